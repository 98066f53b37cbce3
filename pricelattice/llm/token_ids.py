"""Token ids of texts by the tokenizers library, a slice of texts at a time.

Both public tokenizers used here cut a text into words before they merge, and a word's ids do not depend on what stands
around it.  So a slice is cut by classes of code points in NumPy, its words are made distinct in Arrow, and only words not
met before go to the library.  Classes and lower case are asked of the library itself, once a code point.  A file
with another normaliser or cutting rule, or a text beyond the rules below, goes to the library whole.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pricelattice.llm.words import give_back

#: Words, and bytes of words, kept before a worker starts its cache afresh.
CACHE_WORDS, CACHE_BYTES = 1_500_000, 48 << 20
#: Words that go to the library in one text.
LINES = 50
#: Characters of a long text that are cut at once.
PART = 4 << 20
#: Texts that lower-case and normalise character by character, each within this range.
_SIMPLE = re.compile("[\x00-įı-ňŊ-ǃǝ-ǯǴ-ș‐-‧‰-⁞₠-₿]*")
#: The cutting rules that the fast way knows.
_BYTE_RULE = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_WORD_NORMAL = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_WORD_RULE = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_UNKNOWN, _OTHER_SPACE, _SPACE, _LETTER, _NUMBER, _MARK, _END = range(7)
#: Stands between texts; a text that holds it goes to the library whole.
_SEPARATOR = "\U0010FFFF"
#: Bytes that byte-level files name by another character than their own: {byte as a character: its name}.
_OWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_NAMES = {chr(b): chr(0x100 + n) for n, b in enumerate(sorted({*range(0x100)} - {*_OWN}))}
_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def forget(path: str) -> None:
    """Drop the worker's encoder of a file, and give freed memory back, as the worker may go on with other work."""
    _loaded.pop(path, None)
    gc.collect()
    give_back()


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are parallel; threads on top only spin
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.special = [t["content"] for t in rules["added_tokens"]]
        cut, model = (rules["normalizer"], rules["pre_tokenizer"]), rules["model"]
        plain = rules.get("post_processor") is None and model["type"] == "BPE" and not model["dropout"]
        self.joins = cut == (None, _BYTE_RULE)  # a blank belongs to the word behind it, and other white space counts
        self.known = plain and all(self.special) and (self.joins or cut == (_WORD_NORMAL, _WORD_RULE))
        self.classes = np.zeros(0x110001, np.uint8)
        self.classes[ord(_SEPARATOR)] = _END
        self.clear()

    def clear(self) -> None:
        """Forget the words met so far."""
        self.words = pa.array([], pa.binary())
        self.keys, self.slot_of = np.zeros(0, np.int64), np.zeros(0, np.int32)  # hashes of the words in ascending order, and their numbers
        self.flat = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros(1 << 16, np.int64)  # word w has the ids flat[first[w]:first[w + 1]]

    def encode(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts end to end, ``end_id`` behind each; text i has those from first[i] to first[i + 1]."""
        pieces, place, whole = [], [], []
        for i, text in enumerate(texts):
            text = text or ""
            if self._simple(text):
                for part in _parts(text):
                    pieces.append(part), place.append(i)
            else:
                whole.append(i)
        ids, first = self._cut(pieces)
        if len(pieces) == len(texts) and place == list(range(len(texts))):
            return self._ended(ids, first, end_id)
        found: list[list[np.ndarray]] = [[] for _ in texts]
        for n, i in enumerate(place):
            found[i].append(ids[first[n] : first[n + 1]])
        for i in whole:
            found[i].append(np.array(self.tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, np.uint32))
        sizes = [sum(map(len, own)) for own in found]
        flat = np.concatenate([part for own in found for part in own]) if texts else np.zeros(0, np.uint32)
        return self._ended(flat, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), end_id)

    def _ended(self, ids: np.ndarray, first: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        return np.insert(ids, first[1:], np.uint32(end_id)), first + np.arange(len(first))

    def _simple(self, text: str) -> bool:
        if not self.known or any(s in text for s in self.special):
            return False
        return text.isascii() or (_SEPARATOR not in text if self.joins else _SIMPLE.fullmatch(text) is not None)

    def _class_of(self, point: int) -> int:
        if point == 0x20:
            return _SPACE
        within = {ch: len(self._pieces_of(ch + chr(point) + ch)) for ch in "a!1"}
        if within["a"] == 1:
            return _LETTER
        if within["!"] == 1:
            return _MARK
        return _NUMBER if (within["1"] == 1 if self.joins else within["a"] == 3) else _OTHER_SPACE

    def _pieces_of(self, text: str):
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        return self.tokenizer.pre_tokenizer.pre_tokenize_str(text)

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts within the rules."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        data = _SEPARATOR.join(texts) + _SEPARATOR
        if not self.joins:
            data = data.lower()
        point = np.frombuffer(data.encode("utf-32-le"), np.uint32)
        kind = self.classes[point]
        if not kind.all():
            for p in np.unique(point[kind == _UNKNOWN]).tolist():
                self.classes[p] = self._class_of(p)
            kind = self.classes[point]
        starts = np.flatnonzero(self._starts(point, kind))
        utf8 = data.encode()
        if len(utf8) == len(point) + 3 * len(texts):  # ASCII but for the separators
            width = np.cumsum(kind == _END) * 3
            at = starts + np.where(starts > 0, width[starts - 1], 0)
        else:
            width = np.cumsum((point >= 0x80).view(np.int8) + (point >= 0x800).view(np.int8) + (point >= 0x10000).view(np.int8), dtype=np.int32)
            width += np.arange(1, len(width) + 1, dtype=np.int32)
            at = np.where(starts > 0, width[starts - 1], 0)
        offsets = np.append(at, len(utf8)).astype(np.int32)
        word = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(utf8)])
        word = word.dictionary_encode()
        slot = self._slots(word.dictionary)[word.indices.to_numpy()]
        begin = self.first[slot].astype(np.int32)
        count = self.first[slot + 1].astype(np.int32) - begin
        end = np.cumsum(count, dtype=np.int32)
        ids = self.flat[np.repeat(begin - end + count, count) + np.arange(end[-1], dtype=np.int32)]
        return ids, np.concatenate([[0], end[kind[starts] == _END]])

    def _starts(self, point: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Where a word begins; every text ends in a separator, which is a word by itself."""
        before = np.concatenate([[_END], kind[:-1]]).astype(np.uint8)
        after = np.concatenate([kind[1:], [_END]]).astype(np.uint8)
        blank, blank_before = kind <= _SPACE, before <= _SPACE
        visible = (after > _SPACE) & (after != _END)
        if self.joins:
            start = np.where(blank, ~blank_before | visible, (kind != before) & (before != _SPACE))
        else:
            start = np.where(blank, ~blank_before, (kind != before) | (kind == _NUMBER))
        start |= kind == _END
        for i in np.flatnonzero((point == 0x27) & start):  # 's 't 'm 'd 're 've 'll
            tail = "".join(map(chr, point[i + 1 : i + 3].tolist()))
            size = 3 if tail in ("re", "ve", "ll") else 2 if tail[:1] in ("s", "t", "m", "d") else 0
            if size:
                start[i + 1], start[i + size] = False, True
        return start

    def _slots(self, words: pa.Array) -> np.ndarray:
        """Numbers of the distinct words in the cache, which holds them all afterwards."""
        if len(self.words) > CACHE_WORDS or self.words.nbytes > CACHE_BYTES:
            self.clear()
        raw = words.to_numpy(zero_copy_only=False).tolist()  # a tenth of the time of to_pylist
        keys = np.fromiter(map(hash, raw), np.int64, len(raw))
        order = np.argsort(keys)  # a search in ascending order stays near where it was
        place = np.empty(len(raw), np.int64)
        place[order] = np.searchsorted(self.keys, keys[order])
        slots = np.zeros(len(raw), np.int32)
        if len(self.keys):
            near = np.minimum(place, len(self.keys) - 1)
            slots = self.slot_of[near]
            known = self.keys[near] == keys
            at = np.flatnonzero(known)
            # a hash tells where a word may be, its bytes whether it is there
            known[at] = pc.equal(self.words.take(pa.array(slots[at])), words.take(pa.array(at))).to_numpy(zero_copy_only=False)
        else:
            known = np.zeros(len(raw), bool)
        fresh = np.flatnonzero(~known)
        if len(fresh):
            ids, sizes = self._encoded([raw[i].decode() for i in fresh.tolist()])
            n = len(self.words)
            total = self.first[n] + np.cumsum(sizes)
            self.first, self.flat = _room(self.first, n + len(fresh) + 1), _room(self.flat, int(total[-1]))
            self.flat[self.first[n] : total[-1]] = ids
            self.first[n + 1 : n + 1 + len(fresh)] = total
            self.words = pa.concat_arrays([self.words, words.take(pa.array(fresh))])
            slots[fresh] = np.arange(n, n + len(fresh), dtype=np.int32)
            fresh = fresh[np.argsort(keys[fresh])]
            self.keys = np.insert(self.keys, place[fresh], keys[fresh])
            self.slot_of = np.insert(self.slot_of, place[fresh], slots[fresh])
        return slots

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of single words end to end, and their number in each word.

        Visible words go to the library's model, if nothing else is done with them, or as lines of one text, where line ends part
        them; the rest one by one.
        """
        lone = [i for i, w in enumerate(words) if w == _SEPARATOR or w.isspace()]
        odd = set(lone)
        lines = [i for i in range(len(words)) if i not in odd] if odd else range(len(words))
        ids, at = [], []
        if self.joins:
            own, count = self._of_model([words[i] for i in lines])
            ids.append(own), at.append(np.repeat(np.asarray(lines, np.int64), count))
            lines = []
        for a in range(0, len(lines), 20_000):
            some = lines[a : a + 20_000]
            texts = ["\n".join([words[i] for i in some[b : b + LINES]]) for b in range(0, len(some), LINES)]
            found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
            for b, one in enumerate(found):
                own, line = np.array(one.ids, np.uint32), np.array(one.word_ids, np.int64)
                ids.append(own), at.append(np.asarray(some[b * LINES : (b + 1) * LINES])[line])
        for i, found in zip(lone, self.tokenizer.encode_batch_fast(
            ["" if words[i] == _SEPARATOR else words[i] for i in lone], add_special_tokens=False
        )):
            ids.append(np.array(found.ids, np.uint32)), at.append(np.full(len(found.ids), i))
        ids, at = np.concatenate(ids), np.concatenate(at)
        sizes = np.bincount(at, minlength=len(words))
        return ids[np.argsort(at, kind="stable")], sizes

    def _of_model(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of visible words end to end, and their number in each, by the model of a byte-level file.

        Such a file neither normalises nor cuts a word any further; it only names its bytes by characters.
        """
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        named = "\n".join(words).encode()
        present = np.flatnonzero(np.bincount(np.frombuffer(named, np.uint8), minlength=256)).tolist()
        named = named.decode("latin-1")
        for ch in map(chr, present):
            if ch in _NAMES and ch != "\n":
                named = named.replace(ch, _NAMES[ch])
        ids, count, tokenize = array("I"), array("q"), self.model.tokenize
        for word in named.split("\n"):
            own = tokenize(word)
            count.append(len(own))
            ids.extend([token.id for token in own])
        return np.frombuffer(ids, np.uint32), np.frombuffer(count, np.int64)


def _room(array: np.ndarray, size: int) -> np.ndarray:
    return array if len(array) >= size else np.concatenate([array, np.zeros(max(size - len(array), len(array)), array.dtype)])


def _parts(text: str) -> list[str]:
    """The text in parts of about ``PART`` characters, cut before white space behind something else, where words always part."""
    if len(text) <= PART:
        return [text]
    parts, at = [], 0
    gap = re.compile(r"[^\W_][ \n]")
    while found := gap.search(text, at + PART):
        parts.append(text[at : found.start() + 1])
        at = found.start() + 1
    return [*parts, text[at:]]
