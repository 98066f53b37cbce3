"""Repeated passages: MinHash banding of paragraphs, exact verification, removal by components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelattice.llm import words as W
from pricelattice.llm.sets import links_within
from pricelattice.llm.steps import dropped, rooted, sharing_groups, written
from pricelattice.session import BROADCAST_ROWS, broadcast_if_small

_U = np.uint64


def tune_bands(similarity: float, recall: float, most: int = 13) -> tuple[int, int]:
    """Bands and rows for the wanted recall at a similarity: the most rows that ``most`` bands allow, else one row."""
    best = None
    for rows in range(1, 9):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if best is None or bands <= most:
            best = bands, rows
    return best


def anchors(grams: np.ndarray, first: np.ndarray, reach: int) -> np.ndarray:
    """Positions of the least gram of every ``reach`` consecutive grams of one text.

    Where passages agree they have the same anchors, whatever stands around them.
    """
    if len(grams) < reach:
        return np.zeros(0, np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(grams, reach)
    inside = np.ones(len(runs), bool)  # runs that do not cross into the next text
    for end in first[1:-1]:
        inside[max(0, end - reach + 1) : end] = False
    at = np.flatnonzero(inside)
    found = [part + runs[part].argmin(axis=1) for part in np.array_split(at, max(1, len(at) // 100_000))]
    return np.unique(np.concatenate(found))


def covering(at: np.ndarray, node: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """Which windows of ``length`` words to take: of equal ones that follow each other in a text, as many as cover the same words.

    These are the first, the last, and from each the farthest that still meets it.  Equal windows are one node, so no other can be told from them.
    """
    take = np.ones(len(at), bool)
    take[1:] = (node[1:] != node[:-1]) | (text[1:] != text[:-1]) | (np.diff(at) > length)
    edges = np.append(np.flatnonzero(take), len(at))
    take[edges[1:] - 1] = True
    for run in np.flatnonzero(np.diff(edges) > 2):
        i, end = edges[run], edges[run + 1]
        while at[end - 1] - at[i] > length:
            i += np.searchsorted(at[i:end], at[i] + length, "right") - 1
            take[i] = True
    return take


@dataclass
class Units:
    """Stretches of words of several texts: text, first word, word behind the last, and hash of the words."""

    text: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    node: np.ndarray


def units_of(words: W.Words, length: int, reach: int, shingle: int) -> tuple[Units, np.ndarray, Units]:
    """Paragraphs of at least ``length`` words with the shingles of all words, and anchored windows of ``length`` words.

    A paragraph is a line of that many words, or a run of shorter lines up to a blank line, a long line
    or the end of the text; in a text with blank lines, all lines between two of them are one, too, as they may be a wrapped one.
    """
    n = len(words.hashes)
    text_of = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    grams = W.windows_hash(words.hashes, shingle)
    raw = np.frombuffer(words.data, np.uint8)
    line = np.searchsorted(np.flatnonzero(raw == 10), words.starts)
    ahead = np.diff(line, prepend=-2)
    fresh = np.diff(text_of, prepend=-1) > 0
    behind = lambda start: np.append(start[1:], n) if len(start) else start
    blank = ~fresh & (ahead > 1)
    start = np.flatnonzero(fresh | (ahead > 0))
    long = behind(start) - start >= length
    start = start[long | np.concatenate([[True], long[:-1]])[: len(long)] | fresh[start] | blank[start]]
    stop = behind(start)
    block = np.flatnonzero(fresh | blank)
    end = behind(block)
    parted = np.zeros(len(words.first), bool)  # texts with blank lines
    parted[text_of[blank]] = True
    block, end = (x[parted[text_of[block]] & (stop[np.searchsorted(start, block)] != end)] for x in (block, end))
    units = []
    for begin, after in ((start, stop), (block, end)):
        long = after - begin >= length
        units.append((begin[long], after[long], _stretch_hash(words.hashes, begin[long], after[long])))
    start, stop, node = (np.concatenate(c) for c in zip(*units))
    paragraphs = Units(text_of[start], start, stop, node)
    # grams that do not cross into the next text
    counts = np.maximum(np.diff(words.first) - shingle + 1, 0)
    first = np.concatenate([[0], np.cumsum(counts)])
    own = np.repeat(words.first[:-1] - first[:-1], counts) + np.arange(first[-1])
    at = own[anchors(grams[own], first, reach)] if first[-1] else own
    at = at[at + length <= words.first[text_of[at] + 1]]
    node = W.windows_hash(words.hashes, length)[at] if len(at) else np.zeros(0, np.uint64)
    some = covering(at, node, text_of[at], length)
    at, node = at[some], node[some]
    return paragraphs, grams, Units(text_of[at], at, at + length, W.mix(node))


def _stretch_hash(hashes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of each of several stretches that do not overlap: their words with their places."""
    sizes = stop - start
    word = np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    place = word - np.repeat(start, sizes)
    mixed = W.mix(hashes[word] ^ W.mix(place.astype(np.uint64) + _U(1)))
    total = np.add.reduceat(mixed, np.cumsum(sizes) - sizes) if len(sizes) else np.zeros(0, np.uint64)
    return W.mix(total + sizes.astype(np.uint64))


def _keyed(batches: Iterator[pa.RecordBatch], length: int, reach: int, shingle: int, bands: int, rows: int):
    # grams are well mixed, so an odd factor gives each coordinate its own order
    factors = W.mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | _U(1)
    for batch in (part for whole in batches for part in W.slices(whole)):
        words = W.words_of(batch["text"].to_pylist())
        paragraphs, grams, windows = units_of(words, length, reach, shingle)
        keys = np.zeros((len(paragraphs.start), bands), np.uint64)
        if len(keys):
            sizes = paragraphs.stop - paragraphs.start - shingle + 1
            at = np.cumsum(sizes) - sizes
            items = grams[np.repeat(paragraphs.start - at, sizes) + np.arange(sizes.sum())]
            for band in range(bands):
                keys[:, band] = W.mix(np.full(len(keys), band + 1, np.uint64))
                for factor in factors[band * rows : (band + 1) * rows]:
                    keys[:, band] = W.mix(keys[:, band] ^ np.minimum.reduceat(items * factor, at))
        for units, found in ((paragraphs, keys), (windows, np.zeros((0, bands), np.uint64))):
            some = len(found) > 0
            offsets = np.arange(len(units.start) + 1, dtype=np.int32) * (bands if some else 0)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(units.text)), batch["key"].take(pa.array(units.text)),
                 pa.array((units.start - words.first[units.text]).astype(np.int32)),
                 pa.array((units.stop - words.first[units.text]).astype(np.int32)), pa.array(W.signed(units.node)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(W.signed(found.ravel())))],
                ["doc_id", "key", "start", "stop", "node", "bands"],
            )


def _shingled(batches: Iterator[pa.RecordBatch], length: int, reach: int, shingle: int):
    """The shingle sets of the paragraphs asked for: each row names some nodes of its text."""
    for batch in (part for whole in batches for part in W.slices(whole)):
        paragraphs, grams, _ = units_of(W.words_of(batch["text"].to_pylist()), length, reach, shingle)
        asked = batch["nodes"].flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        row = np.repeat(np.arange(batch.num_rows), batch["nodes"].value_lengths().to_numpy(zero_copy_only=False))
        have = {}
        for i, key in enumerate(zip(paragraphs.text.tolist(), paragraphs.node.tolist())):
            have.setdefault(key, i)
        where = [have[key] for key in zip(row.tolist(), asked.tolist())]
        sets = [np.unique(grams[paragraphs.start[i] : paragraphs.stop[i] - shingle + 1]).tobytes() for i in where]
        yield pa.RecordBatch.from_arrays([pa.array(W.signed(asked)), pa.array(sets, pa.binary())], ["node", "items"])


def _cut(batches: Iterator[pa.RecordBatch], carried: list[str]) -> Iterator[pa.RecordBatch]:
    """Texts without the word ranges in ``gone``; a cut leaves the white space before it."""
    for batch in (part for whole in batches for part in W.slices(whole)):
        out, dropped = [], []
        for text, gone in zip(batch["text"].to_pylist(), batch["gone"].to_pylist()):
            if not gone:
                out.append(text), dropped.append([])
                continue
            words = W.words_of([text])
            pieces, spans, at = [], [], 0
            for a, b in zip(gone[0::2], gone[1::2]):
                begin, end = int(words.starts[a]), int(words.ends[b - 1])
                pieces.append(words.data[at:begin])
                spans.append({"start": len(words.data[:begin].decode()), "stop": len(words.data[:end].decode())})
                at = end
            pieces.append(words.data[at:-1])
            out.append(b"".join(pieces).decode()), dropped.append(spans)
        yield pa.RecordBatch.from_arrays(
            [*(batch[c] for c in carried), pa.array(out, pa.string()),
             pa.array(dropped, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))],
            [*carried, "text", "spans"],
        )


def repeated_passages(
    docs: DataFrame, percent: int = 75, length: int = 24, reach: int = 24, shingle: int = 5, recall: float = 0.999,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Passages that an earlier document has too: (doc_id, key, gone, kept_in), one row per document that has any.

    Words are runs of anything but ASCII white space with A-Z lowered.  Two kinds of stretches are compared.  Paragraphs are lines, runs of
    shorter lines, and all lines between two blank ones, of ``length`` words or more; those that collide in a MinHash band (bands tuned to ``recall`` at the threshold) are verified by the exact Jaccard similarity
    of their ``shingle``-word shingles, and equal ones are the same node.  Passages that begin or end within a line are met by windows of ``length`` words that begin at an
    anchor, the least of ``reach`` consecutive shingle hashes: the same passage has the same windows wherever it is
    set in, and every repeat of length + reach + shingle - 2 = 51 words or more holds one.  From the outermost windows a passage
    goes on to the first word that no earlier document with that window has there.

    In a component of nodes the document of the least id (null first) keeps its stretches, the others lose theirs.  Repeats within one document stay.
    Rows equal in id and text are one document; a null or empty text has no passages.
    ``key`` is xxhash64 of the text, ``gone`` the word ranges to cut as [from, to, from, to ...], ``kept_in`` the ids that keep them.
    """
    bands, rows = tune_bands(percent / 100, recall)
    rows_in = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("key"), F.col(text_col).alias("text")
    ).where("text is not null")
    ids = docs.schema[id_col].dataType.simpleString()
    units = written(
        rows_in.mapInArrow(
            lambda batches: _keyed(batches, length, reach, shingle, bands, rows),
            f"doc_id {ids}, key long, start int, stop int, node long, bands array<long>",
        ), "units",
    )
    groups = sharing_groups(units.select(F.explode("bands").alias("bucket"), "node"), "paragraphs")
    nodes = written(groups.select("node").distinct(), "paragraph-nodes")
    # the text of one occurrence of each node gives the shingles to verify
    spots = units.where(F.size("bands") > 0).join(nodes, "node").groupBy("node").agg(F.min(F.struct("doc_id", "key")).alias("doc"))
    spots = spots.groupBy("doc").agg(F.collect_list("node").alias("nodes"))  # at most a document's paragraphs
    spots = written(spots.select(F.col("doc.doc_id").alias("_id"), F.col("doc.key").alias("_key"), "nodes"), "paragraph-spots")
    read = rows_in.join(_broadcast_lists(spots, "nodes"), (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    sets = written(
        read.select("text", "nodes").mapInArrow(lambda batches: _shingled(batches, length, reach, shingle), "node long, items binary")
        .dropDuplicates(["node"]), "paragraph-sets",  # rows equal in id and text
    )
    links = written(links_within(groups, sets, percent), "paragraph-links")
    dropped(sets)
    roots = rooted(nodes, links, "paragraphs").where("node <> root")
    placed = units.select("node", "doc_id", "key", "start", "stop", (F.size("bands") == 0).alias("window"))
    placed = placed.join(broadcast_if_small(roots), "node", "left").select(
        F.coalesce("root", "node").alias("root"), F.struct("doc_id", "key").alias("doc"), "start", "stop", "window"
    )
    # most stretches stand in one document only; those go by two numbers a root
    of = F.xxhash64("doc")
    several = placed.groupBy("root").agg(F.min(of).alias("least"), F.max(of).alias("most")).where("least <> most").select("root")
    repeated = written(placed.join(broadcast_if_small(several, written=True), "root", "left_semi"), "repeated")
    keepers = broadcast_if_small(repeated.groupBy("root").agg(F.min("doc").alias("keeper")), written=True)
    shared = written(repeated.join(keepers, "root"), "shared")
    dropped(units, repeated)
    lost = shared.where("doc <> keeper").groupBy("doc").agg(
        _merged(F.array_sort(F.collect_set(F.struct("start", "stop")))).alias("gone"),
        F.array_sort(F.collect_set("keeper.doc_id")).alias("kept_in"),
        F.array_sort(F.collect_set(F.when(F.col("window"), F.struct("start", "stop", "root")))).alias("windows"),
    )
    lost = written(lost.select("doc.doc_id", "doc.key", "gone", "kept_in", "windows"), "lost")
    ends = lost.where(F.size("windows") > 0).select("gone", "windows").mapInArrow(
        lambda batches: _ends(batches, reach - 1), "root long, left boolean, right boolean"
    )
    more = _extensions(rows_in, shared, ends, length, reach)
    more = more.withColumnsRenamed({"doc_id": "_id", "key": "_key"})
    ranges = F.transform(
        F.sequence(F.lit(0), (F.size("gone") / 2 - 1).cast("int")),
        lambda i: F.struct(F.get("gone", 2 * i).alias("start"), F.get("gone", 2 * i + 1).alias("stop")),
    )
    wider = lost.join(broadcast_if_small(more, written=True), (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return wider.select(
        "doc_id", "key",
        F.when(F.col("more").isNull(), F.col("gone")).otherwise(_merged(F.array_sort(F.concat(ranges, "more")))).alias("gone"),
        F.when(F.col("more").isNull(), F.col("kept_in")).otherwise(F.array_sort(F.array_union("kept_in", "also_in"))).alias("kept_in"),
    )


def _ends(batches: Iterator[pa.RecordBatch], most: int):
    """Windows from which ``most`` words can lead out of the range they lie in: (root, left, right)."""
    flat = lambda column: column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    for batch in batches:
        sizes = [batch[c].value_lengths().to_numpy(zero_copy_only=False) for c in ("gone", "windows")]
        doc = [np.repeat(np.arange(batch.num_rows), n) << 32 for n in (sizes[0] // 2, sizes[1])]
        gone, windows = flat(batch["gone"]), batch["windows"].flatten()
        start, stop, root = (windows.field(n).to_numpy(zero_copy_only=False) for n in ("start", "stop", "root"))
        before, after = np.ones(len(start), bool), np.ones(len(start), bool)
        if len(start) > 1:  # no other window meets it
            before[1:] = (doc[1][1:] != doc[1][:-1]) | (start[1:] > stop[:-1])
            after[:-1] = before[1:]
        held = np.searchsorted(doc[0] + gone[0::2], doc[1] + start, "right") - 1
        begin, end = gone[0::2][held], gone[1::2][held]
        left, right = before & (begin > 0) & (start - most < begin), after & (stop + most > end)
        some = left | right
        yield pa.RecordBatch.from_arrays([pa.array(root[some]), pa.array(left[some]), pa.array(right[some])], ["root", "left", "right"])


#: Bytes of each word's hash that travel with a window.
_WORD_BYTES = 6
#: A window of more occurrences than this is looked up by hashes, not compared in one place.
TOGETHER = 10_000


def _ahead(batches: Iterator[pa.RecordBatch], length: int, most: int):
    """For each side of each window the hashes of the next ``most`` words, nearest first, as far as its text goes."""
    for batch in (part for whole in batches for part in W.slices(whole)):
        words = W.words_of(batch["text"].to_pylist())
        low = np.ascontiguousarray(words.hashes.view(np.uint8).reshape(-1, 8)[:, :_WORD_BYTES])
        spots = batch["spots"].flatten()
        text = np.repeat(np.arange(batch.num_rows), batch["spots"].value_lengths().to_numpy(zero_copy_only=False))
        start, root = (spots.field(n).to_numpy(zero_copy_only=False) for n in ("start", "root"))
        for right, wanted in ((False, spots.field("left")), (True, spots.field("right"))):
            on = np.flatnonzero(wanted.to_numpy(zero_copy_only=False).astype(bool))
            own = text[on]
            at = words.first[own] + start[on]
            if right:
                begin = at + length
                count = np.minimum(words.first[own + 1] - begin, most)
            else:
                count = np.minimum(at - words.first[own], most)
                begin = at - count
            size = int(count.sum())
            place = np.arange(size) - np.repeat(np.cumsum(count) - count, count)
            word = np.repeat(begin, count) + (place if right else np.repeat(count, count) - 1 - place)
            offsets = np.concatenate([[0], np.cumsum(count)]) * _WORD_BYTES
            ahead = pa.Array.from_buffers(pa.binary(), len(on), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(low[word].tobytes())])
            of = pa.array(own)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(of), batch["key"].take(of), pa.array(start[on].astype(np.int32)),
                 pa.array(np.full(len(on), right)), pa.array(root[on]), spots.field("many").take(pa.array(on)), ahead],
                ["doc_id", "key", "start", "right", "root", "many", "ahead"],
            )


def _words_ahead(ahead: pa.Array, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of up to ``most`` word numbers per window, and how many it has."""
    size = np.diff(np.frombuffer(ahead.buffers()[1], np.int32)[ahead.offset : ahead.offset + len(ahead) + 1]) // _WORD_BYTES
    first = np.frombuffer(ahead.buffers()[1], np.int32)[ahead.offset] if len(ahead) else 0
    flat = np.zeros((int(size.sum()), 8), np.uint8)
    flat[:, :_WORD_BYTES] = np.frombuffer(ahead.buffers()[2] or b"", np.uint8, flat.shape[0] * _WORD_BYTES, first).reshape(-1, _WORD_BYTES)
    out = np.zeros((len(size), most), np.uint64)
    out[np.arange(most) < size[:, None]] = flat.view(np.uint64).reshape(-1)
    return out, size


def _compared(batches: Iterator[pa.RecordBatch], most: int):
    """How far each window goes on like one of an earlier document with the same window; rows hold all of one window's occurrences in order."""
    for batch in batches:
        rows = batch["rows"].flatten()
        group = np.repeat(np.arange(batch.num_rows), batch["rows"].value_lengths().to_numpy(zero_copy_only=False))
        if not len(group):
            continue
        doc, key = rows.field("doc").field("doc_id"), rows.field("doc").field("key").to_numpy(zero_copy_only=False)
        same_id = pc.fill_null(pc.equal(doc[1:], doc[:-1]), False).to_numpy(zero_copy_only=False)
        none = doc.is_null().to_numpy(zero_copy_only=False)
        same = (group[1:] == group[:-1]) & (key[1:] == key[:-1]) & (same_id | (none[1:] & none[:-1]))
        rank = np.concatenate([[0], np.cumsum(~same)])  # in order within a group
        ahead, size = _words_ahead(rows.field("ahead"), most)
        far, keeper = np.zeros(len(group), np.int32), np.zeros(len(group), np.int64)
        live, prefix = np.arange(len(group)), group
        for step in range(most):
            live, prefix = live[size[live] > step], prefix[size[live] > step]
            if not len(live):
                break
            order = np.lexsort((ahead[live, step], prefix))
            live, prefix, word = live[order], prefix[order], ahead[live[order], step]
            new = np.concatenate([[True], (prefix[1:] != prefix[:-1]) | (word[1:] != word[:-1])])
            prefix = np.cumsum(new) - 1
            begins = np.flatnonzero(new)
            least, greatest = np.minimum.reduceat(rank[live], begins), np.maximum.reduceat(rank[live], begins)
            held = np.zeros(len(begins), np.int64)  # a row of the earliest document
            first = np.flatnonzero(rank[live] == least[prefix])
            held[prefix[first]] = live[first]
            later = rank[live] > least[prefix]
            far[live[later]], keeper[live[later]] = step + 1, held[prefix[later]]
            stay = (greatest > least)[prefix]
            live, prefix = live[stay], prefix[stay]
        hit = np.flatnonzero(far)
        of = pa.array(hit)
        yield pa.RecordBatch.from_arrays(
            [doc.take(of), pa.array(key[hit]), rows.field("start").take(of), batch["right"].take(pa.array(group[hit])),
             pa.array(far[hit]), doc.take(pa.array(keeper[hit]))], ["doc_id", "key", "start", "right", "words", "keeper"],
        )


def _contexts(batches: Iterator[pa.RecordBatch], most: int):
    """Hash of each window with the next 1, 2 ... words."""
    for batch in batches:
        ahead, size = _words_ahead(batch["ahead"], most)
        chain = W.mix(batch["root"].to_numpy().view(np.uint64) ^ (batch["right"].to_numpy(zero_copy_only=False) + _U(1)))
        for step in range(most):
            on = np.flatnonzero(size > step)
            chain[on] = W.mix(chain[on] ^ ahead[on, step])
            of = pa.array(on)
            yield pa.RecordBatch.from_arrays(
                [*(batch[n].take(of) for n in ("doc_id", "key", "start", "right")), pa.array(np.full(len(on), step + 1, np.int32)),
                 pa.array(W.signed(chain[on]))], ["doc_id", "key", "start", "right", "words", "context"],
            )


def _extensions(rows_in: DataFrame, shared: DataFrame, ends: DataFrame, length: int, reach: int) -> DataFrame:
    """What of a passage stands beyond its outermost windows: (doc_id, key, more, also_in), ranges and ids of documents that have them.

    A window goes on as far as an earlier document with the same window has the same words.  A passage's first and last windows are
    fewer than ``reach`` words from its ends, and words beyond that are another window's; only windows that near to an end of
    what is cut (``ends``) are looked up.
    A window's occurrences come together with the words that follow, one row each, and are compared in memory.  Of a window with more than
    ``TOGETHER`` occurrences every number of words is looked up as one hash, so no task holds them all.
    """
    ids, most = rows_in.schema["doc_id"].dataType.simpleString(), reach - 1
    wanted = ends.groupBy("root").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    counts = shared.where("window").groupBy(F.col("root").alias("r")).agg((F.count("*") > TOGETHER).alias("many"))
    wanted = wanted.join(counts, F.col("root") == F.col("r")).drop("r")
    spots = shared.where("window").join(broadcast_if_small(wanted, written=True), "root").groupBy("doc").agg(
        F.collect_set(F.struct("start", "root", "left", "right", "many")).alias("spots")
    )
    spots = written(spots.select(F.col("doc.doc_id").alias("_id"), F.col("doc.key").alias("_key"), "spots"), "spots")
    read = rows_in.join(_broadcast_lists(spots, "spots"), (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    sides = written(
        read.select("doc_id", "key", "text", "spots").mapInArrow(
            lambda batches: _ahead(batches, length, most),
            f"doc_id {ids}, key long, start int, right boolean, root long, many boolean, ahead binary",
        ).where(F.length("ahead") > 0), "sides",
    )
    row = F.struct(F.struct("doc_id", "key").alias("doc"), "start", "ahead")
    found = sides.where("not many").groupBy("root", "right").agg(F.sort_array(F.collect_list(row)).alias("rows")).select("right", "rows").mapInArrow(
        lambda batches: _compared(batches, most), f"doc_id {ids}, key long, start int, right boolean, words int, keeper {ids}"
    )
    many = sides.where("many")
    if not many.isEmpty():
        contexts = many.mapInArrow(
            lambda batches: _contexts(batches, most), f"doc_id {ids}, key long, start int, right boolean, words int, context long"
        ).select(F.struct("doc_id", "key").alias("doc"), "start", "right", "words", "context")
        contexts = written(contexts, "contexts")
        least = contexts.groupBy("context").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first <> last")
        hits = contexts.join(broadcast_if_small(least.select("context", "first"), written=True), "context").where("doc <> first")
        hits = hits.groupBy("doc", "start", "right").agg(F.max(F.struct("words", F.col("first.doc_id").alias("keeper"))).alias("far"))
        found = found.union(hits.select("doc.doc_id", "doc.key", "start", "right", "far.words", "far.keeper"))
    stop = F.col("start") + length
    at = F.when(F.col("right"), F.struct(stop.alias("start"), (stop + F.col("words")).alias("stop"))).otherwise(
        F.struct((F.col("start") - F.col("words")).alias("start"), F.col("start").alias("stop"))
    )
    return found.groupBy("doc_id", "key").agg(F.collect_set(at).alias("more"), F.collect_set("keeper").alias("also_in"))


def _broadcast_lists(df: DataFrame, lists: str) -> DataFrame:
    """A written table with a hint to broadcast it, if its rows and the entries of its lists are proven few: 30 MB at most."""
    held = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size(lists)), F.lit(0)).alias("entries")).first()
    return F.broadcast(df) if held.rows <= BROADCAST_ROWS and held.entries <= 4 * BROADCAST_ROWS else df


def _merged(ranges):
    """Ascending ranges (start, stop) as disjoint ones [from, to, from, to ...]."""
    def add(done, at):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.greatest(last, at["stop"])))
        return F.when((F.size(done) > 0) & (at["start"] <= last), joined).otherwise(F.concat(done, F.array(at["start"], at["stop"])))

    return F.aggregate(ranges, F.array().cast("array<int>"), add)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with repeated passages cut out of the text, and spans: the characters cut, by the old text's positions.

    The columns of ``docs`` stay (a column named spans is replaced); rows without a repeat stay as they are.
    """
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # docs may have columns of any names
    plain = docs.toDF(*place.values())
    found = written(repeated_passages(plain, id_col=place[id_col], text_col=place[text_col], **how), "repeats")
    found = found.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "gone")
    found = _broadcast_lists(found, "gone")
    carried = [p for c, p in place.items() if c not in (text_col, "spans")]
    rows = plain.withColumn("_hash", F.xxhash64(place[text_col])).join(
        found, (F.col("_hash") == F.col("_key")) & F.col(place[id_col]).eqNullSafe(F.col("_id")), "left"
    ).select(*carried, F.col(place[text_col]).alias("text"), "gone")
    kinds = "".join(f"{p} {plain.schema[p].dataType.simpleString()}, " for p in carried)
    cut = rows.mapInArrow(
        lambda batches: _cut(batches, carried), f"{kinds}text string, spans array<struct<start:int,stop:int>>"
    )
    return cut.select(
        *[F.col("text" if c == text_col else p).alias(c) for c, p in place.items() if c == text_col or c != "spans"], "spans"
    )
