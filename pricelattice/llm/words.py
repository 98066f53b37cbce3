"""Words and shingles of UTF-8 texts as 64-bit hashes, a batch at a time in NumPy.

A word's hash covers its bytes with A-Z lowered, each with its place, however long the word is.  Arrays are built per
slice of ``SLICE`` bytes, so a very long text needs eight bytes a word, not a multiple of its size.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_U = np.uint64
_BYTES = np.arange(256)

LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
#: Words of everything but ASCII white space (space, \t \n \v \f \r).
NON_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Words of digits, lowered letters and every byte beyond ASCII.
ALPHANUMERIC = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((LOWER >= 0x61) & (LOWER <= 0x7A)) | (_BYTES >= 0x80)

_BYTE_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
#: Odd factors of the places within a run of this many bytes; in a longer word each run has a factor, too.
RUN = 4096
_PLACE_FACTORS = np.random.default_rng(20240303).integers(1, 2**63, RUN, dtype=np.uint64) * _U(2) + _U(1)
_PLACES = np.multiply.accumulate(np.full(64, 0xD6E8FEB86659FD93, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass
class Words:
    """Words of several texts laid end to end; text i has words first[i] to first[i + 1]."""

    hashes: np.ndarray
    starts: np.ndarray  # byte offsets in `data`
    ends: np.ndarray
    first: np.ndarray
    begins: np.ndarray  # where each text begins in `data`
    data: bytes


def words_of(texts: list[str | None], kind: np.ndarray = NON_SPACE) -> Words:
    encoded = [b"" if t is None else t.encode() for t in texts]
    data = b" ".join(encoded) + b" "
    begins = np.zeros(len(encoded) + 1, np.int64)
    np.cumsum([len(e) + 1 for e in encoded], out=begins[1:])
    raw = np.frombuffer(data, np.uint8)
    hashes, starts, ends = [], [], []
    at = 0
    while at < len(raw):
        stop = min(at + SLICE, len(raw))
        while stop < len(raw) and kind[raw[stop]]:
            stop += 1
        h, s, e = _slice_words(raw[at:stop], kind)
        hashes.append(h), starts.append(s + at), ends.append(e + at)
        at = stop
    starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return Words(
        np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), starts,
        np.concatenate(ends) if ends else np.zeros(0, np.int64), np.searchsorted(starts, begins), begins, data,
    )


def _slice_words(raw: np.ndarray, kind: np.ndarray):
    inside = kind[raw]
    turns = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = turns[0::2], turns[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    lengths = ends - starts
    at = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(at, lengths)
    codes = _BYTE_CODES[LOWER[raw[inside]]]
    if lengths.max() > RUN:
        run, place = np.divmod(place, RUN)
        codes *= mix(run.astype(np.uint64)) | _U(1)
    codes *= _PLACE_FACTORS[place]
    return mix(np.add.reduceat(codes, at) + lengths.astype(np.uint64)), starts, ends


def windows_hash(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words."""
    count = max(0, len(hashes) - size + 1)
    out = np.full(count, size, np.uint64)
    for j in range(size):
        out += hashes[j : j + count] * _PLACES[j]
    return mix(out)


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Distinct shingles of one text, ascending; of fewer words, the whole sequence as one."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    return np.unique(windows_hash(hashes, min(size, len(hashes))))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)


def slices(batch: pa.RecordBatch, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch of about ``size`` bytes of text, one row at least."""
    lengths = batch["text"].cast(pa.large_string()).fill_null("")
    lengths = np.diff(np.frombuffer(lengths.buffers()[1], np.int64)[lengths.offset : lengths.offset + len(lengths) + 1])
    part = np.cumsum(lengths) // size
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)
    give_back()


def give_back() -> None:
    """Return freed memory to the system between batches: workers live on, and the next stage's have their own needs."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps what is free
        ctypes.CDLL(None).malloc_trim(0)
