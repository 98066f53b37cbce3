"""Token ids as files of a Re-Pair grammar: frequent pairs become rules, any range of ids can be decoded.

A file holds one shard: its documents' ids end to end, as a sequence of symbols below ``base`` (ids) and above (rules
of two symbols each), with how many ids a symbol stands for, and where each document and each ``STRIDE`` symbols begin.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelattice.llm.steps import written
from pricelattice.llm.token_ids import encoder
from pricelattice.llm.words import slices
from pricelattice.session import broadcast_if_small

#: Fixed values of the format: its mark, and the symbols between two entries of the index.
MAGIC, STRIDE = b"RPG1", 64
_HEADER = struct.Struct("<4s5q")
#: Odd factors of the hashes of pairs, two a round.
_FACTORS = np.random.default_rng(20240317).integers(1 << 30, 1 << 31, 64, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def repair(ids: np.ndarray, last: np.ndarray, base: int, least: int = 4, saving: float = 0.06) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair in rounds: (symbols, rules, last), where rule r is the pair of symbols rules[r], itself symbol base + r.

    A round counts the pairs of neighbours and replaces those that occur ``least`` times; where two of them share a
    symbol the more frequent one wins, and the other is counted anew in the next round.  ``last`` marks each document's end,
    over which no pair reaches.  It ends when no pair is left, or a round shortens the sequence by less than ``saving``.
    """
    symbols, last, rules, made = ids.astype(np.uint32), last.copy(), [], 0
    while len(symbols) > 1:
        at, rule, pairs = _replaced(symbols, last, least, len(rules))
        if not len(at):
            break
        symbols[at] = base + made + rule
        last[at] = last[at + 1]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols, last = symbols[stay], last[stay]
        rules.append(pairs)
        made += len(pairs)
        if len(at) < saving * len(stay):
            break
    return symbols, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), last


def _replaced(symbols: np.ndarray, last: np.ndarray, least: int, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One round: places to replace, the new rule of each, and the rules.

    Pairs are counted in a table by their hash.  A slot counts the one pair that it holds; another pair of that slot waits
    for the next round, whose hash is another one.
    """
    bits = min(max(len(symbols).bit_length() - 1, 8), 22)
    left, right = symbols[:-1], symbols[1:]
    slot = left * _FACTORS[2 * turn % len(_FACTORS)]
    slot ^= right * _FACTORS[(2 * turn + 1) % len(_FACTORS)]
    slot = (slot >> np.uint32(32 - bits)).astype(np.int64)
    at = np.flatnonzero((np.bincount(slot, minlength=1 << bits) >= least)[slot] & ~last[:-1])
    slot, pair = slot[at], (left[at].astype(np.uint64) << np.uint64(32)) | right[at]
    holder = np.zeros(1 << bits, np.uint64)
    holder[slot] = pair
    own = holder[slot] == pair
    at, slot = at[own], slot[own]
    worth = np.bincount(slot, minlength=1 << bits)[slot]
    own = worth >= least
    at, slot, worth = at[own], slot[own], worth[own]
    if not len(at):
        return at, at, np.zeros((0, 2), np.uint32)
    worth = (worth << 22) | slot  # the more frequent first, one pair has one number
    next_to = at[1:] == at[:-1] + 1
    same = next_to & (worth[1:] == worth[:-1])
    fits = np.ones(len(at), bool)
    fits[1:] &= ~next_to | (worth[1:] >= worth[:-1])
    fits[:-1] &= ~next_to | (worth[:-1] >= worth[1:])
    if same.any():  # of a run of one pair every second
        place = np.arange(len(at))
        begins = np.where(np.concatenate([[False], same]), 0, place)
        fits &= (place - np.maximum.accumulate(begins)) % 2 == 0
    at, slot = at[fits], slot[fits]
    used = np.bincount(slot, minlength=1 << bits) >= least
    fits = used[slot]
    at, slot = at[fits], slot[fits]
    chosen = np.flatnonzero(used)
    number = np.zeros(1 << bits, np.int32)
    number[chosen] = np.arange(len(chosen))
    rule = number[slot]
    pairs = np.empty((len(chosen), 2), np.uint32)
    pairs[rule, 0], pairs[rule, 1] = symbols[at], symbols[at + 1]
    return at, rule, pairs


def lengths_of(rules: np.ndarray, base: int) -> np.ndarray:
    """How many ids each rule stands for; a rule's symbols come before it."""
    lengths = np.ones(len(rules), np.int64)
    left, right = (rules[:, side].astype(np.int64) - base for side in (0, 1))
    while True:
        new = np.where(left < 0, 1, lengths[np.maximum(left, 0)]) + np.where(right < 0, 1, lengths[np.maximum(right, 0)])
        if (new == lengths).all():
            return lengths
        lengths = new


def _ids_of(rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """Ids of all rules end to end: every pass replaces rules by their two symbols."""
    symbols = rules.reshape(-1)
    while (rule := symbols >= base).any():
        count = 1 + rule
        at = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.uint32)
        out[at] = symbols
        pairs = rules[symbols[rule].astype(np.int64) - base]
        out[at[rule]], out[at[rule] + 1] = pairs[:, 0], pairs[:, 1]
        symbols = out
    return symbols


def store(ids: np.ndarray, first: np.ndarray) -> bytes:
    """The file of documents with the ids first[i] to first[i + 1]."""
    base = int(ids.max(initial=0)) + 1
    last = np.zeros(len(ids), bool)
    last[first[1:][np.diff(first) > 0] - 1] = True
    symbols, rules, last = repair(ids, last, base)
    lengths = lengths_of(rules, base)
    sizes = np.where(symbols < base, 1, lengths[np.maximum(symbols.astype(np.int64) - base, 0)]) if len(rules) else np.ones(len(symbols), np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    width = 2 if base + len(rules) <= 1 << 16 else 3 if base + len(rules) <= 1 << 24 else 4
    packed = lambda x: np.ascontiguousarray(x, "<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()
    return b"".join([
        _HEADER.pack(MAGIC, width, base, len(rules), len(symbols), len(first) - 1),
        packed(rules.reshape(-1)), lengths.astype("<u4").tobytes(), first.astype("<i8").tobytes(),
        begins[:-1][::STRIDE].astype("<i8").tobytes(), packed(symbols),
    ])


class Reader:
    """A stored shard: all of it, a document, or any range of its ids."""

    def __init__(self, content: bytes):
        magic, width, self.base, rules, symbols, documents = _HEADER.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a grammar file")
        at = _HEADER.size

        def take(count: int, kind: str) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(content, kind, count, at)
            at += found.nbytes
            return found

        def symbols_of(count: int) -> np.ndarray:
            found = np.zeros((count, 4), np.uint8)
            found[:, :width] = take(count * width, "u1").reshape(-1, width)
            return found.view("<u4").reshape(-1)

        self.words = self.begins = None
        self.rules = symbols_of(2 * rules).reshape(-1, 2)
        self.lengths = take(rules, "<u4").astype(np.int64)
        self.first = take(documents + 1, "<i8")
        self.index = take(-(-symbols // STRIDE), "<i8")
        self.symbols = symbols_of(symbols)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of a run of symbols, put together from the rules' ids."""
        if self.words is None:
            self.words = _ids_of(self.rules, self.lengths, self.base)
            self.begins = np.cumsum(self.lengths) - self.lengths
        symbols = symbols.astype(np.uint32)
        rule = symbols >= self.base
        number = symbols[rule].astype(np.int64) - self.base
        count = np.ones(len(symbols), np.int64)
        count[rule] = self.lengths[number]
        out = np.repeat(symbols, count)
        own = np.repeat(rule, count)
        count = count[rule]
        end = np.cumsum(count)
        if len(end):
            out[own] = self.words[np.repeat(self.begins[number] - end + count, count) + np.arange(end[-1])]
        return out

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), np.int64)
        rule = symbols >= self.base
        out[rule] = self.lengths[symbols[rule].astype(np.int64) - self.base]
        return out

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to ``stop`` in the shard; only the symbols about them are read."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        low = int(np.searchsorted(self.index, start, side="right")) - 1
        high = int(np.searchsorted(self.index, stop, side="left"))
        symbols = self.symbols[low * STRIDE : high * STRIDE]
        ends = self.index[low] + np.cumsum(self.sizes(symbols))
        a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
        begin = ends[a] - self.sizes(symbols[a : a + 1])[0]
        return self.expand(symbols[a:b])[start - begin : stop - begin]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.first[i]), int(self.first[i + 1]))


def _files(batches: Iterator[pa.RecordBatch], path: str, end_id: int, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of one task, in order, as files of about ``size`` ids; a longer document is cut into pieces."""
    part, nth, start, ordinal = 0, 0, 0, 0
    open_ids, open_docs, held = [], [], 0  # the next file's pieces: (id, ordinal, from, n, ids of all)

    def closed() -> pa.RecordBatch:
        nonlocal nth, start, open_ids, open_docs, held
        ids = np.concatenate(open_ids)
        first = np.concatenate([[0], np.cumsum([d[3] for d in open_docs])]).astype(np.int64)
        table = pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([nth], pa.int64()), pa.array([start], pa.int64()), pa.array([len(ids)], pa.int64()),
             *(pa.ListArray.from_arrays(pa.array([0, len(open_docs)], pa.int32()), column) for column in (
                 pa.concat_arrays([d[0] for d in open_docs]), *(pa.array([d[k] for d in open_docs], pa.int64()) for k in (1, 2, 4)))),
             pa.array([any(d[3] < d[4] for d in open_docs)]), pa.array([store(ids, first)], pa.binary())],
            ["part", "nth", "start", "n_ids", "ids_of", "ordinal", "begin", "doc_ids", "cut", "content"],
        )
        nth, start, open_ids, open_docs, held = nth + 1, start + len(ids), [], [], 0
        return table

    for batch in (piece for whole in batches for piece in slices(whole, 6 << 20)):
        part = batch["part"][0].as_py()
        ids, first = encoder(path).encode(batch["text"].to_pylist(), end_id)
        for i in range(batch.num_rows):
            own = ids[first[i] : first[i + 1]]
            at = 0
            while at < len(own):
                n = min(len(own) - at, size - held)
                open_ids.append(own[at : at + n])
                open_docs.append((batch["id"].slice(i, 1), ordinal, at, n, len(own)))
                at, held = at + n, held + n
                if held == size or (at == len(own) and held >= 0.9 * size):
                    yield closed()
            ordinal += 1
    if held:
        yield closed()


def write_ids(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, size: int = 1 << 18, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The documents' ids in grammar files, in ascending order of id; the written table of files.

    A document is its ids and ``end_id`` (a null or empty text: that alone).  A null id comes first, rows of one id stand as in the
    table; other columns are not read.  A row is a file of at most ``size`` ids: part and nth (its place), start (ids before it in its part),
    n_ids, content, cut (holds a document in part), and for each piece of a document in it ids_of (the document's id), ordinal (its
    place in the part), begin (its ids before the piece) and doc_ids (ids of the whole document).  An empty table gives no file.

    Rows are laid out by id in ranges, ties by place, so that an id with any share of the rows is spread over tasks.  Files are
    rows of a Parquet table, so Spark's committed writes guard them when executors are lost.
    """
    tokenizer = tokenizer or default_tokenizer()
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("tie"))
    rows = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    rows = rows.select("id", "text", F.spark_partition_id().alias("part"))
    files = rows.mapInArrow(
        lambda batches: _files(batches, tokenizer, end_id, size),
        f"part int, nth long, start long, n_ids long, ids_of array<{kind}>, ordinal array<long>, begin array<long>, doc_ids array<long>, cut boolean, content binary",
    )
    return written(files, "grammar-files")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            file = Reader(batch["content"][row].as_py())
            ids = file.expand(file.symbols).astype("<u4")
            first = file.first
            lists = [batch[n][row].values for n in ("ids_of", "ordinal", "begin", "doc_ids")]
            crc = [crc32(ids[a:b]) for a, b in zip(first, first[1:])]
            same = lambda n: pa.array(np.full(len(crc), batch[n][row].as_py()))
            yield pa.RecordBatch.from_arrays(
                [same("part").cast(pa.int32()), *lists, pa.array(first[:-1] + batch["start"][row].as_py()), pa.array(np.diff(first)),
                 pa.array(crc, pa.int64())],
                ["part", "id", "ordinal", "begin", "n_tokens", "start", "length", "crc"],
            )


def joined_crc32(first: int, second: int, length: int) -> int:
    """CRC-32 of two strings end to end, from theirs and the second's ``length`` in bytes.

    A CRC is a remainder of polynomials over GF(2): the first one is multiplied by x to the 8 * length.
    """
    def times(a: int, b: int) -> int:
        out = 0
        for bit in range(31, -1, -1):  # the coefficient of x^0 is the highest bit
            if a >> bit & 1:
                out ^= b
            b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
        return out

    power, base = 1 << 31, 1 << 30
    steps = 8 * length
    while steps:
        if steps & 1:
            power = times(power, base)
        base, steps = times(base, base), steps >> 1
    return times(first, power) ^ second


def read_ids(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document of the files: the id, start (ids of all documents before it), n_tokens, ids_crc32.

    Files are decoded one at a time; a document in several has its pieces' sums joined.  The offsets of the parts are
    sums over a row per part.
    """
    kind = files.schema["ids_of"].dataType.elementType.simpleString()
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    totals = broadcast_if_small(totals, written=True)

    def pieces(of: DataFrame) -> DataFrame:
        found = of.mapInArrow(
            _pieces, f"part int, id {kind}, ordinal long, begin long, n_tokens long, start long, length long, crc long"
        )
        return found.join(totals, F.col("part") == F.col("p"))

    whole = pieces(files).where("length = n_tokens").select("id", F.col("start") + F.col("shift"), "n_tokens", "crc")

    @F.pandas_udf("long")
    def joined(rows: pd.Series) -> pd.Series:
        return rows.map(lambda parts: reduce(lambda crc, p: joined_crc32(crc, p["crc"], 4 * p["length"]), parts, 0))

    cut = pieces(files.where("cut")).where("length < n_tokens").groupBy("part", "ordinal").agg(
        F.first("id").alias("id"), F.min(F.col("start") + F.col("shift")).alias("start"), F.first("n_tokens").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("begin", "crc", "length"))).alias("parts"),
    ).select("id", "start", "n_tokens", joined("parts"))
    return whole.union(cut).toDF(id_col, "start", "n_tokens", "ids_crc32")
