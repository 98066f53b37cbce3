"""Packing by cutting stock: a linear program over patterns of piece lengths, priced by a knapsack."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelattice.llm.steps import numbered, written
from pricelattice.llm.token_ids import encoder, forget
from pricelattice.llm.words import slices

def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(texts: list[str | None], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit, just as the tokenizer gives them."""
    ids, first = encoder(path).encode(texts, 0)
    return [ids[a : b - 1].astype("<u4").tobytes() for a, b in zip(first, first[1:])]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, size: int, with_ids: bool, keep_cache: bool):
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in (part for whole in batches for part in slices(whole, 2 << 20)):
        ids, first = encoder(path).encode(batch["text"].to_pylist(), end_id)
        total = np.diff(first)
        count = -(-total // size)
        row = np.repeat(np.arange(len(count)), count)
        start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * size
        length = np.minimum(total[row] - start, size)
        raw = ids.astype("<u4")
        parts = [raw[a : a + n] for a, n in zip(first[row] + start, length)]
        rest = [n for n in batch.schema.names if n != "text"]
        carried = batch.select(rest).take(pa.array(row)).columns if rest else []
        columns = [*carried, pa.array(start), pa.array(length), pa.array([crc32(x) for x in parts], pa.int64()), pa.array(total[row])]
        names = [*rest, "start", "length", "ids_crc32", "doc_tokens"]
        if with_ids:  # on their way ids take two bytes where they fit, and are compressed
            kind = "<u2" if ids.max(initial=0) < 1 << 16 else "<u4"
            columns.append(pa.array([squeeze(x.astype(kind).tobytes()) for x in parts], pa.binary()))
            columns.append(pa.array(np.full(len(parts), int(kind[-1]), np.int32)))
            names += ["ids", "bytes"]
        yield pa.RecordBatch.from_arrays(columns, names)
    if not keep_cache:
        batch = ids = raw = parts = columns = carried = None
        forget(path)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        whole = [
            np.frombuffer(expand(code.as_py()), f"<u{n}").astype("<u4").tobytes()
            for code, n in zip(batch["ids"], batch["bytes"].to_pylist())
        ]
        rest = [n for n in batch.schema.names if n not in ("ids", "bytes")]
        yield pa.RecordBatch.from_arrays([*(batch[n] for n in rest), pa.array(whole, pa.binary())], [*rest, "ids"])


@dataclass
class Patterns:
    """Row p: how many pieces of each class (column l: l + 1 units) a sequence holds; and how many such sequences."""

    pieces: np.ndarray
    times: np.ndarray


def price(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern of pieces of 1..n units within ``capacity`` units."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = min(room, len(values))
        worth = values[:fits] + best[room - 1 :: -1][:fits]
        choice[room] = worth.argmax()
        best[room] = worth[choice[room]]
        if best[room] <= best[room - 1]:
            best[room], choice[room] = best[room - 1], -1
    pattern, room = np.zeros(len(values)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= choice[room] + 1
    return float(best[capacity]), pattern


def cutting_stock(demand: np.ndarray, capacity: int, rounds: int = 4_000) -> Patterns:
    """Patterns that hold every piece, in about the fewest sequences.

    Column generation: the simplex method keeps as many patterns as there are classes; its dual prices go to the
    knapsack, which returns the pattern worth the most; a worth of one or less proves the optimum.
    Pattern counts are rounded down and the few pieces left over are packed first-fit, longest first.
    Stopping after ``rounds`` columns, or a rounding error, only costs padding, never a piece.
    """
    classes = len(demand)
    basis = np.zeros((classes, classes))  # column j: the pattern in place j
    basis[np.arange(classes), np.arange(classes)] = capacity // np.arange(1, classes + 1)
    inverse, amount = np.diag(1 / basis.diagonal()), demand / basis.diagonal()
    for _ in range(rounds):
        worth, pattern = price(np.maximum(inverse.sum(axis=0), 0), capacity)
        if worth <= 1 + 1e-9:
            break
        towards = np.einsum("ij,j->i", inverse, pattern)
        grows = towards > 1e-9
        if not grows.any():
            break
        ratio = np.full(classes, np.inf)
        ratio[grows] = amount[grows] / towards[grows]
        out = int(ratio.argmin())
        amount = np.maximum(amount - ratio[out] * towards, 0)
        amount[out] = ratio[out]
        basis[:, out] = pattern
        row = inverse[out] / towards[out]
        inverse -= np.outer(towards, row)
        inverse[out] = row
    columns, times = basis.T.astype(np.int64), np.floor(amount + 1e-7).astype(np.int64)
    left = demand.astype(np.int64) - times @ columns
    while (left < 0).any():  # rounding of the amounts: take back a pattern that holds too many
        over = int(np.flatnonzero(left < 0)[0])
        back = int(np.flatnonzero((columns[:, over] > 0) & (times > 0))[0])
        times[back] -= 1
        left += columns[back]
    more, counts = [], []
    while left.any():
        pattern, room = np.zeros(classes, np.int64), capacity
        for units in range(min(classes, room), 0, -1):
            pattern[units - 1] = min(left[units - 1], room // units)
            room -= pattern[units - 1] * units
        holds = pattern > 0
        counts.append(int((left[holds] // pattern[holds]).min()))
        left -= counts[-1] * pattern
        more.append(pattern)
    if more:
        columns, times = np.concatenate([columns, np.array(more)]), np.concatenate([times, counts])
    return Patterns(columns[times > 0], times[times > 0])


def _placer(patterns: Patterns):
    """(class, rank in the class) -> (sequence, order within the sequence)."""
    first_sequence = np.concatenate([[0], np.cumsum(patterns.times)])
    slots = np.concatenate([np.zeros((1, patterns.pieces.shape[1]), np.int64),
                            np.cumsum(patterns.pieces * patterns.times[:, None], axis=0)])
    before = np.cumsum(patterns.pieces[:, ::-1], axis=1)[:, ::-1] - patterns.pieces  # longer pieces come first

    def place(units: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, order = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        for u in np.unique(units):
            here = np.flatnonzero(units == u)
            p = np.searchsorted(slots[:, u - 1], ranks[here], side="right") - 1
            copies = patterns.pieces[p, u - 1]
            k = ranks[here] - slots[p, u - 1]
            sequence[here] = first_sequence[p] + k // copies
            order[here] = before[p, u - 1] + k % copies
        return sequence, order

    return place


def pack(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, size: int = 4096, unit: int = 16,
    id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, with_ids: bool = False,
    keep_cache: bool = True,
) -> DataFrame:
    """Pieces of the documents' tokens, laid into sequences of ``size`` ids.

    A document is its ids and ``end_id`` (a null or empty text: that alone); it is cut only behind each ``size`` ids.
    Returns one row per piece: the ``carry`` columns (default: the id; names of the result are replaced), start, length, ids_crc32,
    doc_tokens, sequence_id, offset, and with ``with_ids`` the ids as little-endian 32-bit.
    Offsets are gapless from 0, longer pieces first; what a sequence lacks is padding.

    Lengths count in classes of ``unit`` ids for the linear program; its input is the histogram of at most
    size / unit classes.  ``keep_cache`` leaves a worker the words it has encoded for its next tasks, about a hundred megabytes.  In each class the pieces are ranked by length, id and start, and the rank gives the place.
    """
    tokenizer = tokenizer or default_tokenizer()
    added = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    kept = [c for c in ([id_col] if carry is None else carry) if c not in added]
    place = [f"c{i}" for i in range(len(kept))]
    kinds = "".join(f"{p} {docs.schema[c].dataType.simpleString()}, " for p, c in zip(place, kept))
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"), *[F.col(c).alias(p) for p, c in zip(place, kept)])
    pieces = rows.mapInArrow(
        lambda batches: _pieces(batches, tokenizer, end_id, size, with_ids, keep_cache),
        f"key {docs.schema[id_col].dataType.simpleString()}, {kinds}start long, length long, ids_crc32 long, doc_tokens long"
        + ", ids binary, bytes int" * with_ids,
    ).withColumn("units", F.ceil(F.col("length") / unit).cast("int"))
    pieces = written(pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    ranked = numbered(pieces.drop("ids", "bytes"), ["units"], ["length", "key", "start"], "rank")
    demand = np.zeros(-(-size // unit), np.int64)
    for r in ranked.groupBy("units").count().collect():  # one row per class
        demand[r["units"] - 1] = r["count"]
    patterns = cutting_stock(demand, len(demand))

    @F.pandas_udf("sequence_id long, ordinal long")
    def placed(units: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, order = _placer(patterns)(units.to_numpy(), ranks.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "ordinal": order})

    laid = ranked.withColumn("at", placed("units", "rank")).withColumn("sequence_id", F.col("at.sequence_id"))
    before = Window.partitionBy("sequence_id").orderBy("at.ordinal").rowsBetween(Window.unboundedPreceding, -1)
    laid = laid.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    if with_ids:  # the ids are moved once, when their place is known
        laid = laid.join(pieces.select("piece", "ids", "bytes"), "piece")
    found = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    laid = laid.select(*place, *found, *(["ids", "bytes"] if with_ids else []))
    if with_ids:
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in laid.drop("ids", "bytes").schema)
        laid = laid.mapInArrow(_unpacked, f"{kinds}, ids binary")
    return laid.select(*[F.col(p).alias(c) for p, c in zip(place, kept)], *found, *(["ids"] if with_ids else []))
