"""Sets of 64-bit hashes as binary columns: ascending, distinct, little-endian."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelattice.llm.steps import written


def links_within(groups: DataFrame, sets: DataFrame, percent: int, block: int = 256) -> DataFrame:
    """Links (a, b) between nodes of one group whose sets reach a Jaccard similarity of ``percent``.

    ``groups`` has (lead, node, n) with the group's size, ``sets`` (node, items).  A group of at most ``block`` nodes is compared in
    one piece.  A greater one is cut into blocks of about that many; a row of work is then a pair of blocks, so a group of
    any size is spread over tasks.  Every pair of nodes is compared, in memory; of the
    links in a piece only enough to connect what they connect are written.
    """
    kind = groups.schema["node"].dataType.simpleString()
    held = F.collect_list(F.struct("node", "items"))
    whole = groups.where(F.col("n") <= block).join(sets, "node").groupBy("lead").agg(held.alias("x"))
    found = whole.select("x").mapInArrow(lambda batches: _linked(batches, percent), f"a {kind}, b {kind}")
    large = groups.where(F.col("n") > block)
    if not large.isEmpty():
        part = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / block)).cast("int")
        blocks = written(
            large.withColumn("block", part).join(sets, "node").groupBy("lead", "block").agg(held.alias("held")), "blocks"
        )
        one = blocks.select("lead", F.col("block").alias("i"))
        work = one.join(one.withColumnRenamed("i", "j"), "lead").where("i <= j")
        work = work.join(blocks.select("lead", F.col("block").alias("i"), F.col("held").alias("x")), ["lead", "i"]).join(
            blocks.select("lead", F.col("block").alias("j"), F.col("held").alias("y")), ["lead", "j"]
        ).select("x", F.when(F.col("i") < F.col("j"), F.col("y")).alias("y"))
        found = found.union(work.mapInArrow(lambda batches: _linked(batches, percent), f"a {kind}, b {kind}"))
    return found.distinct()


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Spanning links within x, or between x and y where y is given."""
    for batch in batches:
        for i in range(batch.num_rows):
            x = _held(batch["x"][i])
            same = "y" not in batch.schema.names or not batch["y"][i].is_valid
            y = x if same else _held(batch["y"][i])
            shared = common(x[1], y[1])
            sizes = np.array([len(s) for s in x[1]])[:, None] + np.array([len(s) for s in y[1]])[None, :]
            label = spanning(100 * shared >= percent * (sizes - shared), same)
            nodes = x[0] if same else pa.concat_arrays([x[0], y[0]])
            joined = np.flatnonzero(label != np.arange(len(label)))
            if len(joined):
                yield pa.RecordBatch.from_arrays([nodes.take(pa.array(label[joined])), nodes.take(pa.array(joined))], ["a", "b"])


def _held(cell: pa.ListScalar) -> tuple[pa.Array, list[np.ndarray]]:
    rows = cell.values
    return rows.field("node"), [np.frombuffer(s.as_py(), np.uint64) for s in rows.field("items")]


def spanning(linked: np.ndarray, same: bool) -> np.ndarray:
    """Least index that links lead to, for the rows and then the columns of ``linked``, or for both if they are the ``same``."""
    rows, columns = linked.shape
    label = np.arange(rows if same else rows + columns)
    here, there = slice(0, rows), slice(0, rows) if same else slice(rows, None)
    most = len(label)
    while True:
        before = label.copy()
        label[here] = np.minimum(label[here], np.where(linked, label[there][None, :], most).min(axis=1, initial=most))
        label[there] = np.minimum(label[there], np.where(linked, label[here][:, None], most).min(axis=0, initial=most))
        if (label == before).all():
            return label


def common(x: list[np.ndarray], y: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of every set of ``x`` with every set of ``y``.

    Items that both sides have become columns of two 0/1 matrices, ``width`` at a time.
    """
    out = np.zeros((len(x), len(y)), np.int64)
    flat = [np.concatenate(s) if s else np.zeros(0, np.uint64) for s in (x, y)]
    row = [np.repeat(np.arange(len(s)), [len(i) for i in s]) for s in (x, y)]
    items = np.intersect1d(*flat)
    column = [np.searchsorted(items, f) for f in flat]
    known = [(c < len(items)) & (items[np.minimum(c, len(items) - 1)] == f) if len(items) else np.zeros(len(f), bool)
             for c, f in zip(column, flat)]
    row, column = [r[k] for r, k in zip(row, known)], [c[k] for c, k in zip(column, known)]
    for at in range(0, len(items), width):
        sides = []
        for s, r, c in zip((x, y), row, column):
            here = (c >= at) & (c < at + width)
            side = np.zeros((len(s), min(width, len(items) - at)), np.float32)
            side[r[here], c[here] - at] = 1
            sides.append(side)
        out += (sides[0] @ sides[1].T).astype(np.int64)
    return out
