"""Exact top-k inner products by block-at-a-time pruning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Below every score; its negative is a long, too.
_LOWEST = -(2**63 - 1)
_CHUNK = "ids binary, rows binary, kind string"


def usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is there and holds finite numbers only."""
    good = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.col(vector_col).isNotNull() & good)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): every component x as floor(scale * x), x as double."""
    return usable(vectors, vector_col).select(
        F.col(id_col).alias("id"),
        F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("v"),
    )


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, filled up with zeros."""
    out = np.zeros((len(lists), width), np.int64)
    for i, row in enumerate(lists):
        values = row.values.to_numpy(zero_copy_only=False)
        out[i, : len(values)] = values
    return out


def _chunked(batches: Iterator[pa.RecordBatch], width: int, size: int) -> Iterator[pa.RecordBatch]:
    """Rows of one partition in chunks: ids and a row-major matrix of integers, 16 bits wide if they fit."""
    ids, rows, held = [], [], 0

    def out():
        key, body = np.concatenate(ids), np.concatenate(rows)
        kind = "<i2" if np.abs(body).max(initial=0) < 2**15 else "<i8"
        return pa.RecordBatch.from_arrays(
            [pa.array([key.tobytes()]), pa.array([body.astype(kind).tobytes()]), pa.array([kind])], ["ids", "rows", "kind"]
        )

    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            ids.append(part["id"].to_numpy(zero_copy_only=False)), rows.append(_matrix(part["v"], width))
            held += part.num_rows
            if held >= size:
                yield out()
                ids, rows, held = [], [], 0
    if held:
        yield out()


def as_float(rows: np.ndarray, others: np.ndarray) -> bool:
    """Whether every inner product, and every part of one, is exact in double precision."""
    most = lambda m: float(np.abs(m.astype(np.float64)).max(initial=0))
    return most(rows) * most(others) * max(1, rows.shape[1]) < 2.0**52


def blocks_of(ids: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lay similar rows side by side and cut them into ranges: order of the rows, and the term maxima of
    each range for positive and for negative query weights.

    Rows go to the leading one of a few anchor rows, and along it by their product with it.
    """
    anchors = rows[np.linspace(0, len(rows) - 1, min(len(rows), 64)).astype(int)]
    kind = np.float64 if as_float(rows, rows) else np.int64
    products = rows.astype(kind) @ anchors.T.astype(kind)
    lead = products.argmax(axis=1)
    order = np.lexsort((ids, -products[np.arange(len(rows)), lead], lead))
    begins = np.arange(0, len(rows), size)
    return order, np.maximum.reduceat(rows[order], begins), np.minimum.reduceat(rows[order], begins)


def best_of_chunk(
    queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, size: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best rows of one chunk for each query: (query index, id, score), score at least the query's floor.

    A query's blocks come in the order of their bounds - the sum over the components of
    weight times the block's maximum (minimum for a negative weight).  A block is scored
    through its rows while its bound is not below the k-th score so far.
    """
    order, high, low = blocks_of(ids, rows, size)
    ids, rows = ids[order], rows[order]
    kind = np.float64 if as_float(queries, rows) else np.int64
    queries, rows, high, low = (m.astype(kind) for m in (queries, rows, high, low))
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    ranked = np.argsort(-bounds, axis=1)
    top = np.full((len(queries), k), _LOWEST)  # best first
    named = np.full((len(queries), k), np.iinfo(np.int64).max)
    kth = floors.copy()
    live = np.arange(len(queries))
    for turn in range(bounds.shape[1]):
        block = ranked[live, turn]
        worth = bounds[live, block] >= kth[live]
        live, block = live[worth], block[worth]
        if not len(live):
            break
        by_block = np.argsort(block, kind="stable")
        for group in np.split(by_block, np.flatnonzero(np.diff(block[by_block])) + 1):
            who, b = live[group], block[group[0]]
            here = slice(b * size, (b + 1) * size)
            scores = (queries[who] @ rows[here].T).astype(np.int64)
            found = scores >= kth[who][:, None]
            found &= query_ids[who][:, None] != ids[here][None, :]
            q, r = np.nonzero(found)
            if not len(q):
                continue
            touched = np.unique(q)
            all_q = np.concatenate([np.repeat(touched, k), q])
            all_s = np.concatenate([top[who[touched]].ravel(), scores[q, r]])
            all_i = np.concatenate([named[who[touched]].ravel(), ids[here][r]])
            best = np.lexsort((all_i, -all_s, all_q))
            all_q, all_s, all_i = all_q[best], all_s[best], all_i[best]
            first = np.searchsorted(all_q, touched)
            take = first[:, None] + np.arange(k)
            top[who[touched]], named[who[touched]] = all_s[take], all_i[take]
            kth[who[touched]] = np.maximum(kth[who[touched]], top[who[touched], -1])
    filled = named != np.iinfo(np.int64).max
    q, _ = np.nonzero(filled)
    return q, named[filled], top[filled]


def exact_top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding",
    chunk: int = 4_096, query_chunk: int = 2_048, block: int = 128, sample: int = 2_048,
) -> DataFrame:
    """The ``k`` rows of greatest integer inner product for each query: query_id, rank (from 1), vec_id, score.

    Components count as floor(scale * x); a shorter vector counts as if filled up with zeros.  Ties go to the smaller
    id; a query's own id is no candidate.  Vectors that are null or hold null, NaN or infinite components take
    no part, nor do null ids.  Repeated ids are separate rows.  Products beyond 64 bits are not supported.

    Vectors lie in chunks of ``chunk`` rows, queries in chunks of ``query_chunk``; every pair of chunks is one small
    row of work, so tasks are even and none holds more than two chunks.  Scores of a ``sample`` of rows give
    each query a floor under its k-th score first; blocks and rows below it are left out.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col, scale).where("id is not null")
    asked = quantised(queries, id_col, vector_col, scale).where("id is not null")
    extent = lambda df: df.agg(F.coalesce(F.max(F.size("v")), F.lit(0)), F.count("*")).first()
    (width, n_rows), (wide, n_asked) = extent(rows), extent(asked)
    width = max(width, wide)
    if not (n_rows and n_asked and width):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    seen_ids, seen = np.array([r["id"] for r in drawn], np.int64), np.zeros((len(drawn), width), np.int64)
    for i, r in enumerate(drawn):
        seen[i, : len(r["v"])] = r["v"]

    def matrix(batch: pa.RecordBatch, column: str, i: int, kind: str) -> np.ndarray:
        return np.frombuffer(batch[column][i].as_py(), batch[kind][i].as_py()).reshape(-1, width).astype(np.int64)

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunked(batches, width, query_chunk):
            ids, body = np.frombuffer(batch["ids"][0].as_py(), np.int64), matrix(batch, "rows", 0, "kind")
            low = np.full(len(ids), _LOWEST)
            if len(seen) > k:
                kind = np.float64 if as_float(body, seen) else np.int64
                for at in range(0, len(ids), 512):
                    scores = (body[at : at + 512].astype(kind) @ seen.T.astype(kind)).astype(np.int64)
                    scores[ids[at : at + 512, None] == seen_ids] = _LOWEST
                    low[at : at + 512] = np.partition(scores, -k, axis=1)[:, -k]
            yield batch.append_column("floors", pa.array([low.tobytes()]))

    parts = -(-n_rows // chunk)
    stock = rows.repartition(parts, F.xxhash64("id")).mapInArrow(lambda b: _chunked(b, width, chunk), _CHUNK)
    wanted = asked.repartition(-(-n_asked // query_chunk), F.xxhash64("id")).mapInArrow(floors, _CHUNK + ", floors binary")
    work = stock.withColumn("part", F.spark_partition_id()).join(
        wanted.select(
            F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("kind").alias("q_kind"), "floors",
            F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        ), "part",
    ).select("ids", "rows", "kind", "q_ids", "q_rows", "q_kind", "floors")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, low, ids = (np.frombuffer(batch[c][i].as_py(), np.int64) for c in ("q_ids", "floors", "ids"))
                q, found, score = best_of_chunk(
                    matrix(batch, "q_rows", i, "q_kind"), q_ids, low, ids, matrix(batch, "rows", i, "kind"), k, block
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[q]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"]
                )

    found = work.mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
