"""Fixity of WARC replicas: Merkle trees over ordered offset ranges, compared from the root down."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelattice.llm.steps import numbered, written
from pricelattice.session import broadcast_if_small


def warc_record(uri: Column, record_id: Column, payload: Column) -> Column:
    """The bytes of one response record; nulls count as empty."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    body = F.coalesce(payload.cast("binary"), F.lit(b""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), text(uri), F.lit("\r\nWARC-Record-ID: <urn:page:"), text(record_id),
        F.lit(">\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), body, F.lit(b"\r\n\r\n"))


def record_index(records: DataFrame, order: list[str], record_col: str = "record", per_file: int = 1_000) -> DataFrame:
    """Lay records into files: adds file, offset, length and digest, and drops the bytes.

    Files hold ``per_file`` consecutive records in ``order``, so no file, and no prefix sum, grows with the data.
    """
    narrow = records.select(
        *[c for c in records.columns if c not in (record_col, "file", "offset", "length", "digest")],
        F.octet_length(record_col).cast("long").alias("length"), F.sha2(F.col(record_col), 256).alias("digest"),
    )
    at = "_at"
    while at in narrow.columns:
        at += "_"
    placed = numbered(narrow, [], order, at).withColumn("file", F.floor(F.col(at) / per_file).cast("long"))
    before = Window.partitionBy("file").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop(at)


@dataclass
class Tree:
    """Levels of nodes (file, place, hash): level 0 covers ``span`` bytes a node, each level above ``fanout`` nodes of the one below."""

    levels: list[DataFrame]
    span: int
    fanout: int


def merkle_tree(index: DataFrame, height: int, span: int = 1 << 16, fanout: int = 16) -> Tree:
    """Hash records (file, offset, length, digest) and offset ranges into a tree for each file.

    A leaf is the hash of the records that begin in its range, in order; a node that of its children with
    their places; a range without records has no node.  A group is bounded by the span or the fan-out.
    """
    record = F.concat_ws(":", "offset", "length", "digest")
    leaves = index.groupBy("file", F.floor(F.col("offset") / span).cast("long").alias("place")).agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", record.alias("r")))), lambda x: x["r"]), "\n"), 256).alias("hash")
    )
    levels = [written(leaves, "merkle-leaves")]
    for _ in range(height):
        child = F.struct("place", F.concat_ws(":", "place", "hash").alias("r"))
        levels.append(levels[-1].groupBy("file", F.floor(F.col("place") / fanout).cast("long").alias("place")).agg(
            F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(child)), lambda x: x["r"]), "\n"), 256).alias("hash")
        ))
    return Tree(levels, span, fanout)


def _height(indexes: list[DataFrame], span: int, fanout: int) -> int:
    """Levels above the leaves until every file has one root."""
    largest = max(i.agg(F.coalesce(F.max("offset"), F.lit(0))).first()[0] for i in indexes) // span
    height = 0
    while largest:
        largest, height = largest // fanout, height + 1
    return height


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(file, place) of nodes whose hashes differ or that only one side has."""
    other = right.withColumnRenamed("hash", "other")
    return left.join(other, ["file", "place"], "full").where(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "place")


def audit(index: DataFrame, replica: DataFrame, span: int = 1 << 16, fanout: int = 16, carry: list[str] | None = None) -> DataFrame:
    """Records in which a replica differs: file, offset, kind, length and replica_length, and the ``carry`` columns of the record.

    Both sides have (file, offset, length, digest); ``replica`` is read at the offsets of the index.  The roots of the files are
    compared first; below a node that agrees nothing is looked at.  kind is 'changed', 'length' (another number of bytes),
    'missing' or 'extra' (only the replica has it).  Equal replicas, or two empty ones, give no rows; of records repeated at one
    file and offset every pair is compared, so neither side should hold any.
    """
    carry = carry or []
    height = _height([index, replica], span, fanout)
    ours, theirs = merkle_tree(index, height, span, fanout), merkle_tree(replica, height, span, fanout)
    suspect = None
    for level in range(height, -1, -1):
        left, right = ours.levels[level], theirs.levels[level]
        if suspect is not None:
            above = suspect.select("file", F.col("place").alias("_above"))
            inside = [F.col("file"), F.floor(F.col("place") / fanout).cast("long").alias("_above")]
            left, right = (
                side.withColumn("_above", inside[1]).join(above, ["file", "_above"], "left_semi").select("file", "place", "hash")
                for side in (left, right)
            )
        suspect = broadcast_if_small(differing(left, right), written=True)
    spots = suspect.select("file", F.col("place").alias("_leaf"))
    leaf = F.floor(F.col("offset") / span).cast("long")
    left, right = (side.withColumn("_leaf", leaf).join(spots, ["file", "_leaf"], "left_semi") for side in (index, replica))
    left = left.select("file", "offset", *carry, F.col("length").alias("length"), F.col("digest").alias("_d"))
    right = right.select("file", "offset", F.col("length").alias("replica_length"), F.col("digest").alias("_e"))
    kind = (
        F.when(F.col("_d").isNull(), "extra").when(F.col("_e").isNull(), "missing")
        .when(F.col("length") != F.col("replica_length"), "length").otherwise("changed")
    )
    both = left.join(right, ["file", "offset"], "full").where(~F.col("_d").eqNullSafe(F.col("_e")) | ~F.col("length").eqNullSafe(F.col("replica_length")))
    return both.select(*carry, "file", "offset", kind.alias("kind"), "length", "replica_length")
