"""Keyed changes to tables: insert, update, upsert, replace, latest.

All are joins on the key.  Batches are first cut to one row per key by an
aggregation-like bounded ranking, so copies of one key never gather in one task, and
no side is broadcast unless Spark knows its size.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from pricelattice.operators.ranking import top_per_group
from pricelattice.session import broadcast_if_small, drop_scratch, scratch_path


def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_per_group(df, keys, order, 1, rank=None)


def latest_per_key(df: DataFrame, keys: list[str], newest: str, tie: str) -> DataFrame:
    """Each key's record with the newest time; undated records come last, then the higher tie column wins."""
    return one_per_key(df, keys, [F.col(newest).desc_nulls_last(), F.col(tie).desc()])


def insert_if_absent(ledger: DataFrame, batch: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Adds rows with a new key; the first of several in the batch wins.

    The batch is cut to one row per key before it is joined, so copies are not shuffled.
    """
    new = one_per_key(batch, [key], order).join(ledger.select(key), key, "left_anti")
    return ledger.unionByName(new.select(ledger.columns))


def update_by_key(
    ledger: DataFrame, batch: DataFrame, keys: list[str], overwrite: list[str], keep_if_null: list[str], order: str
) -> DataFrame:
    """Applies a batch of updates in the given order.

    ``overwrite`` columns take the last update's value, null too; ``keep_if_null``
    columns take the last value that is not null and else keep the old one.  Updates of
    absent keys do nothing.
    """
    last = F.max(F.struct(F.col(order), *overwrite))
    changes = batch.groupBy(*keys).agg(
        last.alias("_last"),
        *[F.max(F.when(F.col(c).isNotNull(), F.struct(order, c)))[c].alias(f"_kept_{c}") for c in keep_if_null],
    )
    joined = ledger.join(changes, keys, "left")
    hit = F.col("_last").isNotNull()
    return joined.select(*[
        F.when(hit, F.col(f"_last.{c}")).otherwise(F.col(c)).alias(c) if c in overwrite
        else F.coalesce(f"_kept_{c}", c).alias(c) if c in keep_if_null
        else F.col(c)
        for c in ledger.columns
    ])


def upsert(ledger: DataFrame, batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of the batch replace rows of the same key entirely; the last of several wins."""
    last = one_per_key(batch, keys, [F.col(order).desc()]).select(ledger.columns)
    return ledger.join(last.select(keys), keys, "left_anti").unionByName(last)


def pending(candidates: DataFrame, ledger: DataFrame, key: str, done: str = "parsed") -> DataFrame:
    """Candidates without a finished ledger entry."""
    finished = ledger.where(F.col("status") == done).select(key)
    return candidates.join(finished, key, "left_anti")


def first_pending(candidates: DataFrame, ledger: DataFrame, key: str, limit: int | None) -> DataFrame:
    """The first ``limit`` candidates by key without a finished entry; each task hands on no more than that many."""
    waiting = pending(candidates, ledger, key).orderBy(key)
    return waiting if limit is None else waiting.limit(limit)


def replace_by_key(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Delete-and-insert: target rows whose key is in the batch give way to the batch.

    Rows whose key is not in the batch stay, even in a partition the batch covers.
    """
    return target.join(batch.select(key), key, "left_anti").unionByName(batch)


# Touched partitions up to this number are named in the predicate itself, so the scan opens only their folders.
LISTED_PARTITIONS = 20_000


def in_partitions(df: DataFrame, partitions: DataFrame, keys: list[str], how: str = "left_semi") -> DataFrame:
    """Rows whose partition is (or, with left_anti, is not) in the list; null is a partition too.

    The list is bounded by states, calendar and regimes.  It is gathered once; its values
    per key prune the folders to be read, and the join on the whole key does the rest.
    """
    touched = partitions.select(*keys).distinct()
    found = touched.limit(LISTED_PARTITIONS + 1).collect()
    if len(found) <= LISTED_PARTITIONS:
        touched = df.sparkSession.createDataFrame(found, touched.schema)
        if how == "left_semi":
            df = df.where(reduce(and_, [_one_of(k, df.schema[k].dataType, {r[k] for r in found}) for k in keys]))
    touched = touched.select(*[F.col(k).alias(f"_p_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_p_{k}")) for k in keys])
    return df.join(broadcast_if_small(touched), same, how)


def _one_of(column: str, kind: DataType, values: set) -> Column:
    known = F.col(column).isin([F.lit(v).cast(kind) for v in sorted(values - {None})])
    return known | F.col(column).isNull() if None in values else known


def replace_partitions(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows of every partition the batch touches give way to the batch."""
    return in_partitions(target, batch, keys, "left_anti").unionByName(batch)


def overwrite_partitions(df: DataFrame, path: str, keys: list[str]) -> None:
    """Write only the partitions present in ``df``; others on disk stay.

    Rows meet by partition value before the write, and adaptive execution splits a
    partition that is too big for one task and merges small ones.
    """
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    )


def merge_into_table(spark: SparkSession, path: str, batch: DataFrame, key: str, partition_keys: list[str]) -> None:
    """Delete-and-insert into a partitioned table, touching only the batch's partitions.

    The merged partitions are first written aside, so a failure before the last step
    leaves the table as it was and the table is not read while it is replaced.
    """
    target = spark.read.schema(batch.schema).parquet(path)
    affected = in_partitions(target, batch, partition_keys)
    aside = scratch_path(spark, "merge")
    replace_by_key(affected, batch, key).write.parquet(aside)
    overwrite_partitions(spark.read.schema(batch.schema).parquet(aside), path, partition_keys)
    drop_scratch(spark, aside)
