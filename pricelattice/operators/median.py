"""Exact grouped median that never gathers a whole group in one task."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelattice.session import broadcast_if_small, cut_lineage


def _slot(value: Column, per_unit: int) -> Column:
    """A non-decreasing integer image of a double: fine near zero, logarithmic far out."""
    size = F.floor(F.least(F.log1p(F.abs(value)), F.lit(1000.0)) * per_unit)
    # NaN sorts after every number
    return F.when(F.isnan(value), F.lit(1 << 62)).when(value < 0, -size).otherwise(size)


def _middle_slots(rows: DataFrame, keys: list[str], per_unit: int) -> DataFrame:
    """The one or two slots per group that hold the middle ranks, with the ranks below them.

    ``rows`` has the keys, ``_v``, ``_below`` (rows of the group known to lie below all of
    these) and ``_n`` (the group's size, null while unknown).
    """
    group = Window.partitionBy(*keys)
    counts = rows.groupBy(*keys, _slot(F.col("_v"), per_unit).alias("_slot"), "_below", "_n").agg(
        F.count(F.lit(1)).alias("_in_slot")
    )
    ranked = counts.select(
        *keys, "_slot", "_in_slot",
        F.coalesce("_n", F.sum("_in_slot").over(group)).alias("_n"),
        (F.col("_below") + F.sum("_in_slot").over(group.orderBy("_slot"))).alias("_upto"),
    ).withColumn("_before", F.col("_upto") - F.col("_in_slot"))
    middle = ranked.where((F.col("_before") < _high_rank()) & (F.col("_upto") >= _low_rank()))
    return middle.select(
        *[F.col(k).alias(f"_m_{k}") for k in keys], F.col("_slot").alias("_m_slot"), "_in_slot", "_n",
        F.min("_before").over(group).alias("_below"),
    )


def _low_rank() -> Column:
    return F.floor((F.col("_n") + 1) / 2)  # ranks count from 1; for an odd size both are the same


def _high_rank() -> Column:
    return F.floor((F.col("_n") + 2) / 2)


def _rows_in(rows: DataFrame, keys: list[str], middle: DataFrame, per_unit: int) -> DataFrame:
    # null is a group of its own, so keys are matched null-safely
    here = _slot(F.col("_v"), per_unit) == F.col("_m_slot")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys], here)
    return rows.select(*keys, "_v").join(broadcast_if_small(middle), same).select(*keys, "_v", "_below", "_n")


def exact_median(
    df: DataFrame, keys: list[str], value: str, result: str, size: str,
    per_unit: int = 1024, max_in_slot: int = 5_000_000,
) -> DataFrame:
    """Per group: the interpolated median of a non-null column and the group's row count.

    1. Count rows per group and value slot.  Slots are counted in the map tasks, so a
       group holding a third of all rows sends a few thousand counts, not its rows.
    2. Running counts over a group's slots show which slots hold the middle ranks; this
       list of at most two slots per group is written and its size checked.
    3. While such a slot is still too full for one task, its rows are counted again in
       slots a thousand times finer.
    4. Only the rows of the last slots go on, counted per distinct value (again combined
       on the map side), and the middle values are read off their running counts.
    """
    rows = df.select(
        *keys, F.col(value).alias("_v"), F.lit(0).cast("long").alias("_below"), F.lit(None).cast("long").alias("_n")
    )
    middle = cut_lineage(_middle_slots(rows, keys, per_unit))
    while per_unit < 1 << 40 and (middle.agg(F.max("_in_slot")).first()[0] or 0) > max_in_slot:
        inside = _rows_in(rows, keys, middle, per_unit)
        per_unit <<= 10  # a power of two, so fine slots nest in coarse ones
        middle = cut_lineage(_middle_slots(inside, keys, per_unit))

    picked = _rows_in(rows, keys, middle, per_unit)
    values = picked.groupBy(*keys, "_below", "_n", "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = F.col("_below") + F.sum("_c").over(Window.partitionBy(*keys).orderBy("_v"))
    placed = values.withColumn("_upto", upto)

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("_c") < rank) & (F.col("_upto") >= rank), F.col("_v")))

    return placed.groupBy(*keys, "_n").agg(
        value_at(_low_rank()).alias("_a"), value_at(_high_rank()).alias("_b")
    ).select(*keys, (F.col("_a") * 0.5 + F.col("_b") * 0.5).alias(result), F.col("_n").alias(size))
