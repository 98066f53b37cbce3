"""Partition-level rules: which partitions changed, and which version of them counts.

Both rules depend on a short list of partition keys (states x months x regimes),
never on a window over a partition's rows: one state may hold a third of the data.
The key list is aggregated on the map side and joined back, broadcast only once its
size is known.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelattice.session import broadcast_if_small

NEVER = datetime(1900, 1, 1)


def high_water_mark(target: DataFrame, column: str = "parsed_at") -> DataFrame:
    """One row: the newest parse time already in the target."""
    newest = F.coalesce(F.max(column), F.lit(NEVER).cast("timestamp_ntz"))
    return target.agg(newest.alias("high_water_mark"))


def changed_partitions(staged: DataFrame, keys: list[str], mark: Column) -> DataFrame:
    """Keys of the partitions holding a row parsed after the mark."""
    return staged.where(F.col("parsed_at") > mark).select(*keys).distinct()


def rows_of_changed_partitions(staged: DataFrame, keys: list[str], target: DataFrame) -> DataFrame:
    """All rows, old ones included, of every partition with something new."""
    mark = high_water_mark(target).first()["high_water_mark"]
    changed = changed_partitions(staged, keys, F.lit(mark).cast("timestamp_ntz"))
    return staged.join(broadcast_if_small(changed, written=True), keys, "left_semi")


def resolve_revisions(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keep revised rows, and unrevised rows of partitions that have no revised row."""
    revised = rows.where("revisado").select(*keys).distinct().withColumn("_revised", F.lit(True))
    flagged = rows.join(broadcast_if_small(revised, written=True), keys, "left")
    return flagged.where(F.col("revisado") | F.col("_revised").isNull()).drop("_revised")
