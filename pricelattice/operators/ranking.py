"""Top rows per group and top rows overall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None) -> DataFrame:
    """The first n rows of each group.

    The literal bound on row_number lets Spark keep n rows per group and map task
    before the shuffle, so a hot group is cut down before it meets in one task.
    """
    name = rank or "_position"
    numbered = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)
    return numbered.withColumn(name, F.col(name).cast("long")) if rank else numbered.drop(name)


def top_overall(df: DataFrame, order: list[Column], n: int, rank: str) -> DataFrame:
    """The first n rows of all, numbered.

    Sort-and-limit first: only n rows reach the unpartitioned window.
    """
    first = df.orderBy(*order).limit(n)
    return first.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("long")).orderBy(rank)
