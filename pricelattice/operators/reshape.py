"""Wide measures to long rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_measures(
    df: DataFrame, ids: list[str], measures: list[str], name: str = "medida", value: str = "valor"
) -> DataFrame:
    """One row per measure that has a value; measures without one give no row."""
    return df.unpivot(ids, measures, name, value).where(F.col(value).isNotNull())
