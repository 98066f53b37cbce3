"""The two reference tables shipped with the package."""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_FOLDER = Path(__file__).resolve().parent.parent / "seeds"

STATES_SCHEMA = "state_slug string, state_code string, state_name string, region string"
MONTHS_SCHEMA = "month_name string, month_number int"


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A reference CSV anywhere Spark can read; '#' lines are comments."""
    return spark.read.csv(path, header=True, schema=schema, comment="#", enforceSchema=False)


def _packaged(spark: SparkSession, name: str, schema: str) -> DataFrame:
    # The files travel with the Python package, not with the cluster's storage, so
    # their dozen of rows go into the plan as a local relation.
    with open(_FOLDER / name, encoding="utf-8", newline="") as f:
        rows = list(csv.DictReader(line for line in f if not line.startswith("#")))
    columns = [part.split()[0] for part in schema.split(", ")]
    ints = {part.split()[0] for part in schema.split(", ") if part.endswith(" int")}
    return spark.createDataFrame(
        [tuple(int(r[c]) if c in ints else r[c] for c in columns) for r in rows], schema
    )


def states(spark: SparkSession) -> DataFrame:
    return _packaged(spark, "states.csv", STATES_SCHEMA)


def months(spark: SparkSession) -> DataFrame:
    return _packaged(spark, "months.csv", MONTHS_SCHEMA)
