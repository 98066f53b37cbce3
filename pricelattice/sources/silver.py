"""Silver tables on disk: partitioned write, idempotent rewrite, merged read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelattice import vocabulary as V
from pricelattice.functions.text import file_id
from pricelattice.operators.keyed import in_partitions, overwrite_partitions
from pricelattice.session import drop_scratch, path_exists, scratch_path

PARTITION_COLUMNS = ["report_type", "desonerado", "year", "month", "state_slug"]


def write_silver(df: DataFrame, root: str) -> None:
    """Hive-style folders per report type, regime, year, month and state.

    Folders present in ``df`` are replaced as a whole; see ``merge_silver`` for adding
    single files to them.
    """
    overwrite_partitions(df, root, PARTITION_COLUMNS)


def merge_silver(spark: SparkSession, root: str, parsed: DataFrame) -> None:
    """Adds parsed files; a file parsed again replaces its earlier rows.

    Only the folders the parsed files belong to are read and rewritten.  The merged
    rows are written aside first, so no folder is read while it is replaced.
    """
    if not path_exists(spark, root):
        write_silver(parsed, root)
        return
    # parsed rows have every column of their report type; the schema also types the folder names for pruning
    affected = in_partitions(spark.read.schema(parsed.schema).parquet(root), parsed, PARTITION_COLUMNS)
    aside = scratch_path(spark, "silver-merge")
    merged = replace_files(affected, parsed)
    merged.write.parquet(aside)
    overwrite_partitions(spark.read.schema(merged.schema).parquet(aside), root, PARTITION_COLUMNS)
    drop_scratch(spark, aside)


def read_silver(spark: SparkSession, root: str, report_type: str | None = None) -> DataFrame:
    """Files of differing layouts merged by column name; folder names become columns."""
    reader = spark.read.option("mergeSchema", True).option("basePath", root)
    return reader.parquet(root if report_type is None else f"{root}/report_type={report_type}")


def silver_schema() -> str:
    """Every column that a silver file of any layout can have, and the folder columns."""
    texts = ["codigo", "descricao", "unidade", "blob_name", "region", "archive_stem", "parsed_at"]
    measures = [m for own in V.MEASURES.values() for m in own]
    return ", ".join([
        *[f"{c} string" for c in texts], *[f"{m} double" for m in measures],
        "revisado boolean, report_type string, desonerado boolean, year int, month string, state_slug string",
    ])


def read_known_silver(spark: SparkSession, root: str) -> DataFrame:
    """Files of differing layouts with the columns they can have; those a file lacks are null.

    The columns are given, so no file is opened to find them, and a question about some folders opens theirs only.
    """
    return spark.read.schema(silver_schema()).parquet(root)


def retype_partition_columns(df: DataFrame) -> DataFrame:
    """Folder names come back as text or number; restore the panel's types."""
    return df.withColumns({
        "desonerado": F.col("desonerado").cast("boolean"),
        "year": F.col("year").cast("int"),
    })


def replace_files(existing: DataFrame, parsed: DataFrame, path: str = "blob_name") -> DataFrame:
    """Rows of a re-parsed source file replace that file's earlier rows."""
    key = "_file_id"
    old = existing.withColumn(key, file_id(F.col(path)))
    new = parsed.withColumn(key, file_id(F.col(path)))
    kept = old.join(new.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True).drop(key)
