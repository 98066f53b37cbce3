"""Which files are price reports, and what their path says about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelattice import vocabulary as V
from pricelattice.functions.text import file_id, last_segment

REPORT_FILE_COLUMNS = [
    "blob_name", "region", "state_slug", "year", "month", "archive_stem", "report_type", "desonerado", "revisado",
]


def report_type(file_name: Column) -> Column:
    """Type told by a lower-case file name; null if it is no synthetic price report."""
    synthetic = F.lit(True)
    for anchor in V.REPORT_NAME_ANCHORS:
        synthetic = synthetic & file_name.contains(anchor)
    # accents may be broken, so the labour report is matched by a tolerant pattern
    kind = (
        F.when(file_name.contains(V.MATERIAL), V.MATERIAL)
        .when(file_name.contains(V.EQUIPMENT), V.EQUIPMENT)
        .when(file_name.rlike("(?is)" + V.LABOUR_NAME_PATTERN), V.LABOUR)
    )
    return F.when(synthetic, kind)


def mentions_relief(path: Column) -> Column:
    """The file name mentions the tax relief, be it 'com' or 'sem'."""
    return F.lower(last_segment(path)).rlike("(?i)" + V.REGIME_NAME_PATTERN)


def mentions_revision(path: Column) -> Column:
    return F.lower(path).contains(V.REVISED_WORD)


def classify_files(files: DataFrame, path: str = "path", keep: tuple[str, ...] = ()) -> DataFrame:
    """Report files among all files, with the facts their path holds."""
    parts = F.split(F.col(path), "/", -1)
    named = files.select(*keep, F.col(path).alias("blob_name"), parts.alias("_parts")).where(
        F.lower("blob_name").endswith(V.REPORT_EXTENSION) & (F.size("_parts") >= 6)
    )
    fields = ["region", "state_slug", "year", "month", "archive_stem"]
    return named.select(
        *keep,
        "blob_name",
        *[F.col("_parts")[i].alias(name) for i, name in enumerate(fields)],
        report_type(F.lower(last_segment(F.col("blob_name")))).alias("report_type"),
        mentions_relief(F.col("blob_name")).alias("desonerado"),
        mentions_revision(F.col("blob_name")).alias("revisado"),
    ).where(F.col("report_type").isNotNull())


def raw_object_path(region: Column, state: Column, year: Column, month: Column, relative: Column) -> Column:
    return F.concat_ws("/", region, state, year.cast("string"), month, relative)


def silver_object_path(root: str) -> Column:
    """Where a classified file's rows belong in silver."""
    return F.concat(
        F.lit(f"{root}/report_type="), F.col("report_type"),
        F.lit("/desonerado="), F.col("desonerado").cast("string"),
        F.lit("/year="), F.col("year"), F.lit("/month="), F.col("month"),
        F.lit("/state_slug="), F.col("state_slug"),
        F.lit("/"), file_id(F.col("blob_name")), F.lit(".parquet"),
    )
