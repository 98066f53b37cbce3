"""The runs: pages to a download ledger, workbooks to silver, silver to gold.

Ledgers are small keyed tables next to the data; each run reads the ledger, does what
is pending and writes the ledger's next version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelattice import vocabulary as V
from pricelattice.operators import graph, keyed, quality
from pricelattice.plans import build, marts, refresh, served
from pricelattice.plans.staging import STAGES
from pricelattice.session import broadcast_if_small, cut_lineage, drop_scratch, path_exists, scratch_path
from pricelattice.sources import files, links, sheets, silver, workbooks
from pricelattice.sources.classify import classify_files, silver_object_path

DOWNLOADS_SCHEMA = (
    "region string, state_code string, year string, month string, revisado boolean, url string, filename string, "
    "extension string, scraped_at timestamp_ntz, downloaded_at timestamp_ntz, status string, file_hash string"
)
PARSES_SCHEMA = (
    "blob_name string, report_type string, region string, state_slug string, year string, month string, "
    "desonerado boolean, revisado boolean, archive_stem string, silver_blob_name string, row_count long, "
    "status string, error string, parsed_at timestamp_ntz"
)


def empty_downloads(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOWNLOADS_SCHEMA)


def empty_parses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PARSES_SCHEMA)


def record_links(ledger: DataFrame, pages: DataFrame, prefix: str) -> DataFrame:
    """The download ledger with the file links of new pages added as pending."""
    found, _ = links.harvest(pages, prefix)
    facts = links.url_metadata(found.select("link").distinct()).withColumnRenamed("link", "url")
    new = facts.withColumn("status", F.lit("pending"))
    for field in ledger.schema:
        if field.name not in new.columns:
            new = new.withColumn(field.name, F.lit(None).cast(field.dataType))
    return keyed.insert_if_absent(ledger, new.select(ledger.columns), "url", [F.col("url")])


def crawl(ledger: DataFrame, pages: DataFrame, seeds: DataFrame, prefix: str) -> DataFrame:
    """The download ledger after a walk over stored pages from the seeds, at most five links deep.

    ``pages`` has url and html, ``seeds`` has node (a url).
    """
    _, onward = links.harvest(pages, prefix)
    visited = graph.reachable(onward.select(F.col("url").alias("src"), F.col("link").alias("dst")), seeds)
    reached = pages.join(visited.select(F.col("node").alias("url")), "url", "left_semi")
    return record_links(ledger, reached, prefix)


def pending_reports(spark: SparkSession, raw_root: str, ledger: DataFrame) -> DataFrame:
    """Report files below the raw folder that are not parsed yet."""
    paths = files.list_objects(spark, raw_root).select("path", F.col("name").alias("blob_name"))
    return keyed.pending(classify_files(paths, "blob_name", keep=("path",)), ledger, "blob_name")


def run_silver(
    spark: SparkSession, raw_root: str, silver_root: str, ledger: DataFrame, parsed_at: str,
    limit: int | None = None, files_per_round: int = 10_000,
) -> DataFrame:
    """Parse pending workbooks into silver, the first ``limit`` by path; returns the new parse ledger.

    A bad file fails alone: its outcome is recorded and none of its rows are kept.  Files are read by folders of one publication,
    region, state, year and month, and those that wait are picked by a join with the written waiting list; the driver
    holds the folders with their numbers of files, which the calendar bounds, and no file.  A round takes folders of about ``files_per_round``
    files; the ledger takes in the outcomes of all rounds once at the end.
    """
    waiting = pending_reports(spark, raw_root, ledger)
    if limit is not None:  # each task hands on no more than that many
        waiting = waiting.orderBy("blob_name").limit(limit)
    waiting = cut_lineage(waiting.withColumn("_folder", _publication_folder()))
    aside = scratch_path(spark, "outcomes")
    folders = waiting.groupBy("_folder").agg(F.count("*").alias("files")).orderBy("_folder").collect()
    for names in _rounds(folders, files_per_round):
        batch = waiting.where(F.col("_folder").isin(names)).drop("_folder")
        _parse_round(spark, names, batch, silver_root, parsed_at, ledger.columns, aside)
    if not path_exists(spark, aside):
        return ledger
    outcomes = spark.read.schema(PARSES_SCHEMA).parquet(aside)
    merged = cut_lineage(keyed.replace_by_key(ledger, outcomes.select(ledger.columns), "blob_name"))
    drop_scratch(spark, aside)
    return merged


def _publication_folder():
    """The folder of the file's publication: its path up to the month, the fourth folder below the root."""
    parts, below = F.split("path", "/"), F.size(F.split("blob_name", "/"))
    return F.array_join(F.slice(parts, F.lit(1), F.size(parts) - below + 4), "/")


def _rounds(folders: list, files: int) -> list[list[str]]:
    """Consecutive folders with about so many files together."""
    rounds, held = [], files
    for row in folders:
        if held >= files:
            rounds.append([])
            held = 0
        rounds[-1].append(row["_folder"])
        held += row["files"]
    return rounds


def _parse_round(
    spark: SparkSession, folders: list[str], batch: DataFrame, silver_root: str, parsed_at: str, columns: list[str], outcomes_path: str
) -> None:
    """Parse the batch's workbooks, which lie below the folders, into silver and append their outcomes."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[xX][lL][sS][xX]")
    content = reader.load(folders).join(broadcast_if_small(batch.select("path")), "path", "left_semi")
    aside = scratch_path(spark, "sheet-rows")
    workbooks.read_cells(content).write.parquet(aside)
    cells = spark.read.parquet(aside).join(batch.select("path", "blob_name", "report_type"), "path")
    # rows that were read before a file broke off do not count
    unreadable = cells.where("error is not null").select(F.col("blob_name").alias("file"), F.col("error").alias("_unreadable"))
    unreadable = broadcast_if_small(unreadable.dropDuplicates(["file"]), written=True)
    rows = cells.where("error is null").select(F.col("blob_name").alias("file"), "report_type", "row_idx", "cells")
    rows = rows.join(unreadable, "file", "left_anti")

    stamp = F.lit(parsed_at).cast("timestamp_ntz")
    facts = batch.drop("path")
    for tipo in V.REPORT_TYPES:
        parsed = sheets.attach_file_metadata(sheets.parse_sheets(rows, tipo), facts, stamp)
        silver.merge_silver(spark, silver_root, parsed)

    outcomes = facts.withColumnRenamed("blob_name", "file").join(
        sheets.file_outcomes(rows).drop("report_type"), "file", "left"
    ).join(unreadable, "file", "left")
    done = F.coalesce(F.col("status"), F.lit("failed"))
    outcomes = outcomes.withColumn("status", done).withColumns({
        "blob_name": F.col("file"),
        "error": F.when(done == "failed", F.coalesce("_unreadable", "error", F.lit("no known header"))),
        "parsed_at": stamp,
    }).withColumn("silver_blob_name", F.when(F.col("status") == "parsed", silver_object_path(silver_root)))
    outcomes.select(columns).write.mode("append").parquet(outcomes_path)
    drop_scratch(spark, aside)


def read_silver_by_type(spark: SparkSession, silver_root: str) -> dict[str, DataFrame]:
    """Silver per report type, with every column of the type present and typed."""
    table = silver.read_known_silver(spark, silver_root)
    return {t: table.where(F.col("report_type") == t) for t in V.REPORT_TYPES}


def run_gold(
    spark: SparkSession, silver_root: str, gold_root: str, states: DataFrame, months: DataFrame, full: bool = False
) -> list[tuple[str, int]]:
    """Build or refresh all sixteen gold relations under ``gold_root``; returns the warnings of the data checks.

    Unless ``full``, only publications with something new are rebuilt, and of the long fact and the views only the folders that
    they touch are rewritten.  What will change is written aside and checked first, so an error leaves every relation as it was.
    A key holds its state and period, so checking the changed partitions proves it unique.  A catalog that has not written
    the long fact lays it out anew from the wide facts.  What a run is about to rewrite is noted first, so a run that is broken off
    is made good by the next.
    """
    full = full or not path_exists(spark, f"{gold_root}/fato_medicao")
    staged = {t: STAGES[t](df) for t, df in read_silver_by_type(spark, silver_root).items()}
    aside = scratch_path(spark, "gold-next")
    dims = {
        name: build.export_table(build.define_mart(name, staged, states, months), f"{aside}/{name}")
        for name in ("dim_uf", "dim_data_referencia", "dim_insumo")
    }
    paths = {t: f"{gold_root}/{name}" for t, name in marts.FACT_NAME.items()}
    changed = {
        t: refresh.next_fact(spark, t, staged[t], months, path, f"{aside}/fact-{t}", full or not path_exists(spark, path))
        for t, path in paths.items()
    }
    quality.require({
        **dims, **{marts.FACT_NAME[t]: df for t, df in changed.items()}, "fato_medicao": marts.build_long_fact(changed)
    })

    pairs = None if full else refresh.unfinished(spark, gold_root)
    if pairs is not None:
        known = spark.catalog.tableExists(build.long_fact_table(gold_root))
        if known and _same_rows(spark.read.parquet(f"{gold_root}/dim_uf"), dims["dim_uf"]):
            pairs |= refresh.touched_pairs(changed) | refresh.relabelled_pairs(spark, gold_root, dims["dim_insumo"])
        else:
            pairs = None
    refresh.mark_unfinished(spark, gold_root, pairs)
    for t, path in paths.items():
        refresh.put_fact(t, changed[t], path, full or not path_exists(spark, path))
    tables = {name: build.export_table(df, f"{gold_root}/{name}") for name, df in dims.items()}
    facts = {t: refresh.fact_table(spark, t, path) for t, path in paths.items()}
    tables |= {marts.FACT_NAME[t]: df for t, df in facts.items()}
    if pairs is None or pairs:
        tables["fato_medicao"] = build.put_long_fact(spark, refresh.long_rows(facts, pairs), gold_root, first=pairs is None)
        refresh.refresh_views(spark, tables, gold_root, pairs)
    refresh.finish(spark, gold_root)
    drop_scratch(spark, aside)
    return quality.require({
        "vw_cobertura": spark.read.parquet(f"{gold_root}/vw_cobertura"),
        "vw_evolucao_preco": served.table(spark, "vw_evolucao_preco", f"{gold_root}/vw_evolucao_preco"),
    })


def _same_rows(one: DataFrame, two: DataFrame) -> bool:
    """Equal multisets of rows; for the small dimensions."""
    two = two.select(one.columns)
    return one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
