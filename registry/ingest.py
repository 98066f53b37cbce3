"""Registered queries of the ingestion side: files, links, ledgers, sheets, silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelattice import standin
from pricelattice import vocabulary as V
from pricelattice.functions.numeric import clean_number, is_bad_number
from pricelattice.functions.text import clean_text
from pricelattice.operators import graph, keyed
from pricelattice.plans import build
from pricelattice.sources import classify, links, sheets, silver
from pricelattice.session import cut_lineage, scratch_path
from registry.lake import Lake
from registry.queries import each_type, query

# ---- scans and sinks -----------------------------------------------------------------------


@query("scan_union_by_name")
def _(k: Lake) -> DataFrame:
    """All report types, labour in both layouts, as tables of their own columns in one folder, read as one table."""
    path = scratch_path(k.spark, "layouts")
    newer = F.col("year") >= "2000"
    for tipo, rows in k.silver.items():
        own = rows.select("codigo", "blob_name", "year", "report_type", *V.MEASURES[tipo])
        if tipo == V.LABOUR:
            own.where(newer).drop(*V.LABOUR_COMPONENTS).write.parquet(f"{path}/{tipo}-new")
            own = own.where(~newer)
        own.write.parquet(f"{path}/{tipo}")
    merged = k.spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(path)
    return merged.select("codigo", "blob_name", "year", "report_type", *sum(V.MEASURES.values(), []))


@query("sink_silver_partitioned")
def _(k: Lake) -> DataFrame:
    table = silver.read_silver(k.spark, k.silver_folders)
    return silver.retype_partition_columns(table).select("codigo", "blob_name", *silver.PARTITION_COLUMNS, *V.MEASURES[V.LABOUR])


@query("scan_hive_partitions")
def _(k: Lake) -> DataFrame:
    """Folder names alone: one row per partition with its number of rows."""
    table = silver.retype_partition_columns(silver.read_silver(k.spark, k.silver_folders))
    return table.groupBy(*silver.PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("n"))


@query("file_id_replace")
def _(k: Lake) -> DataFrame:
    """Revised files of every report type are parsed again with doubled prices and replace their rows."""
    def replaced(tipo: str) -> DataFrame:
        rows = k.silver[tipo].select("blob_name", "codigo", "revisado", F.col(V.HEADLINE_MEASURE[tipo]).alias("valor"))
        return silver.replace_files(rows, rows.where("revisado").withColumn("valor", F.col("valor") * 2))

    return each_type(replaced)


@query("gold_export_roundtrip")
def _(k: Lake) -> DataFrame:
    return build.export_table(k.view("vw_comparacao_uf"), scratch_path(k.spark, "export"))


@query("gold_export_clustered")
def _(k: Lake) -> DataFrame:
    path = scratch_path(k.spark, "clustered")
    cluster, order = ["tipo", "medida", "state_slug"], ["period_start", "codigo"]
    table = build.export_clustered(k.view("vw_evolucao_preco"), path, cluster, order)
    return table.where("tipo = 'equipamentos' and medida = 'custo_produtivo'")


@query("seed_month_lookup")
def _(k: Lake) -> DataFrame:
    from pricelattice.plans.marts import with_month_number

    used = k.panel.groupBy("month").agg(F.count(F.lit(1)).alias("n"))
    return with_month_number(used, k.months, "month")


@query("content_sha256")
def _(k: Lake) -> DataFrame:
    return k.table("documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


# ---- file classification ------------------------------------------------------------------------


def _paths(k: Lake) -> DataFrame:
    """Report paths of the panel next to paths that are no reports."""
    real = k.panel.select(F.col("blob_name").alias("path")).distinct()
    variants = F.array(
        F.col("path"),
        F.replace(F.col("path"), F.lit("Sintético"), F.lit("Analítico")),
        F.replace(F.col("path"), F.lit(".xlsx"), F.lit(".PDF")),
        F.replace(F.replace(F.col("path"), F.lit(".xlsx"), F.lit(".XLSX")), F.lit("ã"), F.lit("╞")),
        F.element_at(F.split("path", "/"), -1),
    )
    return real.select(F.explode(variants).alias("path"))


query("classify_files")(lambda k: classify.classify_files(_paths(k)))
query("classify_regime")(lambda k: _paths(k).select("path", classify.mentions_relief(F.col("path")).alias("desonerado")))
query("classify_revised")(lambda k: _paths(k).select("path", classify.mentions_revision(F.col("path")).alias("revisado")))


@query("raw_object_path")
def _(k: Lake) -> DataFrame:
    member = F.concat(F.col("archive_stem"), F.lit("/"), F.col("report_type"), F.lit(".xlsx"))
    path = classify.raw_object_path(*[F.col(c) for c in ["region", "state_slug", "year", "month"]], member)
    return k.panel.select("blob_name", path.alias("destination")).distinct()


@query("silver_object_path")
def _(k: Lake) -> DataFrame:
    found = classify.classify_files(_paths(k))
    return found.select("blob_name", classify.silver_object_path("silver/reports").alias("destination"))


# ---- links -------------------------------------------------------------------------------------------


def _links(k: Lake) -> DataFrame:
    return links.extract_links(k.table("pages"), ["page_id", "url"])


def _resolved(k: Lake) -> DataFrame:
    return links.resolve_links(_links(k), "url").select("page_id", "url", "link")


def _site(url):
    return F.regexp_extract(url, "^[a-z]+://[^/]+/", 0)


query("page_links")(lambda k: _links(k).select("page_id", "href"))
query("page_links_resolved")(lambda k: _resolved(k).select("page_id", "link"))
query("links_in_scope")(
    lambda k: links.in_scope(_resolved(k), _site(F.col("url")), ["/the", "nicht"]).select("page_id", "link")
)
query("links_distinct")(lambda k: links.distinct_links(_resolved(k), ["page_id"]))


@query("links_file_or_page")
def _(k: Lake) -> DataFrame:
    found = links.distinct_links(_resolved(k), ["page_id"])
    return found.withColumn("is_file", links.is_file(F.col("link")))


@query("url_metadata")
def _(k: Lake) -> DataFrame:
    return links.url_metadata(k.table("pages").select("page_id", F.col("url").alias("link")))


@query("link_reachability")
def _(k: Lake) -> DataFrame:
    seeds = k.table("region").select(F.col("r_regionkey").cast("long").alias("node"))
    return graph.reachable(standin.link_edges(k.spark, k.sf_dir), seeds)


# ---- ledgers -----------------------------------------------------------------------------------------


def _downloads(k: Lake) -> DataFrame:
    return standin.download_records(k.spark, k.sf_dir)


def _first_downloads(k: Lake) -> DataFrame:
    """An existing ledger: every second url, once."""
    return _downloads(k).where(F.col("id") % 6 == 0)


def _parses(k: Lake) -> DataFrame:
    return standin.parse_records(k.spark, k.sf_dir)


def _first_parses(k: Lake) -> DataFrame:
    return _parses(k).where(F.col("seq") % 6 == 0).drop("seq")


query("ledger_insert_ignore")(
    lambda k: keyed.insert_if_absent(_first_downloads(k), _downloads(k), "url", [F.col("id")])
)


@query("ledger_pending")
def _(k: Lake) -> DataFrame:
    waiting = _downloads(k).where(F.col("status").isin("pending", "failed"))
    return waiting.orderBy(F.col("scraped_at").asc_nulls_first(), "id").select(
        "id", "region", "state_code", "year", "month", "url", "filename", "extension"
    )


query("ledger_update_by_key")(
    lambda k: keyed.update_by_key(
        _first_downloads(k), _downloads(k).where(F.col("id") % 4 != 1), ["url"],
        ["status", "file_hash"], ["downloaded_at"], "id",
    )
)
query("ledger_update_composite")(
    lambda k: keyed.update_by_key(
        _downloads(k), _downloads(k).where("status = 'failed'"), ["state_code", "year", "month", "revisado"],
        ["status", "file_hash"], ["downloaded_at"], "id",
    )
)
query("ledger_latest")(
    lambda k: keyed.latest_per_key(
        _downloads(k), ["state_code", "year", "month", "revisado"], "downloaded_at", "id"
    ).select("state_code", "year", "month", "revisado", "status", "filename", "file_hash", "downloaded_at")
)
query("ledger_upsert")(
    lambda k: keyed.upsert(_first_parses(k), _parses(k).where(F.col("seq") % 2 == 1), ["blob_name"], "seq")
)
query("pending_files")(
    lambda k: keyed.pending(_parses(k).select("blob_name").distinct(), _first_parses(k), "blob_name")
)
query("failed_files")(lambda k: _parses(k).where("status = 'failed'").select("blob_name", "error"))

# ---- sheets ----------------------------------------------------------------------------------------------


def _sheets(k: Lake) -> DataFrame:
    return k.sheets


@query("sheet_header_norm")
def _(k: Lake) -> DataFrame:
    text = F.concat_ws("|", sheets.normalized_cells(F.col("cells")))
    return _sheets(k).select("file", "row_idx", text.alias("cells"))


query("sheet_header_find")(lambda k: sheets.find_headers(_sheets(k)))
query("sheet_unknown_layout")(lambda k: sheets.unknown_layouts(_sheets(k)))
query("sheet_rows")(
    lambda k: sheets.data_rows(_sheets(k)).select(
        "file", "row_idx", "layout", F.get("cells", F.lit(0)).alias("first"), F.get("cells", F.lit(3)).alias("fourth")
    )
)
query("clean_text")(lambda k: k.table("documents").select("doc_id", clean_text(F.col("text")).alias("text")))


@query("clean_numeric")
def _(k: Lake) -> DataFrame:
    cell = F.get("cells", F.lit(3))
    return _sheets(k).select(
        "file", "row_idx", clean_number(cell).alias("value"), is_bad_number(cell).alias("bad")
    )


def _measured(parsed: DataFrame, columns: list[str]) -> DataFrame:
    """Some columns and all measures of any report type; those of other types are null."""
    return parsed.select(*columns, *[
        F.col(m) if m in parsed.columns else F.lit(None).cast("double").alias(m) for m in sum(V.MEASURES.values(), [])
    ])


@query("reject_bad_files")
def _(k: Lake) -> DataFrame:
    return each_type(lambda t: _measured(sheets.parse_sheets(_sheets(k), t), ["file", "row_idx", "codigo", "descricao"]))


@query("silver_from_sheets")
def _(k: Lake) -> DataFrame:
    """The whole silver step for every report type: paths classified, sheets parsed, facts attached."""
    # the list of files is made once for all types
    files = cut_lineage(classify.classify_files(k.panel.select(F.col("blob_name").alias("path")).distinct()))
    stamp = F.lit("2002-01-01 00:00:00").cast("timestamp_ntz")
    facts = [
        "codigo", "descricao", "blob_name", "region", "state_slug", "year", "month", "archive_stem", "report_type", "desonerado",
        "revisado", "parsed_at",
    ]

    def parsed(tipo: str) -> DataFrame:
        rows = sheets.parse_sheets(_sheets(k), tipo)
        return _measured(sheets.attach_file_metadata(rows, files, stamp), facts)

    return each_type(parsed).drop("tipo")


@query("pending_limited")
def _(k: Lake) -> DataFrame:
    """The first hundred waiting files by path, the work of a limited run."""
    return keyed.first_pending(_parses(k).select("blob_name").distinct(), _first_parses(k), "blob_name", 100)


query("file_row_counts")(lambda k: sheets.parsed_row_counts(_sheets(k)))
query("file_outcomes")(lambda k: sheets.file_outcomes(_sheets(k)))
