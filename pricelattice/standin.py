"""A silver-shaped price panel derived from the order tables used for testing.

Ten parts make one item; a supplier's nation is the state; the quarter of the ship
date is the publication.  The number of items grows with the data while a series keeps
its density, so every later job grows too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelattice import vocabulary as V
from pricelattice.session import broadcast_if_small

# Rows of two numbers that are broadcast, 16 MB at most; more are joined by shuffles.
SMALL_ROWS = 1 << 20
QUARTER_MONTHS = ["janeiro", "abril", "julho", "outubro"]
REPORT_NAMES = {
    V.MATERIAL: "Relatório Sintético de Materiais",
    V.EQUIPMENT: "Relatório Sintético de Equipamentos",
    V.LABOUR: "Relatório Sintético de Mão de Obra",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(column: Column, values: dict[int, str]) -> Column:
    chosen = F.lit(None).cast("string")
    for key, value in values.items():
        chosen = F.when(column == key, value).otherwise(chosen)
    return chosen


def state_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations in the shape of the state seed."""
    nation, region = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    return nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.lower("n_name").alias("state_slug"),
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("state_code"),
        F.initcap(F.translate("n_name", "_", " ")).alias("state_name"),
        F.lower("r_name").alias("region"),
    )


def silver_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All report types in one wide frame; a type's missing measures are null."""
    line, supplier = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "supplier")
    nation, region, part = (read_table(spark, sf_dir, t) for t in ("nation", "region", "part"))
    # nation and region are fixed lists (25 and 5 rows) at every scale
    places = (
        nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.lower("n_name").alias("state_slug"), F.lower("r_name").alias("region"))
    )
    # sent to the tasks as long as they are few: the lines then move once, for the cells
    suppliers = broadcast_if_small(supplier.select("s_suppkey", F.col("s_nationkey").alias("n_nationkey")), SMALL_ROWS)
    # now and then a state skips a publication and reports with the next one
    skipped = (F.col("n_nationkey") + 4 * F.year("l_shipdate") + F.quarter("l_shipdate")) % 29 == 0
    published = F.when(skipped, F.add_months("l_shipdate", 3)).otherwise(F.to_date("l_shipdate"))
    cells = (
        line.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumn("published", published)
        .withColumns({"item": F.expr("l_partkey div 10"), "y": F.year("published"), "q": F.quarter("published")})
        .groupBy(
            "item", "n_nationkey", "y", "q",
            ((F.col("item") % 3 != 0) & (F.col("l_returnflag") == "R")).alias("desonerado"),
            ((F.col("l_suppkey") + 4 * F.col("y") + F.col("q")) % 8 == 0).alias("revisado"),
        )
        .agg(
            F.min("l_extendedprice").alias("p"),
            F.min("l_quantity").alias("n"),
            F.min("l_discount").alias("d"),
            F.max("l_tax").alias("t"),
        )
    )
    sizes = part.groupBy(F.expr("p_partkey div 10").alias("item")).agg(F.max("p_size").alias("size"))
    sizes = broadcast_if_small(sizes, SMALL_ROWS)
    rows = cells.join(sizes, "item").join(F.broadcast(places), "n_nationkey").withColumns({
        "report_type": _choose(F.col("item") % 3, dict(enumerate(V.REPORT_TYPES))),
        "label": F.col("size") + F.col("y") % 3,
        "month": _choose(F.col("q"), {i + 1: m for i, m in enumerate(QUARTER_MONTHS)}),
    })

    def only(tipo: str, value: Column) -> Column:
        return F.when(F.col("report_type") == tipo, value)

    p, n, d, t = (F.col(c) for c in "pndt")
    year_text = F.col("y").cast("string")
    old_layout = F.col("y") < 2000
    has_value = d != 0  # a zero stands for the '-' placeholder
    flags = F.concat(
        F.when(F.col("desonerado"), " - com desoneração").otherwise(""),
        F.when(F.col("revisado"), " - revisado").otherwise(""),
    )
    archive = F.concat_ws("-", "state_slug", "month", year_text)
    file_name = F.concat(_choose(F.col("item") % 3, dict(enumerate(REPORT_NAMES.values()))), flags, F.lit(".xlsx"))
    return rows.select(
        F.concat(F.when((F.col("item") + F.col("q")) % 2 == 0, "C").otherwise("c"), F.col("item").cast("string")).alias("codigo"),
        F.concat(F.lit("item "), F.col("item").cast("string"), F.lit(" tam "), F.col("label").cast("string")).alias("descricao"),
        F.when((F.col("report_type") != V.EQUIPMENT) & (F.col("label") % 7 != 0), F.concat(F.lit("u"), (F.col("label") % 5).cast("string"))).alias("unidade"),
        only(V.MATERIAL, F.when(has_value, p)).alias("preco_unitario"),
        only(V.EQUIPMENT, p * 10.0).alias("valor_aquisicao"),
        only(V.EQUIPMENT, t * 1000.0).alias("depreciacao"),
        only(V.EQUIPMENT, n * 0.25).alias("oportunidade_capital"),
        only(V.EQUIPMENT, t * 100.0).alias("seguros_impostos"),
        only(V.EQUIPMENT, d * 500.0).alias("manutencao"),
        only(V.EQUIPMENT, n * 2.0).alias("operacao"),
        only(V.EQUIPMENT, F.when(has_value, d * 80.0)).alias("mao_de_obra_operacao"),
        only(V.EQUIPMENT, p).alias("custo_produtivo"),
        only(V.EQUIPMENT, p * 0.5).alias("custo_improdutivo"),
        only(V.LABOUR, F.when(old_layout & has_value, n)).alias("salario"),
        only(V.LABOUR, F.when(old_layout, t * 10.0)).alias("encargos_totais"),
        only(V.LABOUR, p).alias("custo"),
        only(V.LABOUR, F.when(old_layout, d * 10.0)).alias("periculosidade_insalubridade"),
        F.concat_ws("/", "region", "state_slug", year_text, "month", archive, file_name).alias("blob_name"),
        "region", "state_slug", year_text.alias("year"), "month", "report_type", "desonerado", "revisado",
        archive.alias("archive_stem"),
        # published 40 days into the quarter, a revision 45 days later, states an hour apart
        F.date_format(
            F.make_timestamp("y", F.col("q") * 3 - 2, F.lit(1), F.col("n_nationkey") % 24, F.lit(0), F.lit(0))
            + F.expr("make_dt_interval(if(revisado, 85, 40))"),
            "yyyy-MM-dd HH:mm:ss",
        ).alias("parsed_at"),
        # some items are listed three times inside one file, as in some sources
        F.explode(F.sequence(F.lit(1), F.when(F.col("item") % 13 == 0, 3).otherwise(1))).alias("_copy"),
    ).drop("_copy")


COMMON_COLUMNS = [
    "blob_name", "region", "state_slug", "year", "month", "report_type", "desonerado", "revisado",
    "archive_stem", "parsed_at",
]


def columns_of(tipo: str) -> list[str]:
    text = ["codigo", "descricao"] + ([] if tipo == V.EQUIPMENT else ["unidade"])
    return text + V.MEASURES[tipo] + COMMON_COLUMNS


def silver_by_type(panel: DataFrame) -> dict[str, DataFrame]:
    return {t: panel.where(F.col("report_type") == t).select(columns_of(t)) for t in V.REPORT_TYPES}


# ---- sheets as the publisher would send them ------------------------------------------


def sheet_rows(panel: DataFrame) -> DataFrame:
    """The panel turned back into sheets: banners, header, untidy cells, a footer.

    Sheets of one state in 1996 have a header nobody knows; some of 1997 hold a cell
    that is no number.
    """
    item = F.col("codigo").substr(F.lit(2), F.length("codigo")).cast("long")
    old_layout = F.col("year") < "2000"
    broken = (F.col("year") == "1997") & (item % 97 == 5)
    pad = F.array(F.lit(None).cast("string"), F.lit(None).cast("string"))

    def number(column: str) -> Column:
        return F.coalesce(F.col(column).cast("decimal(18,4)").cast("string"), F.lit(" - "))

    first = {V.MATERIAL: "preco_unitario", V.EQUIPMENT: "valor_aquisicao", V.LABOUR: "custo"}

    def body_cells(columns: list[str], broken_column: str) -> Column:
        text = {
            "codigo": F.concat(F.lit("  "), F.col("codigo"), F.lit("\t")),
            "descricao": F.upper(F.replace(F.col("descricao"), F.lit(" "), F.lit(" \u00a0\n"))),
            "unidade": F.col("unidade"),
        }
        return F.concat(F.array(*[
            text[c] if c in text else F.when(broken, F.lit("n/d")).otherwise(number(c)) if c == broken_column else number(c)
            for c in columns
        ]), pad)

    def by_layout(of: dict[tuple[str, int], Column]) -> Column:
        return F.coalesce(*[
            F.when((F.col("report_type") == tipo) & ((F.lit(n) == 1) == ~old_layout if tipo == V.LABOUR else F.lit(True)), value)
            for (tipo, n), value in of.items()
        ])

    layouts = {(t, n): layout for t, options in V.SHEET_LAYOUTS.items() for n, layout in enumerate(options)}
    body = panel.select(
        F.col("blob_name").alias("file"), "report_type", (item * 4 + 10).alias("row_idx"),
        by_layout({k: body_cells(columns, first[k[0]]) for k, (_, columns) in layouts.items()}).alias("cells"),
    )
    files = panel.select(F.col("blob_name").alias("file"), "report_type", "state_slug", "year", "month").distinct()
    unknown = (F.col("state_slug") == "nation_20") & (F.col("year") == "1996")
    header = by_layout({
        k: F.concat(F.array(
            F.when(unknown, "Cod.").otherwise(names[0]), *[F.lit(h.replace(" (R$", "\n (R$")) for h in names[1:]]
        ), pad)
        for k, (names, _) in layouts.items()
    })
    empty = F.lit(None).cast("string")
    banner = F.array(F.lit("Tabela"), F.lit("Preços de referência"), empty, empty)
    place = F.array(empty, F.concat("state_slug", F.lit(" - "), "month", F.lit("/"), "year"), empty, empty)
    footer = F.array(empty, F.lit("fim"), empty, empty)
    frame = files.select(
        "file", "report_type",
        F.inline(F.array(*[
            F.struct(F.lit(position).cast("long").alias("row_idx"), cells.alias("cells"))
            for position, cells in [(0, banner), (1, place), (2, header), (1 << 40, footer)]
        ])),
    )
    return body.unionByName(frame)


# ---- ledgers ----------------------------------------------------------------------------


def download_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of the download ledger; three orders share a url."""
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("timestamp_ntz")
    status = _status()
    return read_table(spark, sf_dir, "orders").select(
        key.alias("id"),
        F.concat(F.lit("r"), (F.col("o_custkey") % 5).cast("string")).alias("region"),
        F.concat(F.lit("s"), (F.col("o_custkey") % 27).cast("string")).alias("state_code"),
        F.year(day).cast("string").alias("year"),
        F.month(day).cast("string").alias("month"),
        (key % 5 == 0).alias("revisado"),
        F.concat(F.lit("https://prices.example/file/"), (key - key % 3).cast("string")).alias("url"),
        F.concat(F.lit("f"), key.cast("string"), F.lit(".zip")).alias("filename"),
        F.lit("zip").alias("extension"),
        F.when(F.col("o_custkey") % 3 != 0, day).alias("scraped_at"),
        F.when((status != "pending") & (key % 5 >= 2), day + F.expr("interval 1 day")).alias("downloaded_at"),
        status.alias("status"),
        F.when((status == "downloaded") & (key % 4 != 0), F.md5(key.cast("string"))).alias("file_hash"),
    )


def _status() -> Column:
    s = F.col("o_orderstatus")
    return F.when(s == "P", "pending").when(s == "F", "failed").otherwise("downloaded")


def parse_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of the parse ledger; three orders share a path."""
    key, s = F.col("o_orderkey"), F.col("o_orderstatus")
    parsed = s != "F"
    return read_table(spark, sf_dir, "orders").select(
        key.alias("seq"),
        F.concat(F.lit("raw/"), (key - key % 3).cast("string"), F.lit(".xlsx")).alias("blob_name"),
        F.element_at(F.array(*[F.lit(t) for t in V.REPORT_TYPES]), (F.col("o_custkey") % 3 + 1).cast("int")).alias("report_type"),
        F.when(parsed, F.col("o_custkey") % 100).alias("row_count"),
        F.when(parsed, "parsed").otherwise("failed").alias("status"),
        F.when(~parsed, F.concat(F.lit("no known header in "), key.cast("string"))).alias("error"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("parsed_at"),
    )


def link_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directed graph over customers: each order points from its customer to another.

    Targets range over as many ids as the table has, so the graph grows with the data.
    """
    orders = read_table(spark, sf_dir, "orders")
    ids = orders.agg((F.coalesce(F.max("o_custkey"), F.lit(0)) + 1).alias("n"))
    target = (F.col("o_custkey") * 7 + F.col("o_orderkey") % 11) % F.col("n")
    return orders.join(F.broadcast(ids)).select(F.col("o_custkey").alias("src"), target.alias("dst"))  # one row joined
