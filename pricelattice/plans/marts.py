"""The star schema: three dimensions, three wide facts, one long fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelattice import vocabulary as V
from pricelattice.functions.text import surrogate_key
from pricelattice.operators.reshape import unpivot_measures
from pricelattice.operators.revision import resolve_revisions, rows_of_changed_partitions

# A partition is what one publication replaces; materials have no tax regime.
PARTITION_KEYS = {
    V.MATERIAL: ["state_slug", "year", "month"],
    V.EQUIPMENT: ["state_slug", "year", "month", "desonerado"],
    V.LABOUR: ["state_slug", "year", "month", "desonerado"],
}
FACT_KEY = {
    V.MATERIAL: "preco_material_id",
    V.EQUIPMENT: "custo_equipamento_id",
    V.LABOUR: "custo_mao_de_obra_id",
}
FACT_NAME = {
    V.MATERIAL: "fato_preco_material",
    V.EQUIPMENT: "fato_custo_equipamento",
    V.LABOUR: "fato_custo_mao_de_obra",
}


def fact_schema(tipo: str) -> str:
    """Columns of a wide fact as a schema string."""
    regime = "" if tipo == V.MATERIAL else "desonerado boolean, "
    layout = "schema_version string, " if tipo == V.LABOUR else ""
    return (
        f"{FACT_KEY[tipo]} string, insumo_id string, state_slug string, period_start date, {regime}"
        + "".join(f"{m} double, " for m in V.MEASURES[tipo])
        + f"{layout}revisado boolean, blob_name string, parsed_at timestamp_ntz"
    )


# identity of a price series; a fact row adds the period
SERIES_KEYS = ["insumo_id", "state_slug", "desonerado", "medida"]


# ---- dimensions ----------------------------------------------------------------


def state_dimension(states: DataFrame) -> DataFrame:
    return states.select("state_slug", "state_code", "state_name", "region")


def with_month_number(df: DataFrame, months: DataFrame, month: str) -> DataFrame:
    """Left join to the twelve month names; an unknown name gives null, the row stays."""
    lookup = months.select(F.col("month_name").alias(month), F.col("month_number").alias("mes_numero"))
    return df.join(F.broadcast(lookup), month, "left")


def period_dimension(staged: dict[str, DataFrame], months: DataFrame) -> DataFrame:
    published = [df.select(F.col("year").alias("ano"), F.col("month").alias("mes")) for df in staged.values()]
    periods = reduce(DataFrame.union, published).distinct()
    return with_month_number(periods, months, "mes").select(
        F.make_date("ano", "mes_numero", F.lit(1)).alias("period_start"),
        "ano",
        "mes",
        "mes_numero",
        ((F.col("mes_numero") - 1) / 3 + 1).alias("trimestre"),
    )


def item_dimension(staged: dict[str, DataFrame]) -> DataFrame:
    """One row per (type, code) with the most recent label that is not null.

    The first aggregation keeps the newest sighting of each distinct label: its
    buffer is a plain timestamp, so it combines in the map tasks and a code that
    fills a third of the rows shrinks to a few label rows before the shuffle.
    """
    def sightings(tipo: str, df: DataFrame) -> DataFrame:
        unit = F.col("unidade") if "unidade" in df.columns else F.lit(None).cast("string")
        return df.select(F.lit(tipo).alias("tipo"), "codigo", "descricao", unit.alias("unidade"), "parsed_at")

    union = reduce(DataFrame.unionByName, [sightings(t, df) for t, df in staged.items()])
    labels = union.groupBy("tipo", "codigo", "descricao", "unidade").agg(F.max("parsed_at").alias("parsed_at"))

    def latest(label: str) -> Column:
        seen = F.when(F.col(label).isNotNull(), F.struct("parsed_at", label))
        return F.max(seen)[label].alias(label)

    return labels.groupBy("tipo", "codigo").agg(latest("descricao"), latest("unidade")).select(
        surrogate_key(F.col("tipo"), F.col("codigo")).alias("insumo_id"), "tipo", "codigo", "descricao", "unidade"
    )


# ---- wide facts ------------------------------------------------------------------


def build_fact(tipo: str, staged: DataFrame, months: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Rows of one wide fact.

    Without a target everything is built; with one, only the partitions that got
    something newer than the target's newest row.
    """
    keys = PARTITION_KEYS[tipo]
    # a row without a complete partition key belongs to no publication
    rows = staged.dropna(subset=keys)
    if target is not None:
        rows = rows_of_changed_partitions(rows, keys, target)
    # Filter before the distinct: the flag is part of the row, so the order does not
    # change the result, and the distinct shuffles only what stays.
    rows = resolve_revisions(rows, keys).distinct()
    rows = with_month_number(rows, months, "month")
    identity = [F.lit(tipo), F.col("codigo")]
    extra = {V.LABOUR: ["schema_version"]}.get(tipo, [])
    return rows.select(
        surrogate_key(*identity, *[F.col(k) for k in keys]).alias(FACT_KEY[tipo]),
        surrogate_key(*identity).alias("insumo_id"),
        "state_slug",
        F.make_date("year", "mes_numero", F.lit(1)).alias("period_start"),
        *([] if tipo == V.MATERIAL else ["desonerado"]),
        *V.MEASURES[tipo],
        *extra,
        "revisado",
        "blob_name",
        "parsed_at",
    )


# ---- long fact ---------------------------------------------------------------------


def build_long_fact(facts: dict[str, DataFrame]) -> DataFrame:
    """One row per item, state, period, regime and measure that has a value."""
    ids = ["fato_id", "insumo_id", "state_slug", "period_start", "desonerado", "revisado", "blob_name", "parsed_at"]

    def long(tipo: str, fact: DataFrame) -> DataFrame:
        regime = F.lit(False) if tipo == V.MATERIAL else F.col("desonerado")
        wide = fact.withColumns({"fato_id": F.col(FACT_KEY[tipo]), "desonerado": regime})
        return unpivot_measures(wide, ids, V.MEASURES[tipo])

    union = reduce(DataFrame.unionByName, [long(t, df) for t, df in facts.items()])
    return union.select(
        surrogate_key(F.col("fato_id"), F.col("medida")).alias("medicao_id"),
        "insumo_id",
        "state_slug",
        "period_start",
        "desonerado",
        "medida",
        "valor",
        "revisado",
        "blob_name",
        "parsed_at",
    )


def series_window() -> Window:
    """Rows of one series in time order.

    The fact's grain allows one row per series and period, so a window partition is
    never longer than the publication calendar.
    """
    return Window.partitionBy(*SERIES_KEYS).orderBy(F.col("period_start").asc_nulls_last())
