"""Parameterised questions a price dashboard asks of the views.

A parameter left ``None`` does not filter.  The views are best built from marts narrowed to the same
item, type and states (``views.narrowed``), so that only their rows are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelattice import vocabulary as V
from pricelattice.functions import labels as L
from pricelattice.functions.numeric import pct_change, stable_mean
from pricelattice.operators.ranking import top_overall
from pricelattice.plans.views import latest_rows, top_changes_at_latest


def matching(df: DataFrame, **wanted) -> DataFrame:
    """Equality, or membership for a list, on each parameter that is given."""
    for column, value in wanted.items():
        if isinstance(value, (list, tuple, set)):
            if value:
                df = df.where(F.col(column).isin(list(value)))
        elif isinstance(value, bool):
            df = df.where(F.col(column) if value else ~F.col(column))
        elif value is not None:
            df = df.where(F.col(column) == value)
    return df


def single_item(df: DataFrame, codigo: str | None = None) -> DataFrame:
    """The rows if they are all of one code, else none.

    Rows that were asked for by a code are of one.  Else two extreme values tell one code from several without a distinct count.
    """
    if codigo is not None:
        return df
    span = df.agg(F.min("codigo").alias("_first"), F.max("codigo").alias("_last"))
    only = span.where(F.col("_first") == F.col("_last")).select(F.col("_first").alias("codigo"))
    return df.join(F.broadcast(only), "codigo", "left_semi")  # at most one row


# ---- prices ----------------------------------------------------------------------------


def current_prices(view: DataFrame, tipo: str, codigo=None, state_name=None, desonerado=None) -> DataFrame:
    found = matching(view, tipo=tipo, codigo=codigo, state_name=state_name, desonerado=desonerado)
    return found.orderBy("descricao", "state_name", "medida")


def series_in_state(evolution: DataFrame, items: DataFrame, tipo: str, state_name: str, codigo=None, desonerado=None) -> DataFrame:
    found = matching(evolution, tipo=tipo, state_name=state_name, codigo=codigo, desonerado=desonerado)
    units = matching(items, tipo=tipo, codigo=codigo).select("tipo", "codigo", "unidade")
    return single_item(found.join(units, ["tipo", "codigo"]), codigo).select(
        "tipo", "codigo", "descricao", "medida", "state_name", "desonerado", "period_start", "valor",
        "variacao_percentual", "unidade",
    ).orderBy("medida", "desonerado", F.col("period_start").asc_nulls_last())


def series_over_states(evolution: DataFrame, items: DataFrame, tipo: str, codigo=None, desonerado=None) -> DataFrame:
    """Mean over all states per period, with the change from period to period."""
    found = single_item(matching(evolution, tipo=tipo, codigo=codigo, desonerado=desonerado), codigo)
    units = matching(items, tipo=tipo, codigo=codigo).select("tipo", "codigo", "unidade")
    keys = ["tipo", "codigo", "descricao", "medida", "desonerado", "period_start"]
    means = found.groupBy(*keys).agg(stable_mean(F.col("valor")).alias("valor")).join(units, ["tipo", "codigo"])
    series = Window.partitionBy("codigo", "medida", "desonerado").orderBy(F.col("period_start").asc_nulls_last())
    return means.select(
        *keys, "valor", "unidade", F.lit(V.ALL_STATES).alias("state_name"),
        pct_change(F.col("valor"), F.lag("valor").over(series)).alias("variacao_percentual"),
    ).orderBy("medida", "desonerado", F.col("period_start").asc_nulls_last())


def unit_suffix(unit: Column) -> Column:
    return F.when(F.coalesce(unit, F.lit("")) != "", F.concat(F.lit(" / "), unit)).otherwise("")


def item_indicators(view: DataFrame, evolution: DataFrame, tipo: str, codigo: str, state_name=None, desonerado=None) -> DataFrame:
    """One row of headline figures for an item; with a state also its price and last change."""
    rows = single_item(current_prices(view, tipo, codigo, None, desonerado), codigo)
    headline = F.col("medida") == V.HEADLINE_MEASURE[tipo]
    main = F.when(headline, F.col("valor"))
    here = F.lit(False) if state_name is None else headline & (F.col("state_name") == state_name)

    def state_of(pick: Column) -> Column:
        return pick["state_name"]

    facts = rows.groupBy("codigo", "descricao", "unidade").agg(
        stable_mean(main).alias("preco_medio"),
        F.min(main).alias("menor_preco"),
        state_of(F.min(F.when(headline, F.struct("valor", "state_name")))).alias("menor_preco_uf"),
        F.max(main).alias("maior_preco"),
        # the first state name wins among equal prices, as for the lowest price
        F.min_by(F.when(headline, F.col("state_name")), F.when(headline, F.struct(-F.col("valor"), "state_name"))).alias("maior_preco_uf"),
        F.coalesce(F.max(F.when(headline, F.col("period_start"))), F.max("period_start")).alias("publicacao"),
        F.min(F.when(here, F.col("valor"))).alias("preco_uf_min"),
        F.max(F.when(here, F.col("valor"))).alias("preco_uf_max"),
    )
    low, high = F.col("preco_uf_min"), F.col("preco_uf_max")
    price_here = F.when(low == high, L.format_money(low)).when(low.isNotNull(), L.format_money_range(low, high))
    facts = facts.withColumns({
        "publicacao_rotulo": L.format_period(F.col("publicacao")),
        "preco_atual": F.coalesce(F.concat(price_here, unit_suffix(F.col("unidade"))), F.lit(V.MISSING_CHANGE)),
    })
    if state_name is None:
        return facts.withColumn("variacao", F.lit(V.MISSING_CHANGE))
    series = matching(
        evolution, tipo=tipo, codigo=codigo, state_name=state_name, desonerado=desonerado,
        medida=V.HEADLINE_MEASURE[tipo],
    )
    # the last row of the series; the relieved regime is listed after the normal one
    last = series.groupBy("codigo").agg(
        F.max_by("variacao_percentual", F.struct("period_start", "desonerado")).alias("_change")
    )
    return facts.join(last, "codigo", "left").withColumn("variacao", L.format_change(F.col("_change"))).drop("_change")


def price_by_state(view: DataFrame, tipo: str, codigo=None, desonerado=None) -> DataFrame:
    """Headline price of one item in every state, labelled by regime."""
    rows = single_item(current_prices(view, tipo, codigo, None, desonerado), codigo)
    return rows.where(F.col("medida") == V.HEADLINE_MEASURE[tipo]).select(
        "codigo", "state_name", "desonerado", L.regime_label(F.col("desonerado")).alias("regime"), "valor",
        L.format_money(F.col("valor")).alias("valor_rotulo"), "unidade",
    ).orderBy("state_name", "regime")


# ---- regimes --------------------------------------------------------------------------


def regime_rows(comparison: DataFrame, tipo: str, codigo=None, state_names=None) -> DataFrame:
    found = single_item(matching(comparison, tipo=tipo, codigo=codigo, state_name=state_names), codigo)
    return found.select(
        "codigo", "medida", "state_name", "period_start", "valor_desonerado", "valor_nao_desonerado",
        "diferenca_percentual",
    ).orderBy("medida", F.col("period_start").asc_nulls_last())


def regime_means(comparison: DataFrame, tipo: str, codigo=None, state_names=None, measures=None) -> DataFrame:
    """Mean per measure and regime at the latest period, one row per regime."""
    rows = matching(regime_rows(comparison, tipo, codigo, state_names), medida=measures)
    means = latest_rows(rows).groupBy("medida").agg(
        stable_mean(F.col("valor_nao_desonerado")).alias("valor_nao_desonerado"),
        stable_mean(F.col("valor_desonerado")).alias("valor_desonerado"),
    )
    long = means.unpivot(["medida"], ["valor_nao_desonerado", "valor_desonerado"], "regime", "valor_medio")
    return long.select(
        L.measure_label(F.col("medida")).alias("medida"),
        L.regime_label(F.col("regime") == "valor_desonerado").alias("regime"),
        "valor_medio",
        L.format_money(F.col("valor_medio")).alias("rotulo"),
    )


def regime_table(comparison: DataFrame, tipo: str, codigo=None, state_names=None, measures=None) -> DataFrame:
    """The latest period's rows of both regimes, formatted for display."""
    rows = matching(regime_rows(comparison, tipo, codigo, state_names), medida=measures)
    return latest_rows(rows).select(
        L.measure_label(F.col("medida")).alias("Medida"),
        F.col("state_name").alias("UF"),
        L.format_money(F.col("valor_nao_desonerado")).alias("Não Desonerado"),
        L.format_money(F.col("valor_desonerado")).alias("Desonerado"),
        L.format_difference(F.col("diferenca_percentual")).alias("Diferença"),
    )


# ---- states and index --------------------------------------------------------------------


def item_across_states(comparison: DataFrame, codigo: str, medida: str) -> DataFrame:
    """One item in every state at the item's overall latest period, dearest first."""
    rows = matching(comparison, codigo=codigo, medida=medida).select(
        "medida", "desonerado", "state_name", "region", "period_start", "valor"
    )
    return latest_rows(rows).withColumns({
        "region": L.region_label(F.col("region")),
        "desonerado_rotulo": L.yes_no(F.col("desonerado")),
        "rotulo": L.format_money(F.col("valor")),
    }).orderBy(F.col("valor").desc(), "state_name", "desonerado")


def index_series(index: DataFrame, states: DataFrame, tipo: str, state_names=None) -> DataFrame:
    wanted = index.where(F.col("tipo") == tipo).drop("tipo")
    named = matching(states, state_name=state_names).select("state_slug", "state_name")
    return wanted.join(named, "state_slug", "inner" if state_names else "left").withColumns({
        "serie": F.concat("state_name", L.series_suffix(F.col("desonerado"))),
        "publicacao": L.format_period(F.col("period_start")),
        "indice_rotulo": L.format_decimal(F.col("indice")),
    })


def top_movers(evolution: DataFrame, states: DataFrame, tipo: str, state_name=None, region=None, desonerado=None, n: int = 20) -> DataFrame:
    """The n biggest changes of the headline measure over the chosen states.

    Each state contributes rows of its own latest period; no state can place more than
    n of them, so the bounded ranking per state comes first.
    """
    area = matching(states, state_name=state_name) if state_name else matching(states, region=region)
    found = matching(evolution, tipo=tipo, medida=V.HEADLINE_MEASURE[tipo], desonerado=desonerado)
    found = found.join(area.select("state_slug"), "state_slug", "left_semi")
    per_state = top_changes_at_latest(found, ["state_slug"], n).drop("posicao")
    order = [F.abs("variacao_percentual").desc(), F.col("codigo"), F.col("state_name"), F.col("desonerado")]
    return top_overall(per_state, order, n, "posicao").select(
        "codigo", "descricao", "medida", "state_name", "period_start", "valor", "valor_anterior",
        "variacao_percentual", "posicao",
    )


def movers_table(movers: DataFrame) -> DataFrame:
    """Top movers with display labels."""
    return movers.select(
        F.col("codigo").alias("Código"),
        F.col("descricao").alias("Descrição"),
        L.measure_label(F.col("medida")).alias("Medida"),
        F.col("state_name").alias("UF"),
        L.format_period(F.col("period_start")).alias("Publicação"),
        L.format_money(F.col("valor_anterior")).alias("Valor Anterior"),
        L.format_money(F.col("valor")).alias("Valor Atual"),
        L.format_change(F.col("variacao_percentual")).alias("Variação"),
    )


# ---- breakdowns -----------------------------------------------------------------------------


def _components(rows: DataFrame, ids: list[str], components: list[str]) -> DataFrame:
    long = rows.unpivot(ids, components, "componente", "valor")
    return long.withColumns({
        "componente": L.measure_label(F.col("componente")),
        "rotulo": L.format_money(F.col("valor")),
    })


def equipment_components(breakdown: DataFrame, codigo: str, state_slug: str, period=None) -> DataFrame:
    """Cost components of one equipment item in one state, a row per component."""
    rows = matching(breakdown, codigo=codigo, state_slug=state_slug, period_start=period)
    ids = ["codigo", "state_slug", "period_start", "desonerado", "custo_produtivo", "custo_improdutivo"]
    return _components(rows, ids, V.EQUIPMENT_COMPONENTS)


def labour_components(breakdown: DataFrame, codigo: str, state_slug: str, period=None) -> DataFrame:
    """Cost components of one labour item; only the older layout has any."""
    rows = matching(breakdown, codigo=codigo, state_slug=state_slug, period_start=period)
    rows = rows.where(F.col("schema_version") == V.LAYOUT_OLD)
    return _components(rows, ["codigo", "state_slug", "period_start", "desonerado", "custo"], V.LABOUR_COMPONENTS)


def equipment_table(breakdown: DataFrame, codigo: str, state_slug: str) -> DataFrame:
    """Every period of an equipment item in a state, formatted and labelled for display."""
    rows = matching(breakdown, codigo=codigo, state_slug=state_slug)
    return rows.select(
        F.col("codigo").alias("Código"), F.col("descricao").alias("Descrição"), F.col("state_name").alias("UF"),
        L.region_label(F.col("region")).alias("Região"),
        L.format_period(F.col("period_start")).alias("Publicação"),
        L.yes_no(F.col("desonerado")).alias("Desonerado"),
        *[L.format_money(F.col(m)).alias(V.MEASURE_LABELS[m]) for m in V.EQUIPMENT_MEASURES],
    )


def labour_table(breakdown: DataFrame, codigo: str, state_slug: str) -> DataFrame:
    """Every period of a labour item in a state; missing figures show as a dash."""
    rows = matching(breakdown, codigo=codigo, state_slug=state_slug)
    dash = F.lit(V.MISSING_CHANGE)
    named = {**{m: V.MEASURE_LABELS[m] for m in V.LABOUR_COMPONENTS}, "custo": "Custo Final"}
    return rows.select(
        F.col("codigo").alias("Código"), F.col("descricao").alias("Descrição"),
        F.coalesce("unidade", dash).alias("Unidade"), F.col("state_name").alias("UF"),
        L.region_label(F.col("region")).alias("Região"),
        L.format_period(F.col("period_start")).alias("Publicação"),
        L.yes_no(F.col("desonerado")).alias("Desonerado"),
        *[F.coalesce(L.format_money(F.col(m)), dash).alias(name) for m, name in named.items()],
        L.layout_label(F.col("schema_version")).alias("Layout"),
    )


# ---- coverage and lists ------------------------------------------------------------------------


def coverage_table(coverage: DataFrame) -> DataFrame:
    return coverage.select(
        "tipo", "state_name", "ultimo_periodo_disponivel", "periodos_disponiveis", "periodos_faltantes_vs_pares"
    ).orderBy(F.col("periodos_faltantes_vs_pares").desc(), "tipo", "state_name")


def coverage_summary(coverage: DataFrame) -> DataFrame:
    return coverage.agg(
        F.count_if(F.col("periodos_faltantes_vs_pares") > 0).alias("com_lacuna"),
        F.count(F.lit(1)).alias("combinacoes"),
    )


def publication_span(periods: DataFrame) -> DataFrame:
    span = periods.agg(F.min("period_start").alias("inicio"), F.max("period_start").alias("fim"))
    return span.withColumns({
        "inicio_rotulo": L.format_period(F.col("inicio")), "fim_rotulo": L.format_period(F.col("fim")),
    })


def list_states(states: DataFrame) -> DataFrame:
    return states.select("state_slug", "state_code", "state_name", "region").orderBy("state_name")


def list_items(items: DataFrame, tipo: str | None = None) -> DataFrame:
    return matching(items, tipo=tipo).select("codigo", "descricao").orderBy("descricao", "codigo")


def list_measures(view: DataFrame, tipo: str, codigo=None) -> DataFrame:
    found = matching(view, tipo=tipo, codigo=codigo).select("medida").distinct()
    return found.withColumn("rotulo", L.measure_label(F.col("medida"))).orderBy("medida")


def list_periods(breakdown: DataFrame, codigo: str, state_slug: str) -> DataFrame:
    found = matching(breakdown, codigo=codigo, state_slug=state_slug).select("period_start").distinct()
    return found.withColumn("rotulo", L.format_period(F.col("period_start"))).orderBy(F.col("period_start").desc_nulls_last())
