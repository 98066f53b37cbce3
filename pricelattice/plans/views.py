"""The nine analytical views over the star schema.

Each is a function of DataFrames.  A caller that wants one item, type or state narrows the
marts first (``narrowed``): the fact is then filtered by its own columns, below the windows
and at the scan; a filter on a view's labels alone would stop at the dimensions.  Joins to dimensions carry no hint; Spark
broadcasts a dimension whose size it knows to be small and shuffles otherwise.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelattice import vocabulary as V
from pricelattice.functions.numeric import relative_change
from pricelattice.functions.text import surrogate_key
from pricelattice.operators.median import exact_median
from pricelattice.operators.ranking import top_per_group
from pricelattice.plans.marts import FACT_NAME, SERIES_KEYS, series_window
from pricelattice.session import broadcast_if_small


def with_names(fact: DataFrame, items: DataFrame, states: DataFrame) -> DataFrame:
    """Inner joins: a fact of an unknown item or state is in no view."""
    return fact.join(items, "insumo_id").join(states, "state_slug")


# ---- long-fact views ------------------------------------------------------------------


def latest_price(long_fact: DataFrame, items: DataFrame, states: DataFrame) -> DataFrame:
    """Most recent value of every series."""
    newest = top_per_group(long_fact, SERIES_KEYS, [F.col("period_start").desc_nulls_last()], 1, rank=None)
    return with_names(newest, items, states).select(
        "tipo", "codigo", "descricao", "unidade", "medida", "valor", "desonerado",
        "state_slug", "state_code", "state_name", "region", "period_start",
    )


def series_changes(long_fact: DataFrame) -> DataFrame:
    """Every value of a series next to the previous one, with the change."""
    w = series_window()
    value, before = F.col("valor"), F.col("valor_anterior")
    return long_fact.select(
        *SERIES_KEYS, "period_start", "valor",
        F.lag("period_start").over(w).alias("period_start_anterior"),
        F.lag("valor").over(w).alias("valor_anterior"),
    ).withColumns({
        "variacao_absoluta": value - before,
        "variacao_percentual": relative_change(value, before),
    })


def price_evolution(long_fact: DataFrame, items: DataFrame, states: DataFrame) -> DataFrame:
    return with_names(series_changes(long_fact), items, states).select(
        "tipo", "codigo", "descricao", "medida", "state_slug", "state_name", "desonerado", "period_start",
        "valor", "period_start_anterior", "valor_anterior", "variacao_absoluta", "variacao_percentual",
    )


def regime_comparison(long_fact: DataFrame, items: DataFrame, states: DataFrame) -> DataFrame:
    """Both tax regimes of an item, state, period and measure side by side."""
    keys = ["insumo_id", "state_slug", "period_start", "medida"]
    # Material prices have one regime only; dropping their measures here keeps them
    # out of the pass.
    both = long_fact.where(~F.col("medida").isin(V.MATERIAL_MEASURES) & F.col("period_start").isNotNull())
    # one pass: the values of either regime of a key, normally one each; a key met more often gives all pairs
    sides = both.groupBy(*keys).agg(*[
        F.collect_list(F.when(F.col("desonerado") == relief, F.col("valor"))).alias(name)
        for relief, name in ((True, "valor_desonerado"), (False, "valor_nao_desonerado"))
    ])
    paired = sides.withColumn("valor_desonerado", F.explode("valor_desonerado"))
    paired = paired.withColumn("valor_nao_desonerado", F.explode("valor_nao_desonerado")).withColumns({
        "diferenca_absoluta": F.col("valor_desonerado") - F.col("valor_nao_desonerado"),
        "diferenca_percentual": relative_change(F.col("valor_desonerado"), F.col("valor_nao_desonerado")),
    })
    return with_names(paired, items, states).select(
        "tipo", "codigo", "descricao", "medida", "state_slug", "state_name", "period_start",
        "valor_desonerado", "valor_nao_desonerado", "diferenca_absoluta", "diferenca_percentual",
    )


def state_comparison(long_fact: DataFrame, items: DataFrame, states: DataFrame) -> DataFrame:
    return with_names(long_fact, items, states).select(
        "tipo", "codigo", "descricao", "medida", "desonerado",
        "state_slug", "state_code", "state_name", "region", "period_start", "valor",
    )


def with_series_base(long_fact: DataFrame) -> DataFrame:
    """Adds the first observed value of the row's series (null if it has no dated row)."""
    w = series_window()
    return long_fact.withColumn(
        "valor_base", F.when(F.first("period_start").over(w).isNotNull(), F.first("valor").over(w))
    )


def series_base(long_fact: DataFrame) -> DataFrame:
    """One row per series with its first observed value."""
    return long_fact.groupBy(*SERIES_KEYS).agg(F.min_by("valor", "period_start").alias("valor_base"))


def readjustment_index(long_fact: DataFrame, items: DataFrame) -> DataFrame:
    """Median of value / series base, times 100, per type, state, regime and period."""
    relative = (
        with_series_base(long_fact)
        .where(F.col("valor_base") != 0)
        .select("insumo_id", "state_slug", "desonerado", "period_start", (F.col("valor") / F.col("valor_base")).alias("r"))
        .join(items.select("insumo_id", "tipo"), "insumo_id")
    )
    index = exact_median(relative, ["tipo", "state_slug", "desonerado", "period_start"], "r", "mediana", "n_insumos")
    return index.select(
        "tipo", "state_slug", "desonerado", "period_start", (F.col("mediana") * 100).alias("indice"), "n_insumos"
    ).orderBy("tipo", "state_slug", "desonerado", F.col("period_start").asc_nulls_last())


def rows_at_latest(df: DataFrame, keys: list[str], period: str = "period_start") -> DataFrame:
    """Rows of each group's latest period (of the overall latest without keys).

    The maxima are aggregated on the map side and joined back, so a big group is not
    gathered in one task as a window would do.
    """
    if not keys:
        last = F.broadcast(df.agg(F.max(period).alias(period)))  # one row
    else:
        last = broadcast_if_small(df.groupBy(*keys).agg(F.max(period).alias(period)))
    return df.join(last, [*keys, period], "left_semi")


def latest_rows(df: DataFrame, period: str = "period_start") -> DataFrame:
    """Rows of the overall latest period, in one pass: each task hands on those of its own latest period only.

    For rows whose latest period is few rows, such as one item's; else :func:`rows_at_latest` keeps them spread.
    """
    rank = F.rank().over(Window.orderBy(F.col(period).desc()))
    return df.where(F.col(period).isNotNull()).withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def top_changes_at_latest(evolution: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Each group's n biggest relative changes among the rows of its latest period.

    Ordering by period first puts the latest period on top, so one bounded ranking
    does the work of a group maximum, a join back and a ranking; only the n rows kept
    per group are then checked against the group's latest period.
    """
    order = [
        F.col("period_start").desc_nulls_last(), F.abs("variacao_percentual").desc(),
        F.col("codigo"), F.col("medida"), F.col("desonerado"),
    ]
    changed = evolution.where(F.col("variacao_percentual").isNotNull())
    top = top_per_group(changed, keys, order, n, rank="posicao")
    last = F.max("period_start").over(Window.partitionBy(*keys))
    return top.withColumn("_last", last).where(F.col("period_start") == F.col("_last")).drop("_last")


def biggest_changes(evolution: DataFrame, n: int = 20) -> DataFrame:
    """The n biggest relative changes per type and state at that pair's latest period."""
    return top_changes_at_latest(evolution, ["tipo", "state_slug"], n).orderBy("tipo", "state_slug", "posicao")


# ---- wide-fact views --------------------------------------------------------------------


def equipment_breakdown(fact: DataFrame, items: DataFrame, states: DataFrame) -> DataFrame:
    return with_names(fact, items, states).select(
        "codigo", "descricao", "state_slug", "state_name", "region", "period_start", "desonerado",
        *V.EQUIPMENT_MEASURES,
    )


def labour_breakdown(fact: DataFrame, items: DataFrame, states: DataFrame) -> DataFrame:
    return with_names(fact, items, states).select(
        "codigo", "descricao", "unidade", "state_slug", "state_name", "region", "period_start", "desonerado",
        *V.LABOUR_COMPONENTS, "custo", "schema_version",
    )


# ---- coverage ------------------------------------------------------------------------------


def published_rows(facts: dict[str, DataFrame]) -> DataFrame:
    """(type, state, period) of every fact row."""
    lists = [df.select(F.lit(tipo).alias("tipo"), "state_slug", "period_start") for tipo, df in facts.items()]
    return reduce(DataFrame.unionByName, lists)


def published_periods(facts: dict[str, DataFrame]) -> DataFrame:
    """Distinct (type, state, period) with at least one fact row."""
    return published_rows(facts).distinct()


def period_bitmaps(published: DataFrame) -> DataFrame:
    """The periods of each type and state as bitmaps over day numbers: (tipo, state_slug, bucket, own, undated, last).

    ``published`` may repeat a period any number of times.  A bitmap of 4 KB is built in the map tasks and combined, so neither
    the rows nor the distinct periods are shuffled; bitmaps of several tables or runs combine by ``bitmap_or_agg``.
    """
    # counted from the year one, so that every date has a number above zero
    day = F.unix_date("period_start") + F.lit(719_163)
    return published.groupBy("tipo", "state_slug", F.bitmap_bucket_number(day).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(day)).alias("own"),
        F.bool_or(F.col("period_start").isNull()).alias("undated"), F.max("period_start").alias("last"),
    )


def _calendar(periods: DataFrame):
    """All published (type, period) as one array value, bounded by the types and the calendar."""
    return periods.select(F.struct("tipo", "period_start").alias("p")).distinct().agg(F.collect_list("p").alias("p")).scalar()


def expected_periods(periods: DataFrame, states: DataFrame) -> DataFrame:
    """Every period some state published, for every state of the dimension."""
    return states.select("state_slug", F.explode(_calendar(periods)).alias("p")).select("p.tipo", "state_slug", "p.period_start")


def missing_periods(periods: DataFrame, states: DataFrame) -> DataFrame:
    """Expected periods a state did not publish: the calendar less the state's own periods.

    An undated period is expected of everyone and matched by nobody.
    """
    own = periods.where(F.col("period_start").isNotNull()).groupBy("state_slug").agg(
        F.collect_set(F.struct("tipo", "period_start")).alias("own")
    )
    missing = F.when(F.col("own").isNull(), _calendar(periods)).otherwise(F.array_except(_calendar(periods), F.col("own")))
    return states.select("state_slug").join(own, "state_slug", "left").select("state_slug", F.explode(missing).alias("p")).select(
        "p.tipo", "state_slug", "p.period_start"
    )


def coverage(published: DataFrame, states: DataFrame) -> DataFrame:
    """Latest period, number of periods and number of gaps per published type and state.

    A state's gaps are the type's expected periods less the state's own, so counts of bits are
    enough and neither distinct periods nor the grid of missing ones are built.
    """
    bitmaps = period_bitmaps(published)
    per_state = bitmaps.groupBy("tipo", "state_slug").agg(
        F.max("last").alias("ultimo_periodo_disponivel"),
        F.sum(F.when(F.col("bucket").isNull(), 0).otherwise(F.bitmap_count("own"))).alias("periodos_disponiveis"),
    )
    # an undated period is expected of everyone and matched by nobody
    expected = bitmaps.groupBy("tipo", "bucket").agg(F.bitmap_or_agg("own").alias("all"), F.bool_or("undated").alias("undated")).groupBy("tipo").agg(
        F.sum(F.when(F.col("bucket").isNull(), F.col("undated").cast("long")).otherwise(F.bitmap_count("all"))).alias("_expected")
    )
    return per_state.join(expected, "tipo").join(states, "state_slug").select(
        "tipo", "state_slug", "state_code", "state_name", "ultimo_periodo_disponivel", "periodos_disponiveis",
        (F.col("_expected") - F.col("periodos_disponiveis")).alias("periodos_faltantes_vs_pares"),
    ).orderBy("tipo", "state_slug")


def narrowed(
    marts: Mapping[str, DataFrame], tipo: str | None = None, codigo: str | None = None, state_names: list[str] | None = None
) -> Mapping[str, DataFrame]:
    """The marts with the long fact cut to a type, an item and states by the fact's own columns.

    An item's key is a hash of type and code, so it is a literal here; the few state names are looked up
    in the dimension.  All three are part of the series key, so windows over series see whole series.
    """
    fact = marts["fato_medicao"]
    if tipo is not None:
        fact = fact.where(F.col("medida").isin(V.MEASURES[tipo]))
    if tipo is not None and codigo is not None:
        fact = fact.where(F.col("insumo_id") == surrogate_key(F.lit(tipo), F.lit(codigo)))
    if state_names:
        found = marts["dim_uf"].where(F.col("state_name").isin(list(state_names))).select("state_slug").collect()
        fact = fact.where(F.col("state_slug").isin([r.state_slug for r in found]))
    return ChainMap({"fato_medicao": fact}, marts)


def view(name: str, marts: Mapping[str, DataFrame]) -> DataFrame:
    """One of the nine views by name, from the mart tables by name."""
    items, states = marts["dim_insumo"], marts["dim_uf"]

    def evolution() -> DataFrame:
        return price_evolution(marts["fato_medicao"], items, states)

    def facts() -> dict[str, DataFrame]:
        return {t: marts[n] for t, n in FACT_NAME.items()}

    builders = {
        "vw_preco_atual": lambda: latest_price(marts["fato_medicao"], items, states),
        "vw_evolucao_preco": evolution,
        "vw_comparacao_regime": lambda: regime_comparison(marts["fato_medicao"], items, states),
        "vw_comparacao_uf": lambda: state_comparison(marts["fato_medicao"], items, states),
        "vw_indice_reajuste": lambda: readjustment_index(marts["fato_medicao"], items),
        "vw_maiores_variacoes": lambda: biggest_changes(evolution()),
        "vw_breakdown_equipamento": lambda: equipment_breakdown(marts[FACT_NAME[V.EQUIPMENT]], items, states),
        "vw_breakdown_mao_de_obra": lambda: labour_breakdown(marts[FACT_NAME[V.LABOUR]], items, states),
        "vw_cobertura": lambda: coverage(published_rows(facts()), states),
    }
    return builders[name]()
