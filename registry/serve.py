"""Registered queries: shared operators, quality, incremental refresh, serving, formats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelattice import vocabulary as V
from pricelattice.functions import labels as L
from pricelattice.functions.numeric import relative_change
from pricelattice.operators import keyed, quality, revision
from pricelattice.plans import build, marts, refresh, serving, views
from pricelattice.session import scratch_path
from registry.lake import CUTOFF, Lake
from registry.queries import each_type, query

# parameters of the serving queries; present at every scale of the test tables
MATERIAL, EQUIPMENT, LABOUR = "c3", "c4", "c5"
STATE_NAME, STATE_SLUG = "Nation 20", "nation_20"
STATE_NAMES = ["Nation 3", "Nation 15", "Nation 20"]
_EQUIPMENT = {"tipo": V.EQUIPMENT, "codigo": EQUIPMENT}

# ---- operators the marts are made of ------------------------------------------------------


@query("regime_filter")
def _(k: Lake) -> DataFrame:
    keys = ["medicao_id", "valor"]
    fact = k.gold["fato_medicao"]
    relieved = fact.where("desonerado").select(*keys, F.lit("d").alias("regime"))
    return relieved.unionByName(fact.where("not desonerado").select(*keys, F.lit("n").alias("regime")))


@query("guarded_ratio")
def _(k: Lake) -> DataFrame:
    ratio = relative_change(F.col("depreciacao"), F.col("manutencao"))
    return k.gold["fato_custo_equipamento"].select("custo_equipamento_id", ratio.alias("ratio"))


@query("join_month_left")
def _(k: Lake) -> DataFrame:
    def dated(tipo: str) -> DataFrame:
        rows = k.staged[tipo].select("codigo", "blob_name", "year", "month")
        # every third item carries a month name nobody knows
        odd = F.when(F.length("codigo") % 3 == 0, F.concat(F.col("month"), F.lit("?"))).otherwise(F.col("month"))
        return marts.with_month_number(rows.withColumn("month", odd), k.months, "month")

    return each_type(dated).withColumn("period_start", F.make_date("year", "mes_numero", F.lit(1)))


@query("dedup_exact_rows")
def _(k: Lake) -> DataFrame:
    return each_type(lambda t: k.staged[t].distinct().select("codigo", "blob_name", F.col(V.HEADLINE_MEASURE[t]).alias("valor"), "parsed_at"))


@query("revisado_resolve")
def _(k: Lake) -> DataFrame:
    return each_type(lambda t: revision.resolve_revisions(k.staged[t], marts.PARTITION_KEYS[t]).select(
        "state_slug", "year", "month", "codigo", F.col(V.HEADLINE_MEASURE[t]).alias("valor"), "revisado", "blob_name"
    ))


@query("latest_period_filter")
def _(k: Lake) -> DataFrame:
    fact = k.gold["fato_medicao"].select("medida", "state_slug", "insumo_id", "desonerado", "period_start", "valor")
    return views.rows_at_latest(fact, ["medida", "state_slug"])


# ---- incremental refresh ----------------------------------------------------------------------


def _batch(k: Lake, tipo: str) -> DataFrame:
    return marts.build_fact(tipo, k.staged[tipo], k.months, target=k.old_fact(tipo))


def _facts(tipo: str, fact: DataFrame) -> DataFrame:
    value = F.col(V.HEADLINE_MEASURE[tipo]).alias("valor")
    return fact.select(F.col(marts.FACT_KEY[tipo]).alias("fato_id"), "period_start", value, "revisado", "parsed_at")


query("high_water_mark")(lambda k: each_type(lambda t: revision.high_water_mark(k.old_fact(t))))


@query("changed_partitions")
def _(k: Lake) -> DataFrame:
    mark = F.lit(CUTOFF).cast("timestamp_ntz")
    regime = lambda t: F.lit(None).cast("boolean") if t == V.MATERIAL else F.col("desonerado")
    return each_type(lambda t: revision.changed_partitions(k.staged[t], marts.PARTITION_KEYS[t], mark).select(
        "state_slug", "year", "month", regime(t).alias("desonerado")
    ))


query("incremental_batch")(lambda k: each_type(lambda t: _facts(t, _batch(k, t))))
query("delete_insert")(lambda k: each_type(lambda t: _facts(t, keyed.replace_by_key(k.old_fact(t), _batch(k, t), marts.FACT_KEY[t]))))


@query("partition_overwrite")
def _(k: Lake) -> DataFrame:
    """Old facts of every type on disk, then the batches' partitions written over them."""
    def overwritten(tipo: str) -> DataFrame:
        path = scratch_path(k.spark, "fact")
        for rows in [k.old_fact(tipo), _batch(k, tipo)]:
            keyed.overwrite_partitions(rows, path, refresh.partition_keys(tipo))
        return _facts(tipo, refresh.fact_table(k.spark, tipo, path))

    return each_type(overwritten)


# ---- quality ----------------------------------------------------------------------------------------

query("check_not_null")(lambda k: quality.null_values(k.gold["fato_preco_material"], "preco_unitario").select("preco_material_id"))
query("check_unique")(lambda k: quality.repeated_values(k.gold["fato_medicao"], "insumo_id"))
query("check_accepted_values")(
    lambda k: quality.unaccepted_values(k.gold["fato_custo_mao_de_obra"], "schema_version", [V.LAYOUT_OLD]).select("custo_mao_de_obra_id")
)
query("check_valor_positivo")(lambda k: quality.implausible_values(
    k.gold["fato_medicao"].withColumn("valor", F.when(F.col("valor") < 5000, F.lit(0.0)).otherwise(F.col("valor")))
).select("medicao_id", "medida", "valor"))
query("warn_cobertura")(lambda k: quality.coverage_gaps(k.view("vw_cobertura")))
query("warn_variacao")(lambda k: quality.suspicious_changes(k.view("vw_evolucao_preco")))


@query("quality_report")
def _(k: Lake) -> DataFrame:
    staged = {"stg_materiais": V.MATERIAL, "stg_equipamentos": V.EQUIPMENT, "stg_mao_de_obra": V.LABOUR}
    tables = {name: k.staged[t] for name, t in staged.items()}
    tables |= {**k.gold.all(), **{n: k.served(n) for n in ["vw_cobertura", "vw_evolucao_preco"]}}
    return quality.report(tables, quality.standard_checks(tables))


@query("catalog_relations")
def _(k: Lake) -> DataFrame:
    """All sixteen relations exported, registered by name and counted there."""
    root = scratch_path(k.spark, "catalog")
    build.export_gold(k.gold.all(), root)
    counts = [
        k.spark.table(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("relation"), "n")
        for name in build.register_catalog(k.spark, root)
    ]
    return reduce(DataFrame.unionByName, counts)


# ---- serving --------------------------------------------------------------------------------------------

query("serve_preco_atual")(lambda k: serving.current_prices(k.served("vw_preco_atual", tipo=V.EQUIPMENT, state_names=[STATE_NAME]), V.EQUIPMENT, state_name=STATE_NAME, desonerado=False))
query("serve_evolucao_uf")(lambda k: serving.series_in_state(
    k.served("vw_evolucao_preco", tipo=V.LABOUR, codigo=LABOUR, state_names=[STATE_NAME]), k.gold["dim_insumo"], V.LABOUR, STATE_NAME, LABOUR
))
query("serve_evolucao_media")(lambda k: serving.series_over_states(k.served("vw_evolucao_preco", **_EQUIPMENT), k.gold["dim_insumo"], V.EQUIPMENT, EQUIPMENT))
query("serve_kpis")(lambda k: serving.item_indicators(k.served("vw_preco_atual", **_EQUIPMENT), k.served("vw_evolucao_preco", **_EQUIPMENT), V.EQUIPMENT, EQUIPMENT, STATE_NAME))
query("serve_preco_por_estado")(lambda k: serving.price_by_state(k.served("vw_preco_atual", **_EQUIPMENT), V.EQUIPMENT, EQUIPMENT))
query("serve_regime")(lambda k: serving.regime_rows(k.served("vw_comparacao_regime", **_EQUIPMENT, state_names=STATE_NAMES), V.EQUIPMENT, EQUIPMENT, STATE_NAMES))
query("serve_regime_media")(lambda k: serving.regime_means(k.served("vw_comparacao_regime", **_EQUIPMENT), V.EQUIPMENT, EQUIPMENT))
query("serve_regime_tabela")(lambda k: serving.regime_table(k.served("vw_comparacao_regime", **_EQUIPMENT), V.EQUIPMENT, EQUIPMENT))
query("serve_comparacao_uf")(lambda k: serving.item_across_states(k.served("vw_comparacao_uf", **_EQUIPMENT), EQUIPMENT, "custo_produtivo"))
query("serve_indice")(lambda k: serving.index_series(k.served("vw_indice_reajuste", tipo=V.EQUIPMENT, state_names=STATE_NAMES), k.gold["dim_uf"], V.EQUIPMENT, STATE_NAMES))
query("serve_top20_regional")(lambda k: serving.top_movers(k.served("vw_evolucao_preco", tipo=V.EQUIPMENT), k.gold["dim_uf"], V.EQUIPMENT, region="africa", desonerado=False))
query("serve_top20_tabela")(lambda k: serving.movers_table(
    serving.top_movers(k.served("vw_evolucao_preco", tipo=V.MATERIAL), k.gold["dim_uf"], V.MATERIAL)
))
query("serve_detalhe_equip")(lambda k: serving.equipment_components(k.served("vw_breakdown_equipamento", codigo=EQUIPMENT, state_names=[STATE_NAME]), EQUIPMENT, STATE_SLUG))
query("serve_detalhe_equip_tabela")(lambda k: serving.equipment_table(k.served("vw_breakdown_equipamento", codigo=EQUIPMENT, state_names=[STATE_NAME]), EQUIPMENT, STATE_SLUG))
query("serve_detalhe_mao")(lambda k: serving.labour_components(k.served("vw_breakdown_mao_de_obra", codigo=LABOUR, state_names=[STATE_NAME]), LABOUR, STATE_SLUG))
query("serve_detalhe_mao_tabela")(lambda k: serving.labour_table(k.served("vw_breakdown_mao_de_obra", codigo=LABOUR, state_names=[STATE_NAME]), LABOUR, STATE_SLUG))
query("serve_cobertura")(lambda k: serving.coverage_table(k.view("vw_cobertura")))
query("serve_cobertura_resumo")(lambda k: serving.coverage_summary(k.view("vw_cobertura")))
query("serve_periodo_span")(lambda k: serving.publication_span(k.gold["dim_data_referencia"]))
query("list_ufs")(lambda k: serving.list_states(k.gold["dim_uf"]))
query("list_insumos")(lambda k: serving.list_items(k.gold["dim_insumo"]))
query("list_medidas")(lambda k: serving.list_measures(k.served("vw_evolucao_preco", **_EQUIPMENT), V.EQUIPMENT, EQUIPMENT))
query("list_periodos")(lambda k: serving.list_periods(k.served("vw_breakdown_equipamento", codigo=EQUIPMENT, state_names=[STATE_NAME]), EQUIPMENT, STATE_SLUG))


@query("serve_single_item_guard")
def _(k: Lake) -> DataFrame:
    """One code passes the guard, several do not: only the first part has rows."""
    view = k.view("vw_preco_atual")
    one = serving.single_item(view.where(F.col("codigo") == MATERIAL)).withColumn("filtro", F.lit("codigo"))
    many = serving.single_item(view.where(F.col("tipo") == V.MATERIAL)).withColumn("filtro", F.lit("tipo"))
    return one.unionByName(many).select("filtro", "codigo", "state_slug", "medida", "valor")


# ---- labels and formats -----------------------------------------------------------------------------------


@query("labels")
def _(k: Lake) -> DataFrame:
    return k.view("vw_comparacao_uf").select(
        "codigo", "state_slug", "period_start",
        L.type_label(F.col("tipo")).alias("tipo"),
        L.measure_label(F.col("medida")).alias("medida"),
        L.region_label(F.col("region")).alias("regiao"),
        L.yes_no(F.col("desonerado")).alias("sim_nao"),
        L.regime_label(F.col("desonerado")).alias("regime"),
    )


query("format_periodo")(lambda k: k.gold["fato_medicao"].select("medicao_id", L.format_period(F.col("period_start")).alias("rotulo")))
query("format_moeda")(lambda k: k.gold["fato_medicao"].select("medicao_id", L.format_money(F.col("valor")).alias("rotulo")))
query("format_faixa")(lambda k: k.gold["fato_custo_equipamento"].select(
    "custo_equipamento_id", L.format_money_range(F.col("custo_improdutivo"), F.col("custo_produtivo")).alias("rotulo")
))
query("format_variacao")(lambda k: k.view("vw_evolucao_preco").select(
    "codigo", "medida", "state_slug", "desonerado", "period_start",
    L.format_change(F.col("variacao_percentual")).alias("variacao"),
    L.format_difference(F.col("variacao_percentual")).alias("diferenca"),
))
