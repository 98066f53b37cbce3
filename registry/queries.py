"""Registered queries: name -> function of (session, folder of input tables)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelattice import vocabulary as V
from pricelattice.plans import views
from registry.lake import Lake, lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    """Register a function of the lake."""

    def register(build: Callable[[Lake], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(lake(spark, sf_dir))
        return build

    return register


def each_type(of: Callable[[str], DataFrame]) -> DataFrame:
    """A part for every report type, named and put together."""
    return reduce(DataFrame.unionByName, [of(t).withColumn("tipo", F.lit(t)) for t in V.REPORT_TYPES])


# ---- staging, marts, views ------------------------------------------------------------

query("stg_materiais")(lambda k: k.staged[V.MATERIAL])
query("stg_equipamentos")(lambda k: k.staged[V.EQUIPMENT])
query("stg_mao_de_obra")(lambda k: k.staged[V.LABOUR])

for _name in [
    "dim_uf", "dim_data_referencia", "dim_insumo", "fato_preco_material", "fato_custo_equipamento",
    "fato_custo_mao_de_obra", "fato_medicao",
]:
    query(_name)(lambda k, name=_name: k.define_mart(name))

for _name in [
    "vw_preco_atual", "vw_evolucao_preco", "vw_comparacao_regime", "vw_comparacao_uf", "vw_indice_reajuste",
    "vw_maiores_variacoes", "vw_breakdown_equipamento", "vw_breakdown_mao_de_obra", "vw_cobertura",
]:
    query(_name)(lambda k, name=_name: k.view(name))

query("serie_base")(lambda k: views.series_base(k.gold["fato_medicao"]))
query("cobertura_esperada")(lambda k: views.expected_periods(views.published_periods(k.facts), k.gold["dim_uf"]))
query("cobertura_faltantes")(lambda k: views.missing_periods(views.published_periods(k.facts), k.gold["dim_uf"]))
