"""Gold build: write the marts, register them, export tables."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from pricelattice import vocabulary as V
from pricelattice.plans import marts, served
from pricelattice.plans.staging import STAGES
from pricelattice.plans.views import biggest_changes, view
from pricelattice.session import shuffle_partitions, unsorted_folders

# Names of the gold relations.
VIEW_NAMES = [
    "vw_preco_atual", "vw_evolucao_preco", "vw_comparacao_regime", "vw_comparacao_uf", "vw_indice_reajuste",
    "vw_maiores_variacoes", "vw_breakdown_equipamento", "vw_breakdown_mao_de_obra", "vw_cobertura",
]
MART_NAMES = [
    "dim_uf", "dim_data_referencia", "dim_insumo", "fato_preco_material", "fato_custo_equipamento",
    "fato_custo_mao_de_obra", "fato_medicao",
]
# The long fact is laid out by these, a subset of every series key: windows and
# groupings over a series then need no shuffle.  The wide facts have them, too, so
# their rows are dealt out before a row per measure is made of them.
BUCKET_KEYS = ["insumo_id", "state_slug"]
# In folders by type and state the state is no bucket key; rows of a bucket are in order of the item.
FOLDER_KEYS, FOLDER_BUCKET_KEYS = ["tipo", "state_slug"], ["insumo_id", "medida"]
LONG_COLUMNS = [
    "medicao_id", "insumo_id", "state_slug", "period_start", "desonerado", "medida", "valor", "revisado", "blob_name", "parsed_at",
]


def define_mart(
    name: str, staged: dict[str, DataFrame], states: DataFrame, months: DataFrame,
    targets: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """One of the seven marts, unevaluated.

    ``targets`` (report type -> existing wide fact) switches the wide facts to the
    incremental form, which holds only the rows of changed partitions.
    """
    def fact(tipo: str) -> DataFrame:
        return marts.build_fact(tipo, staged[tipo], months, (targets or {}).get(tipo))

    builders = {
        "dim_uf": lambda: marts.state_dimension(states),
        "dim_data_referencia": lambda: marts.period_dimension(staged, months),
        "dim_insumo": lambda: marts.item_dimension(staged),
        **{marts.FACT_NAME[t]: lambda t=t: fact(t) for t in V.REPORT_TYPES},
        "fato_medicao": lambda: marts.build_long_fact({t: fact(t) for t in V.REPORT_TYPES}),
    }
    return builders[name]()


def export_table(df: DataFrame, path: str) -> DataFrame:
    """Write the complete current state and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def export_clustered(df: DataFrame, path: str, cluster: list[str], order: list[str]) -> DataFrame:
    """Write range-partitioned and sorted, so that row-group statistics skip data.

    Ranges are cut on ``cluster`` and ``order`` together: a value of the leading
    columns holding a third of the rows spans several files.
    """
    keys = [*cluster, *order]
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def long_fact_table(root: str) -> str:
    """Name under which the session's catalog knows the long fact of a gold folder, with its buckets."""
    return f"pl_{hashlib.md5(root.encode()).hexdigest()[:12]}_fato_medicao"


def export_long_fact(facts: dict[str, DataFrame], root: str, buckets: int | None = None) -> DataFrame:
    """Write the long fact of the wide facts as an external table bucketed by ``BUCKET_KEYS``.

    What is shuffled are the wide rows, with their keys and file names once and not once per measure.  A bucket has
    a file for each report type.  ``buckets`` should leave a bucket some tens of megabytes; the partitions of a shuffle by default.
    """
    spark = next(iter(facts.values())).sparkSession
    n, name = buckets or shuffle_partitions(spark), long_fact_table(root)
    rows = marts.build_long_fact({t: fact.repartition(n, *BUCKET_KEYS) for t, fact in facts.items()})
    with unsorted_folders(spark):  # a task holds one bucket
        rows.write.mode("overwrite").option("path", f"{root}/fato_medicao").bucketBy(n, *BUCKET_KEYS).saveAsTable(name)
    return spark.table(name)


def put_long_fact(spark: SparkSession, rows: DataFrame, root: str, first: bool, buckets: int | None = None) -> DataFrame:
    """The long fact in folders by type and state, bucketed by item and measure: written anew, or only the rows' folders.

    A catalog that does not know the table can't replace folders of it; then it must be ``first``.
    """
    name, layout = long_fact_table(root), [*FOLDER_BUCKET_KEYS, "desonerado", "period_start"]
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select(*[c for c in LONG_COLUMNS if c not in FOLDER_KEYS], *FOLDER_KEYS)
    if first:
        (
            rows.repartition(n, *FOLDER_BUCKET_KEYS).write.mode("overwrite").option("path", f"{root}/fato_medicao")
            .partitionBy(*FOLDER_KEYS).bucketBy(n, *FOLDER_BUCKET_KEYS).sortBy(*layout).saveAsTable(name)
        )
    else:
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(setting)
        spark.conf.set(setting, "dynamic")
        try:
            rows.repartition(n, *FOLDER_BUCKET_KEYS).write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set(setting, before)
    return spark.table(name)


def write_mart(
    name: str, staged: dict[str, DataFrame], states: DataFrame, months: DataFrame, written: Mapping[str, DataFrame], root: str
) -> DataFrame:
    """Write one mart under ``root``; the long fact is built from the written wide facts."""
    if name != "fato_medicao":
        return export_table(define_mart(name, staged, states, months), f"{root}/{name}")
    return export_long_fact({t: written[fact] for t, fact in marts.FACT_NAME.items()}, root)


def build_gold(
    silver: dict[str, DataFrame], states: DataFrame, months: DataFrame, root: str
) -> dict[str, DataFrame]:
    """Write all marts under ``root``."""
    staged = {t: STAGES[t](df) for t, df in silver.items()}
    written: dict[str, DataFrame] = {}
    for name in MART_NAMES:
        written[name] = write_mart(name, staged, states, months, written, root)
    return written


def register_catalog(spark: SparkSession, root: str, names: list[str] | None = None) -> list[str]:
    """One temp view per gold relation found under ``root``/name; the long fact with its buckets if this catalog wrote it."""
    names = MART_NAMES + VIEW_NAMES if names is None else names
    types = {name: tipo for tipo, name in marts.FACT_NAME.items()}
    for name in names:
        if name == "fato_medicao" and spark.catalog.tableExists(long_fact_table(root)):
            spark.table(long_fact_table(root)).select(LONG_COLUMNS).createOrReplaceTempView(name)
        elif name in served.FOLDERS:
            served.read(spark, name, f"{root}/{name}").createOrReplaceTempView(name)
        else:
            # facts may be partitioned; folder names carry no types
            reader = spark.read.schema(marts.fact_schema(types[name])) if name in types else spark.read
            reader.parquet(f"{root}/{name}").createOrReplaceTempView(name)
    return names


def export_views(marts_by_name: dict[str, DataFrame], root: str) -> None:
    """Write the nine views, eight of them in folders; the movers are taken from the written evolution."""
    spark = marts_by_name["dim_uf"].sparkSession
    for name in VIEW_NAMES:
        path = f"{root}/{name}"
        if name == "vw_maiores_variacoes":
            served.write(name, biggest_changes(served.table(spark, "vw_evolucao_preco", f"{root}/vw_evolucao_preco")), path)
        elif name in served.FOLDERS:
            served.write(name, view(name, marts_by_name), path)
        else:
            export_table(view(name, marts_by_name), path)


def export_gold(marts_by_name: dict[str, DataFrame], root: str) -> None:
    """Write all sixteen relations, views included, as a serving catalog."""
    for name in MART_NAMES:
        export_table(marts_by_name[name], f"{root}/{name}")
    export_views(marts_by_name, root)
