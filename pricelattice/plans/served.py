"""Views as folders by report type and state, with the rows of a folder in order of the item.

A question about a state opens its folders; one about an item reads, of each file, the row groups whose range of keys holds
the item.  A refresh replaces whole folders and leaves the others' files alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pricelattice import vocabulary as V
from pricelattice.functions.text import surrogate_key
from pricelattice.session import drop_scratch, scratch_path

_BOTH = ["tipo", "state_slug"]
#: The views that are kept in folders, and by what.
FOLDERS = {
    "vw_preco_atual": _BOTH, "vw_evolucao_preco": _BOTH, "vw_comparacao_regime": _BOTH, "vw_comparacao_uf": _BOTH,
    "vw_indice_reajuste": _BOTH, "vw_maiores_variacoes": _BOTH,
    "vw_breakdown_equipamento": ["state_slug"], "vw_breakdown_mao_de_obra": ["state_slug"],
}
_TYPE_OF = {"vw_breakdown_equipamento": V.EQUIPMENT, "vw_breakdown_mao_de_obra": V.LABOUR}
ITEM = "insumo_id"
_LAYOUT = "_layout"  # readers of the folder pass over names like this
#: Rows of a row group, the least that a question about one item reads of a file.
GROUP_ROWS = 100_000


def _with_item(name: str, view: DataFrame) -> DataFrame:
    """The view with the key of its rows' item, a hash that spreads items evenly over ranges."""
    if "codigo" not in view.columns:
        return view
    tipo = F.lit(_TYPE_OF[name]) if name in _TYPE_OF else F.col("tipo")
    return view.withColumn(ITEM, surrogate_key(tipo, F.col("codigo")))


def type_of(name: str) -> str | None:
    """The one report type that a view is about, if so."""
    return _TYPE_OF.get(name)


def write(
    name: str, view: DataFrame, path: str, group_rows: int = GROUP_ROWS, folders: list[tuple] | None = None
) -> None:
    """Write a view anew, or replace the listed ``folders`` only; other folders keep their files.

    Rows are range-partitioned by folder and item, so a folder with any share of the rows spans several files whose
    ranges of items do not overlap.  The view is written aside first, as the ranges read their input twice and the
    folders may be read by the view itself.
    """
    spark = view.sparkSession
    aside = scratch_path(spark, name)
    _with_item(name, view).write.parquet(aside)
    rows = spark.read.parquet(aside)
    columns = FOLDERS[name]
    keys = columns + [c for c in (ITEM, "medida", "desonerado", "period_start", "posicao") if c in rows.columns]
    mode = "static" if folders is None else "dynamic"
    if folders is None or not rows.isEmpty():
        (
            rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
            .write.mode("overwrite").option("partitionOverwriteMode", mode)
            .option("parquet.block.row.count.limit", group_rows).partitionBy(*columns).parquet(path)
        )
    if folders is None:  # an empty table names its columns, also where no row does
        rows.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/{_LAYOUT}")
    if folders:  # those without rows are gone; at most types times states
        left = {tuple(r) for r in rows.select(*columns).distinct().collect()}
        for folder in set(folders) - left:
            drop_scratch(spark, "/".join([path, *(f"{c}={v}" for c, v in zip(columns, folder))]))
    drop_scratch(spark, aside)


def table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A written view with its item keys; folder names are text, whatever they look like."""
    found = spark.read.parquet(f"{path}/{_LAYOUT}").schema
    rows = StructType([f for f in found if f.name not in FOLDERS[name]])
    return spark.read.schema(StructType([*rows, *(StructField(c, StringType()) for c in FOLDERS[name])])).parquet(path)


def read(
    spark: SparkSession, name: str, path: str, tipo: str | None = None, codigo: str | None = None, state_slugs: list[str] | None = None
) -> DataFrame:
    """The view's rows of a type, an item and states: filters on folders and on the item's key, for the scan to skip by."""
    rows = table(spark, name, path)
    if tipo is not None and "tipo" in FOLDERS[name]:
        rows = rows.where(F.col("tipo") == tipo)
    if state_slugs is not None:
        rows = rows.where(F.col("state_slug").isin(list(state_slugs)))
    if codigo is not None and ITEM in rows.columns and (tipo or name in _TYPE_OF):
        rows = rows.where(F.col(ITEM) == item_key(_TYPE_OF.get(name, tipo), codigo))
    return rows.drop(ITEM)


def item_key(tipo: str, codigo: str):
    return surrogate_key(F.lit(tipo), F.lit(codigo))
