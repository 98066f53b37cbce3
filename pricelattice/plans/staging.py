"""Silver to staging: rename, re-type and normalise only; no rows added or dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelattice import vocabulary as V
from pricelattice.functions.text import capitalize_first

def _file_columns() -> list[Column]:
    return [
        F.col("report_type"),
        # a folder name, so the reader infers text
        F.col("desonerado").cast("boolean").alias("desonerado"),
        F.col("revisado"),
        F.col("region"),
        F.col("state_slug"),
        F.col("year").cast("int").alias("year"),
        F.col("month"),
        F.col("archive_stem"),
        F.col("blob_name"),
        F.col("parsed_at").cast("timestamp_ntz").alias("parsed_at"),
    ]


def _item_columns() -> list[Column]:
    # publications disagree on the case of the code
    return [F.lower("codigo").alias("codigo"), capitalize_first(F.col("descricao")).alias("descricao")]


def stage_materials(silver: DataFrame) -> DataFrame:
    return silver.select(*_item_columns(), "unidade", *V.MATERIAL_MEASURES, *_file_columns())


def stage_equipment(silver: DataFrame) -> DataFrame:
    return silver.select(*_item_columns(), *V.EQUIPMENT_MEASURES, *_file_columns())


def stage_labour(silver: DataFrame) -> DataFrame:
    layout = F.when(F.col("salario").isNotNull(), V.LAYOUT_OLD).otherwise(V.LAYOUT_NEW)
    return silver.select(
        *_item_columns(), "unidade", *V.LABOUR_MEASURES, layout.alias("schema_version"), *_file_columns()
    )


STAGES = {V.MATERIAL: stage_materials, V.EQUIPMENT: stage_equipment, V.LABOUR: stage_labour}
