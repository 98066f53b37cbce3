"""Data checks: each gives the offending rows; the report counts them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelattice import vocabulary as V

ERROR, WARN = "error", "warn"


def _is_null(column: str) -> Column:
    return F.col(column).isNull()


def _is_unaccepted(column: str, accepted: list[str]) -> Column:
    return ~F.col(column).isin(accepted)


def _is_implausible() -> Column:
    zero_total = (F.col("valor") == 0) & F.col("medida").isin(V.TOTAL_MEASURES)
    return (F.col("valor") < 0) | zero_total


def null_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(_is_null(column))


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values met more than once, with their count; nulls are not looked at."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)


def unaccepted_values(df: DataFrame, column: str, accepted: list[str]) -> DataFrame:
    """Rows with a value outside the list; null passes."""
    return df.where(_is_unaccepted(column, accepted))


def implausible_values(long_fact: DataFrame) -> DataFrame:
    """Negative values, and totals that are zero."""
    return long_fact.where(_is_implausible())


def coverage_gaps(coverage: DataFrame) -> DataFrame:
    return coverage.where(F.col("periodos_faltantes_vs_pares") > 0)


def suspicious_changes(evolution: DataFrame, limit: float = 0.3) -> DataFrame:
    return evolution.where(F.abs("variacao_percentual") > limit)


@dataclass(frozen=True)
class Check:
    """A rule of one table: rows for which ``broken`` holds, values of ``unique`` met more than once, or any row of ``offending``."""

    name: str
    severity: str
    table: str
    broken: Column | None = None
    unique: str | None = None
    offending: DataFrame | None = None


def standard_checks(tables: dict[str, DataFrame]) -> list[Check]:
    """The checks of the pipeline, for those tables that are given."""
    keys = {
        "dim_uf": "state_slug", "dim_data_referencia": "period_start", "dim_insumo": "insumo_id",
        "fato_preco_material": "preco_material_id", "fato_custo_equipamento": "custo_equipamento_id",
        "fato_custo_mao_de_obra": "custo_mao_de_obra_id", "fato_medicao": "medicao_id",
    }
    required = {
        "stg_materiais": ["codigo", "blob_name"], "stg_equipamentos": ["codigo", "blob_name"],
        "stg_mao_de_obra": ["codigo", "blob_name"], "dim_insumo": ["codigo"],
        "fato_preco_material": ["insumo_id"], "fato_custo_equipamento": ["insumo_id"],
        "fato_custo_mao_de_obra": ["insumo_id"], "fato_medicao": ["insumo_id", "valor"],
    }
    layouts = [V.LAYOUT_OLD, V.LAYOUT_NEW]
    accepted = {
        "dim_insumo": ("tipo", V.REPORT_TYPES),
        "stg_mao_de_obra": ("schema_version", layouts),
        "fato_custo_mao_de_obra": ("schema_version", layouts),
    }
    checks = []
    for table, df in tables.items():
        key = keys.get(table)
        for column in ([key] if key else []) + required.get(table, []):
            checks.append(Check(f"not_null_{table}_{column}", ERROR, table, broken=_is_null(column)))
        if key:
            checks.append(Check(f"unique_{table}_{key}", ERROR, table, unique=key))
        if table in accepted:
            column, values = accepted[table]
            checks.append(Check(f"accepted_values_{table}_{column}", ERROR, table, broken=_is_unaccepted(column, values)))
        if table == "fato_medicao":
            checks.append(Check("valor_positivo", ERROR, table, broken=_is_implausible()))
        if table == "vw_cobertura":
            checks.append(Check("warn_cobertura_com_lacunas", WARN, table, offending=coverage_gaps(df)))
        if table == "vw_evolucao_preco":
            checks.append(Check("warn_variacao_percentual_suspeita", WARN, table, offending=suspicious_changes(df)))
    return checks


def report(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check: name, severity, number of offending rows or values.

    All rules of a table are counted in one scan of it; where a column must be unique, the others are counted along its groups.
    """
    parts = [
        c.offending.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), "violations"
        )
        for c in checks if c.offending is not None
    ]
    for table, df in tables.items():
        rules = [c for c in checks if c.table == table and c.broken is not None]
        unique = [c for c in checks if c.table == table and c.unique is not None]
        counted = [F.count_if(c.broken).alias(c.name) for c in rules]
        if unique:  # one a table
            per_value = df.groupBy(F.col(unique[0].unique).alias("_value")).agg(F.count(F.lit(1)).alias("_n"), *counted)
            repeated = F.count_if(F.col("_value").isNotNull() & (F.col("_n") > 1)).alias(unique[0].name)
            counts = per_value.agg(repeated, *[F.coalesce(F.sum(c.name), F.lit(0)).alias(c.name) for c in rules])
        elif rules:
            counts = df.agg(*counted)
        else:
            continue
        own = unique + rules
        severity = F.coalesce(*[F.when(F.col("check_name") == c.name, c.severity) for c in own])
        long = counts.unpivot([], [c.name for c in own], "check_name", "violations")
        parts.append(long.select("check_name", severity.alias("severity"), "violations"))
    return reduce(DataFrame.unionByName, parts)


class QualityError(Exception):
    """A check of error severity found offending rows."""


def require(tables: dict[str, DataFrame]) -> list[tuple[str, int]]:
    """Run all checks; raise on errors, return the warnings with their counts."""
    found = [r for r in report(tables, standard_checks(tables)).where("violations > 0").collect()]  # one row per check
    errors = [f"{r.check_name}: {r.violations}" for r in found if r.severity == ERROR]
    if errors:
        raise QualityError("; ".join(errors))
    return [(r.check_name, r.violations) for r in found]
