"""Change carried through the gold layer: changed publications to the long fact and to the views that they feed.

A publication is a report type, a state and a period.  Every series, ranking, index group and latest price lies within
one type and state, so a changed publication touches the folders of that pair and no others; a new label of an
item touches the pairs in which the item is priced.  All lists here are bounded by types, states and the calendar.
"""

from __future__ import annotations

from collections import ChainMap
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelattice import vocabulary as V
from pricelattice.operators import keyed
from pricelattice.plans import build, marts, served
from pricelattice.plans.views import biggest_changes, view
from pricelattice.session import broadcast_if_small, drop_scratch, path_exists

Pairs = set[tuple[str, str]]  # report type and state
_UNFINISHED, _ALL = "_unfinished", "*"


def partition_keys(tipo: str) -> list[str]:
    return ["state_slug", "period_start"] + ([] if tipo == V.MATERIAL else ["desonerado"])


def fact_table(spark: SparkSession, tipo: str, path: str) -> DataFrame:
    """A written wide fact; the schema is given, since folder names carry no types."""
    return spark.read.schema(marts.fact_schema(tipo)).parquet(path)


def next_fact(
    spark: SparkSession, tipo: str, staged: DataFrame, months: DataFrame, path: str, aside: str, full: bool = False, key_only: bool = True
) -> DataFrame:
    """The partitions of a wide fact that will change, as they will be, written ``aside``; the fact itself is left alone.

    ``key_only`` replaces rows by their key, so a row that vanished from a revised file stays; without it a changed
    partition is replaced as a whole.  ``full`` builds all partitions.
    """
    if full:
        marts.build_fact(tipo, staged, months).write.parquet(aside)
        return fact_table(spark, tipo, aside)
    batch_path = f"{aside}-batch"
    marts.build_fact(tipo, staged, months, fact_table(spark, tipo, path)).write.parquet(batch_path)
    batch = fact_table(spark, tipo, batch_path)
    if not key_only:
        return batch
    affected = keyed.in_partitions(fact_table(spark, tipo, path), batch, partition_keys(tipo))
    keyed.replace_by_key(affected, batch, marts.FACT_KEY[tipo]).write.parquet(aside)
    return fact_table(spark, tipo, aside)


def put_fact(tipo: str, changed: DataFrame, path: str, full: bool = False) -> None:
    """Write the changed partitions over those of the table; all of them if ``full``."""
    if full:
        keys = partition_keys(tipo)
        changed.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).parquet(path)
    else:
        keyed.overwrite_partitions(changed, path, partition_keys(tipo))


def touched_pairs(changed: dict[str, DataFrame]) -> Pairs:
    """Type and state of every changed partition."""
    return {(t, r.state_slug) for t, df in changed.items() for r in df.select("state_slug").distinct().collect()}


def relabelled_pairs(spark: SparkSession, root: str, items: DataFrame) -> Pairs:
    """Type and state of the rows whose item has another label in ``items`` than in the dimension that was written last."""
    old = spark.read.parquet(f"{root}/dim_insumo").select(*[F.col(c).alias(f"_{c}") for c in ("insumo_id", "descricao", "unidade")])
    same = F.col("descricao").eqNullSafe(F.col("_descricao")) & F.col("unidade").eqNullSafe(F.col("_unidade"))
    changed = items.join(old, F.col("insumo_id") == F.col("_insumo_id")).where(~same).select("insumo_id")
    if changed.isEmpty():
        return set()
    rows = spark.table(build.long_fact_table(root)).join(broadcast_if_small(changed, written=True), "insumo_id", "left_semi")
    return {(r.tipo, r.state_slug) for r in rows.select("tipo", "state_slug").distinct().collect()}


def mark_unfinished(spark: SparkSession, root: str, pairs: Pairs | None) -> None:
    """Note the pairs (None: all) that a run is about to rewrite; they are due until the run has ended."""
    rows = sorted(pairs) if pairs is not None else [(_ALL, _ALL)]
    spark.createDataFrame(rows, "tipo string, state_slug string").coalesce(1).write.mode("overwrite").parquet(f"{root}/{_UNFINISHED}")


def unfinished(spark: SparkSession, root: str) -> Pairs | None:
    """Pairs that a run before this one has left unfinished; None for all."""
    path = f"{root}/{_UNFINISHED}"
    rows = {tuple(r) for r in spark.read.parquet(path).collect()} if path_exists(spark, path) else set()
    return None if (_ALL, _ALL) in rows else rows


def finish(spark: SparkSession, root: str) -> None:
    drop_scratch(spark, f"{root}/{_UNFINISHED}")


def within(pairs: Pairs) -> Column:
    """Rows of the pairs, told by the folder columns."""
    by_type = {t: sorted(s for k, s in pairs if k == t) for t in {k for k, _ in pairs}}
    return reduce(or_, [(F.col("tipo") == t) & F.col("state_slug").isin(s) for t, s in sorted(by_type.items())], F.lit(False))


def long_rows(facts: dict[str, DataFrame], pairs: Pairs | None) -> DataFrame:
    """Long rows of the pairs, or all, with their type."""
    def part(tipo: str, fact: DataFrame) -> DataFrame:
        if pairs is not None:
            fact = fact.where(F.col("state_slug").isin(sorted(s for t, s in pairs if t == tipo)))
        return marts.build_long_fact({tipo: fact}).withColumn("tipo", F.lit(tipo))

    return reduce(DataFrame.unionByName, [part(t, f) for t, f in facts.items()])


def refresh_views(spark: SparkSession, tables: dict[str, DataFrame], root: str, pairs: Pairs | None) -> None:
    """Write the views' folders of the touched pairs (all without ``pairs``), and the coverage, which is small.

    ``tables`` holds the written marts; their long fact has the folder column tipo.
    """
    fact = tables["fato_medicao"]
    if pairs is not None:
        fact = fact.where(within(pairs))
    own = ChainMap({"fato_medicao": fact.select(build.LONG_COLUMNS)}, tables)
    for name in build.VIEW_NAMES:
        path = f"{root}/{name}"
        if name == "vw_cobertura":
            build.export_table(view(name, tables), path)
            continue
        if name == "vw_maiores_variacoes":  # of the evolution that has just been written
            evolution = served.table(spark, "vw_evolucao_preco", f"{root}/vw_evolucao_preco")
            rows = biggest_changes(evolution if pairs is None else evolution.where(within(pairs)))
        else:
            rows = view(name, own)
        folders = None
        if pairs is not None:
            only = served.type_of(name)
            folders = sorted({(s,) for t, s in pairs if t == only} if only else pairs)
            if only:
                rows = rows.where(F.col("state_slug").isin([s for s, in folders]))
        served.write(name, rows, path, folders=folders)
