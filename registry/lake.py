"""Silver and gold tables derived once per session from a folder of input tables.

The layers mirror the pipeline: silver and the marts are written tables, views and
serving queries are computed over them.  Tables go to the session's shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelattice import standin
from pricelattice.plans import build, seeds, served, views
from pricelattice.plans.marts import FACT_NAME, build_fact
from pricelattice.plans.staging import STAGES
from pricelattice.session import folder_bytes, scratch_path, size_tasks, tune, unsorted_folders
from pricelattice.sources.silver import write_silver

CUTOFF = "2000-01-01 00:00:00"  # parse time that separates the two builds of the incremental queries


class Gold(dict):
    """The mart tables by name, each written when it is first asked for."""

    def __init__(self, source: Lake):
        super().__init__()
        self.source = source
        self.root = scratch_path(source.spark, "gold")

    def __missing__(self, name: str) -> DataFrame:
        k = self.source
        self[name] = build.write_mart(name, k.staged, k.states, k.months, self, self.root)
        return self[name]

    def all(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in build.MART_NAMES}


@dataclass
class Lake:
    spark: SparkSession
    sf_dir: str

    @cached_property
    def input_bytes(self) -> int:
        return folder_bytes(self.spark, self.sf_dir)

    @cached_property
    def _tables(self) -> dict[str, DataFrame]:
        return {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = standin.read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    @cached_property
    def silver_path(self) -> str:
        path = scratch_path(self.spark, "silver")
        with unsorted_folders(self.spark):
            standin.silver_panel(self.spark, self.sf_dir).write.partitionBy("report_type").parquet(path)
        return path

    @cached_property
    def silver_folders(self) -> str:
        """The same rows in the publisher's folder layout."""
        path = scratch_path(self.spark, "silver-folders")
        write_silver(self.panel, path)
        return path

    @cached_property
    def panel(self) -> DataFrame:
        return self.spark.read.parquet(self.silver_path)

    @cached_property
    def sheets(self) -> DataFrame:
        """The raw layer: sheet rows as delivered."""
        path = scratch_path(self.spark, "sheets")
        with unsorted_folders(self.spark):  # a question about one report type reads its folder only
            standin.sheet_rows(self.panel).write.partitionBy("report_type").parquet(path)
        return self.spark.read.parquet(path)

    @property
    def silver(self) -> dict[str, DataFrame]:
        return standin.silver_by_type(self.panel)

    @cached_property
    def staged(self) -> dict[str, DataFrame]:
        return {t: STAGES[t](df) for t, df in self.silver.items()}

    @cached_property
    def states(self) -> DataFrame:
        return standin.state_table(self.spark, self.sf_dir)

    @cached_property
    def months(self) -> DataFrame:
        return seeds.months(self.spark)

    def define_mart(self, name: str) -> DataFrame:
        return build.define_mart(name, self.staged, self.states, self.months)

    @cached_property
    def gold(self) -> Gold:
        return Gold(self)

    @property
    def facts(self) -> dict[str, DataFrame]:
        return {t: self.gold[n] for t, n in FACT_NAME.items()}

    def view(self, name: str, **only) -> DataFrame:
        """A view, of one type, item or some states if they are given."""
        return views.view(name, views.narrowed(self.gold, **only) if only else self.gold)

    @cached_property
    def _served(self) -> dict[str, str]:
        return {}

    def served(self, name: str, tipo: str | None = None, codigo: str | None = None, state_names: list[str] | None = None) -> DataFrame:
        """A view as it is kept for questions, of one type, item or some states if they are given."""
        if name not in self._served:
            path = f"{self.gold.root}/served/{name}"
            if name in served.FOLDERS:
                served.write(name, self.view(name), path)
            else:
                build.export_table(self.view(name), path)
            self._served[name] = path
        if name not in served.FOLDERS:
            return self.spark.read.parquet(self._served[name])
        slugs = None
        if state_names:  # a fixed list
            found = self.gold["dim_uf"].where(F.col("state_name").isin(state_names)).select("state_slug").collect()
            slugs = [r.state_slug for r in found]
        return served.read(self.spark, name, self._served[name], tipo, codigo, slugs)

    @cached_property
    def _old_facts(self) -> dict[str, DataFrame]:
        return {}

    def old_fact(self, tipo: str) -> DataFrame:
        """A wide fact as an earlier build left it, for the incremental queries."""
        if tipo not in self._old_facts:
            before = self.staged[tipo].where(F.col("parsed_at") <= F.lit(CUTOFF).cast("timestamp_ntz"))
            fact = build_fact(tipo, before, self.months)
            self._old_facts[tipo] = build.export_table(fact, scratch_path(self.spark, "old-fact"))
        return self._old_facts[tipo]


_LAKES: dict[tuple[str, str], Lake] = {}


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The session's lake over a folder; built on first use."""
    tune(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LAKES:
        _LAKES[key] = Lake(spark, sf_dir.rstrip("/"))
    size_tasks(spark, _LAKES[key].input_bytes)
    return _LAKES[key]
