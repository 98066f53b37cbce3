"""What keeps a task's share of the work the same on larger tables."""

import os

import pytest
from pyspark.sql import functions as F

from pricelattice import standin
from pricelattice import vocabulary as V
from pricelattice.plans import build, marts
from pricelattice.session import scratch_path, shuffle_partitions, size_tasks, unsorted_folders
from pricelattice.sources import sheets
from registry.lake import Lake

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SETTINGS = [INITIAL, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"]


@pytest.fixture
def settings(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_shuffles_grow_with_the_input(spark, settings):
    size_tasks(spark, 1 << 20)
    small = shuffle_partitions(spark)
    size_tasks(spark, 1 << 30)
    assert shuffle_partitions(spark) == 128 > small
    plan = spark.range(10).groupBy(F.col("id") % 3).count()._jdf.queryExecution().executedPlan().toString()
    assert ", 128)" in plan
    # lower sizes of a session stay
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    size_tasks(spark, 1 << 30)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1048576b"


def test_writers_stay_open_without_a_sort(spark):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before, path = spark.conf.get(name), scratch_path(spark, "folders")
    rows = spark.range(200).select("id", (F.col("id") % 5).alias("folder"))
    with unsorted_folders(spark, 2):  # fewer than there are folders
        assert spark.conf.get(name) == "2"
        rows.coalesce(1).write.partitionBy("folder").parquet(path)
    assert spark.conf.get(name) == before
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, rows.collect()))
    with pytest.raises(ValueError), unsorted_folders(spark):
        raise ValueError
    assert spark.conf.get(name) == before


def test_long_fact_is_laid_out_by_wide_rows(spark):
    def fact(tipo, values):
        known = {"insumo_id": "i", "state_slug": "acre", "blob_name": "f", marts.FACT_KEY[tipo]: "k", "revisado": False, "desonerado": False}
        columns = [c.split() for c in marts.fact_schema(tipo).split(", ")]
        return spark.range(3).select(*[
            F.concat(F.lit(known[c] + "-"), F.col("id").cast("string")).alias(c) if c in ("insumo_id", marts.FACT_KEY[tipo])
            else F.lit(values.get(c, known.get(c))).cast(kind).alias(c) for c, kind in columns
        ])

    facts = {
        V.MATERIAL: fact(V.MATERIAL, {"preco_unitario": 1.5}), V.EQUIPMENT: fact(V.EQUIPMENT, {m: 2.0 for m in V.EQUIPMENT_MEASURES}),
        V.LABOUR: fact(V.LABOUR, {"custo": 3.0}),
    }
    root = scratch_path(spark, "gold")
    written = build.export_long_fact(facts, root, 4)
    assert sorted(map(str, written.collect())) == sorted(map(str, marts.build_long_fact(facts).collect()))
    described = {r.col_name: r.data_type for r in spark.sql(f"describe extended {build.long_fact_table(root)}").collect()}
    assert described["Bucket Columns"] == "[`insumo_id`, `state_slug`]" and described["Num Buckets"] == "4"
    assert set(build.BUCKET_KEYS) <= set(marts.SERIES_KEYS)


def test_sheets_lie_in_a_folder_for_each_type(spark):
    k = Lake(spark, "/root/testdata/sf0.001")
    assert {os.path.basename(os.path.dirname(f)) for f in k.sheets.inputFiles()} == {f"report_type={t}" for t in V.REPORT_TYPES}


def test_header_cells_with_untidy_blanks_are_found(spark, rows):
    names = ["C\u00f3digo", "Descri\u00e7\u00e3o", "Unidade", "Pre\u00e7o Unit\u00e1rio (R$)"]
    cells = [[f" \u00a0{names[0]}\n", *names[1:], None], [f"{names[0]} x", *names[1:]], [None, *names[1:]], ["c o", "x"]]
    data = [(str(i), V.MATERIAL, 7, c) for i, c in enumerate(cells)]
    found = sheets.find_headers(spark.createDataFrame(data, "file string, report_type string, row_idx long, cells array<string>"))
    assert rows(found) == [("0", 7, 0)]


def test_panel_moves_the_lines_once(spark, tmp_path):
    """Suppliers and item sizes are sent to the tasks by their count, whatever Spark makes of the sizes of their files."""
    d = str(tmp_path)
    spark.sql("select 0 as r_regionkey, 'ASIA' as r_name").write.parquet(f"{d}/region.parquet")
    spark.sql("select 1 as n_nationkey, 'NATION_1' as n_name, 0 as n_regionkey").write.parquet(f"{d}/nation.parquet")
    spark.sql("select id as s_suppkey, 1 as s_nationkey from range(20)").write.parquet(f"{d}/supplier.parquet")
    spark.sql("select id as p_partkey, cast(id % 50 as int) as p_size from range(40)").write.parquet(f"{d}/part.parquet")
    spark.sql(
        "select id % 40 as l_partkey, id % 25 as l_suppkey, timestamp '1995-01-01' + make_dt_interval(cast(id as int)) as l_shipdate, 'R' as l_returnflag,"
        " 1.0D * id as l_extendedprice, 2.0D as l_quantity, 0.1D as l_discount, 0.2D as l_tax from range(500)"
    ).write.parquet(f"{d}/lineitem.parquet")
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        panel = standin.silver_panel(spark, d)
        plan = panel._jdf.queryExecution().sparkPlan().toString()
        rows = panel.collect()
    finally:
        spark.conf.set(name, before)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 4
    # lines of unknown suppliers are in no row
    assert {int(r.codigo[1:]) for r in rows} == {0, 1, 2, 3} and min(r.preco_unitario for r in rows if r.preco_unitario is not None) == 0.0
