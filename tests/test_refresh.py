"""Changes carried through the gold layer, and what a question about one item or state reads."""

import glob
import os
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pricelattice import vocabulary as V
from pricelattice.operators import quality
from pricelattice.plans import build, pipeline, refresh, seeds, served, views
from pricelattice.sources.silver import merge_silver
from registry.lake import lake

STATES = ["acre", "bahia", "goias", "parana"]
MONTHS = ["janeiro", "abril", "julho", "outubro"]
SF = "/root/testdata/sf0.1"


def publication(rng, tipo, state, year, month, relieved, revised, stamp):
    """The rows of one report file, a few items with some gaps."""
    name = f"r/{state}/{year}/{month}/{tipo}-{relieved}-{revised}.xlsx"
    rows = []
    for item in rng.sample(range(12), 8):
        measures = {m: None if rng.random() < 0.1 else float(rng.randint(1, 500)) for m in V.MEASURES[tipo]}
        measures[V.HEADLINE_MEASURE[tipo]] = float(rng.randint(1, 500))
        label = f"Item {item}" + (" novo" if rng.random() < 0.02 else "")
        rows.append({
            "codigo": f"{tipo[0]}{item}", "descricao": label, "unidade": None if tipo == V.EQUIPMENT else "kg", "blob_name": name, "region": "r",
            "state_slug": state, "year": year, "month": month, "report_type": tipo, "desonerado": relieved, "revisado": revised,
            "archive_stem": f"{state}-{month}", "parsed_at": stamp, **measures,
        })
    return rows


def silver_rows(spark, rows):
    measures = sum(V.MEASURES.values(), [])
    fields = [f"{c} string" for c in ("codigo", "descricao", "unidade", "blob_name", "region", "state_slug", "month", "report_type", "archive_stem", "parsed_at")]
    schema = ", ".join([*fields, "year int, desonerado boolean, revisado boolean", *[f"{m} double" for m in measures]])
    names = [f.split()[0] for f in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def some_publications(rng, n, stamp):
    out = {}
    for _ in range(n):
        tipo = rng.choice(V.REPORT_TYPES)
        relieved = tipo != V.MATERIAL and rng.random() < 0.5
        key = (tipo, rng.choice(STATES), rng.choice([2022, 2023]), rng.choice(MONTHS), relieved, rng.random() < 0.2)
        out[key] = publication(rng, *key, stamp)
    return sum(out.values(), [])


def files(folder):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


def rows_of(df):
    columns = sorted(df.columns)
    return sorted((tuple(str(round(v, 9) if isinstance(v, float) else v) for v in r) for r in df.select(columns).collect()))


@pytest.mark.parametrize("seed", [1])
def test_refresh_equals_rebuild_and_leaves_other_folders(spark, tmp_path, seed):
    rng = random.Random(seed)
    silver, gold = str(tmp_path / "silver"), str(tmp_path / f"gold{seed}")
    states, months = seeds.states(spark).where(F.col("state_slug").isin(STATES)), seeds.months(spark)
    for turn, n in enumerate([40, 2, 1]):
        merge_silver(spark, silver, silver_rows(spark, some_publications(rng, n, f"2024-0{turn + 1}-01 00:00:00")))
        before = files(gold)
        marks = {t: refresh.fact_table(spark, t, f"{gold}/{name}").count() for t, name in build.marts.FACT_NAME.items()} if turn else {}
        pipeline.run_gold(spark, silver, gold, states, months)
        names = build.register_catalog(spark, gold)
        found = {name: rows_of(spark.table(name)) for name in names}
        tables = {name: spark.table(name) for name in build.MART_NAMES}
        tables["fato_medicao"] = build.marts.build_long_fact({t: tables[n] for t, n in build.marts.FACT_NAME.items()})
        assert found["fato_medicao"] == rows_of(tables["fato_medicao"])
        for name in build.VIEW_NAMES:
            assert found[name] == rows_of(views.view(name, tables)), (turn, name)
        if turn:
            after = files(gold)
            kept = {p for p in after if before.get(p) == after[p]}
            of = lambda paths, name: {os.path.dirname(p) for p in paths if f"/{name}/" in p and "_layout" not in p}
            for name in ("fato_medicao", "vw_evolucao_preco", "vw_preco_atual", "vw_indice_reajuste"):
                rewritten = of(set(after) - kept, name)
                assert 0 < len(rewritten) < len(of(after, name)), (turn, name)  # a few folders, not all
            assert marks and all(n <= refresh.fact_table(spark, t, f"{gold}/{build.marts.FACT_NAME[t]}").count() for t, n in marks.items())


def test_new_label_reaches_every_folder_of_the_item(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold-label")
    states, months = seeds.states(spark).where(F.col("state_slug").isin(STATES)), seeds.months(spark)
    rng = random.Random(7)
    rows = sum((publication(rng, V.MATERIAL, s, 2022, "janeiro", False, False, "2024-01-01 00:00:00") for s in STATES), [])
    merge_silver(spark, silver, silver_rows(spark, rows))
    pipeline.run_gold(spark, silver, gold, states, months)
    new = [dict(r, month="abril", blob_name="r/acre/x.xlsx", descricao="Outro nome", parsed_at="2024-02-01 00:00:00") for r in rows if r["state_slug"] == "acre"]
    merge_silver(spark, silver, silver_rows(spark, new))
    pipeline.run_gold(spark, silver, gold, states, months)
    build.register_catalog(spark, gold)
    codes = {r["codigo"] for r in new}
    got = {(r.state_slug, r.codigo): r.descricao for r in spark.table("vw_preco_atual").collect()}
    assert {s for s, c in got if c in codes} == set(STATES)
    assert all((got[k] == "Outro nome") == (k[1] in codes) for k in got)


def test_a_failed_check_leaves_every_file(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold-failed")
    states, months = seeds.states(spark).where(F.col("state_slug").isin(STATES)), seeds.months(spark)
    rows = publication(random.Random(3), V.MATERIAL, "acre", 2022, "janeiro", False, False, "2024-01-01 00:00:00")
    merge_silver(spark, silver, silver_rows(spark, rows))
    pipeline.run_gold(spark, silver, gold, states, months)
    before = files(gold)
    bad = [dict(r, month="abril", blob_name="r/acre/b.xlsx", preco_unitario=-1.0, parsed_at="2024-02-01 00:00:00") for r in rows]
    merge_silver(spark, silver, silver_rows(spark, bad))
    with pytest.raises(quality.QualityError):
        pipeline.run_gold(spark, silver, gold, states, months)
    assert files(gold) == before


def test_a_run_that_was_broken_off_is_made_good(spark, tmp_path, monkeypatch):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold-broken")
    states, months = seeds.states(spark).where(F.col("state_slug").isin(STATES)), seeds.months(spark)
    rows = publication(random.Random(4), V.MATERIAL, "acre", 2022, "janeiro", False, False, "2024-01-01 00:00:00")
    merge_silver(spark, silver, silver_rows(spark, rows))
    pipeline.run_gold(spark, silver, gold, states, months)
    more = [dict(r, month="abril", blob_name="r/acre/b.xlsx", parsed_at="2024-02-01 00:00:00") for r in rows]
    merge_silver(spark, silver, silver_rows(spark, more))

    def stop(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(refresh, "refresh_views", stop)
        with pytest.raises(RuntimeError):
            pipeline.run_gold(spark, silver, gold, states, months)
    assert served.table(spark, "vw_evolucao_preco", f"{gold}/vw_evolucao_preco").count() == 8
    pipeline.run_gold(spark, silver, gold, states, months)  # nothing new in silver
    assert served.table(spark, "vw_evolucao_preco", f"{gold}/vw_evolucao_preco").count() == 16
    assert not os.path.exists(f"{gold}/_unfinished")


def test_one_item_reads_few_row_groups(spark, tmp_path, capsys):
    """Of all row groups of the evolution at sf0.1, those in whose range of items one item lies."""
    k = lake(spark, SF)
    path = str(tmp_path / "evolution")
    served.write("vw_evolucao_preco", k.view("vw_evolucao_preco"), path, group_rows=500)
    tipo, codigo = V.EQUIPMENT, "c4"
    key = spark.range(1).select(served.item_key(tipo, codigo)).first()[0]
    groups = holding = 0
    for file in glob.glob(f"{path}/tipo=*/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index("insumo_id")
        for g in range(meta.num_row_groups):
            span = meta.row_group(g).column(at).statistics
            groups += 1
            holding += f"tipo={tipo}/" in file and span.min <= key <= span.max
    assert groups > 400 and 0 < holding < 0.05 * groups, (holding, groups)
    found = served.read(spark, "vw_evolucao_preco", path, tipo, codigo, ["nation_3"])
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(insumo_id" in plan and "nation_3" in re.search(r"PartitionFilters: \[(.*)\]", plan).group(1)
    whole = k.view("vw_evolucao_preco").where((F.col("tipo") == tipo) & (F.col("codigo") == codigo) & (F.col("state_slug") == "nation_3"))
    assert rows_of(found) == rows_of(whole) and found.count() > 0


SCANS = {"serve_regime": 1, "serve_regime_media": 1, "serve_regime_tabela": 1, "serve_indice": 3, "serve_kpis": 2, "serve_comparacao_uf": 1,
         "serve_preco_por_estado": 1, "serve_evolucao_media": 2, "serve_evolucao_uf": 2, "serve_preco_atual": 1, "vw_comparacao_regime": 3, "quality_report": 12}


@pytest.mark.parametrize("name", SCANS)
def test_scans_of_a_question(spark, name):
    import __spark_entry__ as entry

    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) <= SCANS[name], plan


def test_rules_and_uniqueness_in_one_pass(spark):
    """Null keys, repeated keys and broken rows, each counted as a pass of its own would."""
    rows = [("a", "c1", 1.0), ("a", "c1", -1.0), ("b", None, 0.0), (None, "c2", 2.0), (None, None, 1.0), ("c", "c3", 3.0), ("c", "c3", 3.0), ("c", "c4", 0.0)]
    fact = spark.createDataFrame(rows, "medicao_id string, insumo_id string, valor double").withColumn("medida", F.lit("custo"))
    for df in (fact, fact.limit(0)):
        got = {r.check_name: r.violations for r in quality.report({"fato_medicao": df}, quality.standard_checks({"fato_medicao": df})).collect()}
        assert got == {
            "unique_fato_medicao_medicao_id": quality.repeated_values(df, "medicao_id").count(),
            "valor_positivo": quality.implausible_values(df).count(),
            **{f"not_null_fato_medicao_{c}": quality.null_values(df, c).count() for c in ("medicao_id", "insumo_id", "valor")},
        }
    assert quality.repeated_values(fact, "medicao_id").count() == 2


def test_defining_the_index_question_runs_no_job(spark):
    import __spark_entry__ as entry

    define = entry.queries()["serve_indice"]
    define(spark, "/root/testdata/sf0.001")  # writes the layers
    spark.sparkContext.setJobGroup("index", "index")
    define(spark, "/root/testdata/sf0.001")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("index")
    spark.sparkContext.setJobGroup("tests", "tests")
    assert len(jobs) <= 2  # the few state names


def test_known_columns_are_those_of_a_merged_read(spark, tmp_path):
    """Three types and both labour layouts, each file with its own columns only."""
    from pricelattice.sources import silver

    root, rng = str(tmp_path / "silver"), random.Random(6)
    for n, tipo in enumerate([*V.REPORT_TYPES, V.LABOUR]):
        rows = silver_rows(spark, publication(rng, tipo, STATES[n], 2022 + n, "abril", n == 3, False, "2024-01-01 00:00:00"))
        lacking = [m for t, own in V.MEASURES.items() for m in own if t != tipo or (n == 3 and m in V.LABOUR_COMPONENTS)]
        silver.write_silver(rows.drop(*lacking, *(["unidade"] if tipo == V.EQUIPMENT else [])), root)
    merged = silver.retype_partition_columns(silver.read_silver(spark, root))
    assert rows_of(silver.read_known_silver(spark, root)) == rows_of(merged)
