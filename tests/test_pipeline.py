"""Workbooks on disk to silver to gold, then a revision on top."""

import io
import re
import zipfile
from xml.sax.saxutils import escape

import pytest

from pricelattice.operators import keyed, quality
from pricelattice.plans import build, pipeline, seeds, views
from pricelattice.sources import workbooks

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def workbook(table):
    """A minimal workbook; strings alternate between shared and inline, None cells are left out."""
    shared, body = [], []
    for i, row in enumerate(table):
        cells = []
        for j, v in enumerate(row):
            at = f'r="{chr(65 + j)}{i + 1}"'
            if v is None:
                continue
            if isinstance(v, float):
                cells.append(f"<c {at}><v>{v}</v></c>")
            elif (i + j) % 2:
                cells.append(f'<c {at} t="inlineStr"><is><t>{escape(v)}</t></is></c>')
            else:
                shared.append(v)
                cells.append(f'<c {at} t="s"><v>{len(shared) - 1}</v></c>')
        body.append(f'<row r="{i + 1}">{"".join(cells)}</row>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {NS} {REL}><sheets><sheet name="s" sheetId="1" r:id="rId7"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId7" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {NS}>" + "".join(f"<si><r><t>{escape(s[:2])}</t></r><r><t>{escape(s[2:])}</t></r></si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {NS}><sheetData>{''.join(body)}</sheetData></worksheet>")
    return out.getvalue()


MAT = ["Código", "Descrição", "Unidade", "Preço Unitário\n(R$)"]


def put(root, path, content):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(content)


def test_cells(spark, tmp_path):
    put(tmp_path, "a.xlsx", workbook([["x & y", None, 1.5], [], [None, "b"]]))
    put(tmp_path, "b.xlsx", b"no zip")
    got = {(r.path.split("/")[-1], r.row_idx): (r.cells, r.error) for r in workbooks.read_workbooks(spark, str(tmp_path)).collect()}
    assert got.pop(("b.xlsx", -1))[1].startswith("BadZipFile")
    assert got == {("a.xlsx", 0): (["x & y", None, "1.5"], None), ("a.xlsx", 1): ([], None), ("a.xlsx", 2): ([None, "b"], None)}


def test_runs(spark, tmp_path):
    raw, silver, gold = tmp_path / "raw ç", str(tmp_path / "silver"), str(tmp_path / "gold")
    acre, bahia = "norte/acre/2021", "nordeste/bahia/2021"
    name = "x/Relatório Sintético de Materiais.xlsx"
    put(raw, f"{acre}/janeiro/{name}", workbook([["TABELA"], MAT, ["A1", "Cal", "kg", 10.0], ["A1", "Cal", "kg", 10.0], ["A2", "Areia", "m3", "-"]]))
    put(raw, f"{acre}/abril/{name}", workbook([MAT, ["a1", "CAL", "kg", 12.0], ["A3", "Brita", "m3", 4.0]]))
    put(raw, f"{bahia}/janeiro/{name}", workbook([MAT, ["A1", "Cal", "kg", 20.0]]))
    put(raw, f"{bahia}/abril/{name}", workbook([MAT, ["A1", "Cal", "kg", "abc"]]))
    put(raw, f"{bahia}/julho/{name}", b"broken")
    put(raw, f"{bahia}/julho/x/Relatório Analítico de Materiais.xlsx", b"not looked at")
    labour = ["Código", "Descrição", "Unidade", "Custo (R$)"]
    put(raw, f"{acre}/abril/x/Relatório Sintético de Mão de Obra - com desoneração.xlsx", workbook([labour, ["P1", "Pedreiro", "h", 21.0]]))

    ledger = pipeline.run_silver(spark, str(raw), silver, pipeline.empty_parses(spark), "2024-01-01 00:00:00", files_per_round=4)
    got = {r.blob_name.replace("/" + name, ""): (r.status, r.row_count, r.error) for r in ledger.collect()}
    broken = got.pop(f"{bahia}/julho")
    assert broken[0] == "failed" and broken[2].startswith("BadZipFile")
    assert got == {
        f"{acre}/janeiro": ("parsed", 3, None), f"{acre}/abril": ("parsed", 2, None), f"{bahia}/janeiro": ("parsed", 1, None),
        f"{bahia}/abril": ("failed", None, "cell is not a number"),
        f"{acre}/abril/x/Relatório Sintético de Mão de Obra - com desoneração.xlsx": ("parsed", 1, None),
    }
    states, months = seeds.states(spark), seeds.months(spark)
    assert pipeline.run_gold(spark, silver, gold, states, months) == [("warn_cobertura_com_lacunas", 1)]

    def prices():
        rows = spark.read.parquet(f"{gold}/vw_evolucao_preco").where("tipo = 'materiais'").collect()
        return sorted((r.state_slug, r.codigo, r.period_start.month, r.valor, r.variacao_percentual) for r in rows)

    first = [
        ("acre", "a1", 1, 10.0, None), ("acre", "a1", 4, 12.0, 0.2), ("acre", "a3", 4, 4.0, None), ("bahia", "a1", 1, 20.0, None),
    ]
    assert prices() == first
    assert spark.read.parquet(f"{gold}/vw_preco_atual").where("tipo = 'mao_de_obra'").first().desonerado is True

    # the failed file is fixed, and a revision of one partition drops item a3
    put(raw, f"{bahia}/abril/{name}", workbook([MAT, ["A1", "Cal", "kg", 30.0]]))
    put(raw, f"{acre}/abril/REVISADO/Relatório Sintético de Materiais.xlsx", workbook([MAT, ["A1", "Cal", "kg", 15.0]]))
    again = pipeline.run_silver(spark, str(raw), silver, ledger, "2024-02-01 00:00:00", limit=10)
    assert again.where("status = 'parsed'").count() == 6 and again.count() == 7
    pipeline.run_gold(spark, silver, gold, states, months)
    refreshed = [
        ("acre", "a1", 1, 10.0, None), ("acre", "a1", 4, 15.0, 0.5), ("acre", "a3", 4, 4.0, None),
        ("bahia", "a1", 1, 20.0, None), ("bahia", "a1", 4, 30.0, 0.5),
    ]
    assert prices() == refreshed
    pipeline.run_gold(spark, silver, gold, states, months, full=True)
    assert prices() == [p for p in refreshed if p[1] != "a3"]

    names = build.register_catalog(spark, gold)
    assert len(names) == 16
    assert quality.require({n: spark.table(n) for n in names}) == [("warn_variacao_percentual_suspeita", 2)]
    plan = views.series_changes(spark.table("fato_medicao"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan

    # a negative price stops the run before the views are written
    put(raw, f"{bahia}/outubro/{name}", workbook([MAT, ["A1", "Cal", "kg", -1.0]]))
    pipeline.run_silver(spark, str(raw), silver, again, "2024-03-01 00:00:00")
    before = prices()
    with pytest.raises(quality.QualityError, match="valor_positivo: 1"):
        pipeline.run_gold(spark, silver, gold, states, months)
    assert prices() == before


def broken_off(rows):
    """A workbook whose sheet ends in the middle of its last row."""
    whole = workbook([MAT, *[[f"A{i}", "Cal", "kg", 1.0] for i in range(rows)]])
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(whole)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
        for part in old.namelist():
            body = old.read(part)
            new.writestr(part, body[: body.rindex(b"<c")] if part.endswith("sheet1.xml") else body)
    return out.getvalue()


@pytest.mark.parametrize("per_batch", [5_000, 100])
def test_a_file_that_breaks_off_leaves_no_rows(spark, tmp_path, monkeypatch, per_batch):
    monkeypatch.setattr(workbooks, "_ROWS_PER_BATCH", per_batch)
    raw, silver = tmp_path / "raw", str(tmp_path / "silver")
    name = "x/Relatório Sintético de Materiais.xlsx"
    put(raw, f"norte/acre/2021/abril/{name}", broken_off(7_000))
    put(raw, f"norte/acre/2021/julho/{name}", workbook([MAT, ["A1", "Cal", "kg", 10.0]]))
    ledger = pipeline.run_silver(spark, str(raw), silver, pipeline.empty_parses(spark), "2024-01-01 00:00:00")
    got = {r.month: (r.status, r.row_count, r.error) for r in ledger.collect()}
    assert got["julho"] == ("parsed", 1, None)
    assert got["abril"][:2] == ("failed", None) and got["abril"][2].startswith("ParseError")
    assert [r.month for r in spark.read.parquet(silver).collect()] == ["julho"]
    put(raw, f"norte/acre/2021/abril/{name}", workbook([MAT, ["A1", "Cal", "kg", 10.0], ["A2", "Cal", "kg", 10.0]]))
    ledger = pipeline.run_silver(spark, str(raw), silver, ledger, "2024-02-01 00:00:00")
    assert {r.month: (r.status, r.row_count) for r in ledger.collect()} == {"julho": ("parsed", 1), "abril": ("parsed", 2)}
    assert spark.read.parquet(silver).count() == 3


def test_the_limit_takes_the_first_by_path(spark, tmp_path):
    raw, silver = tmp_path / "raw", str(tmp_path / "silver")
    for month in ("abril", "janeiro", "julho", "outubro"):
        put(raw, f"norte/acre/2021/{month}/x/Relatório Sintético de Materiais.xlsx", workbook([MAT, ["A1", "Cal", "kg", 10.0]]))
    ledger, seen = pipeline.empty_parses(spark), []
    for _ in range(3):
        ledger = pipeline.run_silver(spark, str(raw), silver, ledger, "2024-01-01 00:00:00", limit=2, files_per_round=1)
        seen.append(sorted(r.month for r in ledger.collect()))
    assert seen == [["abril", "janeiro"], ["abril", "janeiro", "julho", "outubro"], ["abril", "janeiro", "julho", "outubro"]]
    assert not list((tmp_path / "raw").glob("**/*.parquet")) and spark.read.parquet(silver).count() == 4


def test_a_refresh_opens_touched_folders_only(spark, tmp_path, capsys):
    path = str(tmp_path / "table")
    rows = [(i, f"s{i % 5}", i % 2 == 0, None if i % 7 == 0 else i % 3) for i in range(60)]
    table = spark.createDataFrame(rows, "id int, state string, flag boolean, part int")
    table.write.partitionBy("state", "flag", "part").parquet(path)
    target = spark.read.schema(table.schema).parquet(path)
    touched = table.where("id in (3, 7)")
    found = keyed.in_partitions(target, touched, ["state", "flag", "part"])
    found.explain("formatted")
    filters = re.search(r"PartitionFilters: \[(.*)\]", capsys.readouterr().out).group(1)
    assert "s3" in filters and "s2" in filters and "isnull(part" in filters
    want = {r[0] for r in rows if r[1:] in {q[1:] for q in rows if q[0] in (3, 7)}}
    assert {r.id for r in found.collect()} == want


def test_only_reachable_pages_are_harvested(spark):
    root = "https://h.example/reports"

    def page(*hrefs):
        return "".join(f'<a href="{h}">x</a>' for h in hrefs)

    file = "/sul/parana/2021/abril/"
    chain = [(f"{root}/p{i}", page(f"/reports/p{i + 1}", f"/reports{file}f{i}.zip")) for i in range(8)]
    data = [(root, page("/reports/p0", "/reports"))] + chain + [(f"{root}/island", page(f"/reports{file}island.zip"))]
    pages = spark.createDataFrame(data, "url string, html string")
    seeds_ = spark.createDataFrame([(root,)], "node string")
    ledger = pipeline.crawl(pipeline.empty_downloads(spark), pages, seeds_, root)
    # the seed has depth 0, so p4 is the last page within five steps
    assert sorted(r.filename for r in ledger.collect()) == [f"f{i}.zip" for i in range(5)]


def test_links_enter_the_ledger_once(spark):
    base = "https://h.example/reports"
    body = '<a href="/reports/sul/parana/2021/abril-1/f.zip">x</a><a href="/reports/sul">y</a>'
    pages = spark.createDataFrame([(base, body), (base + "/p", body)], "url string, html string")
    ledger = pipeline.record_links(pipeline.empty_downloads(spark), pages, base)
    ledger = pipeline.record_links(ledger, pages, base)
    row = ledger.collect()
    assert len(row) == 1 and (row[0].region, row[0].state_code, row[0].month, row[0].status) == ("sul", "parana", "abril", "pending")
