import zipfile
from urllib.parse import urljoin, urlparse

import pytest

from pricelattice import vocabulary as V
from pricelattice.sources import classify, files, links, sheets, silver


# ---- links -------------------------------------------------------------------------------

BASES = ["https://h.example/a/b/c", "https://h.example/a/b/", "https://h.example", "http://h.example/x?q=1#f"]
HREFS = [
    "d", "./d", "../d", "../../d", "../../../../d", "/root/x", "/root/../y", "//other.example/z", "?p=2", "#top",
    "https://abs.example/k.zip", "d/e/", "d/../e", "..", ".", "ftp://f.example/g", "a.b.zip", "d?x=1#y", "/", "x/./y",
]


def python_resolve(base, href):
    if not href or href.startswith(tuple(V.IGNORED_LINK_SCHEMES)):
        return None
    url = urljoin(base, href)
    parts = urlparse(url)
    return url if parts.scheme and parts.netloc else None


def test_resolution_matches_the_standard_library(spark):
    pairs = [(b, h) for b in BASES for h in HREFS + ["mailto:a@b", "tel:1", "javascript:x()", "data:text/plain,x"]]
    df = spark.createDataFrame(pairs, "base string, href string")
    got = {(r.base, r.href): r.link for r in links.resolve_links(df, "base").collect()}
    assert got == {(b, h): python_resolve(b, h) for b, h in pairs if python_resolve(b, h)}


HTML = """<html><!-- <a href="comment">x</a> --><script>var s = '<a href="script">';</script>
<A HREF="/upper">u</A><a class="k" href='single'>s</a><a href=bare>b</a><a title="a > b" href="quoted">q</a>
<a href="x?a=1&amp;b=2">e</a><link href="style.css"><a name="n">none</a><a href="">empty</a><a
 href="newline">n</a><abbr href="no">x</abbr></html>"""


def test_anchor_extraction(spark):
    pages = spark.createDataFrame([(1, HTML)], "id int, html string")
    found = [r.href for r in links.extract_links(pages, ["id"]).collect()]
    assert found == ["/upper", "single", "bare", "quoted", "x?a=1&b=2", "newline"]


def test_harvest_scope_and_split(spark):
    base = "https://h.example/reports"
    body = "".join(f'<a href="{h}">x</a>' for h in [
        "/reports/sul", "/reports/sul", "/reports/f.zip", "/other/f.zip", "/reports/NotaRevisional.pdf", "/reports/search?q",
    ])
    pages = spark.createDataFrame([(base, body)], "url string, html string")
    found_files, found_pages = links.harvest(pages, base)
    assert [r.link for r in found_files.collect()] == ["https://h.example/reports/f.zip"]
    assert [r.link for r in found_pages.collect()] == ["https://h.example/reports/sul"]


def test_url_metadata(spark):
    url = "https://h.example/x/sul/parana/2021-1/abril-2/PR_Revisado.old.zip"
    row = links.url_metadata(spark.createDataFrame([(url,)], "link string")).first()
    assert (row.region, row.state_code, row.year, row.month) == ("sul", "parana", "2021", "abril")
    assert (row.filename, row.extension, row.revisado) == ("PR_Revisado.old.zip", "zip", True)


# ---- classification --------------------------------------------------------------------------

ROOT = "sul/parana/2021/abril/pr-04-2021/"


@pytest.mark.parametrize("name, kind, relief, revised", [
    ("Relatório Sintético de Materiais.xlsx", "materiais", False, False),
    ("Relatorio Sintetico de Equipamentos - com desoneração.XLSX", "equipamentos", True, False),
    ("Relatório Sintético de M╞o de Obra - sem desoneraç╞o.xlsx", "mao_de_obra", True, False),
    ("sub/dir/RELATORIO SINTETICO MÃO DE OBRA.xlsx", "mao_de_obra", False, False),
    ("REVISADO/Relatório Sintético de Materiais.xlsx", "materiais", False, True),
    ("Relatório Analítico de Equipamentos.xlsx", None, None, None),
    ("Relatório Sintético de Materiais.pdf", None, None, None),
    ("Relatório Sintético de Composições.xlsx", None, None, None),
])
def test_classify(spark, name, kind, relief, revised):
    found = classify.classify_files(spark.createDataFrame([(ROOT + name,)], "path string")).collect()
    if kind is None:
        assert found == []
    else:
        r = found[0]
        assert (r.report_type, r.desonerado, r.revisado) == (kind, relief, revised)
        assert (r.region, r.state_slug, r.year, r.month, r.archive_stem) == ("sul", "parana", "2021", "abril", "pr-04-2021")


def test_shallow_path_is_no_report(spark):
    path = "sul/parana/2021/abril/Relatório Sintético de Materiais.xlsx"
    assert classify.classify_files(spark.createDataFrame([(path,)], "path string")).count() == 0


# ---- files ------------------------------------------------------------------------------------


def test_listing_hash_and_archives(spark, tmp_path):
    import hashlib

    (tmp_path / "in").mkdir()
    with zipfile.ZipFile(tmp_path / "in" / "a.ZIP", "w") as z:
        z.writestr("b/two.txt", "2")
        z.writestr("a/one.txt", "1")
        z.writestr("empty/", "")
    (tmp_path / "plain.txt").write_bytes(b"abc")
    root = str(tmp_path)
    assert files.list_objects(spark, root).count() == 2
    assert files.list_objects(spark, root, glob="*.txt").count() == 1
    assert [(r.name, r.length > 3) for r in files.list_objects(spark, root, prefix="in/").collect()] == [("in/a.ZIP", True)]
    hashes = files.content_hash(spark, root, "*.txt").collect()
    assert [(r.length, r.sha256) for r in hashes] == [(3, hashlib.sha256(b"abc").hexdigest())]
    members = [(r.member, bytes(r.content)) for r in files.archive_members(spark, root).collect()]
    assert members == [("a/one.txt", b"1"), ("b/two.txt", b"2")]


# ---- sheets --------------------------------------------------------------------------------------

PAD = [None, None]
OLD = ["Código", "Descrição", "Unidade", "Salário (R$)", "Encargos Totais", "Custo\n(R$)", "Periculosidade/\nInsalubridade"]
NEW = ["Código", "Descrição", "Unidade", "Custo\n (R$)"]
MAT = ["Código", "Descrição", "Unidade", "Preço Unitário\n(R$)"]
SHEETS = {
    ("old", "mao_de_obra"): [["CABEÇALHO", None], [None, "Local"], OLD + PAD, [" P1 ", "Pedreiro\n Oficial", "h", "10", "-", " 20.5 ", "0"] + PAD, [None, "x"]],
    ("new", "mao_de_obra"): [NEW + PAD, ["p1", "PEDREIRO", None, "21"] + PAD, ["", "blank code", "h", "-"]],
    ("unknown", "mao_de_obra"): [["Código", "Outro"], ["p1", "x"]],
    ("bad", "materiais"): [MAT, ["m1", "Cal", "kg", "1.0"], ["m2", "Areia", "m3", "abc"]],
    ("good", "materiais"): [["Código", "x"], MAT, MAT, ["m1", "Cal", "kg", "1.0"], ["m1", "Cal", "kg", "1.0"]],
    ("only header", "materiais"): [MAT],
}


@pytest.fixture(scope="module")
def sheet_rows(spark):
    data = [(f, t, i, cells) for (f, t), sheet in SHEETS.items() for i, cells in enumerate(sheet)]
    return spark.createDataFrame(data, "file string, report_type string, row_idx int, cells array<string>")


def test_headers(sheet_rows, rows):
    assert rows(sheets.find_headers(sheet_rows)) == [
        ("bad", 0, 0), ("good", 1, 0), ("new", 0, 1), ("old", 2, 0), ("only header", 0, 0)]
    assert rows(sheets.unknown_layouts(sheet_rows)) == [("unknown", "mao_de_obra")]


def test_labour_rows_of_both_layouts(sheet_rows):
    got = [tuple(r) for r in sheets.parse_sheets(sheet_rows, "mao_de_obra").orderBy("file", "row_idx").collect()]
    assert got == [
        ("new", 1, "p1", "pedreiro", "", None, None, 21.0, None),
        ("new", 2, "", "blank code", "h", None, None, None, None),
        ("old", 3, "p1", "pedreiro oficial", "h", 10.0, None, 20.5, 0.0),
    ]


def test_bad_cell_rejects_the_file(sheet_rows, rows):
    parsed = sheets.parse_sheets(sheet_rows, "materiais")
    # a repeated header line is data that is no number, so "good" is rejected as well
    assert parsed.count() == 0
    outcomes = {r.file: (r.row_count, r.status, r.error) for r in sheets.file_outcomes(sheet_rows).collect()}
    assert outcomes == {
        "old": (1, "parsed", None), "new": (2, "parsed", None), "only header": (0, "parsed", None),
        "unknown": (None, "failed", "no known header"),
        "bad": (None, "failed", "cell is not a number"), "good": (None, "failed", "cell is not a number"),
    }
    assert rows(sheets.parsed_row_counts(sheet_rows)) == [("new", 2), ("old", 1), ("only header", 0)]


# ---- silver -----------------------------------------------------------------------------------------


def silver_rows(spark, data):
    return spark.createDataFrame(
        [(b, "materiais", False, "2021", "abril", "acre", c, p) for b, c, p in data],
        "blob_name string, report_type string, desonerado boolean, year string, month string, state_slug string, "
        "codigo string, preco_unitario double",
    )


def test_reparsed_file_replaces_only_itself(spark, tmp_path, rows):
    root = str(tmp_path / "silver")
    silver.write_silver(silver_rows(spark, [("f1", "a", 1.0), ("f1", "b", 2.0), ("f2", "a", 3.0)]), root)
    silver.merge_silver(spark, root, silver_rows(spark, [("f1", "a", 9.0), ("f3", "z", 4.0)]))
    silver.merge_silver(spark, root, silver_rows(spark, [("f1", "a", 9.0)]))
    table = silver.retype_partition_columns(silver.read_silver(spark, root, "materiais"))
    assert rows(table.select("blob_name", "codigo", "preco_unitario")) == [("f1", "a", 9.0), ("f2", "a", 3.0), ("f3", "z", 4.0)]
    assert dict(table.dtypes)["desonerado"] == "boolean" and dict(table.dtypes)["year"] == "int"


def test_merged_schemas(spark, tmp_path):
    spark.range(1).selectExpr("id", "1.0D as salario").write.parquet(str(tmp_path / "t" / "a"))
    spark.range(1).selectExpr("id").write.parquet(str(tmp_path / "t" / "b"))
    table = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(str(tmp_path / "t"))
    assert sorted(str(r.salario) for r in table.collect()) == ["1.0", "None"]
