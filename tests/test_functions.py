import datetime

import pytest
from pyspark.sql import functions as F

from pricelattice.functions import labels as L
from pricelattice.functions import numeric as N
from pricelattice.functions import text as T
from pricelattice.plans import seeds


def value(spark, column, **literals):
    types = {k: v for k, v in literals.items()}
    df = spark.createDataFrame([tuple(v[0] for v in types.values())], ", ".join(f"{k} {v[1]}" for k, v in types.items()))
    return df.select(column).first()[0]


@pytest.mark.parametrize("raw", ["A9299", " a9299 ", " A9299\n", "a9299 ", "\x1cA9299\x1f", None, "", " \t ", "a  b", "a  b", "a b c"])
def test_clean_text_is_split_and_join(spark, raw):
    expected = " ".join((raw or "").split()).strip().lower()
    assert value(spark, T.clean_text(F.col("s")), s=(raw, "string")) == expected


@pytest.mark.parametrize("raw, number, bad", [
    ("1.5", 1.5, False), (" 1.5 ", 1.5, False), ("-", None, False), (" - ", None, False), (" -\n", None, False),
    (None, None, False), ("", None, True), ("abc", None, True), ("1.5d", None, True), ("1,5", None, True),
    ("-2", -2.0, False), ("1e3", 1000.0, False), (".5", 0.5, False), ("5.", 5.0, False), ("inf", float("inf"), False),
])
def test_numbers(spark, raw, number, bad):
    assert value(spark, N.clean_number(F.col("s")), s=(raw, "string")) == number
    assert value(spark, N.is_bad_number(F.col("s")), s=(raw, "string")) is bad


@pytest.mark.parametrize("v, base, expected", [(3.0, 2.0, 0.5), (3.0, 0.0, None), (3.0, None, None), (None, 2.0, None)])
def test_relative_change(spark, v, base, expected):
    assert value(spark, N.relative_change(F.col("v"), F.col("b")), v=(v, "double"), b=(base, "double")) == expected


def test_pct_change_of_zero_is_infinite(spark):
    assert value(spark, N.pct_change(F.col("v"), F.col("b")), v=(3.0, "double"), b=(0.0, "double")) == float("inf")
    assert value(spark, N.pct_change(F.col("v"), F.col("b")), v=(3.0, "double"), b=(None, "double")) is None


@pytest.mark.parametrize("v", [0.0, 0.005, 1.005, 2.675, 1234.5, 1234567.891, -12.3, 0.125, 0.375, 99999.995])
def test_money_as_python_formats_it(spark, v):
    expected = "R$ " + f"{v:,.2f}".translate(str.maketrans(",.", ".,"))
    assert value(spark, L.format_money(F.col("v")), v=(v, "double")) == expected


@pytest.mark.parametrize("v", [0.0, 0.0025, -0.0025, 0.0035, 0.015, -0.3333, 12.3456, 0.00049, -0.0001])
def test_change_as_python_formats_it(spark, v):
    assert value(spark, L.format_change(F.col("v")), v=(v, "double")) == f"{v * 100:+.1f}%".replace(".", ",")
    assert value(spark, L.format_difference(F.col("v")), v=(v, "double")) == f"{v * 100:.1f}%".replace(".", ",")


def test_missing_values_show_dashes(spark):
    assert value(spark, L.format_change(F.col("v")), v=(None, "double")) == "—"
    assert value(spark, L.format_difference(F.col("v")), v=(None, "double")) == "-"


def test_labels_fall_through(spark):
    assert value(spark, L.measure_label(F.col("s")), s=("custo", "string")) == "Custo"
    assert value(spark, L.measure_label(F.col("s")), s=("outro", "string")) == "outro"
    assert value(spark, L.region_label(F.col("s")), s=("centro-oeste", "string")) == "Centro-Oeste"
    assert value(spark, L.layout_label(F.col("s")), s=("pre_2025", "string")) == "Até 2025"


def test_period_label(spark):
    assert value(spark, L.format_period(F.col("d")), d=(datetime.date(2026, 4, 1), "date")) == "Abril/2026"


def test_keys_skip_nulls_and_render_flags(spark):
    import hashlib

    key = T.surrogate_key(F.lit("t"), F.col("a"), F.col("n"), F.col("b"))
    assert value(spark, key, a=(None, "string"), n=(7, "int"), b=(True, "boolean")) == hashlib.md5(b"t|7|true").hexdigest()
    path = "sul/parana/é.xlsx"
    assert value(spark, T.file_id(F.col("p")), p=(path, "string")) == hashlib.sha1(path.encode()).hexdigest()[:16]


def test_seeds(spark):
    states, months = seeds.states(spark), seeds.months(spark)
    assert states.count() == 27 and states.select("state_slug").distinct().count() == 27
    assert {r.region: r["count"] for r in states.groupBy("region").count().collect()} == {
        "norte": 7, "nordeste": 9, "centro-oeste": 4, "sudeste": 4, "sul": 3,
    }
    assert [r.month_number for r in months.orderBy("month_number").collect()] == list(range(1, 13))


def test_seed_file_reader(spark, tmp_path):
    (tmp_path / "m.csv").write_text("# note\nmonth_name,month_number\nmarco,3\n")
    assert [tuple(r) for r in seeds.read_seed(spark, str(tmp_path), seeds.MONTHS_SCHEMA).collect()] == [("marco", 3)]
