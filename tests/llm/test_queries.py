"""The registered queries and the pipeline over the test tables."""

import collections
import zlib

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from pricelattice.llm.packing import default_tokenizer, encode
from test_operators import contaminated, plain_components, shingle_set

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", ["op5_top_k", "op6_warc_fixity"])
def test_against_duckdb(spark, name):
    assert compare.compare(spark, compare.connect(SF), SF, name) is None


COLUMNS = {
    "op1_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op2_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op3_sharding": "doc_id size text_crc32 law shard slot grown_shard", "op4_passage_dedup": "doc_id gone kept_in",
    "op7_near_dedup": "doc_id n_shingles component_id kept", "op8_url_filter": "page_id host path rule verdict",
    "op9_quality": "doc_id held_out score predicted", "op10_language": "doc_id held_out lang_pred score",
    "op11_fill_in_middle": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_grammar_ids": "doc_id start n_tokens ids_crc32",
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns(spark, name):
    found = entry.queries()[name](spark, "/root/testdata/sf0.001")
    assert set(COLUMNS[name].split()) <= set(found.columns)
    assert found.count() > 0


def all_components(rows):
    """Brute force, with the documents that share no shingle with another left out of the pairs."""
    sets = {i: shingle_set(t) for i, t in rows}
    holders = collections.defaultdict(list)
    for i, items in sets.items():
        for item in items:
            holders[item].append(i)
    near = {p for h in holders.values() for p in h if len(h) > 1}
    alone = collections.Counter((i, len(sets[i]), i, True) for i, _ in rows if i not in near)
    return alone + plain_components([r for r in rows if r[0] in near])


def test_near_dedup_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = collections.Counter(tuple(r) for r in entry.queries()["op7_near_dedup"](spark, SF).collect())
    assert got == all_components(rows)


def test_learning_reads_no_held_out_rows(spark, tmp_path):
    """Wrong labels on the held-out rows change nothing."""
    for table in ("documents", "labels"):
        df = spark.read.parquet(f"{SF}/{table}.parquet")
        rest = lambda n, k: F.crc32(F.col("doc_id").cast("string").cast("binary")) % n == k
        if table == "documents":
            df = df.withColumn("lang", F.when(rest(3, 1), F.lit("xx")).otherwise(F.col("lang")))
        else:
            df = df.withColumn("quality", F.when(rest(4, 2), 1 - F.col("quality")).otherwise(F.col("quality")))
        df.write.parquet(str(tmp_path / f"{table}.parquet"))
    for name in ("op9_quality", "op10_language"):
        one, two = (sorted(map(tuple, entry.queries()[name](spark, d).collect())) for d in (SF, str(tmp_path)))
        assert one == two


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, SF), "test-stage")
        if name != "packing":
            assert docs.columns == before.columns
        old, new = ({r.doc_id: r.text for r in d.select("doc_id", "text").collect()} if "text" in d.columns else None for d in (before, docs))
        if name == "language":
            assert len(new) > 0.97 * len(old) and new.items() <= old.items()
        elif name == "near_duplicates":
            assert set(new) == {d for d, _, _, kept in all_components(list(old.items())) if kept} and new.items() <= old.items()
        elif name == "repeated_passages":
            windows = collections.defaultdict(set)
            for i, t in new.items():
                words = (t or "").encode().lower().split()
                for at in range(len(words) - 50):
                    windows[tuple(words[at : at + 51])].add(i)
            assert all(len(v) == 1 for v in windows.values())  # no repeat of 51 words is left
        elif name == "contamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(new) == {i for i, *_, bad in contaminated(list(old.items()), items) if not bad}
        else:
            pieces = collections.defaultdict(bytes)
            for r in sorted(docs.collect(), key=lambda r: (r.doc_id, r.start)):
                assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
                pieces[r.doc_id] += bytes(r.ids)
            ids = list(old)
            assert pieces == {i: code + b"\x02\0\0\0" for i, code in zip(ids, encode([old[i] for i in ids], default_tokenizer()))}


def test_one_of_each_group_whatever_the_ids(spark):
    """Repeated ids on different texts, copies without ids, and rows without words next to a text of the same id."""
    text = lambda seed: " ".join(f"w{seed}x{i}" for i in range(60))
    near = lambda seed: text(seed).replace(f"w{seed}x59", "edited")
    rows = [(5, text(1)), (5, text(2)), (5, text(2)), (5, ""), (5, None), (5, None), (None, text(3)), (None, text(3)), (None, near(3)),
            (6, text(4)), (6, near(4)), (7, near(4)), (None, text(4)), (8, text(1)), (None, text(5)), (None, None), (9, " \n"), (6, text(6))]
    groups = collections.defaultdict(list)
    for i, t in rows:
        same = next((g for g in groups if g and (a := shingle_set(g)) and 4 * len(a & shingle_set(t)) >= 3 * len(a | shingle_set(t))), t)
        groups[same if shingle_set(t) else None].append((i, t))
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], DOCS)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_each_group(spark, docs, SF).collect()]
    assert collections.Counter(r for r in got if not shingle_set(r[1])) == collections.Counter(groups.pop(None))
    assert len([r for r in got if shingle_set(r[1])]) == len(groups) == 6
    for members in groups.values():
        ids = [i for i, _ in members if i is not None]
        assert [r[0] for r in got if r in members] == [min(ids, default=None)]


def test_stages_on_odd_tables(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "en", None, None), (1, text, "en", None, None), (None, text, None, "s", 1), (2, None, None, None, None), (3, "", "de", "s", 0),
            (4, "le la les de des " * 30, "fr", "s", 1), (None, None, None, None, None), (5, "x " * 40_000, "en", "s", 1)]
    for docs in (spark.createDataFrame(rows, DOCS), spark.createDataFrame([], DOCS)):
        for name, stage in corpus_pipeline.STAGES:  # every stage on the whole odd table
            out = stage(spark, docs, SF)
            assert out.count() <= max(len(rows), 40) and (name == "packing" or out.columns == docs.columns)


def test_without_language_labels_no_document_goes(spark):
    docs = spark.createDataFrame([(1, "some text", None, None, None), (2, None, None, "s", 1)], DOCS)
    assert sorted(r.doc_id for r in corpus_pipeline.keep_known_languages(spark, docs, SF).collect()) == [1, 2]
