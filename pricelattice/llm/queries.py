"""Registered queries of the subpackage: name -> function of (session, folder of input tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelattice.llm import language, quality_crf
from pricelattice.llm.decontaminate import find_contamination
from pricelattice.llm.fill_in_middle import digests, fill_in_middle, store_frames
from pricelattice.llm.grammar import read_ids, write_ids
from pricelattice.llm.link_trust import Rule, judge_urls
from pricelattice.llm.near_dedup import near_duplicates
from pricelattice.llm.packing import pack
from pricelattice.llm.passage_dedup import repeated_passages
from pricelattice.llm.prefix_trie import numbered_turns, prefix_trie, rebuilt
from pricelattice.llm.sharding import assign_shards
from pricelattice.llm.steps import written
from pricelattice.llm.topk import exact_top_k
from pricelattice.llm.warc_fixity import audit, record_index, warc_record
from pricelattice.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLE[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"), 24, columns=["doc_id"])


URL_RULES = [
    Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]


@query("op8_url_filter")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = language.held_out(F.col("doc_id"), 4, 2)
    model = quality_crf.learn(docs.where(~out), table(spark, sf_dir, "labels").where(~out))
    found = quality_crf.score_quality(docs, model, carry=["doc_id"])
    return found.select("doc_id", out.alias("held_out"), "score", "predicted")


@query("op10_language")
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language.held_out(F.col("doc_id"), 3, 1)
    found = language.identify(docs, language.learn_dictionaries(docs.where(~out)), carry=["doc_id"])
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


@query("op4_passage_dedup")
def op4_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document that repeats a passage of another: the word ranges to cut, and who keeps them."""
    found = repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "gone", "kept_in", F.size("kept_in").cast("long").alias("n_keepers"))


_TOP_K_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND vec_id IS NOT NULL
), scored AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""


@query("op5_top_k", _TOP_K_SQL)
def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return exact_top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


#: 103 bytes of a record are neither its URI, id, length nor payload.
_FIXITY_SQL = """
WITH damage AS (
    SELECT *, coalesce(html, '') AS body, ('0x' || substr(md5(page_id::VARCHAR), 1, 6))::BIGINT % 97 AS fate FROM pages
), bodies AS (
    SELECT *, CASE fate
        WHEN 0 THEN substr(body, 1, length(body) // 2) || '~' || substr(body, length(body) // 2 + 2)
        WHEN 1 THEN substr(body, 1, length(body) // 3) ELSE body END AS other
    FROM damage
), records AS (
    SELECT page_id, url, body, other, coalesce(fate = 2, false) AS lost, octet_length(encode(body)) AS n, octet_length(encode(other)) AS m,
        103 + octet_length(encode(coalesce(url, ''))) + length(coalesce(page_id::VARCHAR, '')) AS head
    FROM bodies
), sized AS (
    SELECT *, (head + n + length(n::VARCHAR))::BIGINT AS length, (head + m + length(m::VARCHAR))::BIGINT AS replica,
        row_number() OVER (ORDER BY page_id NULLS FIRST, url NULLS FIRST) - 1 AS nth
    FROM records
), placed AS (
    SELECT *, (nth // 1000)::BIGINT AS file,
        coalesce(sum(length) OVER (PARTITION BY nth // 1000 ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
    FROM sized
)
SELECT page_id, file, place AS "offset",
    CASE WHEN lost THEN 'missing' WHEN length <> replica THEN 'length' ELSE 'changed' END AS kind, length,
    CASE WHEN lost THEN NULL ELSE replica END AS replica_length
FROM placed WHERE lost OR body <> other
"""


@query("op6_warc_fixity", _FIXITY_SQL)
def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as WARC files, and a replica of them in which about three records in 97 are flipped, cut or lost."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    fate = F.conv(F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 6), 16, 10).cast("long") % 97
    half, third = F.floor(F.length("html") / 2).cast("int"), F.floor(F.length("html") / 3).cast("int")
    flipped = F.concat(F.substring("html", F.lit(1), half), F.lit("~"), F.substring("html", half + 2, F.length("html")))
    other = F.when(fate == 0, flipped).when(fate == 1, F.substring("html", F.lit(1), third)).otherwise(F.col("html"))
    both = pages.select(
        "page_id", "url", warc_record(F.col("url"), F.col("page_id"), F.col("html")).alias("record"),
        warc_record(F.col("url"), F.col("page_id"), other).alias("other"), F.coalesce(fate == 2, F.lit(False)).alias("lost"),
    )
    copied = both.select(
        "page_id", "url", "record", F.octet_length("other").cast("long").alias("n"), F.sha2("other", 256).alias("d"), "lost"
    )
    index = written(record_index(copied, ["page_id", "url"]), "record-index")
    replica = index.where("not lost").select("file", "offset", F.col("n").alias("length"), F.col("d").alias("digest"))
    return audit(index, replica, carry=["page_id"])


@query("op7_near_dedup")
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


@query("op13_grammar_ids")
def op13_grammar_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents, written as Re-Pair grammar files and read back from them."""
    return read_ids(write_ids(table(spark, sf_dir, "documents").select("doc_id", "text")))


_MIDDLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents
), h AS (
    SELECT doc_id, t, length(t) AS n, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2, ('0x' || s[17:24])::BIGINT AS h3,
        ('0x' || s[25:32])::BIGINT AS h4 FROM d
), c AS (
    SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h
), o AS (
    SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
        ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END AS o FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a::BIGINT END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN (b - a)::BIGINT END AS middle_chars, sha256(o) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN o
        WHEN 'psm' THEN split_part(split_part(o, '<S>', 1), '<P>', 2) || split_part(o, '<M>', 2) || split_part(split_part(o, '<S>', 2), '<M>', 1)
        ELSE split_part(split_part(o, '<P>', 2), '<M>', 1) || split_part(o, '<M>', 2) || split_part(split_part(o, '<P>', 1), '<S>', 2)
    END) AS restored_sha256 FROM o
"""


@query("op11_fill_in_middle", _MIDDLE_SQL)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples of the documents, built from their frames, and their digests."""
    frames = store_frames(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return digests(fill_in_middle(frames)).withColumnRenamed("id", "doc_id")


_TRIE_SQL = """
WITH t AS (
    SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), c AS (
    SELECT c, count(*) AS n, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''),
        lambda ch: ascii(ch)::BIGINT)), lambda s, b: list_reduce(list_concat([xor(s, b)], range(8)), lambda v, i:
        xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END)))) % 6 AS h
    FROM t GROUP BY c
), p AS (
    SELECT c.c, b.pos AS d, b.r, b.x FROM c JOIN t b ON b.c = c.c - c.c % 100 AND b.pos <= c.h
    UNION ALL
    SELECT c.c, least(c.h, coalesce(b.n, 0)) + t.pos - c.h, t.r, t.x FROM c JOIN t ON t.c = c.c LEFT JOIN c b ON b.c = c.c - c.c % 100 WHERE t.pos > c.h
    UNION ALL
    SELECT c, 0, '', '' FROM c
), k AS (
    SELECT c, d, length(x) AS chars, md5(string_agg(md5(r) || md5(x), '') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)) AS k,
        max(d) OVER (PARTITION BY c) AS m FROM p
), v AS (
    SELECT k, d, min(c) AS conv, count(*) AS n, any_value(chars) AS chars, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (m = d), '')) AS ends
    FROM k GROUP BY k, d
), e AS (SELECT DISTINCT a.k, a.d, b.k AS up FROM k a JOIN k b ON a.c = b.c AND b.d = a.d - 1
), w AS (SELECT v.*, (SELECT count(*) FROM e WHERE e.up = v.k AND e.d = v.d + 1) AS children FROM v
), s AS (
    SELECT a.k, a.d, sum((w.n - 1) * w.chars)::BIGINT AS saved, count(*) FILTER (w.children = 0) AS leaves
    FROM w JOIN k a ON a.c = w.conv AND a.d <= w.d GROUP BY a.k, a.d
)
SELECT w.conv AS conv_id, w.d::BIGINT AS depth, u.conv AS parent_conv_id, w.n AS n_convs, w.children AS n_children, s.leaves AS n_leaves,
    s.saved AS saved_tokens, w.ends AS ends_sha256
FROM w JOIN s USING (k, d) LEFT JOIN e USING (k, d) LEFT JOIN v u ON u.k = e.up AND u.d = e.d - 1
"""


@query("op12_prefix_trie", _TRIE_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of conversations, each begun by the first of its hundred."""
    return prefix_trie(rebuilt(numbered_turns(table(spark, sf_dir, "conversations"))))
