"""Documents to training sequences: a chain of stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame: the columns of documents,
without the rows or passages that the stage removes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelattice.llm import language
from pricelattice.llm.decontaminate import find_contamination
from pricelattice.llm.near_dedup import near_duplicates
from pricelattice.llm.packing import pack
from pricelattice.llm.passage_dedup import remove_repeats
from pricelattice.llm.steps import written
from pricelattice.session import broadcast_if_small, tune


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the dictionaries tell; null or letterless texts and ties between languages go.

    A table without language labels teaches nothing; then nothing can be judged, and all documents stay.
    """
    tune(spark)
    dictionaries = language.learn_dictionaries(docs.where(~language.held_out(F.col("doc_id"), 3, 1)))
    if not dictionaries:
        return docs
    # the columns of docs may bear names of the result
    place = numbered_names(docs)
    found = language.identify(docs.toDF(*place.values()), dictionaries, text_col=place["text"], carry=list(place.values()))
    return found.where("not rejected").select(*place.values()).toDF(*docs.columns)


def numbered_names(docs: DataFrame) -> dict[str, str]:
    """Column -> a name that no step uses."""
    return {c: f"c{i}" for i, c in enumerate(docs.columns)}


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the least id, a row without an id last.

    Of the texts that share this id and the group the one of the least hash stays, of equal rows one.
    Rows without words are in no group and stay.
    """
    tune(spark)
    place = numbered_names(docs)
    rows = docs.toDF(*place.values()).withColumns({"_doc": F.col(place["doc_id"]), "_hash": F.xxhash64(place["text"])})
    named = rows.select(F.col("_doc").alias("doc_id"), F.col(place["text"]).alias("text"), "_hash")
    found = near_duplicates(named, with_group=True).select("doc_id", "_hash", "_group", "_leads")
    found = written(found, "near-decisions")
    kept = without(rows, found.where("not _leads"))
    leading = found.where("_leads and _group is not null").groupBy("_group", "doc_id", "_hash").agg(F.count("*").alias("n"))
    twins = written(leading.where("n > 1").drop("n"), "twins")
    if twins.isEmpty():
        return kept.select(*place.values()).toDF(*docs.columns)
    again = twins.select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_key"), "_group")
    double = kept.join(again, F.col("_doc").eqNullSafe(F.col("_id")) & F.col("_hash").eqNullSafe(F.col("_key")))
    one = double.dropDuplicates(["_group"]).select(*place.values())
    return without(kept, twins).select(*place.values()).union(one).toDF(*docs.columns)


def without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Documents whose id and text (_doc, _hash) are not among ``rows`` (doc_id, hash of the text)."""
    rows = rows.select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_key")).distinct()
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_key"))
    return docs.join(broadcast_if_small(rows, written=True), same, "left_anti")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; a document of nothing else goes."""
    tune(spark)
    place = numbered_names(docs)
    cut = remove_repeats(docs.toDF(*place.values()), id_col=place["doc_id"], text_col=place["text"])
    emptied = (F.size("spans") > 0) & (F.length(F.trim(F.coalesce(place["text"], F.lit("")))) == 0)
    return cut.where(~emptied).select(*place.values()).toDF(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least a twentieth is benchmark windows go."""
    benchmark = tune(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    place = numbered_names(docs)
    found = find_contamination(docs.toDF(*place.values()), benchmark, text_col=place["text"], carry=list(place.values()))
    return found.where("not contaminated").select(*place.values()).toDF(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their ids."""
    tune(spark)
    return pack(docs, with_ids=True, keep_cache=False)


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each_group),
    ("repeated_passages", cut_repeated_passages),
    ("contamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: No SQL: compressors, sketches, suffix indexes and column generation are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
