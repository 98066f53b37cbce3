"""Near-duplicate documents by fast similarity sketching, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelattice.llm import words as W
from pricelattice.llm.sets import links_within
from pricelattice.llm.steps import rooted, sharing_groups, written
from pricelattice.session import broadcast_if_small

_U = np.uint64
_FREE = np.uint64(2**64 - 1)


def sketch(items: np.ndarray, bins: int) -> np.ndarray:
    """Fast similarity sketch of a set of 64-bit items.

    In round i every item is hashed to a bin and a value; a bin keeps the least (i, value)
    that reached it.  In the first ``bins`` rounds the bin is drawn by the hash, in the next ones
    round i serves bin i - bins alone, so at the end every bin is filled.  Rounds after
    the one that fills the last bin cannot change anything and are left out.
    """
    out = np.full(bins, _FREE, np.uint64)
    if not len(items):
        return out
    at, step = 0, max(1, 512 // len(items))
    while at < 2 * bins and (out == _FREE).any():
        rounds = np.arange(at, min(at + step, 2 * bins), dtype=np.uint64)
        drawn = W.mix(items[None, :] ^ W.mix(rounds + _U(1))[:, None])
        place = (drawn >> _U(32)) % _U(bins)
        served = rounds >= _U(bins)
        place[served] = (rounds[served] - _U(bins))[:, None]
        value = (rounds[:, None] << _U(48)) | (W.mix(drawn) >> _U(16))
        np.minimum.at(out, place.ravel().astype(np.int64), value.ravel())
        at += step
    return out


def band_keys(coordinates: np.ndarray, rows: int) -> np.ndarray:
    """One key for each run of ``rows`` coordinates."""
    bands = coordinates.reshape(-1, rows)
    key = W.mix(np.arange(len(bands), dtype=np.uint64) + _U(77))
    for j in range(rows):
        key = W.mix(key ^ bands[:, j])
    return key


def _sketched(batches: Iterator[pa.RecordBatch], shingle: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.slices(batch):
            words = W.words_of(part["text"].to_pylist())
            sizes, keys, seen = [], [], {}
            for i, key in enumerate(part["key"].to_pylist()):
                if key not in seen:
                    items = W.shingles(words.hashes[words.first[i] : words.first[i + 1]], shingle)
                    seen[key] = len(items), band_keys(sketch(items, bands * rows), rows) if len(items) else items
                sizes.append(seen[key][0]), keys.append(seen[key][1])
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part["key"], part["doc_id"], pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(W.signed(flat)))],
                ["key", "doc_id", "n_shingles", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.slices(batch):
            words = W.words_of(part["text"].to_pylist())
            sets = [W.shingles(words.hashes[a:b], shingle).tobytes() for a, b in zip(words.first, words.first[1:])]
            yield pa.RecordBatch.from_arrays([part["key"], pa.array(sets, pa.binary())], ["node", "items"])


def near_duplicates(
    docs: DataFrame, percent: int = 75, shingle: int = 5, bands: int = 32, rows: int = 3, text_col: str = "text",
    id_col: str = "doc_id", with_group: bool = False,
) -> DataFrame:
    """Classes of documents linked by 100 * |A and B| >= percent * |A or B| over word shingles.

    Words are runs of anything but ASCII white space with A-Z lowered; a document of fewer than
    ``shingle`` words is one shingle.  Returns one row per input row: all its columns, n_shingles, component_id
    (least id that can be reached over links) and kept (id = component_id).  A document without text
    or words is linked with nothing.  Repeated ids are separate rows; a component of null ids
    only has a null component_id and its rows are kept.

    Ids need not tell components apart: with ``with_group`` two more columns do, _group (null without text or words) and
    _leads (the row has id and text of the component's first: the least id, null last, and of its texts the least hash;
    true without text or words).  Rows equal in id and text lead together.

    Equal texts are one node.  With 32 bands of 3 coordinates a pair at the threshold is missed
    with probability (1 - 0.75**3)**32 < 3e-8; candidates are verified on the full sets.
    """
    spark = docs.sparkSession
    # the columns of docs may have any names, those of the steps here included
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    keyed = docs.toDF(*place.values()).withColumn("_key", F.unhex(F.md5(F.col(place[text_col]).cast("binary"))))
    narrow = keyed.select(F.col("_key").alias("key"), F.col(place[id_col]).alias("doc_id"), F.col(place[text_col]).alias("text"))
    ids = docs.schema[id_col].dataType.simpleString()
    classes = written(
        narrow.mapInArrow(
            lambda batches: _sketched(batches, shingle, bands, rows),
            f"key binary, doc_id {ids}, n_shingles long, bands array<long>",
        ).where("n_shingles > 0").groupBy("key").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")
        ),
        "sketches",
    )
    groups = sharing_groups(classes.select(F.explode("bands").alias("bucket"), F.col("key").alias("node")), "near")
    nodes = groups.select("node").distinct()
    wanted = classes.select("key", "doc_id").join(nodes.withColumnRenamed("node", "key"), "key")
    wanted = broadcast_if_small(wanted.select(F.col("key").alias("_key"), F.col("doc_id").alias("_least")), written=True)
    found = keyed.join(wanted, "_key").where(F.col(place[id_col]).eqNullSafe(F.col("_least")))
    sets = written(
        found.select(F.col("_key").alias("key"), F.col(place[text_col]).alias("text")).mapInArrow(
            lambda batches: _sets(batches, shingle), "node binary, items binary"
        ).dropDuplicates(["node"]), "sets",
    )
    roots = rooted(nodes, written(links_within(groups, sets, percent), "near-links"), "near")
    named = classes.select("key", "doc_id", "n_shingles").join(roots.withColumnRenamed("node", "key"), "key", "left")
    named = written(named.withColumn("root", F.coalesce("root", "key")), "near-classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("first")
    named = named.join(named.groupBy("root").agg(first), "root").select(
        F.col("key").alias("_key"), F.col("n_shingles").alias("_n"), F.col("first.doc_id").alias("_c"),
        F.col("root").alias("_root"), F.col("first.key").alias("_first"),
    )
    own = F.col("_n").isNull()
    id_ = F.col(place[id_col])
    leads = (F.col("_key") == F.col("_first")) & id_.eqNullSafe(F.col("_c"))
    added = {
        "n_shingles": F.coalesce("_n", F.lit(0)).cast("long"),
        "component_id": F.when(own, id_).otherwise(F.col("_c")), "kept": F.when(own, True).otherwise(id_.eqNullSafe(F.col("_c"))),
    }
    if with_group:
        added |= {"_group": F.col("_root"), "_leads": F.when(own, True).otherwise(leads)}
    return keyed.join(named, "_key", "left").select(
        *[F.col(p).alias(c) for c, p in place.items() if c not in added], *[value.alias(c) for c, value in added.items()]
    )
