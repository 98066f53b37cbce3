"""Benchmark decontamination: an FM-index of each training shard is searched for benchmark windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelattice.llm import words as W
from pricelattice.llm.fm_index import FMIndex
from pricelattice.llm.steps import written

#: Symbols in one index; a shard of more is indexed in pieces that overlap by a window.
INDEX_SYMBOLS = 1 << 20
#: Bytes of text in a shard, which bounds a task's memory: hashes, suffixes and ranks take some sixty bytes a word.
SHARD = 2 << 20
_FOUND = "n_words long, hits array<int>, spans array<struct<start:int,stop:int>>, items array<string>"


@dataclass
class Phrases:
    """A block of windows (rows of word hashes, padded) and the items each belongs to."""

    hashes: np.ndarray
    lengths: np.ndarray
    first: np.ndarray  # items of phrase i: items[first[i]:first[i + 1]]
    items: np.ndarray


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in W.slices(whole)):
        words = W.words_of(batch["text"].to_pylist(), W.ALPHANUMERIC)
        phrases, items = [], []
        for item, a, b in zip(batch["item"].to_pylist(), words.first, words.first[1:]):
            own = words.hashes[a:b]
            length = min(size, len(own))
            if length:
                found = {own[i : i + length].tobytes() for i in range(len(own) - length + 1)}
                phrases.extend(found), items.extend([item] * len(found))
        yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.binary()), pa.array(items, pa.string())], ["phrase", "item"])


def benchmark_windows(benchmark: DataFrame, size: int = 13, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (phrase, item): every run of ``size`` words, or the whole of an item of fewer."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda batches: _windows(batches, size), "phrase binary, item string").distinct()


def _block(rows: list, size: int) -> Phrases:
    by_phrase: dict[bytes, list[str]] = {}
    for phrase, item in rows:
        by_phrase.setdefault(bytes(phrase), []).append(item)
    hashes, lengths = np.zeros((len(by_phrase), size), np.uint64), np.zeros(len(by_phrase), np.int64)
    for i, phrase in enumerate(by_phrase):
        lengths[i] = len(phrase) // 8
        hashes[i, : lengths[i]] = np.frombuffer(phrase, np.uint64)
    counts = [len(items) for items in by_phrase.values()]
    items = np.array([item for items in by_phrase.values() for item in items], dtype=object)
    return Phrases(hashes, lengths, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), items)


def occurrences(words: W.Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Every occurrence of a phrase within a text: (first word, phrase)."""
    none = np.zeros(0, np.int64)
    if not len(words.hashes) or not len(phrases.lengths):
        return none, none
    vocabulary, symbols = np.unique(words.hashes, return_inverse=True)
    place = np.minimum(np.searchsorted(vocabulary, phrases.hashes), len(vocabulary) - 1)
    padding = np.arange(phrases.hashes.shape[1]) >= phrases.lengths[:, None]
    known = np.flatnonzero(((vocabulary[place] == phrases.hashes) | padding).all(axis=1))
    if not len(known):
        return none, none
    patterns, lengths = place[known] + 2, phrases.lengths[known]
    # the shard: its texts one after the other, symbol 1 behind each
    counts = np.diff(words.first)
    shard = np.ones(len(symbols) + len(counts), np.int64)
    shard[np.arange(len(symbols)) + np.repeat(np.arange(len(counts)), counts)] = symbols + 2
    starts, which = [none], [none]
    for at in range(0, len(shard), INDEX_SYMBOLS):
        index = FMIndex(shard[at : at + INDEX_SYMBOLS + int(lengths.max()) - 1])
        low, high = index.ranges(patterns, lengths)
        found = high - low
        rows = np.repeat(low - np.cumsum(found) + found, found) + np.arange(found.sum())
        starts.append(index.locate(rows) + at), which.append(np.repeat(known, found))
    starts, which = np.concatenate(starts), np.concatenate(which)
    marks_before = np.cumsum(shard == 1)
    return starts - marks_before[starts], which


def _searched(batches: Iterator[pa.RecordBatch], phrases: Phrases) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in W.slices(whole, SHARD)):
        words = W.words_of(batch["text"].to_pylist(), W.ALPHANUMERIC)
        starts, which = occurrences(words, phrases)
        first, rows = words.first, batch.num_rows
        cover = np.zeros(len(words.hashes) + 1, np.int64)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + phrases.lengths[which], -1)
        doc = np.searchsorted(first, starts, side="right") - 1
        pairs = np.unique(np.stack([doc, which]), axis=1) if len(doc) else np.zeros((2, 0), np.int64)
        cut = np.searchsorted(pairs[0], np.arange(rows + 1))
        hits, spans, items = [], [], []
        for i in range(rows):
            old, named = batch["hits"][i].as_py(), set(batch["items"][i].as_py())
            if cut[i] == cut[i + 1] and not old:
                hits.append([]), spans.append([]), items.append([])
                continue
            covered = np.cumsum(cover[first[i] : first[i + 1]]) > 0
            for a, b in zip(old[0::2], old[1::2]):
                covered[a:b] = True
            turns = np.flatnonzero(np.diff(covered, prepend=False, append=False))
            for p in pairs[1, cut[i] : cut[i + 1]]:
                named.update(phrases.items[phrases.first[p] : phrases.first[p + 1]])
            begin = words.begins[i]
            raw = np.frombuffer(words.data, np.uint8, words.begins[i + 1] - begin, begin)
            chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            a = chars[words.starts[first[i] + turns[0::2]] - begin]
            b = chars[words.ends[first[i] + turns[1::2] - 1] - begin]
            hits.append(turns.tolist()), items.append(sorted(named))
            spans.append([{"start": x, "stop": y} for x, y in zip(a.tolist(), b.tolist())])
        yield pa.RecordBatch.from_arrays(
            [batch["text"], *(batch[n] for n in batch.schema.names if n[0] == "c"), pa.array(np.diff(first), pa.int64()),
             pa.array(hits, pa.list_(pa.int32())),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
             pa.array(items, pa.list_(pa.string()))],
            ["text", *(n for n in batch.schema.names if n[0] == "c"), "n_words", "hits", "spans", "items"],
        )


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = 13, text_col: str = "text", block: int = 500_000,
    carry: list[str] | None = None,
) -> DataFrame:
    """Where benchmark windows occur in each document.

    Words are runs of a-z, 0-9 and non-ASCII characters with A-Z lowered, equal if their 64-bit hashes are.  A window is ``size`` words of
    an item, or all of an item of fewer.  Returns the ``carry`` columns (default: all, the result's names replaced)
    and n_words, n_hit (words inside an occurrence), items (their ids as strings, sorted; a null id is ''),
    spans (the occurrences merged, as character positions) and contaminated (n_hit > 0 and 20 * n_hit >= n_words).
    A null or wordless text has no words and is clean; without windows every document is.

    A slice of documents is one shard with one index in memory.  Windows go to the tasks in blocks of
    ``block`` (window, item) pairs at most; more blocks mean further passes over the documents.
    """
    spark = docs.sparkSession
    windows = written(benchmark_windows(benchmark, size), "windows")
    blocks = max(1, -(-windows.count() // block))
    added = ["n_words", "n_hit", "items", "spans", "contaminated"]
    kept = [c for c in carry or docs.columns if c not in added]
    place = [f"c{i}" for i in range(len(kept))]
    kinds = "".join(f"{p} {docs.schema[c].dataType.simpleString()}, " for p, c in zip(place, kept))
    found = docs.select(
        F.col(text_col).alias("text"), *[F.col(c).alias(p) for p, c in zip(place, kept)],
        F.array().cast("array<int>").alias("hits"), F.array().cast("array<string>").alias("items"),
    )
    for n in range(blocks):
        rows = windows.where(F.pmod(F.xxhash64("phrase", "item"), F.lit(blocks)) == n).collect()
        phrases = spark.sparkContext.broadcast(_block(rows, size))
        found = found.select("text", *place, "hits", "items").mapInArrow(
            lambda batches, phrases=phrases: _searched(batches, phrases.value), f"text string, {kinds}{_FOUND}"
        )
    hit = F.aggregate(
        F.sequence(F.lit(0), F.size("hits") - 2, F.lit(2)), F.lit(0),
        lambda total, i: total + F.get(F.col("hits"), i + 1) - F.get(F.col("hits"), i),
    )
    found = found.withColumn("n_hit", F.when(F.size("hits") > 0, hit).otherwise(0).cast("long"))
    return found.select(
        *[F.col(p).alias(c) for p, c in zip(place, kept)], "n_words", "n_hit", "items", "spans",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
