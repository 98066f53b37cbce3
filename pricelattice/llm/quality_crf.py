"""Document quality by a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelattice.llm import words as W
from pricelattice.session import broadcast_if_small

_B = np.arange(256)
_among = lambda chars: np.isin(_B, list(chars.encode()))
_CLASSES = {
    "upper": (_B >= 65) & (_B <= 90), "digit": (_B >= 48) & (_B <= 57), "high": _B >= 128,
    "symbol": _among("#$%&*<>=+@^~`\\/_[]{}"), "punctuation": _among(".,;:?'\"()-"), "bar": _among("|"), "bang": _among("!"),
}
#: Edges of the bins of each feature of a line.
EDGES = {
    "words": [1, 2, 4, 8, 16, 32, 64], "word_bytes": [2, 3, 4, 5, 6, 8, 12], "upper": [0.005, 0.02, 0.05, 0.1, 0.3, 0.6],
    "digit": [0.001, 0.02, 0.05, 0.1, 0.3], "high": [0.001, 0.02, 0.05, 0.1, 0.3],
    "symbol": [0.001, 0.01, 0.03, 0.06, 0.1, 0.2], "punctuation": [0.001, 0.01, 0.02, 0.04, 0.07, 0.1, 0.2],
    "bar": [0.001, 0.02, 0.05], "bang": [0.001, 0.02, 0.05, 0.1], "distinct": [0.3, 0.5, 0.7, 0.8, 0.9, 0.95, 0.999],
    "stutter": [0.001, 0.05, 0.2, 0.5], "closed": [0.5], "repeated": [0.5], "lines": [2, 3, 5, 9, 17, 33],
}
_SIZES = np.array([len(e) + 1 for e in EDGES.values()])
_OFFSETS = np.cumsum(_SIZES) - _SIZES
_ONE = int(_SIZES.sum())
#: Bins of the line itself, of the line before and of the line after; the last two have one more for no such line.
N_FEATURES = 3 * _ONE + 2


@dataclass
class Lines:
    """Lines of several documents end to end: active features, bytes, and the first line of each document."""

    features: np.ndarray
    lengths: np.ndarray
    first: np.ndarray


def lines_of(texts: list[str | None]) -> Lines:
    """Features of every line; a null or empty text is one empty line."""
    words = W.words_of(texts)
    raw = np.frombuffer(words.data, np.uint8)
    n_docs = len(texts)
    is_end = raw == 10
    is_end[words.begins[1:] - 1] = True  # the separator behind each text
    ends = np.flatnonzero(is_end)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    first = np.searchsorted(starts, words.begins)
    lengths, size = ends - starts, np.maximum(ends - starts, 1)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    n = len(starts)
    line = np.searchsorted(starts, words.starts, side="right") - 1
    count = np.bincount(line, minlength=n)
    some = np.maximum(count, 1)
    value = {"words": count, "word_bytes": np.bincount(line, words.ends - words.starts, n) / some}
    for name, among in _CLASSES.items():
        before = np.concatenate([[0], np.cumsum(among[raw], dtype=np.int64)])
        value[name] = (before[ends] - before[starts]) / size
    order = np.lexsort((words.hashes, line))
    h, l = words.hashes[order], line[order]
    again = (h[1:] == h[:-1]) & (l[1:] == l[:-1])
    value["distinct"] = 1 - np.bincount(l[1:][again], minlength=n) / some
    same = (words.hashes[1:] == words.hashes[:-1]) & (line[1:] == line[:-1])
    value["stutter"] = np.bincount(line[1:][same], minlength=n) / some
    value["closed"] = np.isin(raw[np.maximum(ends - 1, 0)], list(b".!?")) & (lengths > 0)
    # a line's hash: its words with their places
    place = np.arange(len(line)) - np.searchsorted(line, line)
    total = np.zeros(n, np.uint64)
    np.add.at(total, line, W.mix(words.hashes + place.astype(np.uint64)))
    total = W.mix(total ^ W.mix(doc.astype(np.uint64)))
    _, inverse, times = np.unique(total, return_inverse=True, return_counts=True)
    value["repeated"] = (times[inverse] > 1) & (count > 0)
    value["lines"] = np.repeat(np.diff(first), np.diff(first))
    own = np.stack([np.searchsorted(e, value[name], side="right") for name, e in EDGES.items()], axis=1) + _OFFSETS
    before, after = np.roll(own, 1, axis=0) + _ONE, np.roll(own, -1, axis=0) + 2 * _ONE
    before[first[:-1]], after[first[1:] - 1] = 3 * _ONE, 3 * _ONE + 1
    return Lines(np.concatenate([own, before, after], axis=1).astype(np.int32), lengths, first)


@dataclass
class Model:
    """Weights for 'good' of each feature, and of each pair of neighbouring labels (bad, good)."""

    weights: np.ndarray
    steps: np.ndarray


def marginals(model: Model, lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line, and the expected counts of neighbouring labels, by forward-backward.

    All documents go on together, the longest first, one line at a time.
    """
    evidence = model.weights[lines.features].sum(axis=1)
    emit = np.stack([np.zeros_like(evidence), evidence], axis=1)
    counts = np.diff(lines.first)
    by_length = np.argsort(-counts, kind="stable")
    begin, counts = lines.first[:-1][by_length], counts[by_length]
    forward, backward = emit.copy(), np.zeros_like(emit)
    longest = int(counts.max(initial=0))
    alive = np.searchsorted(-counts, -np.arange(longest + 1), side="left")  # documents with more than t lines
    for t in range(1, longest):
        at = begin[: alive[t]] + t
        forward[at] += np.logaddexp(forward[at - 1, :1] + model.steps[0], forward[at - 1, 1:] + model.steps[1])
    pairs = np.zeros((2, 2))
    for t in range(longest - 1, 0, -1):
        at = begin[: alive[t]] + t
        here = backward[at] + emit[at]
        backward[at - 1] = np.logaddexp(here[:, :1] + model.steps[:, 0], here[:, 1:] + model.steps[:, 1])
        joint = forward[at - 1][:, :, None] + model.steps + here[:, None, :]
        joint -= joint.max(axis=(1, 2), keepdims=True)
        joint = np.exp(joint)
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    lead = forward + backward
    return 1 / (1 + np.exp(np.clip(lead[:, 0] - lead[:, 1], -500, 500))), pairs


def fit(lines: Lines, labels: np.ndarray, rounds: int = 80, rate: float = 0.1, ridge: float = 2e-4) -> Model:
    """Maximum likelihood by Adam; every line of a document bears the document's label."""
    model = Model(np.zeros(N_FEATURES), np.zeros((2, 2)))
    counts = np.diff(lines.first)
    truth = np.repeat(labels, counts).astype(float)
    inner = np.maximum(counts - 1, 0)
    seen = np.array([[inner[labels == 0].sum(), 0], [0, inner[labels == 1].sum()]], float)
    flat = lines.features.ravel()
    first, second = np.zeros(N_FEATURES + 4), np.zeros(N_FEATURES + 4)
    for turn in range(1, rounds + 1):
        good, pairs = marginals(model, lines)
        miss = np.repeat(truth - good, lines.features.shape[1])
        slope = np.concatenate([np.bincount(flat, miss, N_FEATURES), (seen - pairs).ravel()]) / len(counts)
        slope -= ridge * np.concatenate([model.weights, model.steps.ravel()])
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = rate * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
        model = Model(model.weights + move[:N_FEATURES], model.steps + move[N_FEATURES:].reshape(2, 2))
    return model


def learn(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    documents: int = 4_000, bytes_in_all: int = 16_000_000,
) -> Model:
    """Fit on a bounded sample of the labelled documents: ``documents`` at most, of ``bytes_in_all`` together.

    Drawn by the hash of the id; a document that would pass the byte limit is left out.  Null ids or labels teach
    nothing; an id labelled twice counts once, as the lesser label.  Without examples the model is
    all zeros and every score is one half.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.min(label_col).cast("int").alias("_label")
    )
    drawn = known.orderBy(F.xxhash64("_id"), "_id").limit(documents)
    drawn = broadcast_if_small(drawn, written=True)
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(drawn, F.col("id") == F.col("_id"))
    sizes = found.select("_id", F.octet_length(F.coalesce("text", F.lit(""))).alias("n")).dropDuplicates(["_id"])
    chosen, room = [], bytes_in_all
    for row in sorted(sizes.limit(documents).collect(), key=lambda r: (r["n"], str(r["_id"]))):
        if row["n"] <= room:
            chosen.append(row["_id"])
            room -= row["n"]
    rows = found.where(F.col("_id").isin(chosen)).select("_id", "_label", "text") if chosen else None
    rows = sorted(rows.dropDuplicates(["_id"]).collect(), key=lambda r: str(r["_id"])) if chosen else []
    if not rows:
        return Model(np.zeros(N_FEATURES), np.zeros((2, 2)))
    return fit(lines_of([r["text"] for r in rows]), np.array([r["_label"] for r in rows]))


def document_scores(model: Model, lines: Lines) -> np.ndarray:
    """P(good) of a document's lines, weighted by their length."""
    good, _ = marginals(model, lines)
    weight = np.maximum(lines.lengths, 1).astype(float)
    first = lines.first[:-1]
    if not len(first):
        return np.zeros(0)
    return np.clip(np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first), 0, 1)


def score_quality(
    docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text", carry: list[str] | None = None,
) -> DataFrame:
    """Adds score (0 to 1: length-weighted marginal of 'good' over the lines) and predicted (1 if score >= threshold).

    Returns the ``carry`` columns, by default all but score and predicted.  The whole text counts; a null or
    empty text is one empty line.
    """
    kept = [c for c in carry or docs.columns if c not in ("score", "predicted")]
    place = [f"c{i}" for i in range(len(kept))]
    kinds = "".join(f"{p} {docs.schema[c].dataType.simpleString()}, " for p, c in zip(place, kept))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in W.slices(whole, 1 << 20)):
            score = document_scores(model, lines_of(batch["text"].to_pylist()))
            yield pa.RecordBatch.from_arrays([*(batch[p] for p in place), pa.array(score)], [*place, "score"])

    rows = docs.select(*[F.col(c).alias(p) for p, c in zip(place, kept)], F.col(text_col).alias("text"))
    found = rows.mapInArrow(scored, f"{kinds}score double")
    return found.select(
        *[F.col(p).alias(c) for p, c in zip(place, kept)], "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
