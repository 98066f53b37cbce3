"""Language by compression: the dictionary of the right language makes the shortest code."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelattice.llm.words import slices
from pricelattice.session import broadcast_if_small, cut_lineage

UNKNOWN = "und"
LEVEL = 6
#: Bytes coded at a time, each piece with the dictionary afresh: what a dictionary saves is then a share of any length.
PIECE = 1 << 16
_MARKS = re.compile(r"[\W\d_]+")


def held_out(id_col: Column, parts: int, part: int) -> Column:
    """Rows kept from learning: crc32 of the id as text has this remainder; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == part, F.lit(False))


def plain(text: str) -> str:
    """Lower-case letters with single spaces: what a code length should depend on."""
    return _MARKS.sub(" ", text.lower()).strip()


def learn_dictionaries(
    labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
    texts_per_language: int = 1_000, bytes_per_language: int = 300_000,
) -> dict[str, bytes]:
    """Raw dictionary content of each language, from a bounded sample of the labelled rows.

    The sample is the ``texts_per_language`` rows of least hash of each language, chosen on ids alone so that
    texts are read only for them, and of these the shortest distinct texts, whole, of ``bytes_per_language`` together
    (one at least).  Rows without language, id or text teach nothing.

    Rows are counted per language first; only those below a hash that twice the wanted number are expected to be below are ranked, so
    a language of any size sends few rows to its task.
    """
    labelled = labelled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    usable = labelled.where(F.col("lang").isNotNull() & F.col("id").isNotNull()).select("lang", "id")
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}  # one row per language
    share = {lang: 2 * texts_per_language / n for lang, n in counts.items()}
    while True:
        below = F.lit(False)
        for lang, part in share.items():
            own = F.col("lang") == lang
            below |= own & (F.xxhash64("id") < F.lit(int(part * 2**64) - 2**63)) if part < 1 else own
        few = cut_lineage(usable.where(below))
        held = {r["lang"]: r["count"] for r in few.groupBy("lang").count().collect()}
        short = [lang for lang, n in counts.items() if held.get(lang, 0) < min(n, texts_per_language)]
        if not short:
            break
        share |= {lang: 4 * share[lang] for lang in short}  # by chance too few, or many rows of one id
    rank = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = few.withColumn("_n", F.row_number().over(rank)).where(F.col("_n") <= texts_per_language).select(
        F.col("lang").alias("_lang"), F.col("id").alias("_id")
    ).distinct()
    rows = labelled.where(F.length("text") > 0).join(
        broadcast_if_small(chosen, written=True), (F.col("id") == F.col("_id")) & (F.col("lang") == F.col("_lang"))
    ).select("lang", "text").distinct()
    so_far = Window.partitionBy("lang").orderBy(F.octet_length("text"), "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum(F.octet_length("text")).over(so_far), F.lit(0)))
    rows = rows.where((F.col("before") == 0) | (F.col("before") + F.octet_length("text") <= bytes_per_language))
    contents: dict[str, list[bytes]] = {}
    for lang, text in sorted(rows.select("lang", "text").collect()):
        if content := plain(text).encode():
            contents.setdefault(lang, []).append(content)
    return {lang: b" ".join(texts) for lang, texts in contents.items()}


def coders(contents: list[bytes], level: int = LEVEL) -> list[zstandard.ZstdCompressor]:
    """A compressor for each raw dictionary, with the frame stripped to what depends on the text."""
    out = []
    for content in contents:
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        how = zstandard.ZstdCompressionParameters.from_level(
            level, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False
        )
        raw.precompute_compress(compression_params=how)
        out.append(zstandard.ZstdCompressor(dict_data=raw, compression_params=how))
    return out


def code_length(coder: zstandard.ZstdCompressor, code: bytes) -> int:
    """Bytes of the code of the whole text, summed over its pieces."""
    return sum(len(coder.compress(code[at : at + PIECE])) for at in range(0, len(code), PIECE))


def _predict(batches: Iterator[pa.RecordBatch], names: list[str], contents: list[bytes], margin: float):
    by_language = coders(contents)
    for batch in (part for whole in batches for part in slices(whole)):
        known, lengths = np.zeros(batch.num_rows, bool), np.ones((batch.num_rows, max(1, len(names))), np.int64)
        for i, value in enumerate(batch["text"]):
            text = value.as_py()
            if names and text and any(map(str.isalpha, text)):
                known[i] = True
                code = plain(text).encode()
                lengths[i] = [code_length(coder, code) for coder in by_language]
        ordered = np.sort(lengths, axis=1)
        lead = (ordered[:, 1] - ordered[:, 0]) / ordered[:, 1] if len(names) > 1 else np.ones(len(known))
        share = 1 / np.exp2(-np.minimum(lengths - ordered[:, :1], 60.0)).sum(axis=1)
        lang = [names[b] if k else UNKNOWN for b, k in zip(lengths.argmin(axis=1), known)]
        rest = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch[n] for n in rest), pa.array(lang, pa.string()), pa.array(np.where(known, share, 0.0)),
             pa.array(np.where(known, lead, 0.0)), pa.array(~known | (lead < margin))],
            [*rest, "lang_pred", "score", "margin", "rejected"],
        )


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], margin: float = 0.002, text_col: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """Language of each text by the shortest zstandard code, summed over pieces of ``PIECE`` bytes of the whole text.

    Returns the ``carry`` columns (by default all but the result's names) and lang_pred, score (0 to 1: the share of the best language when
    each byte saved doubles it), margin (how much longer the second-best code is, as a share of
    it) and rejected (no letter, or a margin below ``margin``; the first language in name order wins a tie).
    A null or letterless text is 'und' with score 0; so is every text if nothing was learned.
    """
    names = sorted(dictionaries)
    contents = [dictionaries[n] for n in names]
    added = ["lang_pred", "score", "margin", "rejected"]
    kept = [c for c in carry or docs.columns if c not in added]
    place = [f"c{i}" for i in range(len(kept))]
    fields = docs.select(*kept).schema
    schema = ", ".join(f"{p} {fields[c].dataType.simpleString()}" for p, c in zip(place, kept))
    schema += (", " if schema else "") + "lang_pred string, score double, margin double, rejected boolean"
    rows = docs.select(*[F.col(c).alias(p) for p, c in zip(place, kept)], F.col(text_col).alias("text"))
    found = rows.mapInArrow(lambda batches: _predict(batches, names, contents, margin), schema)
    return found.select(*[F.col(p).alias(c) for p, c in zip(place, kept)], *added)
