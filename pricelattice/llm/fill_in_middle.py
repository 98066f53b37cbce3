"""Fill-in-the-middle examples over seekable compressed texts.

A text is stored as independent zstandard frames with the code points before each.  A cut opens the one frame it falls in; all other
frames of an example are the text's own, in another order, so an example is again a sequence of frames that any
zstandard reader can read, and digests stream them one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelattice.llm.steps import written
from pricelattice.llm.words import slices

#: What stands before the parts of an example.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_FRAMES = "frames array<struct<start:long,units:int,code:binary>>"
_FRAME_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("units", pa.int32()), ("code", pa.binary())]))


def store_frames(docs: DataFrame, units: int = 1 << 14, level: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts as seekable frames, written: (id, n, marked, frames).

    n is the number of code points (a null text is empty); a frame has ``units`` of them at most, and start counts those before it.
    ``marked`` says whether the text holds one of the marks of an example.  A null id stays null.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= text.contains(mark)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), marked.alias("marked"))
    found = rows.mapInArrow(lambda batches: _stored(batches, units, level), f"id {kind}, n long, marked boolean, {_FRAMES}")
    return written(found, "frames")


def _stored(batches: Iterator[pa.RecordBatch], units: int, level: int) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=level).compress
    for batch in (part for whole in batches for part in slices(whole)):
        frames, counts = [], []
        for text in batch["text"].to_pylist():
            counts.append(len(text))
            frames.append([
                {"start": at, "units": min(units, len(text) - at), "code": squeeze(text[at : at + units].encode())}
                for at in range(0, len(text), units)
            ])
        yield pa.RecordBatch.from_arrays(
            [batch["id"], pa.array(counts, pa.int64()), batch["marked"], pa.array(frames, _FRAME_TYPE)], ["id", "n", "marked", "frames"]
        )


def chosen_cuts(seed: int = 1, plain_percent: int = 10, spm_percent: int = 20) -> dict[str, Column]:
    """Form and cuts of the rows of :func:`store_frames`, by the SHA-256 of the seed and the id (null: empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    draw = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    cuts = [draw[i] % (F.col("n") + 1) for i in (0, 1)]
    plain = (F.col("n") == 0) | F.col("marked") | (draw[2] % 100 >= 100 - plain_percent)
    return {
        "form": F.when(plain, "plain").when(draw[3] % 100 < spm_percent, "spm").otherwise("psm"),
        "first_cut": F.least(*cuts), "second_cut": F.greatest(*cuts),
    }


def fill_in_middle(frames: DataFrame, cuts: dict[str, Column] | None = None) -> DataFrame:
    """Examples of stored texts: (id, n, form, prefix_chars, middle_chars, frames).

    A plain example is the text; psm is the prefix, the suffix and the middle, spm the suffix, the prefix and the middle, each
    behind its mark.  ``cuts`` gives form, first_cut and second_cut of a row (default: :func:`chosen_cuts`).  ``prefix_chars`` and
    ``middle_chars`` are null for a plain one.  The frames of an example count the code points of the example.
    """
    rows = frames.select("id", "n", "frames", *[c.alias(n) for n, c in (cuts or chosen_cuts()).items()])
    kind = frames.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        _examples, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, {_FRAMES}"
    )


class Frames:
    """Frames of one text: positions are found by the units before each, and only cut frames are opened."""

    def __init__(self, cell: pa.Scalar):
        rows = cell.values
        self.starts = rows.field("start").to_numpy(zero_copy_only=False)
        self.units = rows.field("units").to_numpy(zero_copy_only=False)
        self.codes = rows.field("code")
        self.opened: dict[int, str] = {}

    def text(self, i: int) -> str:
        if i not in self.opened:
            self.opened = {i: zstandard.ZstdDecompressor().decompress(self.codes[i].as_py()).decode()}
        return self.opened[i]

    def run(self, start: int, stop: int) -> list[tuple[int, bytes]]:
        """Frames (units, code) of a range: whole ones as they are, those at its ends cut."""
        out = []
        i = int(np.searchsorted(self.starts, start, side="right")) - 1
        while start < stop:
            begin, end = int(self.starts[i]), int(self.starts[i] + self.units[i])
            take = min(end, stop) - start
            if take == end - begin:
                out.append((take, self.codes[i].as_py()))
            else:
                out.append(_frame(self.text(i)[start - begin : start - begin + take]))
            start, i = start + take, i + 1
        return out


def _frame(text: str) -> tuple[int, bytes]:
    return len(text), zstandard.ZstdCompressor(level=3).compress(text.encode())


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mark = {m: _frame(m) for m in (PREFIX, SUFFIX, MIDDLE)}
    for batch in batches:
        out, lengths = [], ([], [])
        for cell, n, form, a, b in zip(batch["frames"], *(batch[c].to_pylist() for c in ("n", "form", "first_cut", "second_cut"))):
            frames = Frames(cell)
            if form == "plain":
                found = frames.run(0, n)
            else:
                prefix, middle, suffix = frames.run(0, a), frames.run(a, b), frames.run(b, n)
                both = [[mark[PREFIX], *prefix], [mark[SUFFIX], *suffix]]
                found = [*(both[0] + both[1] if form == "psm" else both[1] + both[0]), mark[MIDDLE], *middle]
            lengths[0].append(None if form == "plain" else a), lengths[1].append(None if form == "plain" else b - a)
            begins = np.concatenate([[0], np.cumsum([units for units, _ in found])]).tolist()
            out.append([{"start": begin, "units": units, "code": code} for begin, (units, code) in zip(begins, found)])
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["n"], batch["form"], *(pa.array(x, pa.int64()) for x in lengths), pa.array(out, _FRAME_TYPE)],
            ["id", "n", "form", "prefix_chars", "middle_chars", "frames"],
        )


def marks_in(frames: Frames) -> dict[str, int]:
    """Where each mark begins in an example, in code points; frames are read one after the other."""
    found, tail = {}, ""
    for i, begin in enumerate(frames.starts.tolist()):
        seen, tail = tail + frames.text(i), ""
        for mark in (PREFIX, SUFFIX, MIDDLE):
            if mark not in found and (at := seen.find(mark)) >= 0:
                found[mark] = begin - (len(seen) - int(frames.units[i])) + at
        tail = seen[-(len(PREFIX) - 1) :]
    return found


def original_runs(frames: Frames, form: str, length: int) -> list[tuple[int, int]]:
    """Ranges of an example that give the text again, in its order."""
    if form == "plain":
        return [(0, length)]
    at = marks_in(frames)
    size = len(PREFIX)
    ends = sorted([*at.values(), length])
    run = {mark: (place + size, ends[ends.index(place) + 1]) for mark, place in at.items()}
    return [run[PREFIX], run[MIDDLE], run[SUFFIX]]


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        sums = ([], [])
        for cell, form in zip(batch["frames"], batch["form"].to_pylist()):
            frames = Frames(cell)
            length = int(frames.units.sum())
            for out, runs in zip(sums, ([(0, length)], original_runs(frames, form, length))):
                digest = sha256()
                for a, b in runs:
                    for _, code in frames.run(a, b):
                        digest.update(expand(code))
                out.append(digest.hexdigest())
        rest = [n for n in batch.schema.names if n != "frames"]
        yield pa.RecordBatch.from_arrays([*(batch[n] for n in rest), *(pa.array(x, pa.string()) for x in sums)],
                                         [*rest, "output_sha256", "restored_sha256"])


def digests(examples: DataFrame) -> DataFrame:
    """SHA-256 of each example, and of the text rebuilt from it and its form: the marks are looked for in the example itself."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in examples.drop("frames").schema)
    return examples.mapInArrow(_summed, f"{kinds}, output_sha256 string, restored_sha256 string")
