"""Shards by jump consistent hashing: the key and the number of shards decide, no table is kept."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelattice.llm.steps import numbered

_STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key.  With one more shard a key stays or goes to the new shard."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    shard, ahead = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        shard[live] = ahead[live]
        state[live] = state[live] * _STEP + np.uint64(1)
        ahead[live] = ((shard[live] + 1) * (2.0**31 / ((state[live] >> np.uint64(33)).astype(np.float64) + 1))).astype(np.int64)
        live = live[ahead[live] < shards]
    return shard.astype(np.int32)


def stable_key(col: Column) -> Column:
    """60 bits of the MD5 of the key as text; a null key counts as the empty text."""
    text = F.coalesce(col.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def shard_of(key: Column, shards: int) -> Column:
    @F.pandas_udf("int")
    def jump(values: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(values.to_numpy(), shards))

    return jump(stable_key(key))


def assign_shards(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", columns: list[str] | None = None,
) -> DataFrame:
    """Shard, position within the shard, and the shard after one more is appended.

    Adds to the chosen columns of ``docs`` (all by default, replacing those of the same name): size (UTF-8 bytes of the text plus 8;
    null text: 8), text_crc32, law ('key'), shard, grown_shard and slot.  Slots are gapless from 0 in
    order of id, CRC and size; a repeated id goes to one shard, a null id to the shard of the empty key.
    An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    added = {
        "size": (F.octet_length(text) + 8).cast("long"), "text_crc32": F.crc32(text), "law": F.lit("key"),
        "shard": shard_of(F.col(id_col), shards), "grown_shard": shard_of(F.col(id_col), shards + 1),
    }
    keep = [c for c in columns or docs.columns if c not in added and c != "slot"]
    placed = docs.select(*keep, *[value.alias(name) for name, value in added.items()])
    return numbered(placed, ["shard"], [id_col, "text_crc32", "size"], "slot")
