"""Files as rows: listing, fingerprints, archive members."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _binary(spark: SparkSession, root: str, glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(root)


def relative_path(path: Column, root: str) -> Column:
    """Path below the root folder, without scheme and host."""
    bare = F.regexp_replace(path, "^[a-z0-9]+:/*", "/")
    start = re.sub("^[a-z0-9]+:/*", "/", root.rstrip("/"))
    return bare.substr(F.lit(len(start) + 2), F.length(bare))


def list_objects(spark: SparkSession, root: str, prefix: str | None = None, glob: str | None = None) -> DataFrame:
    """All files below a folder, or those whose name below it has a prefix; contents are not read."""
    files = _binary(spark, root, glob).select(
        "path", relative_path(F.col("path"), root).alias("name"), "modificationTime", "length"
    )
    return files if prefix is None else files.where(F.col("name").startswith(prefix))


def content_hash(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """SHA-256 of each file's bytes."""
    return _binary(spark, root, glob).select("path", "length", F.sha2("content", 256).alias("sha256"))


def expand_archives(archives: DataFrame) -> DataFrame:
    """Zip archives (path, content) to one row per member file, in name order."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # one archive in memory at a time, one output batch per member
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in sorted(n for n in archive.namelist() if not n.endswith("/")):
                        data = archive.read(name)
                        yield pd.DataFrame({"path": [path], "member": [name], "size": [len(data)], "content": [data]})

    return archives.select("path", "content").mapInPandas(
        members, "path string, member string, size long, content binary"
    )


def archive_members(spark: SparkSession, root: str, glob: str = "*.[zZ][iI][pP]") -> DataFrame:
    """One row per file inside every zip archive below a folder."""
    return expand_archives(_binary(spark, root, glob))
