"""Session helpers: settings, the shared folder, and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What a broadcast side may weigh, by the widths of its columns; a side with text or nested values goes by its rows.
BROADCAST_BYTES = 8 << 20
_WIDTHS = {"bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8, "int": 4, "float": 4, "date": 4, "smallint": 2, "tinyint": 1, "boolean": 1}
# What a task of the lake's jobs is dealt of a shuffle and of a scan; its hash tables and sorts then stay in memory.
TASK_BYTES, SCAN_BYTES = 16 << 20, 8 << 20
INPUT_BYTES_PER_PARTITION = 8 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# A list of this many rows of ids, texts or short lists stays within some tens of MB per executor.
BROADCAST_ROWS = 200_000


def tune(spark: SparkSession) -> SparkSession:
    """Session settings the results or the skew handling rely on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # rows go to Python in batches of bounded bytes, however long their texts are; a batch is held twice, by the executor and its worker
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    # HotSpot never compiles methods beyond 8000 bytes; wide projections run faster split up
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def folder_bytes(spark: SparkSession, folder: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def size_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Shuffles begin with partitions in proportion to the input, so a task's share is the same at any size.

    Adaptive execution merges small ones, up to ``TASK_BYTES``.  Lower sizes set by the session stay.
    """
    wanted = -(-input_bytes // INPUT_BYTES_PER_PARTITION)
    if wanted > shuffle_partitions(spark):
        spark.conf.set(_INITIAL, str(wanted))
    for name, most in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES), ("spark.sql.files.maxPartitionBytes", SCAN_BYTES)):
        now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
        spark.conf.set(name, f"{min(now, most)}b")


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that a shuffle begins with."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(_INITIAL, None) or 0))


@contextmanager
def unsorted_folders(spark: SparkSession, files: int = 8) -> Iterator[None]:
    """Writes into at most ``files`` folders or buckets a task keep a file open for each, instead of sorting whole rows by folder.

    A task that meets more sorts the rest, so any number is written right.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(files))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def local_session(cores: int | str = "*", app: str = "pricelattice") -> SparkSession:
    """A single-machine session for tests and the bench."""
    return tune(
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", os.path.join(tempfile.gettempdir(), "pricelattice-warehouse"))
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local session may fall back to a temporary folder of this machine.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir()  # already holds a per-application subfolder
    if folder is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="pricelattice-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for a written table."""
    return f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def broadcast_rows(df: DataFrame) -> int:
    """How many rows of these columns may be broadcast: eight MB of numbers, or ``BROADCAST_ROWS`` with anything else."""
    widths = [_WIDTHS.get(kind) for _, kind in df.dtypes]
    return BROADCAST_ROWS if None in widths else max(BROADCAST_ROWS, BROADCAST_BYTES // max(1, sum(widths)))


def broadcast_if_small(df: DataFrame, max_rows: int | None = None, written: bool = False) -> DataFrame:
    """Hint a broadcast only after a bounded count has proven the side small.

    The bound is ``max_rows``, by default what the columns' widths allow.  The count stops at ``max_rows + 1`` rows.  A bigger side is returned without
    a hint, so the join is planned as a shuffle join, where adaptive execution
    splits skewed partitions.  With ``written`` the side is checkpointed in the shared
    folder first, for sides that are costly to compute twice.
    """
    if written:
        df = cut_lineage(df)
    max_rows = broadcast_rows(df) if max_rows is None else max_rows
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df
