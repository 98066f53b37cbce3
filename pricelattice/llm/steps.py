"""Steps that several operators share: written tables, numbering, components, linking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelattice.session import broadcast_if_small, cut_lineage, drop_scratch, scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, kept if executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Remove tables of :func:`written` when everything that was made of them is written, too."""
    for table in tables:
        drop_scratch(table.sparkSession, table.written_to)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def numbered(df: DataFrame, within: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: gapless positions from 0 within each key, in ``order``; ties as they come.

    Rows are range-partitioned on key and order, so a key with any share of the rows is
    spread over tasks; a short table of counts per key and partition gives the offsets.  The columns of ``df`` may have any names.
    """
    place = {c: f"c{i}" for i, c in enumerate(df.columns)}
    inner, keys = [place[c] for c in within], [place[c] for c in [*within, *order]]
    laid = (
        df.toDF(*place.values()).withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie")
        .drop("tie").withColumn("at", F.monotonically_increasing_id())
    )
    laid = cut_lineage(laid).withColumn("part", F.shiftrightunsigned("at", 33))
    runs = laid.groupBy(*inner, "part").agg(F.min("at").alias("least"), F.count("*").alias("n"))
    before = Window.partitionBy(*inner).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *[F.col(k).alias(f"k{i}") for i, k in enumerate(inner)], F.col("part").alias("p"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("least")).alias("shift"),
    )
    same = F.col("part") == F.col("p")
    for i, k in enumerate(inner):
        same &= F.col(k).eqNullSafe(F.col(f"k{i}"))
    return laid.join(broadcast_if_small(runs, written=True), same).select(
        *[F.col(p).alias(c) for c, p in place.items()], (F.col("at") + F.col("shift")).alias(name)
    )


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): rows (node, root) for every node, root its least node.

    Alternating stars: every node hands its neighbours its least neighbour, first the
    greater ones, then the smaller ones, until nothing changes; a logarithmic number of
    rounds.  Minima are combined before the shuffle, so a hub is no single task.
    """
    kind = links.schema["a"].dataType
    links = cut_lineage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = _mark(links)
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        links = cut_lineage(
            small.select("u", F.col("m").alias("v"))
            .union(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        )
        before, mark = mark, _mark(links)
        if mark == before:
            break
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    ).withColumns({c: F.col(c).cast(kind) for c in ("node", "root")})


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def sharing_groups(members: DataFrame, name: str) -> DataFrame:
    """Groups of nodes that share buckets, written: (lead, node, n).

    ``members`` has (bucket, node).  A bucket's least node stands for it, and a group is everything that shares
    a bucket with the same least node; copies of one thing lie in few groups, unlike buckets.  Buckets of one node are dropped.
    The members are laid out by bucket once, for the minima and for the join with them.
    """
    members = members.repartition("bucket")
    wide = members.groupBy("bucket").agg(F.min("node").alias("lead"), F.max("node").alias("hi")).where("lead <> hi")
    groups = written(members.join(wide.select("bucket", "lead"), "bucket").select("lead", "node").distinct(), f"{name}-groups")
    return groups.join(groups.groupBy("lead").agg(F.count("*").alias("n")), "lead")


def rooted(nodes: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Every node with the least node of its component, written: (node, root)."""
    known = components(links)
    return written(nodes.join(known, "node", "left").select("node", F.coalesce("root", "node").alias("root")), f"{name}-roots")
