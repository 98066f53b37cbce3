"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path of turns; paths are sorted and dealt to shards by splitter paths.  Only prefixes of splitters, the
skeleton, can have members in several shards, and their trie is broadcast.  A shard finishes all other nodes by
itself in one scan; of skeleton nodes it gives partial sums, which are combined by reduction.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from pricelattice.llm.steps import numbered, written
from pricelattice.session import broadcast_if_small

#: Bytes of a turn's digest in a path.
WIDTH = 16
_COUNTS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
_RESULT = ["conv_id", "depth", "parent_conv_id", *_COUNTS, "ends_sha256"]
_SCANNED = (
    "kind string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, skeleton int, parent int, above array<int>, chars long, shard int, nth int, chunk string, node binary"
)
#: Characters of member ids that travel in one row, and rows of finished nodes that a task holds before it hands them on.
_CHUNK, _HELD = 1 << 20, 20_000


def turn_code(role: Column, text: Column) -> Column:
    """16 bytes that stand for a role and a text."""
    return F.unhex(F.md5(F.concat(F.md5(role.cast("binary")), F.md5(text.cast("binary"))).cast("binary")))


def numbered_turns(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """The turns of each conversation in order: (conv, pos from 1, code, chars), written.

    Null turns come first; of one turn number the order is that of role and of the text's MD5.  A null role or text is empty; rows without
    an id belong to no conversation.  Texts stay behind: a turn goes on as its code and its number of code points.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.md5(text.cast("binary")).alias("text_md5"), turn_code(role, text).alias("code"), F.length(text).cast("long").alias("chars"),
    )
    placed = numbered(turns, ["conv"], ["turn", "role", "text_md5"], "pos")
    return written(placed.select("conv", (F.col("pos") + 1).alias("pos"), "code", "chars"), "turns")


def rebuilt(turns: DataFrame, block: int = 100, most: int = 5) -> DataFrame:
    """Conversations begun by another one: rows (conv, depth, code, chars), and one of depth 0 for each.

    Conversation c has the first h turns of conversation c - c % ``block`` (all if that has fewer), then its own turns after its
    first h; h = crc32(c) % (``most`` + 1).
    """
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)
    base = F.col("conv") - F.col("conv") % block
    heads = turns.where((F.col("conv") % block == 0) & (F.col("pos") <= most)).groupBy(F.col("conv").alias("head")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "code", "chars"))).alias("turns")  # at most ``most``
    )
    heads = broadcast_if_small(heads, written=True)
    with_head = lambda rows: rows.withColumns({"h": shared, "b": base}).join(heads, F.col("b") == F.col("head"), "left").withColumn(
        "taken", F.slice(F.coalesce("turns", F.array().cast("array<struct<pos:long,code:binary,chars:long>>")), F.lit(1), F.col("h").cast("int"))
    )
    own = with_head(turns.where(F.col("pos") > shared)).select(
        "conv", (F.size("taken") + F.col("pos") - F.col("h")).alias("depth"), "code", "chars"
    )
    marker = F.struct(F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("code"), F.lit(0).cast("long").alias("chars"))
    begun = with_head(turns.where("pos = 1")).select("conv", F.inline(F.concat(F.array(marker), "taken")))
    return own.union(begun)


def prefix_trie(turns: DataFrame, shard_rows: int = 20_000, max_depth: int = 64, most_shards: int = 10_000) -> DataFrame:
    """Every node of the trie of turn sequences: one row each.

    ``turns`` has rows (conv, depth from 1 without gaps, code, chars) and a row of depth 0 for each conversation.  A node is a
    distinct sequence of first turns, from the empty one on; its members are the conversations that begin with it.  Columns: conv_id (smallest
    member), depth, parent_conv_id (the parent's conv_id; root: null), n_convs, n_children, n_leaves (childless nodes in its
    subtree, itself included), saved_tokens (over the subtree: members less one, times the characters of the node's last turn),
    ends_sha256 (of the ids of members that end here, ascending, joined by commas).  Without conversations there is no node.

    A shard holds about ``shard_rows`` conversations, more if there would be over ``most_shards``, so splitters and skeleton are bounded: at most
    ``most_shards`` paths of ``max_depth`` codes.  A task hands on a skeleton node's finished subtrees as it goes.  Equal paths are ordered by
    conversation, so that copies are split over shards, too.  A path holds ``max_depth`` turns; longer conversations are few or few are long, and the nodes below
    that are grouped by hashes of their prefixes (:func:`_deep_nodes`), so that no task holds a whole conversation.
    """
    first = F.col("depth").between(1, max_depth)
    paths = turns.groupBy("conv").agg(
        F.max("depth").alias("total"), F.sort_array(F.collect_list(F.when(first, F.struct("depth", "code", "chars")))).alias("turns"),
    ).select(
        "conv", "total", F.aggregate("turns.code", F.lit(b""), lambda a, b: F.concat(a, b)).alias("key"),
        F.col("turns.chars").alias("chars"),
    )
    paths = written(paths, "paths")
    deep = None
    if not paths.where(F.col("total") > max_depth).isEmpty():
        deep, extra = _deep_nodes(turns, paths, max_depth)
        paths = paths.join(extra, paths["conv"] == extra["owner"], "left")
    else:
        paths = paths.withColumns({c: F.lit(0) for c in ("more_children", "more_leaves", "more_saved")})
    paths = paths.select(
        "conv", "key", "chars", (F.col("total") <= max_depth).alias("ends"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("more_children", "more_leaves", "more_saved")],
    )
    splitters = _splitters(paths, shard_rows, most_shards)
    trie = _skeleton([key for key, _ in splitters])
    spark = turns.sparkSession
    shared = spark.sparkContext.broadcast((splitters, trie))
    dealt = paths.mapInArrow(lambda batches: _dealt(batches, shared.value[0]), StructType([*paths.schema, StructField("shard", IntegerType())]))
    laid = dealt.repartition(F.col("shard")).sortWithinPartitions("shard", "key", "conv")
    scanned = written(laid.mapInArrow(lambda batches: _scan(batches, shared.value[1], max_depth), _SCANNED), "trie-nodes")
    skeleton = written(_reduced(scanned), "skeleton")
    named = skeleton.select(F.col("skeleton").alias("s"), F.col("conv_id").alias("above_conv"))
    found = scanned.where("kind = 'node'").join(broadcast_if_small(named), F.col("parent") == F.col("s"), "left")
    found = found.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above_conv")).select(*_RESULT, "node").union(
        skeleton.select(*_RESULT, "node")
    )
    if deep is None:
        return found.select(*_RESULT)
    found = written(found, "upper-nodes")
    tops = found.where("node is not null").select(F.col("node").alias("top"), F.col("conv_id").alias("above_conv"))
    lower = deep.join(tops, F.col("above_top") == F.col("top"), "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above_conv"))
    return found.select(*_RESULT).union(lower.select(*_RESULT))


def _splitters(paths: DataFrame, shard_rows: int, most_shards: int, per_shard: int = 24) -> list[tuple[bytes, int]]:
    """Paths that part the sorted ones into shards, from a sample by the conversation's hash of about ``per_shard`` rows a shard."""
    rows = paths.count()
    shards = min(-(-rows // shard_rows), most_shards)
    if shards < 2:
        return []
    share = min(1.0, shards * per_shard / rows)
    sample = paths.where(F.pmod(F.xxhash64("conv"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("key", "conv")
    drawn = sorted((bytes(r["key"]), r["conv"]) for r in sample.toLocalIterator())
    return sorted({drawn[len(drawn) * i // shards] for i in range(1, shards)}) if drawn else []


def _skeleton(splitters: list[bytes]) -> dict[tuple[int, bytes], int] | None:
    """The trie of the splitter paths: (number of a node, code of a turn) -> number of the child; the root is 0.  None: one shard."""
    trie: dict[tuple[int, bytes], int] = {}
    for key in splitters:
        node = 0
        for at in range(0, len(key), WIDTH):
            node = trie.setdefault((node, key[at : at + WIDTH]), len(trie) + 1)
    return trie if splitters else None


def _dealt(batches: Iterator[pa.RecordBatch], splitters: list[tuple[bytes, int]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shard = [bisect_right(splitters, row) for row in zip(batch["key"].to_pylist(), batch["conv"].to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], [*batch.schema.names, "shard"])


class _Node:
    __slots__ = ("place", "skeleton", "chars", "n", "least", "children", "leaves", "saved", "ends", "chunks")

    def __init__(self, place: int, skeleton: int, chars: int):
        self.place, self.skeleton, self.chars = place, skeleton, chars
        self.n = self.children = self.leaves = self.saved = 0
        self.least = None
        self.ends: list[int] = []  # members that end here and are not in a chunk or digest yet
        self.chunks: list[str] = []


class _Shard:
    """One shard's scan: a stack of open nodes, and the rows of closed ones."""

    def __init__(self, shard: int, trie: dict[tuple[int, bytes], int] | None, max_depth: int):
        self.shard, self.trie, self.max_depth = shard, trie, max_depth
        self.key, self.rows, self.done = b"", [], []
        self.stack = [self.opened(-1 if trie is None else 0, 0)]

    def opened(self, skeleton: int, chars: int) -> _Node:
        """A new node; one that will be finished here gets its place among the rows before its children do."""
        if skeleton < 0:
            self.rows.append(None)
        return _Node(len(self.rows) - 1, skeleton, chars)

    def add(self, key: bytes, conv: int, chars: list[int], ends: bool, children: int, leaves: int, saved: int) -> None:
        if key != self.key:
            same, limit = 0, min(len(key), len(self.key))
            while same < limit and key[same : same + WIDTH] == self.key[same : same + WIDTH]:
                same += WIDTH
            while len(self.stack) > same // WIDTH + 1:
                self.close()
            if len(self.rows) >= _HELD and self.stack[-1].skeleton >= 0:  # whatever is held is finished
                self.hand_on()
            for at in range(same, len(key), WIDTH):
                above = self.stack[-1].skeleton
                skeleton = self.trie.get((above, key[at : at + WIDTH]), -1) if above >= 0 else -1
                self.stack.append(self.opened(skeleton, chars[at // WIDTH]))
            self.key = key
        node = self.stack[-1]
        node.n += 1
        node.least = conv if node.least is None or conv < node.least else node.least
        node.children += children
        node.leaves += leaves
        node.saved += saved
        if ends:
            node.ends.append(conv)
            if len(node.ends) == 50_000:
                node.chunks.append(",".join(map(str, node.ends)))
                node.ends = []

    def close(self) -> None:
        node, depth = self.stack.pop(), len(self.stack)
        if node.ends:
            node.chunks.append(",".join(map(str, node.ends)))
        above = self.stack[-1] if self.stack else None
        top = None
        if depth == self.max_depth:
            top = sha256(self.key[: depth * WIDTH]).digest()
        if node.skeleton >= 0:
            line = [n.skeleton for n in self.stack]
            self.rows.append(("part", node.least, depth, None, node.n, node.children, node.leaves, node.saved, None,
                              node.skeleton, above.skeleton if above else None, line, node.chars, self.shard, 0, None, top))
            for nth, chunk in enumerate(_cut(node.chunks)):
                self.rows.append(("ends", None, None, None, 0, 0, 0, 0, None, node.skeleton, None, None, 0, self.shard, nth, chunk, None))
        else:
            digest = sha256()
            for nth, chunk in enumerate(node.chunks):
                digest.update(("," * (nth > 0) + chunk).encode())
            node.leaves += node.children == 0
            node.saved += (node.n - 1) * node.chars
            # the parent's least member is not known yet: its place, a number below zero, stands for it
            parent = None if above is None or above.skeleton >= 0 else -1 - above.place
            self.rows[node.place] = ("node", node.least, depth, parent, node.n, node.children, node.leaves, node.saved, digest.hexdigest(),
                                     None, above.skeleton if above and above.skeleton >= 0 else None, None, node.chars, self.shard, 0, None, top)
            if above:
                above.children += 1
                above.leaves += node.leaves
                above.saved += node.saved
        if above:
            above.n += node.n
            above.least = node.least if above.least is None or node.least < above.least else above.least

    def hand_on(self) -> None:
        """The rows held, all of closed nodes, as a batch; parents' places become their least members."""
        columns = [list(c) for c in zip(*self.rows)]
        least = columns[1]
        columns[3] = [p if p is None else least[-1 - p] for p in columns[3]]
        self.done.append(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _KINDS)], _NAMES))
        self.rows = []

    def finish(self) -> list[pa.RecordBatch]:
        while self.stack:
            self.close()
        self.hand_on()
        return self.done


_NAMES = [part.split()[0] for part in _SCANNED.split(", ")]
_KINDS = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}[
    part.split()[1]] for part in _SCANNED.split(", ")]


def _cut(chunks: list[str]) -> Iterator[str]:
    """The ids in texts of about ``_CHUNK`` characters."""
    held, size = [], 0
    for chunk in chunks:
        held.append(chunk)
        size += len(chunk)
        if size >= _CHUNK:
            yield ",".join(held)
            held, size = [], 0
    if held:
        yield ",".join(held)


def _scan(batches: Iterator[pa.RecordBatch], trie: dict[tuple[int, bytes], int] | None, max_depth: int) -> Iterator[pa.RecordBatch]:
    """Closed nodes and parts of skeleton nodes of the shards of one task, whose rows come sorted."""
    shard = None
    for batch in batches:
        columns = [batch[n].to_pylist() for n in ("key", "conv", "chars", "ends", "more_children", "more_leaves", "more_saved")]
        for number, row in zip(batch["shard"].to_pylist(), zip(*columns)):
            if shard is None or shard.shard != number:
                if shard is not None:
                    yield from shard.finish()
                shard = _Shard(number, trie, max_depth)
            shard.add(*row)
            if shard.done:
                yield from shard.done
                shard.done = []
    if shard is not None:
        yield from shard.finish()


def _reduced(scanned: DataFrame) -> DataFrame:
    """The skeleton's nodes from the parts that the shards have of them."""
    parts = scanned.where("kind = 'part'").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("above").alias("above"),
        F.first("chars").alias("chars"), F.first("node").alias("node"), *[F.sum(c).alias(c) for c in _COUNTS],
    )
    parts = written(parts, "skeleton-parts")
    below = parts.groupBy(F.col("parent").alias("p")).agg(F.count("*").alias("own_children"))
    nodes = parts.join(below, F.col("skeleton") == F.col("p"), "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("own_children", F.lit(0))
    ).withColumns({
        "n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"),
        "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars"),
    })
    # every node's own sums go to itself and to all above it
    sums = nodes.select(F.explode(F.array_append("above", F.col("skeleton"))).alias("to"), "n_leaves", "saved_tokens").groupBy("to").agg(
        F.sum("n_leaves").alias("all_leaves"), F.sum("saved_tokens").alias("all_saved")
    )
    ends = scanned.where("kind = 'ends'").select("skeleton", "shard", "nth", "chunk").repartition("skeleton").sortWithinPartitions(
        "skeleton", "shard", "nth"
    ).mapInArrow(_digests, "ended int, sha string")
    named = parts.select(F.col("skeleton").alias("s"), F.col("conv_id").alias("above_conv"))
    return nodes.join(sums, F.col("skeleton") == F.col("to")).join(named, F.col("parent") == F.col("s"), "left").join(
        ends, F.col("skeleton") == F.col("ended"), "left"
    ).select(
        "skeleton", "conv_id", "depth", F.col("above_conv").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("all_leaves").alias("n_leaves"), F.col("all_saved").alias("saved_tokens"),
        F.coalesce("sha", F.lit(sha256().hexdigest())).alias("ends_sha256"), "node",
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's chunks, which come in order, joined by commas; a chunk is held at a time."""
    key, digest = None, None
    for batch in batches:
        keys, sums = [], []
        for at, chunk in zip(batch[0].to_pylist(), batch["chunk"].to_pylist()):
            if key is not None and at == key:
                digest.update(b",")
            else:
                if key is not None:
                    keys.append(key), sums.append(digest.hexdigest())
                key, digest = at, sha256()
            digest.update(chunk.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.types[0]), pa.array(sums, pa.string())], ["ended", "sha"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], batch.schema.types[0]), pa.array([digest.hexdigest()])], ["ended", "sha"])


def _id_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of sorted rows (node, conv) as texts: one row for each node of a batch."""
    for batch in batches:
        node, conv = batch["node"].to_pylist(), batch["conv"].to_pylist()
        cuts = [0, *(i for i in range(1, len(node)) if node[i] != node[i - 1]), len(node)]
        runs = [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]
        yield pa.RecordBatch.from_arrays(
            [pa.array([node[a] for a, _ in runs], pa.binary()), pa.array([conv[a] for a, _ in runs], pa.int64()),
             pa.array([",".join(map(str, conv[a:b])) for a, b in runs], pa.string())], ["node", "first", "chunk"],
        )


def _deep_nodes(turns: DataFrame, paths: DataFrame, max_depth: int) -> tuple[DataFrame, DataFrame]:
    """Nodes below ``max_depth``, and what they add to the paths of the conversations that own them.

    A node is named by the digest of its first ``max_depth`` turns and the XOR of 128-bit hashes of (depth, turn) of the others, a running
    window along each conversation.  Its smallest member owns it: sums over a subtree are sums, over the members, of what each
    owns from there on, and the owner of a node right below carries its subtree to the path above.
    """
    seeds = paths.where(F.col("total") > max_depth).select(
        F.col("conv").alias("c"), "total", F.unhex(F.sha2("key", 256)).alias("above_top")
    )
    along = Window.partitionBy("conv").orderBy("depth")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    rows = turns.where(F.col("depth") > max_depth).join(seeds, F.col("conv") == F.col("c"))
    rows = rows.withColumns({
        "x": F.bit_xor(F.xxhash64("depth", "code")).over(so_far),
        "y": F.bit_xor(F.xxhash64("code", F.lit("second"), "depth")).over(so_far),
    })
    rows = rows.withColumn("node", F.unhex(F.md5(F.concat(
        "above_top", *[F.encode(F.concat(F.lit("/"), F.col(c).cast("string")), "utf-8") for c in ("depth", "x", "y")]
    ))))
    rows = written(rows.withColumn("up", F.lag("node").over(along)).select("conv", "depth", "node", "up", "chars", "total", "above_top"), "deep-turns")
    nodes = rows.groupBy("node").agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.first("depth").alias("depth"), F.first("chars").alias("chars"),
        F.min("up").alias("up"), F.first("above_top").alias("above_top"), (F.max("total") == F.first("depth")).alias("childless"),
    )
    nodes = written(nodes, "deep-nodes")
    owned = nodes.select(F.col("node").alias("k"), F.col("conv_id").alias("owner"), "n_convs", "childless")
    own = rows.join(owned, F.col("node") == F.col("k")).withColumns({
        "leaf": ((F.col("conv") == F.col("owner")) & F.col("childless")).cast("long"),
        "save": F.when(F.col("conv") == F.col("owner"), (F.col("n_convs") - 1) * F.col("chars")).otherwise(0),
    })
    down = Window.partitionBy("conv").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    sums = written(own.select(
        "conv", "depth", "node", "owner", F.sum("leaf").over(down).alias("leaves"), F.sum("save").over(down).alias("saved")
    ), "deep-sums")
    extra = sums.where(F.col("depth") == max_depth + 1).select(
        F.col("conv").alias("owner"), (F.col("conv") == F.col("owner")).cast("long").alias("more_children"),
        F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"),
    )
    totals = sums.groupBy(F.col("node").alias("k")).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    children = nodes.where("up is not null").groupBy(F.col("up").alias("p")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    ended = rows.where("depth = total").select("node", "conv").repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
    ends = ended.mapInArrow(_id_texts, "node binary, first long, chunk string").repartition("node").sortWithinPartitions("node", "first").select(
        "node", "chunk"
    ).mapInArrow(_digests, "ended binary, sha string")
    found = nodes.join(totals, F.col("node") == F.col("k")).join(children, F.col("node") == F.col("p"), "left").join(
        parents, F.col("up") == F.col("above"), "left"
    ).join(ends, F.col("node") == F.col("ended"), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("sha", F.lit(sha256().hexdigest())).alias("ends_sha256"), F.when(F.col("up").isNull(), F.col("above_top")).alias("above_top"),
    )
    return written(found, "deep-found"), extra
