"""The prefix trie of conversations, by a splitter skeleton.

A turn is 16 bytes: the digest of its role and text. A conversation's turns one after
the other are its path, so that byte order sorts conversations like a dictionary, and a node
of the trie is a prefix of paths, of 16 bytes for each level.

Paths are range-partitioned into sorted shards, equal paths by conversation id, so that a path
which a third of all conversations take spreads over many shards. All conversations below a node
stand together in that order. A node that lies in more than one shard is a prefix of the
paths on both sides of a boundary; such nodes are the skeleton, the trie of the splitters'
common prefixes. It travels to the shards by broadcast as two depths a shard: a shard holds its
own first and last path, so it only has to know how far down these are shared with its
neighbours. That is two numbers a partition, whatever the conversations are like.

A shard walks its sorted paths once with a stack of open nodes. A node that is no skeleton is
finished where it closes. For a skeleton node each shard emits a partial aggregate, and a sum over
the shards completes it: counts, sums of subtrees and the smallest member just add up, since the
shard where a node opens counts it for its parent, and the shard where it closes knows
whether anything stands below it (ends sort before longer paths). The members that end at a
skeleton node are hashed in shard order, chunk after chunk, so that they are never in memory
together.

Memory: a shard holds the finished nodes below one open parent, so at most its own share of
the rows, and a stack as deep as its longest path. One conversation is one row of 20 bytes a turn.

Defined results: turns without a turn number come first, ties go by the digest of role and text;
null roles and texts are empty; turns without a conversation id are in no conversation. Rows that
repeat are turns of their own. With no conversation there is no node, not even the root. Columns
beyond those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casewise.llm.textops import small_batches
from casewise.sources.workspace import materialize

WIDTH = 16  # bytes of a path per turn

# Ids that a row of ends holds at most.
_ENDS_AT_ONCE = 4096

_SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
_NODE = (
    "kind string, key string, parent_key string, shard bigint, place int, conv_id bigint, depth bigint, "
    "parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string"
)
_WHOLE, _PART, _CHILD, _ENDS = "whole", "part", "child", "ends"
RESULT = ("conv_id", "depth", "parent_conv_id", *_SUMS, "ends_sha256")


# --- conversations ---------------------------------------------------------------


def turn_lists(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and its ``turns`` in order, each a digest and a number of characters.

    Texts are digested before the shuffle, so 40 bytes a turn are all that moves.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.unhex(F.substring(F.sha2(said, 256), 1, 2 * WIDTH)).alias("digest"),
        F.length(text).alias("size"),
    )
    held = conversations.where(F.col("conv_id").isNotNull())
    listed = held.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"], t["size"])).alias("turns"))


def with_shared_heads(listed: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Conversations whose first h turns, h below ``heads``, are those of their group's first.

    The first of a group has an id divisible by ``group``; h is the id's hash modulo ``heads``.
    Turns that the first lacks are left out; its row meets at most ``group`` others.
    """
    first = F.col("conv_id") - F.col("conv_id") % group
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    listed = listed.withColumns({"first": first, "h": head.cast("int")})
    firsts = listed.where(F.col("conv_id") == F.col("first")).select(
        "first", F.slice("turns", 1, heads - 1).alias("lead")
    )
    lead = F.coalesce(F.slice("lead", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rebuilt = F.concat(lead, F.slice("turns", F.col("h") + 1, F.size("turns")))
    return listed.join(firsts, "first", "left").select("conv_id", rebuilt.alias("turns"))


def _paths(listed: DataFrame) -> DataFrame:
    hexed = F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")
    return listed.select(
        "conv_id", F.unhex(hexed).alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes")
    )


# --- shards ----------------------------------------------------------------------


def common_depth(one: bytes, other: bytes) -> int:
    """How many turns two paths have in common at their start."""
    least = min(len(one), len(other)) // WIDTH
    if not least:
        return 0
    a, b = (np.frombuffer(path, np.uint8, least * WIDTH) for path in (one, other))
    unequal = a != b
    return int(unequal.argmax()) // WIDTH if unequal.any() else least


def _shards(paths: DataFrame) -> DataFrame:
    """The paths dealt by range, written with the number of their shard."""
    parts = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(paths, "paths").repartitionByRange(parts, "path", "conv_id")
    return materialize(dealt.withColumn("shard", F.spark_partition_id().cast("bigint")), "shards")


def skeleton(shards: DataFrame) -> DataFrame:
    """Per shard how deep its first and last path are shared with its neighbours, -1 for not at all.

    The splitter between two shards is the first path of the second; nodes shared by both sides are
    its prefixes. As many rows as there are shards.
    """

    @F.arrow_udf("int")
    def depth(one: pa.Array, other: pa.Array) -> pa.Array:
        pairs = zip(one.to_pylist(), other.to_pylist(), strict=True)
        return pa.array([-1 if a is None or b is None else common_depth(a, b) for a, b in pairs], pa.int32())

    edges = shards.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    order = Window.orderBy("shard")
    edges = edges.withColumn("before", F.lag("last").over(order)).withColumn("after", F.lead("first").over(order))
    shared = edges.select("shard", depth("before", "first").alias("left"), depth("last", "after").alias("right"))
    return materialize(shared, "skeleton")


class _Node:
    """An open node of a shard."""

    __slots__ = ("children", "conv_id", "convs", "depth", "ends", "hash", "leaves", "pending", "place", "saved", "size")

    def __init__(self, depth: int, size: int) -> None:
        self.depth, self.size = depth, size
        self.conv_id: int | None = None
        self.convs = self.children = self.leaves = self.saved = self.place = 0
        self.ends: list[str] = []
        self.hash = None
        self.pending: list[tuple] = []

    def take(self, convs: int, conv_id: int | None) -> None:
        self.convs += convs
        if conv_id is not None and (self.conv_id is None or conv_id < self.conv_id):
            self.conv_id = conv_id


class Walk:
    """One shard's paths in order, to rows of finished nodes and of parts of skeleton nodes."""

    def __init__(self, shard: int, left: int, right: int) -> None:
        self.shard, self.left, self.right = shard, left, right
        self.path = b""
        self.stack: list[_Node] = []
        self.first = self.last = b""
        self.rows: list[tuple] = []

    def _shared_left(self, depth: int) -> bool:
        return depth <= self.left and self.path[: depth * WIDTH] == self.first[: depth * WIDTH]

    def _key(self, depth: int) -> str:
        return sha256(self.path[: depth * WIDTH]).hexdigest()

    def add(self, path: bytes, conv_id: int, sizes: list[int]) -> None:
        if not self.stack:
            self.first = path
            self.stack.append(_Node(0, 0))
            common = 0
        else:
            common = common_depth(self.path, path)
            # What closes before the last path of the shard goes no further right.
            self._close(common, at_end=False)
        self.path = path
        for depth in range(common + 1, len(path) // WIDTH + 1):
            self.stack.append(_Node(depth, sizes[depth - 1]))
        end = self.stack[-1]
        end.take(1, conv_id)
        end.ends.append(str(conv_id))
        if len(end.ends) >= _ENDS_AT_ONCE:
            # It may turn out to go on in the next shard.
            self._flush(end, self._shared_left(end.depth) or end.depth <= self.right)

    def _flush(self, node: _Node, shared: bool) -> None:
        """Passes on ids that end at a node: into its hash, and as a row where other shards have more."""
        if not node.ends:
            return
        text = ",".join(node.ends)
        if shared:
            self.rows.append((_ENDS, self._key(node.depth), None, self.shard, node.place, *[None] * 7, text))
        if node.hash is None:
            node.hash = sha256(text.encode())
        else:
            node.hash.update(f",{text}".encode())
        node.place += 1
        node.ends = []

    def _close(self, depth: int, at_end: bool) -> None:
        """Closes all open nodes below ``depth``."""
        while len(self.stack) - 1 > depth:
            node = self.stack.pop()
            above = self.stack[-1] if self.stack else None
            before = self._shared_left(node.depth)
            after = at_end and node.depth <= self.right
            self._flush(node, before or after)
            # Counted where it opens. Nodes below it that close here hold a leaf each.
            node.saved += (node.convs - (not before)) * node.size
            node.leaves += not after and not node.leaves
            if above is not None:
                above.take(node.convs, node.conv_id)
                above.saved += node.saved
                above.leaves += node.leaves
                above.children += not before
            sums = (node.convs, node.children, node.leaves, node.saved)
            if before or after:
                key = self._key(node.depth)
                parent_key = self._key(node.depth - 1) if node.depth else None
                self.rows.append((_PART, key, parent_key, self.shard, 0, node.conv_id, node.depth, None, *sums, None))
                # Children that are whole wait for the smallest member of all shards.
                self.rows += [(_CHILD, None, key, self.shard, 0, *child) for child in node.pending]
            else:
                ends = (node.hash or sha256()).hexdigest()
                self.rows += [
                    (_WHOLE, None, None, self.shard, 0, *child[:2], node.conv_id, *child[3:]) for child in node.pending
                ]
                mine = (node.conv_id, node.depth, None, *sums, ends)
                if above is None:
                    self.rows.append((_WHOLE, None, None, self.shard, 0, *mine))
                else:
                    above.pending.append(mine)

    def finish(self) -> None:
        if self.stack:
            self._close(-1, at_end=True)


def _schema() -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (one.split() for one in _NODE.split(", "))])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, walk = _schema(), None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in schema.names]
        arrays = [pa.array(list(column), field.type) for column, field in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for batch in batches:
        names = {name: i for i, name in enumerate(batch.schema.names)}
        columns = [batch.column(names[x]).to_pylist() for x in ("shard", "left", "right", "path", "conv_id", "sizes")]
        done: list[tuple] = []
        for shard, left, right, path, conv_id, sizes in zip(*columns, strict=True):
            if walk is None or walk.shard != shard:
                if walk:
                    walk.finish()
                    done += walk.rows
                walk = Walk(shard, left, right)
            walk.add(path, conv_id, sizes)
        if walk:
            done += walk.rows
            walk.rows = []
        for at in range(0, len(done), 10_000):
            yield out(done[at : at + 10_000])
    if walk:
        walk.finish()
        for at in range(0, len(walk.rows), 10_000):
            yield out(walk.rows[at : at + 10_000])


def _hashed_ends(ends: DataFrame) -> DataFrame:
    """``key`` and the hash of its ids: chunks in shard order, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            keys, digests = [], []
            for found, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if found != key:
                    if key is not None:
                        keys.append(key)
                        digests.append(state.hexdigest())
                    key, state = found, sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(digests, pa.string())], ["key", "ends"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["key", "ends"])

    chunks = ends.repartition("key").sortWithinPartitions("key", "shard", "place").select("key", "ends")
    return chunks.mapInArrow(run, "key string, ends string")


def trie(listed: DataFrame) -> DataFrame:
    """A row per node of the trie of ``conv_id`` and ``turns``, with the columns of ``RESULT``."""
    spark: SparkSession = listed.sparkSession
    small_batches(spark)
    shards = _shards(_paths(listed))
    edges = skeleton(shards)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Two numbers a shard.
    known = shards.join(F.broadcast(edges), "shard")
    sorted_shards = known.repartitionByRange(parts, "shard").sortWithinPartitions("shard", "path", "conv_id")
    walked = materialize(
        sorted_shards.select("shard", "left", "right", "path", "conv_id", "sizes").mapInArrow(_walk, _NODE), "walked"
    )

    def of(kind: str) -> DataFrame:
        return walked.where(F.col("kind") == kind)

    reduced = of(_PART).groupBy("key", "parent_key", "depth").agg(
        F.min("conv_id").alias("conv_id"), *(F.sum(name).alias(name) for name in _SUMS)
    )
    reduced = materialize(reduced, "reduced")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    nodes = reduced.join(_hashed_ends(of(_ENDS)), "key", "left").withColumn("ends", F.coalesce("ends", nothing))
    parents = reduced.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    waiting = of(_CHILD).drop("parent_conv_id", "kind", "key", "shard", "place").unionByName(nodes.drop("key"))
    joined = waiting.join(parents, "parent_key", "left").withColumnRenamed("above", "parent_conv_id")
    columns: list[Column] = [F.col(name) for name in RESULT[:-1]] + [F.col("ends").alias(RESULT[-1])]
    return of(_WHOLE).select(*columns).unionByName(joined.select(*columns))
