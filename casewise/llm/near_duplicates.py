"""SimHash near-duplicates through a Gray-ordered hierarchical index.

A fingerprint is 64 bits, a bit being set where over half of the text's hashed shingles
have it. Fingerprints of at most two differing bits are linked, and linked documents form
components.

The index is a tree of masked patterns. An upper node is a pair (mask, value): all of its
fingerprints agree on the bits of ``mask``. Its free bits are cut into three blocks and
each child fixes one of them; two fingerprints two bits apart agree on at least one block,
so they meet in some child. Nodes are split, level by level, until they hold no more than
``LEAF`` fingerprints; fewer than 64 free bits remain at every level, so this always ends.
Thus no task ever holds more than a leaf, however alike the fingerprints are.

Inside a leaf the fingerprints stand in Gray order, where neighbours differ in few bits.
Each run of ``FAN`` neighbours is a node whose pattern holds the bits on which all of them
agree, runs of such nodes form the next level, and a child keeps only the bits its parent
has not settled. A search goes down from the top, adds up the differences pattern by
pattern, and drops a whole group as soon as they exceed the limit.

A leaf gives a spanning forest of its links rather than all pairs (``apart`` gives the pairs
between what is not joined yet, for those who check links); the forests are joined
by alternating large-star and small-star steps. Exact copies share a fingerprint and enter
the index once.

Null and empty texts have no words: fingerprint zero, linked like any other. Repeated rows
get the same component. Documents without an id never name a component; where no member
has an id, the component is null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh64_intdigest

from casewise.llm.textops import lower, map_texts, ranges
from casewise.sources.workspace import materialize

SHINGLE = 3
SEED = 42
DISTANCE = 2
LEAF = 1024
FAN = 8
# Rows that a task searches at once; leaves stay whole.
_CHUNK = 4096
# Links in a batch that a task gives back.
_PAIRS = 1 << 16
_ALL = (1 << 64) - 1


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of one text, 0 where it has no words."""
    words = lower(text).split()
    if not words:
        return 0
    if len(words) < shingle:
        grams, count = [b" ".join(words)], 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        count = len(words) - shingle + 1
    return majority(np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), np.uint64, count))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones, count = np.zeros(64, np.int64), len(hashes)
    for start in range(0, count, 1 << 14):
        octets = hashes[start : start + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_key`` and ``print`` of every document."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))

    def make():
        def score(texts: list[bytes]) -> list[pa.Array]:
            found = np.array([fingerprint(text, shingle) for text in texts], np.uint64)
            return [pa.array(found.view(np.int64))]

        return score

    return map_texts(keyed, make, "print bigint", keep=("doc_id", "text_key"))


# --- the upper nodes ---------------------------------------------------------------


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _children(mask: int) -> list[int]:
    """The masks that fix one third of the free bits as well."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    cuts = [len(free) * part // 3 for part in range(4)]
    return [mask | sum(1 << bit for bit in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _split(nodes: DataFrame, masks: list[int]) -> DataFrame:
    table = F.create_map(
        *(
            F.lit(entry)
            for mask in masks
            for entry in (_signed(mask), [_signed(child) for child in _children(mask)])
        )
    )
    return nodes.select("print", F.explode(F.element_at(table, F.col("mask"))).alias("mask"))


def _leaves(prints: DataFrame, leaf: int) -> DataFrame:
    """``print``, ``mask``: every fingerprint once in each leaf where it has company."""
    masks, leaves = [0], None
    nodes = _split(prints.select("print", F.lit(0).cast("bigint").alias("mask")), masks)
    while True:
        masks = sorted({child for mask in masks for child in _children(mask)})
        nodes = nodes.withColumn("value", F.col("print").bitwiseAND(F.col("mask")))
        sizes = nodes.groupBy("mask", "value").agg(F.count("*").alias("size")).where("size > 1")
        sized = materialize(nodes.join(sizes, ["mask", "value"]), "simhash-level")
        level = sized.where(F.col("size") <= leaf).select("print", "mask", "value")
        leaves = level if leaves is None else leaves.unionByName(level)
        large = sized.where(F.col("size") > leaf)
        if large.isEmpty():
            return leaves
        nodes = _split(large, masks)


def _gray_rank(code: Column) -> Column:
    """The place of ``code`` in the reflected Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


# --- inside a leaf -----------------------------------------------------------------


class GrayTree:
    """Masked patterns over Gray-ordered fingerprints, a tree for each leaf node.

    ``prints`` holds the members of all leaves, one leaf after the other; ``firsts`` says
    where each leaf begins.
    """

    def __init__(self, prints: np.ndarray, firsts: np.ndarray):
        self.prints = prints
        every, some = prints, prints  # bits that all, and that any, of the members have
        starts = np.append(firsts, len(prints))
        self.levels = []  # from the members up: first child of each node, masks, values
        last = np.arange(1, len(prints) + 1)  # one behind the last member of each node
        while True:
            counts = np.diff(starts)
            groups = -(-counts // FAN)
            above = np.concatenate([[0], np.cumsum(groups)])
            inside = np.arange(above[-1]) - np.repeat(above[:-1], groups)
            first = np.repeat(starts[:-1], groups) + inside * FAN
            every = np.bitwise_and.reduceat(every, first)
            some = np.bitwise_or.reduceat(some, first)
            last = last[np.append(first[1:], starts[-1]) - 1]
            self.levels.append((np.append(first, starts[-1]), ~(every ^ some), every, last))
            starts = above
            if groups.max(initial=0) <= 1:
                break

    def links(self, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of all pairs of one leaf that differ in at most ``distance`` bits."""
        top = self.levels[-1]
        sizes = np.diff(np.concatenate([[0], top[3]]))
        query = np.arange(len(self.prints))
        node = np.repeat(np.arange(len(sizes)), sizes)
        gap = np.bitwise_count((self.prints[query] ^ top[2][node]) & top[1][node])
        for depth in range(len(self.levels) - 1, -1, -1):
            keep = gap <= distance
            query, node, gap = query[keep], node[keep], gap[keep]
            first, settled = self.levels[depth][:2]
            counts = first[node + 1] - first[node]
            child = ranges(first[node], counts)
            query, gap = np.repeat(query, counts), np.repeat(gap, counts)
            rest = ~np.repeat(settled[node], counts)
            if depth:
                _, mask, value, last = self.levels[depth - 1]
                rest &= mask[child]
                later = last[child] > query + 1
            else:
                value, later = self.prints, child > query
            child, query, gap, rest = child[later], query[later], gap[later], rest[later]
            gap = gap + np.bitwise_count((self.prints[query] ^ value[child]) & rest)
            node = child
        keep = gap <= distance
        return query[keep], node[keep]


def _forest(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest place linked to each place."""
    root = np.arange(count)
    while True:
        before = root.copy()
        low = np.minimum(root[left], root[right])
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if np.array_equal(before, root):
            return root


def _search(distance: int, grouped: bool = False):
    schema = pa.schema([("left", pa.int64()), ("right", pa.int64())])
    names = ("mask", "value", "print", *(("low", "high") if grouped else ()))

    def edges(firsts: np.ndarray, prints: np.ndarray, *ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        left, right = GrayTree(prints.view(np.uint64), firsts).links(distance)
        if grouped:
            low, high = ends
            one = (low[left] == high[left]) & (low[right] == high[right]) & (low[left] == low[right])
            left, right = left[~one], right[~one]
        else:
            root = _forest(len(prints), left, right)
            right = np.flatnonzero(root != np.arange(len(prints)))
            left = root[right]
        for start in range(0, len(left), _PAIRS):
            some = slice(start, start + _PAIRS)
            columns = [pa.array(prints[left[some]]), pa.array(prints[right[some]])]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * len(names)
        for batch in batches:
            held = [
                np.concatenate([a, batch.column(name).to_numpy()])
                for a, name in zip(held, names, strict=True)
            ]
            while len(held[0]) >= _CHUNK:
                firsts = _firsts(*held[:2])
                # Leaves that surely are whole, as many as the chunk has.
                whole = firsts[max(1, np.searchsorted(firsts, _CHUNK, "right") - 1) :][:1]
                if not whole.size:
                    break
                cut = int(whole[0])
                yield from edges(firsts[firsts < cut], *(a[:cut] for a in held[2:]))
                held = [a[cut:] for a in held]
        if len(held[0]):
            yield from edges(_firsts(*held[:2]), *held[2:])

    return run


def _firsts(mask: np.ndarray, value: np.ndarray) -> np.ndarray:
    new = (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])
    return np.concatenate([[0], np.flatnonzero(new) + 1])


def links(prints: DataFrame, distance: int = DISTANCE, leaf: int = LEAF) -> DataFrame:
    """``left``, ``right``: a spanning forest, leaf by leaf, of all links between the
    distinct fingerprints of ``prints``."""
    return forest(index(prints, leaf), distance)


def index(prints: DataFrame, leaf: int = LEAF) -> DataFrame:
    """The members of all leaves, for one search or more."""
    return _leaves(prints, leaf)


def forest(members: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``links`` of an ``index``."""
    return _searched(members, _search(distance), distance)


def apart(members: DataFrame, groups: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``left``, ``right``: every link of an ``index``, but for those within one group.

    ``groups`` has of each fingerprint, ``print``, the ``low`` and the ``high`` end of its groups.
    """
    return _searched(members.join(groups, "print"), _search(distance, grouped=True), distance)


def _searched(members: DataFrame, search: Callable, distance: int) -> DataFrame:
    if not 0 <= distance <= 2:
        raise ValueError("three blocks find links of at most two differing bits")
    free = F.col("print").bitwiseAND(F.bitwise_not("mask"))
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        members.withColumn("rank", _gray_rank(free))
        .repartition(n, "mask", "value")
        .sortWithinPartitions("mask", "value", "rank")
    )
    found = ordered.drop("rank").mapInArrow(search, "left bigint, right bigint")
    return found.distinct()


# --- components --------------------------------------------------------------------


def _smaller_first(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.greatest("left", "right").alias("high"), F.least("left", "right").alias("low")
    ).where("high <> low")


def components(edges: DataFrame) -> DataFrame:
    """``member``, ``root``: the smallest value that each end of ``edges`` is linked to;
    roots themselves have no row.

    Alternating steps hang every neighbourhood on its smallest member, first the larger
    neighbours, then the smaller ones, until all trees are stars. A hub is only ever met
    in pre-aggregated minima and in joins whose large side can be split.
    """
    pairs = materialize(_smaller_first(edges).distinct(), "component-pairs")
    while True:
        both = pairs.unionByName(pairs.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.min("low").alias("least"))
        hung = both.join(least, "high").where("low > high")
        large = hung.select(
            F.col("low").alias("high"), F.least("least", "high").alias("low")
        ).where("high <> low").distinct()
        large = materialize(large, "component-large")
        least = large.groupBy("high").agg(F.min("low").alias("least"))
        hung = large.join(least, "high").where("low <> least")
        pairs = materialize(
            hung.select(F.col("low").alias("high"), F.col("least").alias("low"))
            .unionByName(least.select("high", F.col("least").alias("low")))
            .distinct(),
            "component-small",
        )
        loose = pairs.groupBy("high").agg(F.count("*").alias("n")).where("n > 1").select("high")
        hanging = pairs.join(pairs.select(F.col("high").alias("low")), "low", "left_semi")
        if loose.isEmpty() and hanging.isEmpty():
            return pairs.select(F.col("high").alias("member"), F.col("low").alias("root"))


def rooted(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """``print``, ``root`` and the ``first`` document of the whole component, per class."""
    found = classes.join(roots, classes["print"] == roots["member"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    firsts = found.groupBy("root").agg(F.min("first").alias("first"))
    return found.select("print", "root").join(firsts, "root")


def _classes(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Documents with their fingerprints, and per fingerprint its component."""
    shingle = options.pop("shingle", SHINGLE)
    documents = materialize(fingerprints(docs, shingle), "simhash-prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    classes = materialize(documents.groupBy("print").agg(first.alias("first")), "simhash-classes")
    roots = components(links(classes.select("print"), **options))
    return documents, rooted(classes, roots)


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``print``, ``component_id``: the smallest id reachable by links."""
    documents, classes = _classes(docs, **options)
    return documents.join(
        classes.select("print", F.col("first.doc_id").alias("component_id")), "print"
    ).select("doc_id", "print", "component_id")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stand first in their component, one for each."""
    return keep_firsts(docs, _classes(docs, **options)[1])


def keep_firsts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the first document of a component, each once.

    Whole rows are cut by the semi join first; only what is left is ranked.
    """
    kept = classes.where("print = root").select(
        F.col("first.doc_id").alias("kept_id"), F.col("first.text_key").alias("kept_key")
    )
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_key"))
    copies = Window.partitionBy("doc_id", "text_key").orderBy(F.xxhash64("row"))
    firsts = rows.join(
        kept,
        F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key")),
        "left_semi",
    )
    return firsts.withColumn("copy", F.row_number().over(copies)).where("copy = 1").select("row.*")
