"""A Merkle manifest of a dataset: content-addressed records, and proofs by descent.

Rows are leaves of one tree per ``tree`` name, in the order of their keys; the trees' roots are
the leaves of a tree above them. Two nodes in a row make their parent, the last one alone
if need be, until one node remains.

Nodes are stored as records from a digest to what stands below it. A record spans up to
``SPAN`` binary levels, so it names up to 2 ** ``SPAN`` children, and with them the digests in
between. Equal subtrees have equal digests and are one record. A record is built
from one group of at most that many nodes; each round of groups is that much smaller than the
one before, so a trillion rows take four.

Proofs come from the top. Requests for leaves start at the root and descend by the digits of
their rank to the base 2 ** ``SPAN``; requests that share their first digits travel as one row until
they part, so each record is fetched by its digest just once per place and no record is hot.
On the way a digit's bits select one child after the other, and the unselected ones are
collected; at the end the segments are reversed, and the path leads from the leaf to the root.

Ranks come from a range sort: rows are dealt out by range, written with their place, and
the ranges' sizes summed up, so that one large tree, one repeated key or a third of all
rows that are the same spread over many tasks.

Defined results: a null field is ``-``; a null key comes first, a null tree name before all
others; rows with one key follow in the order of their digests; rows that repeat are leaves of
their own. A tree of one leaf has that leaf as its root. A row with no siblings at all has the
digest of nothing as its proof. An empty table has no root, and the result no rows. Columns beyond
those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewise.llm.textops import small_batches
from casewise.sources.workspace import materialize

SPAN = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_HEX = 64
_SHIFT = 33  # Bits of monotonically_increasing_id below the partition.
_PAGE = "tree string, size bigint, page bigint, digest string, width int, nodes string"
_LEAF_PAGE = f"{_PAGE}, keys array<bigint>, claims array<string>"
_AT = "tree string, digest string, page bigint, steps array<string>"
_PROVED = (
    "tree string, key bigint, leaf string, top string, proof string, folded string, steps array<string>"
)


class Manifest(NamedTuple):
    """``records``: digest, width, nodes (the levels below, bottom-up, joined) of each round.
    ``requests``: tree, page, keys, claims of every leaf. ``roots``: tree, size, digest, round."""

    records: list[DataFrame]
    requests: DataFrame
    roots: DataFrame
    span: int


# --- digests ---------------------------------------------------------------------


def digest(*fields: Column) -> Column:
    """H of fields, each as its length in bytes, a colon and its text, or ``-`` if null."""
    texts = [field.cast("string") for field in fields]
    parts = [
        F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        for text in texts
    ]
    return F.sha2(F.concat(*parts), 256)


def _h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def grow(nodes: list[str], height: int) -> list[list[str]]:
    """The levels over ``nodes``, themselves first; ``height`` of them follow."""
    levels = [nodes]
    for _ in range(height):
        below = levels[-1]
        levels.append([_h("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return levels


def _depth(size: int) -> int:
    return (size - 1).bit_length()


def _levels(width: int, nodes: str) -> list[list[str]]:
    """The levels of a record, from its joined digests."""
    levels, at, left = [], 0, len(nodes) // _HEX
    while left:
        levels.append([nodes[i : i + _HEX] for i in range(at, at + width * _HEX, _HEX)])
        at, left, width = at + width * _HEX, left - width, (width + 1) // 2
    return levels


def descend(levels: list[list[str]]) -> list[list[str]]:
    """For every child of a record the unselected nodes on the way down to it, topmost first.

    A step is ``L`` or ``R`` with the digest on that side of the selected node, or empty where
    the node has no sibling.
    """
    ways: list[list[str]] = [[]]
    for level in reversed(levels[:-1]):
        below = []
        for place in range(len(level)):
            other = place ^ 1
            step = ("L" if other < place else "R") + level[other] if other < len(level) else ""
            below.append([*ways[place >> 1], step])
        ways = below
    return ways


def fold(node: str, steps: list[str]) -> str:
    """The digest that a node and the steps above it lead to."""
    for step in steps:
        node = _h(step[1:] + node if step[:1] == "L" else node + step[1:])
    return node


# --- ranks -----------------------------------------------------------------------


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` within ``tree``, from 0, and ``size`` of the tree."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    by = ["tree", *order, "_row"]
    dealt = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    dealt = materialize(dealt.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    dealt = dealt.withColumn("_part", F.shiftright("_place", _SHIFT))
    runs = dealt.groupBy("tree", "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first")
    )
    # As many rows of a tree as there are ranges.
    whole = Window.partitionBy("tree")
    runs = runs.select(
        "tree",
        "_part",
        (F.sum("_rows").over(whole.orderBy("_part")) - F.col("_rows") - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(whole).alias("size"),
    )
    joined = dealt.join(runs, ["tree", "_part"])
    return joined.withColumn("rank", F.col("_place") + F.col("_shift"))


# --- building --------------------------------------------------------------------


def _page_of(key: tuple[pa.Scalar, ...], table: pa.Table, round_: int, span: int) -> dict:
    tree, page = (part.as_py() for part in key)
    size = table.column("size")[0].as_py()
    digests = table.column("digest").to_pylist()
    levels = grow(digests, min(span, _depth(size) - span * round_))
    return {
        "tree": [tree], "size": [size], "page": [page], "digest": [levels[-1][0]],
        "width": [len(digests)], "nodes": ["".join(d for level in levels for d in level)],
    }


def _schema(fields: str) -> pa.Schema:
    kinds = {
        "string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(),
        "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (one.split() for one in fields.split(", "))])


def _pages(round_: int, span: int):
    """At the bottom a page also holds the requests for its leaves: keys and claims."""
    schema = _schema(_PAGE if round_ else _LEAF_PAGE)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        fields = _page_of(key, table, round_, span)
        if not round_:
            fields |= {"keys": [table.column("key").to_pylist()], "claims": [table.column("claim").to_pylist()]}
        return pa.table(fields, schema)

    return run


def _rows_of(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def build(leaves: DataFrame, span: int = SPAN) -> Manifest:
    """Trees over leaves with ``tree``, ``key`` (their order), ``digest`` and ``claim``.

    A claim is a digest that is to be proved in the leaf's place; it has no part in the tree.
    """
    small_batches(leaves.sparkSession)
    ranked = _ranked(leaves.select("tree", "key", "digest", "claim"), ["key", "digest"])
    nodes = ranked.select("tree", "size", "rank", "key", "digest", "claim")
    radix, largest, rounds = 1 << span, None, []
    while largest is None or largest > radix ** len(rounds):
        done = len(rounds)
        grouped = nodes.withColumn("page", F.shiftright("rank", span)).groupBy("tree", "page")
        made = materialize(grouped.applyInArrow(_pages(done, span), _PAGE if done else _LEAF_PAGE), f"round-{done}")
        rounds.append(made)
        if largest is None:
            largest = made.agg(F.coalesce(F.max("size"), F.lit(0))).first()[0]
        nodes = made.where(F.col("size") > radix ** len(rounds)).select(
            "tree", "size", F.col("page").alias("rank"), "digest"
        )
    roots = _rows_of(
        [
            made.where(F.col("size") <= radix ** (done + 1)).select("tree", "size", "digest", F.lit(done).alias("round"))
            for done, made in enumerate(rounds)
        ]
    )
    records = [made.select("digest", "width", "nodes").dropDuplicates(["digest"]) for made in rounds]
    return Manifest(records, rounds[0].select("tree", "page", "keys", "claims"), roots, span)


# --- proving ---------------------------------------------------------------------


def _next_requests(span: int):
    """Requests at a record part by their next digit and go on to its children."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema(_AT)
        for batch in batches:
            made = {name: [] for name in schema.names}
            for row in batch.to_pylist():
                levels = _levels(row["width"], row["nodes"])
                for digit, way in enumerate(descend(levels)):
                    made["tree"].append(row["tree"])
                    made["digest"].append(levels[0][digit])
                    made["page"].append((row["page"] << span) + digit)
                    made["steps"].append(way[::-1] + row["steps"])
            yield pa.RecordBatch.from_pydict(made, schema)

    return run


def _leaf_proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last digit: a proof for each request, and where its claim leads."""
    schema = _schema(_PROVED)
    for batch in batches:
        for row in batch.to_pylist():
            levels = _levels(row["width"], row["nodes"])
            above = row["steps"]
            text, ends = "".join(step[1:] for step in above), {}
            made = {name: [] for name in schema.names}
            for digit, way in enumerate(descend(levels)):
                way.reverse()
                node = fold(row["claims"][digit], way)
                if node not in ends:
                    ends[node] = fold(node, above)
                made["leaf"].append(levels[0][digit])
                made["proof"].append(_h("".join(step[1:] for step in way) + text))
                made["folded"].append(ends[node])
                made["steps"].append(way + above if row["with_steps"] else None)
            made |= {"key": row["keys"], "tree": [row["tree"]] * row["width"], "top": [row["top"]] * row["width"]}
            yield pa.RecordBatch.from_pydict(made, schema)


def prove(manifest: Manifest, starts: DataFrame, with_steps: bool = False) -> DataFrame:
    """A row for each leaf: ``tree``, ``key``, ``leaf``, ``top`` (its tree's root), ``proof``,
    ``folded`` (where the claim and the steps lead), and the ``steps``, bottom-up, if asked for.

    ``starts`` has the ``steps`` above each tree's root, by ``tree``.
    """
    small_batches(starts.sparkSession)
    roots = manifest.roots.join(starts.select("tree", "steps"), "tree")
    requests = None
    for done in reversed(range(len(manifest.records))):
        entering = roots.where(F.col("round") == done).select("tree", "digest", F.lit(0).cast("bigint").alias("page"), "steps")
        requests = entering if requests is None else requests.unionByName(entering)
        met = requests.join(manifest.records[done], "digest")
        if done:
            requests = met.select("tree", "page", "steps", "width", "nodes").mapInArrow(_next_requests(manifest.span), _AT)
    asked = met.join(manifest.requests, ["tree", "page"])
    asked = asked.join(roots.select("tree", F.col("digest").alias("top")), "tree")
    columns = ["tree", "steps", "width", "nodes", "keys", "claims", "top", F.lit(with_steps).alias("with_steps")]
    return asked.select(*columns).mapInArrow(_leaf_proofs, _PROVED)


def dataset_manifest(
    docs: DataFrame, leaf: Column, claim: Column, tree: Column, key: Column, span: int = SPAN
) -> DataFrame:
    """Every row proved up to the root of all trees: ``key``, ``leaf``, ``subroot``, ``root``,
    ``proof``, ``folded``.

    ``leaf`` and ``claim`` are digests, ``tree`` a name or null, ``key`` a whole number or null.
    """
    # Sorts like the names themselves, null first.
    name = F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit("-"))
    leaves = docs.select(
        name.alias("tree"), key.cast("bigint").alias("key"), leaf.alias("digest"), claim.alias("claim")
    )
    below = build(leaves, span)
    # The roots in the order of their names: a tree of one name above them.
    names = _ranked(below.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"])
    names = materialize(names.select("tree", F.col("rank").alias("key"), "name", "digest"), "roots")
    above = build(names.withColumn("claim", F.col("digest")), span)
    nothing = F.array().cast("array<string>").alias("steps")
    tops = prove(above, above.roots.select("tree", nothing), with_steps=True)
    tops = materialize(tops.select("key", F.col("top").alias("root"), "steps"), "tops")
    starts = names.join(tops, "key").select(F.col("name").alias("tree"), "root", "steps")
    proved = prove(below, starts)
    # One root in all.
    root = tops.agg(F.max("root").alias("root")).scalar()
    return proved.select("key", "leaf", F.col("top").alias("subroot"), root.alias("root"), "proof", "folded")
