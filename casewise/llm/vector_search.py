"""Exact top-k search by inner product over a vector-approximation file.

A vector's components are scaled and rounded down to integers. Vectors are dealt at random
into blocks of about ``BLOCK`` rows. A block is one row of the file: per dimension the edges
of at most ``CELLS`` cells, a byte per component that names its cell, and the exact vectors.
The edges are the block's own quantiles, the outer ones its own least and greatest values,
so no sample is fitted anywhere, and every vector lies inside its cells.

A search joins blocks of queries with blocks of the file. Within a pair of blocks the scan of
the cells gives two bounds of each score. The kth greatest lower bound rules most rows out; the
exact vectors of the others are read in the order of their upper bounds, until the kth exact
score is above the next bound. What a pair returns is at most k rows a query, and the best k of
all pairs are the result: exact, whatever the data, and no more than k rows per query and
block are ever shuffled, also where a third of all vectors are copies of one.

Defined results: vectors that are null, or hold a component that is null or not finite (also
after scaling), take no part. Only vectors of the same length are compared; those of length 0
score 0. A query's own row is no candidate, another row with the same id or vector is. Rows
without an id are candidates, behind all others at a tie, and can be queries if ``is_query``
says so. Scores beyond 64 bits stand as the nearest 64-bit number. An empty table gives no rows.
Columns other than the id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewise.llm.textops import small_batches
from casewise.sources.workspace import materialize

SCALE = 256
BLOCK = 8192
CELLS = 64

# Bounds of a pair of blocks that are held at a time, and exact vectors read at a time.
_SCANNED = 1 << 20
_READ_AT_ONCE = 64

_BLOCK_FIELDS = "dims int, block int, size int, rows binary, ids binary, exact binary"
_FILE_FIELDS = f"{_BLOCK_FIELDS}, edges binary, cells binary"
_FOUND_FIELDS = "query_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint"


def numbered(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The vectors that take part, each row with a number, written once."""
    values = F.col("vector").cast("array<double>")
    sound = F.forall(values, lambda x: x.isNotNull() & (F.abs(x) <= F.lit(1.7e308 / SCALE)))
    narrow = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("vector"))
    return materialize(narrow.where(sound).withColumn("row", F.monotonically_increasing_id()), "vectors")


# --- blocks ----------------------------------------------------------------------


def _unpacked(table: pa.Table, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids (the greatest number for none) and scaled vectors of a block."""
    vectors = table.column("vector").combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    exact = np.floor(flat * SCALE).reshape(len(vectors), dims)
    ids = table.column("vec_id").fill_null(np.iinfo(np.int64).max).to_numpy()
    return table.column("row").to_numpy(), ids, exact


def _as_bytes(exact: np.ndarray) -> bytes:
    small = np.abs(exact).max(initial=0) < 2**31
    return exact.astype("<i4" if small else "<f8").tobytes()


def _as_numbers(data: bytes, size: int, dims: int) -> np.ndarray:
    kind = "<i4" if len(data) == 4 * size * dims else "<f8"
    return np.frombuffer(data, kind).reshape(size, dims).astype(np.float64)


def _pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> dict:
    dims, block = (part.as_py() for part in key)
    rows, ids, exact = _unpacked(table, dims)
    return {
        "dims": [dims], "block": [block], "size": [len(rows)],
        "rows": [rows.astype("<i8").tobytes()], "ids": [ids.astype("<i8").tobytes()],
        "exact": [_as_bytes(exact)],
    }


def cells_of(exact: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the cells per dimension, ``cells + 1`` ascending numbers, and each component's cell.

    Cell c holds what is at least edge c and less than edge c + 1; the last one holds its
    upper edge too.
    """
    shares = np.linspace(0, 1, cells + 1)
    edges = np.quantile(exact, shares, axis=0, method="nearest") if len(exact) else np.zeros((cells + 1, exact.shape[1]))
    inner = edges[1:-1]
    found = np.empty(exact.shape, np.uint8)
    for d in range(exact.shape[1]):
        found[:, d] = np.searchsorted(inner[:, d], exact[:, d], "right")
    return edges, found


def _approximate(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    fields = _pack(key, table)
    dims, size = fields["dims"][0], fields["size"][0]
    edges, found = cells_of(_as_numbers(fields["exact"][0], size, dims))
    fields |= {"edges": [edges.astype("<f8").tobytes()], "cells": [found.tobytes()]}
    return pa.table(fields, _schema(_FILE_FIELDS))


def _schema(fields: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (one.split() for one in fields.split(", "))])


def _dealt(vectors: DataFrame, blocks: int) -> DataFrame:
    """By the row's number, so neither a repeated id nor a repeated vector makes a large block."""
    place = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    return vectors.select(F.size("vector").alias("dims"), place.alias("block"), "row", "vec_id", "vector")


def approximation_file(vectors: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """The file over ``numbered`` vectors: one row per block, written."""
    small_batches(vectors.sparkSession)
    blocks = max(1, -(-vectors.count() // block_rows))
    dealt = _dealt(vectors, blocks).groupBy("dims", "block")
    return materialize(dealt.applyInArrow(_approximate, _FILE_FIELDS), "va-file")


def query_blocks(queries: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """Queries out of ``numbered`` vectors as blocks, written."""
    small_batches(queries.sparkSession)
    blocks = max(1, -(-queries.count() // block_rows))

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return pa.table(_pack(key, table), _schema(_BLOCK_FIELDS))

    dealt = _dealt(queries, blocks).groupBy("dims", "block")
    return materialize(dealt.applyInArrow(pack, _BLOCK_FIELDS), "queries")


# --- search ----------------------------------------------------------------------


def bounds(queries: np.ndarray, edges: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products, from the cells alone."""
    dims = np.arange(cells.shape[1])
    # Below its upper edge, which is a whole number too; the last cell holds its edge.
    low, high = edges[cells, dims], edges[cells + 1, dims] - (cells < len(edges) - 2)
    middle, reach = (low + high) / 2, (high - low) / 2
    centre, spread = queries @ middle.T, np.abs(queries) @ reach.T
    # Sums of rounded products: a little wider than computed, so that they stay bounds.
    spread += 1e-12 * (np.abs(centre) + spread) + 1e-6
    return centre - spread, centre + spread


def _nearest(query: np.ndarray, skip: int, low: np.ndarray, high: np.ndarray, exact: np.ndarray, ids: np.ndarray, k: int):
    """Places and scores of a query's best k rows of a block, and how many rows were read."""
    if skip >= 0:
        low[skip] = high[skip] = -np.inf
    if len(low) > k:
        least = np.partition(low, len(low) - k)[len(low) - k]
        left = np.flatnonzero(high >= least)
    else:
        left = np.arange(len(low))
    if skip >= 0:
        left = left[left != skip]
    left = left[np.argsort(-high[left], kind="stable")]
    best, scores, read = np.empty(0, np.int64), np.empty(0), 0
    while read < len(left) and (len(best) < k or high[left[read]] >= scores[-1]):
        more = left[read : read + _READ_AT_ONCE]
        read += len(more)
        best = np.concatenate([best, more])
        scores = np.concatenate([scores, exact[more] @ query])
        order = np.lexsort((ids[best], -scores))[:k]
        best, scores = best[order], scores[order]
    return best, scores, read


def _whole_numbers(query: np.ndarray, skip: int, exact: np.ndarray, ids: np.ndarray, k: int):
    """The same for numbers so large that a double would round: in Python's integers, row by row."""
    ends = np.iinfo(np.int64)
    ours = [int(x) for x in query]
    scores = [
        min(max(sum(a * int(b) for a, b in zip(ours, row, strict=True)), ends.min), ends.max)
        for row in exact
    ]
    best = sorted((i for i in range(len(ids)) if i != skip), key=lambda i: (-scores[i], ids[i]))[:k]
    return np.array(best, np.int64), [scores[i] for i in best]


def search_block(pair: dict, k: int) -> tuple[dict[str, np.ndarray], int]:
    """The best k rows of a file's block for every query of a block, and the rows read in all."""
    dims, size, asked = pair["dims"], pair["size"], pair["query_size"]
    exact = _as_numbers(pair["exact"], size, dims)
    rows, ids = np.frombuffer(pair["rows"], "<i8"), np.frombuffer(pair["ids"], "<i8")
    queries = _as_numbers(pair["query_exact"], asked, dims)
    query_rows, query_ids = np.frombuffer(pair["query_rows"], "<i8"), np.frombuffer(pair["query_ids"], "<i8")
    edges = np.frombuffer(pair["edges"], "<f8")
    edges = edges.reshape(len(edges) // max(dims, 1), dims)
    cells = np.frombuffer(pair["cells"], np.uint8).reshape(size, dims)
    by_row = np.argsort(rows)
    at = np.minimum(np.searchsorted(rows, query_rows, sorter=by_row), size - 1)
    skips = np.where(rows[by_row[at]] == query_rows, by_row[at], -1)
    largest = float(np.abs(exact).max(initial=0)) * float(np.abs(queries).max(initial=0))
    found: list[tuple[int, np.ndarray, np.ndarray]] = []
    read = 0
    if largest * max(dims, 1) >= 2.0**53:
        for i in range(asked):
            found.append((i, *_whole_numbers(queries[i], skips[i], exact, ids, k)))
    else:
        step = max(1, _SCANNED // size)
        for first in range(0, asked, step):
            low, high = bounds(queries[first : first + step], edges, cells)
            for i in range(len(low)):
                best, scores, n = _nearest(queries[first + i], skips[first + i], low[i], high[i], exact, ids, k)
                found.append((first + i, best, scores.astype(np.int64)))
                read += n
    counts = [len(best) for _, best, _ in found]
    owner = np.repeat([i for i, _, _ in found], counts).astype(np.int64)
    best = np.concatenate([best for _, best, _ in found]) if found else np.empty(0, np.int64)
    scores = np.concatenate([np.asarray(s, np.int64) for _, _, s in found]) if found else best
    return {
        "query_row": query_rows[owner], "query_id": query_ids[owner],
        "row": rows[best], "vec_id": ids[best], "score": scores,
    }, read


def _without_id(column: np.ndarray) -> pa.Array:
    return pa.array(column, pa.int64(), mask=column == np.iinfo(np.int64).max)


def search(file: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of an approximation file for each query of ``query_blocks``.

    One row per query and rank: ``query_row``, ``query_id``, ``rank`` from 1, ``row``, ``vec_id``,
    ``score``; ties by the smaller id, then by the row's number. Each block of queries meets each
    block of the file in a join; a row of it is a pair of blocks of bounded size.
    """
    small_batches(file.sparkSession)
    schema = _schema(_FOUND_FIELDS)
    sizes = [
        frame.agg(F.coalesce(F.max("block"), F.lit(-1)).alias("last")) for frame in (file, queries)
    ]
    last_block, last_asked = (frame.scalar() for frame in sizes)
    asked = queries.select(
        "dims", F.col("block").alias("asked"), *(F.col(x).alias(f"query_{x}") for x in ("size", "rows", "ids", "exact")),
        F.explode(F.sequence(F.lit(0), F.greatest(last_block, F.lit(0)))).alias("block"),
    )
    met = file.withColumn("asked", F.explode(F.sequence(F.lit(0), F.greatest(last_asked, F.lit(0)))))
    pairs = met.join(asked, ["dims", "block", "asked"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                pair = {name: batch.column(i)[place].as_py() for i, name in enumerate(batch.schema.names)}
                found, _ = search_block(pair, k)
                found |= {name: _without_id(found[name]) for name in ("query_id", "vec_id")}
                yield pa.RecordBatch.from_arrays([pa.array(found[name]) for name in schema.names], schema=schema)

    best = Window.partitionBy("query_row").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row"
    )
    found = pairs.mapInArrow(run, _FOUND_FIELDS).withColumn("rank", F.row_number().over(best))
    return found.where(F.col("rank") <= k).select("query_row", "query_id", "rank", "row", "vec_id", "score")


def top_k(vectors: DataFrame, is_query: Column, k: int, block_rows: int = BLOCK) -> DataFrame:
    """``search`` for those of the vectors of which ``is_query``, a condition on ``vec_id``, is true."""
    table = numbered(vectors)
    return search(
        approximation_file(table, block_rows), query_blocks(table.where(is_query), block_rows), k
    )
