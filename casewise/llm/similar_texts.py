"""The first text of every group of similar ones: five-word shingles, exact similarity.

Two texts are similar if their sets of ``SHINGLE``-word shingles have a Jaccard similarity of
at least ``SIMILARITY``. Similar texts are linked, and linked documents form components.

Candidates come from SimHash first: the fingerprints of the shingle sets go through the index of
``near_duplicates``, and its links of up to two differing bits, and sets of one fingerprint, are
candidates. A forest of them is compared first, and then all pairs between what that left in
different components, so every pair of at most two bits is compared or joined otherwise. At 0.8 about ten of 64 bits differ, for which an index would need eleven copies of every
node on every level, so the less similar pairs come from MinHash as well: ``BANDS`` keys of ``ROWS`` minima each, of which a pair
of similarity 0.8 shares one or more with a probability of 0.9998. In each group of texts with
a common key all are compared with up to four of its members (first and last, smallest and
largest), so the candidates grow with the number of texts, not with the square of a group's
size. Every candidate is verified on the texts themselves, so no link is wrong. A pair that no
common group has as a centre can be missed; the README says how many are found, and what comparing
the rest of each group as well has cost.

Equal shingle sets are one class and enter once. Null and empty texts have no shingles and are
one class; a text of fewer words than a shingle is one shingle of them all. What is kept of a
component is what ``near_duplicates`` keeps.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from casewise.llm.near_duplicates import (
    SEED,
    apart,
    components,
    forest,
    index,
    keep_firsts,
    majority,
    rooted,
)
from casewise.llm.textops import byte_lists, lower, map_texts, small_batches
from casewise.sources.workspace import materialize

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 16
ROWS = 4
# Shingles whose minima are taken at once.
_CHUNK = 1 << 12

_FACTORS, _TERMS = np.random.default_rng(SEED).integers(
    0, 1 << 64, (2, BANDS * ROWS, 1), np.uint64
) | np.array([1, 0], np.uint64).reshape(2, 1, 1)


def shingles(text: bytes, shingle: int = SHINGLE) -> set[bytes]:
    words = lower(text).split()
    if len(words) < shingle:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))


def similarity(left: set[bytes], right: set[bytes]) -> float:
    common = len(left & right)
    return common / (len(left) + len(right) - common) if left or right else 1.0


def sketch(grams: set[bytes]) -> tuple[int, int, list[int]]:
    """The key of a shingle set, 0 if it is empty, its SimHash fingerprint and its keys by bands."""
    if not grams:
        return 0, 0, []
    hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), np.uint64, len(grams))
    hashes.sort()
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), _CHUNK):
        mixed = hashes[start : start + _CHUNK] * _FACTORS + _TERMS
        least = np.minimum(least, mixed.min(axis=1))
    rows = least.tobytes()
    wide = 8 * ROWS
    bands = [xxh64_intdigest(rows[wide * i : wide * (i + 1)], i) for i in range(BANDS)]
    return xxh64_intdigest(hashes.tobytes()), majority(hashes), bands


def _sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id``, ``text_key``, ``print``, ``simhash``, ``size`` and ``bands`` of every document."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))

    def make():
        def score(texts: list[bytes]) -> list[pa.Array]:
            sets = [shingles(text, shingle) for text in texts]
            found = [sketch(grams) for grams in sets]
            keys = np.array([key for key, _, _ in found], np.uint64).view(np.int64)
            simhashes = np.array([bits for _, bits, _ in found], np.uint64).view(np.int64)
            flat = np.array([key for _, _, bands in found for key in bands], np.uint64)
            offsets = np.cumsum([0, *(len(bands) for _, _, bands in found)])
            return [
                pa.array(keys),
                pa.array(simhashes),
                pa.array([len(grams) for grams in sets], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64))),
            ]

        return score

    made = "print bigint, simhash bigint, size bigint, bands array<bigint>"
    return map_texts(keyed, make, made, keep=("doc_id", "text_key"))


class _Prints(NamedTuple):
    """The fingerprints of the classes that have any shingles, and their index."""

    bits: DataFrame
    members: DataFrame


def _prints(classes: DataFrame) -> _Prints:
    bits = classes.where("size > 0").select("print", "simhash", "size")
    return _Prints(bits, index(bits.select(F.col("simhash").alias("print")).distinct()))


def _by_simhash(prints: _Prints) -> DataFrame:
    """``left``, ``right``: of the classes of one fingerprint the first with each other one, and
    the first ones of fingerprints that differ in few bits, as far as a forest links them.

    What stays apart in that is for ``_all_by_simhash``."""
    bits = prints.bits.select("print", "simhash")
    firsts = materialize(bits.groupBy("simhash").agg(F.min("print").alias("first")), "simhash-firsts")
    same = bits.join(firsts, "simhash").select(F.col("first").alias("left"), F.col("print").alias("right"))
    left, right = (
        firsts.select(F.col("simhash").alias(side), F.col("first").alias(f"{side}_first"))
        for side in ("left", "right")
    )
    near = forest(prints.members).join(left, "left").join(right, "right").select("left_first", "right_first")
    pairs = same.where("left <> right").union(near)
    return pairs.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right"))


def _all_by_simhash(prints: _Prints, roots: DataFrame, least: float) -> DataFrame:
    """``left``, ``right``: all classes of equal fingerprints, or of such that differ in few bits, that are
    not in one component yet and whose sizes allow them to be similar."""
    found = prints.bits.join(roots, F.col("print") == F.col("member"), "left")
    found = found.select("print", "simhash", "size", F.coalesce("root", "print").alias("root"))
    found = materialize(found, "simhash-roots")
    groups = found.groupBy("simhash").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    groups = materialize(groups.withColumnRenamed("simhash", "print"), "simhash-groups")
    several = groups.where("low < high").select(F.col("print").alias("left"), F.col("print").alias("right"))
    met = materialize(several.union(apart(prints.members, groups)), "simhash-met")
    left, right = (
        found.select(F.col("simhash").alias(side), F.struct("print", "size", "root").alias(f"{side}_one"))
        for side in ("left", "right")
    )
    pairs = met.join(left, "left").join(right, "right")
    sizes = F.least("left_one.size", "right_one.size") / F.greatest("left_one.size", "right_one.size")
    once = "left_one.root <> right_one.root AND (left <> right OR left_one.print < right_one.print)"
    ends = F.array("left_one.print", "right_one.print")
    return pairs.where(once).where(sizes >= least).select(
        F.array_min(ends).alias("left"), F.array_max(ends).alias("right")
    )


def _candidates(classes: DataFrame, least: float) -> DataFrame:
    """``left``, ``right``: classes with a common key whose sizes allow them to be similar."""
    slots = classes.select(F.struct("print", "size").alias("one"), F.explode("bands").alias("key"))
    by_size = F.struct("one.size", "one.print")
    centres = (
        slots.groupBy("key")
        .agg(
            F.min("one").alias("first"),
            F.max("one").alias("last"),
            F.min(by_size).alias("small"),
            F.max(by_size).alias("large"),
        )
        .where("first.print < last.print")
    )
    ends = [F.struct(f"{end}.print", f"{end}.size") for end in ("first", "last", "small", "large")]
    centres = centres.select("key", F.array_distinct(F.array(*ends)).alias("centres"))
    # Written, so that the join below reads two shuffles and can split a hot key.
    centres = materialize(centres, "similar-centres")
    met = slots.join(centres, "key").select("one", F.explode("centres").alias("centre"))
    sizes = F.least("one.size", "centre.size") / F.greatest("one.size", "centre.size")
    pairs = met.where("one.print <> centre.print").where(sizes >= least)
    return pairs.select(
        F.least("one.print", "centre.print").alias("left"),
        F.greatest("one.print", "centre.print").alias("right"),
    )


def _verified(joined: DataFrame, shingle: int, least: float) -> DataFrame:
    schema = pa.schema([("left", pa.int64()), ("right", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, grams = None, set()
        for batch in batches:
            texts = zip(byte_lists(batch.column("text")), byte_lists(batch.column("other")), strict=True)
            alike = []
            for text, other in texts:
                if text != last:
                    last, grams = text, shingles(text, shingle)
                alike.append(similarity(grams, shingles(other, shingle)) >= least)
            found = pa.array(alike, pa.bool_())
            columns = [batch.column(name).filter(found) for name in schema.names]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return joined.mapInArrow(run, "left bigint, right bigint")


def _links_of(docs: DataFrame, classes: DataFrame, pairs: DataFrame, shingle: int, least: float) -> DataFrame:
    """Those of the pairs whose texts are similar."""
    wanted = pairs.select(F.explode(F.array("left", "right")).alias("print")).distinct()
    wanted = classes.join(wanted, "print").select("print", F.col("first.text_key").alias("text_key"))
    texts = (
        docs.select(F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))
        .join(materialize(wanted, "similar-wanted"), "text_key")
        .groupBy("print")
        .agg(F.first("text").alias("text"))
    )
    texts = materialize(texts, "similar-texts")
    lefts = texts.withColumnRenamed("print", "left")
    rights = texts.select(F.col("print").alias("right"), F.col("text").alias("other"))
    joined = pairs.join(lefts, "left").join(rights, "right")
    return _verified(joined.select("left", "right", "text", "other"), shingle, least)


def similar_roots(
    docs: DataFrame, classes: DataFrame, shingle: int = SHINGLE, least: float = SIMILARITY
) -> DataFrame:
    """``member``, ``root``: the components of verified links between the classes of ``docs``.

    After the first pass every pair that SimHash gives and that is in no common component is compared too, so
    that no link between two of its fingerprints depends on which pairs a forest happens to hold.
    """
    prints = _prints(classes)
    pairs = _by_simhash(prints).unionByName(_candidates(classes, least)).distinct()
    pairs = materialize(pairs, "similar-candidates")
    roots = components(_links_of(docs, classes, pairs, shingle, least))
    rest = _all_by_simhash(prints, roots, least).distinct().join(pairs, ["left", "right"], "left_anti")
    rest = materialize(rest, "similar-rest")
    if rest.isEmpty():
        return roots
    more = _links_of(docs, classes, rest, shingle, least)
    return components(roots.select(F.col("root").alias("left"), F.col("member").alias("right")).unionByName(more))


def drop_similar(docs: DataFrame, shingle: int = SHINGLE, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stand first in their component, one for each."""
    small_batches(docs.sparkSession)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    classes = _sketches(docs, shingle).groupBy("print").agg(
        first.alias("first"),
        *(F.first(name).alias(name) for name in ("simhash", "size", "bands")),
    )
    classes = materialize(classes, "similar-classes")
    return keep_firsts(docs, rooted(classes, similar_roots(docs, classes, shingle, least)))
