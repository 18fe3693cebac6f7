"""Near-duplicate classes by circulant MinHash, banding and exact verification.

Two fixed permutations make all coordinates of a signature: the first scatters
a shingle to a position of the universe, the second ranks positions, and
coordinate k is the least rank over the document's positions with the second
permutation shifted circularly by k.  Bands of coordinates name buckets.

Documents with the same shingle set are one class from the start, so a group of
copies costs one set of band rows.  Within a bucket no pairs are spelled out:
its smallest class is compared with every other one on the full sets (a star),
and the links found are joined into components.  Pairs across components of a
bucket then remain.  They are held against each other by parities, short bit
vectors that bound the difference of two sets from below: only pairs that can
still be linked become rows, and these are verified on the full sets.  A few members of
a bucket at a time meet the others, and the links found join components before more
do, so a large group of near copies does not come out pair by pair.

With 42 bands of 6 rows a pair at similarity 0.8 shares no bucket with
probability 3e-6, at 0.85 with 3e-9; set equality never misses.

Defined results: a null, empty or blank text has an empty set, no links and
itself as its component.  Rows that repeat an id are one node; rows with a null
id are not linked and keep a null component.  An empty table gives an empty
result.  Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from techmine.llm.common import prepare, small_side, stored
from techmine.llm.components import components

UNIVERSE_BITS = 22
BANDS, ROWS = 42, 6
MOST_CELLS = 1 << 14   # of a parity; larger sets share cells, which only rules less out
SEED = 20240607
WORD_CACHE = 300_000
FEW = (2, 128, None)   # members of a bucket that meet the others, round by round; None: all

_U64 = np.uint64
_M1, _M2 = _U64(0x9E3779B97F4A7C15), _U64(0xC2B2AE3D27D4EB4F)
_FINAL = (_U64(0xFF51AFD7ED558CCD), _U64(0xC4CEB9FE1A85EC53))


def _mix(x: np.ndarray) -> np.ndarray:
    for m in _FINAL:
        x = (x ^ (x >> _U64(33))) * m
    return x ^ (x >> _U64(33))


class Shingler:
    """Sets of distinct word shingles of whole texts, as sorted 64-bit hashes."""

    def __init__(self, width: int):
        self.width, self.cache = width, {}

    def __call__(self, text: str | None) -> np.ndarray:
        # bytes.lower changes A-Z only and bytes.split cuts at space and \t-\r.
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, _U64)
        cache = self.cache
        if len(cache) > WORD_CACHE:
            cache.clear()
        for w in set(words).difference(cache):
            cache[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(cache.__getitem__, words), _U64, len(words))
        width = min(self.width, len(h))
        n = len(h) - width + 1
        s = np.full(n, width, _U64)
        for k in range(width):
            s = _mix(s * _M1 + h[k:k + n] * _M2)
        return np.unique(s)


@lru_cache(maxsize=2)
def _ranks(count: int) -> np.ndarray:
    """Windows of the second permutation: row p holds the ranks of position p
    under its first ``count`` circular shifts."""
    size = 1 << UNIVERSE_BITS
    ranks = np.random.default_rng(SEED).permutation(size).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([ranks, ranks[:count]]), count)


# Positions handled at once; bounds the memory of a long text.
BLOCK = 1024


def signature(shingles: np.ndarray, count: int) -> np.ndarray:
    """Circulant MinHash of a non-empty set: ``count`` coordinates."""
    # The first permutation: a keyed bijection, cut to the universe.
    at = (_mix(shingles ^ _U64(SEED)) >> _U64(64 - UNIVERSE_BITS)).astype(np.int64)
    windows = _ranks(count)
    least = windows[at[:BLOCK]].min(axis=0)
    for k in range(BLOCK, len(at), BLOCK):
        np.minimum(least, windows[at[k:k + BLOCK]].min(axis=0), out=least)
    return least


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    s = sig.reshape(bands, rows).astype(_U64)
    key = np.arange(1, bands + 1, dtype=_U64) * _M1
    for k in range(rows):
        key = _mix(key * _M2 + s[:, k])
    return key


SIGNED = "id long, n long, k1 long, k2 long, bands array<long>"


def _sign(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for b in batches:
            sizes, k1, k2, keys = [], [], [], []
            for t in b.column(1).to_pylist():
                s = shingler(t)
                sizes.append(len(s))
                digest = xxhash.xxh3_128_intdigest(s.tobytes())
                k1.append(digest >> 64)
                k2.append(digest & (2 ** 64 - 1))
                if len(s):
                    keys.append(band_keys(signature(s, bands * rows), bands, rows).view(np.int64))
            ends = np.cumsum([bands * (n > 0) for n in sizes], dtype=np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([np.zeros(1, np.int32), ends])),
                pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(np.array(k1, _U64).view(np.int64)),
                 pa.array(np.array(k2, _U64).view(np.int64)), lists], ["id", "n", "k1", "k2", "bands"])
    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for b in batches:
            sets = [shingler(t).view(np.int64) for t in b.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], ["id", "shingles"])
    return run


class _Corpus:
    """The texts, to fetch the full sets of classes that are compared."""

    def __init__(self, rows: DataFrame, width: int, similarity: tuple[int, int]):
        self.rows, self.width, self.similarity = rows, width, similarity

    def sets_of(self, ids: DataFrame) -> DataFrame:
        """(id, shingles) of the documents with these distinct ``ids``."""
        wanted = small_side(stored(ids, "wanted"))
        return stored(self.rows.join(wanted, "id", "left_semi").mapInArrow(
            _sets(self.width), "id long, shingles array<long>"), "sets")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (a, b, distinct) with ``linked``, from the full sets."""
        pairs = stored(pairs, "pairs")
        sets = self.sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct())
        x = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
        y = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
        both = F.size(F.array_intersect("sa", "sb"))
        num, den = self.similarity
        out = (pairs.join(x, "b").join(y, "a").withColumn("both", both)
                    .withColumn("either", F.size("sa") + F.size("sb") - F.col("both"))
                    .select("a", "b", (F.lit(den) * F.col("both") >= F.lit(num) * F.col("either")).alias("linked")))
        return stored(out, "verified")


def components_of_classes(docs: DataFrame, classes: DataFrame, signed: DataFrame, width: int,
                          similarity: tuple[int, int]) -> DataFrame:
    """(node, component) of the class representatives that have verified links;
    the components are those of all links at or above the similarity."""
    num, den = similarity
    rep = signed.join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
    rows = stored(rep.select("id", "n", F.explode("bands").alias("key")), "bands")
    # Buckets of at least two classes; the smallest one is the centre of the star.
    buckets = (rows.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z"))
                   .where("a < z").select("key", "a"))
    members = stored(rows.join(stored(buckets, "buckets"), "key"), "members")
    corpus = _Corpus(docs.join(classes.select(F.col("rep").alias("id")), "id", "left_semi"), width, similarity)
    low, high = F.least("n", "an"), F.greatest("n", "an")
    centre_size = members.where("id = a").select("key", F.col("n").alias("an"))
    pairs = (members.where("id <> a").join(centre_size, "key")
                    .where(F.lit(den) * low >= F.lit(num) * high)  # the sizes alone can rule a link out
                    .select("a", F.col("id").alias("b")).distinct())
    found = corpus.verified(pairs).where("linked").select("a", "b")
    labels = stored(components(found), "labels")
    members = _open_buckets(members.where("id <> a").select("id", "n", "key"), labels)
    if members.isEmpty():
        return labels
    cells = stored(corpus.rows.join(small_side(stored(members.select("id").distinct(), "left")), "id", "left_semi")
                   .mapInArrow(_parities(corpus.width), "id long, cells array<long>"), "cells")
    for few in FEW:
        outside, every = _outside(members, few)
        more = corpus.verified(_across(outside, members, cells, similarity)).where("linked").select("a", "b")
        if not more.isEmpty():
            # Stars of the components found so far stand for their links.
            spanning = labels.select(F.col("component").alias("a"), F.col("node").alias("b"))
            labels = stored(components(spanning.union(more)), "labels")
        if every:
            break
        met = outside.select("key", "id")
        members = _open_buckets(members.select("id", "n", "key").join(met, ["key", "id"], "left_anti"), labels)
        if members.isEmpty():
            break
    return labels


def _open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, id, n, component) of buckets with a pair across components that was not
    compared; ``members`` (id, n, key) are those that have not met all others."""
    labels = labels.select(F.col("node").alias("id"), "component")
    tagged = (members.join(labels, "id", "left")
                     .withColumn("component", F.coalesce("component", "id")))
    tagged = stored(tagged, "tagged")
    state = tagged.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return stored(tagged.join(state.where("lo < hi").select("key"), "key"), "members")


def _outside(members: DataFrame, few: int | None) -> tuple[DataFrame, bool]:
    """The rows of ``members`` outside the most frequent component of their bucket, at
    most ``few`` of each bucket, and whether these are all.  All are taken at once if
    they meet no more rows than ``few`` of each bucket may."""
    per = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
    main = stored(per.groupBy("key").agg(F.max(F.struct("c", "component")).alias("m"), F.sum("c").alias("size")).select(
        "key", F.col("m.component").alias("main"), "size", (F.col("size") - F.col("m.c")).alias("apart")), "main")
    if few is not None:
        total, rows = main.agg(F.sum(F.col("apart") * F.col("size").cast("double")), F.sum("size")).first()
        few = None if total <= few * rows else few
    out = members.join(main.select("key", "main"), "key").where("component <> main").drop("main")
    if few is not None:
        # The same ids in all buckets, so that these compare fewer pairs.
        out = out.withColumn("at", F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("id"), "id")))
        out = out.where(F.col("at") <= few).drop("at")
    return stored(out, "outside"), few is None


def parity(shingles: np.ndarray, bits: int) -> np.ndarray:
    """For each of ``bits`` hash cells, whether an odd number of shingles lies in
    it, as 64-bit words.  Cells where two sets differ are at most as many as the
    shingles that only one of them has."""
    cell = (_mix(shingles ^ _U64(SEED + 1)) & _U64(bits - 1)).astype(np.int64)
    odd = (np.bincount(cell, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def parity_bits(n: int) -> int:
    """Cells for a set of ``n``: a power of two, about four to eight a shingle."""
    return max(64, min(MOST_CELLS, 1 << max(0, 4 * n - 1).bit_length()))


def _parities(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for b in batches:
            words = [parity(s, parity_bits(len(s))) for s in map(shingler, b.column(1).to_pylist())]
            ends = np.cumsum([0, *map(len, words)], dtype=np.int32)
            flat = np.concatenate(words) if words else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "cells"])
    return run


def _differing(x: Column, y: Column) -> Column:
    """Cells in which two parities differ: never more than the symmetric difference
    of the sets.  Half as many cells are made by folding; parities of yet other
    sizes rule nothing out."""
    def fold(c: Column) -> Column:
        half = (F.size(c) / 2).cast("int")
        return F.zip_with(F.slice(c, F.lit(1), half), F.slice(c, half + 1, half), lambda a, b: a.bitwiseXOR(b))

    def count(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, k: n + k)

    return (F.when(F.size(x) == F.size(y), count(x, y)).when(F.size(x) == 2 * F.size(y), count(fold(x), y))
             .when(2 * F.size(x) == F.size(y), count(x, fold(y))).otherwise(F.lit(0)))


def _across(outside: DataFrame, members: DataFrame, cells: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Candidate pairs (a, b) of a bucket across components, without loss.

    In each bucket the rows of ``outside`` meet the other members; a pair comes out
    only if the sizes and the parities of both sets leave room for the similarity.  A
    pair of this similarity differs in few shingles, so in few cells; one that falls
    short is ruled out by the cells with near certainty, and one that is linked never.
    """
    num, den = similarity
    x = outside.join(cells, "id")
    y = members.join(cells, "id").select("key", *[F.col(c).alias(f"{c}2") for c in ("id", "n", "component", "cells")])
    room = (F.lit(den) * F.least("n", "n2") >= F.lit(num) * F.greatest("n", "n2"))
    near = F.lit(num + den) * _differing(F.col("cells"), F.col("cells2")) <= F.lit(den - num) * (F.col("n") + F.col("n2"))
    pairs = x.join(y, (x["key"] == y["key"]) & (F.col("component") != F.col("component2")) & room & near)
    return pairs.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()


def near_classes(docs: DataFrame, width: int = 5, similarity: tuple[int, int] = (80, 100),
                 id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id
    reachable over links at or above the similarity), kept."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    signed = stored(rows.mapInArrow(_sign(width, BANDS, ROWS), SIGNED), "signed")
    classes = stored(signed.where("n > 0 and id is not null").groupBy("k1", "k2")
                           .agg(F.min("id").alias("rep")), "classes")
    labels = components_of_classes(rows, classes, signed, width, similarity).select(
        F.col("node").alias("rep"), "component")
    named = stored(classes.join(labels, "rep", "left")
                          .select("k1", "k2", F.coalesce("component", "rep").alias("component")), "named")
    out = (signed.select("id", "n", "k1", "k2").join(named, ["k1", "k2"], "left")
                 .withColumn("component_id", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component"))
                             .otherwise(F.col("id"))))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, width: int = 5, similarity: tuple[int, int] = (80, 100),
                     id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``: of each
    component the document with the smallest id."""
    lost = near_classes(docs, width, similarity, id_col, text).where("not kept").select(
        F.col(id_col).alias("__llm_lost")).distinct()
    lost = small_side(stored(lost, "near-lost"))
    return docs.join(lost, F.col(id_col) == F.col("__llm_lost"), "left_anti")
