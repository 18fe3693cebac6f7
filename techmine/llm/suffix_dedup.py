"""Removal of repeated byte strings by a range-partitioned sparse suffix array.

A byte goes if a string of ``length`` bytes that covers it also starts earlier
(smaller document, or same document and earlier start).  Equal strings have the
same smallest k-mer (by hash) at the same place, so only the suffixes that start
at such anchors, about 2.5 % of all, need to be sorted.

Suffixes carry their leading tokens (words of 8 bytes) and a 128-bit hash of
their stretch: all bytes of the strings that have this anchor.  Splitters sampled from
the corpus range-partition them by leading tokens; a key that spans several
splitters is spread over their buckets by stretch.  Buckets sort by multikey
quicksort and neighbours are compared:

* of equal stretches all but the first are repeated as a whole;
* different stretches of equal leading tokens can still share some strings.
  Those that agree with another one on enough bytes to the left or right are
  compared string by string, in a second round keyed by the string, which also
  compares across the boundaries of buckets.

Equal stretches and strings collapse in each task before they are shuffled, so
a passage found in a third of all documents costs one row per task.  Whole
copies of documents are set aside first by their digest.

Defined results: a null text is empty and nothing is removed.  Where ids repeat
or are null, rows are ordered by id (nulls first) and text digest, and of equal
rows one is the first.  An empty table gives an empty result.  Only the id and
text columns are read.  ``length`` can be 32 to 65,000 bytes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine.llm.common import partitions, prepare, small_side, stored
from techmine.operators.ids import dense_ids

LENGTH = 100
TOKENS = 3                    # leading tokens of 8 bytes: the k-mer of an anchor
KMER = 8 * TOKENS
SAMPLE_DOCS_PER_BUCKET = 24   # documents sampled for splitters, times buckets
SAMPLE_PER_BUCKET = 200       # suffixes expected of these, times buckets
SAMPLE_SUFFIXES = 400_000     # and at most in all
CHUNK = 400_000               # suffixes that a task collapses at once
BLOCK = 1 << 23               # bytes of a document handled at once
BUCKET_BYTES = 1 << 26        # suffix rows expected in a bucket
LENGTHS = (32, 65_000)        # lengths that the anchors and the fields below allow

_U64 = np.uint64
_POSITION = _U64((1 << 24) - 1)

SUFFIX = np.dtype([("t", "<u8", TOKENS), ("stretch", "<u8"), ("stretch2", "<u8"), ("left", "<u4"), ("right", "<u4"),
                   ("doc", "<i8"), ("low", "<u4"), ("off", "<u2"), ("span", "<u2")])
STRING = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("doc", "<i8"), ("low", "<u4")])
OUT = "doc long, low long, high long, off int, sides int"
ROUTED = "part int, kind int, rows binary"
SUFFIXES, REMOVED = 0, 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(33))) * _U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U64(33))) * _U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U64(33))


def _words(b: bytes) -> np.ndarray:
    """The 8 bytes from every position, as a number that sorts like them."""
    return np.ndarray((len(b) - 7,), ">u8", b, 0, (1,)).astype(np.uint64)


def anchors(b: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last start of its strings, and the word of every
    position, for one block of at least ``length`` bytes."""
    w = _words(b)
    m = len(b) - KMER + 1
    h = np.zeros(m, _U64)
    for t in range(0, KMER, 8):
        h = _mix(h * _U64(0x9E3779B97F4A7C15) + w[t:t + m])
    # Ties go to the first position; both share one number, so a minimum finds it.
    least = (h & ~_POSITION) | np.arange(m, dtype=_U64)
    window, have = length - KMER + 1, 1
    while have < window:
        step = min(have, window - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    at = (least & _POSITION).astype(np.int64)
    cut = np.flatnonzero(np.diff(at)) + 1
    low = np.concatenate([[0], cut])
    return at[low], low, np.concatenate([cut, [len(at)]]) - 1, w


def _side(length: int) -> int:
    """Of the bytes of a string beside its anchor's k-mer, at least so many lie
    on one side."""
    return (length - KMER + 1) // 2


def suffixes_of(doc: int, text: bytes, length: int) -> list[np.ndarray]:
    out = []
    side = _side(length)
    h32, h128 = xxhash.xxh3_64_intdigest, xxhash.xxh3_128_digest
    for start in range(0, max(1, len(text) - length + 1), BLOCK):
        b = text[start:start + BLOCK + length - 1]
        if len(b) < length:
            break
        at, low, high, w = anchors(b, length)
        rows = np.empty(len(at), SUFFIX)
        for k in range(TOKENS):
            rows["t"][:, k] = w[at + 8 * k]
        rows["doc"], rows["low"] = doc, low + start
        rows["off"], rows["span"] = at - low, high - low
        view = memoryview(b)
        ats = at.tolist()
        stretch = np.frombuffer(b"".join([h128(view[i:j + length], a - i) for a, i, j in zip(
            ats, low.tolist(), high.tolist(), strict=True)]), _U64).reshape(-1, 2)
        rows["stretch"], rows["stretch2"] = stretch[:, 0], stretch[:, 1]
        rows["left"] = np.fromiter((h32(view[max(0, a - side):a]) & 0xFFFFFFFF for a in ats), np.uint32, len(at))
        rows["right"] = np.fromiter((h32(view[a + KMER:a + KMER + side]) & 0xFFFFFFFF for a in ats), np.uint32, len(at))
        out.append(rows)
    return out


def _repeats(group_of_sorted: np.ndarray) -> np.ndarray:
    """Whether a sorted row equals the one before."""
    return np.concatenate([[False], group_of_sorted[1:] == group_of_sorted[:-1]]) if len(group_of_sorted) else \
        np.empty(0, bool)


def collapsed(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of equal stretches, and all the others."""
    order = np.lexsort((rows["low"], rows["doc"], rows["stretch2"], rows["stretch"]))
    rows = rows[order]
    again = _repeats(rows["stretch"]) & _repeats(rows["stretch2"])
    return rows[~again], rows[again]


def multikey_quicksort(tokens: np.ndarray) -> np.ndarray:
    """Order of rows of token columns: each part is split by a pivot's token at
    one depth into less, equal and greater; the equal ones go a token deeper."""
    n, depth_of = tokens.shape
    order = np.arange(n)
    todo = [(0, n, 0)]
    while todo:
        low, high, depth = todo.pop()
        if high - low < 2 or depth == depth_of:
            continue
        part = order[low:high]
        if high - low <= 64:
            order[low:high] = part[np.lexsort(tokens[part, depth:].T[::-1])]
            continue
        t = tokens[part, depth]
        some = np.sort(t[:: max(1, len(t) // 31)])
        pivot = some[len(some) // 2]
        less, equal = t < pivot, t == pivot
        a, e = int(less.sum()), int(equal.sum())
        order[low:high] = np.concatenate([part[less], part[equal], part[~less & ~equal]])
        todo += [(low, low + a, depth), (low + a, low + a + e, depth + 1), (low + a + e, high, depth)]
    return order


class Splitters:
    """Bucket of a suffix by its leading tokens."""

    def __init__(self, keys: np.ndarray, buckets: int):
        self.keys = np.ascontiguousarray(keys.astype(">u8")).view(f"S{KMER}").reshape(-1) if len(keys) else keys
        self.buckets = buckets

    def of(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(rows), np.int64)
        key = self._key(rows)
        first = np.searchsorted(self.keys, key, side="left")
        last = np.searchsorted(self.keys, key, side="right")
        # Equal to one splitter: the bucket behind it; to several: any of theirs.
        spread = (rows["stretch"] % np.maximum(last - first, 1).astype(np.uint64)).astype(np.int64)
        return np.where(last > first, first + 1 + spread, first)

    def spread(self, rows: np.ndarray) -> np.ndarray:
        """Whether suffixes with the same leading tokens can be in other buckets."""
        if not len(self.keys):
            return np.zeros(len(rows), bool)
        key = self._key(rows)
        return np.searchsorted(self.keys, key, side="right") - np.searchsorted(self.keys, key, side="left") > 1

    @staticmethod
    def _key(rows: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(rows["t"].astype(">u8")).view(f"S{KMER}").reshape(-1)


def _routed(parts: np.ndarray, rows: np.ndarray, kind: int) -> list[tuple[int, int, bytes]]:
    order = np.argsort(parts, kind="stable")
    parts, rows = parts[order], rows[order]
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
    return [(int(parts[i]), kind, rows[i:j].tobytes()) for i, j in zip(cuts, cuts[1:], strict=False) if j > i]


def _routed_batch(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()),
                                       pa.array([f[1] for f in found], pa.int32()),
                                       pa.array([f[2] for f in found], pa.binary())], ["part", "kind", "rows"])


SPAN = np.dtype([("doc", "<i8"), ("low", "<i8"), ("high", "<i8")])


def _spans(docs: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Byte ranges, overlapping and touching ones of a document joined."""
    order = np.lexsort((low, docs))
    docs, low, high = docs[order], low[order].astype(np.int64), high[order].astype(np.int64)
    if not len(docs):
        return np.empty(0, SPAN)
    new = np.concatenate([[True], docs[1:] != docs[:-1]])
    # Running end within a document: documents are set apart by a large offset.
    base = (np.cumsum(new) - 1) * (int(high.max()) + 1)
    reach = np.maximum.accumulate(high + base)
    start = new | np.concatenate([[True], (low + base)[1:] > reach[:-1]])
    first = np.flatnonzero(start)
    last = np.concatenate([first[1:], [len(docs)]]) - 1
    out = np.empty(len(first), SPAN)
    out["doc"], out["low"], out["high"] = docs[first], low[first], reach[last] - base[last]
    return out


def _route_removed(spans: np.ndarray, n: int) -> list[tuple[int, int, bytes]]:
    return _routed((_mix(spans["doc"].astype(_U64)) % _U64(n)).astype(np.int64), spans, REMOVED) if len(spans) else []


def _emit_suffixes(splitters: Splitters, length: int, n: int):
    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        first, again = collapsed(np.concatenate(held))
        spans = _spans(again["doc"], again["low"], again["low"].astype(np.int64) + again["span"] + length)
        return _routed_batch(_routed(splitters.of(first), first, SUFFIXES) + _route_removed(spans, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if text.is_valid:
                    held += suffixes_of(doc, text.as_buffer().to_pybytes(), length)
                    rows += len(held[-1]) if held else 0
                if rows >= CHUNK:
                    yield flush(held)
                    held, rows = [], 0
        if held:
            yield flush(held)
    return run


def _out(docs, low, high, off, sides) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(docs.astype(np.int64)), pa.array(low.astype(np.int64)), pa.array(high.astype(np.int64)),
         pa.array(off.astype(np.int32)), pa.array(sides.astype(np.int32))], ["doc", "low", "high", "off", "sides"])


def _out_spans(spans: np.ndarray) -> Iterator[pa.RecordBatch]:
    zero = np.zeros(len(spans), np.int32)
    if len(spans):
        yield _out(spans["doc"], spans["low"], spans["high"], zero, zero)


def _shared_sides(rows: np.ndarray, group: np.ndarray, side: str) -> np.ndarray:
    """Whether another row of the group has the same hash of that side."""
    order = np.lexsort((rows[side], group))
    g, s = group[order], rows[side][order]
    like = (g[1:] == g[:-1]) & (s[1:] == s[:-1])
    out = np.empty(len(rows), bool)
    out[order] = np.concatenate([like, [False]]) | np.concatenate([[False], like])
    return out


def _compare_suffixes(splitters: Splitters, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in batches:
            for kind, raw in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                data = raw.as_buffer().to_pybytes()
                if kind == REMOVED:
                    yield from _out_spans(np.frombuffer(data, SPAN))
                else:
                    held.append(np.frombuffer(data, SUFFIX))
        if not held:
            return
        first, again = collapsed(np.concatenate(held))
        held.clear()
        yield from _out_spans(_spans(again["doc"], again["low"], again["low"].astype(np.int64) + again["span"] + length))
        first = first[multikey_quicksort(first["t"])]
        same = np.concatenate([[False], (first["t"][1:] == first["t"][:-1]).all(axis=1)])
        group = np.cumsum(~same)
        sides = 1 * _shared_sides(first, group, "left") + 2 * _shared_sides(first, group, "right")
        sides[splitters.spread(first)] = 3  # others of this key are in other buckets
        ask = first[sides > 0]
        if len(ask):
            yield _out(ask["doc"], ask["low"], ask["low"].astype(np.int64) + ask["span"], ask["off"], sides[sides > 0])
    return run


# What a document's texts meet, packed so that it stays small beside them.
ASKED = np.dtype([("low", "<u4"), ("high", "<u4"), ("off", "<u2"), ("sides", "u1")])
RANGE = np.dtype([("low", "<u4"), ("high", "<u4")])


def _packed(kind: np.dtype, merge: bool):
    """(doc, rows): a document's list of structs as bytes; ranges are merged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            lists = b.column(1)
            ends = lists.offsets.to_numpy()
            flat = lists.flatten()
            cols = {n: flat.field(n).to_numpy() for n in kind.names}
            for i, j in zip(ends, ends[1:], strict=False):
                if merge:
                    s = _spans(np.zeros(j - i, np.int64), cols["low"][i - ends[0]:j - ends[0]],
                               cols["high"][i - ends[0]:j - ends[0]])
                    rows = np.empty(len(s), kind)
                    rows["low"], rows["high"] = s["low"], s["high"]
                else:
                    rows = np.empty(j - i, kind)
                    for n in kind.names:
                        rows[n] = cols[n][i - ends[0]:j - ends[0]]
                out.append(rows.tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["doc", "rows"])
    return run


def _strings(doc: int, text: bytes, asked: np.ndarray, length: int) -> np.ndarray:
    """The strings of a document that are to be compared one by one."""
    side = _side(length)
    starts = []
    for low, high, off, sides in asked.tolist():
        at = np.arange(low, high + 1)
        before = low + off - at  # bytes of the string left of the anchor
        starts.append(at[np.where(before >= side, bool(sides & 1), bool(sides & 2))])
    at = np.unique(np.concatenate(starts))
    rows = np.empty(len(at), STRING)
    w = _words(text)
    h1, h2 = np.zeros(len(at), _U64), np.full(len(at), 0x9E3779B97F4A7C15, _U64)
    for k in [*range(0, length - 8, 8), length - 8]:
        t = w[at + k]
        h1 = _mix(h1 * _U64(0x9E3779B97F4A7C15) + t)
        h2 = _mix((h2 ^ t) * _U64(0xC2B2AE3D27D4EB4F) + _U64(k + 1))
    rows["h1"], rows["h2"], rows["doc"], rows["low"] = h1, h2, doc, at
    return rows


def _first_strings(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((rows["low"], rows["doc"], rows["h2"], rows["h1"]))
    rows = rows[order]
    again = _repeats(rows["h1"]) & _repeats(rows["h2"])
    return rows[~again], rows[again]


def _emit_strings(length: int, n: int):
    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        first, again = _first_strings(np.concatenate(held))
        spans = _spans(again["doc"], again["low"], again["low"].astype(np.int64) + length)
        return _routed_batch(_routed((first["h1"] % _U64(n)).astype(np.int64), first, SUFFIXES)
                             + _route_removed(spans, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            for doc, text, asked in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                found = _strings(doc, text.as_buffer().to_pybytes(), np.frombuffer(asked, ASKED), length)
                held.append(found)
                rows += len(found)
                if rows >= CHUNK:
                    yield flush(held)
                    held, rows = [], 0
        if held:
            yield flush(held)
    return run


def _compare_strings(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in batches:
            for kind, raw in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                data = raw.as_buffer().to_pybytes()
                if kind == REMOVED:
                    yield from _out_spans(np.frombuffer(data, SPAN))
                else:
                    held.append(np.frombuffer(data, STRING))
        if held:
            _, again = _first_strings(np.concatenate(held))
            yield from _out_spans(_spans(again["doc"], again["low"], again["low"].astype(np.int64) + length))
    return run


def _sampled_splitters(rows: DataFrame, n_docs: int, n_bytes: int, buckets: int, length: int) -> Splitters:
    """Splitters from a sample of suffixes whose expected size is bounded: some
    documents, and of these every suffix whose hash is a multiple of ``thin``."""
    share = min(1.0, SAMPLE_DOCS_PER_BUCKET * buckets / max(1, n_docs))
    expected = n_bytes * share * 2 / (length - KMER + 2)
    thin = max(1, int(expected / min(SAMPLE_PER_BUCKET * buckets, SAMPLE_SUFFIXES)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [s for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True) if text.is_valid
                     for s in suffixes_of(doc, text.as_buffer().to_pybytes(), length)]
            if found:
                rows = np.concatenate(found)
                t = rows["t"][rows["stretch"] % _U64(thin) == 0]
                yield pa.RecordBatch.from_arrays([pa.array([t.tobytes()], pa.binary())], ["t"])

    found = rows.sample(share, seed=7).mapInArrow(run, "t binary").collect()
    keys = np.frombuffer(b"".join(bytes(r["t"]) for r in found), np.uint64).reshape(-1, TOKENS)
    if not len(keys):
        return Splitters(np.empty((0, TOKENS), np.uint64), buckets)
    keys = keys[np.lexsort(keys.T[::-1])]
    return Splitters(keys[(np.arange(1, buckets) * len(keys)) // buckets], buckets)


def _by_part(df: DataFrame, n: int) -> DataFrame:
    return df.repartitionById(n, F.col("part"))


def _cut():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(5)]
            for text, copy, spans in zip(b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                merged = [(0, len(raw))] if copy else np.frombuffer(spans or b"", RANGE).tolist()
                digest, at = hashlib.sha256(), 0
                for low, high in merged:
                    digest.update(raw[at:low])
                    at = high
                digest.update(raw[at:])
                for c, v in zip(cols, (len(raw), sum(h - lo for lo, h in merged), len(merged), digest.hexdigest(),
                                       [{"low": lo, "high": h} for lo, h in merged]), strict=True):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(),
                     pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())])))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                                             ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])
    return run


def repeated_strings(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256 and
    ``removed``, the byte ranges (low, high) that go."""
    if not LENGTHS[0] <= length <= LENGTHS[1]:
        raise ValueError(f"length must be {LENGTHS[0]} to {LENGTHS[1]}")
    spark = prepare(docs.sparkSession)
    sha = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text).alias("text"))
    keys = stored(rows.select("doc", size.alias("n"), sha.alias("sha")), "suffix-keys")
    ids = keys.groupBy("doc").agg(F.count(F.lit(1)).alias("c")).where("c > 1 or doc is null")
    names = None
    if not ids.isEmpty():  # ids that name no single row: number the rows
        rows = stored(dense_ids(rows.withColumn("sha", sha), [F.col("doc").asc_nulls_first(), "sha"], id_col="row"), "suffix-rows")
        names = rows.select(F.col("row").alias("id"), F.col("doc").alias("name"))
        rows = rows.select(F.col("row").alias("doc"), "text")
        keys = stored(rows.select("doc", size.alias("n"), sha.alias("sha")), "suffix-keys")
    copies = keys.where(F.col("n") >= length).groupBy("sha").agg(
        F.min("doc").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").select("sha", "first")
    copies = small_side(stored(copies, "suffix-copies"))
    flagged = rows.withColumn("sha", sha).join(copies, "sha", "left").withColumn(
        "copy", F.coalesce(F.col("doc") > F.col("first"), F.lit(False))).select("doc", "text", "copy")
    long_enough = F.octet_length("text") >= length
    firsts = flagged.where(~F.col("copy") & long_enough).select("doc", "text")

    n_docs, n_bytes = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    n = max(partitions(spark), math.ceil(n_bytes * 2 / (length - KMER + 2) * SUFFIX.itemsize / BUCKET_BYTES))
    splitters = _sampled_splitters(rows.where(long_enough), n_docs, n_bytes, n, length)
    routed = firsts.mapInArrow(_emit_suffixes(splitters, length, n), ROUTED)
    compared = stored(_by_part(routed, n).mapInArrow(_compare_suffixes(splitters, length), OUT), "suffixes")
    asked = compared.where("sides > 0").groupBy("doc").agg(
        F.collect_list(F.struct("low", "high", "off", "sides")).alias("asked"))
    asked = asked.mapInArrow(_packed(ASKED, merge=False), "doc long, rows binary").withColumnRenamed("rows", "asked")
    asked = small_side(stored(asked, "suffix-asked"))
    strings = rows.join(asked, "doc").select("doc", "text", "asked").mapInArrow(_emit_strings(length, n), ROUTED)
    more = stored(_by_part(strings, n).mapInArrow(_compare_strings(length), OUT), "strings")
    spans = compared.where("sides = 0").unionByName(more).groupBy("doc").agg(
        F.collect_list(F.struct("low", "high")).alias("spans"))
    spans = spans.mapInArrow(_packed(RANGE, merge=True), "doc long, rows binary").withColumnRenamed("rows", "spans")
    spans = small_side(stored(spans, "suffix-spans"))
    out = flagged.join(spans, "doc", "left").select("doc", "text", "copy", "spans").mapInArrow(
        _cut(), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "removed array<struct<low:long,high:long>>")
    if names is not None:
        out = out.join(names, "id").drop("id").withColumnRenamed("name", "id")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed")
