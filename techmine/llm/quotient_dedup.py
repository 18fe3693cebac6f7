"""Exact dedup by counting quotient filters merged by sorted remainders.

Each partition puts the 64-bit fingerprints of its normalised texts into a
counting quotient filter: the high bits (quotient) name a run, the run holds the
sorted low bits (remainders), each with a count.  All 64 bits are kept, so a
filter is lossless, and cutting it at quotient boundaries gives slices that are
filters of a narrower range.  Slices of one range from all partitions meet in
one task and merge by their sorted remainders, counts adding up.  A copy found
in a third of all rows is one entry per partition there.  Fingerprints with a
count above one send their rows to verification by bytes: the whole normalised
texts are grouped, so equal fingerprints of different texts part again.

Defined results: a null text is the empty text, so all of these are equal to
each other; of equal texts the row with the largest id stays (nulls are the
smallest ids).  Rows that repeat an id with an equal text count one by one in
``group_size`` and share the verdict.  An empty table gives an empty result.
Columns other than id and text are not read by ``classes`` and pass through
``drop_copies`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine.llm.common import ascii_lower, partitions, prepare, small_side, stored, text_or_empty

SLICE_BITS_MIN = 4
SLICE_ROWS = 1 << 22  # fingerprints expected in a slice, copies included


class CountingQuotientFilter:
    """Counts of 64-bit fingerprints, runs in quotient order.

    ``run_ends[q]`` is where the run of quotient ``q`` ends in ``remainders``
    and ``counts``; remainders are sorted within a run and have no repeats.
    """

    def __init__(self, prefix: int, prefix_bits: int, quotient_bits: int,
                 run_ends: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.prefix, self.prefix_bits, self.quotient_bits = prefix, prefix_bits, quotient_bits
        self.run_ends, self.remainders, self.counts = run_ends, remainders, counts

    @staticmethod
    def of(fingerprints: np.ndarray, counts: np.ndarray, prefix: int = 0, prefix_bits: int = 0):
        """Filter of sorted distinct ``fingerprints`` that share their top bits."""
        q_bits = min(max(1, int(len(fingerprints)).bit_length()), 64 - prefix_bits - 1)
        r_bits = np.uint64(64 - prefix_bits - q_bits)
        quotients = (fingerprints >> r_bits) & np.uint64((1 << q_bits) - 1)
        run_ends = np.searchsorted(quotients, np.arange(1 << q_bits, dtype=np.uint64), side="right")
        remainders = fingerprints & ((np.uint64(1) << r_bits) - np.uint64(1))
        return CountingQuotientFilter(prefix, prefix_bits, q_bits, run_ends.astype(np.uint32), remainders, counts)

    def fingerprints(self) -> np.ndarray:
        """The sorted distinct fingerprints, whole again."""
        r_bits = 64 - self.prefix_bits - self.quotient_bits
        lengths = np.diff(self.run_ends, prepend=np.uint32(0))
        quotients = np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths)
        top = (self.prefix << (64 - self.prefix_bits)) if self.prefix_bits else 0
        return np.uint64(top) | (quotients << np.uint64(r_bits)) | self.remainders

    def merged(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        """Both filters as one; runs merge in the order of their remainders."""
        f = np.concatenate([self.fingerprints(), other.fingerprints()])
        n = np.concatenate([self.counts, other.counts])
        order = np.argsort(f, kind="stable")  # two sorted runs: a merge
        f, n = f[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]])) if len(f) else np.array([], dtype=int)
        return CountingQuotientFilter.of(f[first], np.add.reduceat(n, first) if len(f) else n,
                                         self.prefix, self.prefix_bits)

    def slices(self, bits: int) -> Iterator[CountingQuotientFilter]:
        """The non-empty sub-filters of each value of the top ``bits``."""
        f = self.fingerprints()
        tops = (f >> np.uint64(64 - bits)).astype(np.int64)
        for top in np.unique(tops):
            low, high = np.searchsorted(tops, [top, top + 1])
            yield CountingQuotientFilter.of(f[low:high], self.counts[low:high], int(top), bits)

    def to_bytes(self) -> bytes:
        r_bytes = (64 - self.prefix_bits - self.quotient_bits + 7) // 8
        lengths = np.diff(self.run_ends, prepend=np.uint32(0)).astype("<u4")
        cut = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :r_bytes]
        return b"".join([bytes([self.prefix_bits, self.quotient_bits, r_bytes]),
                         np.array([self.prefix, len(self.remainders)], "<u8").tobytes(), lengths.tobytes(),
                         cut.tobytes(), self.counts.astype("<u8").tobytes()])

    @staticmethod
    def from_bytes(b: bytes) -> CountingQuotientFilter:
        prefix_bits, q_bits, r_bytes = b[:3]
        prefix, n = (int(x) for x in np.frombuffer(b, "<u8", 2, 3))
        at = 19
        lengths = np.frombuffer(b, "<u4", 1 << q_bits, at)
        at += 4 << q_bits
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :r_bytes] = np.frombuffer(b, np.uint8, n * r_bytes, at).reshape(n, r_bytes)
        at += n * r_bytes
        counts = np.frombuffer(b, "<u8", n, at).astype(np.uint64)
        return CountingQuotientFilter(prefix, prefix_bits, q_bits, np.cumsum(lengths, dtype=np.uint32),
                                      wide.reshape(-1).view("<u8").astype(np.uint64), counts)


# Fingerprints gathered before they are folded into the partition's filter.
FOLD_ROWS = 1 << 20


def _partition_filter(batches: Iterator[pa.RecordBatch]) -> CountingQuotientFilter | None:
    held, rows, total = [], 0, None

    def fold():
        f, n = np.unique(np.concatenate(held), return_counts=True)
        part = CountingQuotientFilter.of(f, n.astype(np.uint64))
        return part if total is None else total.merged(part)

    for b in batches:
        held.append(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        rows += len(b)
        if rows >= FOLD_ROWS:
            total, held, rows = fold(), [], 0
    return fold() if held else total


def _slices(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = _partition_filter(batches)
        if whole is None or not len(whole.remainders):
            return
        parts = list(whole.slices(bits))
        yield pa.RecordBatch.from_arrays([pa.array([s.prefix for s in parts], pa.int32()),
                                          pa.array([s.to_bytes() for s in parts], pa.binary())], ["slice", "filter"])
    return run


def _merge_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by slice: the filters of one slice are held at a time,
    each of them of more entries than all behind it, so that a fingerprint is
    merged a logarithmic number of times however many partitions send one."""
    held: list[CountingQuotientFilter] = []

    def repeated():
        while len(held) > 1:
            last = held.pop()
            held[-1] = held[-1].merged(last)
        m = held.pop()
        return pa.RecordBatch.from_arrays([pa.array(m.fingerprints()[m.counts > 1].view(np.int64))], ["fingerprint"])

    for b in batches:
        for raw in b.column(1):
            s = CountingQuotientFilter.from_bytes(raw.as_buffer().to_pybytes())
            if held and held[-1].prefix != s.prefix:
                yield repeated()
            while held and len(held[-1].remainders) <= 2 * len(s.remainders):
                s = held.pop().merged(s)
            held.append(s)
    if held:
        yield repeated()


def repeated_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """The fingerprints (one bigint column) that occur more than once."""
    n = max(partitions(fingerprints.sparkSession), fingerprints.count() // SLICE_ROWS)
    bits = max(SLICE_BITS_MIN, (n - 1).bit_length())
    slices = fingerprints.mapInArrow(_slices(bits), "slice int, filter binary")
    return (slices.repartition(n, "slice").sortWithinPartitions("slice")
                  .mapInArrow(_merge_slices, "fingerprint bigint"))


def _normalised(text: str):
    return ascii_lower(text_or_empty(text))


def _repeated_texts(docs: DataFrame, keys: DataFrame, id_col: str, text: str) -> DataFrame:
    """One row per text that several rows share: its sha256, keeper and size.

    ``keys`` has the fingerprint of every row.  Only rows whose fingerprint
    repeats take part; they are grouped by the whole text, which is
    pre-aggregated in each partition before anything is shuffled.
    """
    twice = small_side(stored(repeated_fingerprints(keys.select("__llm_fp")), "cqf-repeated"))
    rows = (docs.select(F.col(id_col).alias("__llm_id"), _normalised(text).alias("__llm_norm"))
                .withColumn("__llm_fp", F.xxhash64("__llm_norm"))
                .join(twice, F.col("__llm_fp") == F.col("fingerprint"), "left_semi"))
    groups = (rows.groupBy("__llm_norm").agg(F.max("__llm_id").alias("__llm_keep"),
                                             F.count(F.lit(1)).alias("__llm_size"))
                  .where("__llm_size > 1"))
    return groups.select(F.unhex(F.sha2("__llm_norm", 256)).alias("__llm_group"), "__llm_keep", "__llm_size")


def _keys(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    norm = docs.select(F.col(id_col).alias("__llm_id"), _normalised(text).alias("__llm_norm"))
    return norm.select("__llm_id", F.xxhash64("__llm_norm").alias("__llm_fp"),
                       F.unhex(F.sha2("__llm_norm", 256)).alias("__llm_sha"))


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    prepare(docs.sparkSession)
    keys = stored(_keys(docs, id_col, text), "cqf-keys")
    groups = small_side(stored(_repeated_texts(docs, keys, id_col, text), "cqf-groups"))
    out = keys.join(groups, F.col("__llm_sha") == F.col("__llm_group"), "left")
    keep = F.when(F.col("__llm_group").isNull(), F.col("__llm_id")).otherwise(F.col("__llm_keep"))
    return out.select(
        F.col("__llm_id").alias(id_col), keep.alias("keep_id"),
        F.coalesce("__llm_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("__llm_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("__llm_sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``."""
    prepare(docs.sparkSession)
    keys = stored(_keys(docs, id_col, text), "cqf-keys")
    groups = small_side(stored(_repeated_texts(docs, keys, id_col, text), "cqf-groups"))
    sha = F.unhex(F.sha2(_normalised(text), 256))
    out = docs.join(groups, sha == F.col("__llm_group"), "left")
    return out.where(F.col("__llm_group").isNull()
                     | F.col(id_col).eqNullSafe(F.col("__llm_keep"))).select(*docs.columns)
