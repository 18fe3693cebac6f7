"""Hierarchical residual packing of token sequences by best fit.

Only sequences longer than the capacity are cut.  Each task best-fits the
pieces of its partition (largest first, each into the fullest bin that still
takes it) and emits the nearly full bins.  The underfull ones go on as items:
rounds of a tree merge bring the residual bins of several partitions together
and best-fit them again, with fewer groups each time, until one group is left
or a round no longer closes bins.  A group is bounded by rows and by packed
pieces, never by a key, so no task grows with the input.

Defined results: a null text is empty and still has its end id; repeated rows
and repeated or null ids are packed one by one.  An empty table gives an empty
result.  Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine.llm.common import partitions, prepare, stored
from techmine.llm.tokens import END_ID, crc32_of, encode

CAPACITY = 4096
SLACK = 8                # bins with at most this many free tokens are nearly full
CHUNK_ROWS = 100_000     # rows that a task best-fits at once
GROUP_BINS = 60_000      # residual bins of one group of a merge round
GROUP_PIECES = 600_000   # packed pieces of one group of a merge round
MIN_GAIN = 0.01          # a round that saves a smaller share of the residual bins is the last

_ITEM = pa.struct([("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                   ("length", pa.int64()), ("crc", pa.int64())])
_BINS = pa.schema([("fill", pa.int64()), ("closed", pa.bool_()), ("items", pa.list_(_ITEM))])
BINS = "fill long, closed boolean, items array<struct<id:long,piece:int,start:long,length:long,crc:long>>"
PIECES = "id long, piece int, start long, length long, crc long"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
           text: str = "text", end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, crc (of its ids), and the
    ids themselves if asked for."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, parts = [], []
            for doc, ids in zip(b.column(0).to_pylist(), encode(tokenizer_path, b.column(1).to_pylist(), end_id),
                                strict=True):
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, crc32_of(part)))
                    if with_ids:
                        parts.append(np.frombuffer(part, "<i4"))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            arrays = [pa.array(c, f.type) for c, f in zip(cols, _ITEM, strict=True)]
            if with_ids:
                arrays.append(pa.array(parts, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, [*[f.name for f in _ITEM], *["ids"] * with_ids])

    return (docs.select(F.col(id_col).cast("long"), F.col(text))
                .mapInArrow(run, PIECES + ", ids array<int>" * with_ids))


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best fit decreasing: the bin of every item, and the fill of every bin."""
    bins = np.empty(len(sizes), np.int64)
    fills: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by free tokens
    frees = 0  # bit f: some open bin has f free tokens
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = frees >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            k = open_bins[free].pop()
            if not open_bins[free]:
                frees &= ~(1 << free)
            fills[k] += size
            free -= size
        else:
            k, free = len(fills), capacity - size
            fills.append(size)
        bins[i] = k
        if free:
            open_bins[free].append(k)
            frees |= 1 << free
    return bins, np.array(fills, np.int64)


def _regroup(lists: pa.ListArray, sizes: np.ndarray, capacity: int) -> pa.RecordBatch:
    """Best-fit rows that hold lists of items into bins that hold them all."""
    bins, fills = best_fit(sizes, capacity)
    order = np.argsort(bins, kind="stable")
    lists = lists.take(pa.array(order))
    ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
    last_of_bin = np.cumsum(np.bincount(bins, minlength=len(fills))) - 1
    offsets = np.concatenate([[0], ends[last_of_bin]]).astype(np.int32)
    items = pa.ListArray.from_arrays(pa.array(offsets), lists.flatten())
    return pa.RecordBatch.from_arrays([pa.array(fills), pa.array(fills >= capacity - SLACK), items], schema=_BINS)


# Packed pieces of one row batch that goes back to Spark.
EMIT_PIECES = 20_000


def _emit(bins: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    at = 0
    ends = bins.column(2).offsets.to_numpy()
    while at < len(bins):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + EMIT_PIECES, side="right")) - 1)
        yield bins.slice(at, to - at)
        at = to


def _pack_pieces(capacity: int):
    """Tasks of the first round: pieces to bins, chunk by chunk."""
    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        cols = [rows.column(k).combine_chunks() for k in range(len(_ITEM))]
        items = pa.StructArray.from_arrays([c.cast(f.type) for c, f in zip(cols, _ITEM, strict=True)],
                                           fields=list(_ITEM))
        each = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32)), items)
        yield from _emit(_regroup(each, rows.column(3).to_numpy(), capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += len(b)
            if n >= CHUNK_ROWS:
                yield from flush(held)
                held, n = [], 0
        if held:
            yield from flush(held)
    return run


def _pack_bins(capacity: int):
    """Tasks of a merge round: residual bins as items."""
    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        yield from _emit(_regroup(rows.column(2).combine_chunks(), rows.column(0).to_numpy(), capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, inner = [], 0, 0
        for b in batches:
            held.append(b)
            n += len(b)
            inner += len(b.column(2).flatten())
            if n >= 2 * GROUP_BINS or inner >= 2 * GROUP_PIECES:
                yield from flush(held)
                held, n, inner = [], 0, 0
        if held:
            yield from flush(held)
    return run


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column(1)
        items = lists.flatten()
        n = np.diff(lists.offsets.to_numpy())
        length = items.field("length").to_numpy()
        before = np.cumsum(length) - length
        firsts = np.concatenate([[0], np.cumsum(n)])[:-1]
        base = np.repeat(before[firsts] if len(firsts) else before, n)
        yield pa.RecordBatch.from_arrays(
            [*[items.field(k) for k in range(len(_ITEM))], pa.array(np.repeat(b.column(0).to_numpy(), n)),
             pa.array(before - base)], [*[f.name for f in _ITEM], "sequence_id", "offset"])


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Place pieces (columns id, piece, start, length, crc; no length above the
    capacity) into sequences: the same columns with sequence_id and offset.

    ``items`` must not change between runs (``stored``).
    """
    spark = prepare(items.sparkSession)
    done = []
    bins = stored(items.select("id", "piece", "start", "length", "crc").mapInArrow(_pack_pieces(capacity), BINS),
                  "bins")
    groups = partitions(spark)
    before = None
    while True:
        done.append(bins.where("closed"))
        rest = bins.where(~F.col("closed"))
        n, inner = rest.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("items")), F.lit(0))).first()
        if groups == 1 or n <= 1 or (before is not None and n > (1 - MIN_GAIN) * before):
            done.append(rest)
            break
        # A quarter of the groups each round, as far as the bounds of a group allow.
        groups = max(1, min(groups // 4, n // 1000), -(-n // GROUP_BINS), -(-inner // GROUP_PIECES))
        mixed = F.xxhash64(F.get("items", F.lit(0)), F.lit(groups))
        bins = stored(rest.repartition(groups, mixed).mapInArrow(_pack_bins(capacity), BINS), "bins")
        before = n
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    every = every.select(F.monotonically_increasing_id().alias("sequence_id"), "items")
    return every.mapInArrow(_placed, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                   text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Tokenise, cut and pack whole texts; one row per piece: id, piece, start,
    length, ids_crc32, sequence_id, offset."""
    items = stored(pieces(docs, tokenizer_path, capacity, id_col, text, end_id), "pieces")
    return (pack(items, capacity).withColumnRenamed("id", id_col).withColumnRenamed("crc", "ids_crc32"))


def sequences(docs: DataFrame, placement: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
              id_col: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """The packed ids themselves: sequence_id, ids.  Ids of ``docs`` must be
    unique; a sequence has at most ``capacity`` ids, so its group is bounded."""
    parts = pieces(docs, tokenizer_path, capacity, id_col, text, end_id, with_ids=True)
    where = placement.select(F.col(id_col).alias("id"), "piece", "sequence_id", "offset")
    joined = parts.select("id", "piece", "ids").join(where, ["id", "piece"])
    lists = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(F.flatten(F.transform(lists, lambda x: x["ids"])).alias("ids"))
