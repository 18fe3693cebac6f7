"""Binary token store with a minimal perfect hash index.

Payload: shards of raw ids in ascending document order, one per range of ids of
documents, written from the encoded texts (unsigned 16-bit where the
vocabulary allows, else 32-bit, little-endian).  Index: keys are hashed into
buckets of bounded size; each bucket has a file with a minimal perfect hash
(bit arrays by level: a key sits in the first level where it is alone in its
place, its rank among all set bits is its slot) and, per slot, a fingerprint of
the key, shard, offset, length and global start.  A lookup reads one bit per
level and one slot; the fingerprint tells absent keys.

Files of lost or repeated task attempts have other names and are never listed:
only names that a finished task returned enter the manifests.

A key is (document id, occurrence): rows that repeat an id are occurrences 0, 1
and so on in the order of the payload.  Defined results: a null text is empty
and stored as its end id; a null id is a key like any other and sorts first; an
empty table gives no files.  Only the id and text columns are read.
"""

from __future__ import annotations

import io
import struct
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from techmine.llm.common import partitions, prepare, shared_path, small_side, stored
from techmine.llm.files import open_read, open_write
from techmine.llm.tokens import END_ID, crc32_of, encode, encoder, gathered

BUCKET_KEYS = 32_768
LEVEL_LOAD = 2.0     # places of a level per key that reaches it
MAGIC = b"MPHI\x01"

_U64 = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(33))) * _U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U64(33))) * _U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U64(33))


def _hash(ids: np.ndarray, occurrences: np.ndarray, nulls: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of keys; another seed gives an independent one."""
    salt = _mix(np.array([seed], _U64) * _U64(0x9E3779B97F4A7C15) + _U64(1))[0]
    other = occurrences.astype(_U64) * _U64(2) + nulls.astype(_U64)
    return _mix(_mix(ids.view(_U64) ^ salt) + _mix(other + salt))


SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u8"), ("start", "<u8")])
FINGERPRINT_SEED = 1 << 20


@dataclass
class PerfectHash:
    """Bit arrays by level over the keys of one bucket."""

    levels: list[np.ndarray]

    @staticmethod
    def build(ids: np.ndarray, occurrences: np.ndarray, nulls: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        left = np.arange(len(ids))
        while len(left):
            size = int(LEVEL_LOAD * len(left)) + 1
            at = (_hash(ids[left], occurrences[left], nulls[left], len(levels)) % _U64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return PerfectHash(levels)

    def slots(self, ids: np.ndarray, occurrences: np.ndarray, nulls: np.ndarray) -> np.ndarray:
        """Slot of every key; -1 for keys that sit in no level (absent)."""
        out = np.full(len(ids), -1, np.int64)
        left, base = np.arange(len(ids)), 0
        for k, bits in enumerate(self.levels):
            at = (_hash(ids[left], occurrences[left], nulls[left], k) % _U64(len(bits))).astype(np.int64)
            here = bits[at]
            rank = np.cumsum(bits) - 1
            out[left[here]] = base + rank[at[here]]
            base += int(bits.sum())
            left = left[~here]
        return out

    def to_bytes(self) -> bytes:
        parts = [struct.pack("<I", len(self.levels))]
        for bits in self.levels:
            parts += [struct.pack("<Q", len(bits)), np.packbits(bits, bitorder="little").tobytes()]
        return b"".join(parts)

    @staticmethod
    def read(f) -> PerfectHash:
        levels = []
        for _ in range(struct.unpack("<I", f.read(4))[0]):
            n = struct.unpack("<Q", f.read(8))[0]
            raw = np.frombuffer(f.read((n + 7) // 8), np.uint8)
            levels.append(np.unpackbits(raw, count=n, bitorder="little").astype(bool))
        return PerfectHash(levels)


def _index_bytes(ids, occurrences, nulls, slots: np.ndarray) -> bytes:
    """Index file of one bucket; ``slots`` has the entry of every key."""
    h = PerfectHash.build(ids, occurrences, nulls)
    table = np.empty(len(ids), SLOT)
    table[h.slots(ids, occurrences, nulls)] = slots
    return MAGIC + h.to_bytes() + struct.pack("<Q", len(table)) + table.tobytes()


def _read_index(data: bytes) -> tuple[PerfectHash, np.ndarray]:
    f = io.BytesIO(data)
    if f.read(len(MAGIC)) != MAGIC:
        raise ValueError("not an index file of a token store")
    h = PerfectHash.read(f)
    n = struct.unpack("<Q", f.read(8))[0]
    return h, np.frombuffer(f.read(n * SLOT.itemsize), SLOT)


@dataclass
class TokenStore:
    """Manifests of a written store; the files are named in them."""

    shards: DataFrame   # shard, file, base: one row per payload shard
    index: DataFrame    # bucket, index_file: one row per bucket
    buckets: int
    width: int          # bytes of an id in the payload
    entries: DataFrame  # id, occurrence, shard, offset, length, start


def _range_starts(keys: DataFrame, n: int, order: list) -> list[tuple]:
    """First (id, tie) of every range but the first, of ``n`` ranges of about the same
    number of rows; only keys are moved, one row per range reaches the driver."""
    ranged = keys.repartitionByRange(n, *order).withColumn("range", F.spark_partition_id())
    key = F.struct(F.col("id").isNotNull().alias("known"), F.coalesce("id", F.lit(0)).alias("id"), "tie")
    starts = ranged.groupBy("range").agg(F.min(key).alias("k")).select("k.*").collect()
    return sorted(tuple(r) for r in starts)[1:]


def _encode_texts(tokenizer_path: str, end_id: int, width: int, starts: list[tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches, 1):
            keys = zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)
            shards = [bisect_right(starts, (i is not None, i or 0, t)) for i, t in keys]
            ids = encode(tokenizer_path, b.column(1).to_pylist(), end_id)
            if width != 4:
                ids = [np.frombuffer(i, "<u4").astype("<u2").tobytes() for i in ids]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(shards, pa.int32()), pa.array(ids, pa.binary())],
                ["id", "tie", "shard", "payload"])
    return run


def _write_shards(folder: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, file = None, 0, ""
        for b in batches:
            if not len(b):
                continue
            if out is None:
                file = f"{folder}/shard-{int(b.column(2)[0].as_py()):06d}-{uuid.uuid4().hex[:12]}.bin"
                out = open_write(file)
            offsets, lengths = [], []
            for ids in b.column(1):
                raw = ids.as_py()
                offsets.append(at)
                lengths.append(len(raw) // width)
                at += len(raw) // width
                out.write(raw)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2).cast(pa.int32()), pa.array([file] * len(b)),
                 pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                ["id", "shard", "file", "offset", "length"])
        if out is not None:
            out.close()
    return run


def _with_bucket(keys: DataFrame, buckets: int) -> DataFrame:
    return keys.withColumn("bucket", F.pmod(F.xxhash64("id", "occurrence", F.col("id").isNull()),
                                            F.lit(buckets)).cast("int"))


def _by_bucket(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by ``column``: one batch per value, which is bounded."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not len(b):
            continue
        values = b.column(column).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(b)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            part = b.slice(low, high - low)
            if held and held[-1].column(column)[0] != part.column(column)[0]:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _keys_of(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = b.column(0)
    return (ids.fill_null(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(),
            ids.is_null().to_numpy(zero_copy_only=False))


def _write_index(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _by_bucket(batches, 2):
            slots = np.empty(len(b), SLOT)
            keys = _keys_of(b)
            slots["fingerprint"] = _hash(*keys, FINGERPRINT_SEED).astype(np.uint32)
            for k, name in enumerate(("shard", "offset", "length", "start"), 3):
                slots[name] = b.column(k).to_numpy()
            bucket = b.column(2)[0].as_py()
            file = f"{folder}/index-{bucket:08d}-{uuid.uuid4().hex[:12]}.mph"
            with open_write(file) as f:
                f.write(_index_bytes(*keys, slots))
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([file])],
                                             ["bucket", "index_file"])
    return run


def write_store(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text: str = "text",
                end_id: int = END_ID, folder: str | None = None) -> TokenStore:
    """Encode whole texts and write payload shards and index files."""
    spark = prepare(docs.sparkSession)
    n = partitions(spark)
    folder = folder or shared_path(spark, "token-store")
    width = 2 if max(encoder(tokenizer_path).vocab_size, end_id + 1) <= 1 << 16 else 4
    # Equal ids are spread by their text, so that a hot id fills several shards.
    order = [F.col("id").asc_nulls_first(), F.col("tie")]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"),
                       F.xxhash64(text).alias("tie"))
    # Encoded where they are read: ids take less room than texts, and no task sorts
    # texts while its worker encodes.
    starts = _range_starts(rows.select("id", "tie"), n, order)
    coded = rows.select("id", "text", "tie").mapInArrow(
        _encode_texts(tokenizer_path, end_id, width, starts), "id long, tie long, shard int, payload binary")
    ranged = coded.repartitionById(n, F.col("shard")).sortWithinPartitions(*order).select("id", "payload", "shard")
    written = stored(ranged.mapInArrow(_write_shards(f"{folder}/payload", width),
                                       "id long, shard int, file string, offset long, length long"), "manifest")
    # One row per shard: bounded by the number of tasks.
    shards = written.groupBy("shard", "file").agg(F.sum("length").alias("ids"))
    shards = stored(shards.select("shard", "file", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids"))
                                  .alias("base")), "shards")
    entries = written.select("id", "shard", "offset", "length").join(
        small_side(shards.select("shard", "base")), "shard")
    entries = entries.withColumn("start", F.col("base") + F.col("offset"))
    entries = stored(entries.withColumn("occurrence", F.row_number().over(
        Window.partitionBy("id").orderBy("start")).cast("long") - 1).drop("base"), "entries")
    buckets = max(1, -(-entries.count() // BUCKET_KEYS))
    keyed = _with_bucket(entries, buckets).select("id", "occurrence", "bucket", "shard", "offset", "length", "start")
    index = stored(keyed.repartition(min(n, buckets), "bucket").sortWithinPartitions("bucket")
                        .mapInArrow(_write_index(f"{folder}/index"), "bucket int, index_file string"), "index")
    return TokenStore(shards, index, buckets, width, entries)


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _by_bucket(batches, 2):
        with open_read(b.column(3)[0].as_py()) as f:
            h, table = _read_index(f.read())
        keys = _keys_of(b)
        at = h.slots(*keys)
        hit = at >= 0
        hit[hit] = table["fingerprint"][at[hit]] == _hash(*keys, FINGERPRINT_SEED).astype(np.uint32)[hit]
        found = table[at[hit]]
        mask = pa.array(hit)
        yield pa.RecordBatch.from_arrays(
            [b.column(0).filter(mask), b.column(1).filter(mask),
             *[pa.array(found[c].astype(np.int64)) for c in ("shard", "offset", "length", "start")]],
            ["id", "occurrence", "shard", "offset", "length", "start"])


def look_up(store: TokenStore, keys: DataFrame) -> DataFrame:
    """Where the payloads of ``keys`` (id, occurrence) are; absent keys are left
    out (up to fingerprint collisions, 1 in 2^32)."""
    n = partitions(keys.sparkSession)
    placed = _with_bucket(keys.select(F.col("id").cast("long"), F.col("occurrence").cast("long")), store.buckets)
    placed = placed.join(small_side(store.index), "bucket").select("id", "occurrence", "bucket", "index_file")
    return (placed.repartition(n, "bucket").sortWithinPartitions("bucket")
                  .mapInArrow(_look_up, "id long, occurrence long, shard long, offset long, length long, start long"))


def _read_payload(width: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, f = None, None
        for b in batches:
            crcs, ids = [], []
            for file, offset, length in zip(*[b.column(k).to_pylist() for k in (3, 4, 5)], strict=True):
                if file != name:
                    if f is not None:
                        f.close()
                    name, f = file, open_read(file)
                f.seek(offset * width)
                raw = np.frombuffer(f.read(length * width), f"<u{width}").astype("<u4")
                crcs.append(crc32_of(raw.tobytes()))
                if with_ids:
                    ids.append(raw.astype(np.int32))
            arrays = [b.column(0), b.column(1), b.column(2), b.column(5), pa.array(crcs, pa.int64())]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, ["id", "occurrence", "start", "n_tokens", "ids_crc32",
                                                      *["ids"] * with_ids])
        if f is not None:
            f.close()
    return run


def read_payload(store: TokenStore, places: DataFrame, with_ids: bool = False) -> DataFrame:
    """Read the ids at ``places`` (of ``look_up``) from the shard files: id,
    occurrence, start, n_tokens, ids_crc32, and the ids if asked for."""
    n = partitions(places.sparkSession)
    shards = small_side(store.shards.select(F.col("shard").cast("long").alias("shard"), "file"))
    rows = places.join(shards, "shard").repartitionByRange(n, "shard", "offset").sortWithinPartitions("shard", "offset")
    return (rows.select("id", "occurrence", "start", "file", "offset", "length")
                .mapInArrow(_read_payload(store.width, with_ids), "id long, occurrence long, start long, n_tokens long, "
                            "ids_crc32 long" + ", ids array<int>" * with_ids))


def keys_of(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The keys (id, occurrence) of all rows of ``docs``."""
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    return ids.withColumn("occurrence", F.row_number().over(Window.partitionBy("id").orderBy("id")).cast("long") - 1)
