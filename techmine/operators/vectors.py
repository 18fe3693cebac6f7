"""Clusters and nearest neighbours of embedding vectors (ML1, ML2).

K-means: seeds come from a few passes that keep far points (k-means||), rounds move
the centres.  A round is one scan: tasks add up their points per cluster, the sums
are merged by (cluster, position), and only the centres, a bounded k x d matrix,
reach the driver.  Every round's centres are written to the shared folder, so a
lost driver goes on from the last one.

Nearest neighbours: rows are filed under their nearest centre; a query looks through
the lists of the centres nearest to it.  ``exact`` then looks through every other
list that the triangle inequality leaves open, given the best row so far and the
lists' radii; without it the recall is measured by ``recall``.

Vectors that are null, of another length than the centres, or hold null or
non-finite entries are left out.  Ties go to the smaller cluster and the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from techmine.operators.joins import broadcast_if_small
from techmine.session import shared_dir

SEED_ROUNDS = 5       # passes that gather seed candidates
SEED_FACTOR = 2       # expected candidates of a pass, in multiples of k
LEAST_GAIN = 1e-6     # a round that lowers the cost by a smaller part is the last
PROBES = 12           # lists a query looks through; vectors without clusters need most of 16


def points(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", unit: bool = False) -> DataFrame:
    """(id, vector) of the vectors that are whole; ``unit`` scales them to length 1
    and leaves out the zero vector."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(id_col).alias("id"), v.alias("vector")).where(v.isNotNull() & (F.size(v) > 0) & ~bad)
    if unit:
        norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
        rows = rows.withColumn("norm", norm).where("norm > 0").select(
            "id", F.transform("vector", lambda x: x / F.col("norm")).alias("vector"))
    return rows


def _matrix(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    keep = np.flatnonzero(np.asarray(column.value_lengths().fill_null(-1)) == d)
    flat = column.take(pa.array(keep)).flatten()
    return keep, np.asarray(flat.to_numpy(zero_copy_only=False), np.float64).reshape(len(keep), d)


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, one column per centre; differences first, so that near
    points lose no digits."""
    out = np.empty((len(x), len(centres)))
    for k, c in enumerate(centres):
        out[:, k] = ((x - c) ** 2).sum(axis=1)
    return out


def _nearest(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, x = _matrix(b.column(1), centres.shape[1])
            d = distances(x, centres)
            at = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep)), pa.array(at.astype(np.int32)),
                 pa.array(d[np.arange(len(at)), at]), b.column(1).take(pa.array(keep))],
                ["id", "cluster", "cost", "vector"])
    return run


def assigned(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """(id, cluster, cost, vector): the nearest centre and the squared distance."""
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_nearest(centres), f"id {kind}, cluster int, cost double, vector array<double>")


def _sums(centres: np.ndarray):
    k, d = centres.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, d + 2))  # sums, number of points, cost
        for b in batches:
            _, x = _matrix(b.column(1), d)
            dist = distances(x, centres)
            at = dist.argmin(axis=1)
            np.add.at(total[:, :d], at, x)
            total[:, d] += np.bincount(at, minlength=k)
            total[:, d + 1] += np.bincount(at, weights=dist[np.arange(len(at)), at], minlength=k)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * (d + 2))), pa.array(total.ravel())], ["at", "value"])
    return run


def lloyd_round(rows: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Moved centres, the cost before the move, and points per cluster.  A centre
    without points stays."""
    k, d = centres.shape
    total = np.zeros(k * (d + 2))
    merged = rows.mapInArrow(_sums(centres), "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    for r in merged.collect():  # k (d + 2) numbers
        total[r["at"]] = r["value"]
    total = total.reshape(k, d + 2)
    n = total[:, d]
    moved = np.where(n[:, None] > 0, total[:, :d] / np.maximum(n, 1)[:, None], centres)
    return moved, float(total[:, d + 1].sum()), n.astype(np.int64)


def seeds(rows: DataFrame, k: int, seed: int = 1) -> np.ndarray:
    """k starting centres: candidates are kept with a chance in proportion to their
    squared distance from those kept before, over a few passes; weighed by the points
    nearest to them, they are thinned out to k in the same way."""
    uniform = lambda r: F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(r), "id"), 11) / float(1 << 53)
    first = rows.orderBy(uniform(0), "id").limit(1).collect()
    if not first:
        return np.empty((0, 0))
    found = np.array([first[0]["vector"]])
    for r in range(1, SEED_ROUNDS + 1):
        near = assigned(rows, found)
        cost = near.agg(F.sum("cost")).first()[0]
        if not cost:
            break
        # About SEED_FACTOR * k rows.
        kept = near.where(uniform(r) < F.lit(SEED_FACTOR * k / cost) * F.col("cost")).orderBy("id").select("vector")
        more = [q["vector"] for q in kept.collect()]
        if more:
            found = np.concatenate([found, np.array(more)])
    _, _, weight = lloyd_round(rows, found)
    rng = np.random.default_rng(seed)
    chosen = [int(weight.argmax())]
    least = distances(found, found[chosen])[:, 0]
    while len(chosen) < min(k, len(found)):
        p = weight * least
        if not p.sum():
            break
        chosen.append(int(rng.choice(len(found), p=p / p.sum())))
        least = np.minimum(least, distances(found, found[chosen[-1:]])[:, 0])
    return found[chosen]


@dataclass(frozen=True)
class Clusters:
    centres: np.ndarray
    costs: list[float]     # before each round's move, and with the last centres
    folder: str            # of the centres of every round


def _write_round(spark: SparkSession, folder: str, r: int, cost: float, centres: np.ndarray) -> None:
    state = [(k, cost, [float(x) for x in c]) for k, c in enumerate(centres)]
    spark.createDataFrame(state, "cluster int, cost double, centre array<double>").coalesce(1).write.mode(
        "overwrite").parquet(f"{folder}/round={r:05d}")


def resumed(spark: SparkSession, folder: str) -> tuple[np.ndarray, list[float]]:
    """Centres and costs of the rounds written below ``folder``."""
    state = spark.read.schema("cluster int, cost double, centre array<double>, round int").parquet(folder)
    last = state.agg(F.max("round")).first()[0]
    rows = state.where(F.col("round") == last).orderBy("cluster").collect()
    costs = [r["cost"] for r in state.where("cluster = 0 and cost >= 0").orderBy("round").collect()]
    return np.array([r["centre"] for r in rows]), costs


def kmeans(rows: DataFrame, k: int, rounds: int = 20, start: np.ndarray | None = None, seed: int = 1,
           folder: str | None = None, least_gain: float = LEAST_GAIN) -> Clusters:
    """K-means of ``rows`` (id, vector).  ``start`` gives the first centres; with the
    ``folder`` of an earlier run, its rounds are continued."""
    spark = rows.sparkSession
    costs: list[float] = []
    if folder is not None:
        centres, costs = resumed(spark, folder)
    else:
        centres = seeds(rows, k, seed) if start is None else np.asarray(start, np.float64)
        folder = shared_dir(spark, "kmeans")
        _write_round(spark, folder, 0, -1.0, centres)
    if not centres.size:
        return Clusters(centres, costs, folder)
    for r in range(len(costs), rounds):
        centres, cost, _ = lloyd_round(rows, centres)
        costs.append(cost)
        _write_round(spark, folder, r + 1, cost, centres)
        if len(costs) > 1 and costs[-2] - cost <= least_gain * costs[-2]:
            break
    last = lloyd_round(rows, centres)[1]
    return Clusters(centres, [*costs, last], folder)


@dataclass(frozen=True)
class VectorIndex:
    """All rows filed under their nearest centre: (id, list, away, vector)."""

    centres: np.ndarray
    rows: DataFrame
    radius: DataFrame      # (list, radius)


def build_index(rows: DataFrame, lists: int, seed: int = 1, rounds: int = 5) -> VectorIndex:
    """An index of ``rows`` (id, vector), written to the shared folder."""
    spark = rows.sparkSession
    centres = kmeans(rows, lists, rounds=rounds, seed=seed).centres
    path = shared_dir(spark, "vector-index")
    if not centres.size:
        centres = np.zeros((1, 1))
    filed = assigned(rows, centres).select("id", F.col("cluster").alias("list"), F.sqrt("cost").alias("away"), "vector")
    filed.write.mode("overwrite").parquet(path)
    filed = spark.read.schema(filed.schema).parquet(path)
    radius = filed.groupBy("list").agg(F.max("away").alias("radius")).checkpoint(eager=True)
    return VectorIndex(centres, filed, radius)


# Rows and queries of one block: a pair of blocks is one row of a join, of bounded size.
BLOCK_ROWS = 256
HELD_QUERIES = 1 << 20   # whose best rows a task holds at once


def _blocks(kind: pa.DataType, d: int, schema: list[str]):
    """Rows (id, lists, vector) in blocks: the ids, the lists as they come, and the
    vectors as one value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, x = _matrix(b.column(2), d)
            for at in range(0, len(keep), BLOCK_ROWS):
                part = pa.array(keep[at:at + BLOCK_ROWS])
                ids, lists = b.column(0).take(part).cast(kind), b.column(1).take(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in (ids, lists)]
                    + [pa.array([x[at:at + BLOCK_ROWS].tobytes()])], schema)
    return run


def _in_blocks(rows: DataFrame, d: int, names: list[str]) -> DataFrame:
    """One row per block of ``rows`` (id, lists, vector), under these names."""
    f = rows.schema.fields
    return rows.mapInArrow(_blocks(_arrow_type(f[0].dataType), d, names),
                           f"{names[0]} array<{f[0].dataType.simpleString()}>, "
                           f"{names[1]} array<{f[1].dataType.simpleString()}>, {names[2]} binary")


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def _costs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows, summed in the order of the positions."""
    out = np.zeros(len(x))
    for k in range(x.shape[1]):
        diff = x[:, k] - y[:, k]
        out += diff * diff
    return out


def _near(x: np.ndarray, q: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, query) of ``other`` that can hold a query's least cost: a matrix
    product gives all costs up to rounding, a margin covers it."""
    with np.errstate(all="ignore"):
        xx, qq = (x * x).sum(axis=1), (q * q).sum(axis=1)
        rough = xx[:, None] + qq[None, :] - 2 * (x @ q.T)
        margin = (4 * x.shape[1] + 64) * np.finfo(float).eps * (xx.max(initial=0.0) + qq)
    if not (np.isfinite(rough).all() and np.isfinite(margin).all()):
        return np.nonzero(other)
    rough[~other] = np.inf
    return np.nonzero(other & (rough <= rough.min(axis=0) + margin))


PAIRS_AT_ONCE = 1 << 16


def _best_in_blocks(kind: pa.DataType, d: int):
    """Joined blocks (ids, lists, vectors; queries, their lists, vectors): of every query
    the least (cost, id) over the rows of its lists, itself left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), kind), pa.array([c for c, _ in held.values()], pa.float64()),
                 pa.array([i for _, i in held.values()], kind)], ["q", "cost", "id"])
            held.clear()
            return out

        for b in batches:
            for k in range(len(b)):
                ids, lists, raw, asked, wanted, qraw = (b.column(c)[k] for c in range(6))
                ids, asked = ids.as_py(), asked.as_py()
                x = np.frombuffer(raw.as_py(), np.float64).reshape(-1, d)
                q = np.frombuffer(qraw.as_py(), np.float64).reshape(-1, d)
                sizes = wanted.values.value_lengths().to_numpy()
                lists, flat = lists.values.to_numpy(), wanted.values.flatten().to_numpy()
                open_lists = np.zeros((max(lists.max(initial=-1), flat.max(initial=-1)) + 1, len(asked)), bool)
                open_lists[flat, np.repeat(np.arange(len(asked)), sizes)] = True
                place = {i: n for n, i in enumerate(dict.fromkeys([*ids, *asked]))}
                own, its = (np.array([place[i] for i in v]) for v in (ids, asked))
                other = open_lists[lists] & (own[:, None] != its[None, :])
                rows, cols = _near(x, q, other)
                for at in range(0, len(rows), PAIRS_AT_ONCE):
                    r, c = rows[at:at + PAIRS_AT_ONCE], cols[at:at + PAIRS_AT_ONCE]
                    cost = _costs(x[r], q[c])
                    order = np.lexsort((cost, c))
                    first = np.r_[True, np.diff(c[order]) > 0]
                    least = np.empty(len(asked))
                    least[c[order][first]] = cost[order][first]
                    ties = cost == least[c]
                    for i, j, w in zip(r[ties].tolist(), c[ties].tolist(), cost[ties].tolist(), strict=True):
                        one = (w, ids[i])
                        if asked[j] not in held or one < held[asked[j]]:
                            held[asked[j]] = one
                if len(held) >= HELD_QUERIES:
                    yield flush()
        if held:
            yield flush()
    return run


def _best(asked: DataFrame, index: VectorIndex) -> DataFrame:
    """(q, best (cost, id)) over the rows of the lists that ``asked`` (q, lists, qv)
    names, itself left out.  Rows and queries meet in blocks, every block of rows with
    every one of queries; rows are not moved while the queries are small, and a task
    holds one pair of blocks and one row per query."""
    d = index.centres.shape[1]
    kind = asked.schema["q"].dataType
    queries = _in_blocks(asked.where("q is not null and size(lists) > 0").select("q", "lists", "qv"), d,
                         ["asked", "wanted", "qvectors"]).checkpoint(eager=True)
    rows = _in_blocks(index.rows.where("id is not null").select("id", "list", "vector"), d, ["ids", "lists", "vectors"])
    pairs = rows.crossJoin(broadcast_if_small(queries))
    name = kind.simpleString()
    best = pairs.mapInArrow(_best_in_blocks(_arrow_type(kind), d), f"q {name}, cost double, id {name}")
    return best.groupBy("q").agg(F.min(F.struct("cost", "id")).alias("best"))


def _to_centres(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = centres.shape
        for b in batches:
            keep, x = _matrix(b.column(1), d)
            away = np.sqrt(distances(x, centres))
            order = away.argsort(axis=1, kind="stable")
            ends = pa.array(np.arange(len(keep) + 1, dtype=np.int32) * k)
            kept = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(kept), b.column(1).take(kept),
                 pa.ListArray.from_arrays(ends, pa.array(order.ravel().astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(np.take_along_axis(away, order, axis=1).ravel()))],
                ["q", "qv", "lists", "gaps"])
    return run


def nearest(index: VectorIndex, queries: DataFrame, probes: int = PROBES, exact: bool = False) -> DataFrame:
    """(id, nearest_id, distance): the nearest other row of each query (id, vector);
    queries that find none are left out."""
    kind = queries.schema["id"].dataType.simpleString()
    turns = queries.mapInArrow(_to_centres(index.centres),
                               f"q {kind}, qv array<double>, lists array<int>, gaps array<double>")
    turns = turns.checkpoint(eager=True)
    best = _best(turns.withColumn("lists", F.slice("lists", 1, probes)), index).checkpoint(eager=True)
    if exact:
        # No row of a list is nearer than the gap to its centre less its radius; a
        # small margin covers rounding.
        radius = index.radius.agg(F.map_from_entries(F.collect_list(F.struct("list", "radius"))).alias("radius"))
        left = F.arrays_zip(F.col("lists").alias("list"), F.col("gaps").alias("gap"))
        left = F.filter(F.slice(left, probes + 1, len(index.centres)), lambda t: (
            F.col("radius")[t["list"]].isNotNull() & (F.col("best").isNull() | (
                t["gap"] - F.col("radius")[t["list"]] <= F.sqrt("best.cost") * (1 + 1e-9) + 1e-9))))
        rest = (turns.crossJoin(F.broadcast(radius))  # one row, a number per list
                     .join(best.withColumnRenamed("q", "q0"), F.col("q") == F.col("q0"), "left")
                     .select("q", F.transform(left, lambda t: t["list"]).alias("lists"), "qv"))
        best = best.unionByName(_best(rest, index)).groupBy("q").agg(F.min("best").alias("best"))
    return best.select(F.col("q").alias("id"), F.col("best.id").alias("nearest_id"),
                       F.sqrt("best.cost").alias("distance"))


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: queries, those whose found row is as near as the nearest, and the share."""
    e = exact.select("id", F.col("distance").alias("least"))
    hit = F.coalesce(F.col("distance") <= F.col("least") * (1 + 1e-12), F.lit(False))
    return e.join(found, "id", "left").agg(F.count(F.lit(1)).alias("n_queries"), F.count_if(hit).alias("n_found")).select(
        "*", F.when(F.col("n_queries") > 0, F.col("n_found") / F.col("n_queries")).alias("recall"))
