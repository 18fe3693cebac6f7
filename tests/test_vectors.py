import numpy as np
import pytest

from techmine.operators import vectors as V
from techmine.session import ship_package
from tests.conftest import SF001, SF01


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def frame(spark, x, start=0):
    return spark.createDataFrame([(start + k, [float(c) for c in v], "clash") for k, v in enumerate(x)],
                                 "vec_id long, embedding array<double>, cluster string")


def blobs(n=300, d=6, k=5, seed=2):
    r = np.random.default_rng(seed)
    return r.normal(size=(k, d))[r.integers(0, k, n)] * 8 + r.normal(size=(n, d))


def lloyd(x, c, rounds):
    """Brute force."""
    costs = []
    for _ in range(rounds):
        d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        at = d.argmin(axis=1)
        costs.append(d.min(axis=1).sum())
        c = np.array([x[at == k].mean(axis=0) if (at == k).any() else c[k] for k in range(len(c))])
    d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    return c, [*costs, d.min(axis=1).sum()], d.argmin(axis=1)


def test_rounds_equal_brute_force(spark):
    x = blobs()
    rows = V.points(frame(spark, x).repartition(5))
    start = np.concatenate([x[:5], [[1e4] * 6]])  # the last centre never gets a point
    got = V.kmeans(rows, 6, rounds=7, start=start, least_gain=-1)
    c, costs, at = lloyd(x, start, 7)
    assert np.allclose(got.centres, c, rtol=1e-12) and np.allclose(got.costs, costs, rtol=1e-12)
    assert all(a >= b - 1e-9 for a, b in zip(got.costs, got.costs[1:]))
    out = {r["id"]: r["cluster"] for r in V.assigned(rows, got.centres).collect()}
    assert [out[k] for k in range(len(x))] == at.tolist()


def test_run_goes_on_from_its_folder(spark):
    x = blobs(120)
    rows = V.points(frame(spark, x))
    whole = V.kmeans(rows, 4, rounds=5, start=x[:4], least_gain=-1)
    part = V.kmeans(rows, 4, rounds=2, start=x[:4], least_gain=-1)
    rest = V.kmeans(rows, 4, rounds=5, folder=part.folder, least_gain=-1)
    assert np.allclose(rest.centres, whole.centres, rtol=1e-12) and np.allclose(rest.costs, whole.costs, rtol=1e-12)


def test_seeds_cover_far_groups(spark):
    x = np.concatenate([blobs(200, 3, 1, s) + 1000 * s for s in range(6)])
    rows = V.points(frame(spark, x))
    c = V.seeds(rows, 6)
    assert c.shape == (6, 3) and {int(round(v.mean() / 1000)) for v in c} == set(range(6))
    assert (V.seeds(rows, 6) == c).all()
    assert len(V.seeds(V.points(frame(spark, [[1.0, 2.0]] * 5)), 3)) == 1  # equal points make one centre
    assert not V.seeds(V.points(frame(spark, [])), 3).size


def brute_nearest(x, ids, asked):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in asked:
        d = ((u - u[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        best = d.min()
        out[ids[q]] = (min(ids[k] for k in np.flatnonzero(d <= best + 1e-15)), np.sqrt(best))
    return out


@pytest.mark.parametrize("kind", ["blobs", "copies", "hot"])
def test_exact_search_equals_brute_force(spark, kind):
    x = blobs(240, 5, 7)
    if kind == "copies":
        x[100:140] = x[3]
    if kind == "hot":
        x[80:] = x[0] + np.random.default_rng(1).normal(size=(160, 5)) * 0.01
    rows = V.points(frame(spark, x), unit=True)
    index = V.build_index(rows, 7)
    want = brute_nearest(x, list(range(240)), range(0, 240, 20))
    for probes in (1, 3):
        got = {r["id"]: (r["nearest_id"], r["distance"]) for r in V.nearest(
            index, rows.where("id % 20 = 0"), probes, exact=True).collect()}
        assert set(got) == set(want)
        for q, (k, d) in want.items():
            assert got[q][1] == pytest.approx(d, abs=1e-9)
            if kind != "copies" or d > 1e-9:
                assert got[q][0] == k


def test_rows_that_are_no_vectors(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(90, None, ""), (91, [], ""), (92, [1.0, None], ""), (93, [nan, 1.0], ""), (94, [inf, 1.0], "")]
    good = [(k, [float(k), 1.0], "") for k in range(6)] + [(2, [2.0, 1.0], "")]
    df = spark.createDataFrame(bad + good + [(95, [0.0, 0.0], "")], "vec_id long, embedding array<double>, cluster string")
    assert V.points(df).count() == 8
    unit = V.points(df, unit=True)
    assert sorted(r["id"] for r in unit.collect()) == [0, 1, 2, 2, 3, 4, 5]
    found = V.kmeans(V.points(df), 3)
    assert V.assigned(V.points(df), found.centres).count() == 8
    # Rows of another length are left out where the centres tell the length.
    odd = V.points(df).unionByName(spark.createDataFrame([(99, [1.0])], "id long, vector array<double>"))
    assert V.assigned(odd, found.centres).where("id = 99").isEmpty()
    empty = V.build_index(V.points(df.limit(0)), 3)
    assert V.nearest(empty, unit, exact=True).count() == 0


def test_recall_of_the_given_tables(spark):
    for sf in (SF001, SF01):
        rows = V.points(spark.read.parquet(f"{sf}/embeddings.parquet"), unit=True)
        index, asked = V.build_index(rows, 16), rows.where("id % 20 = 0")
        r = V.recall(V.nearest(index, asked), V.nearest(index, asked, exact=True)).first()
        assert r.n_queries == asked.count() and r.recall >= 0.9


def test_queries_that_are_not_broadcast_move_no_rows(spark, monkeypatch):
    """Queries beyond the broadcast bound: rows of an index stay where they are, and
    no task gathers a list with its queries."""
    from techmine.operators import joins
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 1)
    x = blobs(240, 5, 7)
    rows = V.points(frame(spark, x), unit=True)
    index = V.build_index(rows, 7)
    got = V.nearest(index, rows.where("id % 20 = 0"), 3, exact=True)
    plan = got._jdf.queryExecution().toString()
    assert "hashpartitioning(list" not in plan and "SortMergeJoin [list" not in plan
    want = brute_nearest(x, list(range(240)), range(0, 240, 20))
    assert {r["id"]: r["nearest_id"] for r in got.collect()} == {q: k for q, (k, _) in want.items()}


def test_blocks_keep_ties_and_repeated_ids(spark):
    """Equal vectors, equal ids with other vectors, and null ids, over several blocks."""
    rng = np.random.default_rng(4)
    pool = rng.normal(size=(30, 4))
    data = [(int(i) if i % 37 else None, [float(v) for v in pool[rng.integers(30)]], "") for i in rng.integers(0, 500, 900)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, cluster string")
    rows = V.points(df, unit=True)
    got = {r["id"]: (r["nearest_id"], r["distance"]) for r in V.nearest(
        V.build_index(rows, 5), rows.where("id % 20 = 0"), 2, exact=True).collect()}
    held = [(r["id"], r["vector"]) for r in rows.collect() if r["id"] is not None]

    def cost(a, b):
        total = 0.0
        for p, q in zip(a, b, strict=True):
            total += (p - q) * (p - q)
        return total

    want = {}
    for q, v in held:
        if q % 20 == 0:
            best = min((cost(v, w), i) for i, w in held if i != q)
            want[q] = min(want.get(q, best), best)
    assert {q: i for q, (i, _) in got.items()} == {q: i for q, (_, i) in want.items()}
    assert all(got[q][1] == np.sqrt(c) for q, (c, _) in want.items())
