"""HI3/HI4 by doubling and after new edges; QRY2 top k by bounds."""

import random
from collections import Counter, deque

import pytest
from pyspark.sql import functions as F

from techmine.operators import hierarchy as H
from techmine.plans import reports
from techmine.session import written

EDGE = "id long, parent_id long, child_id long"


def brute(edges):
    """{(ancestor, descendant): (depth, smallest shortest path)} by breadth-first search."""
    kids = {}
    for p, c in edges:
        kids.setdefault(p, set()).add(c)
    out = {}
    for a in kids:
        level = {a: (a,)}
        seen = set()
        while level:
            nxt = {}
            for node, path in level.items():
                for c in kids.get(node, ()):
                    if c not in seen:
                        nxt[c] = min(nxt.get(c, (*path, c)), (*path, c))
            seen |= set(nxt)
            for c, path in nxt.items():
                out[a, c] = (len(path) - 1, path)
            level = nxt
    return out


def frame(spark, edges):
    return spark.createDataFrame([(i, p, c) for i, (p, c) in enumerate(edges)], EDGE)


def collected(df):
    return {(r["ancestor_id"], r["descendant_id"]): (r["depth"], tuple(r["path"])) for r in df.collect()}


def graph(seed):
    r = random.Random(seed)
    return [(r.randint(1, 14), r.randint(1, 14)) for _ in range(22)]  # cycles, self edges and repeats occur


@pytest.mark.parametrize("edges", [graph(1), graph(2), [], [(1, 1)], [(1, 2), (2, 3), (3, 1), (1, 2)]])
def test_closure_against_breadth_first_search(spark, edges):
    df = frame(spark, edges).union(spark.createDataFrame([(99, None, 1), (98, 1, None)], EDGE))
    assert collected(H.closure(df)) == brute(edges)


def test_deep_chain_takes_logarithmic_rounds(spark, monkeypatch):
    rounds = []
    doubled = H._doubled
    monkeypatch.setattr(H, "_doubled", lambda found, reach: rounds.append(reach) or doubled(found, reach))
    n = 1000
    found = H.closure(frame(spark, [(k, k + 1) for k in range(n)]), paths=False)
    assert found.columns == ["ancestor_id", "descendant_id", "depth"]
    assert found.count() == n * (n + 1) // 2 and found.where("depth <> descendant_id - ancestor_id").isEmpty()
    assert len(rounds) <= 11


@pytest.mark.parametrize("seed", [3, 4])
def test_new_edges_extend_a_closure(spark, seed):
    edges = graph(seed)
    old, new = edges[:12], [*edges[12:], edges[0]]
    got = H.extended_closure(H.closure(frame(spark, old)), frame(spark, new))
    assert collected(got) == brute(edges)


def test_new_edges_that_follow_one_another(spark):
    chain = [(k, k + 1) for k in range(40)]
    got = H.extended_closure(H.closure(frame(spark, chain[::2])), frame(spark, chain[1::2]))
    assert collected(got) == brute(chain)
    none = H.extended_closure(H.closure(frame(spark, chain[::2])), frame(spark, []))
    assert collected(none) == brute(chain[::2])


def naive(rows):
    seen = {(g, i, a, j, b) for g, i, a in rows for h, j, b in rows if g == h and i != j}
    counts = Counter((a, b) for g, a, b in {(g, a, b) for g, _, a, _, b in seen})
    return sorted(((a, b, n) for (a, b), n in counts.items()), key=lambda x: (-x[2], x[0], x[1]))


@pytest.mark.parametrize("groups,names,rows", [(3, 40, 300), (12, 60, 260), (2, 3, 9), (30, 50, 80)])
def test_top_pairs_equal_the_literal_join(spark, groups, names, rows):
    r = random.Random(rows)
    data = sorted({(r.randint(1, groups), i, f"n{i % names:02d}") for i in [int(r.random() ** 2 * names * 1.5) for _ in range(rows)]})
    df = spark.createDataFrame(data, "g long, iri long, name string")
    for top in (1, 10):
        got = [tuple(x) for x in reports.shared_group_pairs(df, "g", "iri", "name", top=top).collect()]
        assert got == naive(data)[:top]


@pytest.mark.parametrize("one_hash", [False, True])
def test_pairs_by_text_iris_sort_no_rows(spark, monkeypatch, one_hash):
    r = random.Random(7)
    data = sorted({(r.randint(1, 9), i, f"n{i % 20:02d}") for i in [int(r.random() ** 2 * 30) for _ in range(200)]})
    if one_hash:  # all iris collide
        monkeypatch.setattr(reports.F, "xxhash64", lambda c: F.lit(1).cast("long"))
    kept = {}
    monkeypatch.setattr(reports, "written", lambda df, name: kept.setdefault(name, written(df, name)) and
                        kept.setdefault(f"{name} plan", df._jdf.queryExecution().toString()) and kept[name])
    rows = [(g, f"https://example.org/{i}", a) for g, i, a in data] * 2  # rows may repeat
    df = spark.createDataFrame([*rows, (1, None, "n00"), (None, "x", "n00"), (1, "x", None)], "g long, iri string, name string")
    got = reports.shared_group_pairs(df, "g", "iri", "name").collect()
    assert sorted(map(tuple, got)) == sorted(naive(data))
    assert [tuple(x) for x in reports.shared_group_pairs(df, "g", "iri", "name", top=10).collect()] == naive(data)[:10]
    plan = kept["iri-bounds plan"].split("Physical Plan")[-1]
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_rare_names_are_not_paired(spark, monkeypatch):
    rows = [(g, i, f"often{i}") for g in range(20) for i in range(12)] + [(g, 100 + g * 50 + k, f"rare{g}-{k}")
                                                                         for g in range(20) for k in range(50)]
    df = spark.createDataFrame(rows, "g long, iri long, name string")
    paired = []
    pair = reports.pairs_within_groups

    def counted(*a, **k):
        out = pair(*a, **k)
        paired.append(out.count())
        return out

    monkeypatch.setattr(reports, "pairs_within_groups", counted)
    reports.shared_group_pairs(df, "g", "iri", "name").agg(F.count("*")).collect()
    whole = paired.pop()
    got = reports.shared_group_pairs(df, "g", "iri", "name", top=10).collect()
    assert all(r["common_topics"] == 20 for r in got) and sum(paired) * 3 < whole
