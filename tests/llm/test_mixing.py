import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from techmine.llm import mixing as mx


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def expected_targets(sizes):
    """Brute force: hand out by weight, take back what is above, hand out again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = dict(zip(order, (5, 2, 1) * len(order)))
    total = 1.5 * sum(sizes.values())
    out, open_ = {s: 0.0 for s in sizes}, set(sizes)
    while open_ and total > 1e-9:
        w = sum(weight[s] for s in open_)
        for s in open_:
            out[s] += total * weight[s] / w
        total = 0.0
        for s in list(open_):
            if out[s] >= 2 * sizes[s]:
                total += out[s] - 2 * sizes[s]
                out[s] = float(2 * sizes[s])
                open_.discard(s)
    return out


def check(rows, plan):
    """``rows`` (id, text, source) against the planned draws."""
    got = Counter((r.doc_id, r.source, r.size) for r in plan)
    assert got == Counter((i, s, words(t)) for i, t, s in rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    want = expected_targets(dict(sizes))
    total, shards = Counter(), Counter()
    for r in plan:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-6)
        n = sum(d.to_word - d.from_word for d in r.draws)
        assert n <= 2 * r.size
        by_pass = defaultdict(list)
        for d in r.draws:
            assert 0 <= d.from_word < d.to_word <= r.size and d["pass"] in (0, 1)
            by_pass[d["pass"]] += range(d.from_word, d.to_word)
        assert all(len(set(w)) == len(w) for w in by_pass.values())  # disjoint within a pass
        total[r.source] += n
        for d in r.draws:
            shards[d.shard] += 1
    for s in sizes:  # exact to the word
        assert abs(total[s] - want[s]) <= 0.5 + 1e-6
    return shards


def test_mix_of_documents(spark, documents):
    rows = [(k, " ".join(f"w{k}_{j}" for j in range(k * 7 % 90)), f"s{min(k % 11, 6)}" if k % 13 else None)
            for k in range(700)] + [(9000, "long " * 5000, "s0"), (9001, None, "s1"), (9002, "", "empty")]
    df = documents(spark, rows)
    plan = mx.planned(df, block=64, shards=8)
    first = plan.collect()
    check(rows, first)
    # Reruns agree, also with the rows in another order and dealt differently.
    again = mx.planned(df.orderBy(F.rand(3)).repartition(3), block=64, shards=8)
    assert sorted(map(repr, first)) == sorted(map(repr, again.collect()))
    other = mx.planned(df, block=64, shards=8, seed=5).collect()
    assert sorted(map(repr, first)) != sorted(map(repr, other))


def test_edge_tables(spark, edge, empty):
    from tests.llm.conftest import EDGE
    check(EDGE, mx.planned(edge, block=1000, shards=3).collect())
    assert mx.planned(empty).count() == 0
    assert mx.planned(edge.where("doc_id = 2")).select(mx.taken()).first()[0] == 0


def test_bijection(spark):
    for n in (1, 2, 3, 17, 64, 1000):
        df = spark.range(n).select("id", mx.permuted(F.col("id"), F.lit(n), F.lit(3), F.lit("k")).alias("p"))
        got = [r.p for r in df.orderBy("id").collect()]
        assert sorted(got) == list(range(n))
        if n >= 64:
            assert sum(abs(a - b) == 1 for a, b in zip(got, got[1:])) < n / 4


def pmf(good, bad, drawn):
    all_ = math.comb(good + bad, drawn)
    return {k: math.comb(good, k) * math.comb(bad, drawn - k) / all_
            for k in range(max(0, drawn - bad), min(good, drawn) + 1)}


@pytest.mark.parametrize("good,bad,drawn", [(5, 7, 4), (1, 9, 10), (0, 4, 2), (4, 0, 2), (60, 30, 45), (300, 2, 151),
                                            (3, 3, 0), (1000, 800, 90)])
def test_variates_follow_the_distribution(spark, good, bad, drawn):
    n = 4000
    long = lambda x: F.lit(x).cast("long")
    df = spark.range(n).select(mx.hypergeometric(
        long(good), long(bad), long(drawn), (F.col("id") + 0.5) / n).alias("k"))
    got = Counter(r.k for r in df.collect())
    want = pmf(good, bad, drawn)
    assert set(got) <= set(want)
    # Evenly spaced uniforms: every value comes up as often as it should, within one.
    assert all(abs(got[k] - n * p) <= 1.001 for k, p in want.items())


def test_large_variates(spark):
    g, b, d = 40_000_000, 25_000_000, 31_000_000
    long = lambda x: F.lit(x).cast("long")
    ks = [r.k for r in spark.range(60).select(mx.hypergeometric(
        long(g), long(b), long(d), mx.uniform(F.lit(1), "id")).alias("k")).collect()]
    mean = d * g / (g + b)
    sd = math.sqrt(mean * b / (g + b) * (g + b - d) / (g + b - 1))
    assert all(abs(k - mean) < 6 * sd for k in ks)
    assert abs(sum(ks) / 60 - mean) < 5 * sd / math.sqrt(60)
    assert 0.6 * sd < math.sqrt(sum((k - mean) ** 2 for k in ks) / 60) < 1.5 * sd


@pytest.mark.parametrize("draws,shards", [([7], 3), ([0, 5, 9, 100, 3], 4), ([1] * 33, 8), ([0, 0], 2), ([50, 1000], 1)])
def test_tree_margins(spark, draws, shards):
    src = spark.createDataFrame(list(enumerate(draws)), "rank long, draws long")
    out = {r["rank"]: r.per_shard for r in mx.splitting_tree(src, shards, 7).collect()}
    assert {k: sum(v) for k, v in out.items()} == dict(enumerate(draws))
    cols = [sum(v[j] for v in out.values()) for j in range(shards)]
    size, more = divmod(sum(draws), shards)
    assert cols == [size + (j < more) for j in range(shards)]
    assert all(x >= 0 for v in out.values() for x in v)


def test_written_mix(spark, documents, tmp_path):
    rows = [(k, " ".join(f"d{k}w{j}" for j in range(30 + k % 50)), f"s{k % 3}") for k in range(120)]
    df = documents(spark, rows)
    mix = mx.write_mix(df, str(tmp_path / "mix"), shards=4, block=32)
    plan = {r.doc_id: r for r in mx.planned(df, shards=4, block=32).collect()}
    got = Counter()
    for r in mix.collect():
        ws = rows[r.doc_id][1].split()
        assert r.text == " ".join(ws[r.from_word:r.to_word])
        got[r.doc_id] += r.to_word - r.from_word
    assert got == Counter({i: sum(d.to_word - d.from_word for d in r.draws) for i, r in plan.items()})
    # About equally many draws in each shard: draws are blocks, here shared by few documents.
    assert {r.shard for r in mix.select("shard").distinct().collect()} == {0, 1, 2, 3}


def test_plan_is_native(spark, documents):
    plan = mx.planned(documents(spark, [(1, "a b", "s")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
