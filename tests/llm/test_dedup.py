import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from techmine.llm import circulant_minhash as cm
from techmine.llm import components as cc
from techmine.llm import quotient_dedup as qd

UPPER = {c: c + 32 for c in range(65, 91)}


def test_quotient_filter_counts_and_merges():
    r = np.random.default_rng(1)
    for size in (1, 2, 50, 3000):
        a, b = (r.integers(0, 1 << 63, size, dtype=np.uint64) % np.uint64(size * 7) * np.uint64(1 << 50) for _ in "ab")
        fs = []
        for x in (a, b):
            f, n = np.unique(x, return_counts=True)
            fs.append(qd.CountingQuotientFilter.of(f, n.astype(np.uint64)))
        m = qd.CountingQuotientFilter.from_bytes(fs[0].to_bytes()).merged(fs[1])
        f, n = np.unique(np.concatenate([a, b]), return_counts=True)
        assert m.fingerprints().tolist() == f.tolist() and m.counts.tolist() == n.tolist()
        parts = list(m.slices(5))
        back = [qd.CountingQuotientFilter.from_bytes(p.to_bytes()) for p in parts]
        assert np.concatenate([p.fingerprints() for p in back]).tolist() == f.tolist()
        assert np.concatenate([p.counts for p in back]).tolist() == n.tolist()


def test_slices_of_many_partitions_merge_few_times(monkeypatch):
    merges = []
    merged = qd.CountingQuotientFilter.merged
    monkeypatch.setattr(qd.CountingQuotientFilter, "merged",
                        lambda a, b: merges.append(len(a.remainders) + len(b.remainders)) or merged(a, b))
    r = np.random.default_rng(2)
    all_of = [np.sort(r.choice(np.arange(1, 60_000, dtype=np.uint64), 100, replace=False)) for _ in range(256)]
    rows = [qd.CountingQuotientFilter.of(f, np.ones(100, np.uint64), 0, 4).to_bytes() for f in all_of]
    batch = pa.RecordBatch.from_arrays([pa.array([0] * 256, pa.int32()), pa.array(rows, pa.binary())], ["slice", "filter"])
    got = np.concatenate([b.column(0).to_numpy() for b in qd._merge_slices(iter([batch]))])
    f, n = np.unique(np.concatenate(all_of), return_counts=True)
    assert got.tolist() == f[n > 1].tolist()
    assert sum(merges) <= 256 * 100 * 10  # one after the other: about 2,700,000 entries



def exact(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault((t or "").translate(UPPER), []).append(i)
    out = []
    for i, t, *_ in rows:
        norm = (t or "").translate(UPPER)
        keep = max((x for x in groups[norm] if x is not None), default=None)
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_classes_edge_cases(spark, edge, empty):
    from tests.llm.conftest import EDGE
    got = [tuple(r) for r in qd.classes(edge).collect()]
    assert sorted(got, key=repr) == exact(EDGE)
    assert qd.classes(empty).count() == 0
    kept = qd.drop_copies(edge)
    assert kept.columns == edge.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        (i for i, keep, *_ in exact(EDGE) if i == keep), key=repr)


def test_equal_fingerprints_are_verified_by_bytes(spark, documents, monkeypatch):
    # A useless fingerprint sends everything to verification; nothing may merge.
    from pyspark.sql import functions as F
    monkeypatch.setattr(qd.F, "xxhash64", lambda *c: F.length(c[0]).cast("long") * 0)
    rows = [(i, f"text {i // 2}", "s") for i in range(20)]
    got = [tuple(r) for r in qd.classes(documents(spark, rows)).collect()]
    assert sorted(got, key=repr) == exact(rows)


def near(rows, width, num=80, den=100):
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    ids = sorted(i for i in sets if sets[i])
    for x in ids:
        for y in ids:
            if x < y and den * len(sets[x] & sets[y]) >= num * len(sets[x] | sets[y]):
                a, b = root(x), root(y)
                comp[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def edited(r, words, n):
    w = list(words)
    for _ in range(n):
        w[r.randrange(len(w))] = f"e{r.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.mark.parametrize("width", [2, 5])
def test_near_classes_against_all_pairs(spark, documents, width):
    r = random.Random(width)
    vocab = [f"v{k}" for k in range(3000)]
    rows, k = [], 0
    for size, edits in ((60, 6), (40, 14), (10, 3), (8, 30)):  # groups around the threshold
        base = [r.choice(vocab) for _ in range(120)]
        for _ in range(size):
            rows.append((k, edited(r, base, r.randint(0, edits)), "s"))
            k += 1
    for _ in range(60):
        rows.append((k, " ".join(r.choice(vocab[:40]) for _ in range(r.randint(1, 60))), "s"))
        k += 1
    rows += [(k + j, t, "s") for j, t in enumerate(["", None, "one", "ONE", "two words", "Two  words", "a b c d e f"] * 2)]
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"], x["kept"])
           for x in cm.near_classes(documents(spark, rows), width=width).collect()}
    assert got == near(rows, width)


def test_buckets_without_a_common_centre(spark, documents, monkeypatch):
    # One bucket for all: stars and the pairs across must find every link alone.
    monkeypatch.setattr(cm, "band_keys", lambda sig, bands, rows: np.zeros(1, np.uint64))
    monkeypatch.setattr(cm, "BANDS", 1)
    r = random.Random(8)
    rows, k = [], 0
    for g in range(12):
        base = [f"g{g}w{j}" for j in range(100)]
        for _ in range(5):
            rows.append((k, edited(r, base, r.randint(0, 9)), "s"))
            k += 1
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"], x["kept"])
           for x in cm.near_classes(documents(spark, rows).coalesce(1), width=2).collect()}
    assert got == near(rows, 2)


def test_near_edge_cases(spark, edge, empty):
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"], x["kept"]) for x in cm.near_classes(edge, width=2).collect()}
    assert got[1] == (0, 1, True) and got[2] == (0, 2, True) and got[3] == (0, 3, True)
    assert got[4] == (1, 4, True) and got[8] == (1, 4, False)
    assert got[5][1] == got[6][1] == got[7][1] == 5
    assert got[None][1] is None
    assert cm.near_classes(empty).count() == 0
    kept = cm.drop_near_copies(edge, width=2)
    assert kept.columns == edge.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 5, 9, None, 11}


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(1000, 1001), (1001, 1001)], "a long, b long")
    got = {r["node"]: r["component"] for r in cc.components(links).collect()}
    assert got == {**{k: 0 for k in range(201)}, 1000: 1000, 1001: 1000}


def test_signature_coordinates_are_circular_shifts():
    s = np.sort(np.random.default_rng(0).integers(0, 1 << 63, 400, dtype=np.uint64))
    sig = cm.signature(s, 12)
    ranks = cm._ranks(12)[:, 0]
    at = (cm._mix(s ^ np.uint64(cm.SEED)) >> np.uint64(64 - cm.UNIVERSE_BITS)).astype(int)
    size = 1 << cm.UNIVERSE_BITS
    assert sig.tolist() == [min(ranks[(a + k) % size] for a in at) for k in range(12)]


def test_parities_bound_the_difference():
    r = np.random.default_rng(8)
    for n in (1, 5, 40, 700, 9000):
        x = np.unique(r.integers(0, 1 << 62, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[: len(x) * 3 // 4], r.integers(0, 1 << 62, n // 3, dtype=np.uint64)]))
        bits = cm.parity_bits(len(x))
        a, b = cm.parity(x, bits), cm.parity(y, bits)
        differ = int(np.unpackbits((a ^ b).view(np.uint8)).sum())
        assert differ <= len(np.setxor1d(x, y))
        assert len(a) * 64 == bits and 64 <= bits <= cm.MOST_CELLS
        # Folding gives the parity of half as many cells.
        if bits > 64:
            assert (a[: len(a) // 2] ^ a[len(a) // 2:]).tolist() == cm.parity(x, bits // 2).tolist()


def test_group_of_variants_equals_all_pairs(spark, documents):
    """Many edits of one text: one large component, some documents just outside it,
    and pairs of these that are linked with each other alone."""
    r = random.Random(11)
    base = [f"b{k}" for k in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(r.choice((1, 2, 3, 4, 5, 6))):
            w[r.randrange(60)] = f"x{i}_{r.randrange(9)}"
        rows.append((1000 - i, " ".join(w), "s"))
        if i % 10 == 0:
            rows.append((3000 + i, " ".join([*w, f"tail{i}"]), "s"))
    for width in (2, 5):
        got = {q.doc_id: (q.n_shingles, q.component_id, q.kept)
               for q in cm.near_classes(documents(spark, rows), width).collect()}
        assert got == near([(i, t) for i, t, _ in rows], width)
        assert 3 < len({c for _, c, _ in got.values()}) < len(rows) - 10


def test_large_group_does_not_come_out_pair_by_pair(spark, documents, monkeypatch):
    """A group of near copies whose smallest document is linked with none of them: the
    pairs that are verified stay near the number of documents."""
    monkeypatch.setattr(cm, "band_keys", lambda sig, bands, rows: np.zeros(1, np.uint64))
    monkeypatch.setattr(cm, "BANDS", 1)
    seen = []
    verified = cm._Corpus.verified
    monkeypatch.setattr(cm._Corpus, "verified", lambda self, pairs: (
        seen.append(pairs.count()), verified(self, pairs))[1])
    base = [f"b{k}" for k in range(100)]
    rows = [(0, " ".join(f"other{k}" for k in range(100)), "s")]
    rows += [(k, " ".join([*base[:-1], f"x{k}"]), "s") for k in range(1, 121)]
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"], x["kept"])
           for x in cm.near_classes(documents(spark, rows), width=2).collect()}
    assert got == near([(i, t) for i, t, _ in rows], 2)
    assert sum(seen) <= 4 * len(rows)


def test_few_comparisons_take_one_round(spark, documents, monkeypatch):
    """Buckets whose members are never linked: while all of them meet as few rows as one
    round may, the other rounds do not run."""
    monkeypatch.setattr(cm, "band_keys", lambda sig, bands, rows: sig[:1].astype(np.uint64) % np.uint64(16))
    monkeypatch.setattr(cm, "BANDS", 1)
    rounds = []
    across = cm._across
    monkeypatch.setattr(cm, "_across", lambda *a: (rounds.append(1), across(*a))[1])
    r = random.Random(4)
    rows = [(k, " ".join(f"v{r.randrange(3000)}" for _ in range(30)), "s") for k in range(50)]
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"], x["kept"])
           for x in cm.near_classes(documents(spark, rows), width=2).collect()}
    assert got == near(rows, 2)
    assert 1 <= len(rounds) <= 2
