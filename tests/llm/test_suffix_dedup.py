import hashlib
import random

import numpy as np
import pytest

from techmine.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string, sha string, doc string"


def brute(docs, length=100):
    """(n_bytes, n_removed, n_spans, sha) per row by a dictionary of all strings."""
    seen, out = set(), []
    for _, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            if s in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(s)
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    passage = [" ".join(word() for _ in range(k)) for k in (12, 25, 40, 80)]
    docs = []
    for _ in range(60):
        parts = [" ".join(word() for _ in range(r.randint(0, 40)))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passage)
            i = r.randint(0, 30)
            parts += [p[i:len(p) - r.randint(0, 30)], " ".join(word() for _ in range(r.randint(0, 20)))]
        docs.append("".join(parts))
    docs += [docs[3], docs[3], docs[5][:150], "x" * 400, "ab" * 300, "x" * 99, "x" * 100, "", None, passage[3] * 3]
    near = docs[7] + passage[2] + " tail of one"
    docs += [near.replace("a", "b", k) for k in range(8)]
    return docs


def run(spark, rows, length=100):
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], SCHEMA).repartition(5)
    got = sd.repeated_strings(df, length).collect()
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got}, got


def test_against_all_strings(spark):
    rows = list(enumerate(corpus()))
    got, raw = run(spark, rows)
    want = {i: w for (i, _), w in zip(rows, brute(rows), strict=True)}
    assert got == want
    assert sum(w[1] > 0 for w in want.values()) > 20
    for r in raw:  # spans are the bytes that go
        assert sum(s["high"] - s["low"] for s in r["removed"]) == r["n_removed"]


@pytest.mark.parametrize("length", [32, 400])
def test_other_lengths(spark, length):
    passage = " ".join(f"p{k * k % 91}" for k in range(400))
    rows = list(enumerate([*corpus(7), "head " + passage, passage[50:] + " tail", passage[:700]]))
    got, raw = run(spark, rows, length)
    assert got == {i: w for (i, _), w in zip(rows, brute(rows, length), strict=True)}
    assert max(s["high"] - s["low"] for r in raw for s in r["removed"]) > 600
    with pytest.raises(ValueError, match="length"):
        sd.repeated_strings(spark.createDataFrame([], SCHEMA), 70_000)


def test_buckets_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(sd, "BUCKET_BYTES", 1 << 11)
    rows = list(enumerate(corpus(11)))
    got, _ = run(spark, rows)
    assert got == {i: w for (i, _), w in zip(rows, brute(rows), strict=True)}


def test_equal_stretches_need_all_128_bits():
    rows = np.zeros(3, sd.SUFFIX)
    rows["stretch"], rows["stretch2"], rows["doc"] = 5, [1, 2, 1], [0, 1, 2]
    first, again = sd.collapsed(rows)
    assert first["doc"].tolist() == [0, 1] and again["doc"].tolist() == [2]


def test_long_text_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(sd, "BLOCK", 333)
    rows = list(enumerate(corpus(5)))
    many = [sd.suffixes_of(i, (t or "").encode(), 100) for i, t in rows]
    starts = sum(int((m["span"].astype(int) + 1).sum()) for ms in many for m in ms)
    assert starts == sum(max(0, len((t or "").encode()) - 99) for _, t in rows)


def test_hot_keys_spread_over_buckets(spark, monkeypatch):
    # Few samples of one repeated passage make equal splitters.
    monkeypatch.setattr(sd, "SAMPLE_DOCS_PER_BUCKET", 1000)
    r = random.Random(1)
    passage = "the common passage of this corpus, " * 4
    docs = ["".join(r.choice("abcdefgh ") for _ in range(30)) + passage[:120 + k % 20]
            + "".join(r.choice("abcdefgh ") for _ in range(30)) for k in range(80)]
    rows = list(enumerate(docs))
    got, _ = run(spark, rows)
    assert got == {i: w for (i, _), w in zip(rows, brute(rows), strict=True)}


def test_repeated_and_null_ids(spark):
    docs = corpus(9)[:20]
    rows = [(None, docs[0]), (None, docs[0]), (1, docs[1]), (1, docs[1]), (1, docs[0] + docs[2]), (2, docs[0])]
    df = spark.createDataFrame([(i, t, "", "") for i, t in rows], SCHEMA)
    got = sd.repeated_strings(df).collect()
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, hashlib.sha256(x[1].encode()).digest()))
    want = sorted((i is not None, i or 0, w) for (i, _), w in zip(order, brute(order), strict=True))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0,
                   (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in got) == want


def test_empty_table(spark):
    assert sd.repeated_strings(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 70, 5000])
def test_multikey_quicksort_orders_by_all_tokens(n):
    r = np.random.default_rng(n)
    t = r.integers(0, 4, (n, 3)).astype(np.uint64)
    order = sd.multikey_quicksort(t)
    assert sorted(order.tolist()) == list(range(n))
    assert t[order].tolist() == sorted(t.tolist())
