import numpy as np

import corpus_pipeline as cp
from techmine.llm.common import stored
from tests.conftest import SF001
from tests.llm.test_dedup import UPPER, near
from tests.llm.test_texts import base_spans, figures
from tests.llm.test_tokens import WORD, check_packing

__all__ = ["np", "WORD"]


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = stored(cp.quality_rules(spark, docs, SF001), "t")
    rows = {r["doc_id"]: r for r in docs.collect()}
    good = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == docs.columns
    assert good <= {i for i, r in rows.items() if not figures(r["text"])[5]}
    # Nothing that fails no rule is dropped.
    fine = {i for i, r in rows.items() for n, chars, sym, dup, _, base in [figures(r["text"])]
            if not base and 100 * sym <= 20 * n and not dup and 2 * n <= chars <= 12 * n}
    assert fine <= good
    groups = {}
    for i in good:
        groups.setdefault(rows[i]["text"].translate(UPPER), []).append(i)
    exact = sorted(max(g) for g in groups.values())
    classes = near([(i, rows[i]["text"]) for i in exact], 5)
    left = sorted(i for i in exact if classes[i][2])
    out = stored(cp.run(spark, SF001), "t").collect()
    assert sorted({r["doc_id"] for r in out}) == left
    clean = stored(cp.secret_scans(spark, docs, SF001), "t")
    assert clean.columns == docs.columns and clean.schema == docs.schema
    texts = {}
    for r in clean.collect():
        assert not base_spans(r["text"] or "")
        if not base_spans(rows[r["doc_id"]]["text"] or ""):
            assert r["text"] == rows[r["doc_id"]]["text"]
        assert r["n_chars"] == len(r["text"])
        texts[r["doc_id"]] = r["text"]
    n, total = check_packing(out, [(i, texts[i]) for i in left], 4096)
    assert n <= -(-total // 4096) + 1


def test_stages_on_edge_tables(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for df in (docs.limit(0), spark.createDataFrame([(1, None, None, None, None), (None, "", "x", "y", 0)], docs.schema)):
        at = df
        for _, stage in cp.STAGES:
            at = stored(stage(spark, at, SF001), "t")
        assert at.count() == 0
        for _, stage in cp.STAGES[1:4]:
            assert stage(spark, df, SF001).count() in (df.count(), 1)
