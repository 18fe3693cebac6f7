import json
import os

from pyspark.sql import functions as F

from conftest import rows
from techmine.session import shared_dir
from techmine.sources import works_json as WJ
from techmine.sources.csv_tables import read_model_table
from techmine.streaming.incremental import register_batch, run_registration_stream


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_csv_quirks(spark):
    d = _local(shared_dir(spark, "csv"))
    with open(os.path.join(d, "topics.csv"), "wb") as f:
        f.write(b'id,nombre_campo\r\n1,"Data, Science"\r\n2,  Plain \r\n3,')  # CRLF, no final newline
    with open(os.path.join(d, "works.csv"), "w", encoding="utf-8", newline="") as f:
        f.write('id,direccion_fuente,titulo,abstract,fecha_publicacion,idioma,num_citas,fwci,tematica_id,doi\n'
                '1,http://x/a.pdf, T ,"line one\nline ""two""",2020-01-01 ,en,,,,10.1/x\n'
                '2,http://x/b.pdf,T2,,2021-02-02,en,7,1.5,3,\n')
    t = read_model_table(spark, os.path.join(d, "topics.csv"), "topic")
    assert rows(t) == [(1, "Data, Science"), (2, "Plain"), (3, None)]
    w = read_model_table(spark, os.path.join(d, "works.csv"), "work")
    got = {r["id"]: r for r in w.collect()}
    assert got[1]["abstract"] == 'line one\nline "two"'
    assert got[1]["title"] == "T" and got[1]["published"] == "2020-01-01 "   # date not trimmed
    assert (got[1]["citations"], got[1]["fwci"], got[1]["topic_id"]) == (0, 0.0, None)
    assert (got[2]["citations"], got[2]["fwci"], got[2]["topic_id"], got[2]["doi"]) == (7, 1.5, 3, None)


def _rec(i, cites, pdf="u", topic="T", **kw):
    r = {"id": f"https://x.org/W{i}", "cited_by_count": cites,
         "best_oa_location": {"pdf_url": pdf, "is_accepted": True},
         "primary_topic": None if topic is None else {"display_name": topic,
                                                      "subfield": {"id": "https://x.org/subfields/1702"}},
         "open_access": {"is_oa": True}, "has_content": {"pdf": True}, "language": "en",
         "keywords": [{"id": "https://x.org/keywords/python"}]}
    r.update(kw)
    return r


def test_json_pages_to_works(spark):
    d = _local(shared_dir(spark, "pages"))
    pages = [
        {"results": [_rec(1, 5, topic="B", title="one",
                          abstract_inverted_index={"the": [0, 2], "cat": [1]}),
                     _rec(2, 9, topic="A"), _rec(3, 9, pdf=""), _rec(4, 1, topic=None)],
         "meta": {"count": 6}},
        {"meta": {"count": 6}},                                       # no results: nothing
        {"results": [_rec(5, 9, topic="B", language="fr"), _rec(6, 0, topic="B", doi="10.1/z"),
                     _rec(7, 3, keywords=[{"id": "https://x.org/keywords/ruby"}])], "meta": {"count": 6}},
    ]
    with open(os.path.join(d, "p.json"), "w") as f:
        for p in pages:
            f.write(json.dumps(p) + "\n")
    recs = WJ.read_pages(spark, d).where(WJ.selection())
    works, topics = WJ.works_and_topics(recs)
    got = rows(works, "id", "source_id" if "source_id" in works.columns else "title", "abstract",
               "citations", "topic_id", "doi", "published", "language")
    # ids by citations desc then record id: W2 (9), W1 (5), W6 (0)
    assert got == [(1, "", "", 9, 1, None, "", "en"), (2, "one", "the cat the", 5, 2, None, "", "en"),
                   (3, "", "", 0, 2, "10.1/z", "", "en")]
    assert rows(topics) == [(1, "A"), (2, "B")]


def test_stream_batches_and_replay(spark):
    landing = shared_dir(spark, "landing")
    rows1 = spark.createDataFrame([(1, "2020-01-01", "Go"), (1, "2020-01-01", "C"), (2, "2020-02-01", "C")],
                                  "work_id long, d string, name string").select(
        "work_id", F.to_timestamp("d").alias("o_orderdate"), "name")
    rows2 = spark.createDataFrame([(3, "2021-01-01", "Zig"), (3, "2021-01-01", "Go")],
                                  "work_id long, d string, name string").select(
        "work_id", F.to_timestamp("d").alias("o_orderdate"), "name")
    rows1.coalesce(1).write.mode("append").parquet(landing)
    rows2.coalesce(1).write.mode("append").parquet(landing)
    dim, links = shared_dir(spark, "dim"), shared_dir(spark, "links")
    run_registration_stream(spark, landing, rows1.schema, dim, links, shared_dir(spark, "ck"),
                            ["o_orderdate", "work_id"])
    assert rows(spark.read.parquet(dim)) == [(1, "C"), (2, "Go"), (3, "Zig")]
    assert rows(spark.read.parquet(links)) == [(1, 1, 1), (2, 1, 2), (3, 2, 1), (4, 3, 2), (5, 3, 3)]
    # a replayed batch adds nothing
    register_batch(spark, rows2, dim, links, ["o_orderdate", "work_id"])
    assert spark.read.parquet(dim).count() == 3 and spark.read.parquet(links).count() == 5


def test_malformed_values_and_row_count(spark):
    from techmine.operators.pages import join_pages, with_row_count
    from techmine.sources.csv_tables import malformed_values
    raw = spark.createDataFrame([("1", "u", "t", None, None, None, "12", "x1", "3", None),
                                 ("2", "u", "t", None, None, None, " ", "", "a", None)],
                                "id string, direccion_fuente string, titulo string, abstract string, "
                                "fecha_publicacion string, idioma string, num_citas string, fwci string, "
                                "tematica_id string, doi string")
    assert rows(malformed_values(raw, "work")) == [("fwci", "x1", 1), ("tematica_id", "a", 1)]
    pages = spark.createDataFrame([(1, 2, "b "), (1, 1, " a"), (2, 1, "  ")], "d long, n long, t string")
    out, obs = with_row_count(join_pages(pages, "d", "n", "t"), "docs")
    assert rows(out) == [(1, "a\n\nb"), (2, None)]
    assert obs.get["rows"] == 2


def test_overwrite_refuses_own_input(spark):
    import pytest
    from techmine.sinks.tables import overwrite
    p = shared_dir(spark, "ow")
    spark.range(5).write.mode("overwrite").parquet(p)
    df = spark.read.parquet(p)
    with pytest.raises(ValueError):
        overwrite(df.where("id > 1"), p)
    q = shared_dir(spark, "ow2")
    overwrite(df.where("id > 1"), q)
    assert spark.read.parquet(q).count() == 3


def test_json_topics_continue_after_stored(spark):
    d = _local(shared_dir(spark, "pages2"))
    page = {"results": [_rec(1, 5, topic="C"), _rec(2, 9, topic="A"), _rec(3, 1, topic="D")], "meta": {"count": 3}}
    with open(os.path.join(d, "p.json"), "w") as f:
        f.write(json.dumps(page) + "\n")
    stored = spark.createDataFrame([(4, "A")], "id long, name string")
    works, topics = WJ.works_and_topics(WJ.read_pages(spark, d).where(WJ.selection()), stored)
    assert rows(topics) == [(4, "A"), (5, "C"), (6, "D")]
    assert rows(works, "id", "topic_id") == [(1, 4), (2, 5), (3, 6)]


def test_records_are_computed_once_and_landed_in_order(spark, tmp_path):
    from pyspark.sql import functions as F
    from techmine.sources import works_json as WJ
    seen = spark.sparkContext.accumulator(0)

    def title(k):
        seen.add(1)
        return f'"{k}"\n'
    records = spark.range(0, 450, 1, 3).select(
        F.format_string("W%04d", 449 - F.col("id")).alias("id"), F.udf(title)("id").alias("title"),
        F.lit(None).cast("string").alias("doi"))
    path = str(tmp_path / "pages")
    WJ.write_pages(records, path, "id")
    assert seen.value == 450
    pages = sorted((r["value"] for r in spark.read.text(path).collect()), key=lambda v: v[v.index("W"):][:5])
    pages = [json.loads(p) for p in pages]
    assert [len(p["results"]) for p in pages] == [200, 200, 50]
    assert [r["id"] for p in pages for r in p["results"]] == [f"W{k:04d}" for k in range(450)]
    assert pages[0]["results"][0] == {"id": "W0000", "title": '"449"\n'} and pages[0]["meta"] == {"count": 450}


def _made_documents(tmp_path, spark, docs):
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_rows_move_once_to_whole_pages(spark, tmp_path):
    from pyspark.sql import functions as F
    from techmine.sources import works_json as WJ
    # Every third row has no name, the others come two by two but one.
    rows = [(k, None if k % 3 == 0 else f"n{(k + 1) // 2:04d}" + "é\x00\\\"" * (k % 2), k) for k in range(100)]
    df = spark.createDataFrame(rows, "k long, name string, __row long").repartition(5)
    dealt, total = WJ._dealt_to_pages(df, ["name", "__row"], 7)
    assert total == 100
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2  # the other is the test's own
    got = sorted((r["__part"], r["__seq"], r["k"]) for r in dealt.collect())
    want = [r[0] for r in sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[2]))]
    assert [k for _, _, k in got] == want
    sizes = [sum(p == q for p, _, _ in got) for q in sorted({p for p, _, _ in got})]
    assert len(set(sizes[:-1])) == 1 and sizes[0] % 7 == 0 and 1 < len(sizes) <= 8
    path = str(tmp_path / "pages")
    WJ.write_pages_of(df, lambda d: d.withColumn("id", F.concat(F.lit("W"), "k")), path, ["name", "__row"], 7)
    pages = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    place = {k: i for i, k in enumerate(want)}
    pages.sort(key=lambda p: place[p["results"][0]["k"]])
    assert [r["k"] for p in pages for r in p["results"]] == want and {p["meta"]["count"] for p in pages} == {100}
    assert [len(p["results"]) for p in pages] == [7] * 14 + [2]
    assert list(pages[-1]["results"][0]) == ["k", "name", "id"]


def test_documents_that_share_an_id_have_each_others_texts(spark, tmp_path):
    from techmine.operators.inverted_index import inverted_index
    from techmine.plans import q_sources as QS
    docs = [(k, f"text of {k}" if k % 4 else " ", "en", f"src{k}", k) for k in range(10)]
    docs += [(3, "another", "de", "src9", 1), (3, None, "en", "src8", 2), (4, "", "en", "src4", 4),
             (None, "no id", "en", "src5", 5), (None, "no id", "en", "src6", 6)]
    base = _made_documents(tmp_path, spark, docs)
    d = spark.read.parquet(f"{base}/documents.parquet")
    want = d.join(inverted_index(d, "doc_id", "text"), "doc_id", "left").select("source", "lang", "n_chars", "index")
    rows_of = QS._documents_with_texts(spark, base)
    records = QS._records_from_documents(rows_of)
    got = records.select("title", "language", "cited_by_count", "abstract_inverted_index")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))
    order = [tuple(r) for r in rows_of.select(*QS.DOCUMENT_ORDER).collect()]
    assert len(order) == len(set(order)) == 8 + 3 * 2 + 2 + 2  # id 3 has two texts, id 4 has none, two have no id
    assert sorted(map(str, order)) == sorted(str(tuple(r)) for r in rows_of.select(*QS.DOCUMENT_ORDER).collect())


def test_loaded_pages_take_less_disk_than_their_texts(spark, tmp_path):
    import os
    import random
    from techmine.plans import registry
    from techmine.session import ensure_checkpoint_dir
    registry.load_all()
    r = random.Random(1)
    names = ["".join(r.choices("abcdefghij", k=6)) for _ in range(3000)]
    docs = [(k, " ".join(r.choices(names, k=300)), "en", f"src{k % 7}", k) for k in range(1000)]
    base, top = _made_documents(tmp_path, spark, docs), ensure_checkpoint_dir(spark).removeprefix("file:")

    def stored():
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(top) for f in fs)
    before = stored()
    got = {r["p"]: r["n"] for r in registry.QUERIES["json_load_graph_counts"](spark, base).collect()}
    kept = [k for k, *_, source, _ in docs if source in ("src4", "src5", "src6")]
    assert got["abstract"] == got["url"] == len(kept) and got["identifier"] == sum(k % 3 != 0 for k in kept)
    assert stored() - before < 1.8 * sum(len(t) for _, t, *_ in docs)
