"""Loads, streams and resolution: nothing may be dropped on the way."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from techmine.functions import text as TX
from techmine.functions.html import parse_page
from techmine.operators import aliases as AL
from techmine.operators import constraints as C
from techmine.operators import detect as DT
from techmine.operators import graph as G
from techmine.operators.ids import dense_ids_after
from techmine.operators.resolve import resolve_text
from techmine.session import shared_dir
from techmine.sinks import rdf
from techmine.sinks import tables as TB
from techmine.sources import csv_tables as CT
from techmine.sources import tables as ST
from techmine.sources import works_json as WJ
from techmine.streaming.incremental import register_batch


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


RESPONSES = "url string, status int, content_type string, body_text string, page_texts array<string>"
NO_PROBE = ("url string, status int, content_type string",)


def _page(link):
    return f'<html><body><a href="{link}">x</a></body></html>'


def test_resolver_follows_chains_to_their_end(spark):
    n = 6
    resp = [(f"http://h/{k}.pdf", 200, "text/html", _page(f"http://h/{k + 1}.pdf"), None) for k in range(n)]
    resp += [(f"http://h/{n}.pdf", 200, "application/pdf", None, [" end ", "of chain"])]
    resp += [("http://loop/a.pdf", 200, "text/html", _page("http://loop/a.pdf"), None),
             ("http://soft/", 200, "text/html", "<p>Error 404</p>", None),
             ("http://blank.pdf", 200, "application/pdf", None, ["  ", ""]),
             ("http://oa.pdf", 200, "application/pdf", None, ["open"]),
             (f"{'https://dl.acm.org/doi/pdf/'}10.1/p", 200, "application/pdf", None, ["probed"]),
             ("http://view/", 200, "text/html", '<div class="textLayer">a</div><span>b</span>', None),
             ("http://twice/", 200, "text/html", _page("http://oa.pdf"), None),
             ("http://twice/", 200, "application/pdf", None, ["text wins"])]
    works = [(1, "http://h/0.pdf", "10.1/x"), (2, "http://loop/a.pdf", ""), (3, "http://soft/", "10.1/oa"),
             (4, "http://blank.pdf", "10.1/p"), (5, "http://view/", None), (6, None, "10.1/oa"),
             (7, "http://missing/", None), (8, "http://twice/", None), (9, "http://soft/", "10.1/oa")]
    oa = [("10.1/oa", "http://oa.pdf"), ("10.1/oa", "http://z.pdf")]
    probe = [("https://dl.acm.org/doi/pdf/10.1/p", 200, "application/pdf")]
    out = resolve_text(spark.createDataFrame(works, "work_id long, url string, doi string"),
                       spark.createDataFrame(resp, RESPONSES),
                       spark.createDataFrame(oa, "doi string, url_for_pdf string"),
                       spark.createDataFrame(probe, *NO_PROBE))
    got = {r["work_id"]: (r["text"], r["final_url"], r["hops"]) for r in out.collect()}
    assert got[1] == ("end \n\nof chain", f"http://h/{n}.pdf", n + 1)
    assert got[2] == (None, None, 1) and got[6] == (None, None, 0) and got[7] == (None, None, 1)
    assert got[3] == got[9] == ("open", "http://oa.pdf", 2)
    assert got[4] == ("probed", "https://dl.acm.org/doi/pdf/10.1/p", 2)
    assert got[5] == ("a b", "http://view/", 1) and got[8] == ("text wins", "http://twice/", 1)


def test_hot_url_is_joined_without_losing_works(spark):
    works = spark.range(3000).select(F.col("id").alias("work_id"), F.lit("http://one/").alias("url"),
                                     F.lit(None).cast("string").alias("doi"))
    resp = spark.createDataFrame([("http://one/", 200, "application/pdf", None, ["t"])], RESPONSES)
    oa = spark.createDataFrame([], "doi string, url_for_pdf string")
    out = resolve_text(works, resp, oa, spark.createDataFrame([], *NO_PROBE))
    assert out.where("text = 't'").count() == 3000


def test_names_of_a_work_in_later_files_are_linked(spark):
    dim, links, done = (shared_dir(spark, n) for n in ("dim", "links", "done"))
    one = spark.createDataFrame([(1, "A", 1), (9, None, 1)], "work_id long, name string, k long")
    two = spark.createDataFrame([(1, "B", 2), (2, "B", 2), (1, "A", 2)], "work_id long, name string, k long")
    for batch in (one, two, two):
        register_batch(spark, batch, dim, links, ["k", "work_id"], done_path=done)
    assert rows(spark.read.parquet(links)) == [(1, 1, 1), (2, 1, 2), (3, 2, 2)]
    assert rows(spark.read.parquet(dim)) == [(1, "A"), (2, "B")]
    assert rows(spark.read.parquet(done)) == [(1,), (2,), (9,)]


def test_unreadable_table_is_no_empty_table(spark):
    links = _local(shared_dir(spark, "broken"))
    with open(os.path.join(links, "part-0.parquet"), "wb") as f:
        f.write(b"no parquet")
    batch = spark.createDataFrame([(1, "A", 1)], "work_id long, name string, k long")
    with pytest.raises(Exception, match="(?i)parquet|footer|magic|read"):
        register_batch(spark, batch, shared_dir(spark, "dim"), links, ["k"])


def _tables(spark, **given):
    out = {t: spark.createDataFrame([], s) for t, s in TB.MODEL_SCHEMAS.items()}
    return out | given


def test_null_keys_stop_the_load(spark):
    topics = spark.createDataFrame([(None, "x"), (1, "y")], "id long, name string")
    with pytest.raises(C.ConstraintError, match="topic.pk"):
        TB.load_tables(_tables(spark), _tables(spark, topic=topics), {})


def test_first_row_of_a_file_wins(spark):
    d = _local(shared_dir(spark, "csv"))
    with open(os.path.join(d, "t.csv"), "w", newline="") as f:
        f.write("id,nombre_campo\r\n5,zebra\r\n5,apple\r\n6,x")
    root = shared_dir(spark, "load")
    topics = CT.read_model_table(spark, os.path.join(d, "t.csv"), "topic", position=True)
    TB.load_committed(spark, root, _tables(spark, topic=topics))
    assert rows(TB.committed_tables(spark, root)["topic"]) == [(5, "zebra"), (6, "x")]
    more = spark.createDataFrame([(6, "again"), (7, "new")], "id long, name string")
    TB.load_committed(spark, root, _tables(spark, topic=more))
    assert rows(TB.committed_tables(spark, root)["topic"]) == [(5, "zebra"), (6, "x"), (7, "new")]
    # A load that never committed is not seen.
    spark.createDataFrame([(8, "half")], "id long, name string").write.parquet(f"{root}/load-half/topic")
    assert TB.committed_tables(spark, root)["topic"].count() == 3


def test_values_that_do_not_parse_stop_the_read(spark):
    d = _local(shared_dir(spark, "csv"))
    with open(os.path.join(d, "w.csv"), "w") as f:
        f.write("id,direccion_fuente,titulo,abstract,fecha_publicacion,idioma,num_citas,fwci,tematica_id,doi\n"
                "1,u,t,,,,7.0,,,\n")
    with pytest.raises(ValueError, match="num_citas"):
        CT.read_model_table(spark, os.path.join(d, "w.csv"), "work")


def test_pretty_printed_pages(spark):
    d = _local(shared_dir(spark, "pages"))
    page = {"results": [{"id": "https://x.org/W1", "cited_by_count": 3}], "meta": {"count": 1}}
    with open(os.path.join(d, "p.json"), "w") as f:
        f.write(json.dumps(page, indent=2))
    assert WJ.read_pages(spark, d, multi_line=True).count() == 1
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        WJ.read_pages(spark, d).collect()


def test_csv_keeps_spaces_quotes_and_newlines(spark):
    src = spark.createDataFrame([("1", "  lead", 'say "x", y', "two\nlines "), ("2", "trail  ", None, "")],
                                "id string, nombre string, tipo string, version string")
    path = shared_dir(spark, "csv-out")
    CT.write_csv(src, path)
    back = CT.read_csv(spark, path, "technology")
    assert rows(back)[0] == ("1", "  lead", 'say "x", y', "two\nlines ")
    CT.to_parquet(spark, path, "technology", shared_dir(spark, "pq"))


def test_positions_beyond_the_packed_range(spark):
    df = spark.sql("SELECT map('a', array(1L << 40), 'b', array(1L), 'c', array(-3L, 1L)) AS m")
    assert df.select(TX.reconstruct_abstract("m")).first()[0] == "c c a"
    assert spark.sql("SELECT map('a', array(2L), 'b', array(1L)) AS m").select(
        TX.reconstruct_abstract("m")).first()[0] == "b a"


def test_html_text_pieces():
    assert parse_page("<p>x<5 and <!-- c --> more</p>")[0] == "x<5 and more"
    assert parse_page('<img class="textLayer">')[1] == ""
    assert parse_page("<ruby>base<rp>(</rp><rt>up</rt><rp>)</rp></ruby>")[0] == "base"


def test_replies_strict_and_one_row_per_work(spark):
    docs = spark.createDataFrame([(1, "t"), (2, "t"), (3, "t")], "work_id long, text string")
    replies = spark.createDataFrame([
        (1, '{"programming_languages": ["C"]} x {"programming_languages": ["D"]}'),
        (2, '{"programming_languages": ["C", 3]}'), (3, '{"programming_languages": ["B"]}'),
        (3, '{"programming_languages": ["A"]}')], "work_id long, raw string")
    assert rows(DT.detect_from_replies(docs, replies)) == [(1, []), (2, []), (3, ["A"])]


def test_vocabulary_of_long_names(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "we use Visual Basic for Applications today"), (2, "Visual Basic (Basic) only"), (3, "")],
                                 "doc_id long, text string")
    vocab = spark.createDataFrame([("Visual Basic",), ("Basic",), ("Visual Basic for Applications",)], "name string")
    want = [(1, "Visual Basic for Applications"), (2, "Basic"), (2, "Visual Basic")]
    assert rows(DT.vocabulary_mentions(docs, vocab)) == want
    monkeypatch.setattr(DT, "FIRST_TOKENS", 0)  # the exploded way
    assert rows(DT.vocabulary_mentions(docs, vocab)) == want


def test_patterns_in_any_order_and_kinds(spark):
    t = spark.createDataFrame([("a", "p", "b", "iri", None), ("b", "r", "c", "iri", None), ("c", "q", "d", "iri", None),
                               ("a2", "p", "b", "literal", None)], "s string, p string, o string, o_kind string, datatype string")
    got = G.match(t, [("?a", "p", "?b"), ("?c", "q", "?d"), ("?b", "r", "?c")])
    assert rows(got, "a", "b", "c", "d") == [("a", "b", "c", "d")]  # the literal "b" is no subject
    assert G.ids_unique(spark.createDataFrame([(1,), (2,)], "id long"))
    assert G.distinct_triples(t, t).count() == 4


def test_plain_doubles(spark):
    values = [0.0004, 12345678.0, 1.5, 0.0, -2.5e7, 1e15, 1e16, 1.25e-05, -3e-09, 123456789.125, 1e300, 100.0, 2e-4, 1e22]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(G.plain_double(F.col("v"))).collect()] == [repr(v) for v in values]


def test_hub_subject_is_written_as_several_blocks(spark):
    t = spark.range(500).select(F.lit("http://x/hub").alias("s"), F.lit(G.SKOS_NARROWER).alias("p"),
                                F.concat(F.lit("http://x/"), F.col("id").cast("string")).alias("o"),
                                F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("datatype"))
    blocks = rdf.turtle_blocks(t, block_triples=100).collect()
    assert 3 <= len(blocks) <= 5
    assert sum(b["block"].count("skos:narrower") for b in blocks) == 500
    path = shared_dir(spark, "ttl")
    rdf.write_turtle(t, path, files=2)
    assert spark.read.text(path).where(F.col("value").contains("narrower")).count() > 0


def test_aliases(spark):
    tech = spark.createDataFrame([(1, "Java Script"), (2, "java-script"), (3, "JAVA_SCRIPT"), (4, "C"), (5, None)],
                                 "id long, name string")
    uses = spark.createDataFrame([("java-script", 9), ("Java Script", 2)], "name string, n_uses long")
    al = AL.propose_aliases(tech, uses)
    assert rows(al, "variant", "canonical") == [("JAVA_SCRIPT", "java-script"), ("Java Script", "java-script")]
    assert rows(AL.apply_aliases(tech.where("name is not null"), al)) == [
        (1, "java-script"), (2, "java-script"), (3, "java-script"), (4, "C")]
    derived = spark.createDataFrame([(1, 2), (2, 3), (4, 40), (40, 400), (400, 4)], "derived_id long, base_id long")
    links = spark.createDataFrame([(7, 1), (7, 2), (7, 3), (8, 4)], "work_id long, technology_id long")
    kept, new = AL.replace_derived(tech, links, derived)
    assert rows(new) == [(7, 3), (8, 4)] and [r[0] for r in rows(kept, "id")] == [3, 4, 5]
    yes, no = AL.split_by_list(tech, spark.createDataFrame([("JAVA script",)], "name string"))
    assert [r[0] for r in rows(yes, "id")] == [1, 2, 3] and [r[0] for r in rows(no, "id")] == [4, 5]


def test_small_helpers(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id long, n int")
    assert rows(C.default_zero(df, "n")) == [(1, 0), (2, 5)]
    assert rows(dense_ids_after(df.select("n"), [F.col("n").asc_nulls_first()], df), "id") == [(3,), (4,)]
    nulls = C.null_violations(df.join(spark.createDataFrame([(1, "a")], "id long, t string"), "id", "left"), ["n", "t"])
    assert rows(nulls) == [("n", 1), ("t", 2)]
    ST.register_views(spark, "/root/testdata/sf0.001", ["nation"])
    assert spark.sql("SELECT count(*) FROM nation").first()[0] == 25


def test_only_repeated_and_stored_keys_are_grouped(spark):
    stored = spark.createDataFrame([(1, "old"), (None, "old")], "id long, name string")
    new = [(1, "x"), (2, "y"), (3, "b"), (3, "a"), (None, "q"), (None, "p"), (4, None)]
    for rows_in in (new, new[1:2] + new[-1:], new[-3:-1], []):
        incoming = spark.createDataFrame(rows_in, "id long, name string")
        want, got = TB.insert_ignore(stored, incoming), TB._additions(stored, incoming)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_refused_load_leaves_no_folder(spark):
    root = shared_dir(spark, "load")
    TB.load_committed(spark, root, _tables(spark, topic=spark.createDataFrame([(1, "a")], "id long, name string")))
    bad = spark.createDataFrame([(2, None), (3, "c")], "id long, name string")
    with pytest.raises(C.ConstraintError, match="topic.not_null"):
        TB.load_committed(spark, root, _tables(spark, topic=bad))
    assert len([d for d in os.listdir(_local(root)) if d.startswith("load-")]) == 1
    assert rows(TB.committed_tables(spark, root)["topic"]) == [(1, "a")]
