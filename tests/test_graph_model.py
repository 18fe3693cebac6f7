import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from techmine.operators import constraints as C
from techmine.operators import dimensions as D
from techmine.operators import graph as G
from techmine.operators import hierarchy as H
from techmine.operators.resolve import resolve_text
from techmine.session import shared_dir
from techmine.sinks import tables as T
from techmine.sinks.rdf import ntriples_lines, turtle_text, write_ntriples
from techmine.sources.rdf import parse_ntriples, read_ntriples

# Folder holding the three cached CSV tables (topics, topic edges,
# technologies) used for the golden counts; the test is skipped without it.
GOLDEN_DIR = os.environ.get("TECHMINE_GOLDEN_CSV_DIR", "")


def _work(spark, rows_):
    return spark.createDataFrame(rows_, "id long, doi string, source_url string, title string, abstract string, "
                                        "published string, language string, citations long, fwci double, "
                                        "topic_id long")


def test_work_triples_truthiness(spark):
    w = _work(spark, [(0, "", "u", None, "", "2020-01-01", "en", 0, None, 0),
                      (5, "d", "u", "t", "a", None, None, None, 1.5, 3)])
    got = rows(G.work_triples(w), "s", "p", "o")
    preds0 = sorted(p for s, p, o in got if s.endswith("obra_0"))
    assert preds0 == sorted([G.RDF_TYPE, G.SCHEMA + "url", G.SCHEMA + "datePublished",
                             G.SCHEMA + "inLanguage", G.SCHEMA + "citationCount"])
    nb = rows(G.work_triples(w, "notebook"), "s", "p")
    assert (G.OPENALEX + "obra_0", G.SCHEMA + "citationCount") not in nb
    assert (G.OPENALEX + "obra_5", G.SCHEMA + "sameAs") in nb


def test_mentions_dedupe_and_zero_ids(spark):
    m = spark.createDataFrame([(1, 2), (1, 2), (0, 2), (1, 0)], "work_id long, technology_id long")
    assert G.graph(mention=m).count() == 1


def test_literal_roundtrip(spark):
    t = spark.createDataFrame(
        [("http://x/s", "http://x/p", 'a "q" \\ back\nnew\tTab\r é ✓ \\n', "literal", None),
         ("http://x/s", "http://x/p2", "http://x/o", "iri", None),
         ("http://x/s", "http://x/p3", "12", "literal", G.XSD_INTEGER)],
        "s string, p string, o string, o_kind string, datatype string")
    back = parse_ntriples(ntriples_lines(t))
    assert rows(back) == rows(t)
    path = shared_dir(spark, "nt-test")
    write_ntriples(t, path)
    assert rows(read_ntriples(spark, path)) == rows(t)


def test_turtle_has_prefixes_per_file(spark):
    topic = spark.createDataFrame([(1, "A, \"b\""), (2, "C")], "id long, name string")
    edge = spark.createDataFrame([(1, 1, 2)], "id long, parent_id long, child_id long")
    g = G.graph(topic=topic, edge=edge)
    path = shared_dir(spark, "ttl-test")
    turtle_text(g, files=3).write.mode("overwrite").text(path)
    local = path[len("file:"):] if path.startswith("file:") else path
    parts = [os.path.join(local, f) for f in os.listdir(local) if f.startswith("part-")]
    blocks = 0
    for p in parts:
        body = open(p, encoding="utf-8").read()
        if "openalex:tematica_" in body:
            assert body.startswith("@prefix")
            blocks += body.count(" .\n") - body.count("@prefix")
    assert blocks == 2


def test_match_optional_filter(spark):
    t = G.graph(topic=spark.createDataFrame([(1, "AI"), (2, "")], "id long, name string"),
                work=_work(spark, [(10, None, "u", "t", None, None, None, 1, 1.0, 1),
                                   (11, None, "u", "t", None, None, None, 1, 1.0, 2)]))
    b = G.match(t, [("?w", G.SCHEMA + "about", "?topic")],
                optional=[[("?topic", G.SKOS_PREF_LABEL, "?label")]])
    assert rows(b, "w", "label") == [(G.OPENALEX + "obra_10", "AI"), (G.OPENALEX + "obra_11", None)]
    with pytest.raises(ValueError):
        G.match(t, [("?a", G.RDF_TYPE, "?b"), ("?c", G.RDF_TYPE, "?d")])


def test_hierarchy_build_and_closure(spark):
    topic = spark.createDataFrame([(1, "X"), (2, " Computer Science "), (3, "Y"), (4, "Y")],
                                  "id long, name string")
    t = H.ensure_base_topics(topic)
    assert rows(t) == [(1, "X"), (2, " Computer Science "), (3, "Y"), (4, "Y"),
                       (5, "Physical Sciences"), (6, "Artificial Intelligence")]
    e = H.build_hierarchy(t)
    # base chain, then AI -> X and AI -> last id of "Y"; Computer Science keeps id 2
    assert rows(e, "parent_id", "child_id") == [(2, 6), (5, 2), (6, 1), (6, 4)]
    cl = H.closure(e)
    assert rows(cl.where("ancestor_id = 5"), "descendant_id", "depth") == [(1, 3), (2, 1), (4, 3), (6, 2)]
    assert rows(H.leaf_topics(t, e), "id") == [(1,), (3,), (4,)]


def test_closure_ends_on_cycles(spark):
    e = spark.createDataFrame([(1, 1, 2), (2, 2, 3), (3, 3, 1)], "id long, parent_id long, child_id long")
    cl = H.closure(e)
    assert cl.count() == 9
    assert rows(H.cycles(cl), "ancestor_id") == [(1,), (2,), (3,)]


def test_registration_stable_and_idempotent(spark):
    existing = spark.createDataFrame([(1, "Python"), (4, "C")], "id long, name string")
    names = spark.createDataFrame([(10, "Prolog"), (10, "C"), (11, "PROLOG"), (12, "Go"), (11, "Go")],
                                  "work_id long, name string")
    new = D.register_names(existing, names, "name", ["work_id"])
    assert rows(new) == [(5, "Prolog"), (6, "Go"), (7, "PROLOG")]
    dim = existing.unionByName(new)
    assert D.register_names(dim, names, "name", ["work_id"]).count() == 0


def test_bridge_rows_continue_ids(spark):
    dim = spark.createDataFrame([(1, "C"), (2, "R")], "id long, name string")
    wn = spark.createDataFrame([(7, "R"), (7, "C"), (3, "C"), (3, "Zig")], "work_id long, name string")
    links = spark.createDataFrame([(40, 1, 1)], "id long, work_id long, technology_id long")
    assert rows(D.bridge_rows(wn, dim, links)) == [(41, 3, 1), (42, 7, 1), (43, 7, 2)]


def test_insert_ignore_and_violations(spark):
    stored = spark.createDataFrame([(1, "a")], "id long, doi string")
    inc = spark.createDataFrame([(1, "z", 0), (2, "b", 2), (2, "c", 1), (3, "b", 3)], "id long, doi string, pos int")
    added = T.insert_ignore(stored, inc, "id", ["pos"])
    assert rows(added) == [(2, "c", 1), (3, "b", 3)]
    after = stored.unionByName(added.select("id", "doi"))
    assert rows(C.unique_violations(after, "doi")) == []
    dup = after.unionByName(spark.createDataFrame([(4, "b")], "id long, doi string"))
    assert rows(C.unique_violations(dup, "doi")) == [("b", 2)]


def test_delete_actions(spark):
    work = spark.createDataFrame([(1, 10), (2, 11)], "id long, topic_id long")
    mention = spark.createDataFrame([(1, 1, 5), (2, 2, 6)], "id long, work_id long, technology_id long")
    edge = spark.createDataFrame([(1, 10, 11)], "id long, parent_id long, child_id long")
    gone_work = spark.createDataFrame([(1,)], "id long")
    assert rows(C.delete_cascade(mention, "work_id", gone_work)) == [(2, 2, 6)]
    gone_topic = spark.createDataFrame([(10,)], "id long")
    assert rows(C.delete_set_null(work, "topic_id", gone_topic)) == [(1, None), (2, 11)]
    assert C.delete_cascade(edge, "parent_id", gone_topic).count() == 0
    with pytest.raises(C.ConstraintError):
        C.delete_restrict(mention, "technology_id", spark.createDataFrame([(5,)], "id long"))
    C.delete_restrict(mention, "technology_id", spark.createDataFrame([(9,)], "id long"))
    mapping = spark.createDataFrame([(10, 100)], "old_id long, new_id long")
    assert rows(C.update_keys(work, "topic_id", mapping)) == [(1, 100), (2, 11)]


def test_load_tables_checks_first(spark):
    base = shared_dir(spark, "load-test")
    paths = {t: f"{base}/{t}" for t in ["topic", "edge", "work", "technology", "mention"]}
    topic = spark.createDataFrame([(1, "A")], "id long, name string")
    edge = spark.createDataFrame([], "id long, parent_id long, child_id long")
    work = _work(spark, [(1, "d1", "u", "t", None, None, None, 0, 0.0, 1)])
    tech = spark.createDataFrame([(1, "C", None, None)], "id long, name string, kind string, version string")
    mention = spark.createDataFrame([(1, 1, 1)], "id long, work_id long, technology_id long")
    empty = {t: df.limit(0) for t, df in zip(paths, [topic, edge, work, tech, mention])}
    incoming = dict(zip(paths, [topic, edge, work, tech, mention]))
    bad = dict(incoming, mention=spark.createDataFrame([(1, 1, 9)], "id long, work_id long, technology_id long"))
    with pytest.raises(C.ConstraintError):
        T.load_tables(empty, bad, paths)
    loc = {t: (p[5:] if p.startswith("file:") else p) for t, p in paths.items()}
    assert not any(os.path.exists(p) and os.listdir(p) for p in loc.values())
    T.load_tables(empty, incoming, paths)
    assert spark.read.parquet(paths["mention"]).count() == 1


def test_resolve_rules(spark):
    R = "url string, status int, content_type string, body_text string, page_texts array<string>"
    responses = spark.createDataFrame([
        ("http://a/1", 200, "application/pdf", None, ["  ", ""]),          # blank pdf -> fallback
        ("http://oa/1.pdf", 200, "application/pdf", None, ["Page one", "two "]),
        ("http://a/2", 200, "text/html", '<a href="x.pdf">x</a>', None),   # follow link
        ("http://a/x.pdf", 500, "application/pdf", None, ["Linked"]),      # status not tested
        ("http://a/3", 200, "text/html", "<p>Error 404 not here</p>", None),
        ("http://a/4", 200, "text/html", '<a href="4">self</a><a href="/4.pdf">p</a>', None),
        ("http://a/4.pdf", 200, "text/html", '<a href="/4.pdf">loop</a>', None),
        ("http://a/5", 200, "text/html", "<span>viewer</span>", None),
    ], R)
    works = spark.createDataFrame([(1, "http://a/1", "d1"), (2, "http://a/2", "d2"), (3, "http://a/3", "d3"),
                                   (4, "http://a/4", ""), (5, "http://a/5", "d5"), (6, "", "d1"),
                                   (7, "http://oa/1.pdf", "d1"), (8, "http://a/3", "d8")],
                                  "work_id long, url string, doi string")
    oa = spark.createDataFrame([("d1", "http://oa/1.pdf"), ("d3", "http://a/3")], "doi string, url_for_pdf string")
    probe = spark.createDataFrame([("https://dl.acm.org/doi/pdf/d8", 200, "application/pdf")],
                                  "url string, status int, content_type string")
    got = {r["work_id"]: (r["text"], r["final_url"], r["hops"])
           for r in resolve_text(works, responses, oa, probe).collect()}
    assert got[1] == ("Page one\n\ntwo", "http://oa/1.pdf", 2)
    assert got[2] == ("Linked", "http://a/x.pdf", 2)
    assert got[3][0] is None            # fallback answers the url already tried
    assert got[4][0] is None            # cyclic links end
    assert got[5] == ("viewer", "http://a/5", 1)
    assert got[6][0] is None            # no url at all
    assert got[7] == ("Page one\n\ntwo", "http://oa/1.pdf", 1)
    assert got[8][1] is None and got[8][2] == 2   # probed publisher url has no response


@pytest.mark.skipif(not os.path.isdir(GOLDEN_DIR), reason="TECHMINE_GOLDEN_CSV_DIR not set")
def test_golden_cache_facts(spark):
    from techmine.sources.csv_tables import read_model_table
    topic = read_model_table(spark, f"{GOLDEN_DIR}/tematica.csv", "topic")
    edge = read_model_table(spark, f"{GOLDEN_DIR}/tematica_contenida.csv", "topic_edge")
    tech = read_model_table(spark, f"{GOLDEN_DIR}/tecnologia.csv", "technology")
    assert topic.count() == 76 and edge.count() == 75 and tech.count() == 538
    assert rows(topic.agg(F.min("id"), F.max("id"))) == [(1, 76)]
    assert C.pk_violations(tech).count() == 0
    assert C.check_violations(edge).count() == 0 and C.fk_violations(edge, "child_id", topic).count() == 0
    assert G.graph(topic=topic, edge=edge, technology=tech).count() == 1378
    cl = H.closure(edge)
    assert cl.count() == 222
    per = {a: n for a, n in rows(cl.groupBy("ancestor_id").count())}
    assert (per[74], per[75], per[76]) == (75, 74, 73)
    rebuilt = H.build_hierarchy(H.ensure_base_topics(topic)).select("parent_id", "child_id")
    assert rows(rebuilt) == rows(edge.select("parent_id", "child_id"))
    assert tech.select(F.lower("name")).distinct().count() == 512


def test_repeated_ids_still_give_a_set(spark):
    topic = spark.createDataFrame([(1, "A"), (1, "A"), (1, "B"), (2, "C")], "id long, name string")
    tech = spark.createDataFrame([(1, "C", None, None)], "id long, name string, kind string, version string")
    assert G.repeated_keys({"topic": topic, "technology": tech}) == {"topic"}
    g = G.graph(topic=topic, technology=tech)
    assert g.count() == 5 + 2 and g.distinct().count() == g.count()


def test_next_id_from_damaged_lines(spark):
    from techmine.operators.ids import next_id_from_lines
    lines = spark.createDataFrame([("id,nombre",), ("3,C",), (' 12 ,"x, y"',), ("oops",), ("",)], "value string")
    assert next_id_from_lines(lines) == 13
    assert next_id_from_lines(spark.createDataFrame([("id",)], "value string")) == 1


def test_closure_deep_chain(spark):
    n = 20
    e = spark.createDataFrame([(i, i, i + 1) for i in range(1, n)], "id long, parent_id long, child_id long")
    cl = H.closure(e)
    assert cl.count() == n * (n - 1) // 2
    assert rows(cl.where("ancestor_id = 1 AND descendant_id = 20"), "depth") == [(19,)]
    assert rows(cl.where("ancestor_id = 18"), "descendant_id", "path") == [(19, [18, 19]), (20, [18, 19, 20])]


def _parse_turtle_blocks(blocks):
    """Test-side reader for the block shape we write: expands prefixed names,
    undoes literal escapes, returns (s, p, o, o_kind, datatype) tuples."""
    import re
    esc = {"\\\\": "\\", '\\"': '"', "\\n": "\n", "\\r": "\r", "\\t": "\t"}

    def term(t):
        if t.startswith("<"):
            return t[1:-1]
        pfx, local = t.split(":", 1)
        return G.PREFIXES[pfx] + local

    out = set()
    for b in blocks:
        assert b.endswith(" .")
        subj, rest = b[:-2].split(" ", 1)
        for po in rest.split(" ;\n    "):
            pred, obj = po.split(" ", 1)
            p = G.RDF_TYPE if pred == "a" else term(pred)
            m = re.fullmatch(r'"((?:[^"\\]|\\.)*)"(?:\^\^(\S+))?', obj, re.S)
            if m:
                lex = re.sub(r"\\.", lambda x: esc[x.group(0)], m.group(1))
                out.add((term(subj), p, lex, "literal", term(m.group(2)) if m.group(2) else None))
            else:
                out.add((term(subj), p, term(obj), "iri", None))
    return out


def test_turtle_blocks_read_back_as_the_same_triples(spark):
    from techmine.sinks.rdf import turtle_blocks
    topic = spark.createDataFrame([(1, 'A "quoted"\tname\\x'), (2, "B")], "id long, name string")
    edge = spark.createDataFrame([(1, 1, 2)], "id long, parent_id long, child_id long")
    work = _work(spark, [(7, "10.1/x", "http://u/a b", "T\nT", None, "2020-01-02", "en", 3, 1.5, 1)])
    mention = spark.createDataFrame([(7, 9), (7, 9)], "work_id long, technology_id long")
    g = G.graph(topic=topic, edge=edge, work=work, mention=mention)
    blocks = [r["block"] for r in turtle_blocks(g).collect()]
    assert _parse_turtle_blocks(blocks) == set(rows(g))


def test_compressed_ntriples_read_back_as_the_same_triples(spark, tmp_path):
    work = spark.range(2000).select("id", F.concat(F.lit("x"), "id").alias("doi"), F.lit(None).cast("string").alias("source_url"),
                                    F.lit('a "quote"\n').alias("title"), F.lit("").alias("abstract"),
                                    F.lit("2001-02-03").alias("published"), F.lit("en").alias("language"),
                                    F.lit(3).cast("long").alias("citations"), F.lit(1.5).alias("fwci"),
                                    F.lit(4).cast("long").alias("topic_id"))
    g = G.graph(work=work)
    sizes = {}
    for kind in ("none", "gzip"):
        path = tmp_path / kind
        write_ntriples(g, str(path), compression=kind)
        sizes[kind] = sum(f.stat().st_size for f in path.glob("part-*"))
        assert rows(read_ntriples(spark, str(path)).fillna("")) == rows(g.fillna(""))
    assert sizes["gzip"] * 4 < sizes["none"]
