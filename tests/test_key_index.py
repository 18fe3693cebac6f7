"""SNK4 with a key index: same verdicts as the full report, touched blocks only."""

import pytest

from techmine.operators import constraints as C
from techmine.session import shared_dir
from techmine.sinks import key_index as K
from techmine.sinks import tables as TB


def tables(spark, **rows):
    return {t: spark.createDataFrame(rows.get(t, []), s) for t, s in TB.MODEL_SCHEMAS.items()}


def work(i, doi=None, topic=1, title="t"):
    given = {"id": i, "doi": doi, "source_url": f"u{i}", "title": title, "topic_id": topic}
    return tuple(given.get(f) for f in TB.MODEL_SCHEMAS["work"].fieldNames())


FIRST = {"topic": [(1, "a"), (2, "b")], "edge": [(1, 1, 2)], "technology": [(1, "T", None, None)],
         "work": [work(1, "d1"), work(2, "d2", 2), work(3 << 20, None)], "mention": [(1, 1, 1), (2, 2, 1)]}
LOADS = {
    "again": FIRST,
    "new rows": {"work": [work(7, "d7"), work(8, None, None)], "mention": [(3, 7, 1), (4, 3 << 20, 1), (1, 99, 99)]},
    "doi twice within": {"work": [work(7, "d"), work(8, "d"), work(9, "d"), work(10, "e"), work(11, "e")]},
    "doi stored": {"work": [work(7, "d1"), work(8, "d2")]},
    "no parent": {"mention": [(5, 5, 1), (6, 1, 5), (7, 9, 9)], "edge": [(2, 1, 7)], "work": [work(9, "d9", 5)]},
    "self edge": {"edge": [(2, 2, 2), (3, 1, 1)]},
    "null values": {"topic": [(3, None)], "work": [work(9, "d9", 1, None)]},
    "parent in the same load": {"topic": [(5, "e")], "work": [work(9, "d9", 5)], "edge": [(9, 5, 1)]},
}


@pytest.fixture(scope="module")
def root(spark):
    path = shared_dir(spark, "indexed")
    K.load_indexed(spark, path, tables(spark, **FIRST))
    return path


@pytest.mark.parametrize("name", LOADS)
def test_report_equals_the_report_over_all_rows(spark, root, name):
    stored = K.indexed_tables(spark, root)
    incoming = tables(spark, **LOADS[name])
    added = {t: TB.insert_ignore(stored[t], incoming[t]) for t in TB.MODEL_SCHEMAS}
    want = TB.model_report(**{t: stored[t].unionByName(added[t]) for t in TB.MODEL_SCHEMAS}).collect()
    firsts = {t: TB.first_rows(df) for t, df in incoming.items()}
    known = K.known_keys(K.stored_keys(spark, root), K._asked_keys(firsts))
    got = K.additions_report(added, known).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == len({r["check"] for r in got})
    broken = sum(r["n"] for r in want)
    assert (broken == 0) == (name in ("again", "new rows", "parent in the same load"))
    if broken:
        with pytest.raises(C.ConstraintError):
            K.load_indexed(spark, root, incoming)


def test_loads_add_what_the_plain_load_adds(spark):
    path, plain = shared_dir(spark, "indexed"), shared_dir(spark, "plain")
    for name in ("again", "new rows", "again", "parent in the same load"):
        K.load_indexed(spark, path, tables(spark, **LOADS[name]))
        TB.load_committed(spark, plain, tables(spark, **LOADS[name]))
    a, b = K.indexed_tables(spark, path), TB.committed_tables(spark, plain)
    for t in TB.MODEL_SCHEMAS:
        assert sorted(map(str, a[t].collect())) == sorted(map(str, b[t].collect()))
    keys = [(r["kind"], r["k"]) for r in K.stored_keys(spark, path).collect()]
    assert len(keys) == len(set(keys)) == len(K.own_keys(a).collect())


def test_null_keys_are_refused(spark, root):
    bad = tables(spark) | {"topic": spark.createDataFrame([(None, "x"), (None, "y"), (9, "z")], "id long, name string")}
    with pytest.raises(C.ConstraintError, match="topic.pk"):
        K.load_indexed(spark, root, bad)


def test_only_touched_blocks_are_read(spark, root):
    asked = K._asked_keys(tables(spark, mention=[(9, 3 << 20, 1)]))
    known = K.known_keys(K.stored_keys(spark, root), asked)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "'work.id'" not in plan.split("PartitionFilters")[0]
    read = K.stored_keys(spark, root).where(K._in_blocks(asked))
    assert {(r["kind"], r["block"]) for r in read.select("kind", "block").collect()} == {
        ("work.id", 3), ("technology.id", 0), ("mention.id", 0)}
    assert sorted(map(tuple, known.collect())) == [("technology.id", "1"), ("work.id", str(3 << 20))]


def test_many_blocks_read_the_whole_index(spark, root, monkeypatch):
    asked = K._asked_keys(tables(spark, mention=[(9, 3 << 20, 1), (10, 1, 1)]))
    want = sorted(map(tuple, K.known_keys(K.stored_keys(spark, root), asked).collect()))
    monkeypatch.setattr(K, "LISTED_BLOCKS", 1)
    assert sorted(map(tuple, K.known_keys(K.stored_keys(spark, root), asked).collect())) == want


def test_of_two_loads_at_once_one_is_refused(spark, monkeypatch):
    path = shared_dir(spark, "indexed")
    K.load_indexed(spark, path, tables(spark, **FIRST))
    report = K.additions_report

    def other_first(added, known):
        monkeypatch.setattr(K, "additions_report", report)
        K.load_indexed(spark, path, tables(spark, topic=[(50, "other")]))
        return report(added, known)

    monkeypatch.setattr(K, "additions_report", other_first)
    with pytest.raises(C.ConstraintError, match="meanwhile"):
        K.load_indexed(spark, path, tables(spark, topic=[(50, "mine"), (51, "mine")]))
    assert sorted((r["id"], r["name"]) for r in K.indexed_tables(spark, path)["topic"].collect()) == [
        (1, "a"), (2, "b"), (50, "other")]
