import json

import pytest

from techmine.operators import constraints as C
from techmine.schemas import TOPIC
from techmine.sinks.tables import commit_state, current_state
from techmine.sources import works_json as WJ
from tests.conftest import rows


def model(spark):
    make = spark.createDataFrame
    return {"topic": make([(1, "a"), (2, "b"), (3, "c")], "id long, name string"),
            "edge": make([(1, 1, 2), (2, 2, 3), (3, 1, 3)], "id long, parent_id long, child_id long"),
            "work": make([(1, 1), (2, 2), (3, None)], "id long, topic_id long"),
            "technology": make([(1, "x"), (2, "y")], "id long, name string"),
            "mention": make([(1, 1, 1), (2, 1, 2), (2, 2, 2), (4, 3, 2)], "id long, work_id long, technology_id long")}


def keys(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def test_actions_over_the_five_tables(spark):
    left = C.delete_through(model(spark), {"topic": keys(spark, 2, 9), "work": keys(spark, 1)})
    assert rows(left["topic"]) == [(1, "a"), (3, "c")] and rows(left["edge"]) == [(3, 1, 3)]
    assert rows(left["work"].fillna(-1)) == [(2, -1), (3, -1)]
    # The mention keys repeat: only the row of work 1 goes.
    assert rows(left["mention"]) == [(2, 2, 2), (4, 3, 2)] and left["technology"].count() == 2


def test_restrict_refuses_unless_the_rows_go_too(spark):
    with pytest.raises(C.ConstraintError):
        C.delete_through(model(spark), {"technology": keys(spark, 1)})
    left = C.delete_through(model(spark), {"technology": keys(spark, 1), "work": keys(spark, 1)})
    assert rows(left["technology"]) == [(2, "y")]
    nothing = C.delete_through(model(spark), {"work": keys(spark)})
    assert {t: df.count() for t, df in nothing.items()} == {t: df.count() for t, df in model(spark).items()}


def test_cascade_within_a_table_and_around_a_cycle(spark):
    t = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, 7), (6, 5), (7, 6), (8, None)], "id long, up long")
    refs = (("t", "up", "t", "cascade"),)
    assert rows(C.delete_through({"t": t}, {"t": keys(spark, 2)}, refs)["t"], "id") == [(1,), (5,), (6,), (7,), (8,)]
    assert rows(C.delete_through({"t": t}, {"t": keys(spark, 5)}, refs)["t"], "id") == [(1,), (2,), (3,), (4,), (8,)]


def test_states_are_committed_as_a_whole(spark, tmp_path, monkeypatch):
    from techmine.streaming.commit_log import CommitLog
    root, s = str(tmp_path / "s"), {"topic": TOPIC}
    make = lambda *r: {"topic": spark.createDataFrame(list(r), TOPIC)}
    assert current_state(spark, root, s)["topic"].count() == 0
    commit_state(spark, root, make((1, "a")))
    commit_state(spark, root, make((2, "b"), (3, "c")))
    assert rows(current_state(spark, root, s)["topic"]) == [(2, "b"), (3, "c")]
    append = CommitLog.append

    def late(self, entry):  # another writer is faster
        monkeypatch.setattr(CommitLog, "append", append)
        commit_state(spark, root, make((9, "z")))
        return append(self, entry)

    monkeypatch.setattr(CommitLog, "append", late)
    with pytest.raises(C.ConstraintError):
        commit_state(spark, root, make((4, "d")))
    assert rows(current_state(spark, root, s)["topic"]) == [(9, "z")]


def test_bad_pages_are_set_aside(spark, tmp_path):
    page = lambda *ids: json.dumps({"results": [{"id": i} for i in ids], "meta": {"count": 9}})
    (tmp_path / "a.json").write_text(page("W1", "W2") + "\n" + page("W3")[:-4] + "\n" + page("W4") + "\n")
    (tmp_path / "b.json").write_text("<html>busy</html>\n{\"meta\": {\"count\": 0}}\n" + page("W5") + "\n")
    records, bad = WJ.read_pages_kept(spark, str(tmp_path))
    assert rows(records, "id") == [("W1",), ("W2",), ("W4",), ("W5",)]
    found = {(r["file"].rsplit("/", 1)[-1], r["page"]) for r in bad.collect()}
    assert found == {("a.json", page("W3")[:-4]), ("b.json", "<html>busy</html>")}
    (tmp_path / "whole").mkdir()
    (tmp_path / "whole" / "c.json").write_text(json.dumps(json.loads(page("W6")), indent=2))
    (tmp_path / "whole" / "d.json").write_text("{\n\"results\": [")
    records, bad = WJ.read_pages_kept(spark, str(tmp_path / "whole"), multi_line=True)
    assert rows(records, "id") == [("W6",)] and [r["file"][-6:] for r in bad.collect()] == ["d.json"]
