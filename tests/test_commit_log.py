import pytest

from techmine.streaming import commit_log as CL


def batch(spark, rows):
    return spark.createDataFrame(rows, "work_id long, name string, seen int")


FIRST = [(1, "Java", 1), (1, "Go", 1), (2, "Java", 2), (3, None, 3)]
SECOND = [(2, "Java", 1), (2, "Lisp", 1), (4, "Ada", 2)]


def tables(spark, root):
    log = CL.CommitLog(spark, root)
    names = {r["id"]: r["name"] for r in log.read("names").collect()}
    links = sorted((r["id"], r["work_id"], names[r["technology_id"]]) for r in log.read("links").collect())
    return names, links, sorted(r[0] for r in log.read("done").collect())


EXPECTED = ({1: "Go", 2: "Java", 3: "Lisp", 4: "Ada"},
            [(1, 1, "Go"), (2, 1, "Java"), (3, 2, "Java"), (4, 2, "Lisp"), (5, 4, "Ada")], [1, 2, 3, 4])


def commit(spark, root, name, rows):
    return CL.register_batch(spark, root, name, batch(spark, rows), ["seen", "work_id"])


def test_commits_and_replays(spark, tmp_path):
    root = str(tmp_path / "a")
    assert commit(spark, root, "x", FIRST) and commit(spark, root, "y", SECOND)
    assert not commit(spark, root, "x", FIRST) and not commit(spark, root, "y", SECOND)
    assert tables(spark, root) == EXPECTED
    assert commit(spark, root, "z", FIRST)  # another batch with the same rows adds nothing
    assert tables(spark, root) == EXPECTED
    assert [(e["seq"], e["first_name"], e["n_names"], e["first_link"], e["n_links"])
            for e in CL.CommitLog(spark, root).entries()] == [(0, 1, 2, 1, 3), (1, 3, 2, 4, 2), (2, 5, 0, 6, 0)]


@pytest.mark.parametrize("at", ["names", "links", "done", "log"])
def test_crash_between_writes(spark, tmp_path, monkeypatch, at):
    root = str(tmp_path / "b")
    commit(spark, root, "x", FIRST)
    write, append = CL._write, CL.CommitLog.append

    def stops(df, path):
        write(df, path)
        if path.endswith(at):
            raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(CL, "_write", stops)
        if at == "log":  # stops before the entry is in place
            m.setattr(CL.CommitLog, "append", lambda self, entry: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            commit(spark, root, "y", SECOND)
    assert CL.CommitLog.append is append and len(CL.CommitLog(spark, root).entries()) == 1
    assert commit(spark, root, "y", SECOND)
    assert tables(spark, root) == EXPECTED


def test_two_runs_at_once(spark, tmp_path, monkeypatch):
    """A second run commits while the first one is about to."""
    root = str(tmp_path / "c")
    append, turns = CL.CommitLog.append, []

    def late(self, entry):
        turns.append(entry["batch"])
        if turns == ["y"]:
            assert commit(spark, root, "x", FIRST)
        return append(self, entry)

    monkeypatch.setattr(CL.CommitLog, "append", late)
    assert commit(spark, root, "y", SECOND)
    assert turns == ["y", "x", "y"]
    assert tables(spark, root) == EXPECTED
    # Two runs of the same batch: the second one finds it done.
    turns.clear()

    def twice(self, entry):
        turns.append(entry["seq"])
        if len(turns) == 1:
            assert commit(spark, root, "w", [(9, "R", 1)])
        return append(self, entry)

    monkeypatch.setattr(CL.CommitLog, "append", twice)
    assert not commit(spark, root, "w", [(9, "R", 1)])
    names, links, done = tables(spark, root)
    assert names[5] == "R" and links[-1] == (6, 9, "R") and done == [1, 2, 3, 4, 9]


def test_empty_log_and_batch(spark, tmp_path):
    root = str(tmp_path / "d")
    assert CL.CommitLog(spark, root).entries() == [] and CL.CommitLog(spark, root).read("names").count() == 0
    assert commit(spark, root, "none", [])
    assert tables(spark, root) == ({}, [], [])
