"""QRY1 and QRY2 kept up to date by drops."""

import random

import pytest

from techmine.operators.constraints import ConstraintError
from techmine.plans import reports
from techmine.session import shared_dir
from techmine.streaming import kept_reports as K

TOPICS = [(1, "Logic"), (2, "Graphs"), (3, "Graphs"), (4, "")]
TECHS = [(k, n) for k, n in enumerate(["Java", "Java", "C", "Go", "Rust", "", "Lua"], 1)]


def tables(spark, works, links):
    return (spark.createDataFrame(works, "id long, topic_id long"),
            spark.createDataFrame(links, "work_id long, technology_id long"))


@pytest.fixture(scope="module")
def dimensions(spark):
    return (spark.createDataFrame(TOPICS, "id long, name string"), spark.createDataFrame(TECHS, "id long, name string"))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def same_as_full(spark, root, works, links, dimensions):
    topic, technology = dimensions
    work, mention = tables(spark, works, links)
    assert rows(K.kept_topic_tech_counts(spark, root)) == rows(reports.topic_tech_counts(work, mention, topic, technology))
    assert rows(K.kept_tech_pairs(spark, root)) == rows(reports.tech_pairs_shared_topics(work, mention, technology))


def test_after_each_drop_the_results_equal_the_full_queries(spark, dimensions):
    """Works before and after their links, links that come again, works without a topic."""
    rnd = random.Random(5)
    far = K.WORK_BLOCK * 3
    drops = []
    for first in (0, far, 0):
        ids = [first + k for k in range(len(drops) * 20, len(drops) * 20 + 12)]
        late = [first + k for k in range(12, 16)] if drops else []
        works = [(w, rnd.choice([1, 2, 3, 4, None])) for w in ids + late]
        links = [(rnd.choice([*ids, *range(16), *range(20, 24)]), rnd.randint(1, 7)) for _ in range(25)]
        drops.append((works, links + links[:3]))
    root = shared_dir(spark, "kept")
    all_works, all_links = {}, []
    for k, (works, links) in enumerate(drops):
        for w, t in works:
            all_works.setdefault(w, t)
        all_links += links
        assert K.land(spark, root, f"drop {k}", *tables(spark, works, links), *dimensions)
        same_as_full(spark, root, list(all_works.items()), all_links, dimensions)
    # A drop that is done is not done again.
    assert not K.land(spark, root, "drop 1", *tables(spark, *drops[1]), *dimensions)
    # The same rows under another name change nothing; an empty drop neither.
    assert K.land(spark, root, "again", *tables(spark, *drops[0]), *dimensions)
    assert K.land(spark, root, "empty", *tables(spark, [], []), *dimensions)
    same_as_full(spark, root, list(all_works.items()), all_links, dimensions)


def test_two_names_of_one_technology_become_a_pair_by_a_second_technology(spark, dimensions):
    """One technology under a name is no pair with itself; a second one of that name is."""
    root = shared_dir(spark, "kept")
    K.land(spark, root, "a", *tables(spark, [(1, 1)], [(1, 1), (1, 3)]), *dimensions)
    assert rows(K.kept_tech_pairs(spark, root)) == [("C", "Java", 1), ("Java", "C", 1)]
    K.land(spark, root, "b", *tables(spark, [(2, 1)], [(2, 2)]), *dimensions)
    assert rows(K.kept_tech_pairs(spark, root)) == [("C", "Java", 1), ("Java", "C", 1), ("Java", "Java", 1)]


def test_old_mentions_are_read_in_touched_blocks_only(spark, dimensions):
    root = shared_dir(spark, "kept")
    far = K.WORK_BLOCK * 5
    K.land(spark, root, "a", *tables(spark, [(1, 1), (far, 2)], [(1, 1), (far, 3)]), *dimensions)
    log = K.CommitLog(spark, root)
    own = spark.createDataFrame([(far + 1,)], "work_id long")
    read = K._stored_part(log, "links", log.entries(), K._touched_blocks(own))
    assert rows(read) == [(far, 3, "C")]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block" in plan and "block" in plan


def test_a_drop_that_lost_the_race_starts_over(spark, dimensions, monkeypatch):
    root = shared_dir(spark, "kept")
    real, other = K.CommitLog.append, []

    def append(log, entry):
        if not other:
            other.append(1)
            assert K.land(spark, root, "other", *tables(spark, [(1, 1)], [(1, 1), (1, 3)]), *dimensions)
        return real(log, entry)

    monkeypatch.setattr(K.CommitLog, "append", append)
    assert K.land(spark, root, "mine", *tables(spark, [(1, 1), (2, 1)], [(1, 1), (2, 4)]), *dimensions)
    same_as_full(spark, root, [(1, 1), (2, 1)], [(1, 1), (1, 3), (2, 4)], dimensions)


def test_links_without_their_technology_or_topic_are_refused(spark, dimensions):
    root = shared_dir(spark, "kept")
    with pytest.raises(ConstraintError):
        K.land(spark, root, "a", *tables(spark, [(1, 1)], [(1, 99)]), *dimensions)
    with pytest.raises(ConstraintError):
        K.land(spark, root, "a", *tables(spark, [(1, 99)], []), *dimensions)
    assert rows(K.kept_topic_tech_counts(spark, root)) == []
