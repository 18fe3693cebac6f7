import pytest

# Columns that clash with names the operators use themselves.
CLASH = ("id", "n", "key", "a", "b", "spans", "kept", "host", "wrapper", "sequence_id", "fingerprint", "n_words")


def frame(spark, rows):
    """documents with (doc_id, text, source) and clashing extra columns."""
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASH)
    return spark.createDataFrame([(*r, *["clash"] * len(CLASH)) for r in rows], schema)


@pytest.fixture(scope="session")
def documents():
    return frame


LONG = " ".join(f"w{k % 977}x{k % 13}" for k in range(30000))
EDGE = [(1, None, "s"), (2, "", "s"), (3, "   \n\t ", None), (4, "One", "s"), (5, LONG, "s"), (6, LONG.upper(), "t"),
        (7, LONG + " tail", "t"), (8, "one", "t"), (9, "Ünï ñ 日本語 🙂 ok", "t"), (None, "no id", "s"), (11, None, None),
        (4, "One", "s"), (4, "One", "s")]


@pytest.fixture(scope="session")
def edge(spark):
    return frame(spark, EDGE)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
