import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_rows():
    """Nulls, empty and long texts, ties, repeated rows, copies, near copies, shared passages."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    base, passage, long = text(120), text(40), text(9000)
    rows = [(1, base), (2, base), (3, base.replace(" ", "\n")), (4, base + " "), (5, base.replace("w1", "v1", 1)), (6, " ".join(base.split()[:110]) + " end")]
    rows += [(7, None), (8, ""), (9, " \t\n"), (10, "one"), (11, "one"), (12, "a b c d e"), (13, " ".join(["rep"] * 60)), (14, long), (15, long[: len(long) // 2])]
    rows += [(16, text(30) + " " + passage + " " + text(30)), (17, passage), (18, text(5) + "\n" + passage), (None, base), (None, passage + " x"), (19, base), (19, base), (19, text(50))]
    rows += [(20 + i, text(r.randint(1, 80))) for i in range(40)]
    rows += [(100, "é ü  nbsp " + text(20)), (101, "😀 " * 30), (102, "x" * 5000), (-5, base)]
    near = base.split()
    for i in range(30):
        edited = near[:]
        edited[r.randrange(len(edited))] = f"n{i}"
        rows.append((200 + i, " ".join(edited)))
    sources = ["b", "a", None, "ä", "", "c"]
    return [(d, t, None, sources[k % 6], None if t is None else len(t)) for k, (d, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def rows():
    return awkward_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same rows with columns named like those that operators make on the way."""
    from pyspark.sql import functions as F

    extra = ("sha", "fp", "sig", "size", "start", "gone", "kept", "paths", "text_hash", "dkey", "score", "_key", "n", "keep_id")
    return docs.withColumns({c: F.lit("clash") for c in extra})
