"""Operator 11 against a brute-force search of all periods and places."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketlake.llm import periodic_runs

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """Maximal stretches for each period, those left out whose smallest period is another."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                stretch = words[i : j + q]
                if not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                    out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = SPLIT.findall(text or "")
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 0
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 9)), max_size=6), st.integers(0, 3))
@settings(max_examples=400, deadline=None)
def test_grid_finds_all_runs(parts, tail):
    words = [w for block, times in parts for w in block * times] + [tail]
    assert [tuple(r) for r in periodic_runs.grid_runs(np.array(words), len(words)).tolist()] == brute_runs(words)


@given(st.lists(st.integers(0, 1), max_size=60))
@settings(max_examples=400, deadline=None)
def test_grid_on_two_words(words):
    assert [tuple(r) for r in periodic_runs.grid_runs(np.array(words, dtype=np.int64), len(words)).tolist()] == brute_runs(words)


def awkward():
    r = random.Random(3)
    word = lambda: r.choice(["a", "b", "c", "dd", "é"])
    rows = [(i, " ".join(word() for _ in range(r.randrange(60)))) for i in range(150)]
    for i in range(60):
        block = [word() for _ in range(r.randint(1, 9))]
        rows.append((200 + i, " x ".join([" ".join(block * r.randint(3, 9)), " ".join(word() for _ in range(20))])))
    rows += [(300, None), (301, ""), (302, " \n\t"), (None, "a b " * 9), (None, None), (303, "w " * 5000), (304, "a b\n" * 2500 + "c"), (303, "w " * 5000)]
    return rows + [(305, " ".join(str(i % 700) for i in range(4000))), (-7, "x y z " * 4)]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("runs"))
    spark.createDataFrame(awkward(), "doc_id long, text string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query(spark, table):
    got = [tuple(r) for r in periodic_runs.op11_periodic_runs(spark, table).select(*COLUMNS).collect()]
    assert sorted(got, key=repr) == sorted((brute_row(*row) for row in awkward()), key=repr)


def test_clashing_columns_and_no_rows(spark, docs, clashing, no_docs):
    plain = sorted(map(tuple, periodic_runs.without_runs(docs).collect()), key=repr)
    assert sorted(map(tuple, periodic_runs.without_runs(clashing).collect()), key=repr) == plain
    assert periodic_runs.without_runs(no_docs).count() == 0


def test_texts_as_they_are(docs, rows):
    found = {(r.doc_id, r.n_words): r for r in periodic_runs.without_runs(docs).collect()}
    got = found[13, 60]
    assert [tuple(x) for x in got.runs] == [(0, 60, 1)] and got.text == "rep"
    assert found[12, 5].text == "a b c d e" and found[7, 0].text == ""
