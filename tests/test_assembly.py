"""Reassembly in steps equals reassembly at once, touches only what it completes, and stands repeats."""

import pytest
from pyspark.sql import functions as F

from docketlake.operators import corpus as C
from docketlake.operators.assembly import Assembly

LETTERS = "[A-Za-z]"


@pytest.fixture(scope="module")
def lines(spark):
    docs = [(i, "\n".join([f"para {i % 7}", "", f"para {i % 3}", f"12 {'x' if i % 2 else '-'}"])) for i in range(40)] + [(40, "1\n2"), (41, ""), (42, None), (43, "only para 99")]
    return C.lines_of(spark.createDataFrame(docs, "doc_id long, text string"), pattern=LETTERS)


@pytest.fixture(scope="module")
def cache(spark, lines):
    return spark.createDataFrame(C.unique_paragraphs(lines).select("k", F.upper("norm").alias("en")).where("norm <> 'only para 99'").collect(), "k string, en string")


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


@pytest.mark.parametrize("buckets", [1, 64])
def test_in_steps(spark, tmp_path, lines, cache, buckets):
    whole = {r.doc_id: r.text for r in C.reassembled(lines, cache).collect() if r.complete}
    assembly = Assembly(spark, str(tmp_path), buckets=buckets)
    got = texts(assembly.begin(lines))
    assert got == {40: "1\n2", 41: ""}
    entries = [cache.where(F.pmod(F.conv(F.substring("k", 1, 2), 16, 10).cast("int"), F.lit(3)) == i) for i in range(3)]
    for step, part in enumerate([*entries, cache.limit(0), entries[0]]):
        for _ in range(2):
            again = texts(Assembly(spark, str(tmp_path), buckets=buckets).add(part, str(step)))
        assert not set(again) & set(got)
        got |= again
    assert got == whole
    assert [tuple(r) for r in assembly.incomplete().collect()] == [(43, 1)]


def test_first_translation_stays(spark, tmp_path, lines, cache):
    assembly = Assembly(spark, str(tmp_path))
    assembly.begin(lines)
    key = C.unique_paragraphs(lines).where("norm = 'only para 99'").first().k
    assembly.add(spark.createDataFrame([("unused", "x"), (None, "y"), (key, None)], "k string, en string"), "a")
    both = spark.createDataFrame([(key, "two"), (key, "one")], "k string, en string")
    assert texts(assembly.add(both, "b")) == {43: "one"}
    assert texts(assembly.add(both, "c")) == {}


def test_only_touched_lines_are_read(spark, tmp_path, lines, cache):
    """The second part reads lines of the buckets of completed documents alone."""
    assembly = Assembly(spark, str(tmp_path))
    assembly.begin(lines)
    key = C.unique_paragraphs(lines).where("norm = 'only para 99'").first().k
    plan = assembly.add(spark.createDataFrame([(key, "x")], "k string, en string"), "a")._jdf.queryExecution().executedPlan().toString()
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(43).cast("long")), F.lit(64))).first()[0]
    assert "(bucket#" in plan and f" = {bucket})" in plan or f"IN ({bucket})" in plan


def test_texts_are_stored_once(spark, tmp_path, lines, cache):
    """Lines with a key are laid out without their text, and no key stands twice in what is translated, whatever steps bring again."""
    assembly = Assembly(spark, str(tmp_path))
    assembly.begin(lines)
    stored = spark.read.parquet(f"{tmp_path}/lines")
    assert stored.where("k is not null and line is not null").count() == 0 and "norm" not in stored.columns
    assert stored.where("k is null").count() == lines.where("k is null and line is not null").count() > 0
    for step in ("a", "b", "a", "c"):
        assembly.add(cache.union(cache), step)
        kept = spark.read.parquet(f"{tmp_path}/cache")
        assert sorted(r.k for r in kept.collect()) == sorted(r.k for r in cache.collect())
