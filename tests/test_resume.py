"""Keyed state and counters that batches carry on: killed and repeated batches, filters that are full, versions."""

import pytest
from pyspark.sql import functions as F

from docketlake.streaming.resume import KeyedState, counts_by, process_new
from docketlake.streaming.versions import Versions

SCHEMA = "k string, v int"


def keys(state):
    rows = state.rows()
    return sorted(r.k for r in rows.collect()) if rows is not None else []


def batch(spark, low, high):
    return spark.createDataFrame([(f"k{i}", i) for i in range(low, high)] + [(None, 0)], SCHEMA)


@pytest.mark.parametrize("bits", [1 << 20, 64])
def test_each_key_once(spark, tmp_path, bits):
    """With 64 bits the filters are full at once: then every key is joined, and results are the same."""
    state = KeyedState(spark, str(tmp_path), "k", buckets=4, bits=bits)
    assert keys(state) == []
    for number, (low, high) in enumerate([(0, 100), (50, 150), (50, 150), (0, 160), (0, 0)]):
        state.add(batch(spark, low, high), f"s-{number}")
    assert keys(state) == sorted(f"k{i}" for i in range(160))
    assert state.rows().where("k = 'k70'").first().v == 70


def test_killed_batches(spark, tmp_path):
    """One that dies at its work, and one that dies after all its writes but before its offsets, run again."""
    state = KeyedState(spark, str(tmp_path), "k", buckets=4)
    state.add(batch(spark, 0, 10), "s-0")

    def dies(rows):
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError, match="killed"):
        state.add(batch(spark, 5, 20), "s-1", dies)
    assert keys(state) == sorted(f"k{i}" for i in range(10))
    for _ in range(3):
        state.add(batch(spark, 5, 20), "s-1")
    assert keys(state) == sorted(f"k{i}" for i in range(20))
    state.add(batch(spark, 0, 25), "other-0")
    assert keys(state) == sorted(f"k{i}" for i in range(25))


def test_only_touched_buckets_are_read(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path), "k", buckets=16)
    state.add(batch(spark, 0, 200), "s-0")
    plan = state.unknown(spark.createDataFrame([("k3", 1), ("new", 2)], SCHEMA), "s-1")
    assert [r.k for r in plan.collect()] == ["new"]
    text = state.rows("s-1", [3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "bucket" in text.split("PartitionFilters")[1][:120]


def test_unknown_keys_read_no_state(spark, tmp_path, monkeypatch):
    state = KeyedState(spark, str(tmp_path), "k", buckets=4)
    state.add(batch(spark, 0, 100), "s-0")
    monkeypatch.setattr(state, "rows", lambda *a: pytest.fail("the state is read"))
    assert state.unknown(spark.createDataFrame([("none of them", 1)], SCHEMA), "s-1").count() == 1


def test_versions(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "v"))
    one = lambda x: spark.createDataFrame([(x,)], "x int")
    assert versions.latest() is None and versions.before("a") == (None, 1)
    for i in range(6):
        before, seq = versions.before(f"b{i}")
        assert seq == i + 1 and (before is None if i == 0 else before.first().x == i - 1)
        versions.write(one(i), f"b{i}", seq)
    before, seq = versions.before("b5")
    assert (before.first().x, seq) == (4, 6) and versions.latest().first().x == 5
    assert len(versions.listed()) <= 4


def test_streams(spark, tmp_path):
    def run(folder):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        process_new(stream, "k", str(tmp_path / "state"), str(tmp_path / folder), lambda df: df.select("k", F.col("v").alias("done"))).awaitTermination()

    for low, high in ((0, 30), (20, 50)):
        batch(spark, low, high).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    run("offsets")
    batch(spark, 40, 60).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    run("offsets")
    run("another run from the start")
    assert keys(KeyedState(spark, str(tmp_path / "state"), "k")) == sorted(f"k{i}" for i in range(60))


def test_counts(spark, tmp_path):
    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        return {r.k: r.n for r in counts_by(stream, "k", str(tmp_path / "counts"), str(tmp_path / "offsets")).collect()}

    batch(spark, 0, 3).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    batch(spark, 2, 4).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    assert run() == {"k0": 1, "k1": 1, "k2": 2, "k3": 1, None: 2}
    batch(spark, 0, 1).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    assert run() == {"k0": 2, "k1": 1, "k2": 2, "k3": 1, None: 3}
