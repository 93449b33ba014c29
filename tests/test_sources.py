"""Readers, writers and runs that are taken up again, on files of our own."""

import json

import pytest
from pyspark.sql import functions as F

from docketlake.sources import readers, sinks
from docketlake.streaming.resume import process_new, read_state


def test_case_lists(spark, tmp_path):
    head = "case_number,case_link,date_of_receipt,judge,decision_date,solution,entry_into_force_date,judicial_acts_link,source_page"
    (tmp_path / "cases_output_Alpha.csv").write_bytes(("﻿" + head + "\r\n2-1/25,http://c,01.02.2025,T,,,,,1\r\n").encode())
    row = readers.case_lists_with_court(spark, str(tmp_path)).first()
    assert (row.case_number, row.solution, row.source_page, row.court_name) == ("2-1/25", None, 1, "Alpha")


def test_court_list(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Base URL,Filter notes\n http://a ,x\n,y\nnan,z\n")
    assert [tuple(r) for r in readers.court_list(spark, str(tmp_path / "c.csv")).collect()] == [("http://a", "x")]
    (tmp_path / "d.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="url"):
        readers.court_list(spark, str(tmp_path / "d.csv"))
    with pytest.raises(ValueError, match="missing"):
        readers.string_table(spark, str(tmp_path / "d.csv"), required=["c"])
    with pytest.raises(ValueError, match="missing"):
        readers.string_table(spark, str(tmp_path / "d.csv"), any_of=["c", "d"])
    assert readers.string_table(spark, str(tmp_path / "d.csv"), any_of=["b", "d"]).count() == 1


def test_checkpoints(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps({"url": "u", "opinion_text": "t", "error": None, "fetched_at": "2026-01-01 00:00:00"}, indent=1))
    (tmp_path / "2.json").write_text('{"url": "v", "opi')
    assert [r.url for r in readers.checkpoints(spark, str(tmp_path)).collect()] == ["u"]


def test_cache_last_wins(spark, tmp_path):
    lines = [{"k": "a", "ru": "x", "en": "1"}, {"k": "b", "ru": "y", "en": "2"}, {"k": "a", "ru": "x", "en": "3"}]
    (tmp_path / "c.jsonl").write_text("\n".join(json.dumps(x) for x in lines) + '\n{"k": "c", "ru"')
    assert {(r.k, r.en) for r in readers.paragraph_cache(spark, str(tmp_path / "c.jsonl")).collect()} == {("a", "3"), ("b", "2")}


def test_whole_texts_and_outline(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text("one\ntwo")
    assert readers.whole_texts(spark, str(tmp_path / "t")).first().text == "one\ntwo"
    ring = [[0.0, 1.0], [2.0, 3.0], [0.0, 1.0]]
    for name, shape in (("f", {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]}}), ("c", {"type": "FeatureCollection", "features": [{"geometry": {"type": "MultiPolygon", "coordinates": [[ring]]}}]})):
        (tmp_path / f"{name}.json").write_text(json.dumps(shape))
        row = readers.outline(spark, str(tmp_path / f"{name}.json")).first()
        assert (row.xs, row.ys) == ([0.0, 2.0, 0.0], [1.0, 3.0, 1.0])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    assert sinks.write_csv(df, str(tmp_path / "o"), ["y", "x"], one_file=True)
    assert not sinks.write_csv(df.where("y > 1"), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    assert spark.read.csv(str(tmp_path / "o"), header=True).columns == ["y", "x"]
    sinks.write_table(df, str(tmp_path / "p"), ["x"])
    assert (tmp_path / "p" / "x=a").exists()
    sinks.write_template(spark, str(tmp_path / "template"))
    assert readers.court_list(spark, str(tmp_path / "template")).count() == 1
    sinks.append_cache(spark.createDataFrame([("k", "ж", "z")], "k string, ru string, en string"), str(tmp_path / "cache"))
    assert readers.paragraph_cache(spark, str(tmp_path / "cache")).first().ru == "ж"
    files = spark.createDataFrame([("p", "t"), ("p", "t")], "a string, b string")
    assert sinks.text_rows(files, "a", "b").count() == 1
    sinks.append_checkpoints(spark.createDataFrame([("u", "t", None)], "url string, opinion_text string, error string"), str(tmp_path / "state"))
    assert len(spark.read.parquet(str(tmp_path / "state")).first()["key"]) == 16


def test_resumed_stream(spark, tmp_path):
    source, state = tmp_path / "in", str(tmp_path / "state")
    schema = "k string, v int"

    def run():
        stream = spark.readStream.schema(schema).json(str(source))
        process_new(stream, "k", state, str(tmp_path / "check"), lambda df: df.select("k", F.col("v").alias("done"))).awaitTermination()

    assert read_state(spark, state, "k") is None
    spark.createDataFrame([("a", 1), ("b", 2)], schema).write.json(str(source))
    run()
    spark.createDataFrame([("a", 9), ("c", 3)], schema).write.mode("append").json(str(source))
    run()
    assert {(r.k, r.done) for r in read_state(spark, state, "k").collect()} == {("a", 1), ("b", 2), ("c", 3)}


def test_settled_tables_can_be_removed(spark, tmp_path):
    from docketlake.session import clear_settled, settled

    clear_settled(spark)
    kept = [settled(spark.range(5)) for _ in range(3)]
    assert sum(df.count() for df in kept) == 15
    assert clear_settled(spark) == 3 and clear_settled(spark) == 0
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|PATH_NOT_FOUND"):
        kept[0].collect()
