"""Writers with a commit: what lands, and what a failed or repeated task leaves."""

import csv
import io

import pytest
from pyspark.sql import functions as F

from docketlake.sources import readers
from docketlake.sources.case_files import Attempt, CaseCsv, _CsvWriter, _TextWriter, sweep, write_case_csv, write_texts

COLUMNS = ["case_number", "solution"]


def landed(folder):
    return sorted(p.name for p in folder.iterdir())


def readers_see(folder):
    """Tasks that run when a job is aborted may leave staging behind."""
    return [n for n in landed(folder) if not n.startswith("_")]


def parsed(folder):
    rows = []
    for p in sorted(folder.glob("*.csv")):
        raw = p.read_bytes()
        assert raw.startswith(b"\xef\xbb\xbf") and raw.endswith(b"\r\n")
        head, *body = csv.reader(io.StringIO(raw.decode("utf-8-sig"), newline=""))
        assert head == COLUMNS
        rows += [(p.name.split(".")[0], *r) for r in body]
    return sorted(rows)


def test_csv_for_each_court(spark, tmp_path):
    rows = [("2-1/25", "да, \"нет\"", "Alpha"), ("2-2/25", None, "Alpha"), ("2-3/25", "a\nb", "Beta"), ("2-4/25", "x", None)]
    df = spark.createDataFrame(rows, "case_number string, solution string, court string")
    write_case_csv(df.coalesce(1), str(tmp_path / "one"), "court", COLUMNS)
    assert landed(tmp_path / "one") == ["cases_output_Alpha.csv", "cases_output_Beta.csv", "cases_output_unnamed.csv"]
    want = [("cases_output_" + (c or "unnamed"), n, s or "") for n, s, c in rows]
    assert parsed(tmp_path / "one") == sorted(want)
    write_case_csv(df.repartition(8, "case_number"), str(tmp_path / "many"), "court", COLUMNS)
    assert parsed(tmp_path / "many") == sorted(want)
    assert not any(n.startswith("_") for n in landed(tmp_path / "many"))
    again = readers.string_table(spark, str(tmp_path / "one"), required=COLUMNS)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(((n, s) for n, s, _ in rows), key=str)


def test_no_rows_make_no_file(spark, tmp_path):
    write_case_csv(spark.createDataFrame([], "case_number string, solution string"), str(tmp_path), "case_number", COLUMNS)
    assert landed(tmp_path) == []


def test_failed_task_leaves_nothing(spark, tmp_path):
    df = spark.range(100).repartition(4).select(F.col("id").cast("string").alias("case_number"), F.when(F.col("id") == 77, F.raise_error(F.lit("boom"))).otherwise(F.lit("x")).cast("string").alias("solution"), F.lit("A").alias("court"))
    with pytest.raises(Exception, match="boom"):
        write_case_csv(df, str(tmp_path), "court", COLUMNS)
    assert readers_see(tmp_path) == []
    (tmp_path / "_staging-x").mkdir(exist_ok=True)
    assert sweep(str(tmp_path)) and landed(tmp_path) == []


def test_repeated_attempt_counts_once(tmp_path):
    """Two attempts of one task have staged their rows; the commit names only that of its message."""
    writer = _TextWriter(str(tmp_path))
    for attempt in ("0-1", "0-2"):
        folder = tmp_path / writer.staging / attempt
        folder.mkdir(parents=True)
        (folder / "a.txt").write_text(attempt)
    writer.commit([Attempt(f"{writer.staging}/0-2", 0, {"a.txt": 1}), None])
    assert landed(tmp_path) == ["a.txt"] and (tmp_path / "a.txt").read_text() == "0-2"


def test_writers_have_staging_of_their_own(tmp_path):
    assert _CsvWriter(str(tmp_path), [], "", "").staging != _CsvWriter(str(tmp_path), [], "", "").staging
    assert CaseCsv.name() == "case_csv"


def test_text_files(spark, tmp_path):
    df = spark.createDataFrame([("a.txt", "да\nнет"), ("b.txt", None), ("c.txt", "")], "name string, text string").repartition(3)
    write_texts(df, str(tmp_path), "name", "text")
    assert landed(tmp_path) == ["a.txt", "b.txt", "c.txt"] and (tmp_path / "a.txt").read_text() == "да\nнет"
    got = {r.path.rsplit("/", 1)[1]: r.text for r in readers.whole_texts(spark, str(tmp_path)).collect()}
    assert got["a.txt"] == "да\nнет"


def test_one_name_for_two_rows(spark, tmp_path):
    for parts in (1, 2):
        df = spark.createDataFrame([("a.txt", "1"), ("a.txt", "2")], "name string, text string").repartition(parts)
        with pytest.raises(Exception, match="more than one row"):
            write_texts(df, str(tmp_path), "name", "text")
    with pytest.raises(Exception, match="no file name"):
        write_texts(spark.createDataFrame([("x/a.txt", "1")], "name string, text string"), str(tmp_path), "name", "text")
    assert readers_see(tmp_path) == []
