"""Workbooks: what is written is read back, by any ranges; sheets, spans of rows, tables of shared strings."""

import zipfile

import pytest
from pyspark.sql import functions as F

from docketlake.sources import workbook as W

TEXTS = ["plain", "да <&> \"q\"", "  spaces \t tab", "two\nlines\r\nmore", "bell \x07 and _x0041_", "", "😀 ￿", "=1+1", "007"]


def frame(spark, n=300):
    rows = [(i, TEXTS[i % len(TEXTS)] if i % 11 else None, i / 7, i % 2 == 0, f"court {i % 3}" if i % 5 else None) for i in range(n)]
    return spark.createDataFrame(rows, "id long, text string, value double, flag boolean, court string"), rows


def back(df):
    typed = df.select(F.col("id").cast("long"), "text", F.col("value").cast("double"), F.col("flag").cast("boolean"), "court")
    return sorted(map(tuple, typed.collect()))


@pytest.mark.parametrize("size", [1 << 26, 5000, 700])
def test_round_trip(spark, tmp_path, size):
    df, rows = frame(spark)
    W.write_workbooks(df.repartition(3, "id"), str(tmp_path), df.columns, by="court", widths=[12, 30, 12, 12, 12])
    names = sorted(p.name for p in tmp_path.iterdir())
    assert names == [f"{c}.{i}.xlsx" for c in ("court 0", "court 1", "court 2", "unnamed") for i in (1, 2, 3)]
    got = W.read_workbooks(spark, str(tmp_path), range_bytes=size)
    assert got.columns == df.columns
    assert back(got) == sorted(rows)
    if size == 700:
        assert got.rdd.getNumPartitions() > 40


def test_row_limit(spark, tmp_path, monkeypatch):
    """Rows beyond a sheet's limit go into further workbooks of the same task."""
    df, rows = frame(spark, 50)
    monkeypatch.setattr(W, "MOST_ROWS", 20)
    out = W._WorkbookWriter(str(tmp_path), df.columns, [])
    batch = df.withColumns({"_file": F.lit("x"), "_sheet": F.lit("s")}).toArrow().combine_chunks().to_batches()[0]

    class Folder:
        def open(self, name):
            return open(tmp_path / name, "wb")

    assert out.fill(Folder(), [batch]) == {"x.xlsx": 19, "x.part1.xlsx": 19, "x.part2.xlsx": 12}
    assert back(W.read_workbooks(spark, str(tmp_path))) == sorted(rows)


def test_sheets_and_fallback(spark, tmp_path):
    rows = [("a", "ORIGINAL", "ru 1"), ("a", "ENGLISH", "en 1"), ("b", "ORIGINAL", "ru 2")]
    df = spark.createDataFrame(rows, "book string, sheet string, text string").coalesce(1)
    W.write_workbooks(df, str(tmp_path), ["text"], by="book", sheet="sheet")
    assert sorted(r.text for r in W.read_workbooks(spark, str(tmp_path), sheet="ENGLISH").collect()) == ["en 1", "ru 2"]
    assert [r.text for r in W.read_workbooks(spark, str(tmp_path / "a.xlsx"), sheet="ORIGINAL").collect()] == ["ru 1"]
    with zipfile.ZipFile(tmp_path / "a.xlsx") as archive:
        assert archive.testzip() is None and W.sheets_of(archive) == [("ENGLISH", "xl/worksheets/sheet1.xml"), ("ORIGINAL", "xl/worksheets/sheet2.xml")]


def test_workbook_of_others(spark, tmp_path):
    """Shared strings in pieces, prefixed tags, cells without addresses, gaps, repeated and blank labels, blank rows."""
    sheet = (
        '<x:worksheet xmlns:x="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><x:sheetData><x:row><x:c t="s"><x:v>0</x:v></x:c><x:c t="s"><x:v>1</x:v></x:c><x:c/><x:c t="s"><x:v>0</x:v></x:c></x:row>'
        '<x:row r="2"><x:c r="B2" t="b"><x:v>1</x:v></x:c></x:row><x:row r="3"><x:c r="A3"><x:v>1.50</x:v></x:c><x:c r="AB3" t="str"><x:f>f</x:f><x:v>z</x:v></x:c></x:row><x:row r="4"/></x:sheetData></x:worksheet>'
    )
    with zipfile.ZipFile(tmp_path / "o.xlsx", "w") as archive:
        archive.writestr("xl/workbook.xml", f'<workbook xmlns="{W.MAIN}" xmlns:r="{W.RELATIONS}"><sheets><sheet name="S" sheetId="1" r:id="q"/></sheets></workbook>')
        archive.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{W.PACKAGE}/relationships"><Relationship Id="q" Target="/xl/other.xml"/></Relationships>')
        archive.writestr("xl/sharedStrings.xml", f'<sst xmlns="{W.MAIN}"><si><r><t>col</t></r><r><t> 1</t></r></si><si><t>col 2</t></si></sst>')
        archive.writestr("xl/other.xml", sheet)
    for size in (1 << 20, 150):
        got = W.read_workbooks(spark, str(tmp_path), range_bytes=size)
        assert got.columns == ["col 1", "col 2"]
        assert sorted(map(tuple, got.collect()), key=str) == [("1.50", None), (None, "true")]
    assert W.read_workbooks(spark, str(tmp_path), schema="`col 2` string, absent string").where("`col 2` is not null").first() == ("true", None)


def test_no_rows_and_failures(spark, tmp_path):
    df, _ = frame(spark)
    W.write_workbooks(df.limit(0), str(tmp_path), df.columns)
    assert list(tmp_path.iterdir()) == []
    with pytest.raises(Exception, match="no workbook"):
        W.read_workbooks(spark, str(tmp_path)).count()
    bad = df.withColumn("text", F.when(F.col("id") == 250, F.raise_error(F.lit("boom")).cast("string")).otherwise(F.col("text")))
    with pytest.raises(Exception, match="boom"):
        W.write_workbooks(bad, str(tmp_path), df.columns)
    assert not [p for p in tmp_path.iterdir() if not p.name.startswith("_")]


def test_column_names():
    assert [W.column_name(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    assert all(W.column_number(f"{W.column_name(i)}7") == i for i in range(2000))
