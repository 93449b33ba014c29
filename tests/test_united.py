"""Files with unlike headers, and JSON lines with torn ends."""

import json

import pytest

from docketlake.sources import readers
from docketlake.sources.united import UnitedFiles


def put(folder, name, data):
    (folder / name).write_bytes(data if isinstance(data, bytes) else data.encode())


@pytest.fixture
def folder(tmp_path):
    put(tmp_path, "cases_A.csv", "﻿id,solution,judge\r\n1,x,Я\r\n2,\"a, \"\"b\"\"\",\r\n")
    put(tmp_path, "cases_B.csv", "judge,note,id,note\nJ,n1,3,n2,beyond\nK\n\n")
    put(tmp_path, "cases_C.csv", "")
    put(tmp_path, "cases_D.csv", "solution,other\ny,z\n")
    put(tmp_path, "cases_E.csv", "id,extra, solution \n")
    put(tmp_path, "cases_F.2.csv", "id,zeta\n9,w")
    put(tmp_path, "cases_G.csv.gz", b"no gzip at all")
    put(tmp_path, "cases_H+ é%41.csv", "id\n")
    return str(tmp_path)


@pytest.mark.parametrize("split", ["100m", "16b"])
def test_united(spark, folder, split):
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        united = UnitedFiles(spark, folder, required=["id"], first=["id", "judge", "never"])
        assert united.columns == ["id", "judge", "never", "solution", "note", "extra", "zeta"]
        got = sorted(map(tuple, united.rows("court").collect()), key=str)
        assert got == sorted([
            ("1", "Я", None, "x", None, None, None, "A"), ("2", None, None, 'a, "b"', None, None, None, "A"),
            ("3", "J", None, None, "n1", None, None, "B"), (None, "K", None, None, None, None, None, "B"), ("9", None, None, None, None, None, "w", "F"),
        ], key=str)
        lineage = {r.file: (r.status, r.rows) for r in united.lineage().collect()}
        assert lineage == {
            "cases_A.csv": ("read", 2), "cases_B.csv": ("read", 2), "cases_C.csv": ("empty", 0), "cases_D.csv": ("missing id", 0),
            "cases_E.csv": ("read", 0), "cases_F.2.csv": ("read", 1), "cases_G.csv.gz": ("unreadable", 0), "cases_H+ é%41.csv": ("read", 0),
        }
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_only_empty_files(spark, tmp_path):
    put(tmp_path, "a.csv", "")
    united = UnitedFiles(spark, str(tmp_path), first=["id"])
    assert united.columns == ["id"] and united.rows().count() == 0 and united.lineage().first().status == "empty"


@pytest.mark.parametrize("split", ["100m", "200b"])
def test_torn_lines(spark, tmp_path, split):
    """The last record of a key wins however files are split; torn lines are counted."""
    one = [json.dumps({"k": f"k{i % 37}", "ru": "р", "en": f"{i}"}, ensure_ascii=False) for i in range(400)]
    put(tmp_path, "a.jsonl", "\n".join([*one[:200], "", "[1]", '{"k": "k1", "en": null}', *one[200:], '{"k": "k5", "en": "to']))
    put(tmp_path, "b.jsonl", '{"k": "k0", "en": "later file"}\n{"k": "new", "ru": null, "en": "1"}\n')
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {r.k: r.en for r in readers.paragraph_cache(spark, str(tmp_path)).collect()}
        assert got == {f"k{i % 37}": f"{i}" for i in range(400)} | {"k0": "later file", "new": "1"}
        counts = {r.file[-7:]: (r.lines, r.bad, r.torn_tail) for r in readers.line_counts(readers.json_lines(spark, str(tmp_path), readers.CACHE)).collect()}
        assert counts == {"a.jsonl": (403, 2, True), "b.jsonl": (2, 0, False)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
