"""Numbers in an order, over any number of partitions and splits."""

import random

import pytest
from pyspark.sql import functions as F

from docketlake.operators.ordering import numbered, running_total
from docketlake.sources.row_order import numbered_lines, with_file_rows, with_row_numbers


@pytest.fixture
def conf(spark):
    kept = {}

    def put(key, value):
        kept.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, str(value))

    yield put
    for key, value in kept.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_numbered(spark, conf, parts):
    conf("spark.sql.shuffle.partitions", parts)
    r = random.Random(parts)
    rows = [(r.choice([None, *range(40)]), i) for i in range(500)] * 1
    df = spark.createDataFrame(rows, "a int, at long").repartition(5)
    got = numbered(df, [F.col("a").desc_nulls_last(), F.col("at")], "n").collect()
    want = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    assert [(x.a, x["at"]) for x in sorted(got, key=lambda x: x.n)] == want and sorted(x.n for x in got) == list(range(1, 501))
    assert numbered(df.where("false"), [F.col("at")], "n").count() == 0


def test_numbered_has_no_single_partition(spark):
    plan = numbered(spark.range(100).toDF("v"), [F.col("v").desc()], "n")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("parts", [1, 9])
def test_running_total(spark, conf, parts):
    conf("spark.sql.shuffle.partitions", parts)
    rows = [(i, None if i % 5 == 0 else i % 7) for i in range(200)]
    got = running_total(spark.createDataFrame(rows, "k int, v int").repartition(3), [F.col("k")], "v", "before").orderBy("k").collect()
    total = 0
    for x in got:
        assert x.before == total
        total += x.v or 0


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lines")
    r = random.Random(1)
    for k, n in enumerate([400, 1, 0, 900]):
        (folder / f"part-{k}.csv").write_text("\r\n".join(["id,text", *[f"{k}-{i},{'x' * r.randrange(80)}" for i in range(n)]]) + ("" if k == 1 else "\r\n"))
    return str(folder)


@pytest.mark.parametrize("split", ["100m", "9k", "400b"])
def test_rows_of_files(spark, conf, folder, split):
    """The whole file in one split, a few splits, and some 200."""
    conf("spark.sql.files.maxPartitionBytes", split)
    conf("spark.sql.files.openCostInBytes", "64b")
    scan = spark.read.csv(folder, header=True)
    want = [f"{k}-{i}" for k, n in enumerate([400, 1, 0, 900]) for i in range(n)]
    assert [r.id for r in with_row_numbers(scan).orderBy("row").collect()] == want
    assert sorted(r.row for r in with_row_numbers(scan).collect()) == list(range(1301))
    assert all(int(r.id.split("-")[1]) == r.row and f"part-{r.id[0]}" in r.file for r in with_file_rows(scan).collect())
    lines = numbered_lines(spark, folder).where("file like '%part-3%'").orderBy("line").collect()
    assert [x.line for x in lines] == list(range(901)) and lines[0].value == "id,text" and lines[5].value.startswith("3-4,")
    if split == "400b":
        assert scan.rdd.getNumPartitions() > 100
