"""The registered queries against DuckDB, and the entry points."""

import pytest

from docketlake.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_sql(name, spark, sf, duck, same_rows):
    same_rows(registry.QUERIES[name](spark, sf).toPandas(), duck.sql(registry.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_one_row_each(name, spark, sf):
    df = registry.QUERIES[name](spark, sf)
    of, key = ("pages", "page_id") if "page_id" in df.columns else ("documents", "doc_id")
    assert df.count() == spark.read.parquet(f"{sf}/{of}.parquet").count()
    assert df.select(key).distinct().count() == df.count()


def test_registered():
    import __spark_entry__

    assert set(registry.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
