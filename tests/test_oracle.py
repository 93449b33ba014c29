"""Every query of the catalog with SQL gives what DuckDB gives; the others give rows of a stable schema."""

import duckdb
import pytest

from docketlake.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_matches_sql(name, spark, sf, duck, same_rows):
    same_rows(catalog.QUERIES[name](spark, sf).toPandas(), duck.sql(catalog.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_gives_rows(name, spark, sf):
    df = catalog.QUERIES[name](spark, sf)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


def test_opinions_of_cases_take_every_text(spark, sf):
    """Each case has the text that its link names, whatever the id; only the others have none."""
    held = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in catalog.QUERIES["opinions_of_cases"](spark, sf).collect()}
    assert set(got) == set(held) and max(held) > 90
    of = {i: 1 if i % 11 == 1 else None if i % 7 == 3 else i - i % 3 for i in held}
    assert {i for i, r in got.items() if r.opinion_text_file} == {i for i, n in of.items() if i % 5 and held.get(n)}
    assert all(r.chars == len(held[of[i]]) for i, r in got.items() if r.opinion_text_file and len(held[of[i]]) <= 32000)


def test_html_title_matches_sql_on_other_references(spark, tmp_path, same_rows):
    """Quotes, references without their end, and blank titles, which the smallest tables lack."""
    titles = ["a &quot;b&quot;", "x &amp;&amp;&amp; y&amp", "c &middot; d", "", "  ", "&lt;p&gt; & q", None]
    rows = [(i, "http://a.example/", None if t is None else f"<html><head><title>{t}</title></head><body><p>1 &lt; 2</p></body></html>") for i, t in enumerate(titles)]
    spark.createDataFrame([*rows, (len(rows), "http://a.example/", "<p>no title</p>")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    same_rows(catalog.QUERIES["html_title"](spark, str(tmp_path)).toPandas(), connection.execute(catalog.ORACLE_SQL["html_title"]).df())


def test_html_main_text_matches_sql_on_cut_references(spark, tmp_path, same_rows):
    """Texts that end within a reference, as those that were cut do, and references that the SQL leaves."""
    ends = ["&quot;", "&quot", "&quo", "&copy", "&middot", "&amp", "&amp ", "&amp;quot", "&lt;", "&ampx", "&notin", "&#39;", "&", "&amp;&amp", "&eacute b"]
    long = "x &quot;y&quot; &amp; z " * 6
    rows = [(3 * i + third, "http://a.example/", f"<html><body><article>{f'<p>{long}{end}</p>' * 5}</article></body></html>") for i, end in enumerate(ends) for third in range(3)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    for name in ("html_main_text", "html_classify"):
        same_rows(catalog.QUERIES[name](spark, str(tmp_path)).toPandas(), connection.execute(catalog.ORACLE_SQL[name]).df())


def test_participants_have_whole_texts(spark, sf):
    given = spark.read.parquet(f"{sf}/conversations.parquet").where("role = 'user' and length(text) > 20").collect()
    got = {r.conv_id: r.participants_plaintiffs for r in catalog.QUERIES["participants"](spark, sf).collect()}
    assert given and all(r.text in got[r.conv_id] for r in given)


def test_entry_points(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
