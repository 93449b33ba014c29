"""Queries that write a table out in the shared folder, in one of the forms that files come in, and read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.functions.dates import day_text, parse_flexible
from docketlake.functions.text import key_of
from docketlake.operators import relational as R
from docketlake.operators.cases import link_files
from docketlake.operators.ordering import numbered
from docketlake.session import shared_folder
from docketlake.sources import readers, sinks
from docketlake.sources.case_files import write_case_csv, write_texts
from docketlake.sources.readers import table
from docketlake.sources.row_order import with_row_numbers
from docketlake.sources.united import UnitedFiles
from docketlake.sources.workbook import read_workbooks, write_workbooks


def scratch(spark: SparkSession) -> str:
    """A new folder that the driver and all executors share."""
    return shared_folder(spark, "files")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    day = day_text(F.col("o_orderdate").cast("date"))
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", day.alias("received"), "o_orderstatus", "o_orderpriority")


ORDERS = "orders_ AS (SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%d.%m.%Y') AS received, o_orderstatus, o_orderpriority FROM orders)"
LISTED = ["o_orderkey", "o_custkey", "o_totalprice", "received"]


def case_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV for each order status, with mark, CRLF and a fixed order of fields; the status comes back out of the names."""
    folder = scratch(spark)
    write_case_csv(_orders(spark, sf), folder, "o_orderstatus", LISTED)
    rows = readers.case_lists_with_court(spark, folder, "o_orderkey long, o_custkey long, o_totalprice double, received string")
    return rows.withColumn("day", parse_flexible(F.col("received")))


def named_text_files(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers of one nation share a link; its text file is named after the first of them."""
    link = F.concat(F.lit(" https://court.example/doc?n="), F.col("s_nationkey").cast("string"))
    cases = table(spark, sf, "supplier").select("s_suppkey", F.concat("s_name", F.lit("/2026")).alias("number"), link.alias("link"))
    texts = cases.groupBy(F.ltrim("link").alias("link")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", "number"))), lambda x: x["number"]), "\n").alias("text"))
    names = link_files(cases, "link", "number", "s_suppkey").select("link", F.substring_index("path", "/", -1).alias("name"))
    folder = scratch(spark)
    write_texts(names.join(texts, "link"), folder, "name", "text")
    return readers.whole_texts(spark, folder).select(F.substring_index("path", "/", -1).alias("name"), "text")


def _read_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The orders as CSV files, in the order of their keys through all files; a scan of them."""
    folder, parts = scratch(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _orders(spark, sf).select(*LISTED).repartitionByRange(parts, "o_orderkey").sortWithinPartitions("o_orderkey")
    rows.write.csv(folder, header=True)
    return spark.read.schema("o_orderkey long, o_custkey long, o_totalprice double, received string").csv(folder, header=True, enforceSchema=False)


def enumerated_rows(spark: SparkSession, sf: str) -> DataFrame:
    return with_row_numbers(_read_listing(spark, sf), "row").select("o_orderkey", "o_custkey", "row")


def restored_order(spark: SparkSession, sf: str) -> DataFrame:
    """The latest order of each customer, numbered anew in the order that they have in the files."""
    rows = with_row_numbers(_read_listing(spark, sf), "row")
    latest = R.latest_per_key(rows, ["o_custkey"], parse_flexible(F.col("received")), F.col("row"))
    return numbered(latest.select("o_custkey", "o_orderkey", "row"), [F.col("row")], "index", first=0)


def _torn_log(spark: SparkSession, sf: str) -> str:
    """The events as a cache of JSON lines, by id through all files; the last line is cut, as by a write that broke off."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    last = events.agg(F.max("event_id")).scalar()
    record = F.to_json(F.struct(F.col("user_id").cast("string").alias("k"), F.col("event_type").alias("ru"), F.col("value").cast("string").alias("en")))
    line = F.when(F.col("event_id") == last, F.substring(record, 1, 20)).otherwise(record)
    folder, parts = scratch(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = events.select("event_id", line.alias("value")).repartitionByRange(parts, "event_id").sortWithinPartitions("event_id")
    rows.select("value").write.text(folder)
    return folder


def torn_cache(spark: SparkSession, sf: str) -> DataFrame:
    """The last whole record of each key."""
    return readers.paragraph_cache(spark, _torn_log(spark, sf)).select("k", "ru", F.col("en").cast("double").alias("en"))


def torn_cache_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = readers.line_counts(readers.json_lines(spark, _torn_log(spark, sf), readers.CACHE))
    return counts.agg(F.sum("lines").alias("lines"), F.sum("bad").alias("bad"), F.count_if("torn_tail").alias("torn_tails"))


#: What each court's file has, in its order.
HEADERS = {
    "F": ["o_orderkey", "o_custkey", "o_totalprice"],
    "O": ["o_totalprice", "o_orderkey", "o_orderpriority"],
    "P": ["received", "o_orderpriority", "o_custkey", "o_orderkey"],
}


def _unlike_files(spark: SparkSession, sf: str) -> UnitedFiles:
    """The orders by status, with other columns in another order for each; an empty file and one without keys among them."""
    folder = scratch(spark)
    for status, columns in HEADERS.items():
        write_case_csv(_orders(spark, sf).where(F.col("o_orderstatus") == status), folder, "o_orderstatus", columns)
    odd = [("cases_output_Empty.csv", ""), ("cases_output_Odd.csv", "judge,note\r\nx,y\r\n")]
    write_texts(spark.createDataFrame(odd, "name string, text string"), folder, "name", "text")
    return UnitedFiles(spark, folder, required=["o_orderkey"], first=["o_orderkey", "o_custkey"])


def united_files(spark: SparkSession, sf: str) -> DataFrame:
    rows = _unlike_files(spark, sf).rows("court_name")
    return rows.select(*[F.col(c).cast({"o_totalprice": "double"}.get(c, "long" if c.endswith("key") else "string")) for c in rows.columns])


def united_files_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and outcome by court; a court of several files has one row."""
    lineage = _unlike_files(spark, sf).lineage()
    court = F.regexp_extract("file", r"([^_/]+?)(\.\d+)?\.csv$", 1)
    return lineage.groupBy(court.alias("court_name"), "status").agg(F.sum("rows").alias("rows"))


def checkpoint_files(spark: SparkSession, sf: str) -> DataFrame:
    """A JSON file for each supplier, every seventh cut off; only whole ones count."""
    url = F.concat(F.lit("https://court.example/"), F.col("s_suppkey").cast("string"))
    failed = F.col("s_suppkey") % 3 == 0
    fields = [url.alias("url"), F.when(~failed, F.col("s_name")).alias("opinion_text"), F.when(failed, "fetch_failed").alias("error"), F.lit("2026-01-01 00:00:00").alias("fetched_at")]
    whole = F.to_json(F.struct(*fields), {"ignoreNullFields": "false", "pretty": "true"})
    text = F.when(F.col("s_suppkey") % 7 == 0, F.substring(whole, 1, 30)).otherwise(whole)
    folder = scratch(spark)
    write_texts(table(spark, sf, "supplier").select(F.concat(key_of(url), F.lit(".json")).alias("name"), text.alias("text")), folder, "name", "text")
    return readers.checkpoints(spark, folder)


def _csv(spark: SparkSession, rows: DataFrame) -> str:
    folder = scratch(spark)
    sinks.write_csv(rows, folder)
    return folder


def court_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' sites as an input list whose columns are found by part of their names; blank addresses are left out."""
    n = F.col("c_custkey")
    address = F.when(n % 10 == 0, F.lit("   ")).when(n % 10 == 1, F.lit("NaN")).when(n % 10 == 2, F.lit(None)).otherwise(F.concat(F.lit(" https://"), F.col("c_name"), F.lit(".example/ ")))
    rows = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("Filter used"), address.alias("Base URL of court"), n.alias("number"))
    return readers.court_list(spark, _csv(spark, rows))


def string_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as text, quotes, commas and line ends among them; one of two alternative columns is there."""
    name = F.concat(F.col("p_name"), F.when(F.col("p_size") % 2 == 0, F.lit(',\n"x"')).otherwise(F.lit("")))
    rows = table(spark, sf, "part").select("p_partkey", name.alias("opinion_text"), "p_retailprice")
    read = readers.string_table(spark, _csv(spark, rows), required=["p_partkey"], any_of=["opinion_text", "opinion_text_file"])
    return read.select(F.col("p_partkey").cast("long").alias("p_partkey"), "opinion_text", F.col("p_retailprice").cast("double").alias("p_retailprice"))


def outlines(spark: SparkSession, sf: str) -> DataFrame:
    """A GeoJSON file for each customer's nation, every third a collection, every second of several polygons; read as rings."""
    n = F.col("n_nationkey")
    ring = lambda at: F.array(*[F.array((n + at + x).cast("double"), (n - y).cast("double")) for x, y in ((0, 0), (1, 0), (1, 1), (0, 0))])
    shape = F.when(n % 2 == 0, F.to_json(F.array(F.array(ring(0)), F.array(ring(10), ring(20))))).otherwise(F.to_json(F.array(ring(0), ring(5))))
    geometry = F.concat(F.lit('{"type":"'), F.when(n % 2 == 0, "MultiPolygon").otherwise("Polygon"), F.lit('","coordinates":'), shape, F.lit("}"))
    feature = F.concat(F.lit('{"type":"Feature","geometry":'), geometry, F.lit("}"))
    text = F.when(n % 3 == 0, F.concat(F.lit('{"type":"FeatureCollection","features":['), feature, F.lit("]}"))).otherwise(feature)
    nations = table(spark, sf, "customer").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    folder = scratch(spark)
    write_texts(nations.select(F.concat(n.cast("string"), F.lit(".geojson")).alias("name"), text.alias("text")), folder, "name", "text")
    rows = readers.outline(spark, folder)
    number = lambda c: F.transform(c, lambda x: x.cast("string"))
    return rows.select("polygon", "ring", F.array_join(number("xs"), " ").alias("xs"), F.array_join(number("ys"), " ").alias("ys"))




def workbook_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The parts as workbooks, one for each brand, as wide as their texts; read back by the labels of the first row."""
    part, folder = table(spark, sf, "part"), scratch(spark)
    widths = {r["column"]: r.width for r in R.widths(part).collect()}
    write_workbooks(part, folder, part.columns, by="p_brand", widths=[widths[c] for c in part.columns])
    read = read_workbooks(spark, folder)
    return read.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in part.schema])


def workbook_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers by nation, those of even nations with a second sheet; where there is none the first one is read."""
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("book"), F.lit("RUSSIAN").alias("sheet"))
    second = rows.where("book % 2 = 0").withColumns({"s_name": F.upper("s_name"), "sheet": F.lit("ENGLISH")})
    both = rows.unionByName(second).repartition("book")
    folder = scratch(spark)
    write_workbooks(both, folder, ["s_suppkey", "s_name"], by="book", sheet="sheet")
    read = read_workbooks(spark, folder, sheet="ENGLISH")
    return read.select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name")


QUERIES = {
    f.__name__: f
    for f in (
        case_csv_round_trip, named_text_files, enumerated_rows, restored_order, torn_cache, torn_cache_counts, united_files, united_files_lineage,
        checkpoint_files, court_inputs, string_columns, outlines, workbook_round_trip, workbook_sheets,
    )
}

LAST = "(SELECT max(event_id) FROM events)"
ORACLE_SQL = {
    "case_csv_round_trip": f"WITH {ORDERS} SELECT o_orderkey, o_custkey, o_totalprice, received, o_orderstatus AS court_name, CAST(strptime(received, '%d.%m.%Y') AS DATE) AS day FROM orders_",
    "named_text_files": "WITH s AS (SELECT s_suppkey, s_name || '/2026' AS number, 'https://court.example/doc?n=' || s_nationkey AS link FROM supplier) SELECT regexp_replace(regexp_replace(arg_min(number, s_suppkey), '[^\\p{L}\\p{N}_-]+', '_', 'g'), '^_+|_+$', '', 'g') || '_' || substr(sha1(link), 1, 8) || '.txt' AS name, string_agg(number, chr(10) ORDER BY s_suppkey) AS text FROM s GROUP BY link",
    "enumerated_rows": "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row FROM orders",
    "restored_order": """WITH r AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, row_number() OVER (ORDER BY o_orderkey) - 1 AS row FROM orders),
l AS (SELECT o_custkey, o_orderkey, row FROM r QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC NULLS LAST, row DESC) = 1) SELECT *, row_number() OVER (ORDER BY row) - 1 AS index FROM l""",
    "torn_cache": f"SELECT CAST(user_id AS VARCHAR) AS k, arg_max(event_type, event_id) AS ru, arg_max(value, event_id) AS en FROM events WHERE event_id < {LAST} AND value IS NOT NULL GROUP BY user_id",
    "torn_cache_counts": "SELECT count(*) AS lines, CAST(1 AS BIGINT) AS bad, CAST(1 AS BIGINT) AS torn_tails FROM events",
    "united_files": f"""WITH {ORDERS} SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN received END AS received, o_orderstatus AS court_name FROM orders_""",
    "united_files_lineage": "SELECT o_orderstatus AS court_name, 'read' AS status, count(*) AS rows FROM orders GROUP BY 1 UNION ALL SELECT 'Empty', 'empty', 0 UNION ALL SELECT 'Odd', 'missing o_orderkey', 0",
    "checkpoint_files": "SELECT 'https://court.example/' || s_suppkey AS url, CASE WHEN s_suppkey % 3 <> 0 THEN s_name END AS opinion_text, CASE WHEN s_suppkey % 3 = 0 THEN 'fetch_failed' END AS error, '2026-01-01 00:00:00' AS fetched_at FROM supplier WHERE s_suppkey % 7 <> 0",
    "court_inputs": "SELECT 'https://' || c_name || '.example/' AS base_url, c_mktsegment AS notes FROM customer WHERE c_custkey % 10 > 2",
    "workbook_round_trip": "SELECT * FROM part",
    "workbook_sheets": "SELECT s_suppkey, CASE WHEN s_nationkey % 2 = 0 THEN upper(s_name) ELSE s_name END AS s_name FROM supplier",
    "string_columns": """SELECT p_partkey, p_name || CASE WHEN p_size % 2 = 0 THEN ',' || chr(10) || '"x"' ELSE '' END AS opinion_text, p_retailprice FROM part""",
    "outlines": """WITH n AS (SELECT DISTINCT c_nationkey AS n FROM customer), r AS (
  SELECT n + p.x AS a, n, p.polygon, p.ring FROM n JOIN (VALUES (0, 0, 0, 0), (0, 1, 0, 10), (0, 1, 1, 20), (1, 0, 0, 0), (1, 0, 1, 5)) p(odd, polygon, ring, x) ON p.odd = n % 2)
SELECT polygon, ring, concat_ws(' ', a::DOUBLE, (a + 1)::DOUBLE, (a + 1)::DOUBLE, a::DOUBLE) AS xs, concat_ws(' ', n::DOUBLE, n::DOUBLE, (n - 1)::DOUBLE, n::DOUBLE) AS ys FROM r""",
}
