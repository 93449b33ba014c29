"""Queries over case records. A case is an order, a court its customer's nation, a locality the region."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.functions.dates import day_text, pages_of, parse_flexible, parse_strict
from docketlake.functions.text import label_blank
from docketlake.operators import analytics as A
from docketlake.operators import relational as R
from docketlake.sources.readers import table

NO_OUTCOME = "No solution recorded"


def cases(spark: SparkSession, sf: str) -> DataFrame:
    """``id, case_number, receipt, solution, court, region``; the outcome 'O' counts as missing."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf, "nation")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("case_number"),
        F.col("o_orderdate").cast("date").alias("receipt"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("solution"),
        F.col("n_name").alias("court"),
        F.col("n_regionkey").alias("region"),
    )


CASES = """cases AS (
  SELECT o_orderkey AS id, o_custkey AS case_number, CAST(o_orderdate AS DATE) AS receipt, CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS solution, n_name AS court, n_regionkey AS region
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""
LABELLED = "coalesce(solution, 'No solution recorded')"


def _dated(spark: SparkSession, sf: str) -> DataFrame:
    return A.with_month(cases(spark, sf).withColumn("solution", F.coalesce("solution", F.lit(NO_OUTCOME))), "receipt")


SPINE = f"""dated AS (SELECT *, CAST(date_trunc('month', receipt) AS DATE) AS month, {LABELLED} AS outcome FROM cases WHERE receipt IS NOT NULL),
spine AS (SELECT CAST(unnest(generate_series((SELECT min(month) FROM dated), (SELECT max(month) FROM dated), INTERVAL 1 MONTH)) AS DATE) AS month)"""


def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("receipt"), "o_orderstatus")
    return R.latest_per_key(orders, ["o_custkey"], F.col("receipt"), F.col("o_orderkey"))


def _linked(spark: SparkSession, sf: str, rows: DataFrame) -> DataFrame:
    keys = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("_linked")).distinct()
    return rows.join(keys, F.col("id") == F.col("_linked"), "left")


def outcome_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The latest record of each case, then a summary by outcome."""
    latest = R.latest_per_key(cases(spark, sf), ["case_number"], F.col("receipt"), F.col("id"))
    rows = _linked(spark, sf, latest)
    return R.outcome_summary(rows, label_blank(F.col("solution"), NO_OUTCOME), F.col("_linked").isNotNull(), F.col("court"), F.col("receipt")).orderBy(F.col("number_of_cases").desc(), "solution")


DIRT = {
    0: ("date_format(o_orderdate, 'dd.MM.yyyy')", "strftime(o_orderdate, '%d.%m.%Y')"),
    1: ("date_format(o_orderdate, 'd.M.yyyy')", "strftime(o_orderdate, '%-d.%-m.%Y')"),
    2: ("concat(' ', date_format(o_orderdate, 'dd/MM/yyyy'))", "' ' || strftime(o_orderdate, '%d/%m/%Y')"),
    3: ("date_format(o_orderdate, 'yyyy-MM-dd')", "strftime(o_orderdate, '%Y-%m-%d')"),
    4: ("'31.02.2025'", "'31.02.2025'"),
    5: ("'nan'", "'nan'"),
    6: ("date_format(o_orderdate, 'd-M-yyyy')", "strftime(o_orderdate, '%-d-%-m-%Y')"),
}


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    branches = " ".join(f"WHEN {k} THEN {s}" for k, (s, _) in DIRT.items())
    return table(spark, sf, "orders").select("o_orderkey", F.expr(f"CASE o_orderkey % 7 {branches} END").alias("given"))


TEXTS = f"texts AS (SELECT o_orderkey, CASE o_orderkey % 7 {' '.join(f'WHEN {k} THEN {d}' for k, (_, d) in DIRT.items())} END AS given FROM orders)"


def date_parse_strict(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(spark, sf).select("o_orderkey", parse_strict(F.col("given")).alias("day"))


def date_parse_flexible(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(spark, sf).select("o_orderkey", parse_flexible(F.col("given")).alias("day"), day_text(parse_flexible(F.col("given"))).alias("day_text"))


def value_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return R.value_frequency(table(spark, sf, "orders"), "o_orderpriority", F.col("o_orderkey"))


def monthly_total(spark: SparkSession, sf: str) -> DataFrame:
    return A.monthly_counts(_dated(spark, sf))


def monthly_by_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return A.monthly_counts(_dated(spark, sf), ["solution"])


def monthly_by_court(spark: SparkSession, sf: str) -> DataFrame:
    return A.monthly_counts(_dated(spark, sf), ["court"])


def monthly_court_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return A.monthly_counts(_dated(spark, sf), ["court", "solution"])


def monthly_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    return A.monthly_levels(_dated(spark, sf), "court", "solution")


def court_month_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """The dense grid, with the courts' order by total."""
    rows = _dated(spark, sf)
    order = R.value_frequency(rows, "court", F.col("id")).select("court", F.col("rank").alias("court_rank"))
    return A.monthly_counts(rows, ["court"]).join(order, "court")


def _population(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension that lacks every seventh nation: balances stand in for people."""
    customer, nation, region = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    people = customer.groupBy("c_nationkey").agg((F.count(F.lit(1)) * 1000).alias("population"))
    rows = nation.join(people, F.col("n_nationkey") == F.col("c_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey")).where(F.col("n_nationkey") % 7 != 6)
    return rows.select(F.col("n_name").alias("court"), F.col("r_name").alias("jurisdiction"), "population", F.col("r_name").alias("locality"), F.col("n_nationkey").cast("double").alias("lat"), (F.col("n_nationkey") * 2).cast("double").alias("lon"), F.col("n_nationkey").alias("ord"))


POPULATION = """population AS (
  SELECT n_name AS court, r_name AS jurisdiction, p.population, r_name AS locality, CAST(n_nationkey AS DOUBLE) AS lat, CAST(n_nationkey * 2 AS DOUBLE) AS lon, n_nationkey AS ord
  FROM nation JOIN (SELECT c_nationkey, count(*) * 1000 AS population FROM customer GROUP BY 1) p ON n_nationkey = c_nationkey JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 7 <> 6
), counts AS (SELECT court, count(*) AS cases FROM cases WHERE receipt IS NOT NULL GROUP BY court)"""


def _court_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _dated(spark, sf).groupBy("court").agg(F.count(F.lit(1)).alias("cases"))


def per_capita(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.per_capita(_court_counts(spark, sf), _population(spark, sf), "court")
    return rows.withColumn("cases_per_10k", F.round("cases_per_10k", 6))


def locality_rollup(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.by_locality(_population(spark, sf), _court_counts(spark, sf), "court")
    scaled_rows = A.with_scale(rows, "cases", 120.0, 2720.0, "size")
    return scaled_rows.withColumn("size", F.round("size", 6))


def locality_per_capita(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.with_locality_rate(A.by_locality(_population(spark, sf), _court_counts(spark, sf), "court"))
    return rows.select("locality", "lat", "lon", "cases", "population", F.round("per_10k", 6).alias("per_10k"))


def avg_processing_days(spark: SparkSession, sf: str) -> DataFrame:
    decided = table(spark, sf, "lineitem").select(F.col("l_orderkey"), F.col("l_shipdate").cast("date").alias("decided"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("receipt")).join(decided, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return A.mean_days(rows, "receipt", "decided").withColumn("avg_processing_days", F.round("avg_processing_days", 6))


def result_pages(spark: SparkSession, sf: str) -> DataFrame:
    counts = _court_counts(spark, sf)
    return counts.select("court", "cases", pages_of(F.col("cases")).alias("pages"))


def outcome_scale(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by outcome on a scale from 0.25 to 1."""
    counts = _dated(spark, sf).groupBy("solution").agg(F.count(F.lit(1)).alias("n"))
    return A.with_scale(counts, "n", 0.25, 1.0, "shade").withColumn("shade", F.round("shade", 6))


def unparsed_dates(spark: SparkSession, sf: str) -> DataFrame:
    rows = _texts(spark, sf).withColumn("given", F.when(F.col("given") != "nan", F.col("given"))).withColumn("day", parse_strict(F.col("given")))
    return A.unparsed_counts(rows, "given", "day")


def court_panels(spark: SparkSession, sf: str) -> DataFrame:
    order = R.value_frequency(_dated(spark, sf), "court", F.col("id"))
    return order.select("court", "rank", A.panel_index(F.col("rank")).alias("at")).select("court", "rank", F.col("at.row").alias("panel_row"), F.col("at.column").alias("panel_column"))


def month_ticks(spark: SparkSession, sf: str) -> DataFrame:
    return A.month_ticks(A.month_spine(_dated(spark, sf)))


QUERIES = {
    f.__name__: f
    for f in (
        latest_per_key, outcome_summary, date_parse_strict, date_parse_flexible, value_frequency, monthly_total, monthly_by_outcome,
        monthly_by_court, monthly_court_outcome, monthly_grouping_sets, court_month_matrix, per_capita, locality_rollup,
        locality_per_capita, avg_processing_days, result_pages, outcome_scale, unparsed_dates, court_panels, month_ticks,
    )
}

ORACLE_SQL = {
    "latest_per_key": "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS receipt, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC NULLS LAST, o_orderkey DESC) = 1",
    "outcome_summary": f"""WITH {CASES}, latest AS (
  SELECT * FROM cases QUALIFY row_number() OVER (PARTITION BY case_number ORDER BY receipt DESC NULLS LAST, id DESC) = 1)
SELECT {LABELLED} AS solution, count(*) AS number_of_cases, count(*) FILTER (WHERE id IN (SELECT l_orderkey FROM lineitem)) AS cases_with_decision_link,
  count(DISTINCT court) AS unique_courts, strftime(min(receipt), '%d.%m.%Y') AS first_occurrence, strftime(max(receipt), '%d.%m.%Y') AS last_occurrence
FROM latest GROUP BY 1""",
    "date_parse_strict": f"WITH {TEXTS} SELECT o_orderkey, CAST(try_strptime(trim(given), '%d.%m.%Y') AS DATE) AS day FROM texts",
    "date_parse_flexible": f"""WITH {TEXTS}, p AS (SELECT o_orderkey, CAST(try_strptime(trim(given), ['%d.%m.%Y', '%d/%m/%Y', '%d-%m-%Y', '%Y-%m-%d']) AS DATE) AS day FROM texts)
SELECT o_orderkey, day, strftime(day, '%d.%m.%Y') AS day_text FROM p""",
    "value_frequency": "SELECT o_orderpriority, n, row_number() OVER (ORDER BY n DESC, f, o_orderpriority) AS rank FROM (SELECT o_orderpriority, count(*) AS n, min(o_orderkey) AS f FROM orders GROUP BY 1)",
    "monthly_total": f"WITH {CASES}, {SPINE} SELECT spine.month, count(dated.id) AS n FROM spine LEFT JOIN dated USING (month) GROUP BY 1",
    "monthly_by_outcome": f"WITH {CASES}, {SPINE}, g AS (SELECT DISTINCT outcome FROM dated) SELECT g.outcome AS solution, spine.month, count(d.id) AS n FROM g CROSS JOIN spine LEFT JOIN dated d ON d.month = spine.month AND d.outcome = g.outcome GROUP BY 1, 2",
    "monthly_by_court": f"WITH {CASES}, {SPINE}, g AS (SELECT DISTINCT court FROM dated) SELECT g.court, spine.month, count(d.id) AS n FROM g CROSS JOIN spine LEFT JOIN dated d ON d.month = spine.month AND d.court = g.court GROUP BY 1, 2",
    "monthly_court_outcome": f"WITH {CASES}, {SPINE}, g AS (SELECT DISTINCT court, outcome FROM dated) SELECT g.court, g.outcome AS solution, spine.month, count(d.id) AS n FROM g CROSS JOIN spine LEFT JOIN dated d ON d.month = spine.month AND d.court = g.court AND d.outcome = g.outcome GROUP BY 1, 2, 3",
    "monthly_grouping_sets": f"""WITH {CASES}, {SPINE} SELECT CASE WHEN grouping(court) = 0 AND grouping(outcome) = 0 THEN 'court_outcome' WHEN grouping(court) = 0 THEN 'court' WHEN grouping(outcome) = 0 THEN 'outcome' ELSE 'total' END AS level,
  court, outcome AS solution, month, count(*) AS n FROM dated GROUP BY GROUPING SETS ((month), (outcome, month), (court, month), (court, outcome, month))""",
    "court_month_matrix": f"""WITH {CASES}, {SPINE}, g AS (SELECT court, row_number() OVER (ORDER BY count(*) DESC, min(id), court) AS court_rank FROM dated GROUP BY court)
SELECT g.court, spine.month, count(d.id) AS n, g.court_rank FROM g CROSS JOIN spine LEFT JOIN dated d ON d.month = spine.month AND d.court = g.court GROUP BY g.court, spine.month, g.court_rank""",
    "per_capita": f"""WITH {CASES}, {POPULATION} SELECT c.court, CASE WHEN p.court IS NULL THEN 'UNKNOWN' ELSE jurisdiction END AS jurisdiction, cases, CAST(population AS DOUBLE) AS population_est,
  round(10000.0::DOUBLE * cases / nullif(population, 0), 6) AS cases_per_10k FROM counts c LEFT JOIN population p USING (court)""",
    "locality_rollup": f"""WITH {CASES}, {POPULATION}, l AS (SELECT locality, CAST(coalesce(sum(cases), 0) AS BIGINT) AS cases, CAST(sum(population) AS BIGINT) AS population, min_by(lat, ord) AS lat, min_by(lon, ord) AS lon FROM population LEFT JOIN counts USING (court) GROUP BY 1)
SELECT *, round(120.0::DOUBLE + 2600.0::DOUBLE * (cases::DOUBLE / nullif((SELECT max(cases) FROM l), 0)::DOUBLE), 6) AS size FROM l""",
    "locality_per_capita": f"""WITH {CASES}, {POPULATION}, l AS (SELECT locality, CAST(coalesce(sum(cases), 0) AS BIGINT) AS cases, CAST(sum(population) AS BIGINT) AS population, min_by(lat, ord) AS lat, min_by(lon, ord) AS lon FROM population LEFT JOIN counts USING (court) GROUP BY 1)
SELECT *, round(10000.0::DOUBLE * cases / population, 6) AS per_10k FROM l WHERE population > 0""",
    "avg_processing_days": """WITH dated AS (SELECT CAST(o_orderdate AS DATE) AS receipt, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(l_shipdate AS DATE) AS decided FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderdate IS NOT NULL),
spine AS (SELECT CAST(unnest(generate_series((SELECT min(month) FROM dated), (SELECT max(month) FROM dated), INTERVAL 1 MONTH)) AS DATE) AS month),
m AS (SELECT month, avg(decided - receipt) AS a, count(*) AS n FROM dated WHERE decided - receipt >= 0 GROUP BY 1)
SELECT month, round(a, 6) AS avg_processing_days, coalesce(n, 0) AS n FROM spine LEFT JOIN m USING (month)""",
    "unparsed_dates": f"WITH {TEXTS}, p AS (SELECT nullif(given, 'nan') AS given, try_strptime(trim(given), '%d.%m.%Y') AS day FROM texts) SELECT count(*) AS rows, count(*) FILTER (WHERE day IS NULL) AS without_date, count(*) FILTER (WHERE day IS NULL AND given IS NOT NULL) AS unparsed FROM p",
    "court_panels": f"WITH {CASES}, {SPINE}, g AS (SELECT court, row_number() OVER (ORDER BY count(*) DESC, min(id), court) AS rank FROM dated GROUP BY court) SELECT court, rank, (rank - 1) // 3 AS panel_row, (rank - 1) % 3 AS panel_column FROM g",
    "month_ticks": f"WITH {CASES}, {SPINE}, i AS (SELECT month, row_number() OVER (ORDER BY month) - 1 AS k, count(*) OVER () AS n FROM spine) SELECT month, strftime(month, '%b %y') AS label FROM i WHERE k % greatest(n // 15, 1) = 0",
    "result_pages": f"WITH {CASES}, {POPULATION} SELECT court, cases, CAST(greatest(ceil(cases / 25.0), 1) AS INTEGER) AS pages FROM counts",
    "outcome_scale": f"WITH {CASES}, c AS (SELECT {LABELLED} AS solution, count(*) AS n FROM cases WHERE receipt IS NOT NULL GROUP BY 1) SELECT solution, n, round(0.25::DOUBLE + 0.75::DOUBLE * (n::DOUBLE / (SELECT max(n) FROM c)::DOUBLE), 6) AS shade FROM c",
}
