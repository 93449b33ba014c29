"""Queries over the dimension of courts, and over the small rules that others do not use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.functions import dates as D
from docketlake.functions import text as T
from docketlake.operators import analytics as A
from docketlake.operators import relational as R
from docketlake.operators import translate as TR
from docketlake.plans.files import scratch
from docketlake.plans.texts import LINES, PARAGRAPHS, _cut, _lines, _packed, _sentences_of, ENDS
from docketlake.sources import readers, sinks
from docketlake.sources.dimensions import COURTS, courts
from docketlake.sources.readers import table

#: Courts that cases are dealt out to: those of the dimension and two that it lacks.
DEALT = len(COURTS) + 2


def _cases(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as cases of the dimension's courts, by customer, and of two others."""
    at = F.col("o_custkey") % DEALT
    orders = table(spark, sf, "orders").select("o_orderkey", at.alias("ord"))
    names = courts(spark).select(F.col("ord").alias("_ord"), "court")
    named = orders.join(names, F.col("ord") == F.col("_ord"), "left")
    return named.select("o_orderkey", F.coalesce("court", F.concat(F.lit("Court "), F.col("ord").cast("string"))).alias("court"))


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    return _cases(spark, sf).groupBy("court").agg(F.count(F.lit(1)).alias("cases"))


VALUES = ", ".join(f"({i}, '{c}', '{j}', {p}, {lat}, {lon}, '{place}')" for i, (c, j, p, lat, lon, place) in enumerate(COURTS))
COUNTED = f"""d(ord, court, jurisdiction, population, lat, lon, locality) AS (VALUES {VALUES}),
counts AS (SELECT coalesce(d.court, 'Court ' || o_custkey % {DEALT}) AS court, count(*) AS cases FROM orders LEFT JOIN d ON d.ord = o_custkey % {DEALT} GROUP BY 1)"""


def courts_per_capita(spark: SparkSession, sf: str) -> DataFrame:
    """Rates of all courts with cases, ranked, written as one CSV table and read back."""
    rates = A.ranked_courts(A.per_capita(_counts(spark, sf), courts(spark), "court"), "court")
    folder = scratch(spark)
    sinks.write_csv(rates, folder, ["court", "jurisdiction", "cases", "population_est", "cases_per_10k", "place", "rate_place"], one_file=True)
    read = spark.read.csv(folder, header=True, schema="court string, jurisdiction string, cases long, population_est double, cases_per_10k double, place long, rate_place long")
    return read.withColumns({"cases_text": D.grouped_digits(F.col("cases")), "rate_text": D.one_decimal(F.col("cases_per_10k")), "cases_per_10k": F.round("cases_per_10k", 6)})


def court_localities(spark: SparkSession, sf: str) -> DataFrame:
    """Every locality of the dimension, with its cases, rate, places and how much a degree of latitude is stretched there."""
    rows = A.ranked_localities(A.by_locality(courts(spark), _counts(spark, sf), "court"))
    aspect = F.round(1 / F.cos(F.radians("lat")), 6)
    return rows.select("locality", "cases", "population", "lat", "lon", F.round("per_10k", 6).alias("per_10k"), "place", "rate_place", aspect.alias("aspect"))


def population_file(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as a dimension in a file, read with its schema; people counted by jurisdiction."""
    rows = table(spark, sf, "customer").select(F.col("c_name").alias("court_name"), F.col("c_mktsegment").alias("jurisdiction"), F.col("c_custkey").alias("population"), F.lit(47.5).alias("lat"), F.col("c_acctbal").alias("lon"), F.col("c_nationkey").cast("string").alias("locality"))
    folder = scratch(spark)
    sinks.write_csv(rows, folder)
    read = readers.population(spark, folder)
    return read.groupBy("jurisdiction").agg(F.count(F.lit(1)).alias("courts"), F.sum("population").alias("population"), F.countDistinct("locality").alias("localities"), F.round(F.max("lon"), 2).alias("lon"))


def date_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """What looks like a date, and what is one."""
    day = F.date_format("o_orderdate", "dd.MM.yyyy")
    given = F.expr("CASE o_orderkey % 5 WHEN 0 THEN concat(' ', day, ' ') WHEN 1 THEN '99.99.2025' WHEN 2 THEN substring(day, 2, 9) WHEN 3 THEN concat(day, '.') ELSE day END")
    rows = table(spark, sf, "orders").select("o_orderkey", day.alias("day")).select("o_orderkey", given.alias("given"))
    return rows.select("o_orderkey", D.looks_like_date(F.col("given")).alias("looks"), D.parse_strict(F.col("given")).isNotNull().alias("parses"))


def translated_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct values of those columns whose labels are listed, whatever their letters, through a translator."""
    part = table(spark, sf, "part")
    columns = R.present(part, ["p_type", "P_BRAND", "p_brand", "p_container"])
    values = R.distinct_values(part, columns).withColumn("needed", T.needs_translation(F.col("value"), None))
    done = TR.translate_values(values.where("needed"), str.upper, "value", None)
    return values.join(done, "value", "left").select("value", "needed", "en")


def _fails_at_times(text: str) -> str | None:
    """Lower case, but an answer only where the length is no multiple of 7."""
    return text.lower() if len(text) % 7 else None


def translated_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents chunk by chunk; chunks that fail stay as they are and are told of."""
    return TR.translate_documents(table(spark, sf, "documents"), _fails_at_times)


def long_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Every distinct paragraph by itself; one over the limit goes in pieces, and one of them that fails fails it all."""
    rows = _lines(spark, sf).where("k is not null").groupBy("k").agg(F.min("norm").alias("norm"))

    @F.pandas_udf("string")
    def translated(texts):
        return texts.map(lambda t: TR.translate_paragraph(_fails_at_times, t, 200))

    answer = translated("norm")
    return rows.select("k", F.replace(answer, F.lit(" "), F.lit("")).alias("en_without_blanks"))


def purged_cache(spark: SparkSession, sf: str) -> DataFrame:
    """A cache whose translations are still mostly vowels here and there, without those entries."""
    cache = _lines(spark, sf).where("k is not null").groupBy("k").agg(F.min("norm").alias("en"))
    return TR.without_untranslated(cache, "[aeiou]", 0.3)


def names_for_files(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned texts by length, and names with a suffix before the extension."""
    name = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("a.b/x"), F.col("doc_id").cast("string"), F.lit(".txt"))).otherwise(F.concat(F.lit("a.b/x"), F.col("doc_id").cast("string")))
    return table(spark, sf, "documents").select("doc_id", F.length(T.clean(F.col("text"))).alias("chars"), T.with_stem_suffix(name, "_EN").alias("name"))


QUERIES = {
    f.__name__: f
    for f in (courts_per_capita, court_localities, population_file, date_shapes, translated_columns, translated_documents, long_paragraphs, purged_cache, names_for_files)
}

WHITE = r"[\s\x0B\x1c-\x1f\x85\p{Z}]"
ORACLE_SQL = {
    "courts_per_capita": f"""WITH {COUNTED}, r AS (SELECT c.court, coalesce(d.jurisdiction, 'UNKNOWN') AS jurisdiction, cases, CAST(population AS DOUBLE) AS population_est, 10000.0::DOUBLE * cases / population AS rate FROM counts c LEFT JOIN d USING (court))
SELECT court, jurisdiction, cases, population_est, round(rate, 6) AS cases_per_10k, row_number() OVER (ORDER BY cases DESC, court) AS place, row_number() OVER (ORDER BY rate NULLS LAST, court) AS rate_place, format('{{:,}}', cases) AS cases_text, CASE WHEN rate IS NOT NULL THEN printf('%.1f', rate) END AS rate_text FROM r""",
    "court_localities": f"""WITH {COUNTED}, l AS (SELECT locality, CAST(coalesce(sum(cases), 0) AS BIGINT) AS cases, CAST(sum(population) AS BIGINT) AS population, CAST(min_by(lat, ord) AS DOUBLE) AS lat, CAST(min_by(lon, ord) AS DOUBLE) AS lon FROM d LEFT JOIN counts USING (court) GROUP BY 1)
SELECT locality, cases, population, lat, lon, round(10000.0::DOUBLE * cases / population, 6) AS per_10k, row_number() OVER (ORDER BY cases DESC, locality) AS place, row_number() OVER (ORDER BY cases::DOUBLE / population DESC, locality) AS rate_place, round(1 / cos(radians(lat)), 6) AS aspect FROM l""",
    "population_file": "SELECT c_mktsegment AS jurisdiction, count(*) AS courts, CAST(sum(c_custkey) AS BIGINT) AS population, count(DISTINCT c_nationkey) AS localities, round(max(c_acctbal), 2) AS lon FROM customer GROUP BY 1",
    "date_shapes": "SELECT o_orderkey, o_orderkey % 5 IN (0, 1, 4) AS looks, o_orderkey % 5 IN (0, 4) OR (o_orderkey % 5 = 2 AND try_strptime(substr(strftime(o_orderdate, '%d.%m.%Y'), 2), '%d.%m.%Y') IS NOT NULL) AS parses FROM orders",
    "translated_columns": "WITH v AS (SELECT p_brand AS value FROM part UNION SELECT p_type FROM part) SELECT value, true AS needed, upper(value) AS en FROM v",
    "purged_cache": f"WITH {LINES} SELECT k, min(norm) AS en FROM lines WHERE k IS NOT NULL AND NOT (length(norm) - length(regexp_replace(norm, '[aeiou]', '', 'g')))::DOUBLE / greatest(length(norm), 1) > 0.3 GROUP BY k",
    "names_for_files": f"SELECT doc_id, CAST(length(coalesce(regexp_replace(regexp_replace(text, '{WHITE}+', ' ', 'g'), '^ | $', '', 'g'), '')) AS INTEGER) AS chars, CASE WHEN doc_id % 2 = 0 THEN 'a.b/x' || doc_id || '_EN.txt' ELSE 'a.b/x' || doc_id || '_EN' END AS name FROM documents",
}
#: Pieces of up to 200 characters of each distinct paragraph.
PIECES = f"""WITH RECURSIVE {LINES}, v AS (SELECT k AS d, min(norm) AS text FROM lines WHERE k IS NOT NULL GROUP BY k), s AS ({_sentences_of('v', ENDS)}), u AS ({_cut('s', 200)}), {_packed('u', "' '", True, 200)}
SELECT d AS k, CASE WHEN length(min(v.text)) <= 200 THEN CASE WHEN length(min(v.text)) % 7 <> 0 THEN replace(lower(min(v.text)), ' ', '') END WHEN bool_and(length(piece) % 7 <> 0) THEN replace(lower(string_agg(piece, ' ' ORDER BY i)), ' ', '') END AS en_without_blanks FROM out JOIN v USING (d) GROUP BY d"""
ORACLE_SQL["long_paragraphs"] = PIECES
ORACLE_SQL["translated_documents"] = f"""WITH x AS ({PARAGRAPHS}), t AS (SELECT doc_id, string_agg(CASE WHEN length(chunk) % 7 = 0 THEN chunk ELSE lower(chunk) END, chr(10) ORDER BY pos) AS en, bool_and(length(chunk) % 7 <> 0) AS complete FROM x GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN coalesce(regexp_matches(d.text, '[^\\s\\x0B\\x1c-\\x1f\\x85\\p{{Z}}]'), false) THEN t.en END AS en, CASE WHEN coalesce(regexp_matches(d.text, '[^\\s\\x0B\\x1c-\\x1f\\x85\\p{{Z}}]'), false) THEN t.complete ELSE true END AS complete FROM documents d LEFT JOIN t USING (doc_id)"""
