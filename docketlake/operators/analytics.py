"""Monthly series, matrices, rates by population and place, processing times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.functions.dates import days_between, month_of, per_10k, scaled
from docketlake.operators.ordering import numbered
from docketlake.session import settled

UNKNOWN_PLACE = "UNKNOWN"


def with_month(df: DataFrame, date: str) -> DataFrame:
    """SRC-6, PF-5: rows with a known date, and its month."""
    return df.where(F.col(date).isNotNull()).withColumn("month", month_of(F.col(date)))


def month_spine(df: DataFrame) -> DataFrame:
    """D-6, AG-9: every month from the first to the last of ``df``; a few rows, however many it has."""
    ends = df.agg(F.min("month").alias("a"), F.max("month").alias("b")).where("a is not null")
    return ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))


def monthly_counts(df: DataFrame, dimensions: Sequence[str] = ()) -> DataFrame:
    """AG-3..5, J-10, J-11: counts by month and the dimensions; months without rows count 0.

    Only combinations of dimensions that occur get a series. The rows are counted once; the first and last month, the
    combinations and their grid of months all come from the counts.
    """
    counts = settled(df.groupBy(*dimensions, "month").agg(F.count(F.lit(1)).alias("n")))
    if not dimensions:
        return month_spine(counts).join(counts, "month", "left").select("month", F.coalesce("n", F.lit(0)).alias("n"))
    first, last = counts.agg(F.min("month")).scalar(), counts.agg(F.max("month")).scalar()
    grid = counts.select(*dimensions).distinct().select(*dimensions, F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month"))
    same = [F.col(f"g.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*dimensions, "month")]
    joined = grid.alias("g").join(counts.alias("c"), on=_all(same), how="left")
    return joined.select(*[F.col(f"g.{c}") for c in (*dimensions, "month")], F.coalesce("n", F.lit(0)).alias("n"))


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def monthly_levels(df: DataFrame, court: str, outcome: str) -> DataFrame:
    """AG-5: the total, by outcome, by court and by both, in one pass; ``level`` says which (null marks "all")."""
    sets = [["month"], [outcome, "month"], [court, "month"], [court, outcome, "month"]]
    of = lambda c: F.grouping(c) == 0
    level = F.when(of(court) & of(outcome), "court_outcome").when(of(court), "court").when(of(outcome), "outcome").otherwise("total")
    rows = df.groupingSets([[F.col(c) for c in s] for s in sets], court, outcome, "month")
    return rows.agg(level.alias("level"), F.count(F.lit(1)).alias("n")).select("level", court, outcome, "month", "n")


def per_capita(counts: DataFrame, population: DataFrame, court: str) -> DataFrame:
    """J-8, M-2: every court of the data; those without a population get the label and nulls.

    ``population``: a row for each court, ``court, jurisdiction, population``; as a dimension it is small by nature,
    and Spark broadcasts it only if its measured size allows.
    """
    known = population.select(F.col(court).alias("_court"), "jurisdiction", F.col("population").cast("double").alias("population_est"))
    rows = counts.join(known, F.col(court) == F.col("_court"), "left")
    return rows.select(
        court,
        F.when(F.col("_court").isNull(), UNKNOWN_PLACE).otherwise(F.col("jurisdiction")).alias("jurisdiction"),
        "cases",
        "population_est",
        per_10k(F.col("cases"), F.col("population_est")).alias("cases_per_10k"),
    )


def ranked_courts(rates: DataFrame, court: str) -> DataFrame:
    """SNK-14, SL-4: ``per_capita`` with ``place``, by cases, most first, and ``rate_place``, by rate, least first and unknown last.

    Of equals the court's name decides.
    """
    by_cases = numbered(rates, [F.col("cases").desc(), F.col(court)], "place")
    return numbered(by_cases, [F.col("cases_per_10k").asc_nulls_last(), F.col(court)], "rate_place")


def ranked_localities(localities: DataFrame) -> DataFrame:
    """SL-5: localities with ``place``, by cases, most first, and ``rate_place``, by rate, most first; without a rate there is none."""
    by_cases = numbered(localities, [F.col("cases").desc(), F.col("locality")], "place")
    rated = numbered(with_locality_rate(by_cases), [F.col("per_10k").desc(), F.col("locality")], "rate_place")
    return rated.unionByName(by_cases.where(per_10k(F.col("cases"), F.col("population")).isNull()), allowMissingColumns=True)


def by_locality(population: DataFrame, counts: DataFrame, court: str) -> DataFrame:
    """AG-7, J-9: every locality of the dimension; courts without cases count 0, their people count all the same.

    ``population`` also has ``locality, lat, lon, ord``; the place is that of the locality's first court.
    """
    known = counts.select(F.col(court).alias("_court"), F.col("cases").alias("_cases"))
    rows = population.join(known, F.col(court) == F.col("_court"), "left")
    return rows.groupBy("locality").agg(
        F.coalesce(F.sum("_cases"), F.lit(0)).cast("long").alias("cases"),
        F.sum("population").cast("long").alias("population"),
        F.min_by("lat", "ord").alias("lat"),
        F.min_by("lon", "ord").alias("lon"),
    )


def with_locality_rate(localities: DataFrame) -> DataFrame:
    """M-2 on localities; those without a rate are left out (SL-5)."""
    return localities.withColumn("per_10k", per_10k(F.col("cases"), F.col("population"))).where("per_10k is not null")


def with_scale(df: DataFrame, column: str, low: float, high: float, name: str) -> DataFrame:
    """AG-10, M-3: a value's place between 0 and the greatest one, as ``low`` to ``high``."""
    return df.withColumn(name, scaled(F.col(column), df.agg(F.max(column)).scalar(), low, high))


def mean_days(df: DataFrame, start: str, end: str) -> DataFrame:
    """AG-8, PF-8: mean days by the month of ``start``; unknown and negative spans do not count, empty months stay null."""
    dated = with_month(df, start)
    spans = dated.withColumn("_days", days_between(F.col(start), F.col(end))).where("_days >= 0")
    means = spans.groupBy("month").agg(F.avg("_days").alias("avg_processing_days"), F.count(F.lit(1)).alias("n"))
    return month_spine(dated).join(means, "month", "left").select("month", "avg_processing_days", F.coalesce("n", F.lit(0)).alias("n"))


def unparsed_counts(df: DataFrame, text: str, parsed: str) -> DataFrame:
    """AG-11: rows, rows without a date, and those whose text is no date."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(parsed).isNull()).alias("without_date"),
        F.count_if(F.col(parsed).isNull() & F.col(text).isNotNull()).alias("unparsed"),
    )


def panel_index(rank: Column, columns: int = 3) -> Column:
    """WN-6: row and column of the rank-th panel, from rank 1 on."""
    at = rank - 1
    return F.struct(F.floor(at / columns).cast("long").alias("row"), F.pmod(at, F.lit(columns)).cast("long").alias("column"))


def month_ticks(months: DataFrame, most: int = 15) -> DataFrame:
    """SL-9, D-7: about ``most`` of the months of a spine, evenly, with their labels."""
    n = months.agg(F.count(F.lit(1))).scalar()
    first = months.agg(F.min("month")).scalar()
    at = F.round(F.months_between("month", first)).cast("long")
    return months.where(F.pmod(at, F.greatest(F.floor(n / most), F.lit(1))) == 0).select("month", F.date_format("month", "MMM yy").alias("label"))


def map_aspect(latitude: float = 47.8) -> Column:
    """M-5: how much longer a degree of latitude is than one of longitude."""
    return 1 / F.cos(F.radians(F.lit(latitude)))
