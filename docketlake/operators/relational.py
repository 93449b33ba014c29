"""Rows by key: latest, first, distinct in order of appearance, pending, frequencies, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketlake.functions.dates import day_text
from docketlake.operators.ordering import numbered


def latest_per_key(df: DataFrame, keys: Sequence[str], date: Column, order: Column) -> DataFrame:
    """WN-1, ST-7: of each key the row with the latest date; unknown dates are oldest, later rows win ties.

    Null keys are one key. Spark keeps one row per key and partition before the shuffle (WindowGroupLimit).
    """
    w = Window.partitionBy(*keys).orderBy(date.desc_nulls_last(), order.desc())
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """WN-2: the first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def first_seen(df: DataFrame, key: Column, order: Column, name: str = "value") -> DataFrame:
    """WN-3, ST-6: distinct values with the position at which each first appears."""
    return df.select(key.alias(name), order.alias("_order")).groupBy(name).agg(F.min("_order").alias("first_seen"))


def first_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """SL-6, SL-7."""
    return df.orderBy(*order).limit(n)


def value_frequency(df: DataFrame, column: str, order: Column) -> DataFrame:
    """AG-2, WN-8: values with their counts and ranks, most frequent first; ties by first appearance, then value.

    Counts are made in parallel, and ranked by ranges of their order: no task sorts all distinct values.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seen"))
    ranked = numbered(counts, [F.col("n").desc(), F.col("first_seen"), F.col(f"`{column}`")], "rank")
    return ranked.select(column, "n", "rank")


def distinct_values(df: DataFrame, columns: Sequence[str], name: str = "value") -> DataFrame:
    """AG-12, ST-3: the distinct strings of several columns, nulls left out."""
    stacked = df.select(F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias(name))
    return stacked.where(F.col(name).isNotNull()).distinct()


def present(df: DataFrame, labels: Sequence[str]) -> list[str]:
    """PF-21: those of the labels that are columns of ``df``, by exact name, in the order of the columns."""
    return [c for c in df.columns if c in labels]


def pending(wanted: DataFrame, done: DataFrame, key: str, retry_failures: bool = False, error: str = "error") -> DataFrame:
    """J-4, J-5, IN-1: what is not done yet; with ``retry_failures`` also what ended in an error."""
    known = done.where(F.col(error).isNull()) if retry_failures else done
    return wanted.join(known.select(key).distinct(), key, "left_anti")


def with_lookup(df: DataFrame, table: DataFrame, key: str, value: str, name: str, default: Column | None = None) -> DataFrame:
    """J-1, J-2: a value looked up by key, else the default; every row stays. ``table`` has a row for each key."""
    small = table.select(F.col(key).alias("_key"), F.col(value).alias("_value"))
    found = df.join(small, F.col(key) == F.col("_key"), "left")
    return found.withColumn(name, F.coalesce("_value", default) if default is not None else F.col("_value")).drop("_key", "_value")


def last_wins(df: DataFrame, key: str, value: str, order: Column) -> DataFrame:
    """SRC-9: the value of each key's last record."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def tagged_union(frames: dict[str, DataFrame], tag: str = "court_name") -> DataFrame:
    """ST-1, ST-2: all rows, each with the name of the frame that it comes from; missing columns are null."""
    out = None
    for name, frame in frames.items():
        part = frame.withColumn(tag, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no frames to unite")
    return out


def ordered_columns(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """ST-8, SNK-16: the named columns in this order, then all others as they come."""
    have = [c for c in first if c in df.columns]
    return df.select(*have, *[c for c in df.columns if c not in first])


def outcome_summary(df: DataFrame, outcome: Column, has_link: Column, court: Column, date: Column) -> DataFrame:
    """AG-1: for each outcome cases, cases with a link, distinct courts, first and last date as text."""
    rows = df.select(outcome.alias("solution"), has_link.alias("_link"), court.alias("_court"), date.alias("_date"))
    return rows.groupBy("solution").agg(
        F.count(F.lit(1)).alias("number_of_cases"),
        F.count_if("_link").alias("cases_with_decision_link"),
        F.countDistinct("_court").alias("unique_courts"),
        day_text(F.min("_date")).alias("first_occurrence"),
        day_text(F.max("_date")).alias("last_occurrence"),
    )


def widths(df: DataFrame, least: int = 12, most: int = 55) -> DataFrame:
    """AG-19, SNK-5: for each column the longest text plus 2, held between the limits."""
    sizes = df.select(*[F.max(F.length(F.col(c).cast("string"))).alias(c) for c in df.columns])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in df.columns]))
    longest = F.greatest(F.coalesce(F.col("x.n"), F.lit(0)), F.length("x.column")) + 2
    return sizes.select(stacked.alias("x")).select("x.column", F.least(F.greatest(longest, F.lit(least)), F.lit(most)).alias("width"))
