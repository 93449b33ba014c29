"""Dates and numbers. Dates are DATE columns; nothing here depends on a time zone."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from docketlake.functions.text import strip

STRICT = "d.M.yyyy"
#: Tried in this order by the flexible parser; ISO dates are read as ISO dates.
FLEXIBLE = (STRICT, "d.M.yy", "d/M/yyyy", "d-M-yyyy", "yyyy-MM-dd", "d MMM yyyy", "d.M.yyyy H:mm")
NOT_DATES = ("nan", "NaT", "")


def _given(c: Column) -> Column:
    bare = strip(c)
    return F.when(~bare.isin(*NOT_DATES), bare)


def parse_strict(c: Column) -> Column:
    """D-2: day.month.year, else null."""
    return F.try_to_timestamp(_given(c), F.lit(STRICT)).cast("date")


def looks_like_date(c: Column) -> Column:
    """PF-19: two, two and four digits between points, whether or not there is such a day; false for null."""
    return F.coalesce(strip(c).rlike(r"\A[0-9]{2}\.[0-9]{2}\.[0-9]{4}\z"), F.lit(False))


def parse_flexible(c: Column) -> Column:
    """D-1: the first of the known formats that fits, else null."""
    return F.coalesce(*[F.try_to_timestamp(_given(c), F.lit(f)) for f in FLEXIBLE]).cast("date")


def month_of(c: Column) -> Column:
    """D-3."""
    return F.trunc(c, "month")


def day_text(c: Column) -> Column:
    """D-4."""
    return F.date_format(c, "dd.MM.yyyy")


def month_label(c: Column) -> Column:
    """D-7."""
    return F.date_format(c, "MMM yyyy")


def days_between(start: Column, end: Column) -> Column:
    """D-5."""
    return F.datediff(end, start)


def now_text() -> Column:
    """D-8."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")


def pages_of(results: Column, per_page: int = 25) -> Column:
    """M-1: pages that so many results fill, one at least."""
    return F.greatest(F.ceil(results / per_page).cast("int"), F.lit(1))


def per_10k(n: Column, population: Column) -> Column:
    """M-2: null without a population."""
    return F.try_divide(F.lit(10_000) * n.cast("double"), population.cast("double"))


def scaled(c: Column, greatest: Column, low: float, high: float) -> Column:
    """M-3: from ``low`` at 0 to ``high`` at the greatest value."""
    return F.lit(low) + F.lit(high - low) * F.try_divide(c.cast("double"), greatest.cast("double"))


def grouped_digits(c: Column) -> Column:
    """S-20: a whole number with commas between groups of three digits."""
    return F.format_number(c, 0)


def one_decimal(c: Column) -> Column:
    """S-20: one digit behind the point, halves to even as in the binary number's own value; no grouping.

    Java's formats round the shortest decimal that stands for the number, halves up: 0.25 to 0.3, and 0.35, which is a little less, to 0.4.
    """

    @F.pandas_udf("string")
    def said(values: pd.Series) -> pd.Series:
        return values.map("{:.1f}".format)

    return F.when(c.isNotNull(), said(c.cast("double")))
