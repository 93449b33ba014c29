"""Numbers in a total order without a single task: rows dealt out by ranges, counts carried from one range to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketlake.session import settled

#: ``monotonically_increasing_id`` has the place in the partition in these bits, the partition above them.
PLACE_BITS = 33


def _free(df: DataFrame, *names: str) -> list[str]:
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def _dealt(df: DataFrame, order: Sequence[Column], at: str) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return settled(rows.withColumn(at, F.monotonically_increasing_id()))


def numbered(df: DataFrame, order: Sequence[Column], name: str, first: int = 1) -> DataFrame:
    """``df`` with a dense number from ``first`` on, in the given order, which must be total (ties are numbered in any way).

    Rows are dealt out by ranges of the order and sorted in their ranges; the number of rows in each range, a row for
    each partition, says where the next one starts.
    """
    at, part, start = _free(df, "at", "part", "start")
    dealt = _dealt(df, order, at)
    sizes = dealt.groupBy(F.shiftright(at, PLACE_BITS).alias(part)).agg(F.count(F.lit(1)).alias(start))
    starts, total = [], first
    for pid, n in sorted(map(tuple, sizes.collect())):
        starts.append((pid, total))
        total += n
    known = F.broadcast(df.sparkSession.createDataFrame(starts, f"`{part}` long, `{start}` long"))
    rows = dealt.withColumn(part, F.shiftright(at, PLACE_BITS)).join(known, part)
    place = F.col(at).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(start) + place).alias(name))


def running_total(df: DataFrame, order: Sequence[Column], value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before each, in the given total order; null counts as 0.

    Sums run inside the ranges that rows are dealt out by; the total of each range reaches the driver.
    """
    at, part, start = _free(df, "at", "part", "start")
    dealt = _dealt(df, order, at)
    number = F.coalesce(F.col(f"`{value}`"), F.lit(0))
    totals = dealt.groupBy(F.shiftright(at, PLACE_BITS).alias(part)).agg(F.sum(number).alias(start))
    starts, total = [], 0
    for pid, n in sorted(map(tuple, totals.collect())):
        starts.append((pid, total))
        total += n
    known = F.broadcast(df.sparkSession.createDataFrame(starts, f"`{part}` long, `{start}` long"))
    before = F.sum(number).over(Window.partitionBy(part).orderBy(at).rowsBetween(Window.unboundedPreceding, -1))
    rows = dealt.withColumn(part, F.shiftright(at, PLACE_BITS)).withColumn(at, F.coalesce(before, F.lit(0))).join(known, part)
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(start) + F.col(at)).cast("long").alias(name))
