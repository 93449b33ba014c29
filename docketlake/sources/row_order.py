"""The order that rows have in their files, as numbers that do not depend on how files are split among tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from docketlake.operators.ordering import running_total


def _split_rows(scan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of a file scan with split and place, and the splits: ``_file, _block, _n, _first``."""
    rows = scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    return rows, rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))


def _joined(scan: DataFrame, rows: DataFrame, splits: DataFrame, name: str, file: str | None) -> DataFrame:
    number = (F.col("_before") + F.col("_at") - F.col("_first")).cast("long").alias(name)
    found = rows.join(splits, ["_file", "_block"])
    return found.select(*scan.columns, *([F.col("_file").alias(file)] if file else []), number)


def with_file_rows(scan: DataFrame, name: str = "row", file: str = "file") -> DataFrame:
    """The rows of a scan with their file and their number in it, from 0 on.

    ``scan`` reads files directly, with no other step between. A task reads its splits from front to back: the first
    pass counts the rows of each split of a file (file and start of block), the second numbers each row by its place in
    its split and what stands before that. Only the table of splits is grouped, not the rows.
    """
    rows, splits = _split_rows(scan)
    before = F.sum("_n").over(Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    return _joined(scan, rows, splits.withColumn("_before", F.coalesce(before, F.lit(0))), name, file)


def with_row_numbers(scan: DataFrame, name: str = "row") -> DataFrame:
    """WN-5: the rows of a scan with a dense number from 0 on, through all files by path.

    As ``with_file_rows``, and the counts of splits are added up over ranges of (file, block).
    """
    rows, splits = _split_rows(scan)
    return _joined(scan, rows, running_total(splits, [F.col("_file"), F.col("_block")], "_n", "_before"), name, None)


def numbered_lines(spark: SparkSession, path: str, reader: DataFrameReader | None = None) -> DataFrame:
    """``value, file, line``: the lines of text files, each with its number in its file, from 0 on."""
    return with_file_rows((reader or spark.read).text(path), "line")
