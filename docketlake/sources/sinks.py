"""Sinks. Inputs are never overwritten: every write has a path of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.functions.dates import now_text
from docketlake.functions.text import key_of


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, one_file: bool = False) -> bool:
    """SNK-7, SNK-14: a header and a fixed order of columns; nothing is written for no rows. ``case_files`` has files by court."""
    rows = df.select(*columns) if columns else df
    if rows.isEmpty():
        return False
    (rows.coalesce(1) if one_file else rows).write.csv(path, header=True, escape='"')
    return True


def write_table(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """SNK-6, SNK-10, SNK-13: Parquet, one folder for each value of the columns. ``workbook`` has workbooks."""
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)


def write_template(spark: SparkSession, path: str) -> None:
    """SNK-3: the court list to fill in."""
    spark.createDataFrame([("https://court.example/modules.php?name_op=r", "")], "base_url string, notes string").coalesce(1).write.csv(path, header=True)


def append_checkpoints(df: DataFrame, path: str) -> None:
    """SNK-4, SNK-8: ``url, opinion_text, error`` with its key and the time, appended."""
    df.select(key_of(F.col("url")).alias("key"), "url", "opinion_text", "error", now_text().alias("fetched_at")).write.mode("append").parquet(path)


def append_cache(df: DataFrame, path: str) -> None:
    """SNK-11, JS-1: JSON lines, letters outside ASCII as they are."""
    df.select("k", "ru", "en").write.mode("append").json(path)


def text_rows(df: DataFrame, path: str, text: str) -> DataFrame:
    """SNK-9, SNK-12: ``path, text``, one row for each file to write; ``case_files.write_texts`` writes them."""
    return df.select(F.col(path).alias("path"), F.col(text).alias("text")).groupBy("path").agg(F.min("text").alias("text"))
