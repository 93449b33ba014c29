"""Sources: explicit schemas, tolerant readers, checked columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketlake.functions.text import blank, strip
from docketlake.sources.row_order import numbered_lines

CASES = T.StructType([T.StructField(c, T.StringType()) for c in ("case_number", "case_link", "date_of_receipt", "judge", "decision_date", "solution", "entry_into_force_date", "judicial_acts_link")] + [T.StructField("source_page", T.IntegerType())])
CHECKPOINT = "url string, opinion_text string, error string, fetched_at string"
CACHE = "k string, ru string, en string"
POPULATION = "court_name string, jurisdiction string, population long, lat double, lon double, locality string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def case_list(spark: SparkSession, path: str, schema=CASES, quoted_newlines: bool = False) -> DataFrame:
    """SRC-3: per-court CSV files (a byte order mark and CRLF do no harm), empty fields being null.

    Files are split among tasks. Where fields may hold line ends ``quoted_newlines`` reads each file in one task.
    """
    return spark.read.schema(schema).csv(path, header=True, multiLine=quoted_newlines, escape='"', enforceSchema=False)


def court_of_file() -> Column:
    """The last part of a file's name, without the number that a court of several files has."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"([^_]+?)(\.\d+)?\.csv$", 1)


def case_lists_with_court(spark: SparkSession, path: str, schema=CASES) -> DataFrame:
    """ST-1: the same with ``court_name`` out of the file name."""
    return case_list(spark, path, schema).select("*", court_of_file().alias("court_name"))


def string_table(spark: SparkSession, path: str, required: Sequence[str] = (), any_of: Sequence[str] = (), quoted_newlines: bool = True) -> DataFrame:
    """SRC-2, SRC-4, SRC-5: all columns as text; fails if a required one, or all of the alternatives, are missing.

    Texts hold line ends, so that each file is read in one task; without ``quoted_newlines`` files are split.
    """
    df = spark.read.csv(path, header=True, multiLine=quoted_newlines, escape='"')
    missing = [c for c in required if c not in df.columns]
    if missing or (any_of and not set(any_of) & set(df.columns)):
        raise ValueError(f"{path}: missing {missing or list(any_of)}; there are {df.columns}")
    return df


def court_list(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: ``base_url, notes``: columns found by part of their names, blank addresses left out."""
    df = spark.read.csv(path, header=True)
    url = next((c for c in df.columns if "url" in c.lower()), None)
    if url is None:
        raise ValueError(f"{path}: no column with 'url' in its name among {df.columns}")
    notes = next((c for c in df.columns if c != url and ("note" in c.lower() or "filter" in c.lower())), None)
    address = strip(F.col(f"`{url}`"))
    rows = df.select(address.alias("base_url"), (F.coalesce(strip(F.col(f"`{notes}`")), F.lit("")) if notes else F.lit("")).alias("notes"))
    return rows.where(~blank(F.col("base_url")) & (F.lower("base_url") != "nan"))


def checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-7: one JSON object a file; unreadable ones are left out."""
    rows = spark.read.schema(CHECKPOINT + ", _bad string").option("columnNameOfCorruptRecord", "_bad").json(folder, multiLine=True)
    return rows.where("url is not null and _bad is null").drop("_bad")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``record, file, line, bad``: JSON lines by their number in the file; ``bad`` marks what is no JSON object.

    Blank lines are left out. The order of lines does not depend on how files are split (``row_order``).
    """
    lines = numbered_lines(spark, path).where(~blank(F.col("value")))
    good = F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    return lines.select(F.when(good, F.from_json("value", schema)).alias("record"), "file", "line", (~good).alias("bad"))


def paragraph_cache(spark: SparkSession, path: str) -> DataFrame:
    """SRC-9: ``k, ru, en``: the last record of each key by file and line; torn lines, and records without key or translation, are left out."""
    rows = json_lines(spark, path, CACHE).where("not bad and record.k is not null and record.en is not null")
    last = F.max_by("record", F.struct("file", "line")).alias("r")
    return rows.groupBy(F.col("record.k").alias("k")).agg(last).select("k", "r.ru", "r.en")


def line_counts(rows: DataFrame) -> DataFrame:
    """SRC-9 on ``json_lines``: for each file its lines, those that are bad, and whether the last one is (a torn write)."""
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.count_if("bad").alias("bad"), F.max_by("bad", "line").alias("torn_tail"))


def whole_texts(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-10: ``path, text``: each file as one text."""
    return spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def population(spark: SparkSession, path: str) -> DataFrame:
    """SRC-11: the dimension of courts, with ``ord``, the order of its rows."""
    rows = spark.read.schema(POPULATION).csv(path, header=True)
    return rows.withColumn("ord", F.monotonically_increasing_id())


def outline(spark: SparkSession, path: str) -> DataFrame:
    """SRC-12, A-3: rings of a GeoJSON feature, or of a collection's first one: ``polygon, ring, xs, ys``."""
    geometry = "struct<type:string,coordinates:string>"
    schema = f"type string, geometry {geometry}, features array<struct<geometry:{geometry}>>"
    rows = spark.read.schema(schema).json(path, multiLine=True)
    one = rows.select(F.coalesce("geometry", F.get("features", F.lit(0))["geometry"]).alias("g"))
    rings = "array<array<array<double>>>"
    polygons = F.when(F.col("g.type") == "Polygon", F.array(F.from_json("g.coordinates", rings))).otherwise(F.from_json("g.coordinates", f"array<{rings}>"))
    flat = one.select(F.posexplode(polygons).alias("polygon", "rings")).select("polygon", F.posexplode("rings").alias("ring", "points"))
    return flat.select("polygon", "ring", F.transform("points", lambda p: p[0]).alias("xs"), F.transform("points", lambda p: p[1]).alias("ys"))
