"""CSV files with unlike headers as one table: each row is read by the header of its own file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.functions.text import blank, strip
from docketlake.session import settled
from docketlake.sources.row_order import numbered_lines



def _name(uri: Column) -> Column:
    """The name of a file, out of its uri."""
    return F.url_decode(F.replace(F.regexp_extract(uri, r"([^/]+)$", 1), F.lit("+"), F.lit("%2B")))


class UnitedFiles:
    """ST-1, ST-2, ST-8, SNK-16: the rows of all CSV files in a folder, and what became of each file.

    The header of a file is its first line (line 0, wherever its splits begin). A row's values go by the names there;
    a name that its file lacks is null, of names that repeat the first counts, values beyond the header are dropped. The
    columns of the table are those of ``first``, in that order, then all others in the order in which they first appear, files
    by path. A file that is empty, cannot be read, or lacks a ``required`` column, is left out, and ``lineage`` says so.

    One pass over first lines finds the columns; rows are read in a second one, split as files are. A row is joined to
    its file's header, of which there is one for each file. Line ends inside quoted fields are not supported.
    """

    def __init__(self, spark: SparkSession, folder: str, required: Sequence[str] = (), first: Sequence[str] = ()):
        readable = spark.read.option("ignoreCorruptFiles", True)
        self.lines = numbered_lines(spark, folder, readable)
        heads = settled(self.lines.where("line = 0").select("file", F.ltrim(F.col("value"), F.lit("﻿")).alias("value")))
        self.width = max(1, heads.agg(F.max(F.size(F.split("value", ",")))).first()[0] or 0)
        names = F.transform(self._cells("value"), strip)
        heads = heads.select("file", F.slice(names, 1, F.size(F.filter(names, F.isnotnull))).alias("names"))
        lacking = F.array_except(F.array(*[F.lit(c) for c in required]).cast("array<string>"), "names")
        self.heads = settled(heads.withColumn("missing", lacking))
        good = self.heads.where(F.size("missing") == 0)
        seen = good.select("file", F.posexplode("names").alias("at", "name")).where(~blank(F.col("name"))).groupBy("name").agg(F.min(F.struct("file", "at")).alias("at"))
        found = [r.name for r in seen.orderBy("at").collect()]
        self.columns = [*first, *[c for c in found if c not in first]]
        # Scans leave empty files out, the listing does not.
        listed = [(f,) for f in spark.read.text(folder).inputFiles()]
        lengths = spark.read.format("binaryFile").load(folder).select(_name(F.col("_metadata.file_path")).alias("_path"), "length")
        names = spark.createDataFrame(listed, "file string").select(_name(F.col("file")).alias("file"))
        self.files = names.join(lengths, F.col("file") == F.col("_path"), "left").select("file", F.coalesce("length", F.lit(0)).alias("length"))

    def _cells(self, line: str) -> Column:
        """The cells of a line, as many as the widest header may have; null beyond its end."""
        row = F.from_csv(line, ", ".join(f"c{i} string" for i in range(self.width)), {"escape": '"', "maxColumns": str(self.width + 20480)})
        return F.array(*[row[f"c{i}"] for i in range(self.width)])

    def rows(self, tag: str | None = None, pattern: str = r"([^_/]+?)(\.\d+)?\.csv$") -> DataFrame:
        """All rows as text; ``tag`` names a column with what ``pattern`` finds in the path."""
        body = self.lines.where("line > 0").where(~blank(F.col("value"))).join(self.heads.where(F.size("missing") == 0).select("file", "names"), "file")
        body = body.select("file", "names", self._cells("value").alias("cells"))
        value = lambda c: F.get("cells", (F.array_position("names", F.lit(c)) - 1).cast("int"))
        columns = [value(c).alias(c) for c in self.columns if c != tag]
        return body.select(*columns, *([F.regexp_extract("file", pattern, 1).alias(tag)] if tag else []))

    def lineage(self) -> DataFrame:
        """``file, status, rows``: ``read``, ``empty``, ``unreadable`` or ``missing`` with the columns that it lacks."""
        counts = self.lines.where("line > 0").where(~blank(F.col("value"))).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
        heads = self.heads.join(counts, "file", "left").select(_name(F.col("file")).alias("_file"), "missing", "n")
        status = F.when(F.col("length") == 0, "empty").when(F.col("missing").isNull(), "unreadable").when(F.size("missing") > 0, F.concat(F.lit("missing "), F.array_join("missing", ", "))).otherwise("read")
        return self.files.join(heads, F.col("file") == F.col("_file"), "left").select("file", status.alias("status"), F.when(status == "read", F.coalesce("n", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("rows"))
