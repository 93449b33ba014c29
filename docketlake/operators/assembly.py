"""Documents put together again as translations come in: only those that new entries complete are touched."""

from __future__ import annotations

import posixpath
import uuid

from pyarrow import fs as files
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.operators.corpus import reassembled
from docketlake.places import place_of
from docketlake.session import settled
from docketlake.streaming.versions import Versions

BUCKETS = 64


class Assembly:
    """IN-3, IN-4, J-6: a folder with the lines of all documents, an index of what they wait for, and what is translated.

    ``lines/bucket=<b>``: lines by hash of the document, those with a key without their text, which a translation replaces. ``index/bucket=<b>``: key and document, once each, by hash of the key.
    ``waiting``: for each document that is not complete the number of its keys without a translation, written
    anew as a version by each step. ``cache/part=<step>/bucket=<b>``: entries by hash of the key.

    A step reads the index only in the buckets of its new keys, takes what it finds there off the numbers, and reads the
    lines only in the buckets of those documents that come down to zero. A step that is repeated under its name replaces
    what it wrote before, and gives the same texts.
    """

    def __init__(self, spark: SparkSession, path: str, doc: str = "doc_id", doc_type: str = "long", buckets: int = BUCKETS):
        self.spark, self.path, self.doc, self.buckets = spark, path.rstrip("/"), doc, buckets
        self.waiting = Versions(spark, f"{self.path}/waiting")
        self.schemas = {"lines": f"`{doc}` {doc_type}, pos int, line string, k string", "index": f"k string, `{doc}` {doc_type}", "cache": "k string, en string, part string"}

    def _bucket(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.buckets)).cast("int")

    def _laid_out(self, df: DataFrame, by: str, place: str) -> None:
        df.withColumn("bucket", self._bucket(by)).repartition(self.buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{place}")

    def _in(self, place: str, keys: DataFrame, column: str) -> DataFrame:
        """The rows of a table in the buckets of some keys; which these are reaches the driver, at most one row a bucket."""
        touched = [r[0] for r in keys.select(self._bucket(column).alias("b")).distinct().collect()]
        return self._read(place).where(F.col("bucket").isin(touched)).drop("bucket")

    def _read(self, place: str) -> DataFrame:
        return self.spark.read.schema(f"{self.schemas[place]}, bucket int").parquet(f"{self.path}/{place}")

    def begin(self, lines: DataFrame) -> DataFrame:
        """Lays ``lines`` (``doc, pos, line, norm, k``) out; gives ``doc, text`` of documents that wait for nothing."""
        self._laid_out(lines.select(self.doc, "pos", F.when(F.col("k").isNull(), F.col("line")).alias("line"), "k"), self.doc, "lines")
        stored = self._read("lines")
        self._laid_out(stored.where("k is not null").select("k", self.doc).distinct(), "k", "index")
        counts = self._read("index").groupBy(self.doc).agg(F.count(F.lit(1)).alias("missing"))
        self.waiting.write(counts, "begin", 1)
        none = self.spark.createDataFrame([], "k string, en string")
        free = stored.where("k is null").drop("bucket").join(self.waiting.latest().select(self.doc), self.doc, "left_anti")
        return reassembled(free.withColumn("norm", F.col("k")), none, self.doc).select(self.doc, "text")

    def _staged(self, entries: DataFrame, step: str) -> DataFrame:
        """The entries by bucket, a row for each key, in a place of their own: they are computed and moved over the network once."""
        dealt = entries.where("k is not null and en is not null").select("k", "en", self._bucket("k").alias("bucket")).repartition(self.buckets, "bucket")
        dealt.groupBy("bucket", "k").agg(F.min("en").alias("en")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/staged/part={step}")
        return self._entries(f"staged/part={step}")

    def _entries(self, place: str) -> DataFrame:
        return self.spark.read.schema("k string, en string, bucket int").parquet(f"{self.path}/{place}").drop("bucket")

    def _move(self, place: str, to: str) -> None:
        """A folder takes the place of another."""
        system, root = place_of(self.path)
        old, new = posixpath.join(root, place), posixpath.join(root, to)
        if system.get_file_info(new).type == files.FileType.Directory:
            system.delete_dir(new)
        system.create_dir(posixpath.dirname(new), recursive=True)
        system.move(old, new)

    def add(self, entries: DataFrame, step: str | None = None) -> DataFrame:
        """Takes in ``entries`` (``k, en``) and gives ``doc, text`` of the documents that they complete.

        Keys that an earlier step has brought keep their first translation; of entries with one key the least counts.
        """
        step = f"step-{step or uuid.uuid4().hex}"
        given = self._staged(entries, step)
        before, seq = self.waiting.before(step)
        known = self._in("cache", given, "k").where(F.col("part") != step).select("k") if seq > 2 else None
        if known is not None and given.select("k").join(known, "k", "left_semi").limit(1).count():
            self._laid_out(settled(given.join(known, "k", "left_anti")), "k", f"cache/part={step}")
        else:
            self._move(f"staged/part={step}", f"cache/part={step}")
        given = self._entries(f"cache/part={step}")

        hits = self._in("index", given, "k").join(given.select("k"), "k", "left_semi").groupBy(self.doc).agg(F.count(F.lit(1)).alias("hits"))
        left = settled(before.join(hits, self.doc, "left").select(self.doc, (F.col("missing") - F.coalesce("hits", F.lit(0))).alias("missing")))
        self.waiting.write(left.where("missing > 0"), step, seq)

        ready = settled(left.where("missing = 0").select(self.doc))
        return self._texts(ready)

    def _texts(self, ready: DataFrame) -> DataFrame:
        """``doc, text`` of documents all of whose keys are translated."""
        lines = self._in("lines", ready, self.doc).join(ready, self.doc, "left_semi")
        wanted = settled(lines.where("k is not null").select("k").distinct())
        cache = self._in("cache", wanted, "k").select("k", "en").join(wanted, "k", "left_semi")
        return reassembled(lines.withColumn("norm", F.col("k")), cache, self.doc).select(self.doc, "text")

    def incomplete(self) -> DataFrame:
        """``doc, missing``: the documents that still wait, and for how many paragraphs."""
        return self.waiting.latest()
