"""Runs that can be taken up again: keyed state in buckets with Bloom filters, counters that batches carry on."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docketlake.session import settled
from docketlake.streaming.versions import Versions

#: Buckets of a state, bits of each bucket's Bloom filter, and bits that a key sets there.
BUCKETS, BITS, HASHES = 64, 1 << 20, 4


def _named(checkpoint: str) -> str:
    """A name for the batches of a stream: runs with one checkpoint number their batches on, others begin anew."""
    return hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:16]


class KeyedState:
    """IN-1, IN-2, SNK-8: rows by key in a folder, each key once, that stay cheap to add to as they grow.

    Rows lie by hash of their key: ``rows/part=<batch>/bucket=<b>``. Beside them each batch carries on a Bloom filter for each
    bucket, as a table of 64-bit words. A batch asks the filters first: what they do not know is new. Only the rest,
    which mostly is known, is joined with the state, and of that only buckets with such keys are read.

    A batch writes its filter before its rows, so that no key of the state is unknown to the filters, whenever a run is killed;
    both go to places that the batch's number names, so that a repeated batch replaces what it wrote before. When filters
    fill up (some 10 bits a key, 6.7 million keys here), more keys are joined; results stay the same.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS, bits: int = BITS):
        self.spark, self.path, self.key, self.buckets, self.bits = spark, path.rstrip("/"), key, buckets, bits
        self.filters = Versions(spark, f"{self.path}/filters")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _bits(self, rows: DataFrame, *columns: str) -> DataFrame:
        """A row for each bit of each key: ``_bucket, _at, _bit`` with ``columns``; ``_at`` is the word, ``_bit`` its mask."""
        slots = F.array(*[F.pmod(F.xxhash64(F.lit(i), F.col(self.key)), F.lit(self.bits)) for i in range(HASHES)])
        each = rows.select(*columns, self._bucket().alias("_bucket"), F.explode(slots).alias("_slot"))
        return each.select(*columns, "_bucket", F.shiftright("_slot", 6).alias("_at"), F.expr("shiftleft(1L, cast(_slot & 63 as int))").alias("_bit"))

    def rows(self, but: str | None = None, buckets: list[int] | None = None) -> DataFrame | None:
        """IN-3: all rows; without those of the batch ``but``, or only of some buckets."""
        if not self.filters.listed():
            return None
        try:
            found = self.spark.read.parquet(f"{self.path}/rows")
        except Exception as error:  # noqa: BLE001 - no batch has had a row yet
            if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
                return None
            raise
        if but is not None:
            found = found.where(F.col("part") != but)
        if buckets is not None:
            found = found.where(F.col("bucket").isin(buckets))
        return found.drop("part", "bucket")

    def unknown(self, rows: DataFrame, part: str) -> DataFrame:
        """Those of ``rows``, one for each key, whose key no other batch has put into the state."""
        before, _ = self.filters.before(part)
        if before is None:
            return rows
        words = before.select("_bucket", "_at", F.col("_bit").alias("_word"))
        met = self._bits(rows, self.key).join(words, ["_bucket", "_at"]).where(F.col("_word").bitwiseAND(F.col("_bit")) != 0)
        maybe = settled(met.groupBy(self.key, "_bucket").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == HASHES).select(self.key, "_bucket"))
        touched = [r[0] for r in maybe.select("_bucket").distinct().collect()]
        held = self.rows(part, touched) if touched else None
        if held is None:
            return rows
        known = maybe.join(held.select(self.key), self.key, "left_semi").select(self.key)
        return rows.join(known, self.key, "left_anti")

    def add(self, rows: DataFrame, part: str, work: Callable[[DataFrame], DataFrame] = lambda new: new) -> None:
        """Puts ``work`` of the rows with new keys into the state; null keys are left out, of rows with one key one counts."""
        keyed = rows.where(F.col(self.key).isNotNull()).dropDuplicates([self.key])
        new = settled(self.unknown(keyed, part))
        before, seq = self.filters.before(part)
        words = self._bits(new).groupBy("_bucket", "_at").agg(F.bit_or("_bit").alias("_bit"))
        if before is not None:
            words = words.unionByName(before).groupBy("_bucket", "_at").agg(F.bit_or("_bit").alias("_bit"))
        self.filters.write(words, part, seq)
        done = work(new).withColumn("bucket", self._bucket()).repartition(self.buckets, "bucket")
        done.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/rows/part={part}")


def process_new(source: DataFrame, key: str, state_path: str, checkpoint: str, work: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """IN-1, IN-2: each micro-batch leaves out the keys that the state has, works, and adds what is new.

    ``source`` is a stream; ``work`` maps the new rows to state rows with ``key``. See ``KeyedState``; a batch that is
    repeated after a failure gives no key twice.
    """
    state, name = KeyedState(source.sparkSession, state_path, key), _named(checkpoint)

    def batch(rows: DataFrame, number: int) -> None:
        state.add(rows, f"{name}-{number}", work)

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_state(spark: SparkSession, path: str, key: str) -> DataFrame | None:
    """IN-3: the state's rows, if there are any yet."""
    return KeyedState(spark, path, key).rows()


def counts_by(source: DataFrame, column: str, path: str, checkpoint: str) -> DataFrame:
    """AG-17: counts of a stream by a column, as a table once all that is there has been read.

    Each batch adds its counts to those of the batch before and writes them as a version of its own, in which a repeated
    batch replaces its first try. Nothing is kept in the driver's memory.
    """
    spark, name = source.sparkSession, _named(checkpoint)
    totals = Versions(spark, path)

    def batch(rows: DataFrame, number: int) -> None:
        part = f"{name}-{number}"
        counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        before, seq = totals.before(part)
        if before is not None:
            counts = counts.unionByName(before).groupBy(column).agg(F.sum("n").alias("n"))
        totals.write(counts, part, seq)

    source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    latest = totals.latest()
    return latest if latest is not None else spark.createDataFrame([], source.select(column, F.lit(0).cast("long").alias("n")).schema)
