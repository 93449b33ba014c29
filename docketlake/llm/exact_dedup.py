"""Exact deduplication of texts (operator 1)."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm.common import build_sieve, fresh, narrow, one_of_each, settled, ship, table, text_bytes
from docketlake.llm.cqf import CountingQuotientFilter

WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"

DIGEST = "doc_id long, fp long, sha binary, n_points long"
_DIGEST_ARROW = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("sha", pa.binary()), ("n_points", pa.int64())])


def _digest_columns(batch: pa.RecordBatch) -> tuple[list, list[bytes]]:
    texts = text_bytes(batch.column(1))
    bare = [t.translate(None, WHITE) for t in texts]
    shas = [hashlib.sha256(t).digest() for t in bare]
    fps = np.frombuffer(b"".join(s[:8] for s in shas), dtype="<i8")
    points = [len(t.decode("utf-8", "replace")) for t in texts]
    return [batch.column(0), pa.array(fps), pa.array(shas, pa.binary()), pa.array(points, pa.int64())], bare


def _digests(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(_digest_columns(batch)[0], schema=_DIGEST_ARROW)


def _partition_filters(block_bits: int):
    """Builds one filter of a partition's fingerprints and cuts it into blocks of the fingerprint space."""

    def build(batches):
        fps = [np.asarray(b.column(0)).astype(np.int64).view(np.uint64) for b in batches if b.num_rows]
        if not fps:
            return
        found, counts = CountingQuotientFilter.of(np.concatenate(fps)).read()
        block = (found >> np.uint64(64 - block_bits)).astype(np.int64)
        heads = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        for a, b in zip(heads, np.r_[heads[1:], len(block)], strict=True):
            part = CountingQuotientFilter.of(found[a:b] << np.uint64(block_bits), counts[a:b])
            yield pa.RecordBatch.from_arrays([pa.array([int(block[a])], pa.int64()), pa.array([part.to_bytes()], pa.binary())], ["block", "filter"])

    return build


def _merge_blocks(block_bits: int):
    """Merges the partial filters of each block; yields the fingerprints counted more than once."""

    def merge(batches):
        waiting: dict[int, list[CountingQuotientFilter]] = defaultdict(list)
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                waiting[block].append(CountingQuotientFilter.from_bytes(data))
                if len(waiting[block]) >= 16:
                    waiting[block] = [CountingQuotientFilter.merge(waiting[block])]
        for block, parts in waiting.items():
            found, counts = CountingQuotientFilter.merge(parts).read()
            many = counts > 1
            fp = (found[many] >> np.uint64(block_bits)) | (np.uint64(block) << np.uint64(64 - block_bits))
            yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(counts[many])], ["fp", "n"])

    return merge


def repeated_fingerprints(digests: DataFrame) -> DataFrame:
    """``fp, n``: the fingerprints of more than one row, out of merged counting quotient filters."""
    partitions = int(digests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block_bits = max(6, (4 * partitions - 1).bit_length())
    blocks = digests.select("fp").mapInArrow(_partition_filters(block_bits), "block long, filter binary")
    return blocks.repartition(partitions, "block").mapInArrow(_merge_blocks(block_bits), "fp long, n long")


def dedup_groups(docs: DataFrame) -> DataFrame:
    """One row for each document: ``doc_id, keep_id, group_size, kept, text_sha256, n_points``.

    Two texts are equal if they are identical without the characters of ``[\\x20\\x09-\\x0D]``; null counts as the
    empty text, and all empty texts are one group. The row with the most code points in the original text stays,
    then the one with the smallest doc_id; a null doc_id comes after all others. Rows that repeat both doc_id and
    text are rows of the group like any other and share the fate of their doc_id. Extra columns are ignored.

    Fingerprints (64 bits of the SHA-256) go into a counting quotient filter for each partition; the merged
    filters name the fingerprints with a count above one. Only rows with such a fingerprint are compared byte by
    byte: least and greatest normalised text of each group must be the same. A sieve of fixed size routes them, so
    that a few unique rows may be verified too, without effect.
    """
    ship(docs.sparkSession)
    plain = narrow(docs, doc_id="long", text="string")
    digests = settled(plain.mapInArrow(_digests, DIGEST))
    sieve = docs.sparkSession.sparkContext.broadcast(build_sieve(repeated_fingerprints(digests), "fp"))

    def routed(batches):
        schema = pa.schema([*_DIGEST_ARROW, ("bare", pa.binary())])
        for batch in batches:
            columns, bare = _digest_columns(batch)
            hit = sieve.value.maybe(np.asarray(columns[1]))
            rows = pa.RecordBatch.from_arrays([*columns, pa.array([t if h else None for t, h in zip(bare, hit, strict=True)], pa.binary())], schema=schema)
            yield rows.filter(pa.array(hit))

    best = F.min(F.struct((-F.col("n_points")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("keep_id"))).alias("best")
    groups = (
        plain.mapInArrow(routed, DIGEST + ", bare binary")
        .groupBy("sha")
        .agg(F.count(F.lit(1)).alias("n"), best, F.min("bare").alias("low"), F.max("bare").alias("high"))
        .where(F.col("n") > 1)
        .select(
            F.lower(F.hex("sha")).alias("text_sha256"),
            F.when(F.col("low") == F.col("high"), F.col("n")).otherwise(F.raise_error(F.lit("two texts share a SHA-256")).cast("long")).alias("group_size"),
            F.col("best.keep_id").alias("keep_id"),
            (-F.col("best.a")).alias("keep_points"),
            F.lit(True).alias("found"),
        )
    )
    keep_id = F.when(F.col("found"), F.col("keep_id")).otherwise(F.col("doc_id"))
    # Joined by a key that neither side is dealt out by: both are shuffled then, and Spark can split a hot group.
    return digests.withColumn("text_sha256", F.lower(F.hex("sha"))).join(groups, "text_sha256", "left").select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("found").isNull() | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points")))).alias("kept"),
        "text_sha256",
        "n_points",
    )


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_groups(table(spark, sf_dir, "documents"))


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept.

    Of rows that repeat both doc_id and text one stays. Text that is null stays null.
    """
    doc, sha, points, own_sha, own_points = fresh(docs, "doc", "sha", "points", "key_sha", "key_points")
    groups = settled(dedup_groups(docs).select(F.col("doc_id").alias(doc), F.col("text_sha256").alias(sha), F.col("n_points").alias(points), F.col("kept").alias("kept")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = docs.withColumns({own_sha: F.sha2(F.translate(text, WHITE.decode(), ""), 256), own_points: F.length(text).cast("long")})
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own_sha) == F.col(sha)) & (F.col(own_points) == F.col(points))
    left = marked.join(groups.where(~F.col("kept")).drop("kept").distinct(), same, "left_anti")
    repeated = settled(groups.where("kept").groupBy(doc, sha, points).count().where("count > 1").drop("count"))
    return one_of_each(left, repeated, same, ["doc_id", own_sha]).drop(own_sha, own_points)


OP1_SQL = """
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS bare FROM documents
), g AS (
  SELECT doc_id, t, bare, count(*) OVER (PARTITION BY bare) AS group_size,
         first_value(doc_id) OVER (PARTITION BY bare ORDER BY length(t) DESC, doc_id) AS keep_id
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256, length(t) AS n_points FROM g
"""
