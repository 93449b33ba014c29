"""The training-corpus pipeline: each stage works on all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm import byte_bpe, exact_dedup, jaccard_join, mixing, quality
from docketlake.llm.common import settled, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones among them, does not reject.

    Null and empty texts are judged by the bias; rows that repeat, and rows without an id, each by their text. No rows
    give none. All columns are kept.
    """
    return quality.good_documents(docs, quality.fit_on(docs, table(spark, sf_dir, "labels")))


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space.

    The longest text stays, of ties the least id, ids before null; of rows that repeat id and text one. Null and empty
    texts are one group. No rows give none. All columns are kept.
    """
    return exact_dedup.without_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingle similarity connects.

    The least id stays, ids before null, of ties the least hash of the text; of rows that repeat id and text one. Null
    and empty texts all stay. No rows give none. All columns are kept.
    """
    return jaccard_join.one_of_each_group(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, in documents; one that is taken repeatedly has a row for each pass.

    A null source is a source of its own. Null and empty texts give no row; rows that repeat id and text are taken
    together. No rows give none. All columns are kept, ``n_chars`` counted anew.
    """
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, and the digest of what they decode to: ``doc_id, n_tokens, ids, decoded_sha256``.

    A null text counts as empty, which has no ids; rows that repeat are encoded each. No rows give none.
    """
    return byte_bpe.encode(docs, ends=False, decoded=True).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256")


STAGES = [
    ("quality_classifier", good_quality),
    ("exact_dedup", no_copies),
    ("ngram_jaccard_join", no_near_copies),
    ("source_mixing", mixed),
    ("byte_bpe", encoded),
]

#: A trained model and a random draw are stages of it: there is no SQL for the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
