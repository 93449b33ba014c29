"""Bounded samples of labelled documents, for fitting classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.llm.common import settled


#: Texts over the first are not fitted on; of the others, in the order of the draw, as many as the second has room for.
MOST_TEXT, MOST_TOGETHER = 200_000, 1 << 26


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed, per_class: dict[int, int], most_bytes: int = MOST_TEXT, together: int = MOST_TOGETHER) -> list[tuple[bytes, int]]:
    """Up to ``per_class[c]`` (text, label) pairs of each class, the same ones each time, in a fixed order.

    Ids are drawn by hash among the labelled rows that ``allowed(doc_id column)`` admits; the bound on ids makes the
    broadcast and what reaches the driver bounded too. Null labels, ids and labels outside the classes are left out;
    an id that is labelled twice counts with its least label; of texts that repeat an id the least is taken. Texts
    over ``most_bytes`` are not drawn, and all together have at most ``together`` bytes: that bounds the driver's
    memory and concerns the fit alone.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("y"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("y").isin(*per_class) & allowed("doc_id"))
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"))
    drawn = None
    for c, n in per_class.items():
        part = known.where(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        drawn = part if drawn is None else drawn.union(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.where(F.octet_length("text") <= most_bytes)
    found = settled(texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")))
    sizes = found.select("doc_id", F.octet_length("text").alias("n")).toPandas()
    sizes = sizes.assign(key=[hash_of(i) for i in sizes["doc_id"]]).sort_values(["key", "doc_id"])
    room = sizes[sizes["n"].cumsum() <= together]["doc_id"].tolist()
    rows = found.where(F.col("doc_id").isin(room)) if len(room) < len(sizes) else found
    rows = rows.toPandas()
    rows = rows.assign(key=[hash_of(i) for i in rows["doc_id"]]).sort_values(["key", "doc_id"])
    return [(t.encode("utf-8", "replace"), int(y)) for t, y in zip(rows["text"], rows["y"], strict=True)]


def hash_of(doc_id: int) -> int:
    """A fixed scrambling of ids, for orders that depend on nothing else."""
    x = (int(doc_id) * 0x9E3779B97F4A7C15 + 0x7F4A7C15) & (2**64 - 1)
    x ^= x >> 31
    return (x * 0xBF58476D1CE4E5B9) & (2**64 - 1)
