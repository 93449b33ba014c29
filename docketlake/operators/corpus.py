"""Documents as paragraphs: split, normalise, key, deduplicate, pack, put together again."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketlake.functions.text import CYRILLIC, collapse, key_of
from docketlake.session import settled, settled_in_place, ship

#: Characters of a batch at most, and what separates its paragraphs.
MAX_CHARS = 1200
DELIMITER = "\n@@@@@\n"
SENTINEL = r"\s*@{3,}\s*"
SENTENCE_END = r"(?<=[.!?])\s+"


def lines_of(docs: DataFrame, doc: str = "doc_id", text: str = "text", pattern: str = CYRILLIC) -> DataFrame:
    """S-5, S-7, S-10, A-1, PF-14: ``doc, pos, line, norm, k``; norm and key are null where a line passes through.

    Lines are what stands between ``\\n``; a null text has none. They are normalised before they become rows: what filters
    rows by their keys would else, pushed down, normalise each line again.
    """
    lines = F.transform(F.split(F.col(text), "\n"), lambda x: F.struct(x.alias("line"), collapse(x).alias("norm")))
    lines = F.transform(lines, lambda x: F.struct(x["line"].alias("line"), F.when(x["norm"].rlike(pattern), x["norm"]).alias("norm")))
    rows = docs.select(doc, F.posexplode(lines).alias("pos", "_l")).select(doc, "pos", "_l.line", "_l.norm")
    return rows.withColumn("k", key_of(F.col("norm")))


def unique_paragraphs(lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """O-2, WN-3: ``k, norm, occurrences, first_doc, first_pos``: each paragraph once, where it first appears."""
    first = F.min(F.struct(F.col(doc).alias("d"), F.col("pos").alias("p"))).alias("f")
    rows = lines.where("k is not null").groupBy("k").agg(F.min("norm").alias("norm"), F.count(F.lit(1)).alias("occurrences"), first)
    return rows.select("k", "norm", "occurrences", F.col("f.d").alias("first_doc"), F.col("f.p").alias("first_pos"))


def paragraph_stats(lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """AG-13: documents, lines, paragraph occurrences, distinct paragraphs, characters with and without repeats.

    Lines are normalised once, for the counts by key; documents are counted without that.
    """
    by_key = settled(lines.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min(F.length("norm")).alias("length")))
    known, total = F.col("k").isNotNull(), lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return by_key.agg(
        total(F.col("n")).alias("lines"),
        total(F.when(known, F.col("n"))).alias("occurrences"),
        total(F.col("n") * F.col("length")).alias("chars"),
        F.count("k").alias("unique_paragraphs"),
        total(F.col("length")).alias("unique_chars"),
    ).select(lines.agg(F.countDistinct(doc)).scalar().alias("documents"), "*")


def keys_of_documents(lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """AG-14: the set of paragraph keys of each document."""
    return lines.groupBy(doc).agg(F.array_sort(F.collect_set("k")).alias("keys"))


def reassembled(lines: DataFrame, cache: DataFrame, doc: str = "doc_id", gate: bool = True) -> DataFrame:
    """J-6, AG-15, AG-16, IN-4: ``doc, text, complete``: lines in order, paragraphs by their translation.

    ``cache``: ``k, en``, a row for each key. A document with an untranslated paragraph is not complete, and with
    ``gate`` its text is null; else such lines stay as they are.
    """
    known = cache.select(F.col("k").alias("_k"), F.col("en").alias("_en"))
    # Lines without a key ask for keys that nothing has, a different one each, so that they do not meet in one task.
    own = F.coalesce("k", F.concat(F.lit("no key "), F.xxhash64(doc, "pos").cast("string")))
    rows = lines.join(known, own == F.col("_k"), "left")
    ready = F.col("norm").isNull() | F.col("_en").isNotNull()
    piece = F.struct(F.col("pos"), F.when(F.col("norm").isNull(), F.col("line")).otherwise(F.coalesce("_en", "line")).alias("x"))
    docs = rows.groupBy(doc).agg(F.array_sort(F.collect_list(piece)).alias("_pieces"), F.bool_and(ready).alias("complete"))
    text = F.array_join(F.transform("_pieces", lambda p: p["x"]), "\n")
    return docs.select(doc, F.when(F.col("complete"), text).otherwise(F.lit(None) if gate else text).alias("text"), "complete")


# TR-5, WN-4: greedy packing. What a partition does to an open batch of c characters is a function of c alone, so the
# functions of all partitions, small tables, are composed on the driver and every partition then packs for itself.


def _alone(norm: str, limit: int) -> Column:
    return (F.length(norm) > limit) | F.col(norm).rlike("@{3}")


class _Packer:
    """The sequential rule. ``size`` is -1 while no batch is open."""

    def __init__(self, limit: int, size: int = -1, batch: int = -1):
        self.limit, self.size, self.batch = limit, size, batch

    def put(self, length: int, alone: bool) -> int:
        if alone:
            self.size, self.batch = -1, self.batch + 1
        elif self.size < 0 or self.size + len(DELIMITER) + length > self.limit:
            self.size, self.batch = length, self.batch + 1
        else:
            self.size += len(DELIMITER) + length
        return self.batch


def _effect(lengths: np.ndarray, alone: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For an open batch of 0 .. limit characters, and last for none: the size left open, and batches begun."""
    n = len(lengths)
    # From an item that begins a batch on, nothing before it matters: its end state, backwards.
    end, begun = np.full(n + 1, -1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
    before = np.r_[0, np.cumsum(np.where(alone, 0, lengths + len(DELIMITER)))]
    stops = np.r_[np.flatnonzero(alone), n]
    next_stop = stops[np.searchsorted(stops, np.arange(n))] if n else np.zeros(0, dtype=np.int64)

    def after(first: int, size: int) -> tuple[int, int]:
        """End state with ``size`` characters open before item ``first``, which must not stand alone."""
        stop = int(next_stop[first])
        fits = int(np.searchsorted(before, before[first] + limit - size, side="right")) - 1
        to = min(max(fits, first), stop)
        if to < n:
            return int(end[to]), int(begun[to])
        return size + int(before[n] - before[first]), 0

    for i in range(n - 1, -1, -1):
        if alone[i]:
            e, b = (-1, 0) if i + 1 == n else (end[i + 1], begun[i + 1])
        elif i + 1 == n:
            e, b = lengths[i], 0
        elif alone[i + 1]:
            e, b = end[i + 1], begun[i + 1]
        else:
            e, b = after(i + 1, int(lengths[i]))
        end[i], begun[i] = e, b + 1
    sizes, counts = np.empty(limit + 2, dtype=np.int64), np.zeros(limit + 2, dtype=np.int64)
    for c in range(limit + 1):
        if not n:
            sizes[c] = c
        elif alone[0]:
            sizes[c], counts[c] = end[0], begun[0]
        else:
            sizes[c], counts[c] = after(0, c)
    sizes[-1], counts[-1] = (end[0], begun[0]) if n else (-1, 0)
    return sizes, counts


def pack_batches(paragraphs: DataFrame, order: list[str], norm: str = "norm", limit: int = MAX_CHARS) -> DataFrame:
    """``paragraphs`` with ``batch_id``, ``batch_pos``: packed greedily in the given order, as one pass over all would.

    A batch joined by the delimiter has at most ``limit`` characters; a paragraph that is longer, or has the sentinel
    in it, is a batch by itself and closes the one before. Exact over any number of partitions: rows are dealt out by
    range, and what reaches the driver is ``limit + 2`` pairs of numbers for each partition. ``order`` must be total.
    """
    sized = paragraphs.withColumns({"_length": F.length(norm).cast("long"), "_alone": _alone(norm, limit)})
    return packed_sizes(sized, order, limit).drop("_length", "_alone")


def packed_sizes(paragraphs: DataFrame, order: list[str], limit: int = MAX_CHARS) -> DataFrame:
    """``pack_batches`` of rows that only tell of paragraphs: ``_length``, and ``_alone`` for those that are batches by themselves."""
    spark = paragraphs.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = paragraphs.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id())
    rows = settled_in_place(rows)

    def effects(frames):
        pid, lengths, alone = None, [], []
        for frame in frames:
            if len(frame):
                pid = int(frame["_pid"].iloc[0])
                lengths += frame["_length"].tolist()
                alone += frame["_alone"].tolist()
        if pid is not None:
            sizes, counts = _effect(np.array(lengths, dtype=np.int64), np.array(alone, dtype=bool), limit)
            yield pd.DataFrame({"pid": [pid], "sizes": [sizes.tolist()], "counts": [counts.tolist()]})

    table = rows.select("_length", "_alone", "_pid").mapInPandas(effects, "pid int, sizes array<long>, counts array<long>").toPandas().sort_values("pid")
    size, batch, starts = -1, -1, {}
    for pid, sizes, counts in table.itertuples(index=False):
        starts[int(pid)] = (size, batch)
        size, batch = int(sizes[size]), batch + int(counts[size])
    start = spark.sparkContext.broadcast(starts)

    def pack(frames):
        packer = None
        for frame in frames:
            if len(frame):
                if packer is None:
                    packer = _Packer(limit, *start.value[int(frame["_pid"].iloc[0])])
                yield frame.drop(columns="_pid").assign(batch_id=[packer.put(n, a) for n, a in zip(frame["_length"], frame["_alone"], strict=True)])

    schema = paragraphs.select("*", F.lit(0).cast("long").alias("batch_id")).schema
    packed = rows.mapInPandas(pack, schema)
    place = F.row_number().over(Window.partitionBy("batch_id").orderBy(*order)) - 1
    return packed.withColumn("batch_pos", place.cast("long"))


def sentence_pieces(text: str, limit: int = MAX_CHARS) -> list[str]:
    """S-12: sentences packed into pieces of at most ``limit`` characters; a longer sentence is cut hard.

    The open piece is closed before a long sentence is cut, and no piece is empty, so that order and text are kept.
    """
    pieces, piece = [], ""
    for sentence in re.split(SENTENCE_END, text):
        if len(sentence) > limit:
            if piece:
                pieces.append(piece)
                piece = ""
            cut = [sentence[i : i + limit] for i in range(0, len(sentence), limit)]
            pieces += cut[:-1]
            sentence = cut[-1]
        joined = f"{piece} {sentence}".strip()
        if piece and len(joined) > limit:
            pieces.append(piece)
            piece = sentence
        else:
            piece = joined
    if piece:
        pieces.append(piece)
    return pieces


def paragraph_chunks(text: str, limit: int = MAX_CHARS) -> list[str]:
    """S-14: whole paragraphs packed into chunks of at most ``limit`` characters; a longer one goes by sentences."""
    chunks, open_lines = [], None
    for line in text.split("\n"):
        if len(line) > limit:
            if open_lines:
                chunks.append(open_lines)
            open_lines = None
            chunks += sentence_pieces(line, limit)
        elif not open_lines:
            open_lines = line
        elif len(open_lines) + 1 + len(line) > limit:
            chunks.append(open_lines)
            open_lines = line
        else:
            open_lines = f"{open_lines}\n{line}"
    if open_lines:
        chunks.append(open_lines)
    return chunks


def chunked(docs: DataFrame, limit: int = MAX_CHARS, by: str = "sentence", doc: str = "doc_id", text: str = "text") -> DataFrame:
    """S-12, S-14 on documents: ``doc, pos, chunk``; a null text has none."""
    ship(docs.sparkSession)
    cut = sentence_pieces if by == "sentence" else paragraph_chunks

    @F.pandas_udf("array<string>")
    def pieces(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: cut(t, limit) if t is not None else [])

    return docs.select(doc, F.posexplode(pieces(F.col(text))).alias("pos", "chunk"))


def sentences_of(text: Column) -> Column:
    """S-11."""
    return F.split(text, SENTENCE_END)


def joined_batch(paragraphs: Column) -> Column:
    """S-13: a batch as one text."""
    return F.array_join(paragraphs, DELIMITER)


def split_batch(text: Column) -> Column:
    """S-13: the segments of a translated batch, blank ones dropped."""
    return F.filter(F.transform(F.split(text, SENTINEL), collapse), lambda x: x != "")


def segments_of(answer: str | None) -> list[str]:
    """``split_batch`` for one answer inside a task."""
    return list(filter(None, (" ".join(piece.split()) for piece in re.split(SENTINEL, answer or ""))))
