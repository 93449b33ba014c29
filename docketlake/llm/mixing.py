"""Mixing sources to target weights, in fixed-length blocks of words (operator 6)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm.common import fresh, mix, one_of_each, settled, settled_in_place, ship, table, text_chunks, words_of

WEIGHTS = (1, 2, 3)
MOST_PASSES = 3
BLOCK_WORDS = 128
#: An output shard gets so many slots on average; shards are drawn in groups of so many.
SHARD_SLOTS, GROUP_SHARDS = 256, 1024
SEED = 17


def numbered_sources(sized: DataFrame) -> DataFrame:
    """``source, size, source_no, weight``: sources by code point, null last. The numbers are carried over ranges of sources."""
    spark = sized.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("size"))
    order = [F.col("source").isNull(), F.col("source")]
    dealt = settled_in_place(sizes.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id()))
    counts = sorted((r.pid, r["n"]) for r in dealt.groupBy("pid").agg(F.count(F.lit(1)).alias("n")).collect())
    before = dict(zip([p for p, _ in counts], np.cumsum([0, *[n for _, n in counts]]).tolist(), strict=False))

    def number(batches):
        seen = None
        for batch in batches:
            if batch.num_rows:
                seen = before[batch.column(2)[0].as_py()] if seen is None else seen
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.arange(seen, seen + batch.num_rows))], ["source", "size", "source_no"])
                seen += batch.num_rows

    numbered = dealt.mapInArrow(number, "source string, size long, source_no long")
    return numbered.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("source_no") % len(WEIGHTS) + 1).cast("int")))


def with_targets(sources: DataFrame, most: float = MOST_PASSES) -> DataFrame:
    """``sources`` with ``target``: shares of the total by weight; a share stops at ``most`` times its source, the excess goes to the others.

    A source stops where its share per weight is below a level that only rises: each round adds up what has stopped.
    """
    at_most = F.col("size") * F.lit(float(most))
    total = sources.agg(F.sum("size")).first()[0] or 0
    level = -1.0
    while True:
        stopped = at_most < F.col("weight") * F.lit(level)
        held, weight = sources.agg(F.sum(F.when(stopped, at_most).otherwise(0.0)), F.sum(F.when(stopped, 0).otherwise(F.col("weight")))).first()
        new = (total - held) / weight if weight else level
        if new <= level or not weight:
            break
        level = new
    return sources.withColumn("target", F.least(at_most, F.col("weight") * F.lit(float(level))))


def permuted(at: np.ndarray, size: int, key: int, back: bool = False) -> np.ndarray:
    """A pseudorandom permutation, or its inverse, of 0 .. size - 1: a Feistel network on the next even number of bits, walked until inside."""
    half = max(1, math.ceil(math.log2(max(2, size)) / 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    rounds = mix(np.arange(4, dtype=np.uint64) + np.uint64(key * 1_000_003 & (2**64 - 1)))
    x = at.astype(np.uint64)
    outside = np.ones(len(x), dtype=bool)
    while outside.any():
        y = x[outside]
        left, right = y >> shift, y & mask
        for k in rounds[::-1] if back else rounds:
            if back:
                left, right = right ^ (mix(left + k) & mask), left
            else:
                left, right = right, left ^ (mix(right + k) & mask)
        x[outside] = (left << shift) | right
        outside = x >= size
    return x.astype(np.int64)


def sized_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, text_hash`` of each row; a null text has no words."""
    ship(docs.sparkSession)

    def count(batches):
        for rows, data, offsets in text_chunks(batches):
            n = words_of(data, offsets).counts.astype(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(n), rows.column(3)], ["doc_id", "source", "size", "text_hash"])

    plain = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return plain.withColumn("text_hash", F.xxhash64("text")).mapInArrow(count, "doc_id long, source string, size long, text_hash long")


def placed_rows(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """``doc_id, source_no, size, text_hash, start``: ``start`` are the words of the source before the row, by doc_id.

    A distributed prefix sum: rows are dealt out by ranges of (source, doc_id). One row for each partition reaches the
    driver, with the sum of its last source; each partition counts on from what stands before it.
    """
    spark = sized.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbers = sources.select(F.col("source").alias("_s"), "source_no")
    known = sized.join(numbers, F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "source")
    order = ["source_no", "doc_id", "size", "text_hash"]
    dealt = settled_in_place(known.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id()))

    def ends(batches):
        first, last, total, pid = None, None, 0, None
        for batch in batches:
            if batch.num_rows:
                no, size = np.asarray(batch.column(0)), np.asarray(batch.column(2))
                pid, first = batch.column(4)[0].as_py(), int(no[0]) if first is None else first
                total = (total if no[-1] == last else 0) + int(size[no == no[-1]].sum())
                last = int(no[-1])
        if pid is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (pid, first, last, total)], ["pid", "first", "last", "total"])

    carried, before = (None, 0), {}
    for pid, first, last, total in sorted(map(tuple, dealt.mapInArrow(ends, "pid long, first long, last long, total long").collect())):
        before[pid] = carried[1] if carried[0] == first else 0
        carried = (last, total + (before[pid] if first == last else 0))
    shared = spark.sparkContext.broadcast(before)

    def place(batches):
        source, had = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            no, doc, size, text_hash = (batch.column(i) for i in range(4))
            s, n = np.asarray(no), np.asarray(size)
            if source is None:
                source, had = int(s[0]), shared.value[batch.column(4)[0].as_py()]
            start = np.cumsum(n) - n
            cuts = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
            for a, b in zip(cuts, np.r_[cuts[1:], len(s)], strict=True):
                had = had if int(s[a]) == source else 0
                source, words = int(s[a]), int(n[a:b].sum())
                start[a:b] += had - start[a]
                had += words
            yield pa.RecordBatch.from_arrays([doc, no, size, text_hash, pa.array(start)], ["doc_id", "source_no", "size", "text_hash", "start"])

    return dealt.mapInArrow(place, "doc_id long, source_no long, size long, text_hash long, start long")


def slots_of(size: int, words: int, source_no: int) -> tuple[int, int]:
    """How many slots give ``words`` words of a source of ``size`` words, and how many of them the last slot takes."""
    blocks = -(-size // BLOCK_WORDS)
    passes, rest = divmod(words, size) if size else (0, 0)
    if not rest:
        return passes * blocks, BLOCK_WORDS
    short = size - (blocks - 1) * BLOCK_WORDS
    place = int(permuted(np.array([blocks - 1]), blocks, source_no * 64 + passes, back=True)[0])
    more = -(-rest // BLOCK_WORDS)
    held = lambda k: k * BLOCK_WORDS - (BLOCK_WORDS - short if place < k else 0)
    if held(more) < rest:
        more += 1
    return passes * blocks + more, rest - held(more - 1)


def _split(n: int, shares: np.ndarray, *seed: int) -> np.ndarray:
    """A multinomial draw with a seed of its own."""
    return np.random.default_rng([SEED, *seed]).multinomial(n, shares / shares.sum())


def slots(sources: DataFrame) -> DataFrame:
    """``shard, source_no, pass, block, words``: what each slot of the output takes, of a block at most ``words`` words.

    For each source a multinomial draw says how many of its slots each output shard gets, first by groups of shards,
    then inside a group; each draw has a seed of its own and is made in a task.
    """
    spark = sources.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    shards = max(1, int(total / BLOCK_WORDS) // SHARD_SLOTS)
    groups = -(-shards // GROUP_SHARDS)
    in_group = np.full(groups, GROUP_SHARDS)
    in_group[-1] = shards - (groups - 1) * GROUP_SHARDS

    def deal(frames):
        for frame in frames:
            for source, size, target in frame.itertuples(index=False):
                n, last = slots_of(int(size), round(target), int(source))
                counts = _split(n, in_group, int(source))
                used = np.flatnonzero(counts)
                first = np.cumsum(counts) - counts
                yield pd.DataFrame({"source_no": source, "size": size, "part": used, "first": first[used], "n": counts[used], "slots": n, "last": last})

    def fill(frames):
        for frame in frames:
            for source, size, group, first, n, count, last in frame.itertuples(index=False):
                blocks = -(-size // BLOCK_WORDS)
                counts = _split(n, np.ones(in_group[group]), int(source), int(group) + 1)
                ends, low = np.cumsum(counts) + first, first
                for low in range(first, first + n, 1 << 18):
                    k = np.arange(low, min(first + n, low + (1 << 18)))
                    turn, block = k // blocks, np.empty(len(k), dtype=np.int64)
                    for one in np.unique(turn):
                        here = turn == one
                        block[here] = permuted(k[here] % blocks, blocks, int(source) * 64 + int(one))
                    shard = group * GROUP_SHARDS + np.searchsorted(ends, k, side="right")
                    words = np.where(k == count - 1, last, BLOCK_WORDS)
                    yield pd.DataFrame({"shard": shard, "source_no": source, "pass": turn, "block": block, "words": words})

    dealt = sources.where("size > 0 and target > 0").select("source_no", "size", "target").repartition(parts).mapInPandas(deal, "source_no long, size long, part long, first long, n long, slots long, last long")
    return dealt.repartition(parts).mapInPandas(fill, "shard long, source_no long, pass long, block long, words long")


def drawn_pieces(placed: DataFrame, sources: DataFrame) -> DataFrame:
    """``shard, source_no, pass, block, start, low, high``: the word ranges of each row that the slots take."""
    end = F.col("start") + F.col("size")
    held = placed.where("size > 0").select("source_no", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / BLOCK_WORDS), F.floor((end - 1) / BLOCK_WORDS))).alias("block"))
    held = held.join(slots(sources), ["source_no", "block"])
    low = F.greatest(F.col("start"), F.col("block") * BLOCK_WORDS) - F.col("start")
    high = F.least(end, F.col("block") * BLOCK_WORDS + F.col("words")) - F.col("start")
    return held.select("shard", "source_no", "pass", "block", "start", low.alias("low"), high.alias("high")).where("low < high")


def _planned(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    sized = settled(sized_rows(docs))
    sources = settled(with_targets(settled(numbered_sources(sized))))
    return settled(placed_rows(sized, sources)), sources


def packed_blocks(docs: DataFrame) -> DataFrame:
    """The mix as blocks: ``shard, source, pass, block, place, doc_id, low, high``, a row for each document's words in a block.

    A slot of an output shard is one (source, pass, block); its rows by ``place`` hold at most 128 words together, words
    ``low`` to ``high`` (exclusive) of each document.
    """
    placed, sources = _planned(docs)
    pieces = drawn_pieces(placed, sources).join(placed.where("size > 0").select("source_no", "start", "doc_id"), ["source_no", "start"])
    return pieces.join(sources.select("source_no", "source"), "source_no").select("shard", "source", "pass", "block", F.col("start").alias("place"), "doc_id", "low", "high")


def mixed_sizes(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, size, source_size, target, taken``.

    Sources go by code point, null last, and weigh 1, 2, 3, repeating. A source's words, in the order of doc_id, are
    cut into blocks of 128; its last block may be shorter. A source's slots go through a pseudorandom permutation of
    its blocks, a new one for each pass, so that no block is taken more than once a pass or in more than three passes;
    the last slot takes only the words that are still missing, so a source gives its target, rounded. A multinomial
    draw for each source says which output shards its slots are in. Null and empty texts have size 0 and are taken 0
    words. Rows that repeat are rows of their own. Extra columns are ignored. Neither sources nor shards are collected.
    """
    placed, sources = _planned(docs)
    taken = drawn_pieces(placed, sources).groupBy("source_no", "start").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
    facts = sources.select("source_no", F.col("size").alias("source_size"), "target")
    rows = placed.join(taken, ["source_no", "start"], "left").join(facts, "source_no")
    return rows.select("doc_id", "size", "source_size", "target", F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("taken"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_sizes(table(spark, sf_dir, "documents"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each pass that takes words of a document.

    A pass that takes all words gives the whole text unchanged; one that takes some gives those, in their order, with
    what stands between them (a new line where words are left out). ``n_chars``, where there is one, is counted anew.
    Rows that repeat doc_id and text are taken as often as all of them together. Null and empty texts give no row.
    """
    placed, sources = _planned(docs)
    key, doc, hashed, took = fresh(docs, "key", "doc", "hash", "takes")
    pieces = drawn_pieces(placed, sources).groupBy("source_no", "start", "pass").agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("pieces"))
    rows = placed.where("size > 0").join(pieces, ["source_no", "start"]).groupBy("doc_id", "text_hash").agg(F.collect_list("pieces").alias("takes"))
    rows = rows.select(F.col("doc_id").alias(doc), F.col("text_hash").alias(hashed), F.col("takes").alias(took))
    once = docs.withColumn(key, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    doubled = settled(placed.groupBy(F.col("doc_id").alias(doc), F.col("text_hash").alias(hashed)).count().where("count > 1").drop("count"))
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(key) == F.col(hashed))
    joined = one_of_each(once, doubled, same, ["doc_id", key]).join(rows, same).drop(doc, hashed, key)
    names = docs.columns
    text_at, chars_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None
    schema = docs.schema

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or b"" for t in part.column(text_at).cast(pa.large_binary()).to_pylist()]
                index, out = [], []
                for i, takes in enumerate(part.column(len(names)).to_pylist()):
                    words = words_of(np.frombuffer(texts[i], dtype=np.uint8), np.array([0, len(texts[i])]))
                    for pieces in takes:
                        spans = [[pieces[0]["low"], pieces[0]["high"]]]
                        for p in pieces[1:]:
                            if p["low"] == spans[-1][1]:
                                spans[-1][1] = p["high"]
                            else:
                                spans.append([p["low"], p["high"]])
                        whole = spans == [[0, len(words.start)]]
                        out.append(texts[i] if whole else b"\n".join(texts[i][words.start[a] : words.end[b - 1]] for a, b in spans))
                        index.append(i)
                rows = part.take(pa.array(index, pa.int64()))
                columns = [rows.column(c) for c in range(len(names))]
                columns[text_at] = pa.array(out, pa.binary()).cast(pa.string())
                if chars_at is not None:
                    columns[chars_at] = pa.array([len(t.decode("utf-8", "replace")) for t in out], pa.int64()).cast(columns[chars_at].type)
                yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(cut, schema)
