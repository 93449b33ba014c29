"""Removal of passages that an earlier document has: repeated-phrase automata (operator 9)."""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm.common import Words, build_sieve, mix, settled, ship, string_buffers, table, text_chunks, words_of

WINDOW_WORDS = 13
#: A window's anchor is the least hash among its runs of so many words.
ANCHOR_WORDS = 5
#: Bits of the sieve of anchors, at least and at most; with a fixed number of them more and more segments would pass for nothing as tables grow.
ANCHOR_SIEVE_BITS = (1 << 25, 1 << 28)
ANCHOR_PROBES = 3
ROW_SIEVE_BITS = 1 << 24
#: Words of a segment that count as one, so that an anchor's number bounds the text that its segments have together.
SEGMENT_WORDS = 64
#: From so many segments of that length on an anchor's windows are dealt out by phrase, and from so many windows on a phrase's over so many salts.
SALTS = ((4096, 16), (65_536, 256), (1_048_576, 4096))
SALT_SIEVE_BITS = 1 << 20
#: Segments that one automaton is compiled for and streamed over.
SHARD_SEGMENTS = 2048
NO_ID = (1 << 63) - 1

SEGMENT = "anchor long, salt int, kind int, dkey long, text_hash long, start int, segment binary"


def anchor_bits(recurring: int) -> int:
    """Bits of the sieve of so many anchors: eight to sixteen for each, within the bounds."""
    least, most = ANCHOR_SIEVE_BITS
    return min(max(1 << (8 * recurring).bit_length(), least), most)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def anchors_of(words: Words, window: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each run of windows of one text with the same anchor: the anchor, its first and its last window's first word."""
    grams = words.gram_hashes(ANCHOR_WORDS, hashes)
    least = sliding_min(grams, window - ANCHOR_WORDS + 1) if len(grams) >= window - ANCHOR_WORDS + 1 else grams[:0]
    n = np.maximum(words.counts - window + 1, 0)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(words.first[:-1], n)
    text = np.repeat(np.arange(len(n)), n)
    anchor = least[at]
    if not len(at):
        return anchor, at, at
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]
    heads = np.flatnonzero(new)
    return anchor[heads], at[heads], at[np.r_[heads[1:], len(at)] - 1]


def normalised(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words with one space after each, and where each begins."""
    n = words.end - words.start
    begin = np.cumsum(n + 1) - (n + 1)
    out = np.full(int((n + 1).sum()), 0x20, dtype=np.uint8)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out[step + np.repeat(begin, n)] = words.data[step + np.repeat(words.start, n)]
    return out, np.r_[begin, len(out)]


def _plain(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", "text", F.coalesce("doc_id", F.lit(NO_ID)).alias("dkey"), F.xxhash64("text").alias("text_hash"))


def _emit_anchors(window: int):
    def run(batches):
        for rows, data, offsets in text_chunks(batches):
            words = words_of(data, offsets)
            anchor, head, tail = anchors_of(words, window)
            dkey = np.asarray(rows.column(2))[np.searchsorted(words.first, head, side="right") - 1]
            size = -(-(tail - head + window) // SEGMENT_WORDS)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(dkey), pa.array(size.astype(np.int64))], ["anchor", "dkey", "size"])

    return run


def _phrase_keys(hashes: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """A hash of the windows that begin at the given words."""
    out = np.zeros(len(at), dtype=np.uint64)
    for i in range(window):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[at + i]
    return mix(out)


def _salts_of(keys: np.ndarray, tiers) -> np.ndarray:
    salts = np.ones(len(keys), dtype=np.int64)
    for (_, count), tier in zip(SALTS, tiers, strict=True):
        salts[tier.value.maybe(keys)] = count
    return salts


def _segments(rows: pa.RecordBatch, words: Words, key: np.ndarray, head: np.ndarray, tail: np.ndarray, salt: np.ndarray, window: int) -> pa.RecordBatch:
    text = np.searchsorted(words.first, head, side="right") - 1
    dkey, text_hash = np.asarray(rows.column(2))[text], np.asarray(rows.column(3))[text]
    salt = np.where(salt > 0, ((text_hash ^ (text_hash >> 29)) & 0x7FFFFFFF) % np.maximum(salt, 1), -1)
    flat, begin = normalised(words)
    raw = flat.tobytes()
    segments = [raw[a : b - 1] for a, b in zip(begin[head].tolist(), begin[tail + window].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(np.ones(len(salt), dtype=np.int32)), pa.array(dkey), pa.array(text_hash), pa.array((head - words.first[text]).astype(np.int32)), pa.array(segments, pa.binary())],
        ["anchor", "salt", "kind", "dkey", "text_hash", "start", "segment"],
    )


def _emit_hot(window: int, hot):
    """The segments of the hot anchors."""

    def run(batches):
        for rows, data, offsets in text_chunks(batches):
            words = words_of(data, offsets)
            anchor, head, tail = anchors_of(words, window)
            hit = hot.value.maybe(anchor)
            if hit.any():
                yield _segments(rows, words, anchor[hit], head[hit], tail[hit], np.zeros(hit.sum(), dtype=np.int64), window)

    return run


def _emit_segments(window: int, sieve, hot, known, tiers):
    """Segments of recurring anchors. Of hot ones the windows that are known phrases, by the hash of the phrase; a run of equal windows is one segment."""

    def run(batches):
        for rows, data, offsets in text_chunks(batches):
            words = words_of(data, offsets)
            hashes = words.hashes()
            anchor, head, tail = anchors_of(words, window, hashes)
            hit = sieve.value.maybe(anchor)
            anchor, head, tail = anchor[hit], head[hit], tail[hit]
            by_phrase = hot.value.maybe(anchor)
            salt = np.zeros(len(anchor), dtype=np.int64)
            if by_phrase.any():
                n = (tail - head + 1)[by_phrase]
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(head[by_phrase], n)
                key = _phrase_keys(hashes, at, window)
                wanted = known.value.maybe(key)
                at, key, run_of = at[wanted], key[wanted], np.repeat(np.arange(len(n)), n)[wanted]
                heads = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1) | (run_of[1:] != run_of[:-1])]) if len(at) else at
                tails = np.r_[heads[1:], len(at)][: len(heads)] - 1
                anchor, head, tail = np.r_[anchor[~by_phrase], key[heads]], np.r_[head[~by_phrase], at[heads]], np.r_[tail[~by_phrase], at[tails]]
                salt = np.r_[salt[~by_phrase], _salts_of(key[heads], tiers)]
            if len(anchor):
                yield _segments(rows, words, anchor, head, tail, salt, window)

    return run


def _cuts(segment: bytes) -> list[int]:
    """Where the words of a segment begin, and one past its end plus one."""
    cuts, at = [0], segment.find(b" ")
    while at >= 0:
        cuts.append(at + 1)
        at = segment.find(b" ", at + 1)
    cuts.append(len(segment) + 1)
    return cuts


def _note_windows(segment: bytes, dkey: int, window: int, seen: dict[bytes, list[int]]) -> None:
    """Notes the least and the greatest document of each window, and how often it was seen."""
    cuts = _cuts(segment)
    for i in range(len(cuts) - window):
        phrase = segment[cuts[i] : cuts[i + window] - 1]
        held = seen.get(phrase)
        if held is None:
            seen[phrase] = [dkey, dkey, 1]
            continue
        held[2] += 1
        if dkey < held[0]:
            held[0] = dkey
        elif dkey > held[1]:
            held[1] = dkey


def _spread_phrases(window: int):
    """The windows of each batch's segments with the least and the greatest document that has them, and their number."""

    def run(batches):
        for batch in batches:
            seen: dict[bytes, list[int]] = {}
            for dkey, segment in zip(batch.column(3).to_pylist(), batch.column(6).to_pylist(), strict=True):
                _note_windows(segment, dkey, window, seen)
            rows = [(phrase, *held) for phrase, held in seen.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else ((),) * 4, (pa.binary(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["phrase", "low", "high", "n"])

    return run


def _keyed(window: int):
    """Phrases with their hash, the one that windows of texts are dealt out by."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            words = words_of(*string_buffers(batch.column(0)))
            key = _phrase_keys(words.hashes(), words.first[:-1], window)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *batch.columns], ["key", "phrase", "low", "n"])

    return run


def _codes(words: Words) -> list[int]:
    """A number for each word, the same for words of equal bytes and no others: an automaton over words has a state for each word of a phrase."""
    flat, _ = normalised(words)
    held = flat.tobytes().split(b" ")[:-1]
    numbers = dict(zip(dict.fromkeys(held), range(len(held))))
    return list(map(numbers.__getitem__, held))


def _locate(window: int):
    """Compiles automata of confirmed phrases and streams the segments of the same anchors through them.

    Rows come sorted by anchor and salt, phrases before segments. Segments with a salt, which have a phrase's hash in place
    of their anchor, rely on the phrases that come with them. Elsewhere all segments of an anchor meet here: windows whose
    hash is that of two documents are candidates, the text of the first document's becomes a phrase, and a segment counts
    only where the automaton finds the phrase in it.
    """

    def shard(table: pa.Table):
        """All rows of some anchors: confirm, compile, search."""
        salt, kind, dkey, text_hash, start = (np.asarray(table.column(c).combine_chunks()) for c in ("salt", "kind", "dkey", "text_hash", "start"))
        words = words_of(*string_buffers(table.column("segment")))
        sources = (np.zeros(0, dtype=np.int64),) * 3
        n = np.where((kind == 1) & (salt < 0), np.maximum(words.counts - window + 1, 0), 0)
        row = np.repeat(np.arange(len(n)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(words.first[:-1], n)
        search = (kind == 1) & (salt >= 0)
        if len(at):
            order = np.argsort(h := words.gram_hashes(window)[at], kind="stable")
            h, row, at = h[order], row[order], at[order]
            heads = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            owner = dkey[row]
            low, high = np.minimum.reduceat(owner, heads), np.maximum.reduceat(owner, heads)
            size = np.diff(np.r_[heads, len(h)])
            search[row[np.repeat(low, size) < owner]] = True
            first_of = np.flatnonzero(owner == np.repeat(low, size))
            group = np.searchsorted(heads, first_of, side="right") - 1
            group, one = np.unique(group, return_index=True)
            known = (low < high)[group]
            one = first_of[one[known]]
            sources = row[one], at[one] - words.first[row[one]], low[group[known]]
        used = search | (kind == 0)
        used[sources[0]] = True
        words = words.only(used)
        code, first_word = _codes(words), words.first.tolist()
        phrases = {tuple(code[first_word[i] : first_word[i + 1]]): int(dkey[i]) for i in np.flatnonzero(kind == 0).tolist()}
        for i, first in zip((words.first[sources[0]] + sources[1]).tolist(), sources[2].tolist(), strict=True):
            phrases[tuple(code[i : i + window])] = first
        out: list[tuple] = []
        if phrases:
            automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for phrase, first in phrases.items():
                automaton.add_word(phrase, first)
            automaton.make_automaton()
            wanted = np.flatnonzero(search)
            for i, own, text, begin in zip(wanted.tolist(), dkey[wanted].tolist(), text_hash[wanted].tolist(), start[wanted].tolist(), strict=True):
                low_word, high_word = -1, -1
                for end, first in automaton.iter(tuple(code[first_word[i] : first_word[i + 1]])):
                    if first >= own:
                        continue
                    here = end - window + 1
                    if here > high_word and high_word >= 0:
                        out.append((own, text, begin + low_word, begin + high_word))
                        low_word = here
                    elif high_word < 0:
                        low_word = here
                    high_word = here + window
                if high_word >= 0:
                    out.append((own, text, begin + low_word, begin + high_word))
        columns = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["dkey", "text_hash", "low", "high"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < SHARD_SEGMENTS:
                continue
            table = pa.Table.from_batches(held)
            anchor, salt = np.asarray(table.column("anchor").combine_chunks()), np.asarray(table.column("salt").combine_chunks())
            cuts = np.flatnonzero((anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1])) + 1
            done = 0
            while len(cuts) and cuts[-1] > done:
                to = int(cuts[min(np.searchsorted(cuts, done + SHARD_SEGMENTS), len(cuts) - 1)])
                yield shard(table.slice(done, to - done))
                done = to
            if not done and salt[-1] >= 0 and rows >= 4 * SHARD_SEGMENTS:
                # A salted anchor needs no more than its phrases to go on.
                yield shard(table)
                table, done = table.filter(pa.array(np.asarray(table.column("kind").combine_chunks()) == 0)), 0
            held = table.slice(done).combine_chunks().to_batches()
            rows = sum(b.num_rows for b in held)
        if held:
            yield shard(pa.Table.from_batches(held))

    return run


def repeated_ranges(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``dkey, text_hash, low, high``: word ranges of windows that start in a document with a smaller doc_id too."""
    ship(docs.sparkSession)
    context, plain = docs.sparkSession.sparkContext, _plain(docs)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = plain.mapInArrow(_emit_anchors(window), "anchor long, dkey long, size long").groupBy("anchor").agg(F.min("dkey").alias("low"), F.max("dkey").alias("high"), F.sum("size").alias("n"))
    recurring = settled(counted.where("low < high").select("anchor", "n"))
    sieve = context.broadcast(build_sieve(recurring, "anchor", anchor_bits(recurring.count()), ANCHOR_PROBES))
    hot = context.broadcast(build_sieve(recurring.where(F.col("n") >= SALTS[0][0]), "anchor", SALT_SIEVE_BITS))
    # Made again for the few hot anchors: that costs less than to keep all segments.
    emit, note = _emit_hot(window, hot), _spread_phrases(window)
    spread = plain.mapInArrow(lambda batches: note(emit(batches)), "phrase binary, low long, high long, n long")
    spread = spread.groupBy("phrase").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).where("low < high")
    phrases = settled(spread.select("phrase", "low", "n").mapInArrow(_keyed(window), "key long, phrase binary, low long, n long"))
    known = context.broadcast(build_sieve(phrases, "key", anchor_bits(phrases.count()), ANCHOR_PROBES))
    tiers = [context.broadcast(build_sieve(phrases.where(F.col("n") >= least), "key", SALT_SIEVE_BITS)) for least, _ in SALTS]
    segments = plain.mapInArrow(_emit_segments(window, sieve, hot, known, tiers), SEGMENT)

    def salted(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_salts_of(np.asarray(batch.column(0)).astype(np.int64), tiers))], ["key", "phrase", "low", "salts"])

    copies = phrases.select("key", "phrase", "low").mapInArrow(salted, "key long, phrase binary, low long, salts long")
    copies = copies.select(F.col("key").alias("anchor"), F.explode(F.sequence(F.lit(0), F.col("salts").cast("int") - 1)).alias("salt"), F.lit(0).alias("kind"), F.col("low").alias("dkey"), F.lit(0).cast("long").alias("text_hash"), F.lit(0).alias("start"), F.col("phrase").alias("segment"))
    dealt = copies.union(segments).repartition(2 * parts, "anchor", "salt").sortWithinPartitions("anchor", "salt", "kind")
    return dealt.mapInArrow(_locate(window), "dkey long, text_hash long, low int, high int")


def _digest(words: Words, gone: list[list] | None) -> tuple[list[int], list[int], list[str]]:
    """Words, removed words and the digest of the kept ones, of each text; ``gone`` has each text's ranges."""
    keep = np.ones(len(words.start) + 1, dtype=bool)
    for i, ranges in enumerate(gone or []):
        for low, high in ranges:
            keep[words.first[i] + low : words.first[i] + high] = False
    flat, begin = normalised(words)
    raw = flat.tobytes()
    counts, removed, shas = words.counts.tolist(), [], []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        stay = keep[a:b]
        if stay.all():
            kept = raw[begin[a] : begin[b] - 1] if b > a else b""
        else:
            edges = np.flatnonzero(np.diff(np.r_[False, stay, False].astype(np.int8))) + a
            kept = b" ".join(raw[begin[i] : begin[j] - 1] for i, j in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        removed.append(b - a - int(stay.sum()))
        shas.append(hashlib.sha256(kept).hexdigest())
    return counts, removed, shas


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _result(doc_id: pa.Array, digest) -> pa.RecordBatch:
    counts, removed, shas = digest
    return pa.RecordBatch.from_arrays([doc_id, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def without_repeats(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256``.

    A word goes if one of the windows of 13 words that cover it also starts in a document with a smaller doc_id. Null
    and empty texts have no words; texts under 13 words lose none. A null doc_id comes after all others, and such rows
    take nothing from each other, as rows of one doc_id do not. Rows that repeat get equal results. Extra columns are
    ignored.

    A window's anchor, the least hash of its five-word runs, brings equal windows together. Anchors of one document
    only are out. Segments of the others meet by anchor; windows of two documents are compiled into automata, through
    which the segments of all documents are streamed, so that every removal rests on equal text. Windows with anchors of very many
    documents are dealt out by their own hash: the phrases are confirmed by a pre-aggregated minimum and go where their windows go,
    those of very many windows to each of a number of salts, which grows with these.
    """
    plain = _plain(docs)
    found = settled(repeated_ranges(docs, window))
    ranges = settled(found.groupBy("dkey", "text_hash").agg(F.collect_set(F.struct("low", "high")).alias("gone")))
    touched = docs.sparkSession.sparkContext.broadcast(build_sieve(ranges, "text_hash", ROW_SIEVE_BITS))

    def untouched(batches):
        for rows, data, offsets in text_chunks(batches):
            apart = ~touched.value.maybe(np.asarray(rows.column(3)))
            whole = rows.filter(pa.array(apart))
            if whole.num_rows == rows.num_rows:
                yield _result(rows.column(0), _digest(words_of(data, offsets), None))
            else:
                for part, held, cuts in text_chunks([whole]):
                    yield _result(part.column(0), _digest(words_of(held, cuts), None))

    def maybe_touched(batches):
        for batch in batches:
            yield batch.filter(pa.array(touched.value.maybe(np.asarray(batch.column(3)))))

    def cut(batches):
        for rows, data, offsets in text_chunks(batches):
            gone = [[(r["low"], r["high"]) for r in x or []] for x in rows.column(2).to_pylist()]
            yield _result(rows.column(0), _digest(words_of(data, offsets), gone))

    rest = plain.mapInArrow(maybe_touched, "doc_id long, text string, dkey long, text_hash long")
    rest = rest.join(ranges, ["dkey", "text_hash"], "left").select("doc_id", "text", "gone")
    return plain.mapInArrow(untouched, RESULT).union(rest.mapInArrow(cut, RESULT))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


OP9_SQL = """
WITH t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM t WHERE len(w) >= 13)
), m AS (
  SELECT x, min(doc_id) AS first FROM g GROUP BY x
), r AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN m USING (x) WHERE first < doc_id
), a AS (
  SELECT doc_id, list(p) AS gone FROM r GROUP BY doc_id
)
SELECT t.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM t LEFT JOIN a USING (doc_id)
"""
