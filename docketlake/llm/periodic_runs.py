"""Periodic runs of words: probes on grids of each period, survivors extended by chunks (operator 11)."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm.common import narrow, ship, table, text_chunks, words_of
from docketlake.llm.substring_dedup import normalised

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words that survivors of the grid are compared over together, and that one is extended by at first.
PROBE_CHUNKS, FIRST_CHUNK = (8, 64), 64

#: For a doc_id and its number of words: which original word stands at each place, or None for the text as it is.
Rewrite = Callable[[int | None, int], np.ndarray | None]


def _matching(ids: np.ndarray, at: int, p: int) -> int:
    """The first i from ``at`` on with ids[i] != ids[i + p], by chunks that double."""
    last, chunk = len(ids) - p, FIRST_CHUNK
    while at < last:
        to = min(last, at + chunk)
        unlike = ids[at:to] != ids[at + p : to + p]
        first = int(unlike.argmax())
        if unlike[first]:
            return at + first
        at, chunk = to, 2 * chunk
    return last


def _matching_back(ids: np.ndarray, at: int, p: int) -> int:
    """The least i so that ids[j] == ids[j + p] for all j from i to before ``at``."""
    chunk = FIRST_CHUNK
    while at > 0:
        low = max(0, at - chunk)
        unlike = (ids[low:at] != ids[low + p : at + p])[::-1]
        first = int(unlike.argmax())
        if unlike[first]:
            return at - first
        at, chunk = low, 2 * chunk
    return 0


def grid_runs(ids: np.ndarray, longest: int) -> np.ndarray:
    """Rows ``start, length, period`` of all runs of ``ids``, by start, then period.

    Several sequences of up to ``longest`` may stand in ``ids`` with a value between that occurs once.

    A run of period p covers four multiples of p at least, so words at jp and (j + 1)p are equal for three j in a row.
    Where they are not, nothing of that period is looked at: n/1 + n/2 + ... probes in all. ``reach`` holds, for each
    place, the furthest end of the runs found there: four grid points inside one of them have their period from it, or
    else (by the theorem of Fine and Wilf) would not all be in it.
    """
    found: list[tuple[int, int, int]] = []
    reach = np.zeros(len(ids), dtype=np.int64)
    for p in range(1, longest // LEAST_PERIODS + 1):
        grid = ids[::p]
        same = grid[1:] == grid[:-1]
        at = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * p
        if not len(at):
            continue
        at = at[reach[at] <= at + 3 * p]
        # From its first grid point on a run repeats itself over 2p words and one more.
        for chunk in PROBE_CHUNKS:
            if len(at) and chunk // 8 <= 2 * p:
                step = np.arange(1, min(chunk, 2 * p) + 1)
                at = np.concatenate([part[(ids[part[:, None] + step] == ids[part[:, None] + step + p]).all(axis=1)] for part in np.array_split(at, 1 + len(at) // 8192)])
        for i in at.tolist():
            if reach[i] > i + 3 * p:
                continue
            start, end = _matching_back(ids, i, p), _matching(ids, i, p) + p
            if end - start >= max(LEAST_WORDS, LEAST_PERIODS * p):
                found.append((start, end - start, p))
                np.maximum(reach[start:end], end, out=reach[start:end])
    runs = np.array(sorted(found, key=lambda r: (r[0], r[2])), dtype=np.int64)
    return runs.reshape(-1, 3)


def _collapse(rewrite: Rewrite | None):
    def run(batches):
        for rows, data, offsets in text_chunks(batches):
            words = words_of(data, offsets)
            counts, first = words.counts, words.first
            place = np.arange(len(words.start))
            for i, doc_id in enumerate(rows.column(0).to_pylist() if rewrite else []):
                new = rewrite(doc_id, int(counts[i]))
                if new is not None:
                    place[first[i] : first[i + 1]] = first[i] + new
            # One place before each text, whose value is its own.
            hashes = (words.hashes() >> np.uint64(1)).view(np.int64)
            ids = np.insert(hashes[place], first[:-1], -1 - np.arange(len(counts)))
            runs = grid_runs(ids, int(counts.max(initial=0)))
            text = np.searchsorted(first + np.arange(len(first)), runs[:, 0], side="right") - 1
            runs[:, 0] -= text + 1
            edges = np.searchsorted(text, np.arange(len(counts) + 1))
            keep = np.ones(len(place), dtype=bool)
            for start, length, period in runs.tolist():
                keep[start + period : start + length] = False
            runs[:, 0] -= first[text]
            flat, begin = normalised(words)
            raw, texts = flat.tobytes(), []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                kept = place[a:b][keep[a:b]]
                cuts = [0, *(np.flatnonzero(np.diff(kept) != 1) + 1).tolist(), len(kept)]
                texts.append(b" ".join(raw[begin[kept[i]] : begin[kept[j - 1] + 1] - 1] for i, j in zip(cuts, cuts[1:], strict=False) if i < j))
            listed = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in range(3)], ["start", "length", "period"])
            columns = [rows.column(0), pa.array(counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), listed), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "text"])

    return run


def without_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_words, runs, text``.

    A run is a stretch of words with a smallest period q, of max(6, 4q) words at least, that no neighbouring word extends
    keeping the period; ``runs`` has ``start, length, period`` of each, by start, then period. ``text`` has the words that
    no run contains after its first q, joined by one space. ``rewrite`` may put another of a text's words in each place
    first. Null and empty texts have no words, no runs and an empty text; rows that repeat, and null ids, are treated
    each. Extra columns are ignored. Words are told apart by 63-bit hashes.

    No row leaves its task: whole texts are worked on in runs of about a megabyte, a longer text by itself.
    """
    ship(docs.sparkSession)
    kind = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text binary"
    found = narrow(docs, doc_id="long", text="string").mapInArrow(_collapse(rewrite), kind)
    return found.withColumn("text", F.col("text").cast("string"))


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The places of the contract: a tenth of the texts end in a loop. A null id counts as the empty text."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = without_runs(table(spark, sf_dir, "documents"), planted)
    longest = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start as start, -r.period as period)))")
    line = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    rows = rows.withColumn("longest", longest)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(line, 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )
