"""Toxicity by compression distance: zstandard dictionaries of ordinary and of toxic text (operator 5)."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm.common import crc_mod, narrow, ship, table, text_bytes
from docketlake.llm.labelled import labelled_sample

#: Labelled documents that the fit uses at most: with label 0 and with label 1.
SAMPLE = {0: 4000, 1: 2000}
ORDINARY_WORDS = 12_000
TOXIC_WORDS = 2_000
#: Short matches anywhere in the dictionary, weighed by an optimal parser.
MATCHING = {"window_log": 20, "hash_log": 18, "chain_log": 19, "search_log": 6, "min_match": 3, "target_length": 64, "strategy": zstandard.STRATEGY_BTULTRA2}
EDGE = b".,;:!?\"'()[]{}<>#$%&*|-_"
#: Windows, and their bytes, that a worker remembers before it starts afresh.
CACHE_WINDOWS, CACHE_BYTES = 1 << 19, 1 << 24
SMALLEST_CELL = 8
#: A word goes into the toxic dictionary from this excess on; a pair of lengths counts from this log-odds on.
EXCESS = 6.0
LEAST_WEIGHT = 1.5

_LOADED: dict = {}


#: A byte is written as these three before compression: a match then costs less than the letters of a short word.
_WIDE = [bytes([b, (b * 167 + 13) % 256, (b * 91 + 101) % 256]) for b in range(256)]


def widened(text: bytes) -> bytes:
    return b"".join(map(_WIDE.__getitem__, text))


def windows(text: bytes) -> list[bytes]:
    """A window is a word, lower-cased, without punctuation at its edges."""
    return [w.strip(EDGE) for w in text.lower().split()]


@dataclass
class Model:
    """Two dictionaries, the carrier phrase that both know, and what a window's two lengths say."""

    ordinary: bytes
    toxic: bytes
    carrier: bytes
    weights: np.ndarray
    slope: float
    bias: float
    length_weight: float

    def meter(self):
        """A function from a window to its cell: bytes added to the carrier with either dictionary."""
        packs = []
        for content in (widened(self.ordinary), widened(self.toxic)):
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=zstandard.ZstdCompressionParameters(**MATCHING))
            how = zstandard.ZstdCompressionParameters(**MATCHING, write_checksum=False, write_content_size=False, write_dict_id=False)
            packs.append(zstandard.ZstdCompressor(dict_data=known, compression_params=how).compress)
        carrier = widened(self.carrier)
        base = [len(pack(carrier)) for pack in packs]
        limit = len(self.weights) - 1

        def cell(window: bytes) -> tuple[int, int]:
            text = carrier + widened(window + b" ")
            a, b = (len(pack(text)) - low for pack, low in zip(packs, base, strict=True))
            return min(max(a, 0), limit), min(max(a - b, 0), limit)

        return cell

    def scorer(self):
        """A function from a text to its score; remembers windows."""
        cell, known, held = self.meter(), {}, [0]

        def score(text: bytes) -> float:
            if len(known) > CACHE_WINDOWS or held[0] > CACHE_BYTES:
                known.clear()
                held[0] = 0
            found = windows(text)
            values = list(map(known.get, found))
            if None in values:
                for w in {w for w, v in zip(found, values, strict=True) if v is None}:
                    known[w] = float(self.weights[cell(w)])
                    held[0] += len(w)
                values = list(map(known.get, found))
            return squash(self.slope * math.log1p(math.fsum(values)) + self.bias + self.length_weight * math.log1p(len(found)))

        return score


def squash(x: float) -> float:
    return 1 / (1 + math.exp(-min(max(x, -40.0), 40.0)))


def _dictionaries(sample: list[tuple[bytes, int]]) -> tuple[bytes, bytes, bytes]:
    """Ordinary words by document frequency; the toxic dictionary has those too, and what stands out in toxic texts."""
    seen, texts = (Counter(), Counter()), [0, 0]
    for text, y in sample:
        texts[y] += 1
        seen[y].update(set(windows(text)))
    ranked = lambda counter: sorted(counter.items(), key=lambda x: (-x[1], x[0]))

    share = max(1, texts[1]) / max(1, texts[0])

    def stands_out(word: bytes) -> float:
        """Standard deviations by which a word's texts with label 1 exceed what its texts with label 0 let expect."""
        expected = (seen[0][word] + 0.5) * share
        return (seen[1][word] - expected) / math.sqrt(expected)

    chosen = {w: stands_out(w) for w, n in seen[1].items() if w and n >= 3}
    chosen = {w: z for w, z in chosen.items() if z > EXCESS}
    ordinary = [w for w, _ in ranked(seen[0]) if w and w not in chosen][:ORDINARY_WORDS]
    toxic = [w for w, _ in sorted(chosen.items(), key=lambda x: (-x[1], x[0]))][:TOXIC_WORDS]
    carrier = b" " + b" ".join(ordinary[:16]) + b" "
    common = b" " + b" ".join(reversed(ordinary))
    return common + carrier, common + b" " + b" ".join(reversed(toxic)) + carrier, carrier


def fit(sample: list[tuple[bytes, int]], cells: int = 40, steps: int = 400) -> Model:
    """Dictionaries from two thirds of the sample; from the rest, thresholds: a weight for each pair of lengths."""
    first, rest = [x for i, x in enumerate(sample) if i % 3], [x for i, x in enumerate(sample) if not i % 3]
    ordinary, toxic, carrier = _dictionaries(first)
    model = Model(ordinary, toxic, carrier, np.zeros((cells, cells)), 1.0, -2.0, 0.0)
    if {y for _, y in rest} != {0, 1}:
        return model
    cell, known = model.meter(), {}
    tables = []
    for text, _ in rest:
        counts = np.zeros((cells, cells))
        for w, n in Counter(windows(text)).items():
            if w not in known:
                known[w] = cell(w)
            counts[known[w]] += n
        tables.append(counts)
    y = np.array([label for _, label in rest], dtype=float)
    counts = np.array(tables)
    held = [counts[y == k].sum(axis=0) for k in (0, 1)]
    totals = [max(1.0, h.sum()) for h in held]
    weights = np.log((held[1] + 1) / (totals[1] + 1)) - np.log((held[0] + 1) / (totals[0] + 1))
    weights[(held[0] + held[1]) < SMALLEST_CELL] = 0
    weights[weights < LEAST_WEIGHT] = 0
    weights[:, 0] = 0  # no byte saved: the window says nothing
    model.weights = weights
    x = np.stack([np.log1p(np.tensordot(counts, weights, 2)), np.log1p(counts.sum(axis=(1, 2)))], axis=1)
    scale = np.maximum(x.std(axis=0), 1e-9)
    z, b, theta = x / scale, -1.0, np.zeros(2)
    balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) ** 0.5
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ theta + b, -40, 40)))
        wrong = balance * (p - y)
        theta, b = theta - 0.5 * (z.T @ wrong) / len(y), b - 0.5 * wrong.mean()
    model.slope, model.length_weight, model.bias = float(theta[0] / scale[0]), float(theta[1] / scale[1]), float(b)
    return model


def fit_on(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on labelled rows whose crc32(doc_id) mod 5 is not 0, as many as SAMPLE says at most."""
    return fit(labelled_sample(docs, labels, "toxic", lambda c: crc_mod(c, 5) != 0, SAMPLE))


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each document.

    Each word of the whole text is compressed behind a carrier phrase, once with each dictionary; the two lengths
    pick the word's weight, and the weights' sum, calibrated, is the score. Null and empty texts have the score of a
    text without words. Rows that repeat get equal scores. A null doc_id counts as the empty text in held_out.
    Extra columns are ignored.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        if _LOADED.get("id") != shared.value.toxic:
            _LOADED.update(id=shared.value.toxic, score=shared.value.scorer())
        for batch in batches:
            scores = [_LOADED["score"](t) for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = narrow(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_on(docs, table(spark, sf_dir, "labels")))
