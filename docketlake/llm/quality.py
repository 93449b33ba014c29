"""Quality classifier: supervised subword embeddings, averaged per document (operator 8)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm.common import Words, crc_mod, mix, narrow, ship, table, text_chunks, words_of
from docketlake.llm.labelled import labelled_sample

#: Labelled documents that the fit uses at most: with label 0 and with label 1.
SAMPLE = {0: 1500, 1: 3000}
BUCKETS = 1 << 15
DIMENSIONS = 8
GRAM_CHARACTERS = (3, 4)
EPOCHS = 12
RATE = 0.5
KEEP_FROM = 0.7
#: Fixed-point steps of a feature's weight: sums of integers do not depend on how texts are dealt out.
STEPS = float(1 << 32)


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with a space before each and at the end, so that no n-gram spans two texts."""
    texts = len(offsets) - 1
    out = np.full(len(data) + texts + 1, 0x20, dtype=np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(1, texts + 1), np.diff(offsets))] = data
    return out, np.r_[0, offsets[1:] + np.arange(1, texts + 1)]


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 bytes, white space as U+0020, and for each byte the number of characters before it."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype="<u4")
    points = np.where((points >= 0x09) & (points <= 0x0D), np.uint32(0x20), points)
    return points, np.r_[0, np.cumsum((data & 0xC0) != 0x80)]


def _grams(points: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the n characters from each character on."""
    m = max(0, len(points) - n + 1)
    h = np.full(m, n, dtype=np.uint32)
    for i in range(n):
        h = h * np.uint32(0x01000193) ^ points[i : i + m]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    return (h & np.uint32(BUCKETS - 1)).astype(np.int64)


def _whole_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word, and of each pair of a word and the next one's being the same or not."""
    h = words.hashes()
    same = np.zeros(len(h), dtype=bool)
    if len(h) > 1:
        same[1:] = h[1:] == h[:-1]
        firsts = words.first[:-1]
        same[firsts[firsts < len(h)]] = False
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64), (mix(same.astype(np.uint64) + np.uint64(77)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _gram_span(words: Words, before: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First character and number of the n-grams of each word with a space at either side."""
    return before[words.start] - 1, np.maximum(before[words.end] - before[words.start] + 3 - n, 0)


@dataclass
class Model:
    """What is left of the embeddings to score with two classes: each bucket's part in the margin, and the bias."""

    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        data, offsets = _spaced(data, offsets)
        words = words_of(data, offsets)
        points, before = _characters(data)
        held = [self.weights[x] for x in _whole_words(words)]
        total, n = held[0] + held[1], np.full(len(words.start), 2, dtype=np.int64)
        for size in GRAM_CHARACTERS:
            low, many = _gram_span(words, before, size)
            run = np.zeros(len(points) + 2, dtype=np.int64)
            grams = self.weights[_grams(points, size)]
            np.cumsum(grams, out=run[1 : len(grams) + 1])
            total += run[np.where(many > 0, low + many, 0)] - run[np.where(many > 0, low, 0)]
            n += many
        means = np.round(total / n).astype(np.int64)
        run = np.r_[0, np.cumsum(means)]
        count = words.counts
        margin = (run[words.first[1:]] - run[words.first[:-1]]) / np.maximum(count, 1) / STEPS + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def sparse_features(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and their shares in the average, for each text."""
    out = []
    for text in texts:
        data, offsets = _spaced(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]))
        words = words_of(data, offsets)
        points, before = _characters(data)
        spans = [_gram_span(words, before, n) for n in GRAM_CHARACTERS]
        share = 1.0 / (2 + sum(many for _, many in spans)) / max(1, len(words.start))
        sums = np.zeros(BUCKETS)
        for buckets in _whole_words(words):
            sums += np.bincount(buckets, share, BUCKETS)
        for n, (low, many) in zip(GRAM_CHARACTERS, spans, strict=True):
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
            sums += np.bincount(_grams(points, n)[at], np.repeat(share, many), BUCKETS)
        used = np.flatnonzero(sums)
        out.append((used.astype(np.int32), sums[used].astype(np.float32)))
    return out


def fit(sample: list[tuple[bytes, int]], seed: int = 7) -> Model:
    """Stochastic gradient descent on the softmax of the averaged vectors, one document a step."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    output, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    features, labels = sparse_features([t for t, _ in sample]), np.array([y for _, y in sample], dtype=np.int64)
    steps = EPOCHS * len(sample)
    for step in range(steps):
        if step % len(sample) == 0:
            order = random.permutation(len(sample))
        i = order[step % len(sample)]
        rate = RATE * (1 - step / steps)
        used, share = features[i]
        hidden = share @ vectors[used]
        logits = hidden @ output + bias
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[labels[i]] -= 1
        push = output @ p
        output -= rate * np.outer(hidden, p)
        bias -= rate * p * 0.1
        # A bucket's share in an average is small; the rate of its vector makes up for it.
        vectors[used] -= (rate * 40) * share[:, None] * push
    weights = np.round(vectors @ (output[:, 1] - output[:, 0]) * STEPS).astype(np.int64)
    return Model(weights, float(bias[1] - bias[0]))


def fit_on(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on labelled rows whose crc32(doc_id) mod 4 is not 2, as many as SAMPLE says at most."""
    return fit(labelled_sample(docs, labels, "quality", lambda c: crc_mod(c, 4) != 2, SAMPLE))


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each document.

    A document is the average of its words' vectors, and a word the average of the vectors of the word, of its
    character n-grams, spaces at its edges included, and of whether it repeats the word before: hashed bigrams of rare
    words are not seen twice, and without it texts of one word over and over pass. All words of the whole text count. Null and empty texts have the
    score of the bias alone. Rows that repeat get equal scores; a null doc_id counts as the empty text in held_out.
    Extra columns are ignored.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for rows, data, offsets in text_chunks(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(shared.value.scores(data, offsets))], ["doc_id", "score"])

    scored = narrow(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_on(docs, table(spark, sf_dir, "labels")))


def good_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that the model rejects; all columns kept.

    Null and empty texts have the bias's score. Rows that repeat, and null ids, are judged each by their text.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            named = pa.RecordBatch.from_arrays([batch.column(at)], ["text"])
            scores = [shared.value.scores(data, offsets) for _, data, offsets in text_chunks([named])]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) >= KEEP_FROM))

    return docs.mapInArrow(run, docs.schema)
