"""Shared pieces: table access, word arrays over Arrow batches, fixed-size sieves and ordered scans."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.session import ensure_checkpoint_dir, settled, settled_in_place, ship

__all__ = ["ensure_checkpoint_dir", "settled", "settled_in_place", "ship"]

#: Java's rendering of the word class of every contract: runs of characters other than these six.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one numpy step works on; a longer text makes a step of its own.
CHUNK_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the given names, cast to the given types: ``narrow(df, doc_id="long")``."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (Stafford's variant 13)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(kind: str, base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(kind)
    if have is not None and len(have) >= n:
        return have
    size = max(n, CHUNK_BYTES + 1)
    powers = np.ones(size, dtype=np.uint64)
    np.cumprod(np.full(size - 1, base, dtype=np.uint64), out=powers[1:])
    if size <= 2 * CHUNK_BYTES:
        _POWERS[kind] = powers
    return powers


@dataclass
class Words:
    """The words of a run of texts. ``first[i]:first[i + 1]`` are those of text ``i``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def only(self, texts: np.ndarray) -> Words:
        """The words of some texts; the others have none."""
        chosen = np.repeat(texts, self.counts)
        return Words(self.data, self.offsets, self.start[chosen], self.end[chosen], np.r_[0, np.cumsum(np.where(texts, self.counts, 0))])

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        n = len(self.data)
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _powers("up", _BASE, n + 1)[:n], out=prefix[1:])
        return mix((prefix[self.end] - prefix[self.start]) * _powers("down", _BASE_INVERSE, n + 1)[self.start])

    def gram_hashes(self, k: int, hashes: np.ndarray | None = None) -> np.ndarray:
        """A hash of the k words from each word on; those that run past their text mean nothing."""
        h = self.hashes() if hashes is None else hashes
        n = max(0, len(h) - k + 1)
        out = np.zeros(n, dtype=np.uint64)
        for i in range(k):
            out = out * np.uint64(0xD6E8FEB86659FD93) + h[i : i + n]
        return mix(out)


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Finds the words of the texts ``data[offsets[i]:offsets[i + 1]]`` (UTF-8)."""
    word = ~_IS_SPACE[data]
    n = len(word)
    begins, ends = word.copy(), word.copy()
    if n:
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        begins[edges] = word[edges]
        ends[edges - 1] = word[edges - 1]
    start = np.flatnonzero(begins)
    return Words(data, offsets, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, where, held = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Splits batches into runs of whole texts of about CHUNK_BYTES; yields the rows, their bytes and offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = string_buffers(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts of a column as bytes; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


@dataclass
class Sieve:
    """A bitmap of fixed size over 64-bit hashes: says no for sure, or maybe.

    Its size does not depend on the data, so it may be broadcast at any scale. When it fills up it lets more
    rows through; an exact join behind it keeps results right.
    """

    bits: int
    words: np.ndarray
    #: Bits of one word that each hash sets.
    probes: int = 1

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        h = hashes.view(np.uint64)
        word = self.words[((h & np.uint64(self.bits - 1)) >> np.uint64(6)).astype(np.int64)]
        out = word >> (h & np.uint64(63))
        for shift in PROBE_SHIFTS[1 : self.probes]:
            out &= word >> ((h >> np.uint64(shift)) & np.uint64(63))
        return (out & np.uint64(1)).astype(bool)


#: Where a hash has the bits that it sets in its word: below the upper ones, which are small in the least of some hashes.
PROBE_SHIFTS = (0, 30, 40)


#: Words of a sieve that reach the driver at once, a row for each.
SIEVE_ROWS = 1 << 19


def build_sieve(df: DataFrame, column: str, bits: int = 1 << 24, probes: int = 1) -> Sieve:
    """A sieve of a column of 64-bit hashes. At most bits / 64 rows reach the driver, up to SIEVE_ROWS at once; a larger one reads ``df`` for each such part."""
    slot, size = F.col(column).bitwiseAND(F.lit(bits - 1)), bits // 64
    set_bits = " | ".join(f"shiftleft(1L, cast(shiftright({column}, {shift}) & 63 as int))" for shift in PROBE_SHIFTS[:probes])
    at = df.select(F.shiftright(slot, 6).alias("at"), F.expr(set_bits).alias("bit"))
    words = np.zeros(size, dtype=np.uint64)
    for low in range(0, size, SIEVE_ROWS):
        part = at if size <= SIEVE_ROWS else at.where((F.col("at") >= low) & (F.col("at") < low + SIEVE_ROWS))
        rows = part.groupBy("at").agg(F.bit_or("bit").alias("bit")).toPandas()
        words[rows["at"].to_numpy(dtype=np.int64)] = rows["bit"].to_numpy(dtype=np.int64).view(np.uint64)
    return Sieve(bits, words, probes)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that ``df`` does not have in any spelling."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while (name := f"_{name}") in taken:
            pass
        out.append(name)
    return out


def one_of_each(df: DataFrame, repeated: DataFrame, same: Column, key: list[str]) -> DataFrame:
    """``df`` with one row of each repeated key, the least by all its columns in their order, nulls first.

    ``repeated``, computed before, names those keys, ``same`` matches them. Maps, which have no order, are compared as JSON.
    """
    if not repeated.limit(1).count():
        return df
    orderable = [F.to_json(F.col(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema]
    (whole,) = fresh(df, "whole")
    least = df.join(repeated, same, "left_semi").groupBy(*key).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.struct(*orderable)).alias(whole))
    return df.join(repeated, same, "left_anti").unionByName(least.select(f"{whole}.*"))


def crc_mod(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)
