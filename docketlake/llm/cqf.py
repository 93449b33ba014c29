"""A counting quotient filter over 64-bit fingerprints, as numpy arrays.

A fingerprint splits into a quotient (its home slot) and a remainder (what the slot holds). Runs of equal
quotient stand in order; ``occupied`` marks the quotients that have a run, ``run_end`` the last slot of each run.
A remainder that was counted more than once is followed by a slot, marked in ``is_count``, that holds its count.
All bits of a fingerprint are kept, so a filter can be read back and two filters merge without loss.
"""

from __future__ import annotations

import numpy as np

_HEAD = np.dtype([("items", "<u8"), ("quotient_bits", "<u8"), ("slots", "<u8")])


class CountingQuotientFilter:
    def __init__(self, quotient_bits: int, occupied: np.ndarray, run_end: np.ndarray, is_count: np.ndarray, slots: np.ndarray, items: int):
        self.quotient_bits, self.occupied, self.run_end, self.is_count, self.slots, self.items = quotient_bits, occupied, run_end, is_count, slots, items

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray | None = None) -> CountingQuotientFilter:
        """``fingerprints`` in any order, repeats allowed."""
        fp = np.asarray(fingerprints, dtype=np.uint64)
        n = np.ones(len(fp), dtype=np.int64) if counts is None else np.asarray(counts, dtype=np.int64)
        order = np.argsort(fp, kind="stable")
        fp, n = fp[order], n[order]
        if len(fp):
            heads = np.flatnonzero(np.r_[True, fp[1:] != fp[:-1]])
            fp, n = fp[heads], np.add.reduceat(n, heads)
        q = max(1, int(np.ceil(np.log2(max(2, len(fp)) / 0.75))))
        shift = np.uint64(64 - q)
        quotient = (fp >> shift).astype(np.int64)
        remainder = fp & ((np.uint64(1) << shift) - np.uint64(1))
        width = 1 + (n > 1).astype(np.int64)
        before = np.cumsum(width) - width
        at = (np.maximum.accumulate(quotient - before) + before) if len(fp) else quotient
        size = max(1 << q, int(at[-1] + width[-1]) if len(fp) else 0)
        occupied, run_end, is_count = (np.zeros(size, dtype=bool) for _ in range(3))
        slots = np.zeros(size, dtype=np.uint64)
        if len(fp):
            slots[at] = remainder
            many = width > 1
            slots[at[many] + 1] = n[many].astype(np.uint64)
            is_count[at[many] + 1] = True
            occupied[quotient] = True
            lasts = np.flatnonzero(np.r_[quotient[1:] != quotient[:-1], True])
            run_end[at[lasts] + width[lasts] - 1] = True
        return cls(q, occupied, run_end, is_count, slots, len(fp))

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprints in ascending order, and their counts."""
        quotients, ends = np.flatnonzero(self.occupied), np.flatnonzero(self.run_end)
        if not len(ends):
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        starts = np.maximum(quotients, np.r_[0, ends[:-1] + 1])
        length = ends - starts + 1
        home = np.repeat(quotients, length)
        at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(starts, length)
        item = ~self.is_count[at]
        where = at[item]
        fp = (home[item].astype(np.uint64) << np.uint64(64 - self.quotient_bits)) | self.slots[where]
        follows = np.minimum(where + 1, len(self.slots) - 1)
        counted = self.is_count[follows] & (follows > where)
        return fp, np.where(counted, self.slots[follows].astype(np.int64), 1)

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """The filter of all that the given ones hold: their sorted sequences merged, counts added."""
        parts = [f.read() for f in filters]
        return cls.of(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))

    def to_bytes(self) -> bytes:
        head = np.array([(self.items, self.quotient_bits, len(self.slots))], dtype=_HEAD)
        flags = [np.packbits(x).tobytes() for x in (self.occupied, self.run_end, self.is_count)]
        used = self.slots[self.slots != 0]
        return b"".join([head.tobytes(), *flags, np.packbits(self.slots != 0).tobytes(), used.astype("<u8").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        items, q, size = (int(x) for x in np.frombuffer(data, dtype=_HEAD, count=1)[0])
        step, at = (size + 7) // 8, _HEAD.itemsize
        bits = [np.unpackbits(np.frombuffer(data, dtype=np.uint8, count=step, offset=at + i * step), count=size).astype(bool) for i in range(4)]
        slots = np.zeros(size, dtype=np.uint64)
        slots[bits[3]] = np.frombuffer(data, dtype="<u8", offset=at + 4 * step)
        return cls(q, bits[0], bits[1], bits[2], slots, items)
