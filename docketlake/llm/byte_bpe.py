"""Byte-level BPE encoding and decoding with a public rank file (operator 7)."""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from docketlake.llm.common import narrow, ship, table, text_chunks

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Distinct pieces, and their bytes, that a worker remembers before it starts afresh.
CACHE_PIECES, CACHE_BYTES = 1 << 18, 1 << 25

#: White space other than U+0020.
_WHITE = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Classes of code points. After an apostrophe s, t, m, d end a contraction; r and v do with e, l does with l.
OTHER, LETTER, NUMBER, SPACE, WHITE, APOSTROPHE, ENDS, RV, E, L = range(10)
_LETTERS = (LETTER, ENDS, RV, E, L)

_LOADED: dict = {}


def codepoint_classes() -> np.ndarray:
    """The class of every code point."""
    if "classes" not in _LOADED:
        kinds = {"L": LETTER, "N": NUMBER}
        classes = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), dtype=np.uint8, count=0x110000)
        classes[_WHITE] = WHITE
        for kind, of in ((SPACE, " "), (APOSTROPHE, "'"), (ENDS, "stmd"), (RV, "rv"), (E, "e"), (L, "l")):
            classes[[ord(c) for c in of]] = kind
        _LOADED["classes"] = classes
    return _LOADED["classes"]


# A state says what the characters before may go on as: nothing (at a text's start, or after a contraction); a run of
# letters, numbers or others; a white run of one or of more characters whose last is a space or is not; an apostrophe
# that opened its piece; and an r or v, or an l, right after that one.
_STATES = 11
START, IN_LETTERS, IN_NUMBERS, IN_OTHER, SPACE_1, SPACE_2, WHITE_1, WHITE_2, QUOTE, QUOTE_RV, QUOTE_L = range(_STATES)
_RUN = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER}
#: What a step says about boundaries: before this character, before the one ahead of it, or not before that one after all.
HERE, BACK, UNDO = 1, 2, 4


def _step(state: int, kind: int) -> tuple[int, int]:
    """The state after a character of the class, and what that says."""
    spaces, whites = (SPACE_1, SPACE_2), (WHITE_1, WHITE_2)
    if kind in (SPACE, WHITE):
        one, more = spaces if kind == SPACE else whites
        return (more, 0) if state in spaces + whites else (one, HERE)
    if (state, kind) in ((QUOTE_RV, E), (QUOTE_L, L)):
        return START, UNDO
    if state == QUOTE and kind == ENDS:
        return START, 0
    said = BACK if state in (SPACE_2, WHITE_2) else 0
    if kind == APOSTROPHE:
        if state in (IN_OTHER, QUOTE, *spaces):
            return IN_OTHER, said
        return QUOTE, said | HERE
    if state == QUOTE and kind in (RV, L):
        return QUOTE_RV if kind == RV else QUOTE_L, HERE
    run = _RUN[LETTER if kind in _LETTERS else kind]
    goes_on = state in spaces or state == run or (run == IN_LETTERS and state in (QUOTE_RV, QUOTE_L)) or (run == IN_OTHER and state == QUOTE)
    return run, said | (0 if goes_on else HERE)


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All functions on states that classes and their compositions are.

    The function of each class (and, ten further on, of each class at a text's start), the composition table, each
    function's action on states, and what a class says in a state.
    """
    own = [tuple(_step(s, k)[0] for s in range(_STATES)) for k in range(10)]
    own += [(_step(START, k)[0],) * _STATES for k in range(10)]
    functions = list(dict.fromkeys([tuple(range(_STATES)), *own]))
    number = {f: i for i, f in enumerate(functions)}
    for f in functions:
        for g in own:
            made = tuple(g[x] for x in f)
            if made not in number:
                number[made] = len(functions)
                functions.append(made)
    then = np.array([[number[tuple(g[x] for x in f)] for g in functions] for f in functions], dtype=np.uint8)
    said = np.array([[_step(s, k)[1] for k in range(10)] for s in range(_STATES)], dtype=np.uint8)
    return np.array([number[f] for f in own], dtype=np.uint8), then, np.array(functions, dtype=np.uint8), said


_OF_CLASS, _THEN, _ACTION, _SAID = _monoid()
_FLAT, _M = _THEN.ravel(), np.uint16(len(_THEN))


def scan(functions: np.ndarray, width: int = 128) -> np.ndarray:
    """Inclusive scan of function compositions, in rows of ``width``: down the columns, then across the rows' totals."""
    n = len(functions)
    if n <= width:
        out, acc = np.empty(n, dtype=np.uint8), 0
        for i, f in enumerate(functions.tolist()):
            acc = int(_THEN[acc, f])
            out[i] = acc
        return out
    rows = -(-n // width)
    grid = np.zeros(rows * width, dtype=np.uint8)
    grid[:n] = functions
    columns = np.ascontiguousarray(grid.reshape(rows, width).T)
    for j in range(1, width):
        columns[j] = _FLAT[columns[j - 1] * _M + columns[j]]
    before = np.zeros(rows, dtype=np.uint8)
    before[1:] = scan(columns[-1].copy(), width)[:-1]
    return np.ascontiguousarray(_FLAT[(before * _M)[None, :] + columns].T).ravel()[:n]


def token_starts(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where the pieces of the pattern start: ``points`` are the code points of texts that begin at ``firsts``.

    A scan gives the state before each character; state and class say where boundaries are.
    """
    n = len(points)
    if not n:
        return np.zeros(0, dtype=np.int64)
    kind = codepoint_classes()[points]
    opens = np.zeros(n + 1, dtype=bool)
    opens[firsts] = True
    opens = opens[:n]
    states = _ACTION[:, START][scan(_OF_CLASS[kind + np.uint8(10) * opens])]
    before = np.empty(n, dtype=np.uint8)
    before[0], before[1:] = START, states[:-1]
    before[opens] = START
    said = _SAID.ravel()[before * np.uint8(10) + kind]
    starts = (said & HERE).astype(bool)
    starts[:-1] |= (said[1:] & BACK).astype(bool)
    starts[:-1] &= (said[1:] & UNDO) == 0
    return np.flatnonzero(starts | opens)


def load_ranks(name: str = RANKS) -> dict[bytes, int]:
    if name not in _LOADED:
        with open(public_tokenizers.path(name), "rb") as lines:
            _LOADED[name] = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return _LOADED[name]


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merges adjacent parts, lowest rank first and leftmost among equals, until no pair has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > 96:
        return _merge_long(piece, ranks)
    none = 1 << 30
    get = ranks.get
    cut = list(range(len(piece) + 1))
    rank = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while rank:
        least = min(rank)
        if least == none:
            break
        i = rank.index(least)
        del cut[i + 1], rank[i]
        if i < len(rank):
            rank[i] = get(piece[cut[i] : cut[i + 2]], none)
        if i:
            rank[i - 1] = get(piece[cut[i - 1] : cut[i + 1]], none)
    return [ranks[piece[a:b]] for a, b in zip(cut, cut[1:], strict=False)]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap and linked parts, for pieces of any length."""
    n = len(piece)
    end, back, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        right = end[i]
        alive[right] = False
        end[i] = stop
        if stop < n:
            back[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if back[i] >= 0 and (r := ranks.get(piece[back[i] : stop])) is not None:
            heapq.heappush(heap, (r, back[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Encodes runs of texts; remembers the ids of pieces it has merged."""

    def __init__(self, ranks: str = RANKS):
        self.ranks = load_ranks(ranks)
        self.forget()
        size = max(self.ranks.values()) + 1
        self.token_length = np.zeros(size, dtype=np.int64)
        ordered = sorted((i, t) for t, i in self.ranks.items())
        self.token_length[[i for i, _ in ordered]] = [len(t) for _, t in ordered]
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(t for _, t in ordered), dtype=np.uint8)

    def forget(self) -> None:
        self.piece_number: dict[bytes, int] = {}
        self.piece_bytes = 0
        self.flat, self.starts = np.zeros(1 << 16, dtype=np.uint32), np.zeros((1 << 16) + 1, dtype=np.int64)

    def _learn(self, pieces: list[bytes]) -> None:
        known, at = self.piece_number, int(self.starts[len(self.piece_number)])
        for piece in pieces:
            if piece in known:
                continue
            ids = merge_pairs(piece, self.ranks)
            n = len(known)
            if n + 2 > len(self.starts):
                self.starts = np.concatenate([self.starts, np.zeros(len(self.starts), dtype=np.int64)])
            while at + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), dtype=np.uint32)])
            self.flat[at : at + len(ids)] = ids
            at += len(ids)
            known[piece] = n
            self.piece_bytes += len(piece)
            self.starts[n + 1] = at

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the texts, where each text's ids begin, and the byte offset at which each token ends in the run."""
        raw = data.tobytes()
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), dtype="<u4")
        leads = np.flatnonzero((data & 0xC0) != 0x80)
        starts = token_starts(points, np.searchsorted(leads, offsets[:-1]))
        at = leads[starts] if len(starts) else np.zeros(0, dtype=np.int64)
        cuts = at.tolist()
        cuts.append(len(raw))
        pieces = [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        if len(self.piece_number) > CACHE_PIECES or self.piece_bytes > CACHE_BYTES:
            self.forget()
        numbers = list(map(self.piece_number.get, pieces))
        if None in numbers:
            self._learn([p for p, n in zip(pieces, numbers, strict=True) if n is None])
            numbers = list(map(self.piece_number.get, pieces))
        numbers = np.array(numbers, dtype=np.int64)
        low = self.starts[numbers]
        n = self.starts[numbers + 1] - low
        before = np.cumsum(n) - n
        ids = self.flat[np.arange(n.sum()) - np.repeat(before - low, n)]
        piece_first = np.searchsorted(at, offsets)
        first = np.r_[before, n.sum()][piece_first]
        return ids, first, np.cumsum(self.token_length[ids])

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that ids stand for."""
        n = self.token_length[ids]
        before = np.cumsum(n) - n
        return self.token_bytes[np.arange(n.sum()) - np.repeat(before - self.token_start[ids], n)]


def encoder(ranks: str = RANKS) -> Encoder:
    key = ("encoder", ranks)
    if key not in _LOADED:
        _LOADED[key] = Encoder(ranks)
    return _LOADED[key]


def encode(docs: DataFrame, ranks: str = RANKS, ends: bool = True, decoded: bool = False) -> DataFrame:
    """``doc_id, ids, ends``: token ids of each whole text and the byte offset at which each token ends.

    A null text counts as empty; an empty text has no ids. Repeated rows are encoded each. Extra columns are ignored.
    With ``ends`` false the offsets are left out; with ``decoded`` the ids are decoded in the same pass, and
    ``decoded_sha256`` is the digest of those bytes.
    """
    ship(docs.sparkSession)

    def run(batches):
        for rows, data, offsets in text_chunks(batches):
            coder = encoder(ranks)
            ids, first, stops = coder.encode(data, offsets)
            cuts = pa.array(first.astype(np.int32))
            columns = [rows.column(0), pa.ListArray.from_arrays(cuts, pa.array(ids.astype(np.int32)))]
            if ends:
                columns.append(pa.ListArray.from_arrays(cuts, pa.array(stops - np.repeat(offsets[:-1], np.diff(first)))))
            if decoded:
                back, bounds = coder.decode(ids).tobytes(), np.r_[0, stops][first].tolist()
                columns.append(pa.array([hashlib.sha256(back[a:b]).hexdigest() for a, b in zip(bounds, bounds[1:], strict=False)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "ids", *["ends"] * ends, *["decoded_sha256"] * decoded]
    schema = "doc_id long, ids array<int>" + ", ends array<long>" * ends + ", decoded_sha256 string" * decoded
    return narrow(docs, doc_id="long", text="string").mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``doc_id, data``: the bytes of each row's ``ids``; null ids count as none."""
    ship(encoded.sparkSession)

    def run(batches):
        for batch in batches:
            held = [encoder(ranks).decode(np.array(x or [], dtype=np.int64)).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def round_trip_digests(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each document: encoded, and the ids decoded, in one pass."""
    ship(docs.sparkSession)

    def run(batches):
        for rows, data, offsets in text_chunks(batches):
            coder = encoder(ranks)
            ids, first, ends = coder.encode(data, offsets)
            little, back = ids.astype("<u4").tobytes(), coder.decode(ids).tobytes()
            cuts = np.r_[0, ends][first].tolist()
            first = first.tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(np.diff(first)),
                    pa.array([hashlib.sha256(little[4 * a : 4 * b]).hexdigest() for a, b in zip(first, first[1:], strict=False)]),
                    pa.array([hashlib.sha256(back[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:], strict=False)]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return narrow(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"))
