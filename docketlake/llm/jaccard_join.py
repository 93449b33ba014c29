"""Set-similarity join of documents on word shingles by chosen paths (operator 2)."""

from __future__ import annotations

import hashlib
import math
import uuid
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm.common import build_sieve, fresh, mix, narrow, one_of_each, settled, ship, table, text_chunks, words_of

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Children that a set gets at each level of a path, on average. Two sets of similarity 0.8 share 8/9 of them.
BRANCHING = 2.0
DEPTH = 2
#: Keys of a set that those linked to it have too, on average at least, where a large bucket splits on.
SHARED_KEYS = 1.2
TARGET_RECALL = 0.9999
#: The run stands in the lowest bits of a path.
RUN_BITS = 8
#: Buckets of up to so many sets, with so many shingles together, are compared at once. Larger ones split on.
SMALL_BUCKET = 256
SMALL_SHINGLES = 1 << 21
#: Sets that a large bucket's centre is made from, about; each salt of its rows holds about so many.
CENTRE_SETS, SALT_SETS = 64, 2048
#: Sets that share a token outside their component's centre are compared at once up to so many, else in blocks of that size.
BLOCK = 1024
#: Steps of a key's hash that rates are held against.
LEVELS = 1 << 30
#: Edges between sets that one task takes at once: 103 MB of Python objects where no two share a set.
LOCAL_EDGES = 1 << 18
#: Sets that a task which reads their shingles has about, where few are left.
TASK_SETS = 1 << 11


def runs_for(recall: float, similarity: float = SIMILARITY, branching: float = BRANCHING, depth: int = DEPTH) -> int:
    """Runs after which a pair just at the threshold has met with probability ``recall``, if all its buckets split once more.

    There it shares SHARED_KEYS of its keys on average at least (see ``_deltas``). The run must fit a path's lowest bits.
    """
    shared, alive = branching * 2 * similarity / (1 + similarity), 1 - math.exp(-SHARED_KEYS)
    for _ in range(depth):
        alive = 1 - math.exp(-shared * alive)
    runs = math.ceil(math.log(1 - recall) / math.log(1 - alive))
    if runs > 1 << RUN_BITS:
        raise ValueError(f"a recall of {recall} at similarity {similarity} takes {runs} runs, more than {1 << RUN_BITS}")
    return runs


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, and where each text's begin.

    A text of one to k - 1 words has one shingle, of all its words; a text without words has none.
    """
    words = words_of(data, offsets)
    h = words.hashes()
    counts = words.counts
    n = np.maximum(counts - k + 1, 0)
    text = np.repeat(np.arange(len(counts)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(words.first[:-1], n)
    grams = words.gram_hashes(k, h)[at]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        own = np.array([int(mix(np.array([sum((int(x) * (2 * i + 3) for i, x in enumerate(h[words.first[d] : words.first[d + 1]])), int(counts[d])) & (2**64 - 1)], dtype=np.uint64))[0]) for d in short], dtype=np.uint64)
        text, grams = np.r_[text, short], np.r_[grams, own]
    if len(short):
        order = np.argsort(text, kind="stable")
        text, grams = text[order], grams[order]
    edges = np.searchsorted(text, np.arange(len(counts) + 1)).tolist()
    for a, b in zip(edges, edges[1:], strict=False):
        grams[a:b].sort()
    if len(grams):
        new = np.r_[True, (text[1:] != text[:-1]) | (grams[1:] != grams[:-1])]
        text, grams = text[new], grams[new]
    return grams, np.searchsorted(text, np.arange(len(counts) + 1))


def _spread(first: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all elements of the given sets, and for each the index into ``sets``."""
    n = first[sets + 1] - first[sets]
    which = np.repeat(np.arange(len(sets)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[sets], n), which


def extend_paths(grams: np.ndarray, first: np.ndarray, sets: np.ndarray, paths: np.ndarray, branching: float) -> tuple[np.ndarray, np.ndarray]:
    """One level more: each path takes those tokens of its set whose hash, with the path, is below branching / size."""
    at, which = _spread(first, sets)
    share = branching / (first[sets + 1] - first[sets])
    limit = (np.minimum(share, 1 - 2.0**-53) * 2.0**64).astype(np.uint64)
    limit[share >= 1] = np.uint64(2**64 - 1)
    key = mix(paths)[which]
    token = mix(grams[at] ^ key)
    chosen = token <= limit[which]
    return sets[which[chosen]], mix(token[chosen] + key[chosen])


def chosen_paths(grams: np.ndarray, first: np.ndarray, runs: int, branching: float = BRANCHING, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Set index and path of every path of every run; the run stands in a path's lowest bits."""
    out_sets, out_paths = [], []
    everyone = np.flatnonzero(np.diff(first) > 0)
    for run in range(runs):
        sets, paths = everyone, np.full(len(everyone), run + 1, dtype=np.uint64)
        for _ in range(depth):
            sets, paths = extend_paths(grams, first, sets, paths, branching)
        out_sets.append(sets)
        out_paths.append((paths & np.uint64(2**64 - (1 << RUN_BITS))) | np.uint64(run))
    return np.concatenate(out_sets), np.concatenate(out_paths)


def _lows(sigs: list[bytes]) -> np.ndarray:
    """The first 64 bits of signatures: what buckets hold. Sets that share them are told apart where sets are joined."""
    return np.frombuffer(b"".join(s[:8] for s in sigs), dtype=">i8").astype("<i8")


def _signatures(grams: np.ndarray, first: np.ndarray) -> list[bytes]:
    return [hashlib.blake2b(grams[a:b].tobytes(), digest_size=16).digest() for a, b in zip(first[:-1], first[1:], strict=True)]


def _profiles(runs: int):
    def profile(batches):
        for rows, data, offsets in text_chunks(batches):
            grams, first = shingle_sets(data, offsets)
            sets, paths = chosen_paths(grams, first, runs)
            order = np.argsort(sets, kind="stable")
            where = np.searchsorted(sets[order], np.arange(rows.num_rows + 1)).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(where), pa.array(paths[order].view(np.int64)))
            sigs = _signatures(grams, first)
            columns = [rows.column(0), rows.column(2), pa.array(sigs, pa.binary()), pa.array(_lows(sigs)), pa.array(np.diff(first).astype(np.int64)), listed]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "sig", "low", "n", "paths"])

    return profile


def _sets_of(sieve):
    def sets(batches):
        for _, data, offsets in text_chunks(batches):
            grams, first = shingle_sets(data, offsets)
            sigs = _signatures(grams, first)
            low = _lows(sigs)
            seen: dict[bytes, int] = {}
            for i in np.flatnonzero(sieve.value.maybe(low) & (np.diff(first) > 0)):
                seen.setdefault(sigs[i], int(i))
            if seen:
                held = [grams[first[i] : first[i + 1]].tobytes() for i in seen.values()]
                yield pa.RecordBatch.from_arrays([pa.array(low[list(seen.values())]), pa.array(list(seen), pa.binary()), pa.array(held, pa.binary())], ["low", "sig", "grams"])

    return sets


def intersections(held: list[np.ndarray], slice_columns: int = 4096) -> np.ndarray:
    """How many elements each two sets share. Memory: sets times slice_columns."""
    m = len(held)
    if m == 2:
        n = len(np.intersect1d(held[0], held[1], assume_unique=True))
        return np.array([[len(held[0]), n], [n, len(held[1])]])
    values, inverse = np.unique(np.concatenate(held), return_inverse=True)
    owner = np.repeat(np.arange(m), [len(x) for x in held])
    shared = np.bincount(inverse, minlength=len(values)) > 1
    column = np.cumsum(shared) - 1
    keep = shared[inverse]
    owner, at = owner[keep], column[inverse[keep]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((m, m), dtype=np.float64)
    for low in range(0, int(shared.sum()), slice_columns):
        a, b = np.searchsorted(at, [low, low + slice_columns])
        block = np.zeros((m, slice_columns), dtype=np.float32)
        block[owner[a:b], at[a:b] - low] = 1
        out += block @ block.T
    return out


def _grouped(batches):
    """Yields the rows of each value of the first column; rows come sorted by it."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != key:
                if rows:
                    yield key, rows
                key, rows = row[0], []
            rows.append(row[1:])
    if rows:
        yield key, rows


def _batched(pairs, names: tuple[str, str], kinds: tuple, size: int = 1 << 14):
    """Record batches of the pairs of an iterator of lists of pairs."""
    held: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in held], kinds[i]) for i in (0, 1)], list(names))

    for found in pairs:
        held += found
        if len(held) >= size:
            yield batch()
            held = []
    if held:
        yield batch()


def _compare(threshold: Fraction, count_links: bool):
    """Compares all sets of each group: ``g, sig, w, grams`` to ``sig, links``, or to edges ``a, b`` between sets of different w.

    Sets of equal w belong together already; the edges span what links join beyond that.
    """

    def finish(rows):
        sigs = [r[0] for r in rows]
        if len(sigs) < 2:
            return []
        held = [np.frombuffer(r[2], dtype=np.uint64) for r in rows]
        sizes, shared = np.array([len(x) for x in held], dtype=np.float64), intersections(held)
        union = sizes[:, None] + sizes[None, :] - shared
        a, b = np.nonzero(np.triu(shared * threshold.denominator >= union * threshold.numerator, 1))
        if count_links:
            weight = np.array([r[1] for r in rows], dtype=np.int64)
            total = np.bincount(a, weight[b], len(sigs)) + np.bincount(b, weight[a], len(sigs))
            return [(sigs[i], int(total[i])) for i in np.flatnonzero(total)]
        first: dict[int, int] = {}
        root, out = [first.setdefault(r[1], i) for i, r in enumerate(rows)], []

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        apart = np.array(root)[a] != np.array(root)[b]
        for x, y in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            p, q = find(x), find(y)
            if p != q:
                root[max(p, q)] = min(p, q)
                out.append((sigs[x], sigs[y]))
        return out

    names, kinds = (("sig", "links"), (pa.binary(), pa.int64())) if count_links else (("a", "b"), (pa.binary(), pa.binary()))
    return lambda batches: _batched((finish(rows) for _, rows in _grouped(batches)), names, kinds)


def _few(df: DataFrame, rows: int, each: int = 1 << 15) -> DataFrame:
    """``df``, of up to ``rows`` rows, in so few tasks that each has some ``each`` of them; as it is if that takes more tasks than it has."""
    wanted = max(1, math.ceil(rows / each))
    return df.coalesce(wanted) if wanted < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def _compared(members: DataFrame, rows: int, sets: DataFrame, threshold: Fraction, count_links: bool) -> DataFrame:
    """``members``, up to ``rows``: ``g, low, only, w``; a null ``only`` stands for every set with these first bits."""
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = members.join(sets, "low").where("only is null or only = sig").select("g", "sig", "w", "grams")
    out = "sig binary, links long" if count_links else "a binary, b binary"
    return _few(whole.repartition(parts, "g"), rows, TASK_SETS).sortWithinPartitions("g").mapInArrow(_compare(threshold, count_links), out)


def _name_of(centre: np.ndarray) -> np.ndarray:
    return mix(centre[:1] + centre.sum(dtype=np.uint64) if len(centre) else np.zeros(1, dtype=np.uint64))


def _majority(batches):
    """``g, held`` to ``g, centre, name``: the shingles of more than half of the sets held, and a hash of them."""
    for batch in batches:
        centres, names = [], []
        for held in batch.column(1).to_pylist():
            values, n = np.unique(np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in held]), return_counts=True)
            centre = values[2 * n > len(held)]
            centres.append(centre.tobytes())
            names.append(int(_name_of(centre).view(np.int64)[0]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(centres, pa.binary()), pa.array(names, pa.int64())], ["g", "centre", "name"])


def _differences(threshold: Fraction, sample: bool):
    """``g, low, sig, w, size, grams, centre``, with ``sample`` ``groups``, to ``g, low, sig, w, size, f, rate, n, keys``, with ``sample`` ``levels``: see ``_deltas``."""
    a, b = threshold.denominator - threshold.numerator, threshold.denominator + threshold.numerator

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            fs, counts, keys, rates, ns, levels = [], [0], [], [], [], []
            groups = batch.column(7).to_pylist() if sample else [None] * batch.num_rows
            for grams, centre, met in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist(), groups, strict=True):
                x, c = np.frombuffer(grams, dtype=np.uint64), np.frombuffer(centre or b"", dtype=np.uint64)
                apart = np.setxor1d(x, c, assume_unique=True)
                fs.append(b * len(apart) - a * len(x))
                rates.append(1.0)
                ns.append(len(x))
                if sample:
                    beyond = (len(apart) + len(c) - len(x)) // 2
                    most, name = (len(x) + min(beyond, len(x) * a / threshold.numerator)) * a / threshold.denominator, _name_of(c)
                    level = np.full(len(apart), LEVELS, dtype=np.int32)
                    for by in mix(name ^ np.array(met, dtype=np.int64).view(np.uint64)):
                        level = np.minimum(level, (mix(apart ^ by) >> np.uint64(64 - LEVELS.bit_length() + 1)).astype(np.int32))
                    if len(apart) > 1.2 * most:
                        rates[-1] = min(SHARED_KEYS / (len(apart) - most), 1.0)
                        apart, level = apart[level < rates[-1] * LEVELS], level[level < rates[-1] * LEVELS]
                    apart = mix(apart + name)
                    levels.append(level[np.argsort(apart.view(np.int64))])
                keys.append(np.sort(apart.view(np.int64)))
                counts.append(counts[-1] + len(apart))
            lists = [pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(np.concatenate(part))) for part in ([keys, levels] if sample else [keys])]
            columns = [*batch.columns[:5], pa.array(fs, pa.int64()), pa.array(rates), pa.array(ns, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["g", "low", "sig", "w", "size", "f", "rate", "n", "keys", *["levels"] * sample])

    return run


def _salted(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """``rows`` (``g, size, low, ..``) with the columns of ``facts`` (``g, size, ..``, a row for each g), however hot a g is."""
    salts = F.ceil(F.col("size") / SALT_SETS).cast("int")
    spread = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("size")
    return rows.withColumn("_salt", F.pmod(F.xxhash64("low"), salts).cast("int")).join(spread, ["g", "_salt"]).drop("_salt")


def _deltas(members: DataFrame, sizes: DataFrame, sets: DataFrame, threshold: Fraction, sample: bool) -> DataFrame:
    """``g, low, sig, w, size, f, rate, n, keys``, with ``sample`` ``levels``, of the members (``g, size, shingles, low, only, w``) of large groups.

    ``sizes`` (``g, size``) has a row for each group, of ``size`` members and ``shingles`` together.

    A group has a centre: the shingles of more than half of some 64 of its sets. D(x) are the shingles by which a set x
    differs from it. Two sets differ by |D(x)| + |D(y)| - 2 |D(x) n D(y)| shingles, so at a similarity of 4/5 they are
    linked if and only if f(x) + f(y) <= 18 |D(x) n D(y)| with f(x) = 9 |D(x)| - |x|. Thus pairs with f(x) + f(y) <= 0 are linked whatever the
    rest, and others only if they share a shingle of D. This holds for any centre, so a sample may choose it.

    ``keys`` are the shingles of D(x). With ``sample`` they are keys of buckets to go on with: all of D(x) where it has at
    most 1.2 m shingles, else each with a probability (``rate``) of 1.2 / (|D(x)| - m). Sets that are linked to x share all
    of D(x) with it but m = (|x| + min(p, |x| / 4)) / 5 shingles, p being those of the centre that x lacks: x has |x| / 5 that the
    other lacks, less 4/5 of those that only the other has. So they share 1.2 chosen ones on average at least. Groups with
    the same centre are one there, named by it, and a set stands in it once; shingles are drawn for each of its groups
    anew, so that two sets that meet in several have as many chances. A shingle is drawn at a rate if its hash in one of the
    groups is below it; ``levels`` are those hashes, from 0 to LEVELS. Of two sets the one with the lower rate thus draws
    what the other draws too, and whoever knows more of a group may lower rates further by them.
    """
    share = F.least(F.lit(1.0), F.greatest(F.lit(8.0), F.least(F.lit(float(CENTRE_SETS)), SMALL_SHINGLES * F.col("size") / F.col("shingles"))) / F.col("size"))
    drawn = members.where(F.pmod(F.xxhash64("g", "low"), F.lit(1 << 30)) <= share * (1 << 30))
    held = drawn.join(sets, "low").where("only is null or only = sig").groupBy("g").agg(F.collect_list("grams").alias("held"))
    centres = settled(_few(held, sizes.count(), 16).mapInArrow(_majority, "g long, centre binary, name long"))
    facts, columns = sizes.join(centres, "g", "left").select("g", "size", "centre", "name"), ["g", "low", "sig", "w", "size", "grams", "centre"]
    if sample:
        members, facts = _families(members, facts)
        columns.append("groups")
    whole = _salted(members, facts.select("g", "size", "centre")).join(sets, "low").where("only is null or only = sig")
    whole = _few(whole, members.count(), TASK_SETS).select(*columns)
    out = "g long, low long, sig binary, w long, size long, f long, rate double, n long, keys array<long>" + ", levels array<int>" * sample
    return whole.mapInArrow(_differences(threshold, sample), out)


def _families(members: DataFrame, facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups with the same centre, if any, as one: ``members`` once each with their ``groups``, and ``facts``, ``g`` being the centre's name.

    ``size`` is that of all its groups together, the number of members at least. Where two centres have one name either will do.
    """
    named = settled(facts.withColumn("name", F.coalesce("name", F.lit(0))))
    families = settled(named.groupBy("name").agg(F.sum("size").alias("total"), F.first("centre").alias("centre")))
    if families.count() == named.count():
        return members.withColumn("groups", F.array("g")), named
    of = _salted(members, named.select("g", "size", "name").join(families.select("name", "total"), "name"))
    once = of.groupBy(F.col("name").alias("g"), F.col("total").alias("size"), "low", "only", "w").agg(F.collect_set("g").alias("groups"))
    return settled(_few(once, members.count())), families.select(F.col("name").alias("g"), F.col("total").alias("size"), "centre")


def _extremes(deltas: DataFrame) -> DataFrame:
    return settled(deltas.groupBy("g").agg(F.max("size").alias("size"), F.min(F.struct("f", "sig")).alias("least"), F.max("f").alias("most")))


def _free_counts(batches):
    """``g, held`` (of ``f, w``) to ``g, f, free``: the weight of all f' <= -f."""
    for batch in batches:
        out: list[list] = [[], [], []]
        for g, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            f, w = (np.array([x[k] for x in held], dtype=np.int64) for k in ("f", "w"))
            order = np.argsort(f)
            f, total = f[order], np.r_[0, np.cumsum(w[order])]
            for column, values in zip(out, ([g] * len(f), f.tolist(), total[np.searchsorted(f, -f, side="right")].tolist()), strict=True):
                column += values
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["g", "f", "free"])


def _count_sharing(threshold: Fraction):
    """``g, side, token, sig, w, f, keys`` to ``sig, links``: pairs with f(x) + f(y) > 0 whose least shared key is the token.

    Where a group has two sides, only pairs across count.
    """
    b2 = 2 * (threshold.denominator + threshold.numerator)

    def finish(rows):
        if len(rows) < 2:
            return []
        token = rows[0][1]
        side, weight, f = (np.array([r[k] for r in rows], dtype=np.int64) for k in (0, 3, 4))
        held = [np.array(r[5], dtype=np.int64) for r in rows]
        shared = intersections(held)
        earlier = intersections([x[x < token] for x in held])
        linked = (f[:, None] + f[None, :] > 0) & (f[:, None] + f[None, :] <= b2 * shared) & (earlier == 0)
        if side.min() < side.max():
            linked &= side[:, None] != side[None, :]
        np.fill_diagonal(linked, False)
        total = linked @ weight
        return [(rows[i][2], int(total[i])) for i in np.flatnonzero(total)]

    return lambda batches: _batched((finish(rows) for _, rows in _grouped(batches)), ("sig", "links"), (pa.binary(), pa.int64()))


def _links_in_large(members: DataFrame, sizes: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """``sig, links`` of the sets of large components: links that follow from f alone, and those that need a shared shingle."""
    spark = members.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    deltas = settled(_deltas(members, sizes, sets, threshold, sample=False))
    ends = _extremes(deltas)
    free = deltas.groupBy("g", "f").agg(F.sum("w").alias("w")).groupBy("g").agg(F.collect_list(F.struct("f", "w")).alias("held")).mapInArrow(_free_counts, "g long, f long, free long")
    own = F.when(F.col("f") <= 0, F.col("w")).otherwise(F.lit(0))
    follows = deltas.select("g", "f", "sig", "w").join(free, ["g", "f"]).select("sig", (F.col("free") - own).alias("links"))
    asking = settled(_salted(deltas, ends.select("g", "size", "most")).where("f + most > 0").select("g", "low", "sig", "w", "f", "keys"))
    rows = settled(asking.select("g", F.explode("keys").alias("token"), "sig"))
    sharing = settled(rows.groupBy("g", "token").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    # Tokens with the same sets are looked at once, by the least of them.
    few = rows.join(sharing.where(F.col("n") <= BLOCK), ["g", "token"]).groupBy("g", "token").agg(F.sort_array(F.collect_list("sig")).alias("m"))
    few = few.groupBy("g", "m").agg(F.min("token").alias("token")).select("g", "token", F.explode("m").alias("sig"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"))
    if sharing.where(F.col("n") > BLOCK).limit(1).count():
        blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        many = rows.join(sharing.where(F.col("n") > BLOCK), ["g", "token"]).withColumn("h", F.pmod(F.xxhash64("sig"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        few = few.union(many.select("g", "token", "sig", F.least("h", "other").alias("i"), F.greatest("h", "other").alias("j"), F.col("h").alias("side")))
    listed = few.join(asking.withColumnRenamed("sig", "_sig").withColumnRenamed("g", "_g"), (F.col("g") == F.col("_g")) & (F.col("sig") == F.col("_sig")))
    listed = listed.select(F.xxhash64("g", "token", "i", "j").alias("g"), "side", "token", "sig", "w", "f", "keys")
    return follows.union(_few(listed.repartition(parts, "g"), rows.count(), TASK_SETS).sortWithinPartitions("g").mapInArrow(_count_sharing(threshold), "sig binary, links long"))


def _local_components(batches):
    """``a, b`` to ``node, label``: the least node of each component of a task's edges."""
    number: dict[bytes, int] = {}
    ends: list[int] = []
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ends += (number.setdefault(a, len(number)), number.setdefault(b, len(number)))
    root = list(range(len(number)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(ends[::2], ends[1::2], strict=True):
        root[find(a)] = find(b)
    nodes, least = list(number), {}
    for node in sorted(nodes):
        least.setdefault(find(number[node]), node)
    for low in range(0, len(nodes), 1 << 14):
        part = nodes[low : low + (1 << 14)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([least[find(number[x])] for x in part], pa.binary())], ["node", "label"])


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the least node of each connected component.

    Up to LOCAL_EDGES edges are one task's work. Of more, each task first turns its edges into stars; then labels spread by
    neighbours and pointer jumping until none changes.
    """
    count = edges.count()
    if count <= LOCAL_EDGES:
        return settled(edges.select("a", "b").coalesce(1).mapInArrow(_local_components, "node binary, label binary"))
    stars = edges.select("a", "b").mapInArrow(_local_components, "node binary, label binary").where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
    both = settled(stars.select("a", "b").union(stars.select("b", "a")).distinct())
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        near = labels.join(heard, "node", "left").select("node", F.col("label").alias("was"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        moved = settled(near.join(jump, "label", "left").select("node", "was", F.least("label", "beyond").alias("label")))
        changed = moved.where(F.col("label") != F.col("was")).limit(1).count()
        labels = moved.select("node", "label")
        if not changed:
            return labels


def _low(column: str):
    return F.conv(F.hex(F.substring(column, 1, 8)), 16, -10).cast("long")


def similar_groups(docs: DataFrame, similarity: float = SIMILARITY, recall: float = TARGET_RECALL) -> DataFrame:
    """One row for each document: ``doc_id, class_id, n_links``.

    Two documents are linked if their sets of five-word shingles have a Jaccard similarity of at least 0.8; n_links
    counts the other documents linked to one, equal sets among them. class_id is the least doc_id of all that links
    connect. A text of one to four words has one shingle of all its words. A null or empty text has none: it is
    linked to nothing and a class of its own. Rows that repeat a text, or a doc_id, count as documents of their own.
    A null doc_id counts as a document; it names a class only if no other id can. Extra columns are ignored.

    Documents with equal sets are one set (128-bit signature of the sorted shingle hashes). Each run gives a set
    some paths: at each level a path takes the tokens whose hash, together with the path so far, is below
    branching / size. Sets on one path form a bucket. Small buckets are compared whole. In a larger one a centre is
    chosen; what is linked by its distance to the centre alone needs no comparison, and the rest splits on by the shingles
    in which sets differ from the centre, since shingles that most sets share do not split them. Every such bucket is
    about half as large at most. One bucket of the first run for each set joins most of what is similar; of all others
    only buckets that hold sets of different components are looked at. Last, links are counted inside each component,
    where no pair can be missed: in large ones by the same centres. The sets stand in a table of the warehouse,
    bucketed by key, while the function runs.
    """
    return _classes(docs, similarity, recall).select("doc_id", "class_id", "n_links")


def _text_hash():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _is_small():
    return (F.col("size") == 2) | ((F.col("size") <= SMALL_BUCKET) & (F.col("shingles") <= SMALL_SHINGLES))


def _edges_of(buckets: DataFrame, labels: DataFrame | None, sets: DataFrame, threshold: Fraction, further: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Spanning links ``a, b`` of the buckets ``path, low, n``, and the buckets that large ones split into, if any.

    Buckets of one component, by ``labels``, are left out.
    """
    held = buckets.withColumn("known", F.col("low"))
    if labels is not None:
        held = buckets.join(labels.select(_low("node").alias("low"), "label"), "low", "left").select("path", "low", "n", F.coalesce(_low("label"), "low").alias("known"))
    same = [F.bit_xor(F.xxhash64("low", F.lit(i))).alias(f"x{i}") for i in (0, 1)]
    shares = held.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"), F.min("known").alias("p"), F.max("known").alias("q"), F.min("n").alias("least"), F.max("n").alias("most"), *same).where("p < q")
    # Two sets alone whose sizes are too far apart are not linked.
    shares = shares.where((F.col("size") > 2) | (F.col("least") * threshold.denominator >= F.col("most") * threshold.numerator))
    # Buckets with the same members are looked at once.
    mixed = shares.groupBy("size", "shingles", "x0", "x1").agg(F.min("path").alias("g"))
    most = buckets.count()
    mixed = settled(_few(mixed.select("g", "size", "shingles", _is_small().alias("small")), most))
    held = settled(_few(held.withColumnRenamed("path", "g").join(mixed, "g"), most))
    most = held.count()
    once = held.where("small").select("g", "low", F.lit(None).cast("binary").alias("only"), F.col("known").alias("w"))
    edges = _compared(once, most, sets, threshold, False)
    large = mixed.where("not small")
    if not large.limit(1).count():
        return settled(_few(edges.distinct(), most)), None
    members = held.where("not small").select("g", "size", "shingles", "low", F.lit(None).cast("binary").alias("only"), F.lit(1).cast("long").alias("w"))
    deltas = settled(_deltas(members, large.select("g", "size"), sets, threshold, sample=True))
    known = settled(_few(_salted(deltas, _extremes(deltas)), most))
    star = known.where((F.col("f") + F.col("least.f") <= 0) & (F.col("sig") != F.col("least.sig"))).select(F.col("least.sig").alias("a"), F.col("sig").alias("b"))
    edges = settled(_few(edges.union(star).distinct(), most))
    if not further:
        return edges, None
    # A bucket all of whose sets are linked to the least is done.
    # In other ones a set shares (f + other f) / 18 shingles of D at least with any that it is linked to: 1.2 keys of those do.
    # Sets that are linked to the least are together by it. They only look for the others, whose f is over -least f.
    other = F.when(F.col("f") + F.col("least.f") <= 0, 1 - F.col("least.f")).otherwise(F.col("least.f"))
    shared = (F.col("f") + other) / (2 * (threshold.denominator + threshold.numerator))
    share = F.least("rate", SHARED_KEYS / F.greatest(F.lit(SHARED_KEYS), shared))
    split = known.where("least.f + most > 0 and f + most > 0").withColumn("share", share)
    drawn = F.filter(F.arrays_zip("keys", "levels"), lambda k: k["levels"] < F.col("share") * LEVELS)
    split = settled(split.select(F.explode(drawn["keys"]).alias("path"), "low", "n"))
    split = settled(split.join(split.groupBy("path").agg(F.min("low").alias("p"), F.max("low").alias("q")).where("p < q").select("path"), "path").distinct())
    return edges, split


def _classes(docs: DataFrame, similarity: float = SIMILARITY, recall: float = TARGET_RECALL) -> DataFrame:
    """``similar_groups`` with a hash of each row's text, the number of its shingles, and a key of its class."""
    ship(docs.sparkSession)
    spark = docs.sparkSession
    threshold = Fraction(similarity).limit_denominator(1000)
    runs = runs_for(recall, similarity)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = narrow(docs, doc_id="long", text="string").withColumn("text_hash", _text_hash())
    profile = settled(plain.mapInArrow(_profiles(runs), "doc_id long, text_hash long, sig binary, low long, n long, paths array<long>"))
    weights = profile.groupBy("sig").agg(F.count(F.lit(1)).alias("w"), F.min("doc_id").alias("least"), F.max("n").alias("n"), F.first("low").alias("low"))
    rows = profile.select(F.explode("paths").alias("path"), "low", "n")
    several = rows.groupBy("path").agg(F.min("low").alias("p"), F.max("low").alias("q")).where("p < q").select("path")
    met = settled(rows.join(several, "path").distinct())
    sieve = spark.sparkContext.broadcast(build_sieve(met.select("low").distinct(), "low"))
    found = plain.select("text").mapInArrow(_sets_of(sieve), "low long, sig binary, grams binary")
    # Dealt out by key once: the joins below move the rows of buckets, not the sets.
    name = f"docketlake_sets_{uuid.uuid4().hex}"
    dealt = found.groupBy("low", "sig").agg(F.first("grams").alias("grams")).repartition(parts, "low")
    dealt.write.bucketBy(parts, "low").sortBy("low").saveAsTable(name)
    try:
        sets = spark.table(name)
        first_run = met.where(F.col("path").bitwiseAND(F.lit((1 << RUN_BITS) - 1)) == 0)
        edges, _ = _edges_of(first_run.groupBy("low", "n").agg(F.min("path").alias("path")).select("path", "low", "n"), None, sets, threshold, further=False)
        labels, buckets = components(edges), met
        while buckets is not None:
            edges, buckets = _edges_of(buckets, labels, sets, threshold)
            if edges.limit(1).count():
                labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).where("a <> b").union(edges))

        members = labels.join(weights.withColumnRenamed("sig", "node"), "node")
        sizes = members.groupBy("label").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"), F.min("least").alias("class_id"))
        members = settled(members.join(sizes.withColumn("small", _is_small()), "label").select("node", "label", "size", "shingles", "small", "class_id", "low", "w"))
        grouped = members.select(F.xxhash64("label").alias("g"), "low", F.col("node").alias("only"), "w", "small", "size", "shingles")
        count = members.count()
        counts = _compared(grouped.where("small").select("g", "low", "only", "w"), count, sets, threshold, True)
        large = settled(grouped.where("not small").select("g", "size").distinct())
        if large.limit(1).count():
            counts = counts.union(_links_in_large(grouped.where("not small").select("g", "size", "shingles", "low", "only", "w"), large, sets, threshold))
        links = settled(_few(counts.groupBy("sig").agg(F.sum("links").alias("links")), count))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    of_sig = weights.join(members.select(F.col("node").alias("sig"), "class_id", "label"), "sig", "left").join(links, "sig", "left")
    of_sig = of_sig.select("sig", F.coalesce("label", "sig").alias("class_key"), F.when(F.col("label").isNull(), F.col("least")).otherwise(F.col("class_id")).alias("class_id"), (F.col("w") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"))
    empty = F.col("n") == 0
    # By a key that neither side is dealt out by, so that Spark can split the many rows of one set.
    of_sig = of_sig.withColumn("_key", F.hex("sig")).drop("sig")
    return profile.select("doc_id", "text_hash", "n", F.hex("sig").alias("_key")).join(of_sig, "_key").select(
        "doc_id",
        "text_hash",
        "n",
        "class_key",
        F.when(empty, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(empty, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
    )


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, the one with the least doc_id (then text hash); all columns kept.

    Rows without words all stay. Of rows that repeat doc_id and text one stays.
    """
    classes = settled(_classes(docs).where("n > 0").select("doc_id", "text_hash", "class_key"))
    order = F.struct(F.col("doc_id").isNull().alias("a"), "doc_id", "text_hash")
    leaders = classes.groupBy("class_key").agg(F.min(order).alias("first"))
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    doc, hashed, kept, own_hash = fresh(docs, "doc", "hash", "kept", "key_hash")
    key = settled(classes.join(leaders, "class_key").select(F.col("doc_id").alias(doc), F.col("text_hash").alias(hashed), own.alias(kept)))
    gone = key.where(~F.col(kept)).select(doc, hashed).distinct()
    repeated = settled(key.where(F.col(kept)).groupBy(doc, hashed).count().where("count > 1").drop("count"))
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own_hash) == F.col(hashed))
    left = docs.withColumn(own_hash, _text_hash()).join(gone, same, "left_anti")
    return one_of_each(left, repeated, same, ["doc_id", own_hash]).drop(own_hash)


OP2_SQL = """
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM t
), e AS (
  SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))
), r AS (
  SELECT a AS doc_id, a AS seen FROM p UNION SELECT r.doc_id, p.b FROM r JOIN p ON p.a = r.seen
), c AS (
  SELECT doc_id, min(seen) AS class_id FROM r GROUP BY doc_id
), l AS (
  SELECT a AS doc_id, count(*) AS n FROM p GROUP BY a
)
SELECT d.doc_id, coalesce(least(c.class_id, d.doc_id), d.doc_id) AS class_id, coalesce(l.n, 0)::BIGINT AS n_links
FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id)
"""
