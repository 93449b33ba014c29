"""Clusters around centroids by Lloyd's rounds over two trees (operator 12)."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm.common import settled, ship, table

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
#: Vectors that one cover tree is built over, and points up to which a node is not divided.
BLOCK, LEAF = 2048, 16
#: Components beyond this could give squared distances that no long holds; up to the second one floats are exact.
MOST, EXACT_FLOAT = 1 << 27, 1 << 21
#: Bounds are floats: a pair is pruned only if it is out of reach by more than their error.
SLACK = 1e-9


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of whole numbers x to all of y."""
    if max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)) > EXACT_FLOAT:
        return np.array([((x - row) ** 2).sum(axis=1) for row in y]).T.reshape(len(x), len(y))
    a, b = x.astype(np.float64), y.astype(np.float64)
    return ((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * (a @ b.T)).astype(np.int64)


@dataclass
class CoverTree:
    """Nodes in preorder. Node i has the points low[i]:high[i], its own ones, of no child, first, up to own[i].

    Its centre is one of its points, and none is further from that than its radius. Children cover its points within
    half the radius; the centres of two children are further apart than that. Nodes of the same parent are reached by ``beyond``.
    """

    order: np.ndarray
    low: np.ndarray
    own: np.ndarray
    high: np.ndarray
    beyond: np.ndarray
    centre: np.ndarray
    radius: np.ndarray

    def children(self, i: int):
        at = i + 1
        while at < self.beyond[i]:
            yield at
            at = int(self.beyond[at])

    def to_bytes(self) -> tuple[bytes, bytes]:
        return np.stack([self.low, self.own, self.high, self.beyond, self.centre]).astype("<i4").tobytes(), self.radius.tobytes()

    @classmethod
    def from_bytes(cls, nodes: bytes, radius: bytes) -> CoverTree:
        held = np.frombuffer(nodes, dtype="<i4").reshape(5, -1)
        return cls(np.arange(held[2][0]), *held, np.frombuffer(radius))


def cover_tree(x: np.ndarray, leaf: int = LEAF) -> CoverTree:
    """A cover tree over the rows of ``x``, of which there is one at least. Centres are places in ``order``."""
    apart = np.sqrt(squared_distances(x, x).astype(np.float64)) * (1 + 1e-12)
    order: list[int] = []
    nodes: list[list] = []

    def grow(points: np.ndarray) -> None:
        i, far = len(nodes), float(apart[points[0], points].max())
        nodes.append([len(order), 0, 0, 0, int(points[0]), far])
        own, below, rest = [points], [], points[:0]
        if len(points) > leaf and far > 0:
            own, rest = [], points
        while len(rest):
            near = apart[rest[0], rest] <= far / 2
            (below if near.sum() > leaf else own).append(rest[near])
            rest = rest[~near]
        for part in own:
            order.extend(part.tolist())
        nodes[i][1] = len(order)
        for part in below:
            grow(part)
        nodes[i][2:4] = len(order), len(nodes)

    grow(np.arange(len(x)))
    place = np.empty(len(x), dtype=np.int64)
    place[order] = np.arange(len(x))
    low, own, high, beyond, centre, radius = (np.array(c) for c in zip(*nodes, strict=True))
    return CoverTree(np.array(order), low, own, high, beyond, place[centre], radius.astype(np.float64))


def nearest(x: np.ndarray, tree: CoverTree, centroids: np.ndarray) -> np.ndarray:
    """For each row of ``x``, in the order of ``tree``, the number of its nearest centroid; of ties the least.

    Both trees are walked together. A node of vectors keeps those nodes of centroids that may hold the nearest one of
    any of its vectors: if two centres are d apart, all pairs are between d - r - s and d + r + s. Nodes of centroids
    wider than the node of vectors are opened first. Points that no child has are compared exactly.
    """
    above = cover_tree(centroids, leaf=1)
    number = above.order
    reach = np.sqrt(squared_distances(x[tree.centre], centroids).astype(np.float64))
    label = np.empty(len(x), dtype=np.int64)

    def opened(j: int) -> list[tuple[int, float, int]]:
        single = [(int(number[c]), 0.0, -1) for c in range(above.low[j], above.own[j])]
        return single + [(int(number[above.centre[k]]), float(above.radius[k]), k) for k in above.children(j)]

    def all_of(items) -> list[int]:
        return sorted({int(c) for which, _, j in items for c in ([which] if j < 0 else number[above.low[j] : above.high[j]])})

    stack = [(0, [(int(number[above.centre[0]]), float(above.radius[0]), 0)])]
    while stack:
        i, items = stack.pop()
        wide = tree.radius[i]
        while True:
            d, r = reach[i, [c for c, _, _ in items]], np.array([r for _, r, _ in items])
            most = (d + r).min() + wide
            items = [item for item, ok in zip(items, (d - r - wide <= most + SLACK * (1 + most)).tolist(), strict=True) if ok]
            if not any(j >= 0 and r >= wide for _, r, j in items):
                break
            items = [new for c, r, j in items for new in (opened(j) if j >= 0 and r >= wide else [(c, r, j)])]
        a, b, z = int(tree.low[i]), int(tree.own[i]), int(tree.high[i])
        if len(items) == 1 and items[0][2] < 0:
            label[a:z] = items[0][0]
            continue
        if a < b:
            near = np.array(all_of(items))
            label[a:b] = near[squared_distances(x[a:b], centroids[near]).argmin(axis=1)]
        stack += [(k, items) for k in tree.children(i)]
    return label


def _whole(values: pa.Array) -> np.ndarray:
    """floor(64 x) of a list column of equal lengths."""
    x = np.floor(SCALE * values.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if np.abs(x).max(initial=0) > MOST:
        raise ValueError(f"a component is beyond {MOST // SCALE}: squared distances need not fit a long")
    return x.astype(np.int64).reshape(len(values), -1)


BLOCKS = "ids array<long>, vectors binary, nodes binary, radius binary"


def _blocks(batches):
    """Blocks of up to BLOCK vectors, each in the order of its cover tree."""
    held: list[tuple[pa.Array, np.ndarray]] = []

    def block(rows) -> pa.RecordBatch:
        ids, x = pa.concat_arrays([i for i, _ in rows]), np.concatenate([v for _, v in rows])
        tree = cover_tree(x)
        ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(tree.order)))
        return pa.RecordBatch.from_arrays([ids, *(pa.array([b], pa.binary()) for b in (x[tree.order].astype("<i4").tobytes(), *tree.to_bytes()))], ["ids", "vectors", "nodes", "radius"])

    count = 0
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            if count + part.num_rows > BLOCK:
                yield block(held)
                held, count = [], 0
            held.append((part.column(0), _whole(part.column(1))))
            count += part.num_rows
    if held:
        yield block(held)


def _read(batch):
    """Ids, vectors and nearest-centroid search of each block of a batch."""
    for ids, vectors, nodes, radius in zip(*(batch.column(i) for i in range(4)), strict=True):
        tree = CoverTree.from_bytes(nodes.as_py(), radius.as_py())
        yield ids.values, np.frombuffer(vectors.as_py(), dtype="<i4").astype(np.int64).reshape(int(tree.high[0]), -1), tree


def _sums(centroids: np.ndarray):
    def run(batches):
        for batch in batches:
            rows = [[], [], []]
            for _, x, tree in _read(batch):
                label = nearest(x, tree, centroids)
                for c in np.unique(label).tolist():
                    mine = label == c
                    for column, value in zip(rows, (c, int(mine.sum()), x[mine].sum(axis=0).tolist()), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    return run


def _labels(centroids: np.ndarray):
    def run(batches):
        for batch in batches:
            for ids, x, tree in _read(batch):
                label = nearest(x, tree, centroids)
                yield pa.RecordBatch.from_arrays([ids, pa.array(label.astype(np.int32)), pa.array(((x - centroids[label]) ** 2).sum(axis=1))], ["vec_id", "cluster", "distance"])

    return run


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> tuple[DataFrame, list[list[int]]]:
    """One row for each vector kept, ``vec_id, cluster, distance``, and the centroids, the cluster's number being the place.

    ``vectors``: ``vec_id, embedding``. Kept are vectors of exactly so many components, none null, NaN or infinite; each
    component x counts as floor(64 x). Centroids start as the kept vectors whose ids have the least SHA-256 of
    ``1:<vec_id>`` (a null id counts as the empty text; of equal ids the lesser vector comes first); fewer vectors than
    clusters give fewer. In each round every centroid becomes the floor of the mean of the vectors nearest to it (squared
    Euclidean distance, ties to the smaller number), empty ones stay. Distances are those after the last round. Rows that
    repeat count each. No vectors give no rows and no centroids. Extra columns are ignored. Components over 2^21 raise an error.

    Vectors are written once as blocks in the order of their cover trees; a round reads the blocks and shuffles a row for
    each block and cluster. What reaches the driver are the sums of the clusters.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    rows = rows.where((F.size("x") == dimensions) & F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf")))))
    drawn = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.orderBy(drawn, "x").limit(clusters).select("x").collect()
    if not first:
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    centroids = _whole(pa.array([r.x for r in first], pa.list_(pa.float64())))
    blocks = settled(rows.mapInArrow(_blocks, BLOCKS))
    for _ in range(rounds):
        part = blocks.mapInArrow(_sums(centroids), "cluster int, n long, sums array<long>")
        sums = part.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dimensions)])
        moved = centroids.tolist()
        for cluster, n, *total in sums.collect():
            moved[cluster] = [int(s) // n for s in total]
        centroids = np.array(moved, dtype=np.int64)
    return blocks.mapInArrow(_labels(centroids), "vec_id long, cluster int, distance long"), centroids.tolist()


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with ``cluster_inertia, inertia, centroid_sha256``; joined from one row for each cluster."""
    assigned = settled(assigned)
    totals = {c: int(d) for c, d in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    facts = [(c, d, sum(totals.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, d in totals.items()]
    known = assigned.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_inertia(*clustered(table(spark, sf_dir, "embeddings")))


def sql(rounds: int = ROUNDS) -> str:
    square = "list_sum(list_transform(range(1, 65), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i])))::BIGINT"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT id, v.vec_id, v.q, arg_min(c.k, struct_pack(d := {square}, k := c.k)) AS k, min({square}) AS d FROM v CROSS JOIN c{r} c GROUP BY id, v.vec_id, v.q)")
        if r < rounds:
            steps.append(f"""s{r} AS (
  SELECT k, i, (s - ((s % n) + n) % n) // n AS x FROM (SELECT k, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT k, unnest(q) AS x, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY k, i)
), c{r + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN (SELECT k, list(x::BIGINT ORDER BY i) AS q FROM s{r} GROUP BY k) m USING (k)
)""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')), q) - 1 AS k, q FROM v ORDER BY k LIMIT {CLUSTERS}
), {", ".join(steps)}
SELECT a.vec_id, a.k::INTEGER AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (k)
"""


OP12_SQL = sql()
