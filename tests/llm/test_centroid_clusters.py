"""Operator 12 against plain Lloyd rounds."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketlake.llm import centroid_clusters as C


def plain(rows):
    kept = [(d, [math.floor(64 * x) for x in v]) for d, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (sha(f"1:{'' if r[0] is None else r[0]}"), r[1]))[:16]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for step in range(4):
        label = [min(range(len(centres)), key=lambda c: (far(v, centres[c]), c)) for _, v in kept]
        if step < 3:
            for c in range(len(centres)):
                mine = [v for (_, v), k in zip(kept, label, strict=True) if k == c]
                centres[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)] if mine else centres[c]
    out = [(d, c, far(v, centres[c]), sha(",".join(map(str, centres[c])))) for (d, v), c in zip(kept, label, strict=True)]
    inertia = lambda c=None: sum(x[2] for x in out if c in (None, x[1]))
    return sorted(((d, c, x, inertia(c), inertia(), s) for d, c, x, s in out), key=repr)


def awkward(families=6, each=25):
    r = random.Random(2)
    rows, centres = [], [[r.uniform(-3, 3) for _ in range(64)] for _ in range(families)]
    for k, centre in enumerate(centres):
        rows += [(100 * k + i, [x + r.gauss(0, 0.05 * (1 + k)) for x in centre]) for i in range(each)]
    rows += [(900 + i, centres[0]) for i in range(40)] + [(5, centres[1]), (5, centres[1]), (5, centres[2]), (None, centres[3]), (None, None)]
    rows += [(950, []), (951, [0.0] * 63), (952, [0.0] * 65), (953, [float("nan")] + [0.0] * 63), (954, [None] + [0.0] * 63), (955, [float("-inf")] + [0.0] * 63)]
    return rows + [(960, [-0.001] * 64), (961, [0.0] * 64), (962, [20_000.0] * 64)]


SCHEMA = "vec_id long, embedding array<double>"


def written(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


@pytest.mark.parametrize("block", [2048, 7])
def test_clusters(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    got = C.op12_centroid_clusters(spark, written(spark, tmp_path, awkward())).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == plain(awkward())


def test_few_and_no_vectors(spark, tmp_path):
    few = [(1, [1.0] * 64), (2, [2.0] * 64), (3, None)]
    assert sorted(map(tuple, C.op12_centroid_clusters(spark, written(spark, tmp_path / "few", few)).collect()), key=repr) == plain(few)
    assert C.op12_centroid_clusters(spark, written(spark, tmp_path / "none", [(3, None)])).count() == 0


def test_clashing_columns(spark):
    rows = [(*r, 1, 2, "x", 3.0) for r in awkward()]
    df = spark.createDataFrame(rows, SCHEMA + ", x int, cluster int, ids string, distance double")
    got, centroids = C.clustered(df)
    assert got.columns == ["vec_id", "cluster", "distance"] and len(centroids) == 16
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got.collect() if r.vec_id is not None) == sorted(r[:3] for r in plain(awkward()) if r[0] is not None)


def test_components_out_of_range(spark):
    with pytest.raises(Exception, match="beyond"):
        C.clustered(spark.createDataFrame([(1, [1e30] * 64)], SCHEMA))


@given(st.integers(0, 10**6), st.integers(1, 200), st.integers(1, 20), st.sampled_from([1, 3, 50, 3_000_000]))
@settings(max_examples=150, deadline=None)
def test_trees_find_the_nearest(seed, n, k, scale):
    r = np.random.default_rng(seed)
    centres = r.integers(-9 * scale, 9 * scale + 1, (max(1, n // 30), 4))
    x = centres[r.integers(0, len(centres), n)] + r.integers(-1, 2, (n, 4))
    c = x[r.integers(0, n, k)] + r.integers(-1, 2, (k, 4))
    tree = C.cover_tree(x, leaf=3)
    assert sorted(tree.order.tolist()) == list(range(n))
    again = C.CoverTree.from_bytes(*tree.to_bytes())
    x = x[tree.order]
    want = np.array([[int(((a - b) ** 2).sum()) for b in c] for a in x]).argmin(axis=1)
    assert np.array_equal(C.nearest(x, again, c), want)


@given(st.integers(0, 10**6), st.integers(1, 150))
@settings(max_examples=100, deadline=None)
def test_cover_tree_covers_and_separates(seed, n):
    x = np.random.default_rng(seed).integers(-20, 21, (n, 2))
    tree = C.cover_tree(x, leaf=2)
    x = x[tree.order]
    for i in range(len(tree.low)):
        held = x[tree.low[i] : tree.high[i]]
        assert np.sqrt(((held - x[tree.centre[i]]) ** 2).sum(axis=1)).max() <= tree.radius[i] * (1 + 1e-9)
        kids = list(tree.children(i))
        assert [tree.low[k] for k in kids] == [tree.own[i], *[tree.high[k] for k in kids]][: len(kids)]
        for a in kids:
            assert tree.radius[a] <= tree.radius[i] / 2 * (1 + 1e-9)
            for b in kids:
                assert a == b or ((x[tree.centre[a]] - x[tree.centre[b]]) ** 2).sum() > (tree.radius[i] / 2) ** 2 * (1 - 1e-9)


def test_far_nodes_are_pruned(monkeypatch):
    """Whole nodes of well separated families are assigned without comparing their vectors."""
    r, compared = np.random.default_rng(1), []
    centres = r.integers(-10_000, 10_000, (8, 64))
    x = np.repeat(centres, 200, axis=0) + r.integers(-3, 4, (1600, 64))
    tree = C.cover_tree(x)
    exact = C.squared_distances
    monkeypatch.setattr(C, "squared_distances", lambda a, b: compared.append(len(a) * len(b)) or exact(a, b))
    assert np.array_equal(C.nearest(x[tree.order], tree, centres), np.repeat(np.arange(8), 200)[tree.order])
    assert sum(compared) < 1600 * 8 / 4
