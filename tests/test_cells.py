"""Pruned all-pairs top-k against a plain one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.operators.cells import knn_all_pruned


def plain(ids, x, k, threshold):
    n = np.linalg.norm(x, axis=1)
    out = set()
    for i in range(len(ids)):
        if n[i] == 0:
            continue
        s = [(-round(float(x[i] @ x[j] / n[i] / n[j]), 9), ids[j]) for j in range(len(ids)) if j != i and n[j] > 0]
        s = sorted(p for p in s if threshold is None or -p[0] >= threshold)[:k]
        out |= {(ids[i], j, r + 1) for r, (_, j) in enumerate(s)}
    return out


def clustered(seed, groups, each, dim=16, spread=0.1):
    g = np.random.default_rng(seed)
    centres = g.standard_normal((groups, dim))
    return np.concatenate([c + spread * g.standard_normal((each, dim)) for c in centres])


@pytest.mark.parametrize("x,k,threshold,pivots", [
    (np.random.default_rng(1).standard_normal((150, 8)), 5, 0.25, 7),
    (np.random.default_rng(2).standard_normal((120, 3)), 3, None, 10),
    (clustered(3, 12, 15), 4, 0.25, 12),
    (np.concatenate([clustered(4, 5, 20), np.zeros((3, 16)), np.ones((60, 16))]), 6, 0.5, 9),
])
def test_equals_brute_force(spark, x, k, threshold, pivots):
    ids = [f"v{i:03d}" for i in range(len(x))]
    rows = spark.createDataFrame([*zip(ids, x.tolist(), strict=True), ("none", None)], "id string, embedding array<double>").withColumn("rank", F.lit("clash"))
    report = {}
    got = knn_all_pruned(rows, k, threshold, rows=16, pivots=pivots, report=report)
    assert {(r.id, r.neighbor_id, r["rank"]) for r in got.collect()} == plain(ids, x, k, threshold)
    assert report["scored"] <= report["pairs"]


def test_clusters_are_not_compared_with_each_other(spark):
    x = clustered(7, 30, 40, dim=24, spread=0.05)
    ids = list(range(len(x)))
    rows = spark.createDataFrame([*zip(ids, x.tolist(), strict=True)], "id bigint, embedding array<double>")
    report = {}
    got = knn_all_pruned(rows, 10, 0.25, rows=64, pivots=60, report=report)
    assert {(r.id, r.neighbor_id, r["rank"]) for r in got.collect()} == plain(ids, x, 10, 0.25)
    assert report["scored"] < 0.2 * report["pairs"]


def test_odd_tables(spark):
    rows = spark.createDataFrame([(1, [0.0, 0.0]), (2, None)], "id bigint, embedding array<double>")
    assert knn_all_pruned(rows).count() == 0 and knn_all_pruned(rows.where("false")).count() == 0
    assert [tuple(r)[:2] for r in knn_all_pruned(spark.createDataFrame([(1, [1.0]), (2, [2.0])], rows.schema)).orderBy("id").collect()] == [(1, 2), (2, 1)]


def test_scorer_equals_all_pairs_with_copies_nulls_and_repeated_ids():
    import pandas as pd
    from newsflow.operators.vectors import _block_topk_fn
    rng = np.random.default_rng(5)
    vec = np.round(rng.normal(size=(700, 8)), 1).astype(np.float32)
    vec[200:500] = vec[7]                                     # more copies than the scorer picks out one by one
    vec[600], vec[601, 3], vec[602, 0] = 0, np.nan, np.inf
    ids = rng.permutation(700)
    ids[:5] = ids[5]
    rows = pd.DataFrame({"id": ids, "vec": list(vec)})
    v = vec.astype(np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        raw = (v @ v.T) / np.outer(np.linalg.norm(v, axis=1), np.linalg.norm(v, axis=1))
    key = np.where(np.isfinite(raw), np.round(raw, 9), -9)
    key[ids[:, None] == ids[None, :]] = -9
    for threshold in (0.25, None):
        want = []
        for i in range(700):
            near = [j for j in sorted(range(700), key=lambda j: (-key[i, j], ids[j])) if key[i, j] > (-2 if threshold is None else threshold - 1e-12)]
            want += [(ids[i], ids[j], round(raw[i, j], 6)) for j in near[:10]]
        got = _block_topk_fn(10, threshold, True, None, chunk=64)(rows, rows)
        assert sorted(zip(got["id"], got["neighbor_id"], got["score"].round(6))) == sorted(want)
        floor = got.groupby("id")["score"].min()
        again = _block_topk_fn(10, threshold, True, None)(rows.assign(floor=rows["id"].map(floor)), rows)
        assert sorted(zip(again["id"], again["neighbor_id"], again["score"].round(6))) == sorted(want)


def test_blocks_of_a_large_table_grow(spark, monkeypatch):
    from newsflow.operators import cells
    monkeypatch.setattr(cells, "ROWS", 8)
    monkeypatch.setattr(cells, "CELLS", 4)
    rng = np.random.default_rng(6)
    rows = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=6)]) for i in range(160)], "id bigint, embedding array<double>")
    seen = []
    monkeypatch.setattr(cells, "_meet", lambda *a, meet=cells._meet: seen.append(a[4]) or meet(*a))
    got = cells.knn_all_pruned(rows, 5, 0.25)
    assert seen and set(seen) == {40}                         # a vector is shipped to 4 cells, not to 20
    want = knn_all_pruned(rows, 5, 0.25, rows=160, pivots=1)
    assert sorted(tuple(r)[:2] for r in got.collect()) == sorted(tuple(r)[:2] for r in want.collect())
