"""Exact top-k search and embedding near-duplicates against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tidewright.llm import embed_dedup, topk
from tidewright.llm.embed_dedup import near_duplicates
from tidewright.llm.topk import top_k

ODD = [(900, None), (901, []), (902, [1.0, None, 0.5, 0.1]), (903, [math.nan, 1.0, 0.0, 0.0]), (904, [math.inf, 0.0, 0.0, 0.0]), (905, [0.0, 0.0, 0.0, 0.0]), (906, [1.0, 2.0]), (907, [1.0, 2.0]), (None, [1.0, 0.0, 0.0, 0.0])]
SCHEMA = "vec_id long, embedding array<float>, score int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rng = np.random.default_rng(1)
    v = (rng.standard_normal((400, 4)) * rng.choice([0.01, 1, 3], (400, 1))).astype(np.float32)
    v[50:60] = v[40]  # ties
    rows = [(i, v[i].tolist()) for i in range(400)]
    df = table(spark, rows + ODD)
    got = top_k(df, df.where("vec_id % 20 = 0")).collect()
    z = np.floor(1024.0 * v.astype(np.float64)).astype(np.int64)
    z = np.vstack([z, np.zeros((1, 4), dtype=np.int64)])
    ids = np.append(np.arange(400), 905)
    want = []
    for q in range(0, 400, 20):
        s = z @ z[q]
        best = [k for k in np.lexsort((ids, -s)) if ids[k] != q][:10]
        want += [(q, r + 1, int(ids[k]), int(s[k])) for r, k in enumerate(best)]
    assert sorted(tuple(r) for r in got) == want


def test_top_k_of_few(spark):
    df = table(spark, [(0, [1.0, 2.0]), (100, [0.5, 0.5]), (1, [1e30, 0.0])])
    got = sorted(tuple(r) for r in top_k(df, df.where("vec_id % 100 = 0")).collect())
    assert got == [(0, 1, 1, (1 << 63) - 1), (0, 2, 100, 1024 * 512 + 2048 * 512), (100, 1, 1, (1 << 63) - 1), (100, 2, 0, 1024 * 512 + 2048 * 512)]
    assert top_k(df.limit(0), df.limit(0)).collect() == []
    one = table(spark, [(0, [1.0])])
    assert top_k(one, one).collect() == []


@pytest.mark.parametrize("chunk", [2048, 16])
def test_near_duplicates(spark, monkeypatch, chunk):
    monkeypatch.setattr(embed_dedup, "CHUNK", chunk)
    rng = np.random.default_rng(2)
    base = rng.standard_normal((120, 24))
    v = np.vstack([base, base[:40] + rng.standard_normal((40, 24)) * 0.2, base[:1] + rng.standard_normal((60, 24)) * 0.15, base[5:9], base[5:6] * 2]).astype(np.float32)
    rows = [(i * 2, v[i].tolist()) for i in range(len(v))]
    got = {r.vec_id: r for r in near_duplicates(table(spark, rows + [(1000, None), (1002, [0.0] * 24), (1004, [math.nan] * 24), (None, v[0].tolist()), (1006, [1.0, 0.0])])).collect()}
    u = v.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    want = near.sum(axis=1)
    found = np.array([got[i * 2].n_links for i in range(len(v))])
    assert (found <= want).all() and found.sum() >= 0.98 * want.sum()
    assert got[None].component_id is None and all(got[i].n_links == 0 and got[i].kept for i in (1000, 1002, 1004, 1006))
    clear = u @ u.T >= 0.96
    for i, j in zip(*np.nonzero(clear), strict=True):
        assert got[2 * i].component_id == got[2 * j].component_id
    assert all(r.kept == (r.vec_id == r.component_id) for k, r in got.items() if k is not None)


def test_repeated_rows(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in near_duplicates(table(spark, rows)).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 0, 3)]
    assert near_duplicates(table(spark, [])).collect() == []


def test_long_vectors(spark):
    rng = np.random.default_rng(8)
    one = rng.standard_normal(5000)
    rows = [(1, one.tolist()), (2, (one * 3 + 0.01).tolist()), (3, rng.standard_normal(5000).tolist()), (4, one[:2952].tolist())]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in near_duplicates(table(spark, rows)).collect())
    assert got == [(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 0, 4)]
    best = top_k(table(spark, rows), table(spark, rows[:1]), 1).collect()
    assert [(r.query_id, r.vec_id) for r in best] == [(1, 2)]


def test_calibration():
    # tables and signs have their places in a cell's number
    assert embed_dedup.tables_needed(0.95, 31) < 256
    assert embed_dedup.count_needed() <= embed_dedup.WINDOWS and embed_dedup.tables_needed(0.95, 10) > 1


def test_recall_with_a_large_cluster(spark):
    """Measured again in each run: link ends found, of a cluster of 2,500 near copies with pairs just at the cosine, small groups and single vectors."""
    rng = np.random.default_rng(5)
    one = rng.standard_normal(64)
    cluster = one / np.linalg.norm(one) + rng.standard_normal((2500, 64)) * 0.0275
    groups = np.repeat(rng.standard_normal((300, 64)), 3, axis=0)
    groups = groups / np.linalg.norm(groups, axis=1, keepdims=True) + rng.standard_normal((900, 64)) * 0.02
    v = np.vstack([cluster, groups, rng.standard_normal((2600, 64))]).astype(np.float32)
    got = {r.vec_id: r for r in near_duplicates(table(spark, [(i, x.tolist()) for i, x in enumerate(v)])).collect()}
    u = v.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    want, found = near.sum(axis=1), np.array([got[i].n_links for i in range(len(v))])
    assert 0.2 < near[:2500, :2500].mean() < 0.9
    assert (found <= want).all() and found.sum() >= 0.99 * want.sum()
    assert {got[i].component_id for i in np.flatnonzero(want[:2500])} == {int(np.flatnonzero(want)[0])}


def test_bounds_leave_few_pairs():
    """Vectors of all directions alike, the hardest: of 20,000 candidates most are ruled out, and the best are found."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((20_000, 64))
    x = topk.scaled(x / np.linalg.norm(x, axis=1, keepdims=True))
    t = topk.make_table(x[:1024], float((x * x).sum(axis=1).max()), len(x))
    ids, q = np.arange(20_000), x[:50]
    found, evaluated = topk.search(t, x, ids, q, ids[:50], np.full(50, np.inf), 10)
    assert evaluated < 0.05 * 50 * 20_000
    for i, (best, scores) in enumerate(found):
        s = (x @ q[i]).astype(np.int64)
        want = [k for k in np.lexsort((ids, -s)) if k != i][:10]
        assert best.tolist() == want and scores.tolist() == s[want].tolist()


def test_repeated_queries_and_lengths(spark):
    rows = [(0, [1.0, 2.0]), (0, [0.5, 9.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0] * 3), (4, [2.0] * 3)]
    df = table(spark, rows)
    got = sorted(tuple(r) for r in top_k(df, df.where("vec_id in (0, 3)"), 3).collect())
    # the least vector of query 0; a repeated candidate counts each time
    assert got == [(0, 1, 1, 512 * 1024), (0, 2, 2, 512 * 1024), (0, 3, 2, 512 * 1024), (3, 1, 4, 3 * 2 * 1024 * 1024)]
