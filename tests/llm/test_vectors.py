"""Embedding near-duplicates and exact top-k against brute force, and their edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopmetrics.llm import capfilter, topk
from shopmetrics.llm.store import on_workers, table

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(autouse=True)
def _workers(spark):
    on_workers(spark)


def brute_links(rows, least=capfilter.COSINE):
    ok = [(i, np.array(v, float), lab) for i, v, lab in rows
          if i is not None and v is not None and lab is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    links = []
    for k, (a, x, p) in enumerate(ok):
        for b, y, q in ok[k + 1 :]:
            if p == q and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                links.append((a, b))
    return links


def brute_near(rows):
    links = brute_links(rows)
    up = {i: i for i, _, _ in rows}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    n_links = dict.fromkeys(up, 0)
    for a, b in links:
        n_links[a] += 1
        n_links[b] += 1
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: (n_links[i], root(i), root(i) == i) for i in up}


def clusters(seed=0, dim=24):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, 2):
        for _ in range(5):
            base = rng.normal(size=dim)
            for _ in range(12):
                rows.append((base + rng.normal(size=dim) * rng.choice([0.02, 0.15, 0.3])).astype(np.float32).tolist())
        rows += [rng.normal(size=dim).astype(np.float32).tolist() for _ in range(30)]
    rows += [rows[0], rows[0], rows[1]]
    return [(i, v, (i // 90) % 3 if i < 270 else 0) for i, v in enumerate(rows)]


def recall(spark, rows):
    want = {i: v[0] for i, v in brute_near(rows).items()}
    got = {r["vec_id"]: r["n_links"] for r in capfilter.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] <= want[i] for i in want)  # none is invented
    return sum(got.values()) / sum(want.values())


def test_near_vectors_are_those_of_brute_force(spark):
    rows = clusters()
    assert recall(spark, rows) >= 0.99
    close = [(i, [round(x, 1) for x in v], p) for i, v, p in rows]  # copies, and nothing at the threshold
    apart = [(i, v if k % 3 else close[k - k % 3][1], p) for k, (i, v, p) in enumerate(close) if k % 5 < 2]
    got = {r[0]: tuple(r)[1:] for r in capfilter.near_vectors(spark.createDataFrame(apart, SCHEMA)).collect()}
    assert got == brute_near(apart)


@pytest.mark.parametrize("cos", [0.931, 0.95, 0.98])
def test_recall_of_links_of_planted_pairs(spark, cos):
    """Pairs at and above the threshold among the given vectors of one label."""
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r.vec_id, r.embedding, 1) for r in df.limit(1000).collect()]
    rng = np.random.default_rng(9)
    for i, v, _ in rows[:300]:
        v = np.array(v) / np.linalg.norm(v)
        w = rng.normal(size=len(v))
        w -= (w @ v) * v
        rows.append((10**6 + i, (cos * v + np.sqrt(1 - cos**2) * w / np.linalg.norm(w)).tolist(), 1))
    assert recall(spark, rows) >= 0.97


def test_a_hot_filter_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(capfilter, "BLOCK", 16)
    rng = np.random.default_rng(1)
    base = rng.normal(size=16)
    rows = [(i, (base + rng.normal(size=16) * 0.1).astype(np.float32).tolist(), 1) for i in range(150)]
    got = {r[0]: tuple(r)[1:] for r in capfilter.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute_near(rows)


def test_near_vectors_edges(spark):
    v, nan = [1.0, 2.0, 2.0], float("nan")
    rows = [(1, v, 1), (2, [2.0, 4.0, 4.0], 1), (3, v, None), (4, None, 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 2.0], 1), (7, [1.0, nan, 2.0], 1),
            (8, [float("inf"), 0.0, 0.0], 1), (9, [1.0, 2.0], 1), (10, [], 1), (None, v, 1), (11, v, 2), (12, [1e-30, 2e-30, 2e-30], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rep", F.lit(1)).withColumn("v", F.lit("x"))
    got = {r[0]: tuple(r)[1:] for r in capfilter.near_vectors(df).collect()}
    assert got == {1: (2, 1, True), 2: (2, 1, False), 12: (2, 1, False), None: (0, None, True), **{i: (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)}}
    assert capfilter.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    twice = capfilter.near_vectors(spark.createDataFrame([(1, v, 1), (1, v, 1)], SCHEMA)).collect()
    assert [tuple(r) for r in twice] == [(1, 1, 1, True)] * 2


def test_list_decoding_finds_every_filter_over_the_threshold():
    rng = np.random.default_rng(2)
    unit = capfilter._unit(rng.normal(size=(20, 12)))
    code = capfilter.filter_code(12, 32)
    rows, labels = capfilter.list_decode(unit, code)
    rotation, codes, cuts = code
    turned = unit @ rotation
    a, b = turned[:, : cuts[1]] @ codes[0].T, turned[:, cuts[1] :] @ codes[1].T
    for i in range(20):
        total = (a[i][:, None] + b[i][None]).ravel()
        mine = set(labels[rows == i].tolist())
        least = min(total[sorted(mine)])
        assert mine == set(np.flatnonzero(total >= least - 1e-12).tolist()) and len(mine) >= capfilter.LEAST_FILTERS


def brute_top(rows, k=topk.K):
    ok = {i: np.floor(64 * np.array(v, float)).astype(int) for i, v in rows
          if i is not None and v is not None and v and None not in v and np.isfinite(np.array(v, float)).all()}
    out = []
    for q in sorted(i for i in ok if i % topk.QUERY_EVERY == 0):
        scores = sorted((-int(ok[q] @ ok[x]), x) for x in ok if x != q and len(ok[x]) == len(ok[q]))
        out += [(q, n, x, -s) for n, (s, x) in enumerate(scores[:k], 1)]
    return out


@pytest.mark.parametrize("blocks", [(512, 8192), (3, 17)])
def test_top_k_is_that_of_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "VECTOR_BLOCK", blocks[1])
    rng = np.random.default_rng(3)
    rows = [(i, (np.round(rng.normal(size=10) * 2) / 8).astype(np.float32).tolist()) for i in range(200)]  # many ties
    rows += [(200 + i, rows[i % 7][1]) for i in range(60)]
    got = [tuple(r) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect()]
    assert got == brute_top(rows)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    q, x = (np.floor(rng.normal(size=(30, 64)) * 20) for _ in range(2))
    for segments in topk.LEVELS:
        (_, qm, qd), (_, xm, xd) = topk.segment_statistics(q, segments), topk.segment_statistics(x, segments)
        assert (qm @ xm.T + qd @ xd.T >= q @ x.T - 1e-6).all()


def test_top_k_edges(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.5]), (20, [1.0, nan]), (40, None), (60, [1.0, 2.0, 3.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [None, 1.0]), (None, [1.0, 1.0]),
            (0, [1.0, 0.5]), (-20, [-1.0, -0.25]), (5, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("r")).withColumn("v", F.lit(2)).withColumn("qb", F.lit(1))
    got = [tuple(r) for r in topk.top_k(df).orderBy("query_id", "rank").collect()]
    unique = {i: v for i, v in rows if i is not None}
    assert got == brute_top(list(unique.items())) and [g[:3] for g in got[-3:]] == [(0, 1, 1), (0, 2, 2), (0, 3, -20)]
    assert topk.top_k(df.limit(0)).collect() == []
