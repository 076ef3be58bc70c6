"""Vector searches against brute force, and odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import ann, topk
from strata.llm import vectors as tables


def vectors(spark, seed=1, n=400, dim=8):
    rng = np.random.default_rng(seed)
    v = rng.normal(0, 1, (n, dim)).round(2)
    if n > 150:
        v[50:150] = v[50]  # a hot vector
    rows = [(i, [float(x) for x in np.float32(r)], "x", "y") for i, r in enumerate(v)]
    odd = [
        (None, [1.0] * dim, "x", "y"), (1000, None, "x", "y"), (1001, [1.0, None] + [0.0] * (dim - 2), "x", "y"), (1002, [math.nan] * dim, "x", "y"),
        (1003, [math.inf] + [0.0] * (dim - 1), "x", "y"), (1004, [0.0] * dim, "x", "y"), (1005, [], "x", "y"), (1006, [5.0], "x", "y"), (0, [9.0] * dim, "x", "y"),
    ]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score string, rank string"), rows + odd


def usable(rows, dim, zero_ok):
    best = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not (zero_ok or any(v)):
            continue
        best[i] = max(best.get(i, []), [float(np.float32(x)) for x in v])
    return {i: v + [0.0] * (dim - len(v)) for i, v in best.items()}


def test_top_k_equals_brute_force(spark):
    df, rows = vectors(spark)
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 10 == 0, k=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    v = {i: [math.floor(256 * x) for x in x] for i, x in usable(rows, 8, True).items()}
    assert set(got) == {i for i in v if i % 10 == 0}
    for q, found in got.items():
        every = sorted((-sum(a * b for a, b in zip(v[q], x)), i) for i, x in v.items() if i != q)[:5]
        assert sorted(found) == [(k + 1, i, -s) for k, (s, i) in enumerate(every)]


def test_block_search_is_exact_for_huge_values():
    v = np.array([[2.0**30, 1.0], [2.0**30, 0.0], [1.0, 2.0**30], [0.0, 0.0]])
    at, row, score = topk.block_search(np.array([9]), np.array([[2.0**30, 1.0]]), np.arange(4), v, 3, block_rows=1)
    assert list(zip(row, score)) == [(0, 2**60 + 1), (1, 2**60), (2, 2**31)]


def test_fewer_rows_than_asked_and_none(spark):
    df, _ = vectors(spark, n=3)
    few = df.filter("vec_id < 3 AND size(embedding) = 8 AND embedding[0] < 9")
    n = few.select("vec_id").distinct().count()
    assert topk.top_k(few, F.lit(True), k=5).count() == n * (n - 1) == ann.nearest(few, F.lit(True)).count()
    for run in (topk.top_k, ann.nearest):
        assert run(df.limit(0), F.lit(True)).count() == 0
        assert run(df.filter("vec_id = 2"), F.lit(True)).count() == 0


def test_permutation_index_finds_the_nearest(spark):
    df, rows = vectors(spark, n=3000, dim=16)
    v = usable(rows, 16, False)
    ids = np.array(sorted(v))
    m = np.array([v[i] for i in ids])
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=20, share=0.15, least=100).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i in v if i % 20 == 0}
    recall = []
    for q, found in got.items():
        s = (m * np.array(v[q])).sum(axis=1)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        found.sort()
        assert [k for k, _, _ in found] == list(range(1, 21))
        assert all(x == pytest.approx(s[np.searchsorted(ids, i)], abs=1e-9) for _, i, x in found)
        assert [(-x, i) for _, i, x in found] == sorted((-x, i) for _, i, x in found)
        recall.append(len({i for _, i, _ in found} & set(ids[order])) / 20)
    assert np.mean(recall) >= 0.9


def test_a_block_is_scored_at_once_for_all_queries_it_may_serve(monkeypatch):
    rng = np.random.default_rng(3)
    v = np.floor(256 * rng.normal(0, 1, (2048, 16)))
    v[100:300] = v[100]  # equal scores: smaller ids win
    ids, calls, plain = np.arange(2048) * 3, [], topk._products
    monkeypatch.setattr(topk, "_products", lambda q, x: calls.append(len(q)) or plain(q, x))
    at, row, score = topk.block_search(ids[::8], v[::8], ids, v, 5, block_rows=32)
    assert len(calls) <= 2 * 64  # not a call for every query and block
    for i, q in enumerate(range(0, 2048, 8)):
        s = (v @ v[q]).astype(int)
        want = [r for r in np.lexsort((ids, -s)) if r != q][:5]
        assert row[at == i].tolist() == want and score[at == i].tolist() == s[want].tolist()


@pytest.mark.parametrize("unit, score", [(topk.block_search, "long"), (ann.permutation_search(np.eye(4), 4, 1.0, 1000), "double")])
def test_batches_meet_groups_without_the_driver_or_a_shuffle(spark, unit, score):
    rng = np.random.default_rng(5)
    v = np.floor(9 * rng.normal(0, 1, (600, 4)))
    v[100:140] = v[100]
    rows = spark.createDataFrame([(3 * i, x.tolist()) for i, x in enumerate(v)], "id long, vec array<double>")
    found = tables.search(rows, rows.filter("id % 2 = 0"), 3, unit, score, group_rows=50, batch_queries=16)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "CartesianProduct" in plan
    assert plan.count("Exchange") == 1  # each task's best by query, and nothing else
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 1800, 6))
    for q, best in got.items():
        s = (v @ v[q // 3]).astype(int)
        want = [r for r in np.lexsort((np.arange(600), -s)) if 3 * r != q][:3]
        assert best == {k + 1: (3 * r, s[r]) for k, r in enumerate(want)}


@pytest.mark.parametrize("scale", [1.0, 2.0**14, 2.0**26])
def test_block_search_keeps_all_rows_from_the_floor_on(scale):
    rng = np.random.default_rng(7)
    v = np.floor(3 * rng.normal(0, 1, (500, 6))) * scale
    ids, exact = np.arange(500), [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in v] for x in v[::10]]
    floor = np.array([sorted(s)[-4 - 3 * (i % 5)] for i, s in enumerate(exact)])
    at, row, score = topk.block_search(ids[::10], v[::10], ids, v, 4, block_rows=8, floor=floor)
    for i, s in enumerate(exact):
        want = [(r, s[r]) for r in sorted(range(500), key=lambda r: (-s[r], r)) if r != 10 * i and s[r] >= floor[i]][:4]
        assert [x for x in zip(row[at == i], score[at == i]) if x[1] >= floor[i]] == want


def test_floats_are_shuffled_as_floats(spark):
    rows = [(1, [1.5, -0.1]), (1, [1.5, 0.1]), (1, [0.7] * 3), (2, [0.1]), (2, [0.1, -5.0]), (3, [math.nan]), (None, [1.0])]
    for kind in ("float", "double", "decimal(3,1)"):
        df = spark.createDataFrame(rows[:-2] + rows[-1:], "id long, vec array<double>").selectExpr("id", f"cast(vec AS array<{kind}>) AS vec")
        if kind != "decimal(3,1)":
            df = df.union(spark.createDataFrame(rows[-2:-1], df.schema))
        out = tables.usable(df, "id", "vec", zero_ok=False)
        assert dict(out.dtypes) == {"id": "bigint", "vec": "array<double>"}
        as_kind = np.float32 if kind == "float" else float
        assert {r["id"]: r["vec"] for r in out.collect()} == {1: [1.5, float(as_kind(0.1))], 2: [float(as_kind(0.1)), -5.0]}
        assert ("cast(max(vec" in out._jdf.queryExecution().optimizedPlan().toString()) == (kind == "float")
