"""Exact top-k inner products by block-at-a-time pruning.

Components are the terms: each vector is quantised to integers; the vectors
of a group, in the order of their ids, are cut into blocks, and every block keeps the maximum (and, for
negative query weights, the minimum) of each component. A query's bound for a
block is the sum over its components of the larger product. A query first
scores its block of the highest bound through its forward rows, which sets its
k-th score. Then the blocks are visited in order of their falling highest bound,
each scored at once for all queries whose bound is not below the k-th score
found so far, in this group or one before it; a block whose bound equals it is
still scored, so ties go to the smaller id exactly.

Rows with a null id take no part, nor do vectors that are null or hold null or
non-finite components; of rows sharing an id, the largest vector counts.
Shorter vectors end in zeros."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import search, usable

BLOCK_ROWS = 64
SCALE = 256
_EXACT, _EXACT_SINGLE = 2.0**53, 2.0**24


def _largest(q: np.ndarray, v: np.ndarray) -> float:
    """No partial sum of an inner product of these is larger."""
    return float(np.abs(q).sum(axis=1).max(initial=0)) * float(np.abs(v).max(initial=0))


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products; in doubles where every partial sum is exact,
    else in Python integers (held within 64 bits). Vectors given in single
    precision are known to have exact sums there and stay in it."""
    if q.dtype == np.float32:
        return q @ v.T
    if _largest(q, v) < _EXACT:
        return (q @ v.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    out = whole(q).astype(object) @ whole(v).astype(object).T
    return np.clip(out, -(2**63), 2**63 - 1).astype(np.int64)


def block_search(qids, q, ids, v, k: int, block_rows: int = BLOCK_ROWS, floor: np.ndarray | None = None):
    """Positions of queries and rows, and scores, of each query's best ``k``
    rows other than its own (ties to smaller ids; ``ids`` ascend). Rows that
    score below the query's ``floor`` may be left out."""
    n, m = len(ids), len(qids)
    starts = np.arange(0, n, block_rows)
    top, low = np.maximum.reduceat(v, starts), np.minimum.reduceat(v, starts)
    bounds = np.maximum(q, 0) @ top.T + np.minimum(q, 0) @ low.T
    # sums beyond 2**53 are rounded: widen, never prune what might be in
    bounds += np.abs(bounds) * 1e-9 + (np.abs(q) @ np.maximum(np.abs(top), np.abs(low)).T) * 1e-12
    least = np.iinfo(np.int64).min
    best = np.full((m, k), least)
    best_row = np.full((m, k), n)  # n: nothing yet
    need = np.full(m, least) if floor is None else floor.astype(np.int64)  # the k-th scores so far
    if _largest(q, v) < _EXACT_SINGLE:
        q, v = q.astype(np.float32), v.astype(np.float32)

    def score_block(b: int, who: np.ndarray) -> None:
        rows = np.arange(starts[b], min(starts[b] + block_rows, n))
        score = _products(q if len(who) == m else q[who], v[rows[0] : rows[-1] + 1])
        # queries that the block has nothing for are done with it: an equal score may win by its id
        some = score.max(axis=1) >= need[who]
        if not some.any():
            return
        who, score = who[some], score[some].astype(np.int64)
        own = ids[rows][None, :] == qids[who][:, None]
        row = np.broadcast_to(rows, score.shape).copy()
        score[own], row[own] = least, n
        score, row = np.hstack([best[who], score]), np.hstack([best_row[who], row])
        keep = _rank(score, row)[:, :k]
        best[who], best_row[who] = np.take_along_axis(score, keep, 1), np.take_along_axis(row, keep, 1)
        need[who] = np.maximum(need[who], best[who, k - 1])

    if not m or not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # each query's own best block sets its k-th score; then the blocks by their highest bound,
    # each scored at once for all queries that it may still give a row
    first = bounds.argmax(axis=1)
    for b in np.unique(first):
        score_block(b, np.flatnonzero(first == b))
    for b in np.argsort(-bounds.max(axis=0), kind="stable"):
        open_ = (need == least) | (bounds[:, b] >= need)
        who = np.flatnonzero(open_ & (first != b))
        if len(who):
            score_block(b, who)
    at, slot = np.nonzero(best_row < n)
    return at, best_row[at, slot], best[at, slot]


def _rank(score: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Order of each line by falling score, then rising row; places without a row come last."""
    falling = np.where(score == np.iinfo(np.int64).min, np.iinfo(np.int64).max, ~score)
    return np.lexsort((row, falling), axis=1)


def top_k(embeddings: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vec: str = "embedding", scale: float = SCALE) -> DataFrame:
    """For each row where ``is_query`` holds, the ``k`` rows (without its own)
    of largest integer inner product of the components floor(scale * x):
    ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``. All rows if there
    are fewer; no rows from an empty table."""
    whole = embeddings.withColumn("__q", is_query).select(F.col(vec_id), F.col(vec), "__q")
    rows = usable(whole, vec_id, vec, zero_ok=True)
    rows = rows.withColumn("vec", F.expr(f"transform(vec, x -> floor(x * {float(scale)!r}D) * 1.0D)"))
    queries = rows.join(whole.filter("__q").select(F.col(vec_id).cast("long").alias("id")).distinct(), "id", "left_semi")
    return search(rows, queries, k, block_search, "long")


ORACLE_SQL = r"""
WITH v AS (
  SELECT vec_id, max(list_transform(embedding, lambda x: floor(256 * x::DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
