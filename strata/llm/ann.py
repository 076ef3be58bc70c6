"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots (the first
``prefix`` of them). Each pivot posts the vectors that name it, with the rank
they give it. A query walks the postings of its own pivots and adds up, for
every vector met there, what the shared pivots save of the footrule distance
(missing pivots count as rank ``prefix``); the nearest by footrule are
reranked by the exact measure.

Pivots come from a bounded sample (the first rows by a hash of the id), spread
apart so that a tight cluster does not fill them; every row is indexed. The share of a group that is reranked is a
parameter of the index: recall rises with it (the README has measured values).
Equal vectors are one entry of a group's index, so copies of one vector do not
crowd out the others.

Rows with a null id take no part, nor do vectors that are null, zero or hold
null or non-finite components; of rows sharing an id, the largest vector
counts. Shorter vectors end in zeros."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import search, usable

PIVOTS = 256
PREFIX = 96
PIVOT_COSINE = 0.8
#: Share of a group's distinct vectors, and least number of them, that a query reranks.
RERANK_SHARE = 0.15
RERANK_LEAST = 400


def pivot_order(v: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first (pivots have length 1)."""
    near = v @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix]


def spread(sample: list[tuple[float, ...]], dim: int, pivots: int) -> np.ndarray:
    """Directions of up to ``pivots`` vectors of the sample, none within
    ``PIVOT_COSINE`` of an earlier one: a tight cluster gets one pivot."""
    v = np.array(sample, dtype=np.float64).reshape(len(sample), dim)
    v /= np.abs(v).max(axis=1, keepdims=True, initial=0)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    kept = np.zeros((0, dim))
    for x in v:
        if len(kept) == pivots:
            break
        if not len(kept) or (kept @ x).max() < PIVOT_COSINE:
            kept = np.vstack([kept, x])
    return kept


def permutation_search(pivots: np.ndarray, prefix: int, share: float, least: int):
    """A unit of search (see ``vectors.search``) over these pivots."""

    def unit(qids, q, ids, v, k: int, floor=None):
        # equal vectors are one entry of the index; its rows (ids ascend) join again at the end
        v, entry, copies = np.unique(v, axis=0, return_inverse=True, return_counts=True)
        rows_of, first = np.argsort(entry.ravel(), kind="stable"), np.cumsum(copies) - copies
        n, depth = len(v), min(prefix, len(pivots))
        order = pivot_order(v, pivots, depth)
        # the inverted file: entries by pivot, with the rank they give it
        by_pivot = np.argsort(order.ravel(), kind="stable")
        ends = np.cumsum(np.bincount(order.ravel(), minlength=len(pivots)))
        post_entry, post_rank = by_pivot // depth, (by_pivot % depth).astype(np.int32)
        asked = pivot_order(q, pivots, depth)
        want = min(n, max(least, k + 1, int(np.ceil(share * n))))
        at, rows, scores = [], [], []
        for i in range(len(qids)):
            saved = np.zeros(n, np.int32)
            for rank, p in enumerate(asked[i]):
                lo, hi = (ends[p - 1] if p else 0), ends[p]
                saved[post_entry[lo:hi]] += 2 * (depth - np.maximum(post_rank[lo:hi], rank))
            if want < n:  # all above the limit, then the first at it
                limit = np.partition(saved, n - want)[n - want]
                near = np.flatnonzero(saved > limit)
                near = np.concatenate([near, np.flatnonzero(saved == limit)[: want - len(near)]])
            else:
                near = np.arange(n)
            score = (v[near] * q[i]).sum(axis=1)  # each entry by itself: the order of summing is fixed
            top = np.lexsort((ids[rows_of[first[near]]], -score))[: k + 1]  # one of them may be the query's own
            row = np.concatenate([rows_of[first[e] : first[e] + min(copies[e], k + 1)] for e in near[top]])
            score = np.repeat(score[top], np.minimum(copies[near[top]], k + 1))
            other = ids[row] != qids[i]
            row, score = row[other], score[other]
            best = np.lexsort((ids[row], -score))[:k]
            at.append(np.full(len(best), i))
            rows.append(row[best])
            scores.append(score[best])
        return np.concatenate(at), np.concatenate(rows), np.concatenate(scores)

    return unit


def nearest(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    vec: str = "embedding",
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    share: float = RERANK_SHARE,
    least: int = RERANK_LEAST,
) -> DataFrame:
    """For each row where ``is_query`` holds, ``k`` rows (without its own) of
    the largest inner product found: ``query_id``, ``rank`` (from 1),
    ``vec_id``, ``score`` (the exact inner product). All rows if there are
    fewer; no rows from an empty table."""
    whole = embeddings.withColumn("__q", is_query).select(F.col(vec_id), F.col(vec), "__q")
    rows = usable(whole, vec_id, vec, zero_ok=False)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(8 * pivots).collect()  # a bounded sample
    dim = max((len(r["vec"]) for r in sample), default=0)
    units = spread([tuple(r["vec"]) + (0.0,) * (dim - len(r["vec"])) for r in sample], dim, pivots)
    find = permutation_search(units, prefix, share, least)

    def unit(qids, q, ids, v, k, floor):
        wide = v.shape[1] - dim  # vectors longer than any pivot
        return (permutation_search(np.pad(units, ((0, 0), (0, wide))), prefix, share, least) if wide > 0 else find)(qids, q, ids, v, k)

    queries = rows.join(whole.filter("__q").select(F.col(vec_id).cast("long").alias("id")).distinct(), "id", "left_semi")
    return search(rows, queries, k, unit, "double")
