"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is put into a random but fixed order (a hash of the document id
and the text) and its words are cut into blocks along that order. A target of T words takes
the blocks of one pass over the source, then of a second pass if T exceeds the
source's size; the last document is cut so that T is met to the word. The
blocks are dealt out to output shards by a tree: each node splits the exact
block counts of all sources between its two halves by one draw from the
multivariate hypergeometric distribution, so every shard is a uniform sample
without replacement and the shards are disjoint. A shard holds a contiguous
run of each source's permuted blocks and is shuffled by itself.

Only the table of sources (guarded by ``max_sources``) meets on the driver.
A null source is a source of its own, ordered last. Null and empty texts have
0 words and are never taken."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, words

#: Blocks that all targets together are cut into, at every input size.
BLOCKS = 1 << 16
#: Hash buckets of a source, between which running sums are carried.
BUCKET_DIGITS = 3
PASSES = 2


def targets(sizes: list[int], weights: list[float], share: float, cap: float) -> list[float]:
    """Words per source: ``share`` of all words by weight, each at most
    ``cap`` times its source; the excess goes to the others by weight until
    none is above. The capped sources are those with the smallest size per
    weight, so one sweep in that order finds the common level."""
    out, left, rest = [0.0] * len(sizes), share * sum(sizes), float(sum(weights))
    order = sorted(range(len(sizes)), key=lambda i: cap * sizes[i] / weights[i])
    for at, i in enumerate(order):
        if left / rest <= cap * sizes[i] / weights[i]:
            for j in order[at:]:
                out[j] = min(left / rest * weights[j], cap * sizes[j])
            break
        out[i] = cap * sizes[i]
        left, rest = left - out[i], rest - weights[i]
    return out


def split_tree(blocks: list[int], shards: int, seed: int) -> list[list[int]]:
    """Blocks of each source that each shard draws: [shard][source]."""
    rng = np.random.Generator(np.random.PCG64(seed))
    out: list[list[int]] = []

    def node(counts: np.ndarray, n: int) -> None:
        if n == 1:
            out.append([int(x) for x in counts])
            return
        half = n // 2
        left = rng.multivariate_hypergeometric(counts, int(counts.sum()) * half // n, method="marginals")
        node(left, half)
        node(counts - left, n - half)

    node(np.asarray(blocks, dtype=np.int64), shards)
    return out


def assign_mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    shards: int = 64,
    seed: int = 17,
    source: str = "source",
    text: str = "text",
    doc_id: str = "doc_id",
    max_sources: int = 100_000,
    with_order: bool = False,
) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` (of its
    source), ``take_1`` and ``take_2`` (words taken in the first and second
    pass, from the text's start) and ``shard_1``, ``shard_2`` (where they go).
    Sources in code-point order, null last, have the ``weights`` in turn.
    Columns of these names in ``docs`` are replaced. Rows of one id go by their
    texts, so reruns agree however the rows are partitioned; only rows equal
    in id and text may change places with each other."""
    spark = docs.sparkSession
    if not 0 < cap <= PASSES or not 0 <= share <= cap:
        raise ValueError("0 <= share <= cap <= 2 is needed")
    mark = F.concat_ws(":", F.col(doc_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    rows = docs.withColumns({"size": words(text), "__h": F.md5(mark.cast("binary"))})
    rows = rows.withColumn("__b", F.substring("__h", 1, BUCKET_DIGITS))
    found = rows.groupBy(F.col(source).alias("__s")).agg(F.sum("size").alias("n")).orderBy(F.asc_nulls_last("__s")).limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources; group them first")
    sizes = [r["n"] for r in found]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, cap)
    take = [int(np.floor(t + 0.5)) for t in goal]
    block = max(1, -(-sum(take) // BLOCKS))
    quota = split_tree([-(-t // block) for t in take], shards, seed) if take else []
    ends = np.cumsum(np.asarray(quota, dtype=np.int64).reshape(len(quota), len(take)), axis=0)
    plan = spark.createDataFrame(
        [(r["__s"], r["n"], g, t, [int(x) for x in ends[:, i]]) for i, (r, g, t) in enumerate(zip(found, goal, take))],
        "__s string, source_size long, target double, __take long, __ends array<bigint>",
    )
    # running words of a source: between buckets from their sums, inside a bucket by a window
    sums = rows.groupBy(F.col(source).alias("__s"), F.col("__b").alias("__bb")).agg(F.sum("size").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__s").orderBy("__bb").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("__s", "__bb", F.coalesce(before, F.lit(0)).alias("__before"))
    sums = sums.join(F.broadcast(plan.withColumnRenamed("__s", "__p")), F.col("__s").eqNullSafe(F.col("__p")))  # one row per source
    inner = Window.partitionBy(source, "__b").orderBy("__h", doc_id, "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.drop("source_size", "target").withColumn("__in", F.sum("size").over(inner) - F.col("size"))
    rows = rows.join(sums, F.col(source).eqNullSafe(F.col("__s")) & (F.col("__b") == F.col("__bb")))
    for p in range(PASSES):
        start = F.col("__before") + F.col("__in") + F.lit(p) * F.col("source_size")
        got = F.greatest(F.lit(0), F.least(F.col("size"), F.col("__take") - start)).cast("long")
        at = F.floor(start / F.lit(block))
        where = F.size(F.filter("__ends", lambda e: e <= at)).cast("int")  # a second parameter would be the index
        rows = rows.withColumns({f"take_{p + 1}": got, f"shard_{p + 1}": F.when(got > 0, where)})
    return rows.drop("__b", "__s", "__n", "__before", "__p", "__take", "__ends", "__in", "__bb", *([] if with_order else ["__h"]))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", seed: int = 17, out: tuple[str, str] = ("shard", "shuffle_key"), **options) -> DataFrame:
    """The mixture itself: one row per document and pass with its columns, the
    text cut to the words taken, and the columns ``out`` (replaced if
    present): its shard, and a key; sorting a shard by the key shuffles it."""
    rest = [c for c in docs.columns if c != text]
    lean = docs.select(doc_id, text, source, F.struct(*rest).alias("__rest"))  # other columns may have any name
    rows = assign_mix(lean, text=text, doc_id=doc_id, source=source, seed=seed, with_order=True, **options)
    takes = F.array(*[F.struct(F.lit(p).alias("p"), F.col(f"take_{p}").alias("n"), F.col(f"shard_{p}").alias("shard")) for p in range(1, PASSES + 1)])
    rows = rows.withColumn("__t", F.explode(F.filter(takes, lambda t: t["n"] > 0)))
    lead = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(rf"([\x20\x09-\x0D]*{WORD})"), 1), F.lit(1), F.col("__t.n").cast("int")), "")
    cut = F.when(F.col("__t.n") < F.col("size"), lead).otherwise(F.col(text))
    columns = [(cut if c == text else F.col("__rest")[c]).alias(c) for c in docs.columns if c not in out]
    return rows.select(*columns, F.col("__t.shard").alias(out[0]), F.xxhash64(F.lit(seed), F.col("__h"), F.col("__t.p")).alias(out[1]))


def by_shard(mixed: DataFrame, shard: str = "shard", shuffle_key: str = "shuffle_key") -> DataFrame:
    """A mixture dealt by shard, in each partition shard after shard and each
    shard shuffled; a shard too large for one partition is split over several."""
    return mixed.hint("rebalance", shard).sortWithinPartitions(shard, shuffle_key)


def write_mix(mixed: DataFrame, path: str) -> None:
    """Write a mixture in folders ``shard=0`` ..., each file shuffled by itself."""
    by_shard(mixed).write.partitionBy("shard").parquet(path)


#: DuckDB SQL for the words taken of every document (the draws of the tree have none).
TAKEN_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws(':', doc_id::VARCHAR, md5(coalesce(text, '')))) AS h
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY source),
s1 AS (SELECT source, n, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w FROM s0),
s2 AS (
  SELECT source, n, w, 2.0::DOUBLE * n / w AS ratio,
         1.5::DOUBLE * sum(n) OVER () - 2.0::DOUBLE * coalesce(sum(n) OVER (ORDER BY 2.0::DOUBLE * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_words,
         sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY 2.0::DOUBLE * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_weight
  FROM s1),
lv AS (SELECT arg_min(left_words / left_weight, ratio) AS level FROM s2 WHERE left_words / left_weight <= ratio),
s AS (SELECT source, n, least(level * w, 2.0::DOUBLE * n) AS target FROM s2, lv),
o AS (
  SELECT d.doc_id, d.size, s.n AS source_size, s.target, floor(s.target + 0.5)::BIGINT AS take,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS start
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, take - start)) + greatest(0, least(size, take - start - source_size)))::BIGINT AS taken
FROM o
"""
