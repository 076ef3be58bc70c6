"""Vector tables as groups of rows, for searches of a query set against all rows in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, stored

#: Most vectors of one group (a unit of search reads one group and one batch of queries).
GROUP_ROWS = 16384
BATCH_QUERIES = 2048
#: Tasks for each core, before the batches of queries multiply them.
TASKS_A_CORE = 4


def usable(rows: DataFrame, vec_id: str, vec: str, zero_ok: bool) -> DataFrame:
    """``id`` and ``vec`` (doubles) of the rows that take part: id and vector
    not null, no null, NaN or infinite component, and (unless ``zero_ok``) not
    all zero. Of rows sharing an id, the largest vector in array order counts."""
    out = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(vec).alias("vec"))
    if dict(out.dtypes)["vec"] != "array<float>":  # floats stay in the shuffle: their order is that of the doubles
        out = out.withColumn("vec", F.col("vec").cast("array<double>"))
    out = out.filter("id IS NOT NULL AND vec IS NOT NULL AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))")
    if not zero_ok:
        out = out.filter("exists(vec, x -> x <> 0)")
    return out.groupBy("id").agg(F.max("vec").cast("array<double>").alias("vec"))


def grouped(rows: DataFrame, dim: int, n: int, name: str) -> DataFrame:
    """Rows gathered into groups of at most ``n`` vectors: ``ids`` (int64,
    ascending) and ``vecs`` (float64; shorter vectors end in zeros)."""
    parts = max(1, -(-rows.count() // n))
    dealt = rows.repartition(parts).sortWithinPartitions("id")  # even groups, whatever the ids

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vecs, held = [], [], 0

        def group():
            nonlocal ids, vecs, held
            i, v = np.concatenate(ids), np.concatenate(vecs)
            ids, vecs = [i[n:]], [v[n:]]
            held = len(ids[0])
            return pa.RecordBatch.from_pydict({"ids": pa.array([i[:n].tobytes()], pa.binary()), "vecs": pa.array([v[:n].tobytes()], pa.binary())})

        for b in batches:
            col = b.column("vec")
            lens = np.asarray(col.value_lengths())
            flat = np.asarray(col.flatten())
            v = np.zeros((len(lens), dim))
            v[np.arange(dim)[None, :] < lens[:, None]] = flat
            ids.append(np.asarray(b.column("id")))
            vecs.append(v)
            held += len(lens)
            while held >= n:
                yield group()
        if held:
            yield group()

    return stored(dealt.mapInArrow(gather, "ids binary, vecs binary"), name)


def search(
    rows: DataFrame,
    queries: DataFrame,
    k: int,
    unit: Callable[..., tuple[np.ndarray, np.ndarray, np.ndarray]],
    score: str,
    group_rows: int = GROUP_ROWS,
    batch_queries: int = BATCH_QUERIES,
) -> DataFrame:
    """The ``k`` best rows of every query: ``query_id``, ``rank``, ``vec_id``,
    ``score``. ``unit(query ids, queries, ids, vectors, k, floor=...)`` gives
    query positions (ascending), row positions and scores of one batch of
    queries against one group, where rows that score below the query's floor
    may be left out; the groups' best are merged per query, ties to the smaller
    id."""
    spark = rows.sparkSession
    bound_batches(spark)
    dim = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    groups = grouped(rows, dim, group_rows, "groups")
    batches = grouped(queries, dim, batch_queries, "queries").withColumnsRenamed({"ids": "qids", "vecs": "qvecs"})
    # each task reads its groups and its batches from the stored tables: by their compressed
    # size Spark would broadcast one side through the driver, and a join by key would shuffle
    # a copy of every batch for each group
    groups = groups.coalesce(TASKS_A_CORE * spark.sparkContext.defaultParallelism)
    pairs = groups.hint("shuffle_replicate_nl").crossJoin(batches)

    kind = np.int64 if score == "long" else np.float64
    nothing = np.iinfo(kind).min if score == "long" else -np.inf

    def run(units: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: dict[int, np.ndarray] = {}  # by a batch's first id: the best scores this task has found
        for u in units:
            for qi, qv, i, v in zip(*(u.column(c) for c in ("qids", "qvecs", "ids", "vecs"))):
                qids, ids = (np.frombuffer(x.as_py(), np.int64) for x in (qi, i))
                qvecs, vecs = (np.frombuffer(x.as_py()).reshape(-1, dim) for x in (qv, v))
                top = tops.get(qids[0], np.full((len(qids), k), nothing, kind))
                at, row, s = unit(qids, qvecs, ids, vecs, k, floor=top[:, 0])
                # k rows of this task score as much already
                fit = ~(s < top[at, 0])
                at, row, s = at[fit], row[fit], s[fit]
                slot = np.arange(len(at)) - np.searchsorted(at, at)
                more = np.full((len(qids), k), nothing, kind)
                more[at, slot] = s
                tops[qids[0]] = np.sort(np.hstack([top, more]), axis=1)[:, k:]
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(qids[at]), "vec_id": pa.array(ids[row]), "score": pa.array(s)})

    found = pairs.select("qids", "qvecs", "ids", "vecs").mapInArrow(run, f"query_id long, vec_id long, score {score}")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
