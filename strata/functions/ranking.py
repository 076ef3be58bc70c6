"""Exact global order statistics without a single-partition step.

``Window.orderBy(x)`` with no partition key moves every row into one task; an
exact ``percentile`` keeps every distinct value of the group in one buffer.
Both break once the input no longer fits one executor. The helpers here give
the same exact answers from plans in which every step is partitioned.

``global_rank`` (every row needs its rank):

1. collapse the input to its distinct values with multiplicities (partial
   aggregation first, so a value held by a third of the rows is one row);
2. cut the distinct values into ``buckets`` ranges at approximate quantiles
   (one ``percentile_approx`` row, broadcast) and find each value's range by
   binary search;
3. count rows per range (<= ``buckets`` rows, so a global window over them is
   bounded) and take a running count inside each range (one range per task,
   about 1/``buckets`` of the distinct values; no ties inside a range because
   values are distinct). Rank = 1 + rows strictly before.

``quantile_targets`` (only a few positions are needed, of one or many columns)
brackets each target with approximate quantiles, counts the rows outside the
bracket exactly and sorts only the rows inside it; see its docstring.

Nothing runs until the caller's action."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scalars import with_scalars

DEFAULT_BUCKETS = 1024


def bucket_of(x: str, bounds: str, n: int) -> Column:
    """Number of the ``n`` ascending ``bounds`` (an array column) that are < x
    (a column): a binary search of ceil(log2(n + 1)) steps per row, so
    ``buckets`` can grow with the data without growing the per-row cost."""
    steps = max(1, math.ceil(math.log2(n + 1)))
    mid = "shiftright(a.lo + a.hi, 1)"
    return F.expr(
        f"aggregate(sequence(1, {steps}), named_struct('lo', 0, 'hi', size({bounds})), "
        f"(a, i) -> CASE WHEN {mid} < a.hi AND element_at({bounds}, {mid} + 1) < {x} "
        f"THEN named_struct('lo', {mid} + 1, 'hi', a.hi) ELSE named_struct('lo', a.lo, 'hi', {mid}) END, "
        "a -> a.lo)"
    )


def _bounds(values: DataFrame, buckets: int) -> DataFrame:
    """One row: approximate range bounds ``_b`` of the distinct values and the
    row total ``_N``. Reading ``_n`` keeps this branch's input identical to the
    other branches', so Spark computes the distinct values once (exchange reuse)."""
    probs = [i / buckets for i in range(1, buckets)]
    return values.agg(F.percentile_approx("_x", probs, 10000).alias("_b"), F.sum("_n").alias("_N"))


def _bucketed(values: DataFrame, bounds: DataFrame, buckets: int) -> DataFrame:
    """Attach ``_bk``: the range of ``_x`` among ``buckets`` approximate
    quantile ranges of the distinct values (one broadcast row of bounds). A
    null ``_x`` gets range -1, the first in ascending and the last in
    descending order, which is where Spark sorts nulls."""
    return values.crossJoin(F.broadcast(bounds.select("_b"))).select(
        "_x",
        "_n",
        F.when(F.col("_x").isNull(), F.lit(-1)).otherwise(bucket_of("_x", "_b", buckets - 1)).alias("_bk"),
    )


def _bucket_offsets(vb: DataFrame, descending: bool) -> DataFrame:
    """Per range: rows in it (``_bn``) and rows in all earlier ranges (``_off``);
    at most ``buckets`` rows, so the global window is bounded."""
    order = "DESC" if descending else "ASC"
    return vb.groupBy("_bk").agg(F.sum("_n").alias("_bn")).selectExpr(
        "_bk", "_bn",
        f"coalesce(sum(_bn) OVER (ORDER BY _bk {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _off",
    )


def _within(descending: bool) -> Column:
    order = "DESC" if descending else "ASC"
    return F.expr(
        f"coalesce(sum(_n) OVER (PARTITION BY _bk ORDER BY _x {order} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )


def positions(values: DataFrame, descending: bool = False, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """``values`` has one row per distinct ``_x`` with multiplicity ``_n``.

    Adds ``_before``: the number of input rows strictly before ``_x`` in the
    requested order."""
    vb = _bucketed(values, _bounds(values, buckets), buckets)
    per = _bucket_offsets(vb, descending).select("_bk", "_off")
    v = vb.withColumn("_in", _within(descending))
    return v.join(F.broadcast(per), "_bk").select("_x", "_n", (F.col("_off") + F.col("_in")).alias("_before"))


def global_rank(
    df: DataFrame,
    by: str,
    out: str = "rank",
    descending: bool = True,
    buckets: int = DEFAULT_BUCKETS,
) -> DataFrame:
    """``rank()`` over the whole table ordered by ``by`` (gaps after ties),
    without moving the table into one partition. Nulls sort last when
    descending and first when ascending, as in Spark; they are one more
    (value, count) row, so no separate pass counts them."""
    values = df.select(F.col(by).alias("_x")).groupBy("_x").agg(F.count(F.lit(1)).alias("_n"))
    ranks = positions(values, descending, buckets).select(
        F.col("_x").alias("_rk"), (F.col("_before") + 1).cast("int").alias(out)
    )
    # one row per distinct value; AQE broadcasts it only when its runtime
    # size is under the threshold, else it is a shuffle join
    return df.join(ranks, df[by].eqNullSafe(F.col("_rk")), "left").drop("_rk")


#: Cells that a bracket is cut into when it is narrowed.
CELLS = 1024


def _narrowed(vals: DataFrame, br: DataFrame, at: Sequence[int]) -> DataFrame:
    """``br`` with narrower brackets, from one more pass: the values of each
    bracket are counted in ``CELLS`` equal cells (a group for each, whatever
    the number of values), and the cells of floor(h) and ceil(h) become the
    bracket. Positions just outside keep the value next to the bracket."""

    def cell(k: int, i: int) -> str:
        width = f"(_hi{k} - _lo{k})"
        part = f"CASE WHEN {width} > 0 AND {width} < DOUBLE('Infinity') THEN least(CAST(floor((_x{i} - _lo{k}) / {width} * {CELLS}) AS INT), {CELLS - 1}) ELSE 0 END"
        return f"CASE WHEN _x{i} < _lo{k} THEN -1 WHEN _x{i} > _hi{k} THEN {CELLS} ELSE {part} END"

    entries = ", ".join(
        f"CASE WHEN _x{i} IS NOT NULL THEN named_struct('k', {k}, 'c', {cell(k, i)}, 'v', _x{i}, 'h', _h{k}) END" for k, i in enumerate(at)
    )
    tagged = with_scalars(vals, br).select(F.expr(f"explode(array({entries}))").alias("_e")).where("_e IS NOT NULL")
    counted = tagged.groupBy(F.col("_e.k").alias("_k"), F.col("_e.c").alias("_c")).agg(
        F.count(F.lit(1)).alias("_n"), F.max("_e.v").alias("_max"), F.min("_e.v").alias("_min"), F.max("_e.h").alias("_h")
    )
    # at most CELLS + 2 rows a target
    before = "coalesce(sum(_n) OVER (PARTITION BY _k ORDER BY _c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    pos = counted.selectExpr("*", f"{before} AS _before")
    cols = []
    for k in range(len(at)):
        for side, p, inside in (("lo", "floor(_h)", "_min"), ("hi", "ceil(_h)", "_max")):
            bound = f"CASE WHEN _c = -1 THEN _max WHEN _c = {CELLS} THEN _min ELSE {inside} END"
            cols.append(F.expr(f"max(CASE WHEN _k = {k} AND _before <= {p} AND {p} < _before + _n THEN {bound} END)").alias(f"_{side}{k}"))
        cols.append(F.expr(f"max(CASE WHEN _k = {k} THEN _h END)").alias(f"_h{k}"))
    return pos.agg(*cols)


def quantile_targets(
    df: DataFrame, targets: Sequence[tuple[str | Column, float, str]], accuracy: int = 10000, narrow: int = 0
) -> DataFrame:
    """One row with the exact, linearly interpolated quantile ``p`` (position h
    = (n-1)*p, as SQL ``percentile_cont``) of every target ``(x, p, name)``.
    Nulls and NaN are ignored; a column without values gives null.

    Two passes over the input for all targets together, both partitioned
    aggregates:

    1. ``percentile_approx`` at p -/+ 3/accuracy brackets every target. Its
       rank error is at most n/accuracy, and the two ways of counting positions
       differ by less than one, so for every n the bracket holds positions
       floor(h) and ceil(h) or ends right beside them.
    2. Every row goes, per target, to its value inside the bracket or to one
       of two groups outside, of which only the count and the value next to
       the bracket are kept. A value shared by many rows is one group. A
       running count over a target's groups (distinct values of about
       6n/accuracy rows, in one task per target) gives exact positions.

    ``narrow`` adds that many passes between the two, each cutting a bracket
    to about 1/``CELLS`` of its values before anything is ordered: 6n/accuracy
    values of 10^12 rows are 6 * 10^8, after one pass about 10^6.

    If a bracket ever missed its target the query would fail loudly instead of
    returning a wrong number."""
    none = F.lit(None).cast("double")
    xs: dict[str, Column] = {}
    at = []
    for x, _, _ in targets:
        key = x if isinstance(x, str) else str(x)
        if key not in xs:
            xs[key] = F.nanvl((F.col(x) if isinstance(x, str) else x).cast("double"), none)
        at.append(list(xs).index(key))
    vals = df.select(*[c.alias(f"_x{i}") for i, c in enumerate(xs.values())])
    ks = range(len(targets))
    probs = [float(p) for _, p, _ in targets]
    names = [name for _, _, name in targets]
    d = 3.0 / accuracy
    aggs = []
    for i in range(len(xs)):
        mine = [probs[k] for k in ks if at[k] == i]
        grid = [max(0.0, p - d) for p in mine] + [min(1.0, p + d) for p in mine]
        aggs += [F.percentile_approx(f"_x{i}", grid, accuracy).alias(f"_a{i}"), F.count(f"_x{i}").alias(f"_N{i}")]
    cols = []
    for k in ks:
        i = at[k]
        place, size = sum(at[j] == i for j in range(k)), at.count(i)
        cols += [f"_a{i}[{place}] AS _lo{k}", f"_a{i}[{size + place}] AS _hi{k}", f"(_N{i} - 1) * CAST({probs[k]!r} AS DOUBLE) AS _h{k}"]
    br = vals.agg(*aggs).selectExpr(*cols)
    for _ in range(narrow):
        br = _narrowed(vals, br, at)
    entries = ", ".join(
        f"CASE WHEN _x{i} < _lo{k} THEN named_struct('k', {k}, 'r', -1, 'x', CAST(NULL AS DOUBLE), 'v', _x{i}, 'h', _h{k}) "
        f"WHEN _x{i} > _hi{k} THEN named_struct('k', {k}, 'r', 1, 'x', CAST(NULL AS DOUBLE), 'v', _x{i}, 'h', _h{k}) "
        f"WHEN _x{i} IS NOT NULL THEN named_struct('k', {k}, 'r', 0, 'x', _x{i}, 'v', _x{i}, 'h', _h{k}) END"
        for k, i in enumerate(at)
    )
    tagged = with_scalars(vals, br).select(F.expr(f"explode(array({entries}))").alias("_e")).where("_e IS NOT NULL")
    counted = tagged.groupBy(F.col("_e.k").alias("_k"), F.col("_e.r").alias("_r"), F.col("_e.x").alias("_x")).agg(
        F.count(F.lit(1)).alias("_c"), F.max("_e.v").alias("_max"), F.min("_e.v").alias("_min"), F.max("_e.h").alias("_h")
    )
    before = "coalesce(sum(_c) OVER (PARTITION BY _k ORDER BY _r, _x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    pos = counted.selectExpr("*", f"{before} AS _before")

    def value(p: str) -> str:
        return (
            f"CASE WHEN _r = -1 THEN CASE WHEN {p} = _c - 1 THEN _max END WHEN _r = 1 THEN CASE WHEN {p} = _before THEN _min END "
            f"WHEN _before <= {p} AND {p} < _before + _c THEN _x END"
        )

    out = pos.agg(
        *[
            c
            for k in ks
            for c in (
                F.expr(f"max(CASE WHEN _k = {k} THEN _h END)").alias(f"_h{k}"),
                F.expr(f"max(CASE WHEN _k = {k} THEN {value('floor(_h)')} END)").alias(f"_xl{k}"),
                F.expr(f"max(CASE WHEN _k = {k} THEN {value('ceil(_h)')} END)").alias(f"_xh{k}"),
            )
        ]
    )
    return out.selectExpr(
        *[
            f"CAST(CASE WHEN _h{k} IS NOT NULL AND (_xl{k} IS NULL OR _xh{k} IS NULL) "
            f"THEN raise_error('quantile_targets: bracket missed its target') WHEN _xl{k} = _xh{k} THEN _xl{k} "
            f"ELSE _xl{k} + (_xh{k} - _xl{k}) * (_h{k} - floor(_h{k})) END AS DOUBLE) AS `{n}`"
            for k, n in zip(ks, names)
        ]
    )


def exact_quantiles(
    df: DataFrame,
    x: str | Column,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    accuracy: int = 10000,
    exact: bool = True,
    narrow: int = 0,
) -> DataFrame:
    """One-row DataFrame of quantiles of one column: exact and interpolated
    (see ``quantile_targets``, also for ``narrow``), or with ``exact=False`` Spark's
    ``percentile_approx`` at this accuracy, in one pass (D9)."""
    names = list(names or [f"q{i}" for i in range(len(probs))])
    if exact:
        return quantile_targets(df, [(x, p, n) for p, n in zip(probs, names)], accuracy, narrow)
    v = F.nanvl((F.col(x) if isinstance(x, str) else x).cast("double"), F.lit(None).cast("double"))
    return df.agg(F.percentile_approx(v, [float(p) for p in probs], accuracy).alias("_a")).select(
        *[F.col("_a")[i].alias(n) for i, n in enumerate(names)]
    )
