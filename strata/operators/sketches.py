"""Mergeable summaries kept by period.

One pass writes a row for each period (and any further keys): exact count and
sum, a HyperLogLog sketch of the entities and a KLL sketch of the measure. The
table is small, whatever the panel; distinct entities, quantiles and shares
below a value of any range of periods come from merging its rows, without a
new scan, and later periods are added by appending their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_sum, money
from ..spec import DEFAULT, PanelSpec

PERIODS = ("day", "week", "month", "quarter", "year")
#: Size of a HyperLogLog sketch (2 ** LG_K registers): standard error 1.04 / sqrt(2 ** LG_K) = 0.8 %.
LG_K = 14
#: Size of a KLL sketch: rank error about 0.7 % (2.3 / KLL_K ** 0.9), 99 times of 100.
KLL_K = 800
KLL_ERROR = 0.007


def period_sketches(df: DataFrame, spec: PanelSpec = DEFAULT, period: str = "month", by: Sequence[str] = (), lg_k: int = LG_K, kll_k: int = KLL_K) -> DataFrame:
    """A row for each period (``Period``: its first day) and ``by``: ``Rows``,
    ``Measured`` (rows with a measure), ``Total``, and the sketches
    ``Entities`` and ``Values`` (binary; null where nothing was seen). Tasks
    sketch before the shuffle, so a hot entity or period sends one row a task.
    Rows without a time have a null period."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}")
    start = F.to_date(F.date_trunc(period, F.col(spec.time)))
    v = money(spec.value, spec)
    return df.groupBy(start.alias("Period"), *by).agg(
        F.count(F.lit(1)).alias("Rows"),
        F.count(v).alias("Measured"),
        exact_sum(spec.value, spec).alias("Total"),
        F.hll_sketch_agg(F.col(spec.entity), F.lit(lg_k)).alias("Entities"),
        F.when(F.count(v) > 0, F.kll_sketch_agg_double(v.cast("double"), kll_k)).alias("Values"),
    )


def merged(sketches: DataFrame, by: Sequence[str | Column] = (), kll_k: int = KLL_K) -> DataFrame:
    """Rows of ``period_sketches`` merged into one for each group of ``by`` (or
    one in all): the same columns but ``Period``."""
    measured = F.sum("Measured")
    aggs = [
        F.sum("Rows").alias("Rows"),
        measured.alias("Measured"),
        F.sum("Total").alias("Total"),
        F.hll_union_agg("Entities").alias("Entities"),
        F.when(measured > 0, F.kll_merge_agg_double("Values", kll_k)).alias("Values"),
    ]
    return sketches.groupBy(*by).agg(*aggs) if by else sketches.agg(*aggs)


def sketch_summary(
    sketches: DataFrame, by: Sequence[str | Column] = (), probs: Sequence[float] = (0.25, 0.5, 0.75), kll_k: int = KLL_K
) -> DataFrame:
    """Answers from merged sketches: ``Rows``, ``Total`` and mean ``Avg``
    (exact), ``Entities`` (estimated number) and ``Q<percent>`` for each of
    ``probs``. A quantile's rank is off by about ``KLL_ERROR`` of all values
    at most; without values it is null."""
    m = merged(sketches, by, kll_k)
    keys = [c for c in m.columns if c not in ("Rows", "Measured", "Total", "Entities", "Values")]
    return m.select(
        *keys,
        "Rows",
        F.col("Total").cast("double").alias("Total"),
        F.try_divide(F.col("Total").cast("double"), F.col("Measured")).alias("Avg"),
        F.hll_sketch_estimate("Entities").alias("Entities"),
        *[
            F.when(F.col("Measured") > 0, F.kll_sketch_get_quantile_double("Values", F.lit(float(p)))).alias(f"Q{p * 100:g}")
            for p in probs
        ],
    )


def share_below(sketches: DataFrame, value: float, by: Sequence[str | Column] = (), kll_k: int = KLL_K) -> DataFrame:
    """Estimated share of values at or below ``value`` from merged sketches (``Share``)."""
    m = merged(sketches, by, kll_k)
    keys = [c for c in m.columns if c not in ("Rows", "Measured", "Total", "Entities", "Values")]
    return m.select(*keys, F.when(F.col("Measured") > 0, F.kll_sketch_get_rank_double("Values", F.lit(float(value)))).alias("Share"))
