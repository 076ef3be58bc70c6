"""Queries for the summaries kept by period: exact parts as numbers, estimates
as whether they lie within their stated error of the exact answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exact_quantiles
from ..functions.scalars import with_scalars
from ..operators import sketches as SK
from ..spec import DEFAULT as SPEC
from . import sql as S
from .registry import panel, publish, register

D = "CAST({} AS DOUBLE)".format


@register(
    "sketch_by_year",
    S.with_(S.PANEL)
    + "SELECT CAST(year(dt) AS INTEGER) AS Year, CAST(count(*) AS BIGINT) AS Row_Count, " + f"{D('sum(value)')} AS Total, "
    "CAST(count(DISTINCT entity) AS BIGINT) AS Entities, 1 AS Entities_Within, 1 AS Median_Within FROM panel GROUP BY 1",
)
def sketch_by_year(spark, sf):
    """Months sketched once, years answered from their sketches: distinct
    entities within 3 standard errors, and the median within its rank error."""
    p = panel(spark, sf)
    kept = SK.period_sketches(p, SPEC, "month")
    est = SK.sketch_summary(kept, [F.year("Period").alias("Year")], (0.5 - 2 * SK.KLL_ERROR, 0.5 + 2 * SK.KLL_ERROR)).toDF("Year", "Row_Count", "Total", "_avg", "_e", "_lo", "_hi")
    exact = p.groupBy(F.year("dt").alias("Year")).agg(F.count_distinct("entity").alias("Entities"), F.expr("percentile(CAST(value AS DOUBLE), 0.5)").alias("_m"))
    near = F.abs(F.col("_e") - F.col("Entities")) <= F.greatest(F.lit(1.0), 3 * 1.04 / 2 ** (SK.LG_K / 2) * F.col("Entities"))
    out = est.join(exact, "Year")  # a row a year
    return publish(out.select("Year", "Row_Count", "Total", "Entities", near.cast("int").alias("Entities_Within"), F.expr("_m BETWEEN _lo AND _hi").cast("int").alias("Median_Within")))


@register(
    "sketch_quartiles",
    S.with_(S.PANEL) + "SELECT CAST(count(*) AS BIGINT) AS Row_Count, 1 AS Q25_Within, 1 AS Q50_Within, 1 AS Q75_Within FROM panel",
)
def sketch_quartiles(spark, sf):
    """The measure's quartiles over all periods from the sketches of months,
    held between the exact quantiles a rank error below and above."""
    p = panel(spark, sf)
    probs, d = (0.25, 0.5, 0.75), 2 * SK.KLL_ERROR
    est = SK.sketch_summary(SK.period_sketches(p, SPEC, "month"), (), probs)
    names = [f"{side}{100 * q:g}" for q in probs for side in ("lo", "hi")]
    exact = exact_quantiles(p, "value", [x for q in probs for x in (q - d, q + d)], names)
    within = [F.col(f"Q{100 * q:g}").between(F.col(f"lo{100 * q:g}"), F.col(f"hi{100 * q:g}")).cast("int").alias(f"Q{100 * q:g}_Within") for q in probs]
    return with_scalars(est, exact).select(F.col("Rows").alias("Row_Count"), *within)
