"""KPI tables: revenue, month-over-month growth, per-entity scores, efficiency
and top/bottom performers. Scalars that the reference collects to the driver
(max total, grand total) are one-row aggregates broadcast onto the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions.numeric import exact_avg, exact_sum, growth_pct, money, r2, ratio_pct
from ..functions.periods import previous
from ..functions.scalars import long_table, with_scalars
from ..spec import DEFAULT, PanelSpec
from .rollup import calendar_keys, flag_kpi, season_kpi, top

# Performance tiers by score (lower bound inclusive), best first.
PERFORMANCE_TIERS: tuple[tuple[float, str], ...] = ((80, "Excellent"), (60, "Good"), (40, "Average"))
TIER_FLOOR = "Below Average"


def revenue_kpi(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """One row: total revenue, mean per row and mean of the per-entity totals
    (two-level aggregate: the second level reads one row per entity)."""
    per = df.groupBy(spec.entity).agg(
        exact_sum(spec.value, spec).alias("_t"), F.count(money(spec.value, spec)).alias("_n")
    )
    return per.agg(
        F.sum("_t").cast("double").alias("Total_Revenue"),
        F.try_divide(F.sum("_t").cast("double"), F.sum("_n")).alias("Avg_Weekly_Revenue"),
        F.try_divide(F.sum("_t").cast("double"), F.count("_t")).alias("Avg_Revenue_Per_Entity"),
    )


def revenue_by_year(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    return (
        df.groupBy(*calendar_keys(df, spec, ["Year"]))
        .agg(r2(exact_sum(spec.value, spec)).alias("Annual_Revenue"))
        .orderBy("Year")
    )


def mom_growth(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Monthly total, the total of the month before (null where it has no rows)
    and growth %."""
    m = df.groupBy(*calendar_keys(df, spec, ["Year", "Month"])).agg(exact_sum(spec.value, spec).alias("_t"))
    prev = previous("_t", F.col("Year") * 12 + F.col("Month"))  # one row per month: bounded
    return m.select(
        "Year",
        "Month",
        r2(F.col("_t")).alias("Monthly_Sales"),
        r2(prev).alias("Prev_Month_Sales"),
        growth_pct(F.col("_t"), prev).alias("MoM_Growth_Pct"),
    ).orderBy("Year", "Month")


def recent_mom_growth(df: DataFrame, spec: PanelSpec = DEFAULT, n: int = 12) -> DataFrame:
    """Total and growth % of the latest ``n`` months."""
    m = mom_growth(df, spec).select("Year", "Month", "Monthly_Sales", "MoM_Growth_Pct")
    return m.orderBy(F.col("Year").desc(), F.col("Month").desc()).limit(n)


def mom_growth_avg(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """One row: mean of the (rounded) monthly growth rates that exist."""
    g = mom_growth(df, spec).where(F.col("MoM_Growth_Pct").isNotNull())
    x = F.col("MoM_Growth_Pct").cast(DecimalType(20, 2))
    return g.agg(
        r2(F.try_divide(F.sum(x).cast("double"), F.count(x))).alias("Avg_MoM_Growth_Pct"),
        F.count(x).alias("Months"),
    )


def tier(score):
    e = None
    for lo, name in PERFORMANCE_TIERS:
        e = F.when(score >= lo, name) if e is None else e.when(score >= lo, name)
    return e.when(score.isNotNull(), TIER_FLOOR)


def entity_kpi(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Per entity: total, mean, peak, low, stddev, rows; consistency score
    (100 - CV%), performance score (total / best total x 100) and tier."""
    m = money(spec.value, spec)
    g = df.groupBy(spec.entity).agg(
        F.sum(m).alias("_t"),
        F.try_divide(F.sum(m).cast("double"), F.count(m)).alias("_a"),
        F.max(m).alias("Peak_Sales"),
        F.min(m).alias("Lowest_Sales"),
        F.stddev(m.cast("double")).alias("_sd"),
        F.count(F.lit(1)).alias("Data_Points"),
    )
    best = g.agg(F.max("_t").alias("_best"))
    score = F.try_divide(F.col("_t").cast("double"), F.col("_best").cast("double")) * 100
    return with_scalars(g, best).select(
        spec.entity,
        r2(F.col("_t")).alias("Total_Sales"),
        r2(F.col("_a")).alias("Avg_Weekly_Sales"),
        "Peak_Sales",
        "Lowest_Sales",
        r2(F.col("_sd")).alias("Sales_StdDev"),
        "Data_Points",
        r2(100 - F.try_divide(F.col("_sd"), F.col("_a")) * 100).alias("Consistency_Score"),
        r2(score).alias("Performance_Score"),
        tier(score).alias("Performance_Tier"),
    )


def entity_efficiency(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Per entity: mean, peak, low, mean/peak utilisation %, range and
    consistency index 100 - range/mean x 100."""
    m = money(spec.value, spec)
    g = df.groupBy(spec.entity).agg(
        F.try_divide(F.sum(m).cast("double"), F.count(m)).alias("_a"),
        F.max(m).alias("Peak_Sales"),
        F.min(m).alias("Low_Sales"),
    )
    rng = F.col("Peak_Sales") - F.col("Low_Sales")
    return g.select(
        spec.entity,
        r2(F.col("_a")).alias("Avg_Sales"),
        "Peak_Sales",
        "Low_Sales",
        ratio_pct(F.col("_a"), F.col("Peak_Sales")).alias("Avg_Capacity_Utilization_Pct"),
        rng.alias("Sales_Range"),
        r2(100 - F.try_divide(rng.cast("double"), F.col("_a")) * 100).alias("Consistency_Index"),
    )


def entity_metrics(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    return df.groupBy(spec.entity).agg(
        r2(exact_sum(spec.value, spec)).alias("Total_Sales"),
        r2(exact_avg(spec.value, spec)).alias("Avg_Sales"),
    )


def top_by_metric(
    df: DataFrame, spec: PanelSpec = DEFAULT, metric: str = "Total_Sales", n: int = 5, bottom: bool = False
) -> DataFrame:
    """n best (or worst) entities by Total_Sales or Avg_Sales."""
    if metric not in ("Total_Sales", "Avg_Sales"):
        raise ValueError("metric must be Total_Sales or Avg_Sales")
    return top(entity_metrics(df, spec), metric, n, ascending=bottom, tie=[spec.entity])


# Key columns of the sections of the dashboard.
DASHBOARD_KEYS = {"revenue": (), "revenue_by_year": ("Year",), "growth": ("Year", "Month"), "holiday_impact": (), "seasonal": ("Season",)}


def dashboard_table(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """The KPI set as one table: Section, Row_Key, Metric, Value (a row for
    each number of each part of ``kpi_dashboard``)."""
    parts = kpi_dashboard(df, spec)
    return long_table({n: (part, DASHBOARD_KEYS.get(n, (spec.entity,))) for n, part in parts.items()})


def kpi_dashboard(df: DataFrame, spec: PanelSpec = DEFAULT) -> dict[str, DataFrame]:
    """The KPI set as lazy DataFrames over one shared input; nothing runs until
    the caller acts on one of them (cache ``df`` first when using several)."""
    return {
        "revenue": revenue_kpi(df, spec),
        "revenue_by_year": revenue_by_year(df, spec),
        "growth": mom_growth(df, spec),
        "store_performance": entity_kpi(df, spec),
        "holiday_impact": flag_kpi(df, spec),
        "seasonal": season_kpi(df, spec),
        "efficiency": entity_efficiency(df, spec),
    }
