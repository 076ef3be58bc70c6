"""Queries for the grouped roll-ups (inventory A1-A16) and KPIs (K1-K15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import kpi as K
from ..operators import rollup as RU
from ..spec import DEFAULT as SPEC
from . import sql as S
from .registry import ORACLE, gappy, panel, publish, register

R, AVG, PCT, GROWTH = S.R, S.AVG, S.PCT, S.GROWTH
PF = S.with_(S.PANEL, S.FEAT)
PP = S.with_(S.PANEL)
D = "CAST({} AS DOUBLE)".format

# ---------------------------------------------------------------- roll-ups


@register(
    "rollup_entity",
    PP + f"SELECT entity, {D('sum(value)')} AS Total_Sales, {R(AVG('value'))} AS Avg_Weekly_Sales, "
    f"{D('max(value)')} AS Max_Weekly_Sales, {D('min(value)')} AS Min_Weekly_Sales, count(*) AS Total_Weeks "
    "FROM panel GROUP BY entity",
)
def rollup_entity(spark, sf):
    return publish(RU.rollup_entity(panel(spark, sf), SPEC))


def _time_sql(keys: str) -> str:
    return (
        PF + f"SELECT {keys}, {D('sum(value)')} AS Total_Sales, {R(AVG('value'))} AS Avg_Weekly_Sales, "
        f"count(*) AS Total_Records FROM feat GROUP BY {keys}"
    )


@register("rollup_month", _time_sql("Year, Month, MonthName"))
def rollup_month(spark, sf):
    return publish(RU.rollup_time(panel(spark, sf), SPEC, "Month"))


@register("rollup_quarter", _time_sql("Year, Quarter"))
def rollup_quarter(spark, sf):
    return publish(RU.rollup_time(panel(spark, sf), SPEC, "Quarter"))


@register("rollup_year", _time_sql("Year"))
def rollup_year(spark, sf):
    return publish(RU.rollup_time(panel(spark, sf), SPEC, "Year"))


def _calendar_sql(periods: dict[str, str]) -> str:
    parts = []
    for name, keys in periods.items():
        used = keys.split(", ")
        cols = ", ".join(f"CAST({k if k in used else 'NULL'} AS VARCHAR) AS {k}" for k in ("Year", "Quarter", "Month", "MonthName"))
        parts.append(
            f"SELECT '{name}' AS Period, {cols}, {D('sum(value)')} AS Total_Sales, {R(AVG('value'))} AS Avg_Sales, "
            f"count(*) AS Total_Records FROM feat GROUP BY {keys}"
        )
    return PF + " UNION ALL ".join(parts)


@register(
    "rollup_calendar",
    _calendar_sql({"Month": "Year, Month, MonthName", "Quarter": "Year, Quarter", "Year": "Year", "Month of year": "Month, MonthName", "Quarter of year": "Quarter"}),
)
def rollup_calendar(spark, sf):
    """All calendar groupings from one scan and one shuffle."""
    out = RU.rollup_calendar(panel(spark, sf), SPEC)
    return publish(out.withColumns({k: F.col(k).cast("string") for k in ("Year", "Quarter", "Month")}))


_COVS = ("cov_a", "cov_b", "cov_c", "cov_d")


@register(
    "entity_performance",
    PP + "SELECT entity, CAST(t AS DOUBLE) AS Total_Sales, Avg_Weekly_Sales, Peak_Sales, Lowest_Sales, Total_Weeks, "
    + ", ".join(f"Avg_{c}" for c in _COVS)
    + ", CAST(rank() OVER (ORDER BY t DESC) AS INTEGER) AS Sales_Rank, "
    f"{R('Peak_Sales - Lowest_Sales')} AS Sales_Range FROM ("
    f"SELECT entity, sum(value) AS t, {R(AVG('value'))} AS Avg_Weekly_Sales, {D('max(value)')} AS Peak_Sales, "
    f"{D('min(value)')} AS Lowest_Sales, count(*) AS Total_Weeks, "
    + ", ".join(f"{R(f'avg({c})')} AS Avg_{c}" for c in _COVS)
    + " FROM panel GROUP BY entity)",
)
def entity_performance(spark, sf):
    return publish(RU.entity_performance(panel(spark, sf), SPEC))


def _top_sql(asc: bool) -> str:
    o = "ASC" if asc else "DESC"
    return (
        PP + f"SELECT entity, {D('sum(value)')} AS Total_Sales FROM panel GROUP BY entity "
        f"ORDER BY Total_Sales {o}, entity LIMIT 10"
    )


@register("top_entities", _top_sql(False))
def top_entities(spark, sf):
    return publish(RU.top_entities(panel(spark, sf), SPEC, 10))


@register("bottom_entities", _top_sql(True))
def bottom_entities(spark, sf):
    return publish(RU.top_entities(panel(spark, sf), SPEC, 10, bottom=True))


@register(
    "flag_impact",
    PP + f"SELECT flag, count(*) AS Total_Records, {D('sum(value)')} AS Total_Sales, {R(AVG('value'))} AS Avg_Sales, "
    f"{D('max(value)')} AS Max_Sales, {D('min(value)')} AS Min_Sales, "
    "CASE WHEN flag = 1 THEN 'Holiday' ELSE 'Non-Holiday' END AS Period_Type FROM panel GROUP BY flag",
)
def flag_impact(spark, sf):
    return publish(RU.flag_impact(panel(spark, sf), SPEC))


@register(
    "flag_impact_unknown",
    PP + "SELECT CAST(flag AS VARCHAR) AS flag, count(*) AS Total_Records, " + f"{D('sum(value)')} AS Total_Sales, {R(AVG('value'))} AS Avg_Sales, "
    f"{D('max(value)')} AS Max_Sales, {D('min(value)')} AS Min_Sales, "
    "CASE flag WHEN 1 THEN 'Holiday' WHEN 0 THEN 'Non-Holiday' END AS Period_Type "
    "FROM (SELECT value, CASE WHEN cov_d > 1 THEN flag END AS flag FROM panel) GROUP BY flag",
)
def flag_impact_unknown(spark, sf):
    """Rows whose flag is not known (here: periods of a single line) have no label."""
    p = panel(spark, sf).withColumn("flag", F.when(F.col("cov_d") > 1, F.col("flag")))
    return publish(RU.flag_impact(p, SPEC).withColumn("flag", F.col("flag").cast("string")))


@register(
    "flag_kpi",
    PP + f"SELECT {R('a0')} AS Non_Flag_Avg, {R('a1')} AS Flag_Avg, {PCT('a1 - a0', 'a0')} AS Flag_Uplift_Pct, "
    f"{PCT('s1', 's')} AS Flag_Revenue_Pct, c1 AS Flag_Rows, c0 AS Non_Flag_Rows FROM ("
    "SELECT CAST(sum(value) FILTER (WHERE flag = 1) AS DOUBLE) / nullif(count(value) FILTER (WHERE flag = 1), 0) AS a1, "
    "CAST(sum(value) FILTER (WHERE flag = 0) AS DOUBLE) / nullif(count(value) FILTER (WHERE flag = 0), 0) AS a0, "
    "sum(value) FILTER (WHERE flag = 1) AS s1, sum(value) AS s, "
    "count(value) FILTER (WHERE flag = 1) AS c1, count(value) FILTER (WHERE flag = 0) AS c0 FROM panel)",
)
def flag_kpi(spark, sf):
    return publish(RU.flag_kpi(panel(spark, sf), SPEC))


@register(
    "season_rollup",
    PF + f"SELECT Season, count(*) AS Total_Records, {D('sum(value)')} AS Total_Sales, {R(AVG('value'))} AS Avg_Sales, "
    f"{D('max(value)')} AS Max_Sales FROM feat GROUP BY Season",
)
def season_rollup(spark, sf):
    return publish(RU.season_rollup(panel(spark, sf), SPEC))


@register(
    "recent_months",
    PF + f"SELECT Year, Month, MonthName, {D('sum(value)')} AS Total_Sales, {R(AVG('value'))} AS Avg_Sales, "
    "count(*) AS Total_Records FROM feat GROUP BY Year, Month, MonthName ORDER BY Year DESC, Month DESC LIMIT 12",
)
def recent_months(spark, sf):
    return publish(RU.recent_months(panel(spark, sf), SPEC, 12))


_LAGY = "CASE WHEN lag(Year) OVER (ORDER BY Year) = Year - 1 THEN lag(t) OVER (ORDER BY Year) END"
_YEARLY = (
    f"SELECT Year, {D('t')} AS Total_Sales, Avg_Weekly_Sales, Total_Weeks, "
    f"{D(_LAGY)} AS Prev_Year_Sales, {GROWTH('t', _LAGY)} AS YoY_Growth_Pct "
    f"FROM (SELECT Year, sum(value) AS t, {R(AVG('value'))} AS Avg_Weekly_Sales, count(*) AS Total_Weeks "
    "FROM feat GROUP BY Year)"
)


@register("yearly_trend", PF + _YEARLY)
def yearly_trend(spark, sf):
    return publish(RU.yearly_trend(panel(spark, sf), SPEC))


@register("yearly_trend_gaps", S.with_(S.PANEL, S.GAPS) + _YEARLY)
def yearly_trend_gaps(spark, sf):
    """A year after one without rows has no previous year."""
    return publish(RU.yearly_trend(gappy(spark, sf), SPEC))


@register(
    "covariates_by_entity",
    PP + "SELECT entity, "
    + ", ".join(f"{R(f'avg({c})', 6)} AS Avg_{c}" for c in _COVS)
    + f", {AVG('value')} AS Avg_Sales FROM panel GROUP BY entity",
)
def covariates_by_entity(spark, sf):
    return publish(RU.covariates_by_entity(panel(spark, sf), SPEC, digits=6))


@register(
    "grand_summary",
    PP + f"SELECT {D('sum(value)')} AS total_sales, {R(AVG('value'))} AS average_weekly_sales, "
    f"{D('max(value)')} AS maximum_weekly_sales, {D('min(value)')} AS minimum_weekly_sales, "
    "count(*) AS total_records, count(DISTINCT entity) AS unique_entities FROM panel",
)
def grand_summary(spark, sf):
    return publish(RU.grand_summary(panel(spark, sf), SPEC))


@register(
    "entity_gap",
    PP + f"SELECT {D('max(t)')} AS Max_Entity_Total, {D('min(t)')} AS Min_Entity_Total, "
    f"{R('CAST(max(t) AS DOUBLE) / nullif(CAST(min(t) AS DOUBLE), 0)')} AS Gap_Ratio "
    "FROM (SELECT entity, sum(value) AS t FROM panel GROUP BY entity)",
)
def entity_gap(spark, sf):
    return publish(RU.entity_gap(panel(spark, sf), SPEC))


@register(
    "season_kpi",
    PF + f"SELECT Season, {D('t')} AS Total_Sales, Avg_Sales, Week_Count, "
    f"{PCT('t', 'sum(t) OVER ()')} AS Revenue_Contribution_Pct, "
    "CAST(rank() OVER (ORDER BY t DESC) AS INTEGER) AS Season_Rank "
    f"FROM (SELECT Season, sum(value) AS t, {R(AVG('value'))} AS Avg_Sales, count(*) AS Week_Count "
    "FROM feat GROUP BY Season)",
)
def season_kpi(spark, sf):
    return publish(RU.season_kpi(panel(spark, sf), SPEC))


# ---------------------------------------------------------------- KPIs


@register(
    "revenue_kpi",
    PP + f"SELECT {D('sum(t)')} AS Total_Revenue, {D('sum(t)')} / nullif(sum(n), 0) AS Avg_Weekly_Revenue, "
    f"{D('sum(t)')} / nullif(count(t), 0) AS Avg_Revenue_Per_Entity "
    "FROM (SELECT entity, sum(value) AS t, count(value) AS n FROM panel GROUP BY entity)",
)
def revenue_kpi(spark, sf):
    return publish(K.revenue_kpi(panel(spark, sf), SPEC))


@register(
    "revenue_by_year",
    PF + f"SELECT Year, {D('sum(value)')} AS Annual_Revenue FROM feat GROUP BY Year",
)
def revenue_by_year(spark, sf):
    return publish(K.revenue_by_year(panel(spark, sf), SPEC))


_LAGM = (
    "CASE WHEN lag(Year * 12 + Month) OVER (ORDER BY Year, Month) = Year * 12 + Month - 1 "
    "THEN lag(t) OVER (ORDER BY Year, Month) END"
)
_MOM = (
    f"SELECT Year, Month, {D('t')} AS Monthly_Sales, {D(_LAGM)} AS Prev_Month_Sales, "
    f"{GROWTH('t', _LAGM)} AS MoM_Growth_Pct FROM (SELECT Year, Month, sum(value) AS t FROM feat GROUP BY Year, Month)"
)


@register("mom_growth", PF + _MOM)
def mom_growth(spark, sf):
    return publish(K.mom_growth(panel(spark, sf), SPEC))


@register("mom_growth_gaps", S.with_(S.PANEL, S.GAPS) + _MOM)
def mom_growth_gaps(spark, sf):
    """A month after one without rows has no previous month."""
    return publish(K.mom_growth(gappy(spark, sf), SPEC))


@register(
    "recent_mom_growth",
    PF + f"SELECT Year, Month, Monthly_Sales, MoM_Growth_Pct FROM ({_MOM}) ORDER BY Year DESC, Month DESC LIMIT 12",
)
def recent_mom_growth(spark, sf):
    return publish(K.recent_mom_growth(panel(spark, sf), SPEC, 12))


@register(
    "mom_growth_avg",
    PF
    + f"SELECT {R('CAST(sum(CAST(MoM_Growth_Pct AS DECIMAL(20,2))) AS DOUBLE) / nullif(count(MoM_Growth_Pct), 0)')} "
    f"AS Avg_MoM_Growth_Pct, count(MoM_Growth_Pct) AS Months FROM ({_MOM}) WHERE MoM_Growth_Pct IS NOT NULL",
)
def mom_growth_avg(spark, sf):
    return publish(K.mom_growth_avg(panel(spark, sf), SPEC))


_EK = (
    "ek AS (SELECT entity, sum(value) AS t, "
    + AVG("value")
    + " AS a, max(value) AS mx, min(value) AS mn, stddev_samp(CAST(value AS DOUBLE)) AS sd, count(*) AS n "
    "FROM panel GROUP BY entity), best AS (SELECT max(t) AS b FROM ek)"
)
_SCORE = "CAST(t AS DOUBLE) / nullif(CAST(b AS DOUBLE), 0) * 100"
_ENTITY_KPI = (
    f"SELECT entity, {D('t')} AS Total_Sales, {R('a')} AS Avg_Weekly_Sales, {D('mx')} AS Peak_Sales, "
    f"{D('mn')} AS Lowest_Sales, {R('sd')} AS Sales_StdDev, n AS Data_Points, "
    f"{R('100 - sd / nullif(a, 0) * 100')} AS Consistency_Score, {R(_SCORE)} AS Performance_Score, "
    f"CASE WHEN {_SCORE} >= 80 THEN 'Excellent' WHEN {_SCORE} >= 60 THEN 'Good' "
    f"WHEN {_SCORE} >= 40 THEN 'Average' WHEN {_SCORE} IS NOT NULL THEN 'Below Average' END AS Performance_Tier "
    "FROM ek, best"
)


@register("entity_kpi", S.with_(S.PANEL, _EK) + _ENTITY_KPI)
def entity_kpi(spark, sf):
    return publish(K.entity_kpi(panel(spark, sf), SPEC))


@register(
    "top_entity_kpi",
    S.with_(S.PANEL, _EK) + f"SELECT * FROM ({_ENTITY_KPI}) ORDER BY Performance_Score DESC, entity LIMIT 10",
)
def top_entity_kpi(spark, sf):
    return publish(RU.top(K.entity_kpi(panel(spark, sf), SPEC), "Performance_Score", 10, tie=["entity"]))


@register(
    "entity_efficiency",
    PP + f"SELECT entity, {R('a')} AS Avg_Sales, {D('mx')} AS Peak_Sales, {D('mn')} AS Low_Sales, "
    f"{PCT('a', 'mx')} AS Avg_Capacity_Utilization_Pct, {D('mx - mn')} AS Sales_Range, "
    f"{R('100 - CAST(mx - mn AS DOUBLE) / nullif(a, 0) * 100')} AS Consistency_Index "
    f"FROM (SELECT entity, {AVG('value')} AS a, max(value) AS mx, min(value) AS mn FROM panel GROUP BY entity)",
)
def entity_efficiency(spark, sf):
    return publish(K.entity_efficiency(panel(spark, sf), SPEC))


def _top10(name: str, by: str) -> str:
    return f"SELECT * FROM ({ORACLE[name]}) ORDER BY {by} DESC NULLS LAST, entity LIMIT 10"


@register("top_efficiency", _top10("entity_efficiency", "Avg_Capacity_Utilization_Pct"))
def top_efficiency(spark, sf):
    return publish(RU.top(K.entity_efficiency(panel(spark, sf), SPEC), "Avg_Capacity_Utilization_Pct", 10, tie=["entity"]))


def _register_covariate_views() -> None:
    for c in ("cov_a", "cov_b", "cov_c"):

        def view(spark, sf, c=c):
            means = RU.covariates_by_entity(panel(spark, sf), SPEC, digits=6).select("entity", f"Avg_{c}", "Avg_Sales")
            return publish(RU.top(means, "Avg_Sales", 10, tie=["entity"]))

        sql = f"SELECT entity, Avg_{c}, Avg_Sales FROM ({_top10('covariates_by_entity', 'Avg_Sales')})"
        register(f"top_sales_with_{c}", sql)(view)


_register_covariate_views()


def _metric_sql(metric: str, asc: bool) -> str:
    return (
        PP + f"SELECT * FROM (SELECT entity, {D('sum(value)')} AS Total_Sales, {R(AVG('value'))} AS Avg_Sales "
        f"FROM panel GROUP BY entity) ORDER BY {metric} {'ASC' if asc else 'DESC'}, entity LIMIT 5"
    )


@register("top_by_metric", _metric_sql("Total_Sales", False))
def top_by_metric(spark, sf):
    return publish(K.top_by_metric(panel(spark, sf), SPEC, "Total_Sales", 5))


@register("bottom_by_metric", _metric_sql("Avg_Sales", True))
def bottom_by_metric(spark, sf):
    return publish(K.top_by_metric(panel(spark, sf), SPEC, "Avg_Sales", 5, bottom=True))
