"""Queries for the time-series operators (inventory T1-T15, X5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series as TS
from ..operators.rollup import top
from ..spec import DEFAULT as SPEC
from . import sql as S
from .registry import ORACLE, daily, gappy, panel, publish, register

R, AVG, PCT, GROWTH, ORD = S.R, S.AVG, S.PCT, S.GROWTH, S.ORD
PF = S.with_(S.PANEL, S.FEAT)
D = "CAST({} AS DOUBLE)".format
BASE = ["entity", "dt", "value"]


def _keep(df, new):
    return publish(df.select(*BASE, *new))


_MA = (4, 8, 12, 26, 52)


@register(
    "moving_averages",
    S.with_(S.PANEL)
    + "SELECT entity, dt, CAST(value AS DOUBLE) AS value, "
    + ", ".join(f"{S.RAVG(k)} AS MA_{k}W" for k in _MA)
    + " FROM panel",
)
def moving_averages(spark, sf):
    return _keep(TS.moving_averages(panel(spark, sf), SPEC, _MA), [f"MA_{k}W" for k in _MA])


@register(
    "moving_averages_min_rows",
    S.with_(S.PANEL)
    + "SELECT entity, dt, CAST(value AS DOUBLE) AS value, "
    + ", ".join(f"CASE WHEN count(value) OVER {S.WIN(k)} >= 4 THEN {S.RAVG(k)} END AS MA_{k}W" for k in (4, 12))
    + " FROM panel",
)
def moving_averages_min_rows(spark, sf):
    """No average of fewer than four rows."""
    return _keep(TS.moving_averages(panel(spark, sf), SPEC, (4, 12), min_rows=4), ["MA_4W", "MA_12W"])


_TREND = (
    f"trend AS (SELECT *, CASE WHEN MA_4W > MA_12W THEN 'Uptrend' WHEN MA_4W < MA_12W THEN 'Downtrend' "
    f"ELSE 'Neutral' END AS Trend_Signal FROM (SELECT entity, dt, value, {S.RAVG(4)} AS MA_4W, "
    f"{S.RAVG(12)} AS MA_12W FROM panel))"
)


@register(
    "trend_signal",
    S.with_(S.PANEL, _TREND) + "SELECT entity, dt, CAST(value AS DOUBLE) AS value, MA_4W, MA_12W, Trend_Signal FROM trend",
)
def trend_signal(spark, sf):
    return _keep(TS.trend_signal(panel(spark, sf), SPEC), ["MA_4W", "MA_12W", "Trend_Signal"])


_L4 = f"lag(value, 4) OVER {ORD}"


@register(
    "momentum",
    S.with_(S.PANEL)
    + f"SELECT entity, dt, CAST(value AS DOUBLE) AS value, {D(_L4)} AS Sales_4W_Ago, "
    f"{D(f'value - {_L4}')} AS Momentum_4W, {PCT(f'value - {_L4}', _L4)} AS Momentum_Pct_4W FROM panel",
)
def momentum(spark, sf):
    return _keep(TS.momentum(panel(spark, sf), SPEC, 4), ["Sales_4W_Ago", "Momentum_4W", "Momentum_Pct_4W"])


@register(
    "seasonality_month",
    PF + f"SELECT Month, MonthName, {R(AVG('value'))} AS Avg_Sales, {D('sum(value)')} AS Total_Sales, "
    "count(*) AS Data_Points FROM feat GROUP BY Month, MonthName",
)
def seasonality_month(spark, sf):
    return publish(TS.seasonality(panel(spark, sf), SPEC, "Month"))


@register(
    "seasonality_quarter",
    PF + f"SELECT Quarter, {R(AVG('value'))} AS Avg_Sales, {D('sum(value)')} AS Total_Sales, "
    "count(*) AS Data_Points FROM feat GROUP BY Quarter",
)
def seasonality_quarter(spark, sf):
    return publish(TS.seasonality(panel(spark, sf), SPEC, "Quarter"))


@register(
    "seasonality_dow",
    S.with_(S.DAILY, f"dfeat AS (SELECT *, {S.CAL()} FROM daily)")
    + f"SELECT DayOfWeek, DayName, {R(AVG('value'))} AS Avg_Sales, count(*) AS Data_Points "
    "FROM dfeat GROUP BY DayOfWeek, DayName",
)
def seasonality_dow(spark, sf):
    """Day-of-week profile on the daily orders panel (weekly rows are all Mondays)."""
    return publish(TS.seasonality(daily(spark, sf), SPEC, "DayOfWeek"))


_MY = "OVER (PARTITION BY Month ORDER BY Year)"
_LY = f"CASE WHEN lag(Year) {_MY} = Year - 1 THEN lag(t) {_MY} END"
_YOY = (
    f"SELECT Year, Month, MonthName, {D('t')} AS Monthly_Sales, Avg_Weekly_Sales, Week_Count, "
    f"{D(_LY)} AS Prev_Year_Sales, {D(f't - ({_LY})')} AS YoY_Change, {PCT(f't - ({_LY})', _LY)} AS YoY_Change_Pct "
    f"FROM (SELECT Year, Month, MonthName, sum(value) AS t, {R(AVG('value'))} AS Avg_Weekly_Sales, "
    "count(*) AS Week_Count FROM feat GROUP BY Year, Month, MonthName)"
)


@register("yoy_month", PF + _YOY)
def yoy_month(spark, sf):
    return publish(TS.yoy_month(panel(spark, sf), SPEC))


@register("yoy_month_gaps", S.with_(S.PANEL, S.GAPS) + _YOY)
def yoy_month_gaps(spark, sf):
    """A month whose year before has no rows for it has no previous value."""
    return publish(TS.yoy_month(gappy(spark, sf), SPEC))


@register(
    "peak_rows",
    PF + "SELECT entity, dt, CAST(value AS DOUBLE) AS value, flag, Year, Month, MonthName, Season FROM feat "
    "ORDER BY value DESC, entity, dt LIMIT 10",
)
def peak_rows(spark, sf):
    return publish(TS.peak_rows(panel(spark, sf), SPEC, 10))


@register(
    "peak_months",
    PF + f"SELECT Year, Month, MonthName, {D('sum(value)')} AS Total_Sales FROM feat GROUP BY Year, Month, MonthName "
    "ORDER BY Total_Sales DESC, Year, Month LIMIT 10",
)
def peak_months(spark, sf):
    return publish(TS.peak_months(panel(spark, sf), SPEC, 10))


_L1, _L2 = f"lag(value, 1) OVER {ORD}", f"lag(value, 2) OVER {ORD}"


@register(
    "velocity",
    S.with_(S.PANEL)
    + f"SELECT entity, dt, CAST(value AS DOUBLE) AS value, {D(_L1)} AS Prev_Week_Sales, "
    f"{D(f'value - {_L1}')} AS Sales_Velocity, {D(f'value - 2 * {_L1} + {_L2}')} AS Sales_Acceleration, "
    f"CASE WHEN value - {_L1} > 0 THEN 'Accelerating' WHEN value - {_L1} < 0 THEN 'Decelerating' "
    "ELSE 'Stable' END AS Velocity_Status FROM panel",
)
def velocity(spark, sf):
    cols = ["Prev_Week_Sales", "Sales_Velocity", "Sales_Acceleration", "Velocity_Status"]
    return _keep(TS.velocity(panel(spark, sf), SPEC), cols)


def _mavg(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(20,2))) AS DOUBLE) / nullif(count({c}), 0)"


_RECENT = (
    "recent AS (SELECT entity, "
    + AVG("value")
    + f" AS av, {_mavg('MA_4W')} AS a4, {_mavg('MA_12W')} AS a12, max(dt) AS last_dt FROM ("
    f"SELECT entity, dt, value, {S.RAVG(4)} AS MA_4W, {S.RAVG(12)} AS MA_12W, "
    "row_number() OVER (PARTITION BY entity ORDER BY dt DESC) AS rn FROM panel) WHERE rn <= 12 GROUP BY entity)"
)


@register(
    "forecast_baseline",
    S.with_(S.PANEL, _RECENT)
    + f"SELECT entity, {R('av')} AS Recent_Avg_Sales, {R('a4')} AS Recent_MA_4W, {R('a12')} AS Recent_MA_12W, "
    f"{R('(a4 + a12) / 2')} AS Forecast_Next_Week FROM recent",
)
def forecast_baseline(spark, sf):
    return publish(TS.forecast_baseline(panel(spark, sf), SPEC, 12))


@register(
    "trend_strength",
    S.with_(S.PANEL, _TREND)
    + "SELECT entity, up AS Uptrend_Periods, down AS Downtrend_Periods, flat AS Neutral_Periods, "
    f"n AS Total_Periods, {PCT('up', 'n')} AS Uptrend_Pct FROM (SELECT entity, "
    "count(*) FILTER (WHERE Trend_Signal = 'Uptrend') AS up, count(*) FILTER (WHERE Trend_Signal = 'Downtrend') AS down, "
    "count(*) FILTER (WHERE Trend_Signal = 'Neutral') AS flat, count(*) AS n FROM trend GROUP BY entity)",
)
def trend_strength(spark, sf):
    return publish(TS.trend_strength(panel(spark, sf), SPEC))


@register(
    "trend_counts",
    S.with_(S.PANEL, _TREND) + "SELECT entity, Trend_Signal, count(*) AS Period_Count FROM trend GROUP BY entity, Trend_Signal",
)
def trend_counts(spark, sf):
    return publish(TS.trend_counts(panel(spark, sf), SPEC))


# the same answers by the plans for an entity that holds most of the rows
def _split(name: str, run) -> None:
    def query(spark, sf):
        return publish(run(panel(spark, sf), F.year("dt")))

    register(f"{name}_split", ORACLE[name])(query)


_split("forecast_baseline", lambda p, b: TS.forecast_baseline(p, SPEC, 12, split_block=b))
_split("trend_strength", lambda p, b: TS.trend_strength(p, SPEC, split_block=b))
_split("trend_counts", lambda p, b: TS.trend_counts(p, SPEC, split_block=b))

_MIDX = (
    f"midx AS (SELECT Month, MonthName, am, am / nullif(aall, 0) AS idx FROM "
    f"(SELECT Month, MonthName, {AVG('value')} AS am FROM feat GROUP BY Month, MonthName), "
    f"(SELECT {AVG('value')} AS aall FROM panel))"
)


@register(
    "seasonal_index",
    S.with_(S.PANEL, S.FEAT, _MIDX) + f"SELECT Month, MonthName, {R('am')} AS Avg_Sales, {R('idx', 4)} AS Seasonal_Index FROM midx",
)
def seasonal_index(spark, sf):
    return publish(TS.seasonal_index(panel(spark, sf), SPEC))


@register(
    "forecast_horizon",
    S.with_(S.PANEL, S.FEAT, _MIDX, _RECENT)
    + f"SELECT entity, Step, Forecast_Date, {R('((a4 + a12) / 2) * idx')} AS Forecast_Value FROM ("
    "SELECT entity, a4, a12, CAST(s.Step AS INTEGER) AS Step, CAST(last_dt + 7 * CAST(s.Step AS INTEGER) AS DATE) AS Forecast_Date "
    "FROM recent, (SELECT unnest(generate_series(1, 4)) AS Step) s) f "
    "LEFT JOIN midx ON month(f.Forecast_Date) = midx.Month",
)
def forecast_horizon(spark, sf):
    return publish(TS.forecast_horizon(panel(spark, sf), SPEC, horizon=4))


_split("forecast_horizon", lambda p, b: TS.forecast_horizon(p, SPEC, horizon=4, split_block=b))


def _top10(name: str, by: str) -> str:
    return f"SELECT * FROM ({ORACLE[name]}) ORDER BY {by} DESC NULLS LAST, entity LIMIT 10"


@register("top_forecast", _top10("forecast_baseline", "Forecast_Next_Week"))
def top_forecast(spark, sf):
    return publish(top(TS.forecast_baseline(panel(spark, sf), SPEC), "Forecast_Next_Week", 10, tie=["entity"]))


@register("top_trend_strength", _top10("trend_strength", "Uptrend_Pct"))
def top_trend_strength(spark, sf):
    return publish(top(TS.trend_strength(panel(spark, sf), SPEC), "Uptrend_Pct", 10, tie=["entity"]))
