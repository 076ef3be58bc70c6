"""Queries for the feature-engineering operators (inventory F1-F13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..spec import DEFAULT as SPEC
from . import sql as S
from .registry import DIRTY, daily, panel, publish, register

_BASE = ["entity", "dt", "value"]
_CAL = ["Year", "Quarter", "Month", "Day", "WeekOfYear", "DayOfWeek", "MonthName", "DayName", "IsWeekend", "Season"]


def _keep(df, new):
    return publish(df.select(*_BASE, *new))


def _sql_feat_cols(extra: str) -> str:
    return f"SELECT entity, dt, CAST(value AS DOUBLE) AS value, {extra} FROM panel"


@register(
    "temporal_features",
    S.with_(S.DAILY)
    + f"SELECT entity, dt, CAST(value AS DOUBLE) AS value, {S.CAL()} FROM daily",
)
def temporal_features(spark, sf):
    """Calendar parts on the daily orders panel (every weekday occurs)."""
    return publish(FE.calendar_features(daily(spark, sf), SPEC))


@register(
    "rolling_avg",
    S.with_(S.PANEL)
    + _sql_feat_cols(", ".join(f"{S.RAVG(k)} AS Rolling_Avg_{k}W" for k in (4, 12, 26))),
)
def rolling_avg(spark, sf):
    cols = FE.rolling_columns(SPEC, (4, 12, 26), sum_name=None)
    return publish(panel(spark, sf).select(*_BASE, *[c.alias(n) for n, c in cols.items()]))


@register(
    "rolling_sum",
    S.with_(S.PANEL)
    + _sql_feat_cols(", ".join(f"{S.RSUM(k)} AS Rolling_Sum_{k}W" for k in (4, 12, 26))),
)
def rolling_sum(spark, sf):
    cols = FE.rolling_columns(SPEC, (4, 12, 26))
    keep = {n: c for n, c in cols.items() if n.startswith("Rolling_Sum")}
    return publish(panel(spark, sf).select(*_BASE, *[c.alias(n) for n, c in keep.items()]))


@register(
    "lag_features",
    S.with_(S.PANEL)
    + _sql_feat_cols(
        ", ".join(f"CAST(lag(value, {k}) OVER {S.ORD} AS DOUBLE) AS Sales_Lag_{k}W" for k in (1, 4, 52))
    ),
)
def lag_features(spark, sf):
    return _keep(FE.lag_features(panel(spark, sf), SPEC), [f"Sales_Lag_{k}W" for k in (1, 4, 52)])


_GROWTH_SQL = (
    S.with_(S.PANEL)
    + "SELECT entity, dt, CAST(value AS DOUBLE) AS value, "
    + f"CAST(lag(value, 1) OVER {S.ORD} AS DOUBLE) AS Sales_Prev_Week, "
    + f"{S.GROWTH('value', f'lag(value, 1) OVER {S.ORD}')} AS WoW_Growth_Pct, "
    + f"CAST(lag(value, 52) OVER {S.ORD} AS DOUBLE) AS Sales_Prev_Year, "
    + f"{S.GROWTH('value', f'lag(value, 52) OVER {S.ORD}')} AS YoY_Growth_Pct FROM panel"
)


@register("growth_rates", _GROWTH_SQL)
def growth_rates(spark, sf):
    return _keep(FE.growth_rates(panel(spark, sf), SPEC), list(FE.growth_columns(SPEC)))


_YTD = "(PARTITION BY entity, year(dt) ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_CUM_SQL_COLS = (
    f"{S.R(f'CAST(sum(value) OVER {_YTD} AS DOUBLE)')} AS Cumulative_Sales, "
    f"{S.R(f'CAST(sum(value) OVER {_YTD} AS DOUBLE) / nullif(count(value) OVER {_YTD}, 0)')} AS Cumulative_Avg_Sales"
)


@register("cumulative_metrics", S.with_(S.PANEL) + _sql_feat_cols(_CUM_SQL_COLS))
def cumulative_metrics(spark, sf):
    return _keep(FE.cumulative_metrics(panel(spark, sf), SPEC), list(FE.cumulative_columns(SPEC)))


_QB = "qb AS (SELECT quantile_cont(CAST(value AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(value AS DOUBLE), 0.5) AS q2, quantile_cont(CAST(value AS DOUBLE), 0.75) AS q3 FROM panel)"
_QCASE = (
    "CASE WHEN value IS NULL THEN NULL WHEN CAST(value AS DOUBLE) <= q1 THEN {a} WHEN CAST(value AS DOUBLE) <= q2 THEN {b} "
    "WHEN CAST(value AS DOUBLE) <= q3 THEN {c} ELSE {d} END"
)
_QUART_COLS = (
    _QCASE.format(a="'Low'", b="'Medium-Low'", c="'Medium-High'", d="'High'")
    + " AS Sales_Category, CAST("
    + _QCASE.format(a=1, b=2, c=3, d=4)
    + " AS INTEGER) AS Sales_Quartile"
)


@register(
    "value_quartiles",
    S.with_(S.PANEL, _QB)
    + f"SELECT entity, dt, CAST(value AS DOUBLE) AS value, {_QUART_COLS} FROM panel, qb",
)
def value_quartiles(spark, sf):
    return _keep(FE.value_quartiles(panel(spark, sf), SPEC), ["Sales_Category", "Sales_Quartile"])


def _feature_set_sql() -> str:
    roll = ", ".join(
        f"{S.RAVG(k)} AS Rolling_Avg_{k}W, {S.RSUM(k)} AS Rolling_Sum_{k}W" for k in (4, 12, 26)
    )
    lags = ", ".join(f"CAST(lag(value, {k}) OVER {S.ORD} AS DOUBLE) AS Sales_Lag_{k}W" for k in (1, 4, 52))
    growth = (
        f"CAST(lag(value, 1) OVER {S.ORD} AS DOUBLE) AS Sales_Prev_Week, "
        f"{S.GROWTH('value', f'lag(value, 1) OVER {S.ORD}')} AS WoW_Growth_Pct, "
        f"CAST(lag(value, 52) OVER {S.ORD} AS DOUBLE) AS Sales_Prev_Year, "
        f"{S.GROWTH('value', f'lag(value, 52) OVER {S.ORD}')} AS YoY_Growth_Pct"
    )
    return (
        S.with_(S.PANEL, _QB)
        + "SELECT entity, dt, CAST(value AS DOUBLE) AS value, flag, cov_a, cov_b, cov_c, cov_d, "
        + f"{S.CAL()}, {roll}, {lags}, {growth}, {_CUM_SQL_COLS}, {_QUART_COLS} FROM panel, qb"
    )


@register("feature_set", _feature_set_sql())
def feature_set(spark, sf):
    return publish(FE.feature_set(panel(spark, sf), SPEC))


@register("feature_set_split", _feature_set_sql())
def feature_set_split(spark, sf):
    """The same table by the plan for a dominant entity."""
    return publish(FE.feature_set(panel(spark, sf), SPEC, split_block=F.year("dt")))


_DOUBLE = (
    "pd AS (SELECT entity, dt, CASE WHEN (entity + weekofyear(dt)) % 13 = 0 THEN NULL "
    "WHEN (entity + weekofyear(dt)) % 13 = 1 THEN CAST('NaN' AS DOUBLE) ELSE CAST(value AS DOUBLE) END AS value FROM panel)"
)
_CLEAN_VALUE = "CASE WHEN isnan(value) THEN NULL ELSE value END"


def double_panel(spark, sf):
    """The panel with a double measure that is null in some weeks and NaN in others."""
    wk = (F.col("entity") + F.weekofyear("dt")) % 13
    v = F.when(wk == 1, F.lit(float("nan"))).when(wk != 0, F.col("value").cast("double"))
    return panel(spark, sf).select("entity", "dt", v.alias("value"))


@register(
    "rolling_double",
    S.with_(S.PANEL, _DOUBLE)
    + "SELECT entity, dt, "
    + ", ".join(f"{S.RAVG(k, f'({_CLEAN_VALUE})')} AS Rolling_Avg_{k}W, {S.RSUM(k, f'({_CLEAN_VALUE})')} AS Rolling_Sum_{k}W" for k in (4, 12))
    + " FROM pd",
)
def rolling_double(spark, sf):
    """Rolling windows of a measure that is summed as double."""
    out = FE.rolling_metrics(double_panel(spark, sf), DIRTY, (4, 12))
    return out.select("entity", "dt", *[f"Rolling_{x}_{k}W" for k in (4, 12) for x in ("Avg", "Sum")])
