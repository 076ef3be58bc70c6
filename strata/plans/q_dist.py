"""Queries for chart data (V1-V9), label counts (A13) and the extras X1, X2, X6."""

from __future__ import annotations

from ..operators import distribution as DI
from ..operators import features as FE
from ..operators import rollup as RU
from ..operators import series as TS
from ..spec import DEFAULT as SPEC
from . import sql as S
from .q_features import _QB, _QUART_COLS
from .registry import DIRTY, dirty, panel, publish, register

R, AVG, PCT = S.R, S.AVG, S.PCT
PF = S.with_(S.PANEL, S.FEAT)
PP = S.with_(S.PANEL)
D = "CAST({} AS DOUBLE)".format
VARS = ["value", "cov_a", "cov_b", "cov_c", "cov_d"]


def _num(c: str) -> str:
    return D(c) if c == "value" else c


@register(
    "series_points",
    PP + f"SELECT dt, {D('sum(value)')} AS Total_Sales, count(*) AS Entities FROM panel GROUP BY dt",
)
def series_points(spark, sf):
    return publish(DI.series_points(panel(spark, sf), SPEC))


@register(
    "season_avg",
    PF + f"SELECT Season, {AVG('value')} AS Avg_Sales, CAST(CASE Season WHEN 'Winter' THEN 1 WHEN 'Spring' THEN 2 "
    "WHEN 'Summer' THEN 3 WHEN 'Fall' THEN 4 END AS INTEGER) AS Season_Order FROM feat GROUP BY Season",
)
def season_avg(spark, sf):
    return publish(DI.season_avg(panel(spark, sf), SPEC))


_VALS = "v AS (SELECT CAST(value AS DOUBLE) AS v FROM panel WHERE value IS NOT NULL)"


@register(
    "histogram",
    S.with_(
        S.PANEL,
        _VALS,
        "st AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 50 AS w FROM v)",
        "c AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / nullif(w, 0)), 49) END AS INTEGER) AS Bin, "
        "count(*) AS Row_Count FROM v, st GROUP BY 1)",
        "b AS (SELECT CAST(unnest(generate_series(0, 49)) AS INTEGER) AS Bin, lo, w FROM st WHERE lo IS NOT NULL)",
    )
    + f"SELECT b.Bin AS Bin, {R('lo + b.Bin * w', 4)} AS Bin_Start, {R('lo + (b.Bin + 1) * w', 4)} AS Bin_End, "
    "COALESCE(c.Row_Count, 0) AS Row_Count FROM b LEFT JOIN c ON b.Bin = c.Bin",
)
def histogram(spark, sf):
    return publish(DI.histogram(panel(spark, sf), SPEC, 50))


@register(
    "box_summary",
    S.with_(
        S.PANEL,
        _VALS,
        "q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3 FROM v)",
        "f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)",
    )
    + f"SELECT count(*) AS Count, min(v) AS Min, {R('q1', 4)} AS Q1, {R('q2', 4)} AS Median, {R('q3', 4)} AS Q3, "
    f"{R('iqr', 4)} AS IQR, {R('lf', 4)} AS Lower_Fence, {R('uf', 4)} AS Upper_Fence, "
    "min(v) FILTER (WHERE v >= lf) AS Whisker_Low, max(v) FILTER (WHERE v <= uf) AS Whisker_High, "
    "count(*) FILTER (WHERE v < lf OR v > uf) AS Outlier_Count, max(v) AS Max FROM v, f GROUP BY q1, q2, q3, iqr, lf, uf",
)
def box_summary(spark, sf):
    return publish(DI.box_summary(panel(spark, sf), SPEC))


def _corr(a: str, b: str) -> str:
    return f"corr({_num(a)}, {_num(b)})"


def _nanless(c: str) -> str:
    return f"CASE WHEN isnan({c}) THEN NULL ELSE {R(c, 6)} END"


_PAIRS = [(a, b) for i, a in enumerate(VARS) for b in VARS[i:]]


def _corr_sql(table: str = "panel") -> str:
    cm = "cm AS (SELECT " + ", ".join(f"{_corr(a, b)} AS c{k}" for k, (a, b) in enumerate(_PAIRS)) + f" FROM {table})"
    parts = []
    for k, (a, b) in enumerate(_PAIRS):
        parts.append(f"SELECT '{a}' AS X, '{b}' AS Y, {_nanless(f'c{k}')} AS Corr FROM cm")
        if a != b:
            parts.append(f"SELECT '{b}' AS X, '{a}' AS Y, {_nanless(f'c{k}')} AS Corr FROM cm")
    return S.with_(S.PANEL, *([S.DIRTY] if table == "dirty" else []), cm) + " UNION ALL ".join(parts)


@register("correlation_matrix", _corr_sql())
def correlation_matrix(spark, sf):
    return publish(DI.correlation_matrix(panel(spark, sf), SPEC))


_CV = "sd / nullif(a, 0) * 100"


@register(
    "entity_volatility",
    PP + f"SELECT entity, {R('a')} AS Avg_Weekly_Sales, {R('sd')} AS Sales_StdDev, {R(_CV)} AS CV_Pct, "
    f"CAST(rank() OVER (ORDER BY {R(_CV)} DESC NULLS LAST) AS INTEGER) AS Volatility_Rank "
    f"FROM (SELECT entity, {AVG('value')} AS a, stddev_samp(CAST(value AS DOUBLE)) AS sd FROM panel GROUP BY entity)",
)
def entity_volatility(spark, sf):
    return publish(DI.entity_volatility(panel(spark, sf), SPEC))


def _corr_entity_sql(table: str = "panel") -> str:
    return (
        S.with_(S.PANEL, *([S.DIRTY] if table == "dirty" else []))
        + "SELECT entity, "
        + ", ".join(f"{_nanless(f'c_{c}')} AS Corr_{c}" for c in VARS[1:])
        + " FROM (SELECT entity, "
        + ", ".join(f"{_corr('value', c)} AS c_{c}" for c in VARS[1:])
        + f" FROM {table} GROUP BY entity)"
    )


@register("correlation_by_entity", _corr_entity_sql())
def correlation_by_entity(spark, sf):
    return publish(DI.correlation_by_entity(panel(spark, sf), SPEC))


@register(
    "peak_flag_periods",
    PP + f"SELECT dt, {D('sum(value)')} AS Total_Sales, count(*) AS Entities FROM panel WHERE flag = 1 GROUP BY dt "
    "ORDER BY Total_Sales DESC, dt LIMIT 10",
)
def peak_flag_periods(spark, sf):
    return publish(DI.peak_flag_periods(panel(spark, sf), SPEC, 10))


_LABELS = ("Season", "Sales_Category", "Trend_Signal", "Velocity_Status")
_LAB = (
    "lab AS (SELECT Season, Sales_Category, CASE WHEN MA_4W > MA_12W THEN 'Uptrend' WHEN MA_4W < MA_12W "
    f"THEN 'Downtrend' ELSE 'Neutral' END AS Trend_Signal, CASE WHEN vel > 0 THEN 'Accelerating' WHEN vel < 0 THEN 'Decelerating' "
    f"ELSE 'Stable' END AS Velocity_Status FROM (SELECT *, {S.RAVG(4)} AS MA_4W, {S.RAVG(12)} AS MA_12W, "
    f"value - lag(value, 1) OVER {S.ORD} AS vel, "
    f"{_QUART_COLS} FROM feat, qb))"
)


@register(
    "label_counts",
    S.with_(S.PANEL, S.FEAT, _QB, _LAB)
    + " UNION ALL ".join(
        f"SELECT '{k}' AS Label_Kind, {k} AS Label, count(*) AS Row_Count FROM lab GROUP BY {k}"
        for k in _LABELS
    ),
)
def label_counts(spark, sf):
    p = panel(spark, sf)
    feats = TS.velocity(TS.trend_signal(FE.calendar_features(p, SPEC), SPEC), SPEC)
    feats = FE.value_quartiles(feats, SPEC, FE.quartile_bounds(p, SPEC))
    return publish(RU.label_counts(feats, *_LABELS))


@register("correlation_matrix_dirty", _corr_sql("dirty"))
def correlation_matrix_dirty(spark, sf):
    """Nulls in two of the columns: correlations are over complete pairs."""
    return publish(DI.correlation_matrix(dirty(spark, sf), DIRTY))


@register("correlation_by_entity_dirty", _corr_entity_sql("dirty"))
def correlation_by_entity_dirty(spark, sf):
    return publish(DI.correlation_by_entity(dirty(spark, sf), DIRTY))
