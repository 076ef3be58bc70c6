"""Queries for data quality (Q1-Q8) and cleaning (C1-C17) on the dirty panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.dates import date_votes
from ..functions.ranking import quantile_targets
from ..operators import clean as CL
from ..operators import quality as QU
from ..spec import DEFAULT as SPEC
from . import sql as S
from .q_features import double_panel
from .registry import dirty, panel, publish, register

R, AVG, PCT = S.R, S.AVG, S.PCT
PD = S.with_(S.PANEL, S.DIRTY)
PP = S.with_(S.PANEL)
DCOLS = ["entity", "dt_raw", "value", "flag", "cov_a", "cov_b", "cov_c", "cov_d"]
DOUBLES = {"value", "cov_a", "cov_b", "cov_c", "cov_d"}
NUMERIC = ["entity", "value", "flag", "cov_a", "cov_b", "cov_c", "cov_d"]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Publish a row-level table with doubles rounded to ``digits`` (row-level
    imputed means are sums of doubles whose last bits depend on the order)."""
    df = publish(df)
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _sel(exprs: dict[str, str], src: str, tail: str = "") -> str:
    cols = ", ".join(f"{R(e, 6) if n in DOUBLES else e} AS {n}" for n, e in exprs.items())
    return f"SELECT {cols} FROM {src} {tail}"


def _ident(extra: dict[str, str] | None = None) -> dict[str, str]:
    d = {c: c for c in DCOLS}
    d.update(extra or {})
    return d


# ---------------------------------------------------------------- quality


def _miss(c: str) -> str:
    return f"({c} IS NULL OR isnan({c}))" if c in DOUBLES else f"{c} IS NULL"


@register(
    "null_profile",
    PD
    + " UNION ALL ".join(
        f"SELECT '{c}' AS Column, count(*) FILTER (WHERE {_miss(c)}) AS Null_Count, "
        f"{PCT(f'count(*) FILTER (WHERE {_miss(c)})', 'count(*)')} AS Null_Pct FROM dirty"
        for c in DCOLS
    ),
)
def null_profile(spark, sf):
    return publish(QU.null_profile(dirty(spark, sf)))


@register(
    "dataset_stats",
    PD
    + f"SELECT count(*) AS Total_Records, CAST({len(DCOLS)} AS INTEGER) AS Total_Columns, "
    f"'{','.join(DCOLS)}' AS Column_Names, "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS Null_{c}" for c in DCOLS)
    + " FROM dirty",
)
def dataset_stats(spark, sf):
    return publish(QU.dataset_stats(dirty(spark, sf)))


@register(
    "validate_report",
    PD
    + "SELECT count(*) AS Total_Records, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS Duplicate_Records, "
    + ", ".join(f"{PCT(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)')} AS Null_Pct_{c}" for c in DCOLS)
    + " FROM dirty",
)
def validate_report(spark, sf):
    return publish(QU.validate_report(dirty(spark, sf)))


@register(
    "describe_numeric",
    PD
    + " UNION ALL ".join(
        f"SELECT '{c}' AS Column, count(x) AS Count, {R('avg(x)', 4)} AS Mean, {R('stddev_samp(x)', 4)} AS StdDev, "
        f"min(x) AS Min, max(x) AS Max FROM (SELECT CAST({c} AS DOUBLE) AS x FROM dirty)"
        for c in NUMERIC
    ),
)
def describe_numeric(spark, sf):
    return publish(QU.describe_numeric(dirty(spark, sf), NUMERIC))


@register(
    "panel_coverage",
    PP
    + "SELECT min(dt) AS Min_Date, max(dt) AS Max_Date, count(DISTINCT entity) AS Entities, count(*) AS Total_Rows, "
    "count(*) FILTER (WHERE flag = 1) AS Flag_Rows, count(*) FILTER (WHERE flag = 0) AS Non_Flag_Rows, "
    f"{PCT('count(*) FILTER (WHERE flag = 1)', 'count(*)')} AS Flag_Pct, "
    f"{PCT('count(*) FILTER (WHERE flag = 0)', 'count(*)')} AS Non_Flag_Pct FROM panel",
)
def panel_coverage(spark, sf):
    return publish(QU.panel_coverage(panel(spark, sf), SPEC))


# ---------------------------------------------------------------- imputation

_MEAN = f"st AS (SELECT {AVG('CAST(value AS DECIMAL(18,2))')} AS f0, avg(cov_a) AS f1 FROM dirty)"


@register(
    "impute_mean",
    S.with_(S.PANEL, S.DIRTY, _MEAN) + _sel(_ident({"value": "COALESCE(value, f0)", "cov_a": "COALESCE(cov_a, f1)"}), "dirty, st"),
)
def impute_mean(spark, sf):
    return rounded(CL.impute(dirty(spark, sf), "mean", ["value", "cov_a"], SPEC))


_MED = "st AS (SELECT quantile_cont(value, 0.5) AS f0, quantile_cont(cov_a, 0.5) AS f1 FROM dirty)"


@register(
    "impute_median",
    S.with_(S.PANEL, S.DIRTY, _MED) + _sel(_ident({"value": "COALESCE(value, f0)", "cov_a": "COALESCE(cov_a, f1)"}), "dirty, st"),
)
def impute_median(spark, sf):
    return rounded(CL.impute(dirty(spark, sf), "median", ["value", "cov_a"], SPEC))


def _mode(c: str) -> str:
    return f"(SELECT {c} FROM dirty WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} ASC LIMIT 1)"


_MODE = f"st AS (SELECT {_mode('value')} AS f0, {_mode('cov_a')} AS f1)"


@register(
    "impute_mode",
    S.with_(S.PANEL, S.DIRTY, _MODE) + _sel(_ident({"value": "COALESCE(value, f0)", "cov_a": "COALESCE(cov_a, f1)"}), "dirty, st"),
)
def impute_mode(spark, sf):
    return rounded(CL.impute(dirty(spark, sf), "mode", ["value", "cov_a"], SPEC))


@register(
    "drop_missing",
    PD + _sel(_ident(), "dirty", "WHERE value IS NOT NULL AND NOT isnan(value) AND cov_a IS NOT NULL AND NOT isnan(cov_a)"),
)
def drop_missing(spark, sf):
    return rounded(CL.impute(dirty(spark, sf), "drop", ["value", "cov_a"], SPEC))


@register(
    "fill_zero",
    PD + _sel(_ident({"value": "COALESCE(value, 0)", "cov_a": "COALESCE(cov_a, 0)"}), "dirty"),
)
def fill_zero(spark, sf):
    return rounded(CL.impute(dirty(spark, sf), "fill", ["value", "cov_a"], SPEC))


# ---------------------------------------------------------------- dates

_PARSE = (
    "CAST(CASE WHEN regexp_full_match(dt_raw, '\\d{4}-\\d{2}-\\d{2}') THEN try_strptime(dt_raw, '%Y-%m-%d') "
    "WHEN regexp_full_match(dt_raw, '\\d{2}-\\d{2}-\\d{4}') THEN try_strptime(dt_raw, '%d-%m-%Y') "
    "WHEN regexp_full_match(dt_raw, '\\d{2}/\\d{2}/\\d{4}') THEN try_strptime(dt_raw, '%d/%m/%Y') "
    "WHEN regexp_full_match(dt_raw, '\\d{1,2}/\\d{1,2}/\\d{4}') THEN try_strptime(dt_raw, '%m/%d/%Y') END AS DATE)"
)
_PARSED = (
    f"parsed AS (SELECT *, CAST(year(dt) AS INTEGER) AS Year, CAST(month(dt) AS INTEGER) AS Month, "
    f"CAST(day(dt) AS INTEGER) AS Day, CAST(dayofweek(dt) + 1 AS INTEGER) AS DayOfWeek "
    f"FROM (SELECT *, {_PARSE} AS dt FROM dirty))"
)
_PARTS = {c: c for c in ("dt", "Year", "Month", "Day", "DayOfWeek")}


@register("parse_dates", S.with_(S.PANEL, S.DIRTY, _PARSED) + _sel({**_ident(), **_PARTS}, "parsed"))
def parse_dates(spark, sf):
    return rounded(CL.parse_dates(dirty(spark, sf), "dt_raw", out="dt"))


_TEXT_DATES = {"month_first": "MM/dd/yyyy", "month_first_dashed": "MM-dd-yyyy", "month_first_short": "M/d/yyyy", "day_first": "dd/MM/yyyy", "day_first_dashed": "dd-MM-yyyy", "iso": "yyyy-MM-dd"}


@register(
    "parse_dates_month_first",
    S.with_(S.PANEL) + "SELECT entity, CAST(dt AS VARCHAR) AS dt, " + ", ".join(f"CAST(dt AS VARCHAR) AS {c}" for c in _TEXT_DATES) + " FROM panel",
)
def parse_dates_month_first(spark, sf):
    """The same dates written in six formats, a column each: every column is
    read as a whole, ambiguous days and months included."""
    out = panel(spark, sf).select("entity", "dt", *[F.date_format("dt", f).alias(c) for c, f in _TEXT_DATES.items()])
    votes = date_votes(out, list(_TEXT_DATES))
    for c in _TEXT_DATES:
        out = CL.parse_dates(out, c, parts=False, votes=votes)
    return out.select("entity", *[F.col(c).cast("string").alias(c) for c in ("dt", *_TEXT_DATES)])


# ---------------------------------------------------------------- outliers

_QIQR = "qb AS (SELECT quantile_cont(CAST(value AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(value AS DOUBLE), 0.75) AS q3 FROM panel)"
_V = "CAST(value AS DOUBLE)"


@register(
    "outliers_iqr",
    S.with_(S.PANEL, _QIQR)
    + f"SELECT entity, dt, {_V} AS value, CAST(CASE WHEN {_V} < q1 - 1.5 * (q3 - q1) OR {_V} > q3 + 1.5 * (q3 - q1) "
    "THEN 1 ELSE 0 END AS INTEGER) AS value_outlier FROM panel, qb",
)
def outliers_iqr(spark, sf):
    return publish(CL.outliers_iqr(panel(spark, sf).select("entity", "dt", "value"), "value", 1.5))


@register(
    "outliers_zscore",
    S.with_(S.PANEL, f"zs AS (SELECT {AVG('value')} AS mu, stddev_samp({_V}) AS sd FROM panel)")
    + f"SELECT entity, dt, {_V} AS value, CAST(CASE WHEN abs(({_V} - mu) / nullif(sd, 0)) > 3.0 THEN 1 ELSE 0 END "
    "AS INTEGER) AS value_outlier FROM panel, zs",
)
def outliers_zscore(spark, sf):
    return publish(CL.outliers_zscore(panel(spark, sf).select("entity", "dt", "value"), "value", 3.0, SPEC))


_QCAP = "qb AS (SELECT quantile_cont(CAST(value AS DOUBLE), 0.01) AS lo, quantile_cont(CAST(value AS DOUBLE), 0.99) AS hi FROM panel)"


@register(
    "outliers_cap",
    S.with_(S.PANEL, _QCAP)
    + f"SELECT entity, dt, {R(f'CASE WHEN {_V} < lo THEN lo WHEN {_V} > hi THEN hi ELSE {_V} END', 4)} AS value FROM panel, qb",
)
def outliers_cap(spark, sf):
    out = CL.cap_outliers(panel(spark, sf).select("entity", "dt", "value"), "value")
    return publish(out.withColumn("value", F.round("value", 4)))


@register(
    "outliers_remove",
    S.with_(S.PANEL, _QCAP) + f"SELECT entity, dt, {_V} AS value FROM panel, qb WHERE {_V} >= lo AND {_V} <= hi",
)
def outliers_remove(spark, sf):
    return publish(CL.remove_outliers(panel(spark, sf).select("entity", "dt", "value"), "value"))


# ---------------------------------------------------------------- missing values as NaN

_NAN = (
    "pd AS (SELECT entity, dt, CASE WHEN (entity + weekofyear(dt)) % 13 = 1 THEN NULL WHEN (entity + weekofyear(dt)) % 13 = 0 THEN NULL "
    "ELSE CAST(value AS DOUBLE) END AS v FROM panel)"
)


def _with_nan(spark, sf):
    return double_panel(spark, sf)


@register(
    "outliers_iqr_nan",
    S.with_(S.PANEL, _NAN, "qb AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM pd)")
    + "SELECT entity, dt, CAST(CASE WHEN v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END AS INTEGER) AS value_outlier FROM pd, qb",
)
def outliers_iqr_nan(spark, sf):
    """A NaN is missing: no outlier, and no part of the quartiles."""
    return CL.detect_outliers(_with_nan(spark, sf), "value", "iqr").drop("value")


@register(
    "outliers_zscore_nan",
    S.with_(S.PANEL, _NAN, "zs AS (SELECT avg(v) AS mu, stddev_samp(v) AS sd FROM pd)")
    + "SELECT entity, dt, CAST(CASE WHEN abs((v - mu) / nullif(sd, 0)) > 3.0 THEN 1 ELSE 0 END AS INTEGER) AS value_outlier FROM pd, zs",
)
def outliers_zscore_nan(spark, sf):
    return CL.detect_outliers(_with_nan(spark, sf), "value", "zscore").drop("value")


@register(
    "outliers_cap_nan",
    S.with_(S.PANEL, _NAN, "qb AS (SELECT quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM pd)")
    + f"SELECT entity, dt, {R('CASE WHEN v < lo THEN lo WHEN v > hi THEN hi ELSE v END', 4)} AS value FROM pd, qb",
)
def outliers_cap_nan(spark, sf):
    return CL.cap_outliers(_with_nan(spark, sf), "value").withColumn("value", F.round("value", 4))


_ALL = "st AS (SELECT " + ", ".join([f"{AVG('CAST(value AS DECIMAL(18,2))')} AS value_f", *[f"avg({c}) AS {c}_f" for c in ("cov_a", "cov_b", "cov_c", "cov_d")]]) + " FROM dirty)"


@register(
    "impute_all_numeric",
    S.with_(S.PANEL, S.DIRTY, _ALL) + _sel(_ident({c: f"COALESCE({c}, {c}_f)" for c in ("value", "cov_a", "cov_b", "cov_c", "cov_d")}), "dirty, st"),
)
def impute_all_numeric(spark, sf):
    """No column list: every numeric column but the entity, time and flag."""
    return rounded(CL.impute(dirty(spark, sf), "mean", None, SPEC))


_ISO = "isod AS (SELECT *, CAST(CASE WHEN regexp_full_match(dt_raw, '\\d{4}-\\d{2}-\\d{2}') THEN try_strptime(dt_raw, '%Y-%m-%d') END AS DATE) AS dt FROM dirty)"


@register("parse_dates_one_format", S.with_(S.PANEL, S.DIRTY, _ISO) + _sel({**_ident(), "dt": "CAST(dt AS VARCHAR)"}, "isod"))
def parse_dates_one_format(spark, sf):
    """With a given pattern, text in any other is null."""
    out = CL.parse_dates(dirty(spark, sf), "dt_raw", out="dt", formats="yyyy-MM-dd", parts=False)
    return rounded(out.withColumn("dt", F.col("dt").cast("string")))


_QS = (0.001, 0.01, 0.25, 0.5, 0.75, 0.99, 0.999)


@register(
    "quantiles_narrowed",
    S.with_(S.PANEL) + "SELECT " + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), {q}) AS {c}_q{i}" for c in ("value", "cov_a") for i, q in enumerate(_QS)) + " FROM panel",
)
def quantiles_narrowed(spark, sf):
    """Exact quantiles of two columns, with brackets narrowed once before anything is ordered."""
    return quantile_targets(panel(spark, sf), [(c, q, f"{c}_q{i}") for c in ("value", "cov_a") for i, q in enumerate(_QS)], narrow=1)


@register("dedupe_exact", PD + _sel(_ident(), "(SELECT DISTINCT * FROM dirty)"))
def dedupe_exact(spark, sf):
    return rounded(CL.dedupe(dirty(spark, sf)))


_CLEAN = (
    _PARSED
    + f", st AS (SELECT {AVG('CAST(value AS DECIMAL(18,2))')} AS f0, avg(cov_a) AS f1, avg(cov_b) AS f2, "
    "avg(cov_c) AS f3, avg(cov_d) AS f4 FROM parsed), "
    "imp AS (SELECT entity, dt_raw, COALESCE(value, f0) AS value, flag, COALESCE(cov_a, f1) AS cov_a, "
    "COALESCE(cov_b, f2) AS cov_b, COALESCE(cov_c, f3) AS cov_c, COALESCE(cov_d, f4) AS cov_d, dt, Year, Month, Day, "
    "DayOfWeek FROM parsed, st), "
    "qb AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM imp), "
    "capped AS (SELECT * EXCLUDE (value, lo, hi), CASE WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END "
    "AS value FROM imp, qb)"
)


@register(
    "clean_panel",
    S.with_(S.PANEL, S.DIRTY, _CLEAN) + _sel({**_ident(), **_PARTS}, "(SELECT DISTINCT * FROM capped)"),
)
def clean_panel(spark, sf):
    return rounded(CL.clean_panel(dirty(spark, sf), SPEC, "dt_raw", "dt"))
