"""Cleaning: imputation, multi-format date parsing, outlier flags, capping,
trimming, de-duplication and the composed cleaning plan.

Statistics (means, quantiles, modes) are one-row aggregates broadcast onto the
rows, so every cleaning step stays one lazy plan with no driver round trip;
quantiles are exact and computed without a single-partition step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, MapType

from ..functions.dates import date_votes, parse_date, parse_date_ordered, vote_order
from ..functions.numeric import exact_avg, plain_avg
from ..functions.ranking import exact_quantiles, quantile_targets
from ..functions.scalars import with_scalars
from ..spec import DEFAULT, PanelSpec
from .quality import missing, numeric_columns

# Columns that ``parse_dates`` adds.
DATE_PARTS: tuple[str, ...] = ("Year", "Month", "Day", "DayOfWeek")
STRATEGIES = ("mean", "median", "mode", "drop", "fill")


def _fill(df: DataFrame, stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace null (and NaN in float columns) by the matching ``_f<i>`` scalar,
    keeping each column's type."""
    out = with_scalars(df, stats)
    repl = {
        c: F.when(missing(df, c), F.col(f"_f{i}").cast(df.schema[c].dataType)).otherwise(F.col(c))
        for i, c in enumerate(columns)
    }
    return out.withColumns(repl).select(*df.columns)


def _modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the most frequent non-missing value of each column as
    ``_f<i>``; ties go to the smallest value. One pass for all columns: a row
    gives one (column, value) pair per column, pairs are counted (partial
    aggregation first) and the counts reduced by ``min_by``."""
    kinds = [df.schema[c].dataType for c in columns]
    none = [F.lit(None).cast(t) for t in kinds]
    value = [F.nanvl(F.col(c), n) if isinstance(t, (FloatType, DoubleType)) else F.col(c) for c, t, n in zip(columns, kinds, none)]
    pairs = [
        F.struct(F.lit(i).alias("i"), *[(value[j] if j == i else none[j]).alias(f"v{j}") for j in range(len(columns))])
        for i in range(len(columns))
    ]
    long = df.select(F.inline(F.array(*pairs)))
    vs = [f"v{j}" for j in range(len(columns))]
    counts = long.where(F.coalesce(*[F.col(v).cast("string") for v in vs]).isNotNull()).groupBy("i", *vs).agg(F.count(F.lit(1)).alias("k"))
    return counts.agg(
        *[
            F.min_by(f"v{j}", F.when(F.col("i") == j, F.struct((-F.col("k")).alias("k"), F.col(f"v{j}").alias("v")))).alias(f"_f{j}")
            for j in range(len(columns))
        ]
    )


def impute(
    df: DataFrame,
    strategy: str = "mean",
    columns: Sequence[str] | None = None,
    spec: PanelSpec | None = DEFAULT,
    exact: bool = True,
) -> DataFrame:
    """Missing-value treatment: ``mean`` / ``median`` / ``mode`` fill,
    ``drop`` rows with a missing listed column, or ``fill`` with 0.
    ``columns=None`` means every numeric column but the entity, time and flag
    of ``spec`` (D4; a made-up entity id would be a wrong row). The measure
    named by ``spec`` is averaged exactly (decimal sum). ``exact=False`` takes
    approximate medians."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    roles = {spec.entity, spec.time, spec.flag} if spec is not None else set()
    cols = list(columns) if columns is not None else [c for c in numeric_columns(df) if c not in roles]
    if not cols:
        return df
    if strategy == "drop":
        return df.dropna(subset=cols)
    if strategy == "fill":
        return df.fillna(0, subset=cols)
    if strategy == "mean":

        def mean(c: str) -> Column:
            if spec is not None and c == spec.value and spec.value_scale is not None:
                return exact_avg(c, spec)
            return plain_avg(c)

        stats = df.agg(*[mean(c).alias(f"_f{i}") for i, c in enumerate(cols)])
    elif strategy == "median":
        if exact:
            stats = quantile_targets(df, [(c, 0.5, f"_f{i}") for i, c in enumerate(cols)])
        else:
            x = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols}
            stats = df.agg(*[F.percentile_approx(x[c], 0.5, 10000).alias(f"_f{i}") for i, c in enumerate(cols)])
    else:
        stats = _modes(df, cols)
    return _fill(df, stats, cols)


def parse_dates(
    df: DataFrame,
    column: str = "Date",
    out: str | None = None,
    formats: Sequence[str] | str | None = None,
    parts: bool = True,
    votes: DataFrame | None = None,
) -> DataFrame:
    """String column -> date; unparseable text becomes null. Adds Year, Month,
    Day, DayOfWeek.

    One given pattern is used as it is. Of several (by default all known ones)
    every row takes the one that the unambiguous values of the whole column
    speak for most, among those that can read it; the votes are one row,
    broadcast. ``votes`` takes them from elsewhere (``date_votes``). To parse
    several columns, take the votes of all of them from the raw table at once:
    those of a column counted behind the parsing of others would repeat it."""
    target = out or column
    if isinstance(formats, str) or (formats is not None and len(formats) == 1):
        res = df.withColumn(target, parse_date(column, formats))
    else:
        names = [*df.columns, *([target] if target not in df.columns else [])]
        one = votes if votes is not None else date_votes(df, column, formats)
        order = F.col("_vote_order") if "_vote_order" in one.columns else vote_order("_votes")
        if "_vote_order" in one.columns and isinstance(one.schema["_vote_order"].dataType, MapType):
            order = order[column]
        res = with_scalars(df, one).withColumn(target, parse_date_ordered(column, order, formats)).select(*names)
    if parts:
        d = F.col(target)
        res = res.withColumns(dict(zip(DATE_PARTS, (F.year(d), F.month(d), F.dayofmonth(d), F.dayofweek(d)))))
    return res


def _number(column: str) -> Column:
    """The column as double, NaN as null (D23)."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def outliers_iqr(df: DataFrame, column: str, threshold: float = 1.5, exact: bool = True) -> DataFrame:
    """``{column}_outlier`` = 1 outside [q1 - k*IQR, q3 + k*IQR], else 0 (also
    for a missing value)."""
    q = exact_quantiles(df, column, [0.25, 0.75], ["_q1", "_q3"], exact=exact)
    x = _number(column)
    iqr = F.col("_q3") - F.col("_q1")
    flag = F.when((x < F.col("_q1") - threshold * iqr) | (x > F.col("_q3") + threshold * iqr), 1).otherwise(0)
    return with_scalars(df, q).withColumn(f"{column}_outlier", flag).select(*df.columns, f"{column}_outlier")


def outliers_zscore(df: DataFrame, column: str, threshold: float = 3.0, spec: PanelSpec | None = None) -> DataFrame:
    """``{column}_outlier`` = 1 when |x - mean| / stddev > threshold (ledger D2, D3), else 0."""
    x = _number(column)
    mean = exact_avg(column, spec) if spec is not None and spec.value == column else plain_avg(column)
    stats = df.agg(mean.alias("_mu"), F.stddev(x).alias("_sd"))
    z = F.abs(F.try_divide(x - F.col("_mu"), F.col("_sd")))
    flag = F.when(z > threshold, 1).otherwise(0)
    return with_scalars(df, stats).withColumn(f"{column}_outlier", flag).select(*df.columns, f"{column}_outlier")


def detect_outliers(
    df: DataFrame, column: str, method: str = "iqr", threshold: float | None = None, spec: PanelSpec | None = None, exact: bool = True
) -> DataFrame:
    """``outliers_iqr`` or ``outliers_zscore`` by name, with their default
    thresholds. ``exact=False`` takes approximate quartiles (D9)."""
    if method == "iqr":
        return outliers_iqr(df, column, 1.5 if threshold is None else threshold, exact=exact)
    if method == "zscore":
        return outliers_zscore(df, column, 3.0 if threshold is None else threshold, spec)
    raise ValueError("method must be 'iqr' or 'zscore'")


def _bounds(df: DataFrame, column: str, lower: float, upper: float, exact: bool = True) -> DataFrame:
    return exact_quantiles(df, column, [lower, upper], ["_lo", "_hi"], exact=exact)


def cap_outliers(df: DataFrame, column: str, lower: float = 0.01, upper: float = 0.99, exact: bool = True) -> DataFrame:
    """Winsorise to the [lower, upper] quantiles; nulls stay null and NaN
    becomes null. The column becomes double."""
    x = _number(column)
    capped = F.when(x < F.col("_lo"), F.col("_lo")).when(x > F.col("_hi"), F.col("_hi")).otherwise(x)
    return with_scalars(df, _bounds(df, column, lower, upper, exact)).withColumn(column, capped).select(*df.columns)


def remove_outliers(df: DataFrame, column: str, lower: float = 0.01, upper: float = 0.99, exact: bool = True) -> DataFrame:
    """Keep rows inside the [lower, upper] quantiles (missing values drop out)."""
    x = _number(column)
    kept = with_scalars(df, _bounds(df, column, lower, upper, exact)).where((x >= F.col("_lo")) & (x <= F.col("_hi")))
    return kept.select(*df.columns)


def handle_outliers(
    df: DataFrame, column: str, method: str = "cap", lower: float = 0.01, upper: float = 0.99, exact: bool = True
) -> DataFrame:
    """``cap_outliers`` or ``remove_outliers`` by name; ``exact=False`` takes
    approximate quantiles (D9)."""
    if method == "cap":
        return cap_outliers(df, column, lower, upper, exact)
    if method == "remove":
        return remove_outliers(df, column, lower, upper, exact)
    raise ValueError("method must be 'cap' or 'remove'")


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop exact duplicate rows (or duplicates on ``subset``)."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def clean_panel(
    df: DataFrame,
    spec: PanelSpec = DEFAULT,
    date_column: str = "Date",
    date_out: str | None = None,
) -> DataFrame:
    """Parse dates, mean-impute the measure and covariates, cap the measure at
    p1/p99, drop exact duplicates (as the reference does, D24).
    Reports are separate operators (``null_profile``, ``validate_report``)."""
    # the statistics read no date, so dates are parsed behind them
    filled = impute(df, "mean", [spec.value, *spec.covariates], spec)
    capped = cap_outliers(filled, spec.value)
    votes = date_votes(df, date_column)
    if date_out is None or {date_out, *DATE_PARTS} & set(df.columns):
        return dedupe(parse_dates(capped, date_column, date_out, votes=votes))
    # the text stays and nothing is replaced: rows are equal without their dates if they are with them
    return parse_dates(dedupe(capped), date_column, date_out, votes=votes)
