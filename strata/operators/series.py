"""Time-series operators over a panel: moving averages and crossover signals,
momentum, velocity, seasonality profiles, year-over-year comparison, peaks,
trend strength and baseline forecasts.

Row-wise series columns are window expressions partitioned by the entity
(one Exchange per chain); profiles are hash aggregates over calendar keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions.numeric import exact_avg, exact_sum, money, r2, ratio_pct
from ..functions.periods import previous
from ..functions.scalars import with_scalars
from ..spec import DEFAULT, PanelSpec
from .features import entity_window, rolling_columns, split_window_features
from .rollup import calendar_keys, top

# Crossover and velocity labels.
TREND_LABELS = ("Uptrend", "Downtrend", "Neutral")
VELOCITY_LABELS = ("Accelerating", "Decelerating", "Stable")

SEASONALITY_KEYS: dict[str, tuple[str, ...]] = {
    "Month": ("Month", "MonthName"),
    "Quarter": ("Quarter",),
    "DayOfWeek": ("DayOfWeek", "DayName"),
}


def ma_columns(spec: PanelSpec, windows: Sequence[int], min_rows: int = 1) -> dict[str, Column]:
    return rolling_columns(spec, windows, avg_name="MA_{k}W", sum_name=None, min_rows=min_rows)


def _split_lags(df: DataFrame, spec: PanelSpec, lags: Sequence[int], split_block: Column) -> DataFrame:
    """``df`` plus ``_lag{k}`` columns computed by ``split_window_features``."""
    t = split_window_features(df, spec, (), lags, split_block)
    return t.select(*df.columns, *[F.col(f"Sales_Lag_{k}W").alias(f"_lag{k}") for k in lags])


def moving_averages(
    df: DataFrame,
    spec: PanelSpec = DEFAULT,
    windows: Sequence[int] = (4, 8, 12, 26, 52),
    split_block: Column | None = None,
    min_rows: int = 1,
) -> DataFrame:
    """MA_kW: trailing k-row mean per entity, rounded to 2; null where the
    window holds fewer than ``min_rows`` values (D13). ``split_block`` selects
    the split strategy for a dominant entity (same values)."""
    if split_block is None:
        return df.withColumns(ma_columns(spec, windows, min_rows))
    t = split_window_features(df, spec, windows, (), split_block, min_rows)
    return t.select(*df.columns, *[F.col(f"Rolling_Avg_{k}W").alias(f"MA_{k}W") for k in windows])


def trend_signal(
    df: DataFrame, spec: PanelSpec = DEFAULT, short: int = 4, long: int = 12, split_block: Column | None = None
) -> DataFrame:
    """Uptrend when MA_short > MA_long, Downtrend when below, else Neutral
    (including missing averages). Missing MA columns are added (D14)."""
    need = [k for k in (short, long) if f"MA_{k}W" not in df.columns]
    if need:
        df = moving_averages(df, spec, need, split_block)
    s, lo = F.col(f"MA_{short}W"), F.col(f"MA_{long}W")
    up, down, flat = TREND_LABELS
    return df.withColumn("Trend_Signal", F.when(s > lo, up).when(s < lo, down).otherwise(flat))


def momentum(df: DataFrame, spec: PanelSpec = DEFAULT, period: int = 4, split_block: Column | None = None) -> DataFrame:
    """Value ``period`` rows back, the difference and the difference in %."""
    if split_block is None:
        ago = F.lag(spec.value, period).over(entity_window(spec))
    else:
        cols = df.columns
        df = _split_lags(df, spec, (period,), split_block)
        ago = F.col(f"_lag{period}")
    diff = F.col(spec.value) - ago
    out = df.withColumns(
        {
            f"Sales_{period}W_Ago": ago,
            f"Momentum_{period}W": r2(diff),
            f"Momentum_Pct_{period}W": ratio_pct(diff, ago),
        }
    )
    return out if split_block is None else out.drop(f"_lag{period}").select(
        *cols, f"Sales_{period}W_Ago", f"Momentum_{period}W", f"Momentum_Pct_{period}W"
    )


def velocity(df: DataFrame, spec: PanelSpec = DEFAULT, split_block: Column | None = None) -> DataFrame:
    """First and second differences of the measure and a sign label.

    Acceleration is v - 2*lag1 + lag2 (the lag of the first difference),
    evaluated in the same window pass."""
    cols = df.columns
    if split_block is None:
        w = entity_window(spec)
        l1, l2 = F.lag(spec.value, 1).over(w), F.lag(spec.value, 2).over(w)
    else:
        df = _split_lags(df, spec, (1, 2), split_block)
        l1, l2 = F.col("_lag1"), F.col("_lag2")
    v = F.col(spec.value)
    vel = v - l1
    up, down, flat = VELOCITY_LABELS
    out = df.withColumns(
        {
            "Prev_Week_Sales": l1,
            "Sales_Velocity": r2(vel),
            "Sales_Acceleration": r2(v - F.lit(2) * l1 + l2),
            "Velocity_Status": F.when(vel > 0, up).when(vel < 0, down).otherwise(flat),
        }
    )
    names = ["Prev_Week_Sales", "Sales_Velocity", "Sales_Acceleration", "Velocity_Status"]
    return out if split_block is None else out.select(*cols, *names)


def seasonality(df: DataFrame, spec: PanelSpec = DEFAULT, by: str = "Month") -> DataFrame:
    """Mean, total and rows of the measure by Month, Quarter or DayOfWeek
    over all years (DayOfWeek has no total, as in the reference)."""
    if by not in SEASONALITY_KEYS:
        raise ValueError(f"by must be one of {list(SEASONALITY_KEYS)}")
    aggs = [r2(exact_avg(spec.value, spec)).alias("Avg_Sales")]
    if by != "DayOfWeek":
        aggs.append(r2(exact_sum(spec.value, spec)).alias("Total_Sales"))
    aggs.append(F.count(F.lit(1)).alias("Data_Points"))
    keys = SEASONALITY_KEYS[by]
    return df.groupBy(*calendar_keys(df, spec, keys)).agg(*aggs).orderBy(keys[0])


def yoy_month(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Monthly totals next to the same month one year earlier (null where that
    month has no rows)."""
    m = df.groupBy(*calendar_keys(df, spec, ["Year", "Month", "MonthName"])).agg(
        exact_sum(spec.value, spec).alias("_t"),
        r2(exact_avg(spec.value, spec)).alias("Avg_Weekly_Sales"),
        F.count(F.lit(1)).alias("Week_Count"),
    )
    prev = previous("_t", F.col("Year"), "Month")
    return m.select(
        "Year",
        "Month",
        "MonthName",
        r2(F.col("_t")).alias("Monthly_Sales"),
        "Avg_Weekly_Sales",
        "Week_Count",
        r2(prev).alias("Prev_Year_Sales"),
        r2(F.col("_t") - prev).alias("YoY_Change"),
        ratio_pct(F.col("_t") - prev, prev).alias("YoY_Change_Pct"),
    ).orderBy("Year", "Month")


def peak_rows(df: DataFrame, spec: PanelSpec = DEFAULT, n: int = 10) -> DataFrame:
    """The n largest rows with their calendar context (ties by entity, time)."""
    ctx = calendar_keys(df, spec, ["Year", "Month", "MonthName", "Season"])
    rows = df.select(spec.entity, spec.time, spec.value, spec.flag, *ctx)
    return top(rows, spec.value, n, tie=[spec.entity, spec.time])


def peak_months(df: DataFrame, spec: PanelSpec = DEFAULT, n: int = 10) -> DataFrame:
    m = df.groupBy(*calendar_keys(df, spec, ["Year", "Month", "MonthName"])).agg(
        r2(exact_sum(spec.value, spec)).alias("Total_Sales")
    )
    return top(m, "Total_Sales", n, tie=["Year", "Month"])


def _ma_avg(c: str) -> Column:
    x = F.col(c).cast(DecimalType(20, 2))  # MA values carry two decimals: exact
    return F.try_divide(F.sum(x).cast("double"), F.count(x))


def last_rows(df: DataFrame, spec: PanelSpec, n: int, split_block: Column | None = None) -> DataFrame:
    """The last ``n`` rows of every entity. With ``split_block`` (an ascending
    function of time) in two stages: the last n of each (entity, block), then
    the last n of what is left, at most n rows a block."""
    order = [F.col(c).desc() for c in spec.order]
    out = df
    if split_block is not None:
        inner = Window.partitionBy(spec.entity, "_blk").orderBy(*order)
        out = out.withColumn("_blk", split_block).withColumn("_rn", F.row_number().over(inner)).where(F.col("_rn") <= n)
    w = Window.partitionBy(spec.entity).orderBy(*order)
    return out.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).select(*df.columns)


def _recent(df: DataFrame, spec: PanelSpec, recent: int, split_block: Column | None) -> DataFrame:
    need = [k for k in (4, 12) if f"MA_{k}W" not in df.columns]
    if need:
        df = moving_averages(df, spec, need, split_block)  # D15: add the averages it needs
    last = last_rows(df, spec, recent, split_block)
    return last.groupBy(spec.entity).agg(
        exact_avg(spec.value, spec).alias("_av"),
        _ma_avg("MA_4W").alias("_a4"),
        _ma_avg("MA_12W").alias("_a12"),
        F.max(spec.time).alias("_last"),
    )


def forecast_baseline(
    df: DataFrame, spec: PanelSpec = DEFAULT, recent: int = 12, split_block: Column | None = None
) -> DataFrame:
    """Per entity over its last ``recent`` rows: mean measure, mean MA_4W and
    MA_12W, and next-period forecast = mean of the two MA means. The
    row_number filter is planned as a per-entity WindowGroupLimit;
    ``split_block`` keeps a dominant entity out of one task (``last_rows``)."""
    g = _recent(df, spec, recent, split_block)
    return g.select(
        spec.entity,
        r2(F.col("_av")).alias("Recent_Avg_Sales"),
        r2(F.col("_a4")).alias("Recent_MA_4W"),
        r2(F.col("_a12")).alias("Recent_MA_12W"),
        r2((F.col("_a4") + F.col("_a12")) / 2).alias("Forecast_Next_Week"),
    )


def trend_strength(df: DataFrame, spec: PanelSpec = DEFAULT, split_block: Column | None = None) -> DataFrame:
    """Per entity: rows in each trend state, total, and uptrend share %.
    ``split_block`` as in ``trend_signal``; the counts are added up by task."""
    if "Trend_Signal" not in df.columns:
        df = trend_signal(df, spec, split_block=split_block)
    sig = F.col("Trend_Signal")
    up, down, flat = TREND_LABELS
    g = df.groupBy(spec.entity).agg(
        F.count_if(sig == up).alias("Uptrend_Periods"),
        F.count_if(sig == down).alias("Downtrend_Periods"),
        F.count_if(sig == flat).alias("Neutral_Periods"),
        F.count(F.lit(1)).alias("Total_Periods"),
    )
    return g.withColumn("Uptrend_Pct", ratio_pct(F.col("Uptrend_Periods"), F.col("Total_Periods")))


def trend_counts(df: DataFrame, spec: PanelSpec = DEFAULT, split_block: Column | None = None) -> DataFrame:
    if "Trend_Signal" not in df.columns:
        df = trend_signal(df, spec, split_block=split_block)
    return df.groupBy(spec.entity, "Trend_Signal").agg(F.count(F.lit(1)).alias("Period_Count"))


def _month_index(df: DataFrame, spec: PanelSpec) -> DataFrame:
    m = df.groupBy(*calendar_keys(df, spec, ["Month", "MonthName"])).agg(exact_avg(spec.value, spec).alias("_am"))
    overall = df.agg(exact_avg(spec.value, spec).alias("_all"))
    return with_scalars(m, overall).withColumn("_idx", F.try_divide(F.col("_am"), F.col("_all")))


def seasonal_index(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Per calendar month: mean measure and its ratio to the overall mean."""
    return _month_index(df, spec).select(
        "Month", "MonthName", r2(F.col("_am")).alias("Avg_Sales"), F.round("_idx", 4).alias("Seasonal_Index")
    )


def forecast_horizon(
    df: DataFrame,
    spec: PanelSpec = DEFAULT,
    horizon: int = 4,
    step_days: int = 7,
    recent: int = 12,
    split_block: Column | None = None,
) -> DataFrame:
    """``horizon`` future periods per entity: the flat baseline forecast
    scaled by the seasonal index of each target month. The index table has
    at most 12 rows, so it is broadcast."""
    base = _recent(df, spec, recent, split_block).select(
        spec.entity, ((F.col("_a4") + F.col("_a12")) / 2).alias("_base"), "_last"
    )
    idx = _month_index(df, spec).select(F.col("Month").alias("_m"), "_idx")
    steps = base.select(
        spec.entity, "_base", "_last", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("Step")
    ).withColumn("Forecast_Date", F.date_add(F.col("_last"), F.col("Step") * step_days))
    out = steps.join(F.broadcast(idx), F.month("Forecast_Date") == F.col("_m"), "left")
    return out.select(
        spec.entity,
        "Step",
        "Forecast_Date",
        r2(F.col("_base") * F.col("_idx")).alias("Forecast_Value"),
    )
