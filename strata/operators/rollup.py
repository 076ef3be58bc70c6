"""Grouped business roll-ups: by entity, by calendar period, by flag and by
season, with ranks and top-n.

Every roll-up is a hash aggregate (partial aggregation before the shuffle, so
a hot key ships one partial row per task). Windows that follow run over the
aggregated rows; the only ones without a partition key are over calendar
groups (years, months, seasons), whose count does not grow with the data. The
entity rank, whose input does grow, uses ``global_rank``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import exact_avg, exact_sum, growth_pct, money, plain_avg, r2, ratio_pct
from ..functions.periods import previous
from ..functions.ranking import global_rank
from .features import calendar_columns
from ..spec import DEFAULT, PanelSpec

PERIOD_KEYS: dict[str, tuple[str, ...]] = {
    "Month": ("Year", "Month", "MonthName"),
    "Quarter": ("Year", "Quarter"),
    "Year": ("Year",),
}


def calendar_keys(df: DataFrame, spec: PanelSpec, names: Sequence[str]) -> list[Column]:
    """Calendar group keys: existing columns when present, else derived from time."""
    missing = [n for n in names if n not in df.columns]
    cal = calendar_columns(spec.time, missing) if missing else {}
    return [F.col(n) if n in df.columns else cal[n].alias(n) for n in names]


def _vmax(spec: PanelSpec) -> Column:
    return F.max(money(spec.value, spec))


def _vmin(spec: PanelSpec) -> Column:
    return F.min(money(spec.value, spec))


def rollup_entity(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Total, mean, max, min and row count per entity."""
    return df.groupBy(spec.entity).agg(
        r2(exact_sum(spec.value, spec)).alias("Total_Sales"),
        r2(exact_avg(spec.value, spec)).alias("Avg_Weekly_Sales"),
        _vmax(spec).alias("Max_Weekly_Sales"),
        _vmin(spec).alias("Min_Weekly_Sales"),
        F.count(F.lit(1)).alias("Total_Weeks"),
    )


def rollup_time(
    df: DataFrame, spec: PanelSpec = DEFAULT, period: str = "Month", avg_name: str = "Avg_Weekly_Sales"
) -> DataFrame:
    """Total, mean and row count by Month (Year, Month, MonthName), Quarter
    (Year, Quarter) or Year, in calendar order."""
    if period not in PERIOD_KEYS:
        raise ValueError(f"period must be one of {list(PERIOD_KEYS)}")
    keys = PERIOD_KEYS[period]
    return (
        df.groupBy(*calendar_keys(df, spec, keys))
        .agg(
            r2(exact_sum(spec.value, spec)).alias("Total_Sales"),
            r2(exact_avg(spec.value, spec)).alias(avg_name),
            F.count(F.lit(1)).alias("Total_Records"),
        )
        .orderBy(*[k for k in keys if k != "MonthName"])
    )


# The calendar groupings of ``rollup_calendar`` and their names.
CALENDAR_SETS: dict[str, tuple[str, ...]] = {
    "Month": ("Year", "Month", "MonthName"),
    "Quarter": ("Year", "Quarter"),
    "Year": ("Year",),
    "Month of year": ("Month", "MonthName"),
    "Quarter of year": ("Quarter",),
}


def rollup_calendar(df: DataFrame, spec: PanelSpec = DEFAULT, periods: Sequence[str] | None = None) -> DataFrame:
    """Total, mean and row count of all calendar groupings together: months,
    quarters and years, and months and quarters over all years. ``Period``
    names the grouping; keys it does not use are null.

    One scan and one shuffle by grouping sets, where ``rollup_time`` for each
    period would read the input as many times."""
    names = list(periods or CALENDAR_SETS)
    unknown = set(names) - set(CALENDAR_SETS)
    if unknown:
        raise ValueError(f"periods must be of {list(CALENDAR_SETS)}")
    keys = ["Year", "Quarter", "Month", "MonthName"]
    rows = df.select(spec.value, *calendar_keys(df, spec, keys))
    sets = [tuple(F.col(k) for k in CALENDAR_SETS[n]) for n in names]
    g = rows.groupingSets(sets, *keys).agg(
        F.grouping_id().alias("_gid"),
        r2(exact_sum(spec.value, spec)).alias("Total_Sales"),
        r2(exact_avg(spec.value, spec)).alias("Avg_Sales"),
        F.count(F.lit(1)).alias("Total_Records"),
    )
    period = None
    for n in names:  # a bit is set for each key left out
        gid = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in CALENDAR_SETS[n])
        period = F.when(F.col("_gid") == gid, n) if period is None else period.when(F.col("_gid") == gid, n)
    return g.select(period.alias("Period"), *keys, "Total_Sales", "Avg_Sales", "Total_Records")


def entity_performance(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Per entity: totals, extremes, weeks, covariate means, rank by total
    (``rank``: ties share a rank, the next rank skips) and the max-min range."""
    g = df.groupBy(spec.entity).agg(
        exact_sum(spec.value, spec).alias("_total"),
        r2(exact_avg(spec.value, spec)).alias("Avg_Weekly_Sales"),
        _vmax(spec).alias("Peak_Sales"),
        _vmin(spec).alias("Lowest_Sales"),
        F.count(F.lit(1)).alias("Total_Weeks"),
        *[r2(plain_avg(c)).alias(f"Avg_{c}") for c in spec.covariates],
    )
    g = global_rank(g, "_total", "Sales_Rank", descending=True)
    return g.select(
        spec.entity,
        r2(F.col("_total")).alias("Total_Sales"),
        "Avg_Weekly_Sales",
        "Peak_Sales",
        "Lowest_Sales",
        "Total_Weeks",
        *[f"Avg_{c}" for c in spec.covariates],
        "Sales_Rank",
        r2(F.col("Peak_Sales") - F.col("Lowest_Sales")).alias("Sales_Range"),
    )


def top(df: DataFrame, by: str, n: int = 10, ascending: bool = False, tie: Sequence[str] = ()) -> DataFrame:
    """First n rows by ``by`` with a total order (tie columns ascending).
    Planned as TakeOrderedAndProject: each task keeps n rows."""
    o = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(o, *[F.col(t).asc() for t in tie]).limit(n)


def entity_totals(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    return df.groupBy(spec.entity).agg(r2(exact_sum(spec.value, spec)).alias("Total_Sales"))


def top_entities(df: DataFrame, spec: PanelSpec = DEFAULT, n: int = 10, bottom: bool = False) -> DataFrame:
    """n entities with the largest (or smallest) totals; ties broken by entity."""
    return top(entity_totals(df, spec), "Total_Sales", n, ascending=bottom, tie=[spec.entity])


def flag_impact(
    df: DataFrame, spec: PanelSpec = DEFAULT, labels: tuple[str, str] = ("Non-Holiday", "Holiday")
) -> DataFrame:
    """Rows, total, mean, max and min by flag value, with a period label (null
    for rows without a flag)."""
    return df.groupBy(spec.flag).agg(
        F.count(F.lit(1)).alias("Total_Records"),
        r2(exact_sum(spec.value, spec)).alias("Total_Sales"),
        r2(exact_avg(spec.value, spec)).alias("Avg_Sales"),
        _vmax(spec).alias("Max_Sales"),
        _vmin(spec).alias("Min_Sales"),
    ).withColumn("Period_Type", F.when(F.col(spec.flag) == 1, labels[1]).when(F.col(spec.flag).isNotNull(), labels[0]))


def flag_kpi(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """One row: mean measure with and without the flag, uplift % of the
    flagged mean over the unflagged one, and the flagged share of the total.
    A missing flag group gives nulls instead of an error (ledger D19)."""
    m = money(spec.value, spec)
    on, off = F.col(spec.flag) == 1, F.col(spec.flag) == 0
    s1, c1 = F.sum(F.when(on, m)), F.count(F.when(on, m))
    s0, c0 = F.sum(F.when(off, m)), F.count(F.when(off, m))
    a1 = F.try_divide(s1.cast("double"), c1)
    a0 = F.try_divide(s0.cast("double"), c0)
    return df.agg(
        r2(a0).alias("Non_Flag_Avg"),
        r2(a1).alias("Flag_Avg"),
        ratio_pct(a1 - a0, a0).alias("Flag_Uplift_Pct"),
        ratio_pct(s1, F.sum(m)).alias("Flag_Revenue_Pct"),
        c1.alias("Flag_Rows"),
        c0.alias("Non_Flag_Rows"),
    )


def season_rollup(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Rows, total, mean and max by season, largest total first."""
    return (
        df.groupBy(*calendar_keys(df, spec, ["Season"]))
        .agg(
            F.count(F.lit(1)).alias("Total_Records"),
            r2(exact_sum(spec.value, spec)).alias("Total_Sales"),
            r2(exact_avg(spec.value, spec)).alias("Avg_Sales"),
            _vmax(spec).alias("Max_Sales"),
        )
        .orderBy(F.col("Total_Sales").desc())
    )


def recent_months(df: DataFrame, spec: PanelSpec = DEFAULT, n: int = 12) -> DataFrame:
    """The latest n months of the monthly trend."""
    m = rollup_time(df, spec, "Month", avg_name="Avg_Sales")
    return m.orderBy(F.col("Year").desc(), F.col("Month").desc()).limit(n)


def yearly_trend(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Total, mean and rows by year, the total of the year before (null where
    it has no rows) and growth %."""
    y = df.groupBy(*calendar_keys(df, spec, ["Year"])).agg(
        exact_sum(spec.value, spec).alias("_total"),
        r2(exact_avg(spec.value, spec)).alias("Avg_Weekly_Sales"),
        F.count(F.lit(1)).alias("Total_Weeks"),
    )
    prev = previous("_total", F.col("Year"))  # one row per year: bounded
    return y.select(
        "Year",
        r2(F.col("_total")).alias("Total_Sales"),
        "Avg_Weekly_Sales",
        "Total_Weeks",
        r2(prev).alias("Prev_Year_Sales"),
        growth_pct(F.col("_total"), prev).alias("YoY_Growth_Pct"),
    ).orderBy("Year")


def covariates_by_entity(df: DataFrame, spec: PanelSpec = DEFAULT, digits: int | None = None) -> DataFrame:
    """Mean of every covariate and of the measure per entity, one aggregate."""

    def rnd(c: Column) -> Column:
        return c if digits is None else F.round(c, digits)

    return df.groupBy(spec.entity).agg(
        *[rnd(plain_avg(c)).alias(f"Avg_{c}") for c in spec.covariates],
        exact_avg(spec.value, spec).alias("Avg_Sales"),
    )


def grand_summary(df: DataFrame, spec: PanelSpec = DEFAULT, approx_entities: bool = False) -> DataFrame:
    """One row: total, mean, max, min, rows and distinct entities."""
    ent = F.approx_count_distinct(spec.entity) if approx_entities else F.count_distinct(spec.entity)
    return df.agg(
        r2(exact_sum(spec.value, spec)).alias("total_sales"),
        r2(exact_avg(spec.value, spec)).alias("average_weekly_sales"),
        _vmax(spec).alias("maximum_weekly_sales"),
        _vmin(spec).alias("minimum_weekly_sales"),
        F.count(F.lit(1)).alias("total_records"),
        ent.alias("unique_entities"),
    )


def label_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Row count per label value of each of the ``columns``: Label_Kind (the
    column), Label, Row_Count; one pass for all of them."""
    kinds = F.array(*[F.struct(F.lit(c).alias("Label_Kind"), F.col(c).alias("Label")) for c in columns])
    return df.select(F.inline(kinds)).groupBy("Label_Kind", "Label").agg(F.count(F.lit(1)).alias("Row_Count"))


def entity_gap(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """One row: largest and smallest entity total and their ratio."""
    t = df.groupBy(spec.entity).agg(exact_sum(spec.value, spec).alias("_t"))
    return t.agg(F.max("_t").alias("_mx"), F.min("_t").alias("_mn")).select(
        r2(F.col("_mx")).alias("Max_Entity_Total"),
        r2(F.col("_mn")).alias("Min_Entity_Total"),
        r2(F.try_divide(F.col("_mx").cast("double"), F.col("_mn").cast("double"))).alias("Gap_Ratio"),
    )


def season_kpi(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Per season: total, mean, rows, share of the grand total and rank."""
    g = df.groupBy(*calendar_keys(df, spec, ["Season"])).agg(
        exact_sum(spec.value, spec).alias("_t"),
        r2(exact_avg(spec.value, spec)).alias("Avg_Sales"),
        F.count(F.lit(1)).alias("Week_Count"),
    )
    allrows = Window.partitionBy()  # four seasons at most: bounded
    return g.select(
        "Season",
        r2(F.col("_t")).alias("Total_Sales"),
        "Avg_Sales",
        "Week_Count",
        ratio_pct(F.col("_t"), F.sum("_t").over(allrows)).alias("Revenue_Contribution_Pct"),
        F.rank().over(Window.orderBy(F.col("_t").desc())).alias("Season_Rank"),
    )
