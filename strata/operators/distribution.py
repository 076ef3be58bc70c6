"""Chart data as Spark aggregates: the reference collects whole columns to
pandas to draw; here each chart's data is a small aggregate computed on the
cluster (series points, season means, histogram bins, box-plot summary,
correlation matrix), plus volatility and per-entity correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import season_ordinal
from ..functions.numeric import exact_avg, exact_sum, money, r2, safe_corr
from ..functions.ranking import exact_quantiles, global_rank
from ..functions.scalars import long_table, with_scalars
from ..spec import DEFAULT, PanelSpec
from .rollup import calendar_keys, top


def _x(df: DataFrame, spec: PanelSpec, column: str | None) -> Column:
    if column is None or column == spec.value:
        return money(spec.value, spec).cast("double")
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def series_points(df: DataFrame, spec: PanelSpec = DEFAULT, entity=None) -> DataFrame:
    """One point per period: the measure summed over entities (or for one
    entity), in time order — bounded by the number of periods."""
    src = df if entity is None else df.where(F.col(spec.entity) == F.lit(entity))
    return (
        src.groupBy(spec.time)
        .agg(r2(exact_sum(spec.value, spec)).alias("Total_Sales"), F.count(F.lit(1)).alias("Entities"))
        .orderBy(spec.time)
    )


def season_avg(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Mean measure by season in Winter, Spring, Summer, Fall order."""
    g = df.groupBy(*calendar_keys(df, spec, ["Season"])).agg(exact_avg(spec.value, spec).alias("Avg_Sales"))
    return g.withColumn("Season_Order", season_ordinal(F.col("Season"))).orderBy("Season_Order")


def histogram(df: DataFrame, spec: PanelSpec = DEFAULT, bins: int = 50, column: str | None = None) -> DataFrame:
    """``bins`` equal-width bins over [min, max] of the measure: Bin, Bin_Start,
    Bin_End, Row_Count (empty bins included). The maximum falls in the last
    bin; a constant column puts every row in bin 0 (ledger M13)."""
    x = _x(df, spec, column)
    vals = df.select(x.alias("_v")).where(F.col("_v").isNotNull())
    st = vals.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi")).withColumn(
        "_w", (F.col("_hi") - F.col("_lo")) / bins
    )
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor(F.try_divide(F.col("_v") - F.col("_lo"), F.col("_w"))), F.lit(bins - 1))
    )
    counts = with_scalars(vals, st).groupBy(b.cast("int").alias("Bin")).agg(F.count(F.lit(1)).alias("Row_Count"))
    frame = st.where(F.col("_lo").isNotNull()).select(
        "_lo", "_w", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("Bin")
    )
    # both sides hold at most ``bins`` rows
    out = frame.join(F.broadcast(counts), "Bin", "left")
    return out.select(
        "Bin",
        F.round(F.col("_lo") + F.col("Bin") * F.col("_w"), 4).alias("Bin_Start"),
        F.round(F.col("_lo") + (F.col("Bin") + 1) * F.col("_w"), 4).alias("Bin_End"),
        F.coalesce(F.col("Row_Count"), F.lit(0)).alias("Row_Count"),
    ).orderBy("Bin")


def box_summary(
    df: DataFrame, spec: PanelSpec = DEFAULT, column: str | None = None, whisker: float = 1.5, exact: bool = True
) -> DataFrame:
    """One row: count, min, quartiles, IQR, fences, whiskers (most extreme
    values inside the fences) and the number of points outside. Quartiles are
    exact, or with ``exact=False`` approximate in one pass (D9)."""
    x = _x(df, spec, column)
    vals = df.select(x.alias("_v")).where(F.col("_v").isNotNull())
    q = exact_quantiles(vals, "_v", [0.25, 0.5, 0.75], ["_q1", "_q2", "_q3"], exact=exact)
    q = q.withColumn("_iqr", F.col("_q3") - F.col("_q1")).withColumns(
        {"_lf": F.col("_q1") - whisker * F.col("_iqr"), "_uf": F.col("_q3") + whisker * F.col("_iqr")}
    )
    v = F.col("_v")
    inside_lo, inside_hi = v >= F.col("_lf"), v <= F.col("_uf")
    # a global aggregate: one row even for an empty input (ledger M9)
    agg = with_scalars(vals, q).agg(
        *[F.max(c).alias(c) for c in ("_q1", "_q2", "_q3", "_iqr", "_lf", "_uf")],
        F.count(F.lit(1)).alias("Count"),
        F.min(v).alias("Min"),
        F.max(v).alias("Max"),
        F.min(F.when(inside_lo, v)).alias("Whisker_Low"),
        F.max(F.when(inside_hi, v)).alias("Whisker_High"),
        F.count_if(~inside_lo | ~inside_hi).alias("Outlier_Count"),
    )
    r4 = lambda c: F.round(F.col(c), 4)
    return agg.select(
        "Count",
        "Min",
        r4("_q1").alias("Q1"),
        r4("_q2").alias("Median"),
        r4("_q3").alias("Q3"),
        r4("_iqr").alias("IQR"),
        r4("_lf").alias("Lower_Fence"),
        r4("_uf").alias("Upper_Fence"),
        "Whisker_Low",
        "Whisker_High",
        "Outlier_Count",
        "Max",
    )


def correlation_matrix(
    df: DataFrame, spec: PanelSpec = DEFAULT, columns: Sequence[str] | None = None, digits: int = 6
) -> DataFrame:
    """Pearson correlation of every pair of (measure, covariates) from ONE
    aggregate, as long (X, Y, Corr) rows, symmetric with both orders."""
    cols = list(columns or [spec.value, *spec.covariates])
    xs = {c: _x(df, spec, c) for c in cols}
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]

    def cell(a: str, b: str) -> Column:
        return F.when(F.stddev_samp(xs[a]) > 0, 1.0) if a == b else F.round(safe_corr(xs[a], xs[b]), digits)

    row = df.agg(*[cell(a, b).alias(f"_c{k}") for k, (a, b) in enumerate(pairs)])
    cells = []
    for k, (a, b) in enumerate(pairs):
        cells.append(F.struct(F.lit(a).alias("X"), F.lit(b).alias("Y"), F.col(f"_c{k}").alias("Corr")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("X"), F.lit(a).alias("Y"), F.col(f"_c{k}").alias("Corr")))
    return row.select(F.inline(F.array(*cells)))


def entity_volatility(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Per entity: mean, stddev, coefficient of variation % and its rank
    (most volatile first, distributed rank)."""
    m = money(spec.value, spec)
    g = df.groupBy(spec.entity).agg(
        F.try_divide(F.sum(m).cast("double"), F.count(m)).alias("_a"), F.stddev(m.cast("double")).alias("_sd")
    )
    g = g.select(
        spec.entity,
        r2(F.col("_a")).alias("Avg_Weekly_Sales"),
        r2(F.col("_sd")).alias("Sales_StdDev"),
        r2(F.try_divide(F.col("_sd"), F.col("_a")) * 100).alias("CV_Pct"),
    )
    return global_rank(g, "CV_Pct", "Volatility_Rank", descending=True)


def correlation_by_entity(df: DataFrame, spec: PanelSpec = DEFAULT, digits: int = 6) -> DataFrame:
    """Per entity: correlation of the measure with each covariate."""
    v = _x(df, spec, None)
    return df.groupBy(spec.entity).agg(
        *[F.round(safe_corr(v, _x(df, spec, c)), digits).alias(f"Corr_{c}") for c in spec.covariates]
    )


def peak_flag_periods(df: DataFrame, spec: PanelSpec = DEFAULT, n: int = 10) -> DataFrame:
    """The n flagged periods with the largest total measure across entities."""
    g = (
        df.where(F.col(spec.flag) == 1)
        .groupBy(spec.time)
        .agg(r2(exact_sum(spec.value, spec)).alias("Total_Sales"), F.count(F.lit(1)).alias("Entities"))
    )
    return top(g, "Total_Sales", n, tie=[spec.time])


# Key columns of the charts that are not by entity.
CHART_KEYS = {
    "seasons": ("Season",), "months": ("Month",), "flag_impact": (), "histogram": ("Bin",), "box": (),
    "correlation": ("X", "Y"), "years": ("Year",),
}


def chart_table(df: DataFrame, spec: PanelSpec = DEFAULT, top_n: int = 10) -> DataFrame:
    """The data of all charts as one table: Section, Row_Key, Metric, Value."""
    keys = {"series": (spec.time,), **CHART_KEYS}
    return long_table({n: (part, keys.get(n, (spec.entity,))) for n, part in chart_data(df, spec, top_n).items()})


def chart_data(df: DataFrame, spec: PanelSpec = DEFAULT, top_n: int = 10) -> dict[str, DataFrame]:
    """The data behind every chart of the reference's dashboard, as lazy
    DataFrames over one input (cache ``df`` first when evaluating several)."""
    from .kpi import revenue_by_year
    from .rollup import flag_kpi, top_entities
    from .series import seasonality

    return {
        "series": series_points(df, spec),
        "top_entities": top_entities(df, spec, top_n),
        "bottom_entities": top_entities(df, spec, top_n, bottom=True),
        "seasons": season_avg(df, spec),
        "months": seasonality(df, spec, "Month"),
        "flag_impact": flag_kpi(df, spec),
        "histogram": histogram(df, spec),
        "box": box_summary(df, spec),
        "correlation": correlation_matrix(df, spec),
        "years": revenue_by_year(df, spec),
    }
