"""Micro-fixtures with hand-computed answers (FIXTURES.md section 4)."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, IntegerType, LongType, StructField, StructType

from strata.functions import exact_quantiles, global_rank, parse_date, season
from strata.operators import clean as CL
from strata.operators import distribution as DI
from strata.operators import features as FE
from strata.operators import kpi as K
from strata.operators import quality as QU
from strata.operators import rollup as RU
from strata.operators import series as TS
from strata.spec import PanelSpec

SPEC = PanelSpec(covariates=())
SCHEMA = StructType(
    [
        StructField("entity", LongType()),
        StructField("dt", DateType()),
        StructField("value", DecimalType(18, 2)),
        StructField("flag", IntegerType()),
    ]
)


def panel(spark, values, entity=1, flags=None, start=dt.date(2020, 1, 6)):
    rows = []
    for i, v in enumerate(values):
        d = start + dt.timedelta(days=7 * i)
        rows.append((entity, d, None if v is None else Decimal(str(v)), (flags or [0] * len(values))[i]))
    return spark.createDataFrame(rows, SCHEMA)


def by_time(df):
    return [r.asDict() for r in df.orderBy("entity", "dt").collect()]


def test_m1_velocity_rolling_wow(spark):
    p = panel(spark, [10, 20, 15, 15, None, 30])
    v = by_time(TS.velocity(p, SPEC))
    assert [r["Prev_Week_Sales"] for r in v] == [None, 10, 20, 15, 15, None]
    assert [r["Sales_Velocity"] for r in v] == [None, 10, -5, 0, None, None]
    assert [r["Sales_Acceleration"] for r in v] == [None, None, -15, 5, None, None]
    assert [r["Velocity_Status"] for r in v] == ["Stable", "Accelerating", "Decelerating", "Stable", "Stable", "Stable"]
    r = by_time(p.withColumns(FE.rolling_columns(SPEC, [2])))
    assert [x["Rolling_Avg_2W"] for x in r] == [10.0, 15.0, 17.5, 15.0, 15.0, 30.0]
    assert [x["Rolling_Sum_2W"] for x in r] == [10.0, 30.0, 35.0, 30.0, 15.0, 30.0]
    g = by_time(FE.growth_rates(p, SPEC))
    assert [x["WoW_Growth_Pct"] for x in g] == [None, 100.0, -25.0, 0.0, None, None]


def test_m2_growth_from_zero_is_null(spark):
    g = by_time(FE.growth_rates(panel(spark, [0, 5]), SPEC))
    assert g[1]["WoW_Growth_Pct"] is None


def test_m3_nan_and_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    prof = QU.null_profile(df).collect()[0]
    assert prof["Null_Count"] == 2 and prof["Null_Pct"] == 50.0
    filled = [r.x for r in CL.impute(df, "mean", ["x"], None).collect()]
    assert sorted(filled) == [1.0, 2.0, 2.0, 3.0]


def test_m4_multi_format_dates(spark):
    raw = ["05-02-2010", "2010-02-05", "05/02/2010", "5/2/2010", "25/12/2010", "junk", None]
    df = spark.createDataFrame([(s,) for s in raw], "s string")
    got = [r.d for r in df.select(parse_date("s").alias("d")).collect()]
    d = dt.date
    assert got == [d(2010, 2, 5), d(2010, 2, 5), d(2010, 2, 5), d(2010, 5, 2), d(2010, 12, 25), None, None]


def test_m5_profile_mixed_types(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2020, 1, 1), 1, 1.5), (None, None, None, float("nan"))],
        "s string, d date, i int, x double",
    )
    prof = {r.Column: r.Null_Count for r in QU.null_profile(df).collect()}
    assert prof == {"s": 1, "d": 1, "i": 1, "x": 1}
    stats = QU.dataset_stats(df).collect()[0]
    assert stats.Total_Records == 2 and stats.Total_Columns == 4


def test_m6_outliers_and_cap(spark):
    vals = [float(i) for i in range(1, 100)] + [10000.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    flags = {r.v: r.v_outlier for r in CL.outliers_iqr(df, "v").collect()}
    assert [v for v, f in flags.items() if f == 1] == [10000.0]
    capped = {round(r.v, 4) for r in CL.cap_outliers(df, "v").collect()}
    assert 198.01 in capped and 1.99 in capped and 10000.0 not in capped


def test_m7_null_value_quartile(spark):
    p = panel(spark, [1, 2, 3, None, 5])
    rows = by_time(FE.value_quartiles(p, SPEC))
    assert rows[3]["Sales_Category"] is None and rows[3]["Sales_Quartile"] is None
    assert rows[0]["Sales_Quartile"] == 1 and rows[4]["Sales_Category"] == "High"


def test_m8_missing_flag_group(spark):
    r = RU.flag_kpi(panel(spark, [1, 2, 3]), SPEC).collect()[0]
    assert r.Flag_Avg is None and r.Flag_Uplift_Pct is None
    assert r.Flag_Revenue_Pct in (None, 0.0)


def test_m9_empty_input(spark):
    p = panel(spark, [1]).limit(0)
    for df in [
        RU.grand_summary(p, SPEC),
        RU.flag_kpi(p, SPEC),
        RU.entity_gap(p, SPEC),
        K.revenue_kpi(p, SPEC),
        QU.panel_coverage(p, SPEC),
        QU.validate_report(p),
        DI.box_summary(p, SPEC),
        exact_quantiles(p, "value", [0.5]),
        CL.cap_outliers(p, "value"),
    ]:
        df.collect()
    assert DI.histogram(p, SPEC).count() == 0
    assert exact_quantiles(p, "value", [0.5]).collect()[0][0] is None


def test_m10_rank_ties(spark):
    a = panel(spark, [5, 5], entity=1)
    b = panel(spark, [10], entity=2)
    c = panel(spark, [10], entity=3)
    d = panel(spark, [1], entity=4)
    df = a.unionByName(b).unionByName(c).unionByName(d)
    perf = {r.entity: r.Sales_Rank for r in RU.entity_performance(df, SPEC).collect()}
    assert perf == {1: 1, 2: 1, 3: 1, 4: 4}
    top = [r.entity for r in RU.top_entities(df, SPEC, 2).collect()]
    assert top == [1, 2]


def test_m11_money_is_exact(spark):
    p = panel(spark, ["1643690.90"])
    assert RU.grand_summary(p, SPEC).collect()[0].total_sales == 1643690.90


def test_m12_seasons(spark):
    df = spark.createDataFrame([(m,) for m in (1, 3, 6, 9, 12)], "m int")
    assert [r.s for r in df.select(season(F.col("m")).alias("s")).collect()] == [
        "Winter", "Spring", "Summer", "Fall", "Winter",
    ]


def test_m13_constant_column(spark):
    p = panel(spark, [7, 7, 7, 7])
    h = DI.histogram(p, SPEC, 50).where("Row_Count > 0").collect()
    assert len(h) == 1 and h[0].Bin == 0 and h[0].Row_Count == 4
    z = CL.outliers_zscore(p, "value", 3.0, SPEC).agg(F.sum("value_outlier")).collect()[0][0]
    assert z == 0


def test_global_rank_matches_window_rank(spark):
    import random

    rnd = random.Random(7)
    rows = [(i, float(rnd.choice([None, *range(40)]) or 0) if i % 11 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, x double")
    from pyspark.sql import Window

    want = {r.id: r.r for r in df.select("id", F.rank().over(Window.orderBy(F.col("x").desc_nulls_last())).alias("r")).collect()}
    got = {r.id: r.r for r in global_rank(df, "x", "r", descending=True, buckets=8).collect()}
    assert got == want
    want_a = {r.id: r.r for r in df.select("id", F.rank().over(Window.orderBy(F.col("x").asc_nulls_first())).alias("r")).collect()}
    got_a = {r.id: r.r for r in global_rank(df, "x", "r", descending=False, buckets=8).collect()}
    assert got_a == want_a


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257])
def test_exact_quantiles_match_percentile(spark, n):
    import random

    rnd = random.Random(n)
    vals = [float(rnd.randint(0, 50)) for _ in range(n)] + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = list(exact_quantiles(df, "x", probs, accuracy=100).collect()[0])
    clean = df.where(~F.isnan("x"))
    want = clean.agg(F.percentile("x", probs)).collect()[0][0]
    assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9) for a, b in zip(got, want))


def test_type_publishing(spark):
    from strata.functions import publish

    p = panel(spark, [1, 2])
    out = publish(RU.rollup_entity(p, SPEC))
    assert {f.dataType.simpleString() for f in out.schema.fields} <= {"bigint", "double", "int"}
    assert isinstance(out.schema["Total_Sales"].dataType, DoubleType)


def test_unknown_parameters_raise(spark):
    p = panel(spark, [1])
    with pytest.raises(ValueError):
        CL.impute(p, "bogus", ["value"])
    with pytest.raises(ValueError):
        CL.handle_outliers(p, "value", "bogus")
    with pytest.raises(ValueError):
        RU.rollup_time(p, SPEC, "Decade")
    with pytest.raises(ValueError):
        K.top_by_metric(p, SPEC, "Bogus")


def test_hot_value_third_of_rows(spark):
    """One value held by a third of the rows: exact answers, and the value is
    one row (with its count) when the ranges are sorted."""
    n = 30000
    df = spark.range(n).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 500.0 ELSE CAST(id % 997 AS DOUBLE) END AS x")
    probs = [0.1, 0.3, 0.5, 0.9]
    got = list(exact_quantiles(df, "x", probs, accuracy=1000).collect()[0])
    want = df.agg(F.percentile("x", probs)).collect()[0][0]
    assert got == want
    from pyspark.sql import Window

    ranked = global_rank(df, "x", "r", descending=True, buckets=16)
    want_r = df.select("id", F.rank().over(Window.orderBy(F.col("x").desc())).alias("w"))
    bad = ranked.join(want_r, "id").where("r != w").count()
    assert bad == 0


# --- odd values ------------------------------------------------------------------


def _double_panel(spark, rows):
    return spark.createDataFrame(rows, "entity long, dt date, value double, flag int, cov_a double, cov_b double, cov_c double, cov_d double")


def test_quantiles_at_every_small_size(spark):
    import numpy as np

    from strata.functions.ranking import exact_quantiles

    probs = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
    for n in (1, 2, 3, 4, 5, 7, 16, 101):
        v = [float((i * 37) % 23) for i in range(n)]
        got = exact_quantiles(spark.createDataFrame([(x,) for x in v], "v double"), "v", probs).first()
        assert list(got) == pytest.approx(list(np.quantile(v, probs)))


def test_quantiles_beyond_the_default_accuracy(spark):
    from strata.functions.ranking import quantile_targets

    df = spark.range(60_000).selectExpr("CAST(id * 7919 % 60000 AS DOUBLE) AS a", "CASE WHEN id % 3 = 0 THEN 5.0D ELSE id * 0.5D END AS b", "IF(id = 7, double('inf'), 1.0D) AS c")
    got = quantile_targets(df, [(c, p, f"{c}{p}") for c in "abc" for p in (0.01, 0.5, 0.99, 1.0)]).first()
    want = df.selectExpr(*[f"percentile({c}, {p}D)" for c in "abc" for p in (0.01, 0.5, 0.99, 1.0)]).first()
    assert list(got) == pytest.approx(list(want))


def test_correlation_uses_complete_pairs(spark):
    from strata.functions.numeric import safe_corr

    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (None, 1000.0), (500.0, None)], "x double, y double")
    assert df.agg(safe_corr(F.col("x"), F.col("y"))).first()[0] == pytest.approx(1.0)


def test_rolling_doubles_do_not_cancel(spark):
    import datetime as dt

    from strata.operators.features import rolling_metrics, split_window_features
    from strata.spec import PanelSpec

    spec = PanelSpec(value_scale=None)
    v = [1e17, 1.0, 1.0, float("inf"), 1.0, 1.0, None, float("nan"), 2.0]
    df = _double_panel(spark, [(1, dt.date(2020, 1, 6) + dt.timedelta(weeks=i), x, 0, 0.0, 0.0, 0.0, 0.0) for i, x in enumerate(v)])
    want = [1e17, 1e17 + 1, 2.0, float("inf"), float("inf"), 2.0, 1.0, None, 2.0]
    for out in (rolling_metrics(df, spec, (2,)), split_window_features(df, spec, (2,), (1,), F.month("dt"))):
        assert [r["Rolling_Sum_2W"] for r in out.orderBy("dt").collect()] == want


def test_split_plan_keeps_null_entities_and_times(spark):
    import datetime as dt

    from strata.operators.series import moving_averages
    from strata.spec import PanelSpec

    days = [dt.date(2020, 1, 6), dt.date(2020, 1, 13), dt.date(2021, 1, 4), None]
    rows = [(e, d, float(i), 0, 0.0, 0.0, 0.0, 0.0) for i, (e, d) in enumerate((e, d) for e in (1, None) for d in days)]
    df = _double_panel(spark, rows)
    for spec in (PanelSpec(), PanelSpec(value_scale=None)):
        plain = sorted(map(str, moving_averages(df, spec, (2,)).collect()))
        assert len(plain) == 8 and plain == sorted(map(str, moving_averages(df, spec, (2,), split_block=F.year("dt")).collect()))


def test_a_measure_out_of_range_fails_and_nan_is_missing(spark):
    import datetime as dt

    from strata.operators.clean import cap_outliers, detect_outliers, impute
    from strata.operators.rollup import grand_summary
    from strata.sources.panel import weekly_panel

    day = dt.date(2020, 1, 6)
    with pytest.raises(Exception, match="OUT_OF_RANGE|OVERFLOW"):
        grand_summary(_double_panel(spark, [(1, day, 5e16, 0, 0.0, 0.0, 0.0, 0.0), (2, day, 1.0, 0, 0.0, 0.0, 0.0, 0.0)])).collect()
    nan = _double_panel(spark, [(i, day, float("nan") if i == 0 else float(i), 0, 0.0, 0.0, 0.0, 0.0) for i in range(9)])
    assert grand_summary(nan).first()["total_sales"] == 36.0
    assert cap_outliers(nan, "value").where("entity = 0").first()["value"] is None
    assert {r["value_outlier"] for m in ("iqr", "zscore") for r in detect_outliers(nan, "value", m).collect()} == {0}
    assert impute(nan.withColumn("entity", F.when(F.col("entity") > 1, F.col("entity"))), "mean").where("entity IS NULL").count() == 2
    items = spark.createDataFrame([(1, day, float("nan"), 1.0, 0.1, 0.1), (1, day, 2.5, 1.0, 0.1, 0.1)], "l_suppkey long, l_shipdate date, l_extendedprice double, l_quantity double, l_discount double, l_tax double")
    assert float(weekly_panel(items).first()["value"]) == 2.5


def test_queries_see_files_added_later(spark, tmp_path):
    from strata.plans.registry import panel

    from .conftest import SF_SMALL

    items = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    half = f"file:{tmp_path}/lineitem.parquet"
    items.where("l_orderkey % 2 = 0").write.parquet(half)
    first = panel(spark, f"file:{tmp_path}").count()
    items.where("l_orderkey % 2 = 1").write.mode("append").parquet(half)
    assert first < panel(spark, f"file:{tmp_path}").count() == panel(spark, SF_SMALL).count()


def test_ambiguous_and_month_first_dates(spark):
    from strata.functions.dates import parse_date

    df = spark.createDataFrame([("12-25-2010",), ("05-02-2010",), ("13/02/2010",)], "d string")
    assert [str(r[0]) for r in df.select(parse_date("d")).collect()] == ["2010-12-25", "2010-02-05", "2010-02-13"]


def test_split_plans_of_single_operators(spark):
    from strata.operators.series import trend_signal
    from strata.plans.registry import panel

    from .conftest import SF_SMALL

    p, block = panel(spark, SF_SMALL).where("entity <= 3"), F.year("dt")
    for run in (FE.rolling_metrics, FE.lag_features, FE.growth_rates, trend_signal):
        plain, split = run(p), run(p, split_block=block)
        assert plain.columns == split.columns
        assert plain.exceptAll(split).count() == 0 and plain.count() == split.count()


def _panel(spark, rows, schema="entity long, dt string, value double, flag int"):
    return spark.createDataFrame(rows, schema).withColumn("dt", F.to_date("dt")).withColumn("value", F.col("value").cast("decimal(18,2)"))


def test_previous_periods_are_those_of_the_calendar(spark):
    """A period without rows gives null, not the period before it; rows without a time have none."""
    from strata.operators import kpi, rollup, series

    spec = SPEC.with_(covariates=())
    df = _panel(spark, [(1, "2019-01-07", 10.0, 0), (1, "2019-03-04", 20.0, 0), (1, "2021-01-04", 40.0, 0), (1, "2022-01-03", 60.0, 1), (2, "2021-12-27", 5.0, 0), (1, None, 7.0, 0)])
    years = {r.Year: (r.Prev_Year_Sales, r.YoY_Growth_Pct) for r in rollup.yearly_trend(df, spec).collect()}
    assert years == {None: (None, None), 2019: (None, None), 2021: (None, None), 2022: (45.0, 33.33)}
    months = {(r.Year, r.Month): r.Prev_Month_Sales for r in kpi.mom_growth(df, spec).collect()}
    assert months == {(None, None): None, (2019, 1): None, (2019, 3): None, (2021, 1): None, (2021, 12): None, (2022, 1): 5.0}
    yoy = {(r.Year, r.Month): (r.Prev_Year_Sales, r.YoY_Change) for r in series.yoy_month(df, spec).collect()}
    assert yoy[2022, 1] == (40.0, 20.0) and yoy[2021, 1] == (None, None) and yoy[None, None] == (None, None)
    assert [tuple(r) for r in kpi.mom_growth_avg(df, spec).collect()] == [(1100.0, 1)]


def test_the_whole_column_decides_how_a_date_is_read(spark):
    from strata.operators.clean import parse_dates

    def read(*texts, formats=None):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, d string")
        return [str(r.d) if r.d else None for r in parse_dates(df, "d", formats=formats, parts=False).orderBy("i").collect()]

    assert read("12/25/2010", "05/02/2010", "02/13/2010") == ["2010-12-25", "2010-05-02", "2010-02-13"]
    assert read("25/12/2010", "05/02/2010", "13/02/2010") == ["2010-12-25", "2010-02-05", "2010-02-13"]
    assert read("12-25-2010", "05-02-2010") == ["2010-12-25", "2010-05-02"]
    assert read("05/02/2010", "06/02/2010") == ["2010-02-05", "2010-02-06"]  # nothing decides: day first
    # the larger part of the column decides; each separator for itself
    assert read("25/12/2010", "12/25/2010", "12/26/2010", "05/02/2010") == ["2010-12-25", "2010-12-25", "2010-12-26", "2010-05-02"]
    assert read("12/25/2010", "05-02-2010", "2010-07-01", "5/2/2010", "x", None, "") == ["2010-12-25", "2010-02-05", "2010-07-01", "2010-05-02", None, None, None]
    assert read("12/25/2010", "05/02/2010", formats="dd/MM/yyyy") == [None, "2010-02-05"]
    assert read("12/25/2010", "05/02/2010", formats=["dd/MM/yyyy", "MM/dd/yyyy"]) == ["2010-12-25", "2010-05-02"]
    assert read("03/03/2010", formats=["dd/MM/yyyy", "MM/dd/yyyy"]) == ["2010-03-03"]
    empty = spark.createDataFrame([], "d string, Year string")
    assert parse_dates(empty, "d", out="t").collect() == []


def test_rows_without_a_flag_have_no_label(spark):
    from strata.operators.rollup import flag_impact

    df = _panel(spark, [(1, "2020-01-06", 1.0, 1), (1, "2020-01-13", 2.0, 0), (1, "2020-01-20", 4.0, None)])
    assert {r.flag: r.Period_Type for r in flag_impact(df, SPEC).collect()} == {1: "Holiday", 0: "Non-Holiday", None: None}


def test_averages_of_too_few_rows(spark):
    from strata.operators.series import moving_averages

    values = [1.0, None, 3.0, 5.0, 7.0]
    df = _panel(spark, [(1, f"2020-01-{6 + 7 * i if i < 4 else 31}", v, 0) for i, v in enumerate(values)])
    for block in (None, F.weekofyear("dt")):
        for least, want in ((1, [1.0, 1.0, 2.0, 4.0, 5.0]), (2, [None, None, 2.0, 4.0, 5.0]), (3, [None, None, None, None, 5.0])):
            got = moving_averages(df, SPEC, (3,), block, least).orderBy("dt").collect()
            assert [r.MA_3W for r in got] == want, (least, block)


def test_split_plans_for_last_rows_and_running_totals(spark):
    from strata.operators import features, series
    from strata.plans.registry import panel

    from .conftest import SF_SMALL

    p = panel(spark, SF_SMALL).where("entity <= 2").cache()
    p = p.unionByName(p.limit(3).withColumn("entity", F.lit(None).cast("long"))).unionByName(p.limit(1).withColumn("dt", F.lit(None).cast("date")).withColumn("entity", F.lit(99).cast("long")))
    for block in (F.floor(F.datediff("dt", F.lit("1990-01-01")) / 28),):  # block edges every four weeks
        for plain, split in [
            (series.last_rows(p, SPEC, 5), series.last_rows(p, SPEC, 5, block)),
            (series.forecast_baseline(p, SPEC), series.forecast_baseline(p, SPEC, split_block=block)),
            (series.forecast_horizon(p, SPEC), series.forecast_horizon(p, SPEC, split_block=block)),
            (series.trend_strength(p, SPEC), series.trend_strength(p, SPEC, split_block=block)),
            (series.trend_counts(p, SPEC), series.trend_counts(p, SPEC, split_block=block)),
            (features.cumulative_metrics(p, SPEC, per_year=False), features.cumulative_metrics(p, SPEC, per_year=False, split_block=block)),
        ]:
            assert plain.columns == split.columns
            assert plain.exceptAll(split).count() == 0 and plain.count() == split.count()


def test_calendar_groupings_equal_each_by_itself(spark):
    from strata.operators import rollup
    from strata.plans.registry import panel

    from .conftest import SF_SMALL

    p = panel(spark, SF_SMALL)
    p = p.unionByName(p.limit(2).withColumn("dt", F.lit(None).cast("date")))
    whole = rollup.rollup_calendar(p, SPEC)
    for period, keys in rollup.PERIOD_KEYS.items():
        one = rollup.rollup_time(p, SPEC, period, avg_name="Avg_Sales")
        got = whole.where(F.col("Period") == period).select(*one.columns)
        assert got.exceptAll(one).count() == 0 and got.count() == one.count() > 0
    assert {r.Period for r in whole.collect()} == set(rollup.CALENDAR_SETS)
    some = rollup.rollup_calendar(p, SPEC, ["Year"])
    assert some.count() == whole.where("Period = 'Year'").count()
    with pytest.raises(ValueError):
        rollup.rollup_calendar(p, SPEC, ["Week"])


def test_dashboards_as_tables(spark):
    from strata.operators import distribution, kpi
    from strata.plans.registry import panel

    from .conftest import SF_SMALL

    p = panel(spark, SF_SMALL)
    for table, parts in ((kpi.dashboard_table(p, SPEC), kpi.kpi_dashboard(p, SPEC)), (distribution.chart_table(p, SPEC), distribution.chart_data(p, SPEC))):
        assert table.columns == ["Section", "Row_Key", "Metric", "Value"]
        rows = table.collect()
        assert {r.Section for r in rows} == set(parts)
        assert len({(r.Section, r.Row_Key, r.Metric) for r in rows}) == len(rows)
    total = [r.Value for r in kpi.dashboard_table(p, SPEC).where("Metric = 'Total_Revenue'").collect()]
    assert total == [r.Total_Revenue for r in kpi.revenue_kpi(p, SPEC).collect()]


def test_sketches_of_periods_merge(spark, tmp_path):
    """Written once, months answer for any range; later months are appended; a hot entity changes nothing."""
    from strata.operators import sketches as SK

    df = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7L ELSE id % 5000 END AS entity", "date_add(DATE'2020-01-01', CAST(id % 400 AS INT)) AS dt",
        "CASE WHEN id % 11 > 0 THEN CAST((id * 7919 % 60000) / 100 AS DECIMAL(18,2)) END AS value",
    )
    path = str(tmp_path / "kept")
    SK.period_sketches(df.where("dt < '2020-07-01'"), SPEC, "month").write.parquet(path)
    SK.period_sketches(df.where("dt >= '2020-07-01'"), SPEC, "month").write.mode("append").parquet(path)
    kept = spark.read.parquet(path)
    assert kept.count() == 14
    for rows, part in ((df, kept), (df.where("dt < '2020-04-01'"), kept.where("Period < '2020-04-01'"))):
        got = SK.sketch_summary(part, probs=(0.1, 0.5, 0.9)).first()
        n, total, entities = rows.agg(F.count("*"), F.sum("value"), F.count_distinct("entity")).first()
        assert got.Rows == n and got.Total == float(total)
        assert abs(got.Entities - entities) <= 0.03 * entities
        for p in (0.1, 0.5, 0.9):
            share = rows.where("value IS NOT NULL").agg(F.avg((F.col("value") <= F.lit(got[f"Q{p * 100:g}"])).cast("double"))).first()[0]
            assert abs(share - p) <= 2 * SK.KLL_ERROR
        below = SK.share_below(part, 300.0).first().Share
        assert abs(below - rows.where("value IS NOT NULL").agg(F.avg((F.col("value") <= 300).cast("double"))).first()[0]) <= 2 * SK.KLL_ERROR
    by_year = SK.sketch_summary(kept, [F.year("Period").alias("Year")]).collect()
    assert {r.Year: r.Rows for r in by_year} == {r.y: r.n for r in df.groupBy(F.year("dt").alias("y")).agg(F.count("*").alias("n")).collect()}
    none = SK.period_sketches(df.where("false"), SPEC)
    assert none.count() == 0 and SK.sketch_summary(none).first().Q50 is None
    blank = SK.period_sketches(df.where("value IS NULL").withColumn("dt", F.lit(None).cast("date")), SPEC, by=["entity"])
    first = SK.sketch_summary(blank).first()
    assert first.Q50 is None and first.Avg is None and blank.where("Period IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        SK.period_sketches(df, SPEC, "hour")


def test_narrowed_brackets_keep_quantiles_exact(spark):
    """Uniform, skewed, tied, tiny and infinite columns, any number of passes."""
    from strata.functions.ranking import quantile_targets

    probs = (0.0, 0.25, 0.77, 0.999, 1.0)
    columns = {"steep": "pow(1.01D, id % 2000) * id", "tied": "CASE WHEN id % 3 = 0 THEN 5D ELSE id END", "two": "id % 2 * 1e300D - 5e299", "holes": "CASE WHEN id % 5 = 0 THEN NULL WHEN id % 7 = 0 THEN double('NaN') ELSE 1 / (id + 1.0D) END"}
    for n, narrow in ((0, 1), (1, 1), (17, 1), (5000, 2)):
        df = spark.range(n).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])
        want = {c: [r for r in df.selectExpr(f"percentile(nanvl({c}, CAST(NULL AS DOUBLE)), array{probs}) AS p".replace("(0.0,", "(0.0D,")).first().p or [None] * len(probs)] for c in columns}
        got = quantile_targets(df, [(c, p, f"{c}{i}") for c in columns for i, p in enumerate(probs)], accuracy=100, narrow=narrow).first()
        for c in columns:
            for i, w in enumerate(want[c]):
                g = got[f"{c}{i}"]
                assert g == w or g is not None and w is not None and math.isclose(g, w, rel_tol=1e-12, abs_tol=1e288 if c == "two" else 0), (c, n, narrow, probs[i], g, w)


def test_narrowing_bounds_what_one_task_orders(spark, monkeypatch):
    """A pass leaves about a 1024th of a bracket's values to be grouped and ordered, for one more scan."""
    from strata.functions import ranking

    seen = []
    monkeypatch.setattr(ranking, "_narrowed", lambda vals, br, at, f=ranking._narrowed: seen.append((br, f(vals, br, at))) or seen[-1][1])
    df = spark.range(200_000).selectExpr("CAST(id * 7919 % 200003 AS DOUBLE) AS x")
    plain, q = (ranking.quantile_targets(df, [("x", 0.5, "m")], accuracy=50, narrow=n) for n in (0, 1))
    assert [d._jdf.queryExecution().optimizedPlan().toString().count("Range (") for d in (plain, q)] == [2, 3]
    held = []
    for br in seen[0]:
        lo, hi = br.select("_lo0", "_hi0").first()
        held.append(df.where(F.col("x").between(lo, hi)).count())
    assert held[0] > 5000 and held[1] < 50
    assert q.first().m == plain.first().m


def test_approximate_quantiles_are_passed_on(spark):
    p = panel(spark, [float(i) for i in range(1, 202)])
    for run in (
        lambda e: CL.detect_outliers(p, "value", exact=e), lambda e: CL.handle_outliers(p, "value", "cap", exact=e),
        lambda e: CL.handle_outliers(p, "value", "remove", exact=e), lambda e: FE.value_quartiles(p, SPEC, exact=e), lambda e: DI.box_summary(p, SPEC, exact=e),
    ):
        texts = [run(e)._jdf.queryExecution().optimizedPlan().toString() for e in (True, False)]
        assert "bracket missed" in texts[0] and "bracket missed" not in texts[1]
        assert run(False).count() > 0


def test_patterns_are_tried_on_texts_of_their_shape_and_lose_none(spark):
    import itertools

    from strata.functions.dates import DATE_FORMATS, _read, _shape, date_votes

    days, years = ("1", "01", "001", "12", "13", "0", "00", "31", "32", "+5", "-5", "x", ""), ("2010", "0000", "+12345", "12345", "-2010", "201", "", "2010 ", "2010x", "99999999")
    texts = {sep.join(p) for sep in "-/. " for a in days for b in days for y in years for p in ((a, b, y), (y, a, b))}
    texts |= {"20100102", "2010-01-02T00", " 2010-01-02 ", "\t2010-01-02", "１２/１２/2010", "12/12/2010\n", "02 Jan 2010", "Jan"}
    df = spark.createDataFrame([(t,) for t in texts], "d string").select(F.trim("d").alias("d"))
    formats = [*DATE_FORMATS, "yyyyMMdd", "yyyy.M.d", "d M yyyy", "dd MMM yyyy", "yyyy-MM-dd'T'HH"]
    assert [f for f in formats if _shape(f) is None] == formats[-2:]
    lost = df.select("d", *[(~_read(F.col("d"), f).eqNullSafe(F.try_to_date("d", f))).alias(f"x{i}") for i, f in enumerate(formats)])
    assert lost.where(F.greatest(*[F.col(f"x{i}") for i in range(len(formats))])).collect() == []
    # a text is read once for each pattern, whatever is asked of its dates
    plan = date_votes(df, "d")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(") == len(DATE_FORMATS) == plan.lower().count("rlike(")


def test_columns_are_parsed_with_votes_of_one_pass(spark):
    from strata.functions.dates import date_votes
    from strata.operators.clean import parse_dates
    from strata.plans import QUERIES

    rows = [("12/25/2010", "25/12/2010", "2010-12-25"), ("05/02/2010", "05/02/2010", "2010-05-02"), (None, "", "x")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    out, votes = df, date_votes(df, ["a", "b", "c"])
    for c in "abc":
        out = parse_dates(out, c, parts=False, votes=votes)
    got = {tuple(None if x is None else str(x) for x in r) for r in out.collect()}
    assert got == {("2010-12-25", "2010-12-25", "2010-12-25"), ("2010-05-02", "2010-02-05", "2010-05-02"), (None, None, None)}
    from .conftest import SF_SMALL

    # one scan for the rows, and one plan of the votes for each column that takes them (all the same, so run once)
    plan = QUERIES["parse_dates_month_first"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 7


def test_split_rows_look_back_over_tiles(spark, monkeypatch):
    import datetime as dt

    from strata.operators import features
    from strata.spec import PanelSpec

    monkeypatch.setattr(features, "TILE_ROWS", 3)
    rows = [(e, dt.date(2020, 1, 6) + dt.timedelta(weeks=i), float(i * i) if i % 4 else None, 0, 0.0, 0.0, 0.0, 0.0) for e in (1, None) for i in range(23)]
    df = _double_panel(spark, rows)
    for spec in (PanelSpec(), PanelSpec(value_scale=None)):
        for windows, lags in (((2,), (1, 2)), ((4, 2), (7, -2, 0)), ((), (-3,)), ((1,), ())):
            want = df.withColumns(features.rolling_columns(spec, windows) | features.lag_columns(spec, lags))
            got = features.split_window_features(df, spec, windows, lags, F.month("dt")).select(*want.columns)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # a row goes to its own tile and, near an edge, to the next: not once for every k
    monkeypatch.setattr(features, "TILE_ROWS", 10)
    plan = features.split_window_features(df, PanelSpec(), (4, 8), (1, 9), F.month("dt"))._jdf.queryExecution().optimizedPlan().toString()
    assert "first(" not in plan and plan.count("_tile") > 0


def test_cleaning_reads_a_date_once_for_the_votes_and_once_for_its_row(spark):
    from strata.functions.dates import DATE_FORMATS
    from strata.plans import QUERIES

    from .conftest import SF_SMALL

    plan = QUERIES["clean_panel"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(") == 2 * len(DATE_FORMATS) == plan.lower().count("rlike(")


def test_cleaned_rows_are_equal_by_the_columns_that_stay(spark):
    from strata.operators.clean import clean_panel

    rows = [(1, "2020-01-06", 1.0, 0), (1, "06-01-2020", 1.0, 0), (1, "2020-01-06", 1.0, 0), (1, None, 1.0, 0), (1, "x", 1.0, 0)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "entity long, raw string, value double, flag int, dt int")
    spec = SPEC.with_(covariates=())
    plain = df.drop("dt")
    assert clean_panel(plain, spec, "raw", "dt").count() == 4  # texts stay apart
    assert clean_panel(plain, spec, "raw").count() == 2  # dates take the place of the texts
    assert clean_panel(df, spec, "raw", "dt").count() == 4
    other = df.withColumn("dt", F.monotonically_increasing_id())  # replaced by the dates: no part of what is equal
    assert clean_panel(other, spec, "raw", "dt").count() == 4
