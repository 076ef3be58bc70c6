"""Plan checks: operators run no Spark action while being built; window
features share one shuffle by entity; scans are pruned."""

import pytest

import __spark_entry__ as E
from strata.operators import clean as CL
from strata.operators import distribution as DI
from strata.operators import features as FE
from strata.operators import kpi as K
from strata.operators import quality as QU
from strata.operators import rollup as RU
from strata.operators import series as TS
from strata.sources import dirty_panel, read_table, weekly_panel
from strata.spec import DEFAULT as SPEC

from .conftest import SF_SMALL


def _jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None) or [])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def inputs(spark):
    li = read_table(spark, SF_SMALL, "lineitem")
    p = weekly_panel(li)
    return p, dirty_panel(p)


def test_building_operators_runs_no_action(spark, inputs):
    p, d = inputs
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    built = [
        FE.feature_set(p, SPEC),
        RU.entity_performance(p, SPEC),
        RU.season_kpi(p, SPEC),
        RU.yearly_trend(p, SPEC),
        K.entity_kpi(p, SPEC),
        K.mom_growth_avg(p, SPEC),
        TS.forecast_horizon(p, SPEC),
        TS.yoy_month(p, SPEC),
        TS.trend_strength(p, SPEC),
        CL.clean_panel(d, SPEC, "dt_raw", "dt"),
        CL.impute(d, "median", ["value", "cov_a"], SPEC),
        CL.impute(d, "mode", ["value"], SPEC),
        QU.validate_report(d),
        QU.null_profile(d),
        DI.box_summary(p, SPEC),
        DI.histogram(p, SPEC),
        DI.correlation_matrix(p, SPEC),
        DI.entity_volatility(p, SPEC),
    ]
    assert all(b is not None for b in built)
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_window_features_share_one_exchange(spark, inputs):
    p, _ = inputs
    cols = {}
    for c in (FE.rolling_columns(SPEC), FE.lag_columns(SPEC), FE.growth_columns(SPEC), FE.cumulative_columns(SPEC)):
        cols.update(c)
    plan = _plan(p.withColumns(cols))
    # one Exchange builds the panel (by entity, week), one feeds every window
    assert plan.count("Exchange hashpartitioning") == 2
    assert "SinglePartition" not in plan


def test_scan_is_pruned(spark):
    li = read_table(spark, SF_SMALL, "lineitem")
    plan = _plan(RU.grand_summary(weekly_panel(li), SPEC))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "l_orderkey" not in scan and "l_returnflag" not in scan


def test_entity_rank_is_not_single_partition(spark, inputs):
    p, _ = inputs
    plan = _plan(RU.entity_performance(p, SPEC))
    # the only single-partition steps are over bounded rows (bucket offsets, scalars)
    assert "Window [rank(" not in plan


def test_filter_reaches_scan(spark):
    from pyspark.sql import functions as F

    li = read_table(spark, SF_SMALL, "lineitem").where(F.col("l_suppkey") == 3)
    plan = _plan(weekly_panel(li))
    assert "PushedFilters: [IsNotNull(l_suppkey), EqualTo(l_suppkey,3)]" in plan


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 35


def test_split_window_features_equal_default(spark, inputs):
    from pyspark.sql import functions as F

    p, _ = inputs
    a = FE.feature_set(p, SPEC)
    b = FE.feature_set(p, SPEC, split_block=F.year("dt"))
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # fine blocks: a block boundary every 4 weeks, lags of 52 rows cross many
    c = FE.split_window_features(p, SPEC, block=F.floor(F.datediff("dt", F.lit("1990-01-01")) / 28))
    cols = {}
    cols.update(FE.rolling_columns(SPEC))
    cols.update(FE.lag_columns(SPEC))
    d = p.withColumns(cols)
    c = c.select(*d.columns)
    assert c.exceptAll(d).count() == 0 and d.exceptAll(c).count() == 0


def test_split_window_features_spread_one_entity(spark):
    """One entity holding every row: the large shuffles are keyed by
    (entity, block) and (entity, row), never by the entity alone."""
    from pyspark.sql import functions as F

    df = spark.range(3000).selectExpr(
        "7L AS entity", "date_add(DATE'2000-01-03', CAST(id AS INT) * 7) AS dt",
        "CAST(id % 113 AS DECIMAL(18,2)) AS value", "0 AS flag",
    )
    spec = SPEC.with_(covariates=())
    out = FE.split_window_features(df, spec, block=F.year("dt"))
    plan = _plan(out)
    big = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(entity" in ln and "_blk" not in ln and "_t" not in ln]
    assert len(big) <= 1  # at most the per-block offsets table (one row per block)
    cols = {}
    cols.update(FE.rolling_columns(spec))
    cols.update(FE.lag_columns(spec))
    ref = df.withColumns(cols)
    assert out.select(*ref.columns).exceptAll(ref).count() == 0


def test_exact_quantiles_read_input_at_most_three_times(spark, inputs):
    from strata.functions import exact_quantiles

    p, _ = inputs
    q = exact_quantiles(p, "value", [0.01, 0.25, 0.5, 0.75, 0.99])
    q.collect()
    assert _plan(q).count("FileScan parquet") <= 3


def test_series_split_block_equal_default(spark, inputs):
    from pyspark.sql import functions as F

    from strata.operators import series as TS

    p, _ = inputs
    blk = F.floor(F.datediff("dt", F.lit("1990-01-01")) / 28)
    for a, b in [
        (TS.moving_averages(p, SPEC), TS.moving_averages(p, SPEC, split_block=blk)),
        (TS.velocity(p, SPEC), TS.velocity(p, SPEC, split_block=blk)),
        (TS.momentum(p, SPEC, 4), TS.momentum(p, SPEC, 4, split_block=blk)),
    ]:
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dashboards_are_lazy_and_run(spark, inputs):
    """K13 and V10: dicts of lazy DataFrames over one input; building runs no
    job, and every entry evaluates."""
    from strata.operators.distribution import chart_data

    p, _ = inputs
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    kpis = K.kpi_dashboard(p, SPEC)
    charts = chart_data(p, SPEC)
    assert set(tracker.getJobIdsForGroup(None)) == before
    assert set(kpis) == {"revenue", "revenue_by_year", "growth", "store_performance", "holiday_impact", "seasonal", "efficiency"}
    assert set(charts) == {"series", "top_entities", "bottom_entities", "seasons", "months", "flag_impact", "histogram", "box", "correlation", "years"}
    for df in [*kpis.values(), *charts.values()]:
        assert df.count() > 0


@pytest.mark.parametrize("key, scans", [("impute_median", 3), ("impute_mode", 3), ("label_counts", 3), ("clean_panel", 7)])
def test_columns_share_their_passes(spark, key, scans):
    from strata.plans import QUERIES

    plan = QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= scans


def test_calendar_groupings_take_one_scan_and_one_shuffle(spark, inputs):
    p, _ = inputs
    plan = RU.rollup_calendar(p, SPEC)
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    text = _plan(plan)
    assert text.count("Expand [") == 1 and text.count("Exchange hashpartitioning(Year") == 1
    assert text.count("Exchange") == 2  # the other one builds the panel


def test_split_plans_never_hold_a_whole_entity(spark):
    """One entity with every row: shuffles by the entity alone carry its blocks' totals or last rows, not its rows."""
    from pyspark.sql import functions as F

    df = spark.range(4000).selectExpr(
        "id DIV 1000000 + 7 AS entity", "date_add(DATE'1950-01-02', CAST(id AS INT) * 7) AS dt",
        "CAST(id % 113 AS DECIMAL(18,2)) AS value", "0 AS flag",
    )
    spec = SPEC.with_(covariates=())
    last = TS.last_rows(df, spec, 3, F.year("dt"))
    text = _plan(last)
    # the first stage deals by (entity, block) and keeps three rows of each before the second deals by entity
    assert "hashpartitioning(entity" in text and "_blk" in text.split("hashpartitioning(entity")[-1][:40]
    assert text.count("WindowGroupLimit") >= 2
    assert last.count() == 3
    run = FE.cumulative_metrics(df, spec, per_year=False, split_block=F.year("dt"))
    windows = [ln for ln in _plan(run).splitlines() if "Window [" in ln and "_blk" not in ln]
    assert not windows
