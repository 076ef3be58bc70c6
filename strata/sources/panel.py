"""Panels derived from the driver's tables.

``weekly_panel``: one row per (supplier, ISO week) from ``lineitem`` — the
clean panel. ``dirty_panel``: the same rows with nulls, three date formats and
exact duplicates, for the cleaning operators. ``daily_orders``: a daily panel
from ``orders`` for the day-of-week and weekend operators (weekly rows all fall
on Mondays)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions.dates import week_start
from ..functions.numeric import cents, from_cents
from ..spec import PanelSpec

# ISO weeks marked as flagged periods in the fixture panel.
FLAG_WEEKS: tuple[int, ...] = (6, 36, 47, 52)

PANEL = PanelSpec()
DIRTY = PanelSpec(value_scale=None)


def weekly_panel(lineitem: DataFrame) -> DataFrame:
    """entity bigint, dt date, value decimal(18,2), flag int, cov_a..cov_d double.

    One hash aggregate keyed by (supplier, week): map-side partial sums mean a
    supplier holding a large share of lineitem still sends one row per week
    and task to the shuffle. Money is summed as exact integer cents (long
    arithmetic, equal to summing DECIMAL(18,2) values)."""
    g = (
        lineitem.select(
            F.col("l_suppkey").alias("entity"),
            week_start("l_shipdate").alias("dt"),
            cents("l_extendedprice").alias("_p"),
            cents("l_quantity").alias("_q"),
            cents("l_discount").alias("_d"),
            cents("l_tax").alias("_t"),
        )
        .groupBy("entity", "dt")
        .agg(
            F.sum("_p").alias("_sp"),
            F.sum("_q").alias("_sq"),
            F.sum("_d").alias("_sd"),
            F.sum("_t").alias("_st"),
            F.count(F.lit(1)).alias("_n"),
        )
    )

    def mean(c: str):
        return F.expr(f"CAST(CAST(`{c}` AS DECIMAL(38,0)) / 100 AS DOUBLE) / `_n`")

    return g.select(
        "entity",
        "dt",
        from_cents("_sp").alias("value"),
        F.expr(f"CASE WHEN weekofyear(dt) IN ({', '.join(map(str, FLAG_WEEKS))}) THEN 1 ELSE 0 END").alias("flag"),
        mean("_sq").alias("cov_a"),
        mean("_sd").alias("cov_b"),
        mean("_st").alias("cov_c"),
        F.expr("CAST(`_n` AS DOUBLE)").alias("cov_d"),
    )


def gappy_panel(panel: DataFrame) -> DataFrame:
    """The panel of a business that was closed for the year 1994 and for March
    and April 1996: these periods have no rows."""
    year = F.year("dt")
    closed = (year == 1994) | ((year == 1996) & F.month("dt").isin(3, 4))
    return panel.where(~closed)


def dirty_panel(panel: DataFrame) -> DataFrame:
    """Deterministic damage: the date as text in one of three formats by year,
    value null when (entity + week) % 13 = 0, cov_a null when
    (entity * week) % 29 = 0, and every June row of entities divisible by 10
    repeated once."""
    wk = F.weekofyear("dt")
    y3 = F.year("dt") % 3
    # one scan: a row to be repeated comes as two copies of itself
    copies = F.when((F.col("entity") % 10 == 0) & (F.month("dt") == 6), 2).otherwise(1)
    return panel.select(
        "entity",
        F.when(y3 == 0, F.date_format("dt", "dd-MM-yyyy"))
        .when(y3 == 1, F.date_format("dt", "yyyy-MM-dd"))
        .otherwise(F.date_format("dt", "dd/MM/yyyy"))
        .alias("dt_raw"),
        F.when((F.col("entity") + wk) % 13 == 0, F.lit(None)).otherwise(F.col("value").cast("double")).alias("value"),
        "flag",
        F.when((F.col("entity") * wk) % 29 == 0, F.lit(None)).otherwise(F.col("cov_a")).alias("cov_a"),
        "cov_b",
        "cov_c",
        "cov_d",
        F.explode(F.sequence(F.lit(1), copies)).alias("_copy"),
    ).drop("_copy")


def daily_orders(orders: DataFrame) -> DataFrame:
    """A daily panel: one row per (customer, order date) with summed order value."""
    return (
        orders.select(
            F.col("o_custkey").alias("entity"),
            F.to_date("o_orderdate").alias("dt"),
            cents("o_totalprice").alias("_v"),
        )
        .groupBy("entity", "dt")
        .agg(F.sum("_v").alias("_sv"))
        .select("entity", "dt", from_cents("_sv").alias("value"))
    )
