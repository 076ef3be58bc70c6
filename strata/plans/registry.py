"""Registered queries: each key is one operator of the inventory run over the
driver's tables (whole tables, no row caps), with its independent SQL oracle.

A query is ``fn(spark, sf_dir) -> DataFrame``; the SQL string runs in DuckDB
over views named after the parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import publish
from ..sources import DIRTY, PANEL, daily_orders, dirty_panel, gappy_panel, read_table, weekly_panel
from . import sql as S

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def panel(spark: SparkSession, sf: str) -> DataFrame:
    return weekly_panel(read_table(spark, sf, "lineitem"))


def gappy(spark: SparkSession, sf: str) -> DataFrame:
    """The panel with periods that have no rows."""
    return gappy_panel(panel(spark, sf))


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    return dirty_panel(panel(spark, sf))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily_orders(read_table(spark, sf, "orders"))


__all__ = ["QUERIES", "ORACLE", "register", "panel", "gappy", "dirty", "daily", "publish", "F", "S", "PANEL", "DIRTY"]
