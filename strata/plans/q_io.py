"""Queries for sources and sinks (S2-S9): write the panel, read it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.features import rolling_metrics
from ..operators.quality import preview
from ..session import shared_dir
from ..sources import load_csv, load_csv_checked, save, save_bucketed
from ..sources.tables import load_weekly_sales
from ..spec import PanelSpec
from . import sql as S
from .registry import panel, publish, register

_PANEL_OUT = (
    S.with_(S.PANEL)
    + "SELECT entity, dt, CAST(value AS DOUBLE) AS value, flag, cov_a, cov_b, cov_c, cov_d FROM panel"
)


def _target(spark, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("csv_roundtrip", _PANEL_OUT)
def csv_roundtrip(spark, sf):
    """Write the panel as CSV with a header, read it back with the explicit
    schema (no inference pass)."""
    p = panel(spark, sf)
    path = _target(spark, "csv")
    save(p, path, format="csv", mode="overwrite")
    return publish(load_csv(spark, path, schema=p.schema, header=True))


@register("partitioned_roundtrip", _PANEL_OUT)
def partitioned_roundtrip(spark, sf):
    """Write the panel as parquet partitioned by flag, read it back; the
    partition column returns from the directory names."""
    p = panel(spark, sf)
    path = _target(spark, "parquet")
    save(p, path, format="parquet", mode="overwrite", partition_by=["flag"])
    back = spark.read.parquet(path)
    return publish(back.select(*[F.col(c).cast(p.schema[c].dataType) for c in p.columns]))


@register("csv_inferred", _PANEL_OUT)
def csv_inferred(spark, sf):
    """Write the panel as CSV, read it back with inferred types."""
    p = panel(spark, sf)
    path = _target(spark, "csv")
    save(p, path, format="csv", mode="overwrite")
    back = load_csv(spark, path, header=True, infer_schema=True)
    return publish(back.select(*[F.col(c).cast(p.schema[c].dataType) for c in p.columns]))


@register("json_roundtrip", _PANEL_OUT)
def json_roundtrip(spark, sf):
    """Write the panel as JSON lines, read it back with its schema."""
    p = panel(spark, sf)
    path = _target(spark, "json")
    save(p, path, format="json", mode="overwrite")
    return publish(spark.read.schema(p.schema).json(path))


@register(
    "weekly_sales_load",
    S.with_(S.PANEL)
    + "SELECT CAST(entity AS INTEGER) AS Store, strftime(dt, '%d-%m-%Y') AS Date, CAST(value AS DOUBLE) AS Weekly_Sales, flag AS Holiday_Flag, "
    "cov_a AS Temperature, cov_b AS Fuel_Price, cov_c AS CPI, cov_d AS Unemployment FROM panel",
)
def weekly_sales_load(spark, sf):
    """The panel written in the raw weekly layout, loaded with its fixed schema."""
    raw = panel(spark, sf).select(
        F.col("entity").alias("Store"), F.date_format("dt", "dd-MM-yyyy").alias("Date"), F.col("value").alias("Weekly_Sales"),
        F.col("flag").alias("Holiday_Flag"), F.col("cov_a").alias("Temperature"), F.col("cov_b").alias("Fuel_Price"),
        F.col("cov_c").alias("CPI"), F.col("cov_d").alias("Unemployment"),
    )
    path = _target(spark, "weekly")
    save(raw, path, format="csv", mode="overwrite")
    return publish(load_weekly_sales(spark, path))


@register(
    "sample_rows",
    S.with_(S.PANEL)
    + "SELECT entity, dt, CAST(value AS DOUBLE) AS value FROM panel WHERE value IS NOT NULL ORDER BY entity, dt LIMIT 20",
)
def sample_rows(spark, sf):
    """A deterministic preview: chosen columns, non-null measure, ordered, first 20."""
    return publish(preview(panel(spark, sf), ["entity", "dt", "value"], order=["entity", "dt"], not_null=["value"], n=20))


# A line is broken by a text in place of the number, a missing field or one too many.
_LINES = """lines AS (SELECT entity, dt, value, concat(entity, ',', strftime(dt, '%Y-%m-%d'),
    CASE WHEN entity % 5 = 0 AND month(dt) = 1 THEN ',n/a' WHEN entity % 5 = 1 AND month(dt) = 2 THEN ''
         WHEN entity % 5 = 2 AND month(dt) = 3 THEN concat(',', value, ',more') ELSE concat(',', value) END) AS line,
    entity % 5 < 3 AND month(dt) = entity % 5 + 1 AS broken FROM panel)"""


@register(
    "csv_rejects",
    S.with_(S.PANEL, _LINES)
    + "SELECT CASE WHEN NOT broken THEN CAST(entity AS VARCHAR) END AS entity, CASE WHEN NOT broken THEN dt END AS dt, "
    "CASE WHEN NOT broken THEN CAST(value AS DOUBLE) END AS value, CASE WHEN broken THEN line END AS line FROM lines",
)
def csv_rejects(spark, sf):
    """A file with broken lines: its good rows, and beside them the rejected lines."""
    part = "CASE WHEN entity % 5 = 0 AND month(dt) = 1 THEN ',n/a' WHEN entity % 5 = 1 AND month(dt) = 2 THEN '' WHEN entity % 5 = 2 AND month(dt) = 3 THEN concat(',', value, ',more') ELSE concat(',', value) END"
    p = panel(spark, sf).select("entity", "dt", "value")
    path = _target(spark, "lines")
    p.select(F.expr(f"concat(entity, ',', date_format(dt, 'yyyy-MM-dd'), {part})").alias("line")).write.text(path)
    good, rejects = load_csv_checked(spark, path, p.schema, header=False)
    good = good.withColumn("entity", F.col("entity").cast("string"))
    return publish(good.unionByName(rejects.select("line"), allowMissingColumns=True))


@register(
    "bucketed_rolling",
    S.with_(S.PANEL) + f"SELECT entity, dt, CAST(value AS DOUBLE) AS value, {S.RAVG(4)} AS Rolling_Avg_4W, {S.RSUM(4)} AS Rolling_Sum_4W FROM panel",
)
def bucketed_rolling(spark, sf):
    """The panel kept as a table bucketed by entity and sorted by time; windows over it shuffle nothing."""
    path = _target(spark, "bucketed")
    name = f"bucketed_{uuid.uuid4().hex}"
    save_bucketed(panel(spark, sf).select("entity", "dt", "value"), name, "entity", ["dt"], 16, path)
    return publish(rolling_metrics(spark.table(name), PanelSpec(covariates=()), (4,)))
