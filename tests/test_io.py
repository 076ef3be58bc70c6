"""Sources and sinks: CSV with explicit / inferred schema, parquet partitioned
write, JSON, save modes."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from strata.session import shared_dir
from strata.sources import load_csv, read_table, save, weekly_panel, weekly_sales_schema

from .conftest import SF_SMALL


def _path(spark, name):
    return os.path.join(shared_dir(spark), f"test-{name}-{uuid.uuid4().hex}")


@pytest.fixture(scope="module")
def panel(spark):
    return weekly_panel(read_table(spark, SF_SMALL, "lineitem"))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_csv_explicit_schema(spark, panel):
    path = _path(spark, "csv")
    save(panel, path, "csv")
    assert _same(load_csv(spark, path, schema=panel.schema), panel)


def test_csv_inferred_and_string(spark, panel):
    path = _path(spark, "csv2")
    save(panel.select("entity", "cov_d"), path, "csv")
    inferred = load_csv(spark, path, infer_schema=True)
    assert dict(inferred.dtypes) == {"entity": "int", "cov_d": "double"}
    as_text = load_csv(spark, path, infer_schema=False)
    assert {t for _, t in as_text.dtypes} == {"string"}


def test_weekly_sales_schema_reads_reference_layout(spark):
    path = _path(spark, "raw")
    os.makedirs(path)
    with open(os.path.join(path, "w.csv"), "w") as f:
        f.write("Store,Date,Weekly_Sales,Holiday_Flag,Temperature,Fuel_Price,CPI,Unemployment\n")
        f.write("1,05-02-2010,1643690.90,0,42.31,2.572,211.0963582,8.106\n")
        f.write("1,bad,oops,0,,,,\n")
    df = load_csv(spark, path, schema=weekly_sales_schema())
    rows = df.collect()
    assert len(rows) == 2 and rows[0].Store == 1 and rows[1].Weekly_Sales is None


def test_parquet_partitioned_and_modes(spark, panel):
    path = _path(spark, "pq")
    save(panel, path, "parquet", partition_by=["flag"])
    back = spark.read.parquet(path).select(*panel.columns)
    assert _same(back, panel)
    assert {"flag=0", "flag=1"} <= set(os.listdir(path))
    save(panel, path, "parquet", mode="append", partition_by=["flag"])
    assert spark.read.parquet(path).count() == 2 * panel.count()
    save(panel.limit(1), path, "parquet", mode="ignore")
    assert spark.read.parquet(path).count() == 2 * panel.count()
    with pytest.raises(Exception):
        save(panel, path, "parquet", mode="error")


def test_json(spark, panel):
    path = _path(spark, "json")
    small = panel.select("entity", "dt", F.col("value").cast("double").alias("value"))
    save(small, path, "json")
    back = spark.read.schema(small.schema).json(path)
    assert _same(back, small)


def test_bad_format_rejected(spark, panel):
    with pytest.raises(ValueError):
        save(panel, _path(spark, "x"), "xml")


def test_weekly_sales_layout_end_to_end(spark, panel):
    """A panel written in the weekly store-sales CSV layout (text dates in
    dd-MM-yyyy) loads, cleans and runs the feature and KPI operators with the
    WEEKLY_SALES spec, giving the same numbers as on the panel itself."""
    from strata.functions import publish
    from strata.operators import clean as CL
    from strata.operators import features as FE
    from strata.operators import kpi as K
    from strata.sources import WEEKLY_SALES, load_weekly_sales
    from strata.spec import DEFAULT

    raw = panel.select(
        F.col("entity").cast("int").alias("Store"),
        F.date_format("dt", "dd-MM-yyyy").alias("Date"),
        F.col("value").alias("Weekly_Sales"),
        F.col("flag").alias("Holiday_Flag"),
        F.col("cov_a").alias("Temperature"),
        F.col("cov_b").alias("Fuel_Price"),
        F.col("cov_c").alias("CPI"),
        F.col("cov_d").alias("Unemployment"),
    )
    path = _path(spark, "weekly")
    save(raw, path, "csv")
    df = load_weekly_sales(spark, path)
    assert dict(df.dtypes)["Weekly_Sales"] == "decimal(18,2)"
    clean = CL.parse_dates(df, "Date")  # no nulls to impute in this file
    a = publish(K.entity_kpi(clean, WEEKLY_SALES)).withColumnRenamed("Store", "entity")
    b = publish(K.entity_kpi(panel, DEFAULT)).withColumn("entity", F.col("entity").cast("int"))
    assert _same(a.select(*sorted(a.columns)), b.select(*sorted(b.columns)))
    fa = FE.feature_set(clean, WEEKLY_SALES).select("Store", "Date", "Rolling_Avg_4W", "Sales_Quartile", "Cumulative_Sales")
    fb = FE.feature_set(panel, DEFAULT).select(
        F.col("entity").cast("int").alias("Store"), F.col("dt").alias("Date"), "Rolling_Avg_4W", "Sales_Quartile", "Cumulative_Sales"
    )
    assert _same(fa, fb)


def test_no_line_is_lost(spark, tmp_path):
    from pyspark.sql.types import StructType

    from strata.sources import load_csv_checked

    lines = ["id,day,amount", "1,2020-01-06,2.50", "2,2020-01-07", "3,2020-01-08,x", "4,2020-01-09,1.00,more", "", "  ", "five,2020-01-10,1.00", "6,,", '7,2020-01-11,"3.00"', "8,tomorrow,1.00", "id,day,amount"]
    for part in (0, 1):
        (tmp_path / f"{part}.csv").write_text("\n".join(lines) + "\n")
    schema = StructType.fromDDL("id int, day date, amount decimal(18,2)")
    good, rejects = load_csv_checked(spark, str(tmp_path), schema)
    assert good.schema.simpleString() == schema.simpleString() and rejects.columns == ["file", "line"]
    kept = sorted((r.id, str(r.day), str(r.amount)) for r in good.collect())
    assert kept == sorted(2 * [(1, "2020-01-06", "2.50"), (6, "None", "None"), (7, "2020-01-11", "3.00")])
    broken = rejects.collect()
    assert sorted(r.line for r in broken) == sorted(2 * ["2,2020-01-07", "3,2020-01-08,x", "4,2020-01-09,1.00,more", "five,2020-01-10,1.00", "8,tomorrow,1.00"])
    assert {r.file[-5:] for r in broken} == {"0.csv", "1.csv"}
    # each table by itself, pruned to one column, loses nothing
    assert good.count() == 6 and rejects.count() == 10 and good.select("id").count() + rejects.select("line").count() == 16
    whole, none = load_csv_checked(spark, str(tmp_path), schema, header=False)
    assert whole.count() == 6 and none.count() == 14


def test_bucketed_table_needs_no_shuffle(spark, panel, tmp_path):
    from strata.operators.features import rolling_metrics
    from strata.sources import save_bucketed

    save_bucketed(panel, "bucketed_panel", "entity", ["dt"], 4, str(tmp_path / "b"))
    try:
        table = spark.table("bucketed_panel")
        out = rolling_metrics(table, windows=(4, 12))
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        plain = rolling_metrics(panel, windows=(4, 12))
        assert out.exceptAll(plain).count() == 0 and out.count() == plain.count() > 0
        per = table.groupBy("entity").count()
        assert "Exchange" not in per._jdf.queryExecution().executedPlan().toString()
        with pytest.raises(ValueError):
            save_bucketed(panel, "bucketed_panel", "entity", ["dt"], 4, mode="replace")
    finally:
        spark.sql("DROP TABLE bucketed_panel")
