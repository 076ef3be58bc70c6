"""Data-quality reports: null/NaN profile, dataset statistics, validation
(duplicates + null %), numeric describe and panel coverage.

Each report is one aggregate over the input (the reference runs one action per
column); long-format reports are the aggregate row exploded into one row per
column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from ..functions.numeric import ratio_pct
from ..spec import DEFAULT, PanelSpec


def is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (FloatType, DoubleType))


def missing(df: DataFrame, c: str) -> Column:
    """Null, or NaN for float/double columns only (ANSI-safe: ledger D5)."""
    x = F.col(c)
    return (x.isNull() | F.isnan(x)) if is_float(df, c) else x.isNull()


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: Column, Null_Count (null or NaN), Null_Pct."""
    cols = list(columns or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(missing(df, c)).alias(f"_m{i}") for i, c in enumerate(cols)])
    long = row.select(
        "_n",
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("Column"), F.col(f"_m{i}").alias("Null_Count")) for i, c in enumerate(cols)])
        ).alias("_r"),
    )
    return long.select("_r.Column", "_r.Null_Count", ratio_pct(F.col("_r.Null_Count"), F.col("_n")).alias("Null_Pct"))


def dataset_stats(df: DataFrame) -> DataFrame:
    """One row: rows, columns, column names and the null count of each column."""
    return df.agg(
        F.count(F.lit(1)).alias("Total_Records"),
        F.lit(len(df.columns)).alias("Total_Columns"),
        F.lit(",".join(df.columns)).alias("Column_Names"),
        *[F.count_if(F.col(c).isNull()).alias(f"Null_{c}") for c in df.columns],
    )


def validate_report(df: DataFrame) -> DataFrame:
    """One row: rows, exact-duplicate rows (rows minus distinct rows) and the
    null % of every column, rounded to 2. The distinct count is a grouped
    aggregate over all columns; partial aggregation collapses a heavily
    repeated row before the shuffle."""
    base = df.agg(
        F.count(F.lit(1)).alias("Total_Records"),
        *[ratio_pct(F.count_if(F.col(c).isNull()), F.count(F.lit(1))).alias(f"Null_Pct_{c}") for c in df.columns],
    )
    distinct = df.groupBy(*df.columns).count().agg(F.count(F.lit(1)).alias("_d"))
    out = base.crossJoin(distinct)
    return out.select(
        "Total_Records",
        (F.col("Total_Records") - F.col("_d")).alias("Duplicate_Records"),
        *[f"Null_Pct_{c}" for c in df.columns],
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 4) -> DataFrame:
    """One row per numeric column: Count, Mean, StdDev, Min, Max (typed
    doubles, unlike ``describe()`` which returns strings)."""
    cols = list(columns or numeric_columns(df))

    def x(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.nanvl(v, F.lit(None).cast("double"))

    aggs = []
    for i, c in enumerate(cols):
        aggs += [
            F.count(x(c)).alias(f"_c{i}"),
            F.round(F.avg(x(c)), digits).alias(f"_a{i}"),
            F.round(F.stddev(x(c)), digits).alias(f"_s{i}"),
            F.min(x(c)).alias(f"_lo{i}"),
            F.max(x(c)).alias(f"_hi{i}"),
        ]
    row = df.agg(*aggs)
    recs = [
        F.struct(
            F.lit(c).alias("Column"),
            F.col(f"_c{i}").alias("Count"),
            F.col(f"_a{i}").alias("Mean"),
            F.col(f"_s{i}").alias("StdDev"),
            F.col(f"_lo{i}").alias("Min"),
            F.col(f"_hi{i}").alias("Max"),
        )
        for i, c in enumerate(cols)
    ]
    return row.select(F.inline(F.array(*recs)))


def panel_coverage(df: DataFrame, spec: PanelSpec = DEFAULT, approx_entities: bool = False) -> DataFrame:
    """One row: date range, distinct entities, rows, flagged / unflagged rows
    and their shares."""
    ent = F.approx_count_distinct(spec.entity) if approx_entities else F.count_distinct(spec.entity)
    on = F.count_if(F.col(spec.flag) == 1)
    off = F.count_if(F.col(spec.flag) == 0)
    n = F.count(F.lit(1))
    return df.agg(
        F.min(spec.time).alias("Min_Date"),
        F.max(spec.time).alias("Max_Date"),
        ent.alias("Entities"),
        n.alias("Total_Rows"),
        on.alias("Flag_Rows"),
        off.alias("Non_Flag_Rows"),
        ratio_pct(on, n).alias("Flag_Pct"),
        ratio_pct(off, n).alias("Non_Flag_Pct"),
    )


def preview(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    order: Sequence[str] = (),
    not_null: Sequence[str] = (),
    n: int = 20,
) -> DataFrame:
    """The first ``n`` rows: chosen columns, rows where ``not_null`` have
    values, in ``order`` (without an order, any ``n`` rows)."""
    out = df.dropna(subset=list(not_null)) if not_null else df
    out = out.orderBy(*order) if order else out
    return out.select(*(columns or df.columns)).limit(n)
