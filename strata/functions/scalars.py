"""Scalars without the driver: a global aggregate is a one-row DataFrame, so it
can be broadcast (its size is one row by construction) and cross joined onto
the rows that need it. The reference collects such scalars and re-injects them
as literals; here the plan stays one lazy job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row of ``df``.

    A join against a one-row side never emits pairs: each row meets exactly one
    row. (Scalar subqueries, ``DataFrame.scalar()``, were measured as the
    alternative: nested ones are planned once per reference, 130 scans instead
    of 7 for the quartile plan, so the broadcast row is kept.)

    ``one_row`` should be a global aggregate (``df.agg(...)`` with no
    grouping); of anything else one row counts, which is what bounds the
    broadcast (the optimizer drops the limit over a global aggregate)."""
    return df.crossJoin(F.broadcast(one_row.limit(1)))


def long_table(parts: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Tables of unlike columns as one: for each (table, key columns) a row for
    each of its numbers: Section, Row_Key (keys joined by "|"), Metric, Value."""
    out = []
    for section, (df, keys) in parts.items():
        metrics = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in keys]
        cells = F.array(*[F.struct(F.lit(m).alias("Metric"), F.col(m).cast("double").alias("Value")) for m in metrics])
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
        out.append(df.select(F.lit(section).alias("Section"), key.alias("Row_Key"), F.inline(cells)))
    return reduce(DataFrame.unionByName, out)
