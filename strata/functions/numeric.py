"""Column expressions shared by all operators: exact money sums, ANSI-safe ratios
and the single rounding rule. Every helper returns a ``Column``; none runs an action."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..spec import PanelSpec


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column, spec: PanelSpec) -> Column:
    """The measure as an exact decimal: NaN is missing (D23), a value beyond
    the declared precision fails the query. ``value_scale`` is the number of
    decimals the measure has; declare more, or None for a measure summed as
    double, where two are not enough."""
    x = col(c)
    if spec.value_scale is None:
        return F.nanvl(x.cast("double"), F.lit(None).cast("double"))
    return F.when(~F.isnan(x.cast("double")), x.cast(DecimalType(spec.value_precision, spec.value_scale)))


def exact_sum(c: str | Column, spec: PanelSpec) -> Column:
    """Order-independent sum: decimal inside, so every engine and every
    partitioning gives the same bits once it is cast to double."""
    return F.sum(money(c, spec))


def exact_avg(c: str | Column, spec: PanelSpec) -> Column:
    """sum / count of the non-null values, as double; null on no rows."""
    m = money(c, spec)
    return F.try_divide(F.sum(m).cast("double"), F.count(m))


def plain_avg(c: str | Column) -> Column:
    """Mean of a double covariate with NaN treated as missing (D23)."""
    x = col(c).cast("double")
    return F.avg(F.nanvl(x, F.lit(None).cast("double")))


def r2(c: Column, digits: int = 2) -> Column:
    """The one rounding rule (HALF_UP on the shortest decimal form)."""
    return F.round(c.cast("double"), digits)


def ratio_pct(num: Column, den: Column, digits: int = 2) -> Column:
    """round(num / den * 100); null instead of an ANSI divide-by-zero (D16)."""
    return F.round(F.try_divide(num.cast("double"), den.cast("double")) * 100, digits)


def growth_pct(cur: Column, prev: Column, digits: int = 2) -> Column:
    """(cur - prev) / prev * 100, rounded; null when prev is 0 or null."""
    return ratio_pct(cur.cast("double") - prev.cast("double"), prev, digits)


def publish(df):
    """Cast decimal columns to double: results carry int, bigint, double,
    string and date only."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over the complete pairs; null (not an ANSI divide
    error) when either side has zero variance or there are fewer than two.

    One co-moment state holds the counts, means and moments of the complete
    pairs (``regr_r2``, null for a constant x and 1 for a constant y); the
    covariance gives the sign. Both leave incomplete pairs out by themselves."""
    r2, cov = F.regr_r2(y, x), F.covar_samp(x, y)
    size = F.sqrt(F.least(r2, F.lit(1.0)))
    return F.when(r2.isNotNull() & ~((cov == 0) & (r2 == 1)), F.signum(cov) * size)


def cents(c: str, scale: int = 2) -> Column:
    """Exact unscaled long of ``CAST(c AS DECIMAL(18, scale))``.

    Fast path: a double already on the 10^-scale grid (rint(x*10^s)/10^s == x,
    which holds for every value stored with at most ``scale`` decimals) is
    converted with one multiply; anything else goes through the decimal cast,
    so the result always equals the decimal cast. NaN is missing; a value that
    does not fit (an infinity too) fails the query."""
    x, f = f"CAST(`{c}` AS DOUBLE)", 10**scale
    return F.expr(
        f"CASE WHEN isnan({x}) THEN NULL "
        f"WHEN abs({x}) < 1e15 / {f} AND rint({x} * {f}.0) / {f}.0 = {x} THEN CAST(rint({x} * {f}.0) AS BIGINT) "
        f"ELSE CAST(CAST({x} AS DECIMAL(18,{scale})) * {f} AS BIGINT) END"
    )


def from_cents(c: str, scale: int = 2, precision: int = 18) -> Column:
    """Long of unscaled units -> DECIMAL(precision, scale), exactly."""
    return F.expr(f"CAST(CAST(`{c}` AS DECIMAL(38,0)) / {10**scale} AS DECIMAL({precision},{scale}))")
