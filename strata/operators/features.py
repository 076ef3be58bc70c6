"""Feature engineering over a panel: calendar parts, rolling and cumulative
measures, lags, growth rates and value quartiles.

All per-entity columns use windows partitioned by the entity and ordered by
time. Spark fuses window expressions with the same partitioning into one
Window operator after one Exchange + Sort, and a window partitioned by
(entity, year) is satisfied by the same hash partitioning on entity, so the
whole feature set costs one shuffle by entity plus the quantile aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import SEASON_MONTHS, SEASON_ORDER, season
from ..functions.numeric import growth_pct, money, r2
from ..functions.ranking import exact_quantiles
from ..functions.scalars import with_scalars
from ..spec import DEFAULT, PanelSpec

# Quartile labels, lowest first.
QUARTILE_LABELS: tuple[str, ...] = ("Low", "Medium-Low", "Medium-High", "High")


def entity_window(spec: PanelSpec, *extra: Column | str):
    return Window.partitionBy(F.col(spec.entity), *extra).orderBy(*[F.col(c) for c in spec.order])


def calendar_columns(date: str | Column, names: Sequence[str] | None = None) -> dict[str, Column]:
    """Calendar parts of ``date`` (a column name or Column): Year, Quarter,
    Month, Day, WeekOfYear, DayOfWeek (1 = Sunday), MonthName, DayName, IsWeekend,
    Season. Only ``names`` are built when given."""
    d = f"`{date}`" if isinstance(date, str) else None
    if d is None:  # a Column: compose with the Column API
        dow, month = F.dayofweek(date), F.month(date)
        full = {
            "Year": F.year(date),
            "Quarter": F.quarter(date),
            "Month": month,
            "Day": F.dayofmonth(date),
            "WeekOfYear": F.weekofyear(date),
            "DayOfWeek": dow,
            "MonthName": F.date_format(date, "MMMM"),
            "DayName": F.date_format(date, "EEEE"),
            "IsWeekend": F.when(dow.isin(1, 7), 1).when(dow.isNotNull(), 0),
            "Season": season(month),
        }
        return {n: full[n] for n in (names or full)}
    seasons = " ".join(
        f"WHEN month({d}) IN ({', '.join(map(str, SEASON_MONTHS[n]))}) THEN '{n}'" for n in SEASON_ORDER[:-1]
    )
    sql = {
        "Year": f"year({d})",
        "Quarter": f"quarter({d})",
        "Month": f"month({d})",
        "Day": f"dayofmonth({d})",
        "WeekOfYear": f"weekofyear({d})",
        "DayOfWeek": f"dayofweek({d})",
        "MonthName": f"date_format({d}, 'MMMM')",
        "DayName": f"date_format({d}, 'EEEE')",
        "IsWeekend": f"CASE WHEN dayofweek({d}) IN (1, 7) THEN 1 WHEN {d} IS NOT NULL THEN 0 END",
        "Season": f"CASE {seasons} WHEN {d} IS NOT NULL THEN '{SEASON_ORDER[-1]}' END",
    }
    return {n: F.expr(sql[n]) for n in (names or sql)}


def calendar_features(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Year, Quarter, Month, Day, WeekOfYear, DayOfWeek (1 = Sunday), MonthName,
    DayName, IsWeekend, Season — one projection, no shuffle."""
    return df.withColumns(calendar_columns(spec.time))


def _trailing(spec: PanelSpec, k: int) -> tuple[Column, Column]:
    """Sum and count of the last k rows. Of a decimal measure, as differences
    of running totals: O(1) per row for any k, and exact. Doubles would cancel
    in a difference (and stay NaN after an infinity), so their rows are summed
    over the sliding frame itself. Stated in SQL so each column is one JVM
    call to build."""
    m = _money_sql(spec)
    w = _window_sql(spec)
    if spec.value_scale is None:
        frame = f"OVER ({w} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
        return F.expr(f"sum({m}) {frame}"), F.expr(f"count({m}) {frame}")
    cs = f"sum(coalesce({m}, 0)) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    cc = f"count({m}) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    # running totals k rows back (0 before the first row)
    n = f"({cc} - coalesce(lag({cc}, {k}) OVER ({w}), 0))"
    total = f"CASE WHEN {n} > 0 THEN {cs} - coalesce(lag({cs}, {k}) OVER ({w}), 0) END"
    return F.expr(total), F.expr(n)


def _money_sql(spec: PanelSpec) -> str:
    if spec.value_scale is None:
        return f"nanvl(CAST(`{spec.value}` AS DOUBLE), CAST(NULL AS DOUBLE))"
    cast = f"CAST(`{spec.value}` AS DECIMAL({spec.value_precision},{spec.value_scale}))"
    return f"CASE WHEN NOT isnan(CAST(`{spec.value}` AS DOUBLE)) THEN {cast} END"


def _window_sql(spec: PanelSpec) -> str:
    order = ", ".join(f"`{c}`" for c in spec.order)
    return f"PARTITION BY `{spec.entity}` ORDER BY {order}"


def rolling_columns(
    spec: PanelSpec,
    windows: Sequence[int] = (4, 12, 26),
    avg_name: str = "Rolling_Avg_{k}W",
    sum_name: str | None = "Rolling_Sum_{k}W",
    min_rows: int = 1,
) -> dict[str, Column]:
    """Trailing k-row average and sum (partial windows count, as in the
    reference); rounded to 2. The sum is a true sum (ledger D1). Null where the
    window holds fewer than ``min_rows`` values of the measure (D13)."""
    out: dict[str, Column] = {}
    for k in windows:
        s, n = _trailing(spec, k)
        if min_rows > 1:
            s = F.when(n >= min_rows, s)
        out[avg_name.format(k=k)] = r2(F.try_divide(s.cast("double"), n))
        if sum_name:
            out[sum_name.format(k=k)] = r2(s)
    return out


def rolling_metrics(
    df: DataFrame,
    spec: PanelSpec = DEFAULT,
    windows: Sequence[int] = (4, 12, 26),
    split_block: Column | None = None,
    min_rows: int = 1,
) -> DataFrame:
    """Trailing averages and sums, null below ``min_rows`` values;
    ``split_block`` as in ``feature_set``."""
    if split_block is not None:
        return split_window_features(df, spec, windows, (), split_block, min_rows)
    return df.withColumns(rolling_columns(spec, windows, min_rows=min_rows))


def lag_columns(spec: PanelSpec, lags: Sequence[int] = (1, 4, 52), name: str = "Sales_Lag_{k}W") -> dict[str, Column]:
    w = entity_window(spec)
    return {name.format(k=k): F.lag(spec.value, k).over(w) for k in lags}


def lag_features(
    df: DataFrame, spec: PanelSpec = DEFAULT, lags: Sequence[int] = (1, 4, 52), split_block: Column | None = None
) -> DataFrame:
    """Value k rows back within the entity (row lag, not calendar lag);
    ``split_block`` as in ``feature_set``."""
    if split_block is not None:
        return split_window_features(df, spec, (), lags, split_block)
    return df.withColumns(lag_columns(spec, lags))


def _growth(spec: PanelSpec, prev: Column, prev_year: Column) -> dict[str, Column]:
    v = F.col(spec.value)
    return {
        "Sales_Prev_Week": prev,
        "WoW_Growth_Pct": growth_pct(v, prev),
        "Sales_Prev_Year": prev_year,
        "YoY_Growth_Pct": growth_pct(v, prev_year),
    }


def growth_columns(spec: PanelSpec, period: int = 1, year_period: int = 52) -> dict[str, Column]:
    w = entity_window(spec)
    return _growth(spec, F.lag(spec.value, period).over(w), F.lag(spec.value, year_period).over(w))


def growth_rates(df: DataFrame, spec: PanelSpec = DEFAULT, split_block: Column | None = None) -> DataFrame:
    """Week-over-week and 52-row year-over-year growth in percent; null when
    the earlier value is 0 or missing (never an ANSI divide error).
    ``split_block`` as in ``feature_set``."""
    if split_block is not None:
        t = split_window_features(df, spec, (), (1, 52), split_block)
        cols = _growth(spec, F.col("Sales_Lag_1W"), F.col("Sales_Lag_52W"))
        return t.withColumns(cols).select(*df.columns, *cols)
    return df.withColumns(growth_columns(spec))


def cumulative_columns(spec: PanelSpec, per_year: bool = True) -> dict[str, Column]:
    extra = [F.year(spec.time)] if per_year else []
    w = entity_window(spec, *extra).rowsBetween(Window.unboundedPreceding, 0)
    m = money(spec.value, spec)
    return {
        "Cumulative_Sales": r2(F.sum(m).over(w)),
        "Cumulative_Avg_Sales": r2(F.try_divide(F.sum(m).over(w).cast("double"), F.count(m).over(w))),
    }


def cumulative_metrics(
    df: DataFrame, spec: PanelSpec = DEFAULT, per_year: bool = True, split_block: Column | None = None
) -> DataFrame:
    """Running (year-to-date) sum and average per entity; over all years with
    ``per_year=False``. ``split_block`` (an ascending function of time) adds
    the totals of earlier blocks to sums within a block, so that no task holds
    a whole entity; year-to-date windows are split by year already."""
    if per_year or split_block is None:
        return df.withColumns(cumulative_columns(spec, per_year))
    rows = _running_totals(df, spec, split_block)
    total = F.when(F.col("_cc") > 0, F.col("_cs"))
    mean = F.try_divide(total.cast("double"), F.col("_cc"))
    return rows.select(*df.columns, r2(total).alias("Cumulative_Sales"), r2(mean).alias("Cumulative_Avg_Sales"))


def quartile_bounds(df: DataFrame, spec: PanelSpec = DEFAULT, exact: bool = True) -> DataFrame:
    """One row: q1, q2, q3 of the measure, exact or (``exact=False``, D9) approximate in one pass."""
    return exact_quantiles(df, money(spec.value, spec), [0.25, 0.5, 0.75], ["_q1", "_q2", "_q3"], exact=exact)


def value_quartiles(
    df: DataFrame, spec: PanelSpec = DEFAULT, bounds: DataFrame | None = None, exact: bool = True
) -> DataFrame:
    """Sales_Category (Low .. High) and Sales_Quartile (1..4) by the global
    quartiles of the measure; a null measure gets nulls (ledger D10).
    ``exact=False`` takes approximate quartiles (D9)."""
    b = bounds if bounds is not None else quartile_bounds(df, spec, exact)
    v = money(spec.value, spec).cast("double")
    q = F.when(v.isNull(), F.lit(None))
    for i, qc in enumerate(("_q1", "_q2", "_q3"), start=1):
        q = q.when(v <= F.col(qc), F.lit(i))
    q = q.otherwise(F.lit(4))
    qc = F.col("Sales_Quartile")
    lab = F.when(qc.isNull(), F.lit(None))
    for i, name in enumerate(QUARTILE_LABELS, start=1):
        lab = lab.when(qc == i, F.lit(name))
    cols = df.columns
    out = with_scalars(df, b).withColumn("Sales_Quartile", q.cast("int"))
    return out.select(*cols, lab.alias("Sales_Category"), "Sales_Quartile")


def feature_set(
    df: DataFrame,
    spec: PanelSpec = DEFAULT,
    windows: Sequence[int] = (4, 12, 26),
    lags: Sequence[int] = (1, 4, 52),
    split_block: Column | None = None,
) -> DataFrame:
    """Calendar + rolling + lags + growth + year-to-date + quartiles in one
    projection of window expressions (one Exchange on the entity).

    ``split_block`` (e.g. ``F.year("dt")``) switches the rolling and lag
    columns to ``split_window_features``, for panels where one entity holds
    a large share of the rows; the year-to-date window is already split by
    (entity, year). Results are identical."""
    cols: dict[str, Column] = {}
    cols.update(calendar_columns(spec.time))
    if split_block is None:
        cols.update(rolling_columns(spec, windows))
        cols.update(lag_columns(spec, lags))
        cols.update(growth_columns(spec))
        feats = df.withColumns(cols)
    else:
        need = sorted(set(lags) | {1, 52})
        feats = split_window_features(df, spec, windows, need, split_block)
        feats = feats.withColumns(cols).withColumns(_growth(spec, F.col("Sales_Lag_1W"), F.col("Sales_Lag_52W")))
        names = list(cols)
        names += [n for k in windows for n in (f"Rolling_Avg_{k}W", f"Rolling_Sum_{k}W")]
        names += [f"Sales_Lag_{k}W" for k in lags]
        names += ["Sales_Prev_Week", "WoW_Growth_Pct", "Sales_Prev_Year", "YoY_Growth_Pct"]
        feats = feats.select(*df.columns, *names)
    feats = feats.withColumns(cumulative_columns(spec, per_year=True))
    return value_quartiles(feats, spec, quartile_bounds(df, spec))


#: Rows of an entity that one window of ``split_window_features`` holds, beside those lent by the tile next to it.
TILE_ROWS = 4096


def _running_totals(df: DataFrame, spec: PanelSpec, block: Column) -> DataFrame:
    """``df`` plus row number ``_rn``, running sum ``_cs`` and running count
    ``_cc`` of each entity, computed within (entity, ``block``) windows and
    shifted by the totals of the earlier blocks."""
    ent = spec.entity
    m = money(spec.value, spec)
    base = df.withColumn("_blk", block)
    order = [F.col(c) for c in spec.order]
    inside = Window.partitionBy(ent, "_blk").orderBy(*order)
    run = inside.rowsBetween(Window.unboundedPreceding, 0)
    base = base.withColumns(
        {
            "_rn": F.row_number().over(inside),
            "_cs": F.sum(F.coalesce(m, F.lit(0))).over(run),
            "_cc": F.count(m).over(run),
        }
    )
    prior = Window.partitionBy(ent).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        base.groupBy(ent, "_blk")
        .agg(F.count(F.lit(1)).alias("_bn"), F.sum(F.coalesce(m, F.lit(0))).alias("_bs"), F.count(m).alias("_bc"))
        .select(
            ent,
            "_blk",
            F.coalesce(F.sum("_bn").over(prior), F.lit(0)).alias("_on"),
            F.coalesce(F.sum("_bs").over(prior), F.lit(0)).alias("_os"),
            F.coalesce(F.sum("_bc").over(prior), F.lit(0)).alias("_oc"),
        )
    )
    blocks = blocks.withColumnsRenamed({ent: "_oe", "_blk": "_ob"})
    same = F.col(ent).eqNullSafe(F.col("_oe")) & F.col("_blk").eqNullSafe(F.col("_ob"))
    return base.join(blocks, same).withColumns(
        {
            "_rn": F.col("_rn") + F.col("_on"),
            "_cs": F.col("_cs") + F.col("_os"),
            "_cc": F.col("_cc") + F.col("_oc"),
        }
    )


def split_window_features(
    df: DataFrame,
    spec: PanelSpec = DEFAULT,
    windows: Sequence[int] = (4, 12, 26),
    lags: Sequence[int] = (1, 4, 52),
    block: Column | None = None,
    min_rows: int = 1,
) -> DataFrame:
    """Rolling sums / averages and lags without one task per entity, for a
    panel where one entity may hold a large share of all rows.

    1. Row numbers and running sums are computed inside (entity, time block)
       windows (``block`` defaults to the year) and shifted by the totals of
       the earlier blocks (a small per-block aggregate).
    2. The numbered rows of an entity are cut into tiles of ``TILE_ROWS``
       (or the farthest k, if more). A row less than k rows before the next
       tile (or behind the one before, for negative k) goes to that tile
       too, as a lender of its values; windows over (entity, tile) then look
       k rows back, and lenders are dropped.
    Same columns and values as ``rolling_columns`` + ``lag_columns``."""
    ent = spec.entity
    m = money(spec.value, spec)
    rows = _running_totals(df, spec, block if block is not None else F.year(spec.time))
    # a double measure is summed row by row (see _trailing), over the frame itself
    double = spec.value_scale is None
    back = max([0, *([k - 1 for k in windows] if double else windows), *lags])
    ahead = max([0, *[-k for k in lags]])
    n_tile = max(TILE_ROWS, back, ahead)
    at = F.col("_rn") - 1
    tile, place = F.floor(at / n_tile), at % n_tile
    own = [F.struct(tile.alias("tile"), F.lit(False).alias("lent"))]
    if back:
        own.append(F.when(place >= n_tile - back, F.struct((tile + 1).alias("tile"), F.lit(True).alias("lent"))))
    if ahead:
        own.append(F.when(place < ahead, F.struct((tile - 1).alias("tile"), F.lit(True).alias("lent"))))
    dealt = rows.select(*df.columns, "_rn", "_cs", "_cc", F.explode(F.array_compact(F.array(*own))).alias("_in"))
    dealt = dealt.select(*df.columns, "_rn", "_cs", "_cc", F.col("_in.tile").alias("_tile"), F.col("_in.lent").alias("_lent"), m.alias("_m"))
    w = Window.partitionBy(ent, "_tile").orderBy("_rn")
    seen: dict[str, Column] = {f"_v{k}": F.lag(spec.value, k).over(w) for k in lags}
    for k in windows:
        if double:
            frame = w.rowsBetween(1 - k, 0)
            seen |= {f"_s{k}": F.sum("_m").over(frame), f"_n{k}": F.count("_m").over(frame)}
        else:
            seen |= {f"{c}{k}": F.lag(c, k).over(w) for c in ("_cs", "_cc")}
    g = dealt.withColumns(seen).where(~F.col("_lent")).withColumnsRenamed({"_cs": "_cs0", "_cc": "_cc0"})
    out: dict[str, Column] = {}
    for k in windows:
        if double:
            s, n = F.col(f"_s{k}"), F.col(f"_n{k}")
        else:
            n = F.col("_cc0") - F.coalesce(F.col(f"_cc{k}"), F.lit(0))
            s = F.when(n > 0, F.col("_cs0") - F.coalesce(F.col(f"_cs{k}"), F.lit(0)))
        if min_rows > 1:
            s = F.when(n >= min_rows, s)
        out[f"Rolling_Avg_{k}W"] = r2(F.try_divide(s.cast("double"), n))
        out[f"Rolling_Sum_{k}W"] = r2(s)
    for k in lags:
        out[f"Sales_Lag_{k}W"] = F.col(f"_v{k}")
    return g.select(*df.columns, *[c.alias(n) for n, c in out.items()])
