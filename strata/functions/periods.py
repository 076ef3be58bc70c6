"""The row of an earlier period, found by its number and not by its place."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def previous(value: str, period: Column, *by: str, back: int = 1) -> Column:
    """``value`` of the row whose ``period`` (an integer, one row for each,
    within ``by``) is ``back`` earlier; null where no such row exists.

    A RANGE frame over the period number, so a missing period leaves a gap
    instead of shifting its neighbours together. A null period has none."""
    w = Window.partitionBy(*by).orderBy(period).rangeBetween(-back, -back)
    return F.when(period.isNotNull(), F.max(value).over(w))
