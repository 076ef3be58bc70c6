"""Date parsing and calendar parts as built-in expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import col

# Date patterns tried in this order (day-first wins where nothing else decides).
DATE_FORMATS: tuple[str, ...] = ("yyyy-MM-dd", "dd-MM-yyyy", "MM-dd-yyyy", "dd/MM/yyyy", "MM/dd/yyyy", "M/d/yyyy")

# Season of each month.
SEASON_MONTHS: dict[str, tuple[int, ...]] = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
}
SEASON_ORDER: tuple[str, ...] = ("Winter", "Spring", "Summer", "Fall")


# What the text of a numeric field looks like where a pattern can read it.
_FIELD_TEXT: dict[str, str] = {
    "yyyy": "[+-]?[0-9]{4,}",
    "MM": "(0[1-9]|1[0-2])",
    "dd": "(0[1-9]|[12][0-9]|3[01])",
    "M": "[+-]?0*([1-9]|1[0-2])",
    "d": "[+-]?0*([1-9]|[12][0-9]|3[01])",
}


def _shape(fmt: str) -> tuple[str, set[str]] | None:
    """A regular expression that every text ``fmt`` can read begins with, and
    its separators, of patterns of numeric years, months and days; else None."""
    parts = re.findall(r"y+|M+|d+|[-/. ]|.", fmt, re.DOTALL)
    seps = {x for x in parts if x in "-/. "}
    if not all(x in _FIELD_TEXT or x in seps for x in parts):
        return None
    return "^" + "".join(_FIELD_TEXT.get(x) or f"[{x}]" for x in parts), seps


def _read(s: Column, fmt: str) -> Column:
    """The text as a date, or null. A pattern is tried on texts of its shape
    only (separators first): one that fails costs an exception a row."""
    read, shape = F.try_to_date(s, fmt), _shape(fmt)
    if shape is None:
        return read
    may = [*[s.contains(x) for x in sorted(shape[1])], s.rlike(shape[0])]
    return F.when(reduce(and_, may), read)


def parse_date(c: str | Column, formats: Sequence[str] | str | None = None) -> Column:
    """String -> date trying each pattern per row; unparseable -> null.

    No sampling and no action: every row picks the first pattern that fits it,
    so a column mixing several formats parses completely."""
    if isinstance(formats, str):
        formats = (formats,)
    s = F.trim(col(c).cast("string"))
    return F.coalesce(*[_read(s, f) for f in tuple(formats or DATE_FORMATS)])


def date_readings(c: str | Column, formats: Sequence[str] | None = None) -> Column:
    """Array of the dates that the patterns read in the text, null where one
    cannot. A lambda over the one text keeps the code that Spark generates
    small: spelled out for several columns, it outgrows what the JVM compiles."""
    fmts = tuple(formats or DATE_FORMATS)
    return F.transform(F.array(F.trim(col(c).cast("string"))), lambda s: F.array(*[_read(s, f) for f in fmts]))[0]


def date_votes(df: DataFrame, column: str | Sequence[str], formats: Sequence[str] | None = None) -> DataFrame:
    """One row. ``_votes``: for each pattern, the number of values it reads
    that have one reading only. Patterns that read a value as different dates
    leave it out; 12/25/2010 speaks for month-first, 05/02/2010 for none.
    ``_vote_order``: the places of the patterns, most votes first. One aggregate
    over the column, no sampling. Of several columns both are maps from their
    names, still from one pass."""
    columns = [column] if isinstance(column, str) else list(column)
    read = df.select(*[date_readings(c, formats).alias(f"_r{i}") for i, c in enumerate(columns)])

    def counts(i: int) -> Column:
        r = F.col(f"_r{i}")
        sure = F.array_min(r) == F.array_max(r)
        return F.array(*[F.count_if(sure & r[j].isNotNull()) for j in range(len(formats or DATE_FORMATS))])

    votes = read.agg(*[counts(i).alias(f"_v{i}") for i in range(len(columns))])
    found = {"_votes": [F.col(f"_v{i}") for i in range(len(columns))]}
    found["_vote_order"] = [vote_order(v) for v in found["_votes"]]
    if isinstance(column, str):
        return votes.select(*[v[0].alias(n) for n, v in found.items()])
    return votes.select(*[F.create_map(*[x for c, y in zip(columns, v) for x in (F.lit(c), y)]).alias(n) for n, v in found.items()])


def vote_order(votes: str | Column) -> Column:
    """Places of the patterns by falling votes; ties go by the order of the patterns."""
    ranked = F.array_sort(F.transform(col(votes), lambda n, i: F.struct((-n).alias("n"), i.alias("place"))))
    return F.transform(ranked, lambda x: x["place"])


def parse_date_ordered(c: str | Column, order: str | Column, formats: Sequence[str] | None = None) -> Column:
    """String -> date by the first pattern that can read it, in the order that
    the array ``order`` names them (``date_votes``); unparseable -> null. So an
    ambiguous text is read as the rest of its column is, and a column of
    several formats parses completely."""
    s = F.trim(col(c).cast("string"))
    read = [_read(s, f) for f in tuple(formats or DATE_FORMATS)]

    def by(place: Column) -> Column:
        e = F.when(place == 0, read[0])
        for i, r in enumerate(read[1:], start=1):
            e = e.when(place == i, r)
        return e

    return F.aggregate(col(order), F.lit(None).cast("date"), lambda date, place: F.coalesce(date, by(place)))


def parse_date_voted(c: str | Column, formats: Sequence[str] | None = None, votes: str = "_votes") -> Column:
    """``parse_date_ordered`` by the pattern that most values of the column
    speak for, of those that can read this one (``date_votes``)."""
    return parse_date_ordered(c, vote_order(votes), formats)


def season(month: Column) -> Column:
    e = None
    for name in SEASON_ORDER[:-1]:
        cond = month.isin(*SEASON_MONTHS[name])
        e = F.when(cond, F.lit(name)) if e is None else e.when(cond, F.lit(name))
    return e.when(month.isNotNull(), F.lit(SEASON_ORDER[-1]))


def season_ordinal(s: Column) -> Column:
    e = None
    for i, name in enumerate(SEASON_ORDER, start=1):
        e = F.when(s == name, F.lit(i)) if e is None else e.when(s == name, F.lit(i))
    return e


def week_start(c: str | Column) -> Column:
    """Monday of the ISO week of a date or timestamp."""
    return F.trunc(F.to_date(col(c)), "week")
