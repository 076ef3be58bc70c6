"""Variable-capacity best-fit packing.

Documents become pieces no longer than the largest permitted sequence length.
Pieces are dealt by hash into groups of about ``group_items`` (identical rows
by a number of their own, so a group stays small whatever repeats), and each
group is packed by best-fit decreasing: a piece goes to the open bin it fills
best; if none has room, a bin is opened. Its size is chosen for all permitted
lengths together: each is filled, on trial, with the largest pieces still to
come that fit, and the one of least cost per token so held is opened. The same
group is also packed with each single length as the least to be opened; of
these whole plans the cheapest is kept (a sequence costs its length and
``sequence_cost``). At the end every bin shrinks to the smallest permitted
length that holds its contents.

A text's length is its words plus one end token; null and empty texts have the
end token alone."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import words

CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence besides its length, in tokens.
SEQUENCE_COST = 16
GROUP_ITEMS = 4096
#: Identical rows that one row becomes at a time.
COPIES = 1 << 14


def _filled(falling: np.ndarray, at: int, room: int) -> int:
    """Tokens that the largest fitting of the pieces ``falling[at:]``, one after another, put into ``room``."""
    held = 0
    while at < len(falling) and room - held > 0:
        at += int(np.searchsorted(-falling[at:], held - room))  # the first that fits
        # as many neighbours as fit, if they are equal
        if at < len(falling):
            n = int(falling[at])
            same = int(np.searchsorted(-falling[at:], -n, "right"))
            take = min(same, (room - held) // n)
            held += take * n
            at += same
    return held


def _pack(falling: np.ndarray, caps: list[int], sequence_cost: int, least: int | None) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each of the falling lengths, and the tokens of each
    bin. ``least``: the shortest bin to open; None chooses each by trial."""
    bins, offsets = [], []
    used: list[int] = []
    open_bins: list[tuple[int, int]] = []  # (room, bin), sorted
    for i, n in enumerate(falling.tolist()):
        at = bisect_left(open_bins, (n, -1))
        if at < len(open_bins):
            room, b = open_bins.pop(at)
        else:
            able = [c for c in caps if c >= max(n, least or 0)]
            if least is None and len(able) > 1:
                able.sort(key=lambda c: ((c + sequence_cost) / (n + _filled(falling, i + 1, c - n)), c))
            room, b = able[0], len(used)
            used.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += n
        if room > n:
            insort(open_bins, (room - n, b))
    return bins, offsets, used


def best_fit(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES, sequence_cost: int = SEQUENCE_COST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset in the bin and the bin's final capacity for each length:
    the cheapest of the plans (equal ones: the first)."""
    caps = sorted(capacities)
    order = np.argsort(-lengths, kind="stable")
    falling = lengths[order]
    if not len(lengths):
        return (np.zeros(0, np.int64),) * 3
    plans = (_pack(falling, caps, sequence_cost, least) for least in (None, *caps[::-1]))
    bins, offsets, used = min(plans, key=lambda p: sum(caps[bisect_left(caps, u)] + sequence_cost for u in p[2]))
    final = np.array([caps[bisect_left(caps, u)] for u in used], np.int64)
    out = np.empty((2, len(lengths)), np.int64)
    out[:, order] = bins, offsets
    return out[0], out[1], final[out[0]]


def pack(
    docs: DataFrame,
    capacities: tuple[int, ...] = CAPACITIES,
    text: str = "text",
    doc_id: str = "doc_id",
    sequence_cost: int = SEQUENCE_COST,
    group_items: int = GROUP_ITEMS,
) -> DataFrame:
    """Pieces of all documents in their bins: ``doc_id``, ``piece`` (from 0),
    ``start`` and ``length`` (tokens of the document), ``bin_id``, ``offset``
    in the bin and ``capacity`` of the bin. Every token is in exactly one
    piece. Repeated rows are packed as often as they come; an empty table
    gives no rows."""
    caps = tuple(sorted(capacities))
    top = caps[-1]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("__t"), (words(text) + 1).alias("__n"))
    # identical rows are counted first, then numbered, so that no group holds them all
    rows = rows.groupBy("doc_id", "__t", "__n").agg(F.count(F.lit(1)).alias("__c")).withColumn("__u", F.ceil(F.col("__n") / top))
    n = rows.agg(F.sum(F.col("__u") * F.col("__c"))).first()[0] or 0
    groups = max(1, -(-int(n) // group_items))
    for column, count in (("__c1", F.ceil(F.col("__c") / COPIES)), ("__c2", F.least(F.lit(COPIES), F.col("__c") - F.col("__c1") * COPIES)), ("piece", F.col("__u"))):
        rows = rows.select("*", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))).alias(column))
    pieces = rows
    pieces = pieces.select(
        "doc_id",
        "piece",
        (F.col("piece").cast("long") * top).alias("start"),
        F.least(F.lit(top).cast("long"), F.col("__n") - F.col("piece").cast("long") * top).alias("length"),
        F.pmod(F.xxhash64("doc_id", "__t", "__c1", "__c2", "piece"), F.lit(groups)).alias("__g"),
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # doc_id travels as it is: only lengths are computed on
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        b, o, c = best_fit(pdf["length"].to_numpy(np.int64), caps, sequence_cost)
        pdf["bin_id"] = pdf["__g"].astype(np.int64) * (1 << 32) + b
        pdf["offset"], pdf["capacity"] = o, c.astype(np.int64)
        return pdf.drop(columns="__g")

    kind = dict(docs.dtypes)[doc_id]
    schema = f"doc_id {kind}, piece int, start long, length long, bin_id long, offset long, capacity long"
    if kind in ("bigint", "int"):  # pandas has no nullable plain integers
        pieces = pieces.withColumn("doc_id", F.col("doc_id").cast("string"))
        out = pieces.groupBy("__g").applyInPandas(run, schema.replace(f"doc_id {kind}", "doc_id string", 1))
        return out.withColumn("doc_id", F.col("doc_id").cast(kind))
    return pieces.groupBy("__g").applyInPandas(run, schema)
