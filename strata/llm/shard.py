"""Sharding by minimax contiguous partition.

Rows with equal texts form an atomic group. Groups are ordered by the 64-bit
hash of their text and gathered into 2**16 ordered units (the top 16 bits of
that hash), so the ordered sizes fit on the driver whatever the input holds.
The smallest feasible shard capacity is found by binary search with a greedy
check over those sizes, and the order is cut there. Everything per row is
DataFrame expressions.

Null texts are one group of 16 bytes a row; empty texts another."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNIT_BITS = 16
#: Rows of a shard are numbered in so many independent cells.
CELLS = 1024


def _greedy(prefix: list[int], lo: int, hi: int, capacity: int) -> list[int] | None:
    """Starts of the shards that fill units [lo, hi) first-come up to
    ``capacity`` each; None if one unit alone is larger."""
    starts, at = [], lo
    while at < hi:
        end = bisect_right(prefix, prefix[at] + capacity, at, hi + 1) - 1
        if end == at:
            return None
        starts.append(at)
        at = end
    return starts


def _runs(prefix: list[int], starts: list[int]) -> list[tuple[int, int, int]]:
    return [(prefix[b] - prefix[a], a, b) for a, b in zip(starts, [*starts[1:], len(prefix) - 1])]


def _fewest(prefix: list[int], bounds: list[tuple[int, int]], shards: int) -> list[int]:
    """Starts under the smallest capacity that cuts the spans ``bounds`` into at most ``shards`` runs."""

    def plan(capacity: int) -> list[int] | None:
        starts = []
        for lo, hi in bounds:
            run = _greedy(prefix, lo, hi, capacity)
            if run is None:
                return None
            starts += run
        return starts if len(starts) <= shards else None

    lo, hi = 0, max(prefix[b] - prefix[a] for a, b in bounds)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if plan(mid) is None:
            lo = mid
        else:
            hi = mid
    return plan(hi)


def minimax_cuts(sizes: list[int], shards: int) -> list[int]:
    """Start unit of every shard (the first is 0): contiguous runs of
    ``sizes``, the largest run as small as possible.

    If a few units are larger than an equal share of what is left, a second
    plan gives each a shard of its own and searches the capacity of the runs
    between them; it is taken if its largest run is no larger, so that one
    huge group does not let the other shards fill up to its size. Spare shards
    halve the largest runs. Fewer starts than shards come back only if there
    are fewer non-empty units than shards."""
    prefix = [0, *accumulate(sizes)]
    used = [i for i, s in enumerate(sizes) if s]
    if len(used) <= shards:
        return [0, *used[1:]]
    starts = _fewest(prefix, [(0, len(sizes))], shards)
    alone: list[int] = []
    left, k = prefix[-1], shards
    for i in sorted(used, key=lambda i: -sizes[i]):
        if k == 1 or sizes[i] * k <= left:
            break
        alone.append(i)
        left, k = left - sizes[i], k - 1
    if alone:
        edges = [-1, *sorted(alone), len(sizes)]
        bounds = [(a + 1, b) for a, b in zip(edges, edges[1:]) if prefix[b] > prefix[a + 1]]
        if bounds and len(bounds) <= k:
            apart = sorted({*_fewest(prefix, bounds, k), *alone})
            if max(_runs(prefix, apart))[0] <= max(_runs(prefix, starts))[0]:
                starts = apart
    starts[0] = 0
    while len(starts) < shards:
        _, a, b = max(r for r in _runs(prefix, starts) if sum(x > 0 for x in sizes[r[1] : r[2]]) > 1)
        starts = sorted([*starts, min(range(a + 1, b), key=lambda c: max(prefix[c] - prefix[a], prefix[b] - prefix[c]))])
    return starts


def assign_shards(docs: DataFrame, shards: int = 40, text: str = "text", doc_id: str = "doc_id", overhead: int = 16) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes of the text plus ``overhead``),
    ``text_crc32`` (null for a null text), ``law`` ('bytes'), ``shard``,
    ``slot`` (gapless from 0 in each shard) and ``grown_shard`` (null: the law
    of sizes moves rows when shards are added). Columns of these names in
    ``docs`` are replaced. Equal texts share a shard. An empty table gives an
    empty result."""
    rows = docs.withColumns(
        {
            "size": (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(overhead)).cast("long"),
            "text_crc32": F.crc32(F.col(text).cast("binary")),
            "__unit": F.shiftrightunsigned(F.xxhash64(text), 64 - UNIT_BITS).cast("int"),
            "__cell": F.pmod(F.xxhash64(doc_id, F.crc32(F.col(text).cast("binary"))), F.lit(CELLS)).cast("int"),
        }
    )
    sizes = [0] * (1 << UNIT_BITS)
    for unit, total in rows.groupBy("__unit").agg(F.sum("size")).collect():  # at most 2**16 rows
        sizes[unit] = total
    starts = minimax_cuts(sizes, shards)
    shard = " + ".join(["0", *(f"cast(__unit >= {s} AS int)" for s in starts[1:])])
    rows = rows.withColumns({"law": F.lit("bytes"), "shard": F.expr(shard), "grown_shard": F.lit(None).cast("int")})
    # slots: rows before a cell from the counts of at most shards x CELLS cells, then numbers inside the cell
    cells = rows.groupBy("shard", "__cell").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("shard").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.select("shard", "__cell", F.coalesce(before, F.lit(0)).alias("__before"))
    at = F.row_number().over(Window.partitionBy("shard", "__cell").orderBy(doc_id, "text_crc32", "size"))
    return (
        rows.withColumn("__at", at)
        .join(cells, ["shard", "__cell"])
        .withColumn("slot", (F.col("__before") + F.col("__at") - 1).cast("long"))
        .drop("__unit", "__cell", "__at", "__before")
    )


def write_shards(docs: DataFrame, path: str, shards: int = 40, **names: str) -> None:
    """Write ``docs`` in folders ``shard=0`` ...; Spark may split a large shard over tasks (REBALANCE)."""
    out = assign_shards(docs, shards, **names)
    out.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
