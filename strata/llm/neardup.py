"""Near-duplicates by MinHash with tensored banding.

A document is the set of its distinct 5-word shingles. Small collections of
``ROWS`` minhashes each are computed; every pair of collections is a table, so
few minhashes make many tables, and two documents meet if they agree in at
least two collections. There are as many collections as it takes that a pair
just similar enough is missed with a probability below ``MISS`` (16 for 85
percent: 48 minhashes make 120 tables); more similar pairs are missed less. A collection's value that
only one set has cannot be part of a shared key, so keys are formed only from
the values that are shared.

Equal sets are one class before any of this (a pre-aggregated group by a
128-bit fingerprint). Every bucket names one centre; the components of these
stars are the groups within which classes can link. Links are confirmed on
full shingle sets, never on sketches: a group's sets are dealt into blocks of
about ``BLOCK_SHINGLES`` shingles, every pair of blocks meets in one task, and
the task returns the links of a spanning forest, at most one less than it has
classes. So no group is expanded into all its pairs, none is gathered in one
place however large, and no link between components is lost.

Texts that are null, empty or without words have an empty set and link with
nothing. A null id counts as larger than any id. Ids are whole numbers or
texts of such (any other fails the query); 2**63 - 1 stands for a null id and
comes back as null."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, stored
from .components import components
from .tokens import U, mix, pieces, shingle_hashes, utf8, word_hashes

WIDTH = 5
ROWS = 3
#: Probability of missing a pair that is just similar enough.
MISS = 1e-5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Shingles of a block; two blocks at most meet in a task.
BLOCK_SHINGLES = 250_000
#: Stands for a null id.
NO_ID = 2**63 - 1



def collections(percent: int) -> int:
    """Least number of collections of which fewer than two agree, at this similarity, with a probability below ``MISS``."""
    agree, m = (percent / 100) ** ROWS, 2
    while (1 - agree) ** m + m * agree * (1 - agree) ** (m - 1) > MISS:
        m += 1
    return m


def factors(m: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(7)).integers(0, 2**63, m * ROWS, dtype=np.uint64) * U(2) + U(1)


def sets_of(column: pa.Array, width: int = WIDTH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingle hashes of all rows, ascending within a row, and their offsets, piece by piece."""
    data, at = utf8(column)
    for lo, hi in pieces(at):
        w, of_row = word_hashes(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
        sh, ends = shingle_hashes(w, of_row, width)
        rows = [np.unique(sh[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        yield np.concatenate([*rows, np.zeros(0, U)]).astype(U), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)


def fingerprints(sets: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    """128 bits of each set; None for an empty one."""
    full = np.flatnonzero(np.diff(at) > 0)
    out: list[bytes | None] = [None] * (len(at) - 1)
    if len(full):
        a, b = (np.add.reduceat(mix(sets ^ U(c)), at[full]) for c in (0x243F6A8885A308D3, 0x13198A2E03707344))
        both = np.stack([mix(a), mix(b)], axis=1)
        for i, r in enumerate(full):
            out[r] = both[i].tobytes()
    return out


def band_values(sets: np.ndarray, at: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The value of each collection [row, collection] of the non-empty rows."""
    full = np.flatnonzero(np.diff(at) > 0)
    m = len(by) // ROWS
    out = np.zeros((len(full), m), U)
    if len(full):
        for c in range(m):
            value = np.full(len(full), U(c + 1))
            for r in range(ROWS):
                value = mix(value + np.minimum.reduceat(sets * by[c * ROWS + r], at[full]))
            out[:, c] = value
    return out


def signatures(docs: DataFrame, text: str, doc_id: str, percent: int) -> DataFrame:
    """``id``, ``th`` (hash of the text), ``n`` (set size), ``node`` (fingerprint) and ``bands``."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))
    by = factors(collections(percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, nodes, bands, ends = [], [], [], [0]
            for sets, at in sets_of(b.column("t")):
                size = np.diff(at)
                n.append(size)
                nodes += fingerprints(sets, at)
                bands.append(band_values(sets, at, by).ravel().view(np.int64))
                ends.extend(ends[-1] + np.cumsum((size > 0) * (len(by) // ROWS)))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*bands, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("th"), pa.array(np.concatenate([*n, np.zeros(0, np.int64)])), pa.array(nodes, pa.binary()), lists],
                names=["id", "th", "n", "node", "bands"],
            )

    return rows.mapInArrow(run, "id long, th long, n long, node binary, bands array<bigint>")


def stars(classes: DataFrame) -> DataFrame:
    """Links ``u``, ``v`` from the classes that share a table key to the bucket's centre."""
    cells = classes.select("node", "id", F.posexplode("bands").alias("i", "c"))
    shared = cells.groupBy("i", "c").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k")
    held = cells.join(shared, ["i", "c"]).groupBy("node", "id").agg(F.sort_array(F.collect_list(F.struct("i", "c"))).alias("h"))  # as many as collections at most
    pairs = "flatten(transform(sequence(0, size(h) - 2), a -> transform(sequence(a + 1, size(h) - 1), b -> xxhash64(h[a].i, h[b].i, h[a].c, h[b].c))))"
    keys = held.filter("size(h) > 1").select("node", "id", F.explode(F.expr(pairs)).alias("key"))
    many = keys.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.min(F.struct("id", "node")).alias("c")).filter("k > 1")
    return keys.join(many, "key").filter("node <> c.node").select(F.col("node").alias("u"), F.col("c.node").alias("v")).distinct()


def full_sets(docs: DataFrame, wanted: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``node``, ``n`` and ``set`` (ascending hashes) of the wanted classes, from one of their texts each."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))
    rows = rows.join(wanted.select("id", "th"), ["id", "th"], "left_semi").select("t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for sets, at in sets_of(b.column("t")):
                blobs = [sets[lo:hi].tobytes() for lo, hi in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fingerprints(sets, at), pa.binary()), pa.array(np.diff(at)), pa.array(blobs, pa.binary())], names=["node", "n", "set"]
                )

    return rows.mapInArrow(run, "node binary, n long, set binary").dropDuplicates(["node"])


def forest(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between sets of different ``side`` (of any sides, if there is but
    one) that join two components of such links; a spanning forest of them.

    A set's partners are looked up by its rarest shingles only: of two sets
    that link, each has more in common than it has left over, so some shingle
    is among the rarest of both. The sizes in common are then counted whole."""
    n = np.array([len(x) for x in sets], np.int64)
    every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    runs = np.diff(np.append(first, len(every)))
    # shared shingles only; each set's shingles from the rarest on
    run = np.repeat(np.arange(len(runs)), runs)
    held = runs[run] > 1
    who, run = owner[held], run[held]
    by = np.lexsort((run, runs[run], who))
    who, run = who[by], run[by]
    at = np.searchsorted(who, np.arange(len(sets) + 1))
    shared = np.diff(at)
    least = -(-percent * n // 100)
    prefix = (n - least + 1) - (n - shared)  # shingles of one set alone come first in its order
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def holders(runs_of: np.ndarray) -> np.ndarray:
        size = runs[runs_of]
        return owner[np.arange(int(size.sum())) + np.repeat(first[runs_of] - (np.cumsum(size) - size), size)]

    mixed = len(set(side.tolist())) > 1
    out = []
    for i in range(len(sets)):
        if prefix[i] <= 0:
            continue
        mine = run[at[i] : at[i + 1]]
        near = np.unique(holders(mine[: prefix[i]]))
        near = near[(near != i) & (100 * np.minimum(n[near], n[i]) >= percent * np.maximum(n[near], n[i]))]
        if mixed:
            near = near[side[near] != side[i]]
        here = find(i)
        near = np.array([j for j in near.tolist() if find(j) != here], np.int64)
        if not len(near):
            continue
        both = np.bincount(holders(mine), minlength=len(sets))[near]
        for j in near[100 * both >= percent * (n[near] + n[i] - both)].tolist():
            a, b = find(i), find(j)
            if a != b:
                root[a] = b
                out.append((i, j))
    return out


def confirmed(groups: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links ``u``, ``v`` that hold together each component of similar sets
    within the groups (``node``, ``root``)."""
    members = sets.select("node", "n").join(groups, "node")
    blocks = members.groupBy("root").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    members = members.join(blocks, "root").withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    meets = "transform(sequence(0, blocks - 1), o -> struct(least(o, b) AS lo, greatest(o, b) AS hi))"
    placed = members.select("node", "root", "b", F.explode(F.expr(meets)).alias("m")).select("node", "root", "b", "m.lo", "m.hi")

    def run(table: pa.Table) -> pa.Table:
        nodes, blobs = table.column("node").to_pylist(), table.column("set").to_pylist()
        order = sorted(range(len(nodes)), key=nodes.__getitem__)  # the same forest however the rows arrive
        found = forest([np.frombuffer(blobs[i], U) for i in order], np.asarray(table.column("b"))[order], percent) if nodes else []
        return pa.table({k: pa.array([nodes[order[x[side]]] for x in found], pa.binary()) for side, k in enumerate("uv")})

    rows = placed.join(sets.select("node", "set"), "node")
    return rows.select("root", "lo", "hi", "b", "node", "set").groupBy("root", "lo", "hi").applyInArrow(run, "u binary, v binary")


def linked(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """One row per document: ``id`` (``NO_ID`` for null), ``th``, ``n_shingles``,
    ``root`` (the class of sets it is linked to; null without words) and
    ``component`` (smallest id of it). An empty table gives no rows."""
    bound_batches(docs.sparkSession)
    rows = stored(signatures(docs, text, doc_id, percent), "signatures")
    classes = rows.filter("n > 0").groupBy("node").agg(F.min(F.struct("id", "th")).alias("r"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = stored(classes.select("node", "r.id", "r.th", "n", "bands"), "classes")
    groups = stored(components(stars(classes)), "groups")
    sets = stored(full_sets(docs, classes.join(groups, "node", "left_semi"), text, doc_id), "sets")
    roots = components(confirmed(groups, sets, percent))
    named = classes.select("node", "id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("id").alias("component"))
    named = named.join(least, "root").select("node", "root", "component")
    out = rows.select("id", "th", F.col("n").alias("n_shingles"), "node").join(named, "node", "left")
    return out.select("id", "th", "n_shingles", "root", F.coalesce("component", "id").alias("component"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``."""
    out = linked(docs, text, doc_id, percent)
    none = F.lit(NO_ID)
    return out.select(
        F.nullif("id", none).alias("doc_id"), "n_shingles", F.nullif("component", none).alias("component_id"), (F.col("id") == F.col("component")).alias("kept")
    )


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component (its smallest id; of repeated
    rows, one). Rows without words all stay."""
    out = linked(docs, text, doc_id, percent)
    one = out.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("id", "th")).alias("r")).select("r.id", "r.th", F.lit(False).alias("__all"))
    rest = out.filter("root IS NULL").select("id", "th", F.lit(True).alias("__all")).distinct()
    keys = one.unionByName(rest).withColumnsRenamed({"id": "__i", "th": "__t"})
    rows = docs.withColumns({"__id": F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)), "__th": F.xxhash64(text)})
    rows = rows.join(keys, (F.col("__id") == F.col("__i")) & (F.col("__th") == F.col("__t")))
    again = F.row_number().over(Window.partitionBy("__id", "__th").orderBy(F.lit(0)))
    once = rows.filter("NOT __all").withColumn("__at", again).filter("__at = 1").drop("__at")
    return once.unionByName(rows.filter("__all")).select(*docs.columns)


#: DuckDB SQL of the rows (all pairs of documents that share a shingle: for small tables).
ORACLE_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, len(sh)::BIGINT AS n_shingles, sh FROM s),
e AS (SELECT doc_id, n_shingles, unnest(sh) AS g FROM n),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n_shingles, b.n_shingles
  HAVING 100 * count(*) >= {PERCENT} * (a.n_shingles + b.n_shingles - count(*))),
r(u, v) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.u, p.v FROM r JOIN p ON p.u = r.v)
SELECT n.doc_id, n.n_shingles, c.m AS component_id, n.doc_id = c.m AS kept
FROM n JOIN (SELECT u, min(v) AS m FROM r GROUP BY u) c ON c.u = n.doc_id
"""
