"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of ``BLOCK`` bytes. All blocks are sorted
and each distinct one gets an integer name; then pairs of neighbouring names
are named in the same way (a name left over at the end pairs with none), until
each text has one name. Names are given by sorting whole blocks and whole
pairs, never by a hash, so two texts of as many blocks have one name if and
only if they are equal: no identity can collide.

Texts are worked on in chunks of a bounded number of bytes and blocks (a longer
text is a chunk of its own). A chunk sends each of its distinct blocks or pairs
once, to the task that its hash is dealt to; there they are sorted and named in
one sweep, and the names return to the chunk. So a block that a third of all
texts hold counts once a chunk, rows of a group never meet in one place, and
text moves through one shuffle only. Chunks are written to the shared folder at
each level, so their numbering is fixed whatever executor is lost.

A text of n blocks needs log2(n) levels; levels beyond the first hold texts of
several blocks only, 16 bytes a pair."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, stored
from .tokens import utf8

#: Bytes of a block.
BLOCK = 4096
#: Bytes and blocks at which a chunk is sent.
CHUNK_BYTES, CHUNK_BLOCKS = 32 << 20, 1 << 14

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: A row is a text (``at``: its number in the chunk; ``places``: which of the
#: chunk's blocks or pairs follow each other in it; ``name``: its one name, once
#: known), or a block or pair to be named (``at``: its place; ``block``: its bytes).
_ROW = "chunk long, at long, places array<long>, name long, blocks long, sha256 string, id {id}, block binary"


class _Chunk:
    """Texts of a task, with their distinct blocks or pairs."""

    def __init__(self):
        self.of: dict[bytes, int] = {}
        self.texts: list[tuple] = []  # at, places, name, blocks, sha256, id
        self.size = self.held = 0

    def place(self, parts: list[bytes]) -> list[int]:
        self.held += len(parts)
        return [self.of.setdefault(x, len(self.of)) for x in parts]

    def add(self, raw: bytes, doc_id) -> None:
        parts = [raw[i : i + BLOCK] for i in range(0, max(len(raw), 1), BLOCK)]
        self.texts.append((len(self.texts), self.place(parts), None, len(parts), hashlib.sha256(raw).hexdigest(), doc_id))
        self.size += len(raw)

    def table(self, chunk: int, schema: pa.Schema) -> pa.Table:
        n, m = len(self.texts), len(self.of)
        columns = [[chunk] * (n + m), *[[*x, *[None] * m] for x in zip(*self.texts)], [*[None] * n, *self.of]]
        columns[1][n:] = range(m)
        return pa.table([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)


def _arrow(rows: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(rows)


def first_chunks(docs: DataFrame, rows: T.StructType) -> DataFrame:
    """All rows of ``docs`` (key, text) in chunks, each distinct block of a chunk once."""
    schema = _arrow(rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, sent, held = TaskContext.get().partitionId(), 0, _Chunk()
        for b in batches:
            data, at = utf8(b.column(1))
            for r, doc_id in enumerate(b.column(0).to_pylist()):
                held.add(_LOWER[data[at[r] : at[r + 1]]].tobytes(), doc_id)
                if held.size >= CHUNK_BYTES or held.held >= CHUNK_BLOCKS:
                    yield from held.table((task << 32) + sent, schema).to_batches(1024)
                    sent, held = sent + 1, _Chunk()
        if held.texts:
            yield from held.table((task << 32) + sent, schema).to_batches(1024)

    return docs.mapInArrow(cut, rows)


def named(asked: DataFrame) -> DataFrame:
    """``chunk, at, given``: equal blocks of all chunks get one integer. Blocks
    are dealt by hash, sorted, and numbered in order in one sweep."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name, last = (TaskContext.get().partitionId() << 40) - 1, None
        for b in batches:
            out = np.empty(b.num_rows, np.int64)
            for i, block in enumerate(b.column(2).to_pylist()):
                if block != last:
                    name, last = name + 1, block
                out[i] = name
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out)], names=["chunk", "at", "given"])

    dealt = asked.repartition(F.xxhash64("block")).sortWithinPartitions("block")
    return dealt.mapInArrow(number, "chunk long, at long, given long")


def paired(texts: DataFrame, names: DataFrame, rows: T.StructType) -> DataFrame:
    """The chunks one level up: texts of one place have its name and are done,
    the others hold each distinct pair of their names once."""
    schema = _arrow(rows)

    def pair(of: pa.Table, given: pa.Table) -> pa.Table:
        name = np.zeros(given.num_rows, np.int64)
        name[np.asarray(given["at"])] = np.asarray(given["given"])
        up = _Chunk()
        for at, places, _, blocks, sha, doc_id in zip(*[of[c].to_pylist() for c in ("at", "places", "name", "blocks", "sha256", "id")]):
            x = name[places]
            if len(x) == 1:
                up.texts.append((at, None, int(x[0]), blocks, sha, doc_id))
                continue
            raw = np.append(x, [-1] * (len(x) % 2)).astype(">i8").tobytes()
            up.texts.append((at, up.place([raw[i : i + 16] for i in range(0, len(raw), 16)]), None, blocks, sha, doc_id))
        return up.table(of["chunk"][0].as_py(), schema)

    return texts.groupBy("chunk").cogroup(names.groupBy("chunk")).applyInArrow(pair, rows)


def identities(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of ``docs``: ``chunk`` and ``at`` (its number), ``id``
    (its key), ``sha256`` of the normalised text, and its identity, ``blocks``
    (how many) and ``name``: texts are equal if and only if both are."""
    spark = docs.sparkSession
    bound_batches(spark)
    kind = docs.schema[key].dataType.simpleString()
    rows = T.StructType.fromDDL(_ROW.format(id=kind))
    state, done = stored(first_chunks(docs.select(key, text), rows), "blocks"), []
    while not done or not state.filter("block is not null").isEmpty():
        names = named(state.filter("block is not null").select("chunk", "at", "block"))
        state = stored(paired(state.filter("places is not null").drop("block"), names, rows), "names")
        done.append(state.filter("name is not null").select("chunk", "at", "id", "sha256", "blocks", "name"))
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of ``docs``: its key, ``keep_id`` (the largest key
    among the rows of equal text), ``group_size`` (how many they are), ``kept``
    and ``text_sha256`` (of the normalised text, lowercase hex).

    Texts are equal when identical after lower-casing A-Z only; null counts as
    empty. Of each group just one row is kept, of repeated rows with the
    largest key any one. A null key is smaller than any other; a group of null
    keys only has a null ``keep_id``. An empty table gives an empty one."""
    rows = identities(docs, key, text)
    best = F.max(F.struct("id", "chunk", "at"))
    # a row for each group and chunk before anything meets: a hot group has no more than there are chunks
    local = rows.groupBy("chunk", "blocks", "name").agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
    groups = local.groupBy("blocks", "name").agg(F.max("best").alias("best"), F.sum("n").alias("n"))
    groups = local.select("chunk", "blocks", "name").join(groups, ["blocks", "name"])
    kept = (F.col("best.chunk") == F.col("chunk")) & (F.col("best.at") == F.col("at"))
    return rows.join(groups, ["chunk", "blocks", "name"]).select(
        F.col("id").alias(key), F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"), F.col("sha256").alias("text_sha256")
    )


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the kept row of each group only, all columns as they were."""
    az = "abcdefghijklmnopqrstuvwxyz"
    sha = F.sha2(F.translate(F.coalesce(F.col(text), F.lit("")), az.upper(), az).cast("binary"), 256)
    kept = exact_duplicates(docs, key, text).filter("kept").select(F.col(key).alias("__key"), F.col("text_sha256").alias("__kept"))
    rows = docs.withColumn("__sha", sha).dropDuplicates([key, "__sha"])
    return rows.join(kept, (F.col("__sha") == F.col("__kept")) & F.col(key).eqNullSafe(F.col("__key")), "left_semi").drop("__sha")


ORACLE_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""
