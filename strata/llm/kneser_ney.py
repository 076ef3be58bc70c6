"""Interpolated modified Kneser-Ney bigram model, counted in Spark and read through memory maps.

Tokens are lower-cased words and one end per text. Counting goes in shards
whose number follows the bytes of text, so that a shard stays small whatever
the input. Tasks add up their counts before anything is shuffled, and send
each shard sorted arrays. A bigram lies in the shard of its first word; words
so frequent that their shard would stick out (``HOT`` of an equal share) are
spread over all shards by the whole bigram, and their totals are added up
afterwards. Each shard is written as sorted hash arrays with raw counts to the
shared folder; workers map these files and search them, so a worker's memory
does not grow with the model.

With c the count of a bigram, D the discounts of Chen and Goodman's modified
form (from the counts of counts, one set per order) and N the numbers of
distinct continuations:

    P(w|v) = max(c(vw) - D(c), 0) / c(v) + g(v) P(w)
    P(w)   = max(N(.w) - D'(N), 0) / N(..) + g' / (V + 1)

g returns exactly the mass that the discounts take, so both sum to one over
the V words and one unknown. Null and empty texts are one end token."""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, scratch, stored
from .tokens import U, mix, pieces, utf8, word_hashes

#: Bytes of text that one shard of the counts stands for.
SHARD_BYTES = 12 << 20
#: Tokens that a task gathers before it sends counts.
GATHER = 2_500_000
#: A word is spread over the shards beyond this part of a shard's equal share.
HOT = 0.25

END, BEGIN = U(0xA3EC647659359ACD), U(0xC2B2AE3D27D4EB4F)
_WORD_FIELDS = [("word", "<u8"), ("count", "<i8"), ("total", "<i8"), ("left", "<i8"), ("n1", "<i8"), ("n2", "<i8"), ("n3", "<i8")]


# --- files in the shared folder -------------------------------------------------


def _plain(path: str) -> str | None:
    """The path without a file scheme; None if another scheme stores it."""
    m = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(?://(?=/))?(.*)", path)
    return path if not m else m[2] if m[1] == "file" else None


def put(path: str, *arrays: np.ndarray) -> None:
    """Write arrays one after another; the file appears whole or not at all."""
    plain = _plain(path)
    if plain is None:
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(path)
        store.create_dir(os.path.dirname(at))
        with store.open_output_stream(at) as f:
            for a in arrays:
                f.write(np.ascontiguousarray(a))
        return
    os.makedirs(os.path.dirname(plain), exist_ok=True)
    part = f"{plain}.{uuid.uuid4().hex}"
    with io.open(part, "wb") as f:
        for a in arrays:
            f.write(np.ascontiguousarray(a))
    os.replace(part, plain)


def mapped(path: str) -> np.ndarray:
    """The bytes of a file, mapped. Of a store without file paths, a worker
    first fetches its own copy."""
    plain = _plain(path)
    if plain is None:
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(path)
        with tempfile.NamedTemporaryFile() as f, store.open_input_stream(at) as src:
            while block := src.read(1 << 20):
                f.write(block)
            f.flush()
            return np.memmap(f.name, np.uint8, "r") if f.tell() else np.zeros(0, np.uint8)
    return np.memmap(plain, np.uint8, "r") if os.path.getsize(plain) else np.zeros(0, np.uint8)


# --- tokens ---------------------------------------------------------------------


def tokens(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words with an end after each text, their predecessors, and tokens per text; piece by piece."""
    data, at = utf8(column)
    for lo, hi in pieces(at):
        w, of_row = word_hashes(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
        n = np.diff(of_row)
        out = np.insert(w, of_row[1:], END)
        before = np.empty_like(out)
        before[1:] = out[:-1]
        before[np.cumsum(n + 1) - (n + 1)] = BEGIN
        yield out, before, n + 1


def shard_of(words: np.ndarray, shards: int) -> np.ndarray:
    """Ascending with the hash: sorted words lie shard by shard."""
    return ((words >> U(32)) * U(shards)) >> U(32)


def bigram_keys(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(v + U(0x9FB21C651E98DF25)) + w)


def bigram_shards(v: np.ndarray, keys: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    at = np.searchsorted(hot, v)
    at[at == len(hot)] = 0
    return np.where(hot[at] == v, shard_of(keys, shards), shard_of(v, shards))


def _beside(shard: np.ndarray, shards: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """An order by shard, then by as many bits of ``first`` and ``second`` as are left, in halves."""
    bits = 64 - max(1, (shards - 1).bit_length())
    low = bits // 2
    return (shard << U(bits)) | ((first >> U(8) & U((1 << (bits - low)) - 1)) << U(low)) | (second >> U(8) & U((1 << low) - 1))


def _totals(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values, first) if len(first) else values[:0]


def _blob(a: np.ndarray) -> pa.Array:
    return pa.array([np.ascontiguousarray(a).tobytes()], pa.binary())


def _joined(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in table.column(column)), kind)


def _cuts(sorted_shards: np.ndarray) -> list[tuple[int, int, int]]:
    found, start = np.unique(sorted_shards, return_index=True)
    return list(zip(found.tolist(), start.tolist(), [*start[1:].tolist(), len(sorted_shards)]))


# --- counting -------------------------------------------------------------------


def count_words(texts: DataFrame, shards: int) -> DataFrame:
    """``shard``, ``words``, ``counts``: the training counts of every word and the end."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def send():
            w, c = np.unique(np.concatenate(held), return_counts=True)
            for s, lo, hi in _cuts(shard_of(w, shards)):
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), _blob(w[lo:hi]), _blob(c[lo:hi].astype("<i8"))], names=["shard", "words", "counts"])

        for b in batches:
            for w, _, _ in tokens(b.column(0)):
                held.append(w)
                size += len(w)
                if size >= GATHER:
                    yield from send()
                    held, size = [], 0
        if held:
            yield from send()

    def merge(table: pa.Table) -> pa.Table:
        w, c = _totals(_joined(table, "words", U), _joined(table, "counts", "<i8"))
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "words": _blob(w), "counts": _blob(c)})

    kind = "shard int, words binary, counts binary"
    return texts.mapInArrow(count, kind).groupBy("shard").applyInArrow(merge, kind)


def hot_words(words: DataFrame, limit: float) -> list[int]:
    """Words counted more than ``limit`` times (so many at most as that goes into all tokens)."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w, c in zip(b.column("words"), b.column("counts")):
                w, c = np.frombuffer(w.as_buffer(), np.int64), np.frombuffer(c.as_buffer(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(w[c > limit])], names=["word"])

    return [r[0] for r in words.select("words", "counts").mapInArrow(pick, "word long").collect()]


def count_bigrams(texts: DataFrame, shards: int, hot: np.ndarray, folder: str) -> DataFrame:
    """Write each shard's bigram file. Comes back: ``shard`` (of a word), and
    for its words ``ctx`` (word, total, n1, n2, n3 as a context) and ``left``
    (word, number of distinct predecessors), in parts; ``counts``: how many
    bigrams were counted once, twice, three and four times; ``file``: the shard
    whose file was written, once for each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def send():
            v, w = (np.concatenate(x) for x in zip(*held))
            s = bigram_shards(v, bigram_keys(v, w), hot, shards)
            # by shard, then like pairs side by side (a pair split by equal bits is joined in the merge)
            order = np.argsort(_beside(s, shards, v, w))
            s, v, w = s[order], v[order], w[order]
            first = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (w[1:] != w[:-1]) | (s[1:] != s[:-1])]))
            c = np.diff(np.append(first, len(v))).astype("<u4")
            s, v, w = s[first], v[first], w[first]
            for sh, lo, hi in _cuts(s):
                run = np.flatnonzero(np.concatenate([[True], v[lo + 1 : hi] != v[lo : hi - 1]]))
                length = np.diff(np.append(run, hi - lo)).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([sh], pa.int32()), _blob(v[lo:hi][run]), _blob(length), _blob(w[lo:hi]), _blob(c[lo:hi])], names=["shard", "v", "runs", "w", "c"]
                )

        for b in batches:
            for w, v, _ in tokens(b.column(0)):
                held.append((v, w))
                size += len(w)
                if size >= GATHER:
                    yield from send()
                    held, size = [], 0
        if held:
            yield from send()

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        v, w = np.repeat(_joined(table, "v", U), _joined(table, "runs", "<u4")), _joined(table, "w", U)
        c = _joined(table, "c", "<u4").astype(np.int64)
        keys = bigram_keys(v, w)
        order = np.argsort(keys)
        keys, v, w, c = keys[order], v[order], w[order], c[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, v, w, c = keys[first], v[first], w[first], np.add.reduceat(c, first)
        put(f"{folder}/bigrams-{shard}", keys, c.astype("<i8"))
        ctx, of = np.unique(v, return_inverse=True)
        parts = np.stack([np.bincount(of, x, len(ctx)).astype("<i8") for x in (c, c == 1, c == 2, c > 2)], axis=1)
        word, left = np.unique(w, return_counts=True)
        counts = [int((c == i).sum()) for i in (1, 2, 3, 4)]
        rows = {"shard": [], "ctx": [], "parts": [], "left": [], "n": [], "counts": [], "file": []}
        to_ctx, to_word = ({s: (lo, hi) for s, lo, hi in _cuts(shard_of(x, shards))} for x in (ctx, word))
        for s in sorted({*to_ctx, *to_word}):
            (a, b), (x, y) = to_ctx.get(s, (0, 0)), to_word.get(s, (0, 0))
            got = (s, ctx[a:b].tobytes(), parts[a:b].tobytes(), word[x:y].tobytes(), left[x:y].astype("<i8").tobytes(), [0] * 4 if rows["shard"] else counts, None if rows["shard"] else shard)
            for k, value in zip(rows, got):
                rows[k].append(value)
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int32())
        return pa.table({k: pa.array(x, t) for (k, x), t in zip(rows.items(), kinds)})

    sent = texts.mapInArrow(count, "shard int, v binary, runs binary, w binary, c binary")
    return sent.groupBy("shard").applyInArrow(merge, "shard int, ctx binary, parts binary, left binary, n binary, counts array<bigint>, file int")


def write_words(words: DataFrame, stats: DataFrame, folder: str) -> DataFrame:
    """Write each shard's word file; comes back: per shard, counts of predecessor counts 1 to 4, of those over 2, their total, and the words counted (``of``), and the shard (``file``)."""

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        known, counts = _joined(table, "words", U), _joined(table, "counts", "<i8")
        ctx, parts = _joined(table, "ctx", U), _joined(table, "parts", "<i8").reshape(-1, 4)
        word, left = _totals(_joined(table, "left", U), _joined(table, "n", "<i8"))
        every = np.unique(np.concatenate([known, ctx, word]))
        out = np.zeros(len(every), _WORD_FIELDS)
        out["word"] = every
        out["count"][np.searchsorted(every, known)] = counts
        out["left"][np.searchsorted(every, word)] = left
        for k, name in enumerate(("total", "n1", "n2", "n3")):
            np.add.at(out[name], np.searchsorted(every, ctx), parts[:, k])
        put(f"{folder}/words-{shard}", out.view(np.uint8))
        of = [int((left == i).sum()) for i in (1, 2, 3, 4)] + [int((left > 2).sum()), int(left.sum()), int((out["count"] > 0).sum())]
        return pa.table({"of": pa.array([of], pa.list_(pa.int64())), "file": pa.array([shard], pa.int32())})

    none = F.lit(b"")
    a = words.select("shard", "words", "counts", *[none.alias(c) for c in ("ctx", "parts", "left", "n")])
    b = stats.select("shard", none.alias("words"), none.alias("counts"), "ctx", "parts", "left", "n")
    return a.unionByName(b).groupBy("shard").applyInArrow(merge, "of array<bigint>, file int")


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and over 2; thirds of the count where counts of counts are missing."""
    if not (n1 and n2):
        return 1 / 3, 2 / 3, 1.0
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return tuple(min(max(x, 0.1), i - 0.1) for i, x in enumerate(d, 1))


class Model:
    """Where the files are, and the sums that hold for all of them (a few
    numbers, the hot words and, a bit for each shard, which files were written)."""

    def __init__(self, folder: str, shards: int, hot: np.ndarray, tokens: int, words: int, d2, d1, left_total: int, back: float, written: dict):
        self.folder, self.shards, self.hot, self.tokens, self.words = folder, shards, hot, tokens, words
        self.d2, self.d1, self.left_total, self.back, self.written = d2, d1, left_total, back, written


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count all texts of ``docs`` and write the model's files to the shared folder."""
    spark = docs.sparkSession
    bound_batches(spark)
    folder = scratch(spark, "kneser-ney")
    texts = docs.select(text)
    size = texts.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = -(-size // SHARD_BYTES) + 1
    words = stored(count_words(texts, shards), "words")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(np.frombuffer(c.as_buffer(), "<i8").sum()) for c in b.column("counts")], pa.int64())], names=["n"])

    n = words.select("counts").mapInArrow(total, "n long").agg(F.sum("n")).first()[0] or 0
    hot = np.unique(np.array([*hot_words(words, HOT * n / shards), BEGIN.astype(np.int64)], np.int64).view(U))
    stats = stored(count_bigrams(texts, shards, hot, folder), "bigrams")
    n2 = stats.agg(*[F.sum(F.col("counts")[i]) for i in range(4)]).first()
    ends = write_words(words, stats, folder).collect()  # a row per shard
    of = [sum(x) for x in zip(*[r[0] for r in ends])] if ends else [0] * 7
    written = {"words": [r[1] for r in ends], "bigrams": [r[0] for r in stats.filter("file IS NOT NULL").select("file").collect()]}
    d2, d1 = discounts(*[x or 0 for x in n2]), discounts(*of[:4])
    back = (d1[0] * of[0] + d1[1] * of[1] + d1[2] * of[4]) / of[5] if of[5] else 1.0
    return Model(folder, shards, hot, n, of[6], d2, d1, of[5], back, {k: _bits(x, shards) for k, x in written.items()})


def _bits(places: list[int], n: int) -> np.ndarray:
    out = np.zeros(n, bool)
    out[places] = True
    return np.packbits(out)


# --- scoring --------------------------------------------------------------------


def _discount(count: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.where(count >= 3, d[2], np.where(count == 2, d[1], np.where(count == 1, d[0], 0.0)))


class Reader:
    """A worker's maps of a model's files."""

    def __init__(self, model: Model):
        self.m, self.maps = model, {}

    def file(self, kind: str, shard: int) -> np.ndarray:
        """The file of a shard; empty if nothing was counted there. One that was written and is gone raises."""
        name = f"{kind}-{shard}"
        if name not in self.maps:
            there = self.m.written[kind][shard >> 3] >> (7 - (shard & 7)) & 1
            self.maps[name] = mapped(f"{self.m.folder}/{name}") if there else np.zeros(0, np.uint8)
        return self.maps[name]

    def word_rows(self, words: np.ndarray) -> np.ndarray:
        """Rows of ascending words; zeros where unknown."""
        out = np.zeros(len(words), _WORD_FIELDS)
        for s, lo, hi in _cuts(shard_of(words, self.m.shards)):
            rows = self.file("words", s).view(_WORD_FIELDS)
            if len(rows):
                at = np.minimum(np.searchsorted(rows["word"], words[lo:hi]), len(rows) - 1)
                out[lo:hi] = np.where(rows["word"][at] == words[lo:hi], rows[at], out[lo:hi])
        return out

    def bigram_counts(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        keys = bigram_keys(v, w)
        s = bigram_shards(v, keys, self.m.hot, self.m.shards)
        bits = 64 - max(1, (self.m.shards - 1).bit_length())
        order = np.argsort((s << U(bits)) | (keys >> U(64 - bits)))
        out = np.zeros(len(keys), np.int64)
        for sh, lo, hi in _cuts(s[order]):
            raw = self.file("bigrams", sh)
            n = len(raw) // 16
            if n:
                known, count = raw[: 8 * n].view(U), raw[8 * n :].view("<i8")
                here = order[lo:hi]
                at = np.minimum(np.searchsorted(known, keys[here]), n - 1)
                out[here] = np.where(known[at] == keys[here], count[at], 0)
        return out

    def score(self, w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability, base log10 probability and whether known, of each token after its predecessor."""
        m = self.m
        every, where = np.unique(np.concatenate([w, v]), return_inverse=True)
        rows = self.word_rows(every)
        # of each word: its lower-order probability, and as a context its total and returned mass
        lower = np.maximum(rows["left"] - _discount(rows["left"], m.d1), 0) / max(m.left_total, 1) + m.back / (m.words + 1)
        total = rows["total"]
        mass = np.where(total > 0, (m.d2[0] * rows["n1"] + m.d2[1] * rows["n2"] + m.d2[2] * rows["n3"]) / np.maximum(total, 1), 1.0)
        at, before = where[: len(w)], where[len(w) :]
        pair, pair_of = np.unique(before.astype(np.int64) * len(every) + at, return_inverse=True)
        count = self.bigram_counts(every[pair // len(every)], every[pair % len(every)])[pair_of]
        p = np.maximum(count - _discount(count, m.d2), 0) / np.maximum(total[before], 1) + mass[before] * lower[at]
        seen = rows["count"][at]
        return np.log10(p), np.log10((seen + 0.1) / (m.tokens + 0.1 * (m.words + 1))), seen > 0


def score_texts(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` (log10 probability of the text) and ``perplexity`` (10 ** (-score
    / n_tokens)). Columns of these names are replaced."""
    bound_batches(docs.sparkSession)
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    rows = docs.drop(*names)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))
    fields = ("folder", "shards", "hot", "tokens", "words", "d2", "d1", "left_total", "back", "written")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Model(**dict(zip(fields, shared.value))))
        for b in batches:
            out = []
            for w, v, n in tokens(b.column(b.schema.get_field_index(text))):
                p, base, known = reader.score(w, v)
                start = np.cumsum(n) - n
                sums = [np.add.reduceat(x, start) for x in (known.astype(np.int64), base, p)]
                out.append((n, sums[0], np.full(len(n), reader.m.tokens), sums[1], sums[2], 10 ** (-sums[2] / n)))
            made = [pa.array(np.concatenate(x)) for x in zip(*out)] if out else [pa.array(np.zeros(0, t)) for t in (np.int64,) * 3 + (float,) * 3]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], names=[*b.schema.names, *names])

    kinds = [T.LongType()] * 3 + [T.DoubleType()] * 3
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *[T.StructField(n, k) for n, k in zip(names, kinds)]]))


def perplexities(docs: DataFrame, learn: Column, text: str = "text") -> DataFrame:
    """Train on the rows where ``learn`` holds, score all rows."""
    return score_texts(docs, train(docs.filter(learn), text), text)
