"""Quality classifier: a byte-level convolutional network in numpy.

Filters look at ``WIDTH`` consecutive bytes of the UTF-8 text. A text is read
whole, in chunks of two ``CELL``-byte cells that overlap by one cell. Each
filter's responses are max-pooled over a chunk; the chunks of a text are
pooled by maximum and by mean, and one logistic unit combines both into a
probability.

The network is fitted to a bounded sample of labelled rows: ``per_class`` rows
of each class, the first by a hash of the id. Their whole texts are written to
the shared folder and come to the driver in parts of about ``BUFFER`` rows,
shuffled ``BUFFER_BYTES`` at a time; parts beyond ``HOLD_BYTES`` are read anew
in each epoch. Responses are computed some cells at a time, so the driver
holds no more than those bytes and one part. The intercept is
then set back to the class shares of all labelled documents that may be
learned from. Scoring reads every byte of every text.

Null and empty texts are scored as one blank cell."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, stored
from .tokens import utf8

WIDTH = 6
FILTERS = 16
CELL = 128
PER_CLASS = 2500
EPOCHS = 6
#: Steps that a fit takes at least; few examples are gone through more often.
LEAST_STEPS = 240
#: Texts, and bytes of text, that the fit holds and shuffles at a time.
BUFFER, BUFFER_BYTES = 1024, 16 << 20
#: Bytes of text that the driver keeps between epochs; further parts are read again.
HOLD_BYTES = 64 << 20


@dataclass
class Network:
    """``bytes_`` [place, byte, filter], ``bias`` [filter], ``out`` [2 x filter], ``base``."""

    bytes_: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    base: float

    def pairs(self) -> np.ndarray:
        """Responses to two neighbouring bytes (low byte first), for each even place."""
        t = self.bytes_
        return np.stack([(t[j][None, :, :] + t[j + 1][:, None, :]).reshape(65536, -1) for j in range(0, WIDTH, 2)]).astype(np.float32)


def blank(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after another, each ended by at least ``WIDTH`` zero bytes and
    filled up to whole cells; the cell where each begins, and the end."""
    cells = np.array([(len(t) + WIDTH + CELL - 1) // CELL for t in texts], np.int64)
    at = np.concatenate([[0], np.cumsum(cells)])
    out = np.zeros(int(at[-1]) * CELL, np.uint8)
    for t, a in zip(texts, at):
        out[a * CELL : a * CELL + len(t)] = t
    return out, at


def cell_maxima(pairs: np.ndarray, data: np.ndarray, at: np.ndarray, step: int = 512) -> np.ndarray:
    """Largest response of each filter in each cell; windows end with their text's last cell."""
    n = len(data) // CELL
    last = np.zeros(n, bool)
    last[at[1:] - 1] = True
    out = np.empty((n, pairs.shape[2]), np.float32)
    data = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
    for lo in range(0, n, step):
        hi = min(lo + step, n)
        b = data[lo * CELL : hi * CELL + WIDTH].astype(np.uint16)
        two = b[:-1] | (b[1:] << np.uint16(8))
        size = (hi - lo) * CELL
        got = pairs[0][two[:size]]
        for k in range(1, len(pairs)):
            got += pairs[k][two[2 * k : 2 * k + size]]
        got = got.reshape(hi - lo, CELL, -1)
        got[last[lo:hi], CELL - WIDTH + 1 :] = -np.inf
        out[lo:hi] = got.max(axis=1)
    return out


def chunk_maxima(cells: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maxima of overlapping chunks (cells k and k+1 of the same text; a
    one-cell text is one chunk), and the chunk where each text begins."""
    n = np.maximum(np.diff(at) - 1, 1)
    start = np.concatenate([[0], np.cumsum(n)])
    first = np.arange(start[-1]) - np.repeat(start[:-1], n) + np.repeat(at[:-1], n)
    second = np.minimum(first + 1, np.repeat(at[1:], n) - 1)
    return np.maximum(cells[first], cells[second]), start


def probabilities(net: Network, pairs: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    data, at = blank(texts)
    chunks, start = chunk_maxima(cell_maxima(pairs, data, at), at)
    h = np.maximum(chunks + net.bias, 0).astype(np.float64)
    top = np.maximum.reduceat(h, start[:-1], axis=0)
    mean = np.add.reduceat(h, start[:-1], axis=0) / np.diff(start)[:, None]
    z = (np.hstack([top, mean]) * net.out).sum(axis=1) + net.base  # each text by itself
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def peaks(bytes_: np.ndarray, data: np.ndarray, at: np.ndarray, step: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """As ``cell_maxima``, from the filters themselves: the largest response of each filter in each cell, and its place."""
    n = len(data) // CELL
    last = np.zeros(n, bool)
    last[at[1:] - 1] = True
    cells, where = np.empty((n, FILTERS), np.float32), np.empty((n, FILTERS), np.int64)
    padded = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
    for lo in range(0, n, step):
        hi = min(lo + step, n)
        size = (hi - lo) * CELL
        got = sum(bytes_[j][padded[lo * CELL + j : lo * CELL + j + size]] for j in range(WIDTH)).reshape(hi - lo, CELL, -1)
        got[last[lo:hi], CELL - WIDTH + 1 :] = -np.inf
        best = got.argmax(axis=1)
        cells[lo:hi] = np.take_along_axis(got, best[:, None, :], 1)[:, 0, :]
        where[lo:hi] = best + (np.arange(lo, hi) * CELL)[:, None]
    return cells, where


def loss(net: Network, texts: list[np.ndarray], labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy of whole texts, and its gradient by ``bytes_``, ``bias``, ``out`` and ``base``;
    it reaches the bytes at each chunk's maximum."""
    data, at = blank(texts)
    cells, where = peaks(net.bytes_.astype(np.float32), data, at)
    n = np.maximum(np.diff(at) - 1, 1)
    start = np.concatenate([[0], np.cumsum(n)])
    first = np.arange(start[-1]) - np.repeat(start[:-1], n) + np.repeat(at[:-1], n)
    second = np.minimum(first + 1, np.repeat(at[1:], n) - 1)
    later = cells[second] > cells[first]
    chunks, place = np.where(later, cells[second], cells[first]), np.where(later, where[second], where[first])
    h = np.maximum(chunks + net.bias, 0).astype(np.float64)
    top = np.maximum.reduceat(h, start[:-1], axis=0)
    x = np.hstack([top, np.add.reduceat(h, start[:-1], axis=0) / n[:, None]])
    z = np.clip(x @ net.out + net.base, -30, 30)
    p = 1 / (1 + np.exp(-z))
    dz = (p - labels) / len(texts)
    dx = dz[:, None] * net.out[None, :]
    doc = np.repeat(np.arange(len(texts)), n)
    peak = (h == top[doc]) & (h > 0)
    share = np.maximum(np.add.reduceat(peak.astype(np.float64), start[:-1], axis=0), 1)
    dh = np.where(h > 0, dx[doc, FILTERS:] / n[doc][:, None], 0) + np.where(peak, (dx[:, :FILTERS] / share)[doc], 0)
    grad = np.zeros_like(net.bytes_)
    f = np.broadcast_to(np.arange(FILTERS), place.shape)
    padded = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
    for j in range(WIDTH):
        np.add.at(grad[j], (padded[place + j], f), dh)
    cost = float(np.mean(np.logaddexp(0, z) - labels * z))
    return cost, [grad, dh.sum(axis=0), x.T @ dz, np.array([dz.sum()])]


def shuffled(rows: Iterable[tuple[np.ndarray, float]], rng: np.random.Generator, batch: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Batches of a stream of (text, label), shuffled within bounded buffers."""
    held, size = [], 0

    def send():
        order = rng.permutation(len(held))
        for lo in range(0, len(order), batch):
            pick = [held[i] for i in order[lo : lo + batch]]
            yield [t for t, _ in pick], np.array([y for _, y in pick])

    for row in rows:
        held.append(row)
        size += len(row[0])
        if len(held) >= BUFFER or size >= BUFFER_BYTES:
            yield from send()
            held, size = [], 0
    if held:
        yield from send()


def fit(rows: Callable[[], Iterable[tuple[np.ndarray, float]]], n: int, epochs: int = EPOCHS, batch: int = 32, rate: float = 0.01, seed: int = 3) -> Network:
    """Adam on the cross-entropy of ``n`` (text, label) that ``rows()`` streams
    anew for each of ``epochs`` (more, until ``LEAST_STEPS`` are taken)."""
    rng = np.random.Generator(np.random.PCG64(seed))
    net = Network(rng.normal(0, 0.3, (WIDTH, 256, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.3, 2 * FILTERS), 0.0)
    net.bytes_[:, 0] = 0
    state = [np.zeros_like(x) for x in (net.bytes_, net.bias, net.out)] + [np.zeros(1)]
    speed = [np.zeros_like(x) for x in state]
    each = max(1, -(-n // batch))
    epochs = max(epochs, -(-LEAST_STEPS // each))
    step, steps = 0, epochs * each
    for _ in range(epochs):
        for texts, labels in shuffled(rows(), rng, batch):
            _, grads = loss(net, texts, labels)
            grads[0] += 1e-4 * net.bytes_ / WIDTH
            grads[2] += 1e-4 * net.out
            step += 1
            now = rate * max(1 - 0.9 * step / steps, 0.1)
            moved = []
            for k, g in enumerate(grads):
                state[k] = 0.9 * state[k] + 0.1 * g
                speed[k] = 0.99 * speed[k] + 0.01 * g * g
                moved.append(now * (state[k] / (1 - 0.9**step)) / (np.sqrt(speed[k] / (1 - 0.99**step)) + 1e-8))
            net.bytes_ -= moved[0]
            net.bias -= moved[1]
            net.out -= moved[2]
            net.base -= float(moved[3][0])
    return net


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id", per_class: int = PER_CLASS) -> Network:
    """Fit on the documents that ``labels`` (``key``, ``label``) marks 0 or 1:
    ``per_class`` of each class, the first by a hash of ``key``, whole texts.
    One class alone (or none) gives a constant. Labels that are null or
    neither 0 nor 1, or without a document, teach nothing: they are joined to
    the documents before anything is counted or picked. Of several labels of
    one key the largest counts; of several documents of one key, each."""
    marks = labels.select(F.col(key).alias("__k"), F.col(label).cast("int").alias("__y")).filter("__y IN (0, 1) AND __k IS NOT NULL")
    marks = marks.groupBy("__k").agg(F.max("__y").alias("__y"))
    # ids only: the texts are read for the rows picked
    known = docs.select(F.col(key).alias("__d")).join(marks, F.col("__d") == F.col("__k")).groupBy("__k", "__y").agg(F.count(F.lit(1)).alias("__n"))
    known = stored(known, "labelled")
    shares = {r[0]: r[1] for r in known.groupBy("__y").agg(F.sum("__n")).collect()}
    if len(shares) < 2:
        base = float(np.log((shares.get(1, 0) + 0.5) / (shares.get(0, 0) + 0.5)))
        return Network(np.zeros((WIDTH, 256, FILTERS)), np.zeros(FILTERS), np.zeros(2 * FILTERS), base)
    sample = None
    for y in (0, 1):
        picked = known.filter(F.col("__y") == y).orderBy(F.xxhash64("__k"), "__k").limit(per_class).select("__k", "__y")  # so few rows are broadcast
        there = docs.select(F.col(key).alias("__d"), F.coalesce(F.col(text), F.lit("")).alias("b")).join(F.broadcast(picked), F.col("__d") == F.col("__k"))
        there = there.orderBy(F.xxhash64("__k"), "__k", F.xxhash64("b")).limit(per_class).select("__k", "b", "__y")
        sample = there if sample is None else sample.unionAll(there)
    # in parts of about BUFFER rows, dealt by hash, which mix the classes
    parts = -(-sum(min(per_class, x) for x in shares.values()) // BUFFER)
    sample = stored(sample.withColumns({"__h": F.xxhash64("__k"), "__p": F.pmod(F.xxhash64(F.lit("part"), "__k"), F.lit(parts))}), "examples")
    taken = {r[0]: r[1] for r in sample.groupBy("__y").count().collect()}

    held, size = {}, 0  # parts read, up to HOLD_BYTES

    def rows() -> Iterator[tuple[np.ndarray, float]]:
        nonlocal size
        for part in range(parts):
            got = held.get(part)
            if got is None:
                got = sorted(tuple(r) for r in sample.filter(F.col("__p") == part).select("__h", "b", "__y").collect())
                more = sum(len(t) for _, t, _ in got)
                if size + more <= HOLD_BYTES:
                    held[part], size = got, size + more
            for _, text, y in got:
                yield np.frombuffer(text.encode(), np.uint8), float(y)

    net = fit(rows, sum(taken.values()))
    net.base += float(np.log(shares[1] / shares[0]) - np.log(taken[1] / taken[0]))
    return net


def score_quality(docs: DataFrame, net: Network, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in ``out`` (replaced if present)."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(net).values()))  # a few hundred KB, whatever the input
    rows = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network(*shared.value)
        pairs = model.pairs()
        for b in batches:
            data, at = utf8(b.column(b.schema.get_field_index(text)))
            scores, held, size = [], [], 0
            for lo, hi in zip(at[:-1], at[1:]):
                held.append(data[lo:hi])
                size += hi - lo
                if size > 1 << 20:
                    scores.append(probabilities(model, pairs, held))
                    held, size = [], 0
            scores.append(probabilities(model, pairs, held))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(scores), pa.float64())], names=[*b.schema.names, out])

    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.DoubleType())])
    return rows.mapInArrow(run, schema)
