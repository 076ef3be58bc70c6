"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are bare lower-cased words. Their document counts by class are taken
over every labelled row that may be learned from; the ``terms`` with the
largest chi-square against the label are the vocabulary. Their IDF is over all
documents, labelled or not. Only the examples are a bounded sample: the first
``per_class`` rows of each class by a hash of the id, kept as an inverted
index over blocks of examples with the largest weight of
each term in each block. For a text, the blocks are bounded by the sum of its
term weights times those maxima, the best blocks are scored through their
postings, and then every other block whose bound reaches the k-th best
cosine: the k nearest are exact, ties to the smaller example id.

A neighbour votes with 1 / (distance + ``SOFTEN``), times how many labelled
rows of its class it stands for, so that the votes' share of toxic
neighbours is on the scale of the corpus; ``PRIOR`` votes at the corpus rate
keep texts without near examples there. Null texts, empty texts and texts
without a vocabulary term get the corpus rate."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches
from .tokens import PUNCTUATION, pieces, utf8, word_hashes

#: The README has the recall against vectors of all words.
TERMS = 2048
LEAST_DOCS = 3
#: Examples of label 0 and of label 1.
PER_CLASS = (6000, 3000)
NEIGHBOURS = 15
BLOCK = 64
FIRST_BLOCKS = 4
SOFTEN = 0.1
PRIOR = 0.5


@dataclass
class Index:
    """Examples as block postings. Postings of a term and block lie together:
    ``ends[term, block]`` bounds them in ``rows`` and ``weights``."""

    terms: np.ndarray  # hashes, ascending
    idf: np.ndarray
    peak: np.ndarray  # [term, block]
    starts: np.ndarray  # [term, block]
    ends: np.ndarray
    rows: np.ndarray
    weights: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    stands_for: np.ndarray  # rows of the corpus behind each example
    rate: float


def term_vectors(terms: np.ndarray, idf: np.ndarray, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit TF-IDF vectors (1 + log count) of all rows: term numbers, weights, offsets by row."""
    found, weights, n = [], [], []
    for lo, hi in pieces(at):
        w, of_row = word_hashes(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], PUNCTUATION)
        place = np.searchsorted(terms, w)
        place[place == len(terms)] = 0
        known = terms[place] == w if len(terms) else np.zeros(len(w), bool)
        row = np.repeat(np.arange(hi - lo), np.diff(of_row))[known]
        key, count = np.unique(row * max(len(terms), 1) + place[known], return_counts=True)
        row, term = key // max(len(terms), 1), key % max(len(terms), 1)
        weight = (1 + np.log(count)) * idf[term]
        norm = np.sqrt(np.bincount(row, weight * weight, minlength=hi - lo))
        found.append(term)
        weights.append(weight / norm[row])
        n.append(np.bincount(row, minlength=hi - lo))
    at = np.concatenate([[0], np.cumsum(np.concatenate(n))]) if n else np.zeros(1, np.int64)
    return np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*weights, np.zeros(0)]), at.astype(np.int64)


def build(terms, idf, term, weight, at, ids, labels, stands_for, rate: float, block: int = BLOCK) -> Index:
    """The index over examples given as term vectors (see ``term_vectors``)."""
    n, v = len(ids), len(terms)
    # like examples side by side, so that blocks differ: by class, then heaviest term
    size = np.diff(at)
    row = np.repeat(np.arange(n), size)
    by_weight = np.lexsort((-weight, row))
    lead = np.where(size > 0, np.append(term[by_weight], -1)[np.minimum(at[:-1], len(term))], -1)
    order = np.lexsort((ids, lead, labels))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    blocks = -(-n // block) if n else 0
    row = place[row]
    cell = term * max(blocks, 1) + row // block
    sort = np.lexsort((row, cell))
    cell, row, weight = cell[sort], row[sort], weight[sort]
    every = np.arange(v * blocks)
    starts, ends = np.searchsorted(cell, every), np.searchsorted(cell, every, "right")
    peak = np.zeros(v * blocks)
    if len(cell):
        np.maximum.at(peak, cell, weight)
    shape = (v, blocks)
    return Index(terms, idf, peak.reshape(shape), starts.reshape(shape), ends.reshape(shape), row, weight, ids[order], labels[order], stands_for[order], rate)


def nearest(index: Index, term: np.ndarray, weight: np.ndarray, k: int, first: int = FIRST_BLOCKS) -> tuple[np.ndarray, np.ndarray]:
    """Exact ``k`` nearest examples of positive cosine: places and cosines, nearest first."""
    n, blocks = len(index.ids), index.peak.shape[1]
    score = np.zeros(n)

    def add(chosen: np.ndarray) -> None:
        lo, hi = index.starts[term][:, chosen].ravel(), index.ends[term][:, chosen].ravel()
        size = hi - lo
        at = np.arange(int(size.sum())) + np.repeat(lo - (np.cumsum(size) - size), size)
        score[:] += np.bincount(index.rows[at], index.weights[at] * np.repeat(np.repeat(weight, len(chosen)), size), minlength=n)

    if not len(term) or not n:
        return np.zeros(0, np.int64), np.zeros(0)
    bound = weight @ index.peak[term]
    best = np.argpartition(-bound, min(first, blocks - 1))[:first]
    add(best)
    kth = np.partition(score, n - k)[n - k] if n >= k else 0.0
    rest = np.flatnonzero((bound >= kth - 1e-9) & (bound > 0))
    rest = rest[~np.isin(rest, best)]
    if len(rest):
        add(rest)
    places = np.flatnonzero(score > 0)
    if len(places) > k:  # all at or over the k-th, then ties by id
        limit = np.partition(score[places], len(places) - k)[len(places) - k]
        places = places[score[places] >= limit - 1e-12]
    order = np.lexsort((index.ids[places], -np.round(score[places], 12)))[:k]
    return places[order], np.minimum(score[places[order]], 1.0)


def vote(index: Index, places: np.ndarray, cosine: np.ndarray) -> float:
    """Share of distance-weighted votes for label 1."""
    w = 1 / (1 - cosine + SOFTEN) * index.stands_for[places]
    total = 1 / (1 + SOFTEN) * PRIOR * index.stands_for.mean() if len(index.ids) else 1.0
    return float((np.sum(w * index.labels[places]) + total * index.rate) / (np.sum(w) + total))


def inverse_frequencies(docs: DataFrame, text: str, terms: np.ndarray) -> np.ndarray:
    """IDF of ``terms`` (hashes, ascending) over all ``docs``. A task adds up
    its own counts, so that only one row of each task and term is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        total = np.zeros(len(known) + 1, np.int64)  # the last one counts documents
        for b in batches:
            term, _, at = term_vectors(known, np.ones(len(known)), *utf8(b.column("t")))
            total[:-1] += np.bincount(term, minlength=len(known))
            total[-1] += len(at) - 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(held), "n": pa.array(total[held])})

    found = docs.select(F.col(text).alias("t")).mapInArrow(counts, "term long, n long").groupBy("term").agg(F.sum("n")).collect()
    n = np.zeros(len(terms) + 1)
    for r in found:
        n[r[0]] = r[1]
    return np.log((1 + n[-1]) / (1 + n[:-1])) + 1


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    label: str = "toxic",
    key: str = "doc_id",
    terms: int = TERMS,
    per_class: tuple[int, int] = PER_CLASS,
) -> Index:
    """The index of documents that ``labels`` (``key``, ``label``) marks 0 or
    1. Labels that are null or neither, or without a document, teach nothing;
    without any label the score is 0.5 everywhere. Of several labels of one
    key the largest counts; of several documents of one key, each."""
    bound_batches(docs.sparkSession)
    marks = labels.select(F.col(key).alias("__k"), F.col(label).cast("int").alias("__y")).filter("__y IN (0, 1) AND __k IS NOT NULL")
    marks = marks.groupBy("__k").agg(F.max("__y").alias("__y"))
    # sorted and merged at every size: what is shuffled follows the input
    shown = docs.select(F.col(key).alias("__d"), F.col(text).alias("t")).join(marks.hint("merge"), F.col("__d") == F.col("__k"))
    known = shown.groupBy("__k", "__y").agg(F.count("*").alias("__n"))  # labelled documents
    total = {r[0]: r[1] for r in known.groupBy("__y").agg(F.sum("__n")).collect()}

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = utf8(b.column("t"))
            y = np.asarray(b.column("__y"))
            w, of_row = word_hashes(data, at, PUNCTUATION)
            row = np.repeat(np.arange(len(y)), np.diff(of_row))
            order = np.lexsort((row, w))
            w, row = w[order], row[order]
            new = np.ones(len(w), bool)
            new[1:] = (w[1:] != w[:-1]) | (row[1:] != row[:-1])
            w, row = w[new], row[new]
            term, start = np.unique(w, return_index=True)
            if len(term):
                n, n1 = np.diff(np.append(start, len(w))), np.add.reduceat(y[row].astype(np.int64), start)
                yield pa.RecordBatch.from_pydict({"term": pa.array(term.view(np.int64)), "n": pa.array(n.astype(np.int64)), "n1": pa.array(n1)})

    n, n1 = sum(total.values()), total.get(1, 0)
    none = np.zeros(0)
    rate = n1 / n if n else 0.5
    if len(total) < 2:
        return build(none.astype(np.uint64), none, none.astype(np.int64), none, np.zeros(1, np.int64), none.astype(np.int64), none, none, rate)
    df = shown.select("t", "__y").mapInArrow(counts, "term long, n long, n1 long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))
    # chi-square of the 2 x 2 table of term and label
    chi = f"{n}D * pow(n1 * ({n}D - n - {n1} + n1) - (n - n1) * ({n1}D - n1), 2) / (n * ({n}D - n) * {n1}D * {n - n1}D)"
    picked = df.filter(f"n >= {LEAST_DOCS} AND n < {n}").orderBy(F.expr(chi).desc(), "term").limit(terms).select("term").collect()
    hashes = np.sort(np.array([r["term"] for r in picked], np.int64).view(np.uint64))
    idf = inverse_frequencies(docs, text, hashes)
    shared = docs.sparkSession.sparkContext.broadcast((hashes, idf))  # ``terms`` numbers

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            term, weight, at = term_vectors(*shared.value, *utf8(b.column("t")))
            lists = [pa.LargeListArray.from_arrays(at, pa.array(x)).cast(pa.list_(k)) for x, k in ((term, pa.int64()), (weight, pa.float64()))]
            yield pa.RecordBatch.from_arrays([b.column("__d"), *lists], names=["id", "term", "weight"])

    rows = []
    for y in (0, 1):
        few = known.filter(F.col("__y") == y).select("__k", "__y").orderBy(F.xxhash64("__k"), "__k").limit(per_class[y])  # so few rows are broadcast
        there = docs.select(F.col(key).alias("__d"), F.col(text).alias("t")).join(F.broadcast(few), F.col("__d") == F.col("__k")).select("__d", "t")
        got = there.mapInArrow(vectors, f"id {dict(docs.dtypes)[key]}, term array<bigint>, weight array<double>")
        got = got.orderBy(F.xxhash64("id"), "id", F.hash("weight")).limit(per_class[y]).collect()
        rows += [(r["id"], r["term"], r["weight"], y, total[y] / len(got)) for r in got]
    at = np.concatenate([[0], np.cumsum([len(r[1]) for r in rows])]).astype(np.int64)
    return build(
        hashes, idf,
        np.array([x for r in rows for x in r[1]], np.int64), np.array([x for r in rows for x in r[2]], np.float64), at,
        np.array([r[0] for r in rows]), np.array([r[3] for r in rows], np.float64), np.array([r[4] for r in rows], np.float64), rate,
    )


def score_toxicity(docs: DataFrame, index: Index, text: str = "text", out: str = "score", k: int = NEIGHBOURS) -> DataFrame:
    """``docs`` with ``out`` (probability of label 1) and ``evidence``: the
    nearest examples (id as text, label, cosine), nearest first. Columns of
    these names are replaced. Each row is scored by itself: repeated rows have
    equal scores, null and empty texts the share of label 1, without evidence."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(index).values()))  # bounded by the sample and the vocabulary
    rows = docs.drop(out, "evidence")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Index(*shared.value)
        for b in batches:
            term, weight, at = term_vectors(known.terms, known.idf, *utf8(b.column(b.schema.get_field_index(text))))
            scores, places, cosines = [], [], []
            for lo, hi in zip(at[:-1], at[1:]):
                p, c = nearest(known, term[lo:hi], weight[lo:hi], k)
                scores.append(vote(known, p, c))
                places.append(p)
                cosines.append(c)
            ends = np.concatenate([[0], np.cumsum([len(p) for p in places])]).astype(np.int32)
            p = np.concatenate([*places, np.zeros(0, np.int64)])
            seen = pa.StructArray.from_arrays(
                [pa.array([str(x) for x in known.ids[p]], pa.string()), pa.array(known.labels[p].astype(np.int32)), pa.array(np.concatenate([*cosines, np.zeros(0)]))],
                names=["id", "label", "cosine"],
            )
            made = [pa.array(np.array(scores, np.float64)), pa.ListArray.from_arrays(pa.array(ends), seen)]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], names=[*b.schema.names, out, "evidence"])

    seen = T.StructType([T.StructField("id", T.StringType()), T.StructField("label", T.IntegerType()), T.StructField("cosine", T.DoubleType())])
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.DoubleType()), T.StructField("evidence", T.ArrayType(seen))])
    return rows.mapInArrow(run, schema)
