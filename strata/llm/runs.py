"""Periodic runs of words, found by catchers over completed power-of-two blocks.

A run of period q is a stretch in which every word equals the word q places
before it, q is the smallest such period, the stretch is at least
``max(LEAST, TIMES * q)`` words long, and no neighbouring word extends it.

Once the words ``[a, a + 2**k)`` of a block of level k have come in, the block
has a catcher. While the next ``2**k`` suffixes begin, it compares the last
``2**k`` words appended with its block; where they are equal, a square of a
period q in ``[2**k, 2**(k+1))`` is under way. A run of four periods or more
holds a whole aligned block and its copy q later, so none escapes. Squares of
one period caught by neighbouring blocks merge into one stretch, whose two
ends lie less than a block away and are found by comparing shrinking blocks.
A catch inside a known run of a smaller period repeats that run and is left
out.

Every appended word meets one catcher of each level. The words of a batch of
texts are appended together, so that the comparisons of a level are one numpy
expression: O(n log n) for n words whatever they are, and 8 n bytes of block
values for each level up to the longest period there can be. Blocks are
compared by 64-bit values; every run is then checked word by word, and the
batch is read anew with other values should a check ever fail, so results are
exact."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches
from .tokens import U, mix, pieces, utf8

#: A run has at least so many words, and at least so many periods.
LEAST, TIMES = 6, 4

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
_SPACE = U(0x9E3779B97F4A7C15)


def _extend(values: list[np.ndarray], at: np.ndarray, period: np.ndarray, bound: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on (``step`` 1) or before ``at`` (``step`` -1)
    equal those a period later, while they stay within ``bound``; fewer than
    the blocks of the next level hold."""
    out = np.zeros(len(at), np.int64)
    for level in range(len(values) - 1, -1, -1):
        size, value = 1 << level, values[level]
        first = at + out if step > 0 else at - out - size
        inside = first + period + size <= bound if step > 0 else first >= bound
        first = np.where(inside, first, 0)
        later = np.where(inside, first + period, 0)
        out += np.where(inside & (value[first] == value[later]), size, 0)
    return out


def _catch(ids: np.ndarray, ends: np.ndarray, least: int, times: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Starts, ends and periods of all runs; None if two unlike blocks had one value."""
    n = len(ids)
    lens = np.diff(ends, prepend=0)
    stop, begin = np.repeat(ends, lens), np.repeat(ends - lens, lens)  # of the text of each word
    value = mix(ids.astype(np.uint64) * _SPACE + U(seed))
    below: list[np.ndarray] = []  # block values of the levels before
    covered = np.zeros(n, np.int64)  # furthest end of a run so far that holds the word
    found = []
    size = 1
    longest = int(lens.max(initial=0))
    while size * times <= longest:
        # the catcher of the block before meets the suffixes that begin in a block
        met = n - 2 * size + 1
        hits = np.flatnonzero(value[size : size + met] == np.repeat(value[::size], size)[:met]) + size
        block = (hits // size - 1) * size
        keep = (hits + size <= stop[block]) & (hits + size > covered[block])
        block, period = block[keep], hits[keep] - block[keep]
        if len(block):
            order = np.lexsort((block, period))
            block, period = block[order], period[order]
            new = np.concatenate([[True], (period[1:] != period[:-1]) | (block[1:] != block[:-1] + size)])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(block)) - 1
            period = period[first]
            left, right = block[first], block[last] + size
            left = left - _extend(below, left, period, begin[left], -1)
            right = right + period + _extend(below, right, period, stop[block[last]], 1)
            keep = right - left >= np.maximum(least, times * period)
            for a, b, q in zip(left[keep].tolist(), right[keep].tolist(), period[keep].tolist()):
                if not np.array_equal(ids[a : b - q], ids[a + q : b]):
                    return None
                found.append((a, b, q))
            for a, b, _ in found[len(found) - int(keep.sum()) :]:
                np.maximum(covered[a:b], b, out=covered[a:b])
        below.append(value)
        if n < 2 * size:
            break
        value = mix(value[: n - 2 * size + 1] * U(0xD6E8FEB86659FD93) + mix(value[size:] + U(size)))
        size *= 2
    return tuple(np.array(x, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def runs(ids: np.ndarray, ends: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of all runs of the words ``ids`` (equal words
    have equal numbers) of texts that end before the places ``ends``; ordered
    by start, then period."""
    if times < 4:
        raise ValueError("a catcher needs runs of four periods at least")
    seed = 1
    while (got := _catch(ids, ends, least, times, seed)) is None:
        seed += 1
    order = np.lexsort((got[2], got[0]))
    return tuple(x[order] for x in got)


def _batch(column: pa.Array, least: int, times: int) -> Iterator[tuple[list[list[dict]], list[str], list[int]]]:
    """Runs, collapsed text and number of words of each text, piece by piece."""
    data, at = utf8(column)
    for lo, hi in pieces(at):
        words = [bytes(data[at[r] : at[r + 1]]).split() for r in range(lo, hi)]
        every = [w for x in words for w in x]
        ends = np.cumsum([len(x) for x in words])
        ids = np.asarray(pa.array(every, pa.binary()).dictionary_encode().indices) if every else np.zeros(0, np.int64)
        start, end, period = runs(ids.astype(np.int64), ends, least, times)
        of = np.searchsorted(ends, start, "right")
        found, collapsed = [[] for _ in words], [b" ".join(x) for x in words]
        for r in np.unique(of).tolist():
            base = int(ends[r]) - len(words[r])
            drop = np.zeros(len(words[r]), bool)
            for i in np.flatnonzero(of == r).tolist():
                a, b, q = int(start[i]) - base, int(end[i]) - base, int(period[i])
                found[r].append({"start": a, "length": b - a, "period": q})
                drop[a + q : b] = True
            collapsed[r] = b" ".join(w for w, d in zip(words[r], drop.tolist()) if not d)
        yield found, [x.decode() for x in collapsed], [len(x) for x in words]


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length and period of every
    run in words of the text, by start, then period) and ``collapsed`` (the
    words without those that any run holds after its first period, joined by
    one space). Columns of these names are replaced.

    Words are runs of bytes other than space and \\t \\n \\v \\f \\r, told apart by
    case. Null, empty and wordless texts have no run and an empty collapsed
    text. Each row is worked on by itself, so repeated rows give like results
    and an empty table an empty one; a text is never cut."""
    bound_batches(docs.sparkSession)
    names = ["n_words", "runs", "collapsed"]
    rows = docs.drop(*[n for n in names if n != text])
    kinds = (pa.int64(), pa.list_(pa.struct([(n, pa.int64()) for n in RUN.names])), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = ([], [], [])
            for found, collapsed, n in _batch(b.column(b.schema.get_field_index(text)), least, times):
                for column, more in zip(out, (n, found, collapsed)):
                    column += more
            made = [pa.array(x, k) for x, k in zip(out, kinds)]
            kept = [(c, x) for c, x in zip(b.schema.names, b.columns) if c not in names]
            yield pa.RecordBatch.from_arrays([*[x for _, x in kept], *made], names=[*[c for c, _ in kept], *names])

    fields = [f for f in rows.schema.fields if f.name not in names]
    types = [T.LongType(), T.ArrayType(RUN, False), T.StringType()]
    return rows.mapInArrow(run, T.StructType([*fields, *[T.StructField(n, k) for n, k in zip(names, types)]]))


def longest(runs: str = "runs"):
    """The run of greatest length (ties: smallest start, then smallest period) as start, length, period; null without runs."""
    by = f"array_max(transform({runs}, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))"
    return F.expr(f"transform(array({by}), r -> if(r is null, null, struct(-r.start AS start, r.length AS length, -r.period AS period)))[0]")


def looped(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with loops planted in about a tenth of the texts, picked by
    h = crc32 of the decimal key: where h % 10 = 0 and the text has n > 0
    words, every word i >= a is word a + (i - a) % p, with g = h div 10,
    a = g % n and p = 1 + (n - a) div (3 + g % 8). Such texts come back with
    one space between words, all others as they were (a null key: as it was)."""
    h = f"crc32(cast(cast(`{key}` AS string) AS binary))"
    made = (
        f"transform(array(named_struct('w', regexp_extract_all(`{text}`, '[^\\\\x20\\\\x09-\\\\x0D]+', 0), 'g', {h} div 10)), "
        "s -> named_struct('w', s.w, 'n', size(s.w), 'g', s.g, 'a', if(size(s.w) > 0, s.g % size(s.w), 0)))[0]"
    )
    loop = (
        f"transform(array({made}), s -> array_join(transform(s.w, (x, i) -> "
        "if(i < s.a, x, s.w[int(s.a + (i - s.a) % (1 + (s.n - s.a) div (3 + s.g % 8)))])), ' '))[0]"
    )
    return docs.withColumn(text, F.expr(f"if({h} % 10 = 0, {loop}, `{text}`)"))
