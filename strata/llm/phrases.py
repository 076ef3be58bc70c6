"""Collocations: phrases of words that occur together more often than apart.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and
pieces into words at spaces and tabs. Only padded longest windows are counted:
each word starts one window of ``ORDER`` lead columns (the word and those after
it in its piece, null beyond the end). The counts of all shorter phrases are
marginals of these: one ROLLUP over the lead columns sums the windows by ever
shorter prefixes, down to the words of each language. No phrase length is
exploded by itself.

A window is padded from where it cannot be frequent any more: a phrase that is
frequent enough holds only shorter phrases that are. So tasks first add up
words, pairs and then longer runs in hashed buckets, a bitmap for each length;
what lies in a bucket below the limit is rare. A bucket holds all runs of a
hash, so no frequent phrase is ever cut short. Rare words keep their windows,
all of one nameless word, and count for their language. Windows that are left
repeat, so tasks add them up before the shuffle.

There is a bucket for about every second word, from 2 ** 16 up to 2 ** 28 (a
quarter of that for runs of three words and more): bitmaps of 90 MB together
at most, broadcast. Beyond some 50 GB of text buckets fill up, fewer windows
are cut short and more distinct ones are shuffled; counts stay exact at every
size.

Null languages are ``und``, null texts have no words."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, stored
from .tokens import U, mix, pieces, utf8, word_hashes, word_spans

#: Words of a longest window.
ORDER = 5
#: Powers of two: fewest and most buckets, and buckets of one segment.
BUCKETS, SEGMENT = (16, 28), 16
#: Pairs that a task gathers before it sends counts.
GATHER = 2_500_000
#: Parts in which a language's phrases are ranked first.
PARTS = 64

_BOUND = np.zeros(256, bool)
_BOUND[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SPACE = _BOUND.copy()
_SPACE[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Words:
    """Words of some texts: their places, and the runs of words within a piece."""

    def __init__(self, data: np.ndarray, at: np.ndarray, langs: list[str]):
        self.starts, self.ends, self.of_row = word_spans(data, at, _SPACE)
        self.hashes, _ = word_hashes(data, at, _SPACE)
        n = len(self.hashes)
        bounds = np.concatenate([[0], np.cumsum(_BOUND[data])])
        self.next = np.zeros(n, bool)  # the next word follows in the same piece
        self.next[:-1] = bounds[self.starts[1:]] == bounds[self.ends[:-1]]
        last = self.of_row[1:] - 1
        self.next[last[np.diff(self.of_row) > 0]] = False
        salt = np.repeat(np.array([zlib.crc32(x.encode()) for x in langs], U), np.diff(self.of_row))
        self.salted = mix(self.hashes + (salt << U(20)))

    def runs(self, order: int, bits: dict[int, np.ndarray], power: dict[int, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length: the words at which a run of it starts that may be
        frequent as far as the ``bits`` tell, and the buckets of these runs."""
        at, value = np.arange(len(self.hashes)), self.salted
        alive = None
        for k in range(1, order + 1):
            if k > 1:
                # both runs shorter by one word are there, and in one piece
                more = alive[at] & self.next[at + k - 2]
                at, value = at[more], value[more]
                more = alive[at + 1]
                at, value = at[more], value[more]
                value = mix(value + U(0x9FB21C651E98DF25)) + self.hashes[at + k - 1]
            bucket = (mix(value) >> U(64 - power[k])).astype(np.int64)
            if k in bits:
                more = (bits[k][bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8)) & 1 == 1
                at, value, bucket = at[more], value[more], bucket[more]
            yield k, at, bucket
            alive = np.zeros(len(self.hashes) + 1, bool)
            alive[at] = True


def _each(b: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, _Words]]:
    """Pieces of a batch (lang, text): rows from, rows to, bytes, offsets, words."""
    data, at = utf8(b.column(1))
    langs = b.column(0).to_pylist()
    for lo, hi in pieces(at):
        here, of = data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        yield lo, hi, here, of, _Words(here, of, langs[lo:hi])


def frequent_buckets(texts: DataFrame, least: int, lengths: range, known: dict[int, np.ndarray], power: dict[int, int]) -> dict[int, np.ndarray]:
    """For each of ``lengths`` a bit for each bucket: whether runs of so many
    words fall into it ``least`` times or more. ``known``: the bits of shorter runs."""
    kind = "<u4" if least > 255 else "u1"  # no count beyond the limit matters
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {k: [] for k in lengths}, 0

        def send():
            for k, buckets in held.items():
                bucket, n = np.unique(np.concatenate(buckets), return_counts=True)
                n = np.minimum(n, least).astype(kind)
                found, first = np.unique(bucket >> SEGMENT, return_index=True)
                for s, a, z in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(bucket)]):
                    low = (bucket[a:z] & (2**SEGMENT - 1)).astype("<u2")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([s], pa.int32()), pa.array([low.tobytes()], pa.binary()), pa.array([n[a:z].tobytes()], pa.binary())],
                        names=["k", "segment", "low", "n"],
                    )

        for b in batches:
            for *_, words in _each(b):
                for k, _, bucket in words.runs(lengths[-1], shared.value, power):
                    if k in held:
                        held[k].append(bucket)
                        size += len(bucket)
                if size >= GATHER:
                    yield from send()
                    held, size = {k: [] for k in lengths}, 0
        if size:
            yield from send()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sums = None, None

        def done():
            bits = np.packbits(sums >= least).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([place[0]], pa.int32()), pa.array([place[1]], pa.int32()), pa.array([bits], pa.binary())], names=["k", "segment", "bits"])

        for b in batches:
            for k, s, low, n in zip(*[c.to_pylist() for c in b.columns]):
                if (k, s) != place:
                    if sums is not None:
                        yield done()
                    place, sums = (k, s), np.zeros(2**SEGMENT, np.int64)
                sums[np.frombuffer(low, "<u2")] += np.frombuffer(n, kind)  # a bucket stands once in a row
        if sums is not None:
            yield done()

    sent = texts.mapInArrow(count, "k int, segment int, low binary, n binary")
    rows = sent.repartition("k", "segment").sortWithinPartitions("k", "segment").mapInArrow(add, "k int, segment int, bits binary").collect()
    out = {k: np.zeros(2 ** power[k] // 8, np.uint8) for k in lengths}  # of bounded size
    for r in rows:
        out[r.k][r.segment << (SEGMENT - 3) : (r.segment + 1) << (SEGMENT - 3)] = np.frombuffer(r.bits, np.uint8)
    return out


def cut_pieces(texts: DataFrame, bits: dict[int, np.ndarray], power: dict[int, int], order: int = ORDER) -> DataFrame:
    """``lang`` and ``pieces``: the lower-cased words of each text. Before each
    stands a digit, how many words its window holds (0: the word itself is
    rare, and left out); a space follows if that is two or more, else a line end."""
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, at, words in _each(b):
                n = len(words.starts)
                extent = np.zeros(n, np.int64)
                for k, held, _ in words.runs(order, shared.value, power):
                    extent[held] = k
                size = np.where(extent > 0, words.ends - words.starts, 0)
                begin = np.concatenate([[0], np.cumsum(size + 2)])
                out = np.empty(int(begin[-1]), np.uint8)
                out[begin[:-1]] = 0x30 + extent
                out[begin[1:] - 1] = np.where(extent > 1, 0x20, 0x0A)
                within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                out[within + np.repeat(begin[:-1] + 1, size)] = _LOWER[data[within + np.repeat(words.starts, size)]]
                ends = begin[words.of_row].astype("<i4")
                text = pa.StringArray.from_buffers(hi - lo, pa.py_buffer(ends.tobytes()), pa.py_buffer(out.tobytes()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), text], names=["lang", "pieces"])

    return texts.mapInArrow(cut, "lang string, pieces string")


def windows(pieces: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, w1, w2, ...``: the lead columns of every word, null past the end of its window."""
    words = pieces.select("lang", F.explode(F.split("pieces", "\n")).alias("p")).filter("p <> ''").select("lang", F.split("p", " ").alias("x"))
    words = words.selectExpr("lang", "transform(x, y -> int(substr(y, 1, 1))) AS e", "transform(x, y -> substr(y, 2)) AS w")
    leads = ", ".join(f"slice(w, {k}, size(w))" for k in range(1, order + 1))
    leads = words.selectExpr("lang", f"inline(arrays_zip(e, {leads})) AS (e, {', '.join(f'w{k}' for k in range(1, order + 1))})")
    return leads.selectExpr("lang", "w1", *[f"if(e >= {k}, w{k}, null) AS w{k}" for k in range(2, order + 1)])


def phrase_counts(docs: DataFrame, least: int = 100, order: int = ORDER, lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang``, ``words`` (their number), ``phrase`` and ``f``: every phrase of
    1 to ``order`` words that occurs ``least`` times in its language or more,
    and all words of the language (``words`` 0, ``phrase`` empty)."""
    if not 2 <= order <= 9:
        raise ValueError("order must be from 2 to 9")
    bound_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    most = min(max(int(size / 12).bit_length(), BUCKETS[0]), BUCKETS[1])
    power = {k: most if k < 3 else max(most - 2, BUCKETS[0]) for k in range(1, order + 1)}
    columns = [f"w{k}" for k in range(1, order + 1)]
    bits = frequent_buckets(texts, least, range(1, 3), {}, power)
    if order > 2:
        bits |= frequent_buckets(texts, least, range(3, order + 1), bits, power)
    cut = cut_pieces(texts, bits, power, order)
    longest = windows(cut, order).groupBy("lang", *columns).agg(F.count(F.lit(1)).alias("c"))
    sums = longest.rollup("lang", *columns).agg(F.sum("c").alias("f"), F.grouping_id().alias("gid"))
    # all but the first k lead columns summed away: gid has the last bits set
    level = F.lit(None).cast("int")
    for k in range(order + 1):
        here = F.col("gid") == 2 ** (order - k) - 1
        level = F.when(here & (F.col(columns[k - 1]) != "") if k else here, k).otherwise(level)  # neither padding nor rare words
    sums = sums.select("lang", level.alias("words"), F.concat_ws(" ", *columns).alias("phrase"), "f")
    return sums.filter((F.col("words") == 0) | (F.col("f") >= least)).filter("words is not null")


def collocations(docs: DataFrame, least: int = 100, most: int = 2000, order: int = ORDER, covered: int = 100, lang: str = "lang", text: str = "text") -> DataFrame:
    """The ``most`` best phrases of 2 to ``order`` words of each language:
    ``lang``, ``rank`` (from 1), ``phrase``, ``a`` (its count), ``l`` and ``r``
    (counts of its two parts at the lowest-scoring cut, of equal ones the
    first), ``n`` (words of the language) and ``score`` = floor(1000 a n / (l r)).

    Phrases that occur fewer than ``least`` times are none, and those within a
    longer phrase that has ``covered`` percent of their count are left out.
    Equal scores go by count, then by the bytes of the phrase. A language of no
    frequent phrase has no row; an empty table gives an empty one. Numbers are
    exact (38 digits)."""
    counts = stored(phrase_counts(docs, least, order, lang, text), "phrases")
    phrases = counts.filter("words > 0").select("lang", "phrase", "f")
    found = counts.filter("words >= 2").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    cuts = found.select("lang", "phrase", "a", F.col("w"), F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("concat_ws(' ', slice(w, 1, k))").alias("lp"), F.expr("concat_ws(' ', slice(w, k + 1, size(w)))").alias("rp")
    )
    for part, count in (("lp", "l"), ("rp", "r")):
        cuts = cuts.join(phrases.withColumnsRenamed({"phrase": part, "f": count}), ["lang", part])
    total = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    score = F.expr("(cast(a AS decimal(19)) * cast(n AS decimal(18)) * 1000) div (cast(l AS decimal(19)) * cast(r AS decimal(18)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r", "n")).alias("best")
    scored = cuts.join(total, "lang").groupBy("lang", "phrase", "a").agg(lowest)

    # every phrase inside a longer one, with the largest count of those around it
    if order > 2:
        inner = found.filter(F.size("w") > 2).select("lang", "a", "w", F.explode(F.sequence(F.lit(2), F.size("w") - 1)).alias("m"))
        inner = inner.select("lang", "a", F.explode(F.expr("transform(sequence(1, size(w) - m + 1), i -> concat_ws(' ', slice(w, i, m)))")).alias("phrase"))
        inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
        scored = scored.join(inner, ["lang", "phrase"], "left").filter(F.expr(f"coalesce(100 * around < {covered} * a, true)"))

    order_by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = scored.select("lang", "phrase", "a", "best.*").withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    # a language's best are among the best of its parts
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order_by))).filter(F.col("place") <= most)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order_by)).cast("long")).filter(F.col("rank") <= most)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM t),
s AS (SELECT lang, [x FOR x IN regexp_split_to_array(p, '[ \t]+') IF x <> ''] AS w FROM p),
n AS (SELECT lang, cast(sum(len(w)) AS BIGINT) AS n FROM s GROUP BY lang),
g AS (SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
      FROM s, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, string_split(phrase, ' ') AS w, k, f AS a FROM f WHERE k >= 2),
cut AS (SELECT lang, phrase, w, a, unnest(range(1, k)) AS j FROM c),
scored AS (
  SELECT cut.lang, cut.phrase, a, j, l.f AS l, r.f AS r, n, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
  FROM cut JOIN n ON n.lang = cut.lang
  JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(w[1:j], ' ')
  JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(w[j + 1:], ' ')),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
kept AS (SELECT * FROM low WHERE NOT EXISTS (
  SELECT 1 FROM c WHERE c.lang = low.lang AND c.phrase <> low.phrase AND contains(' ' || c.phrase || ' ', ' ' || low.phrase || ' ') AND c.a >= low.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, cast(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000
"""
