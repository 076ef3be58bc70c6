"""Phrase mining: brute force at low limits, exact arithmetic, odd rows, hot languages."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from strata.llm import phrases

from .conftest import CLASHES, docs_of


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def brute_counts(rows, order=5):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, order + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    return f, n


def brute(rows, least, most, order=5):
    f, n = brute_counts(rows, order)
    found = {(lang, p): a for (lang, p), a in f.items() if len(p) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, p), a in found.items():
        inside = any(
            q != p and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (other, q), b in found.items() if other == lang and len(q) > len(p)
        )
        if inside:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), a, f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    return {(lang, i, x[2].decode(), *x[3:], -x[0]) for lang, found in out.items() for i, x in enumerate(sorted(found)[:most], 1)}


def check(spark, rows, least, most, **options):
    docs = spark.createDataFrame([(lang, t, *["x"] * 3) for lang, t in rows], "lang string, text string, n string, rank string, f string")
    got = phrases.collocations(docs, least, most, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, least, most, options.get("order", 5))
    return got


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "New", "york", "é", "日本", "x\x1cy", "the", "-"]
    joins = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!?"]
    return ["".join(rng.choice(vocabulary) + rng.choice(joins) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_equals_brute_force(spark):
    rows = [(random.Random(i).choice(["en", "de", None]), t) for i, t in enumerate(texts(1, 120))]
    rows += [("en", "in the new york city hall. In The NEW york city hall,in the new york city")] * 4 + [("fr", "un deux")]
    assert len(check(spark, rows, 3, 2000)) > 100
    check(spark, rows, 300, 2000)
    check(spark, rows, 2, 7)
    check(spark, rows, 2, 50, order=2)


def test_counts_of_all_lengths(spark):
    rows = [("en", t) for t in texts(2, 60)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    f, n = brute_counts(rows)
    got = {(r.lang, r.words, r.phrase): r.f for r in phrases.phrase_counts(docs, 2).collect()}
    want = {(lang, len(p), " ".join(p)): c for (lang, p), c in f.items() if c >= 2} | {(lang, 0, ""): c for lang, c in n.items() if c}
    assert got == want


def test_windows_end_where_they_get_rare(spark):
    """With few buckets some rare runs stay; frequent ones always do, and every word has its window."""
    rows = [(None, f"alpha Beta r{i} alpha beta gamma s{i}, t{i} delta") for i in range(50)]
    docs = spark.createDataFrame(rows, "lang string, text string").select(F.lit("und").alias("lang"), "text")
    power = dict.fromkeys(range(1, 6), 16)
    bits = phrases.frequent_buckets(docs, 50, range(1, 3), {}, power)
    bits |= phrases.frequent_buckets(docs, 50, range(3, 6), bits, power)
    for r in phrases.cut_pieces(docs, bits, power).collect():
        assert r.pieces == "2alpha 1beta\n0\n3alpha 2beta 1gamma\n0\n0\n1delta\n"
    check(spark, rows, 50, 10)
    check(spark, rows, 50, 10, order=3)


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = 3 * 10**12

    def counts(docs, *rest):
        rows = [("en", 0, "", 10**15), ("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 7)]
        return docs.sparkSession.createDataFrame(rows, "lang string, words int, phrase string, f long")

    monkeypatch.setattr(phrases, "phrase_counts", counts)
    r = phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect()
    assert [tuple(x) for x in r] == [("en", 1, "a b", big - 7, big, big + 1, 10**15, 1000 * (big - 7) * 10**15 // (big * (big + 1)))]


def test_odd_rows(spark, messy, empty):
    assert phrases.collocations(empty).count() == 0 and set(CLASHES) <= set(messy.columns)
    odd = [(None, None, None), (1, "", None), (2, "... ,,, \n", None), (3, "word", None)]
    assert phrases.collocations(docs_of(spark, odd), 1).count() == 0
    rows = [(None, r.text) for r in messy.select("text").collect()]
    got = phrases.collocations(messy, 3, 20).collect()
    assert {tuple(r) for r in got} == brute(rows, 3, 20) and got


def test_windows_are_padded_and_rolled_up(spark):
    pieces = spark.createDataFrame([("en", "3a 2b 1c\n0\n1d\n"), ("en", "")], "lang string, pieces string")
    got = [tuple(r)[1:] for r in phrases.windows(pieces, 3).collect()]
    assert len(got) == 5 and set(got) == {("", None, None), ("a", "b", "c"), ("b", "c", None), ("c", None, None), ("d", None, None)}
    docs = spark.createDataFrame([("en", "a b")], "lang string, text string")
    plan = phrases.phrase_counts(docs, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand [") == 1 and "spark_grouping_id" in plan
