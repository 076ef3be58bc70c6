"""Periodic runs: brute force on small texts, loops planted by the query, odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from strata.llm import runs
from strata.llm.queries import QUERIES
from tests.conftest import SF_SMALL

from .conftest import LONG, MESSY


def brute_runs(s, least=6, times=4):
    out = []
    for q in range(1, len(s) // times + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            stretch = s[i : j + q]
            if len(stretch) >= max(least, times * q) and not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                out.append((i, len(stretch), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def looping(rng, letters, most):
    """A text of repeated and broken roots."""
    t = []
    while len(t) < most:
        root = [rng.randrange(letters) for _ in range(rng.randint(1, 9))]
        t += (root * rng.randint(1, 9))[: rng.randint(1, 60)]
    return t[: rng.randint(0, most)]


@pytest.mark.parametrize("least, times", [(6, 4), (0, 4), (10, 5)])
def test_runs_equal_brute_force(least, times):
    rng = random.Random(least)
    for _ in range(400):
        texts = [looping(rng, rng.choice([1, 2, 3]), rng.choice([8, 40, 90])) for _ in range(rng.randint(0, 4))]
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        start, end, period = runs.runs(np.array(sum(texts, []), np.int64), ends, least, times)
        want = []
        for t, e in zip(texts, ends.tolist()):
            want += [(a + e - len(t), a + e - len(t) + n, q) for a, n, q in brute_runs(t, least, times)]
        assert list(zip(start.tolist(), end.tolist(), period.tolist())) == want


def test_a_false_match_is_read_anew(monkeypatch):
    """With values so short that unlike blocks collide, the check word by word still gives exact runs."""
    rng, seeds = random.Random(5), []

    def weak(x, mix=runs.mix):
        return mix(x) & np.uint64(1)

    def catch(ids, ends, least, times, seed, catch=runs._catch):
        seeds.append(seed)
        with monkeypatch.context() as m:
            m.setattr(runs, "mix", weak if seed < 3 else runs.mix)
            return catch(ids, ends, least, times, seed)

    monkeypatch.setattr(runs, "_catch", catch)
    s = [rng.randrange(40) for _ in range(400)] + [1, 2, 3] * 9
    got = runs.runs(np.array(s), np.array([len(s)]))
    assert [(a, b - a, q) for a, b, q in zip(*[x.tolist() for x in got])] == brute_runs(s)
    assert seeds == [1, 2, 3]


def test_hard_texts_stay_fast():
    """Work does not grow with the square of a text, whatever repeats in it."""
    import time

    n = 300_000
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    cases = {"one word": [0] * n, "fibonacci": b[:n], "breaks": [int(i % 1537 == 0) for i in range(n)], "halves": list(range(n // 2)) * 2}
    began = time.time()
    found = {k: runs.runs(np.array(s), np.array([n])) for k, s in cases.items()}
    assert time.time() - began < 30
    assert [x.tolist() for x in found["one word"]] == [[0], [n], [1]]
    assert not len(found["fibonacci"][0]) and not len(found["halves"][0]) and len(found["breaks"][0]) > 100


def test_odd_rows(spark, messy, empty):
    out = runs.periodic_runs(messy.withColumnRenamed("kept", "runs"))
    assert {"root", "length"} <= set(out.columns) and out.columns.count("runs") == 1
    rows = out.collect()
    assert len(rows) == len(MESSY)
    for r in rows:
        words = [w.decode() for w in (r.text or "").encode().split()]
        assert r.n_words == len(words)
        if r.text == "tie tie tie tie tie tie":
            assert [tuple(x) for x in r.runs] == [(0, 6, 1)] and r.collapsed == "tie"
        else:
            assert r.runs == [] and r.collapsed == " ".join(words)
    assert any(r.text == LONG for r in rows)
    assert runs.periodic_runs(empty).count() == 0
    case = runs.periodic_runs(spark.createDataFrame([("A a A a A a A a",), ("a a a a a a a",)], "text string")).collect()
    assert [[tuple(x) for x in r.runs] for r in case] == [[(0, 8, 2)], []]


def digest(doc_id, text):
    """The query's row by brute force."""
    words = [w.decode() for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    number = {}
    found = brute_runs([number.setdefault(w, len(number)) for w in words])
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    most = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(found), *most, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    odd = [(10_000_000 + i, t) for i, t in enumerate(["", None, " \t", "one", "a b " * 50 + "c", "x " * 7 + "y x x x x x x", *["w1 w2 w3 w4 w5 w6 w7 w8 w9"] * 40])]
    rows = [tuple(r) for r in docs.collect() if len((r.text or "").split()) < 700] + odd
    spark.createDataFrame(rows, docs.schema).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_square_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = {digest(*r) for r in rows}
    assert {tuple(r) for r in got.collect()} == want
    assert sum(r[1] > 0 for r in want) > 20
