"""Exact duplicates by block naming: plain grouping, long texts, hot groups, odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from strata.llm import naming

from .conftest import CLASHES, LONG, MESSY


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def check(rows, out):
    """rows: (id, text); out: the operator's rows."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert Counter((r.doc_id, sha[r.text_sha256]) for r in out) == Counter((i, lower(t)) for i, t in rows)
    for r in out:
        ids = groups[sha[r.text_sha256]]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids) and r.keep_id == (max(known) if known else None)
        assert not r.kept or r.doc_id == r.keep_id
    assert Counter(sha[r.text_sha256] for r in out if r.kept) == Counter(dict.fromkeys(groups, 1))


def test_odd_rows(spark, messy, empty):
    check([(i, t) for i, t, _ in MESSY], naming.exact_duplicates(messy).collect())
    assert naming.exact_duplicates(empty).count() == 0 and naming.deduplicated(empty).count() == 0
    kept = naming.deduplicated(messy)
    assert kept.columns == messy.columns and set(CLASHES) <= set(kept.columns)
    want = {lower(t) for _, t, _ in MESSY}
    assert Counter(lower(r.text) for r in kept.collect()) == Counter(dict.fromkeys(want, 1))


def test_texts_of_many_blocks(spark, monkeypatch):
    """Texts that differ in one byte, in length at a block's edge, or in the order of their blocks only."""
    monkeypatch.setattr(naming, "BLOCK", 8)
    monkeypatch.setattr(naming, "CHUNK_BLOCKS", 200)
    rng = random.Random(1)
    blocks = ["aaaaaaaa", "bbbbbbbb", "aaaabbbb", "\x00" * 8]
    texts = ["".join(rng.choice(blocks) for _ in range(rng.randint(0, 9))) for _ in range(300)]
    texts += [t + x for t in texts[:60] for x in ("", "a", "aaaaaaa", "A" * 8, "\x00")]
    texts += ["é" * k for k in range(12)] + ["x" * 801, "x" * 800 + "y", "X" * 801]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(rows, naming.exact_duplicates(docs).collect())
    named = naming.identities(docs).collect()
    by = defaultdict(set)
    for r in named:
        by[r.blocks, r.name].add(r.sha256)
    assert all(len(x) == 1 for x in by.values()) and len(by) == len({lower(t) for t in texts})


def test_hot_group_sends_a_row_for_each_chunk(spark, monkeypatch):
    """A third of all rows are one text of several blocks; what is named is its blocks once a chunk."""
    monkeypatch.setattr(naming, "CHUNK_BLOCKS", 100)
    rows = [(i, LONG[:9000] if i % 3 == 0 else f"text {i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    monkeypatch.setattr(naming, "named", lambda asked, f=naming.named: seen.append(asked) or f(asked))
    check(rows, naming.exact_duplicates(docs).collect())
    hot = LONG[:4096].lower().encode()
    chunks = seen[0].select("chunk").distinct().count()
    assert seen[0].filter(F.col("block") == F.lit(hot)).count() <= chunks < 30
    assert seen[0].groupBy("chunk", "block").count().filter("count > 1").isEmpty()


def test_keys_of_other_kinds(spark):
    docs = spark.createDataFrame([("a", "One"), ("b", "one"), (None, "one"), (None, "two")], "name string, body string")
    got = {(r.name, r.keep_id, r.group_size, r.kept) for r in naming.exact_duplicates(docs, "name", "body").collect()}
    assert got == {("a", "b", 3, False), ("b", "b", 3, True), (None, "b", 3, False), (None, None, 1, True)}
    assert sorted(r.body for r in naming.deduplicated(docs, "name", "body").collect()) == ["one", "two"]
