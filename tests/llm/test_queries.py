"""Registered queries: SQL where there is some, contracts, and the pipeline stage by stage."""

import hashlib
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from strata.llm import mix, neardup, quality, secrets
from strata.llm.common import fold
from strata.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL

from .test_documents import brute_near, check_shards, plain_spans, words

SF_MIDDLE = os.path.join(os.path.dirname(SF_SMALL), "sf0.01")


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(E.queries()) >= {*QUERIES, "pipeline"} and set(E.oracle_sql()) >= set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF_SMALL), con.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    rows = Counter(tuple(r[c] for c in cols) for r in got.collect())
    assert rows == Counter(tuple(dict(zip(want.columns, r))[c] for c in cols) for r in want.fetchall())
    assert sum(rows.values()) > 0


@pytest.mark.parametrize("name, least, columns, above", [("op1_toxic_neighbours", 0.3, "toxic", 0.02), ("op3_byte_network", 0.7, "quality", 0.05)])
def test_classifiers_beat_the_majority_on_held_out_rows(spark, name, least, columns, above):
    """Accuracy on rows whose labels were never read, of all and of long texts."""
    rows = QUERIES[name](spark, SF_MIDDLE).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MIDDLE}/documents.parquet").collect()}
    marks = {r.doc_id: r[columns] for r in spark.read.parquet(f"{SF_MIDDLE}/labels.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= least) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in marks]
    share = sum(marks[r.doc_id] for r in held) / len(held)
    right = [r.predicted == marks[r.doc_id] for r in held]
    assert len(held) > 80 and sum(right) / len(held) >= max(share, 1 - share) + above
    long = [ok for ok, r in zip(right, held) if len(docs[r.doc_id] or "") > 4000]
    assert sum(long) >= 0.8 * len(long)


def test_toxicity_scores_are_calibrated_and_traceable(spark):
    """Held-out rows by band of score have about that share of toxic ones, and the votes give the score again."""
    rows = QUERIES["op1_toxic_neighbours"](spark, SF_MIDDLE).collect()
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_MIDDLE}/labels.parquet").collect()}
    held = [(r.score, marks[r.doc_id]) for r in rows if r.held_out and r.doc_id in marks]
    off = 0.0
    for lo in np.arange(0, 1, 0.2):
        band = [(s, y) for s, y in held if lo <= s < lo + 0.2 or lo > 0.7 and s == 1]
        if band:
            off += len(band) / len(held) * abs(np.mean([s for s, _ in band]) - np.mean([y for _, y in band]))
    assert off < 0.08
    assert any(r.evidence for r in rows)
    for r in rows:
        assert len(r.evidence) <= 15 and all(0 < e.cosine <= 1 and marks[int(e.id)] == e.label for e in r.evidence)
        assert [e.cosine for e in r.evidence] == sorted((e.cosine for e in r.evidence), reverse=True)
        assert all(zlib.crc32(e.id.encode()) % 4 != 2 for e in r.evidence)


def test_secret_and_shard_contracts(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in QUERIES["op6_secret_lexing"](spark, SF_SMALL).collect():
        base = plain_spans(text[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in base) for x in ("assign", "access", "hex"))
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
    rows = QUERIES["op7_minimax_shards"](spark, SF_SMALL).collect()
    check_shards([type("R", (), {**r.asDict(), "text": text[r.doc_id]}) for r in rows], 40)


def test_other_queries_return_all_rows(spark):
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert QUERIES["op4_kneser_ney"](spark, SF_SMALL).count() == n
    packed = QUERIES["op8_best_fit_packing"](spark, SF_SMALL)
    assert packed.select("doc_id").distinct().count() == n
    vecs = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    asked = vecs.filter("vec_id % 20 = 0").count()
    assert QUERIES["op10_permutation_index"](spark, SF_SMALL).count() == asked * min(20, vecs.count() - 1)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("root", F.lit("extra"))
    columns, kept = docs.columns, {}
    for at, (name, stage) in enumerate(P.STAGES):
        before = docs
        stage(spark, docs, SF_SMALL).write.parquet(str(tmp_path / str(at)))
        docs = spark.read.parquet(str(tmp_path / str(at)))
        kept[name] = (before, docs)
        assert at == len(P.STAGES) - 1 or docs.columns == columns
    assert [n for n, _ in P.STAGES] == ["quality classifier", "near-dedup", "secret scan", "source mixing", "best-fit packing"]

    before, after = kept["quality classifier"]
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").filter(fold("doc_id", 4) != 2)
    scored = quality.score_quality(before, quality.train(before, labels))
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scored.filter("score >= 0.7").collect()}

    before, after = kept["near-dedup"]
    rows = [(r.doc_id, r.text, r.source) for r in before.collect()]
    want = {d for d, n, c, k in brute_near(rows, 80) if k or not n}
    assert sorted(r.doc_id for r in after.collect()) == sorted(want)

    before, after = kept["secret scan"]
    text = {r.doc_id: r.text for r in before.collect()}
    rows = after.collect()
    assert len(rows) == len(text)
    for r in rows:
        assert not secrets.scan(r.text) and (r.text == text[r.doc_id] or secrets.scan(text[r.doc_id])) and r.n_chars == len(r.text)

    before, after = kept["source mixing"]
    size, took = Counter(), Counter()
    whole = {r.doc_id: len(words(r.text)) for r in before.collect()}
    for r in after.collect():
        took[r.doc_id] += len(words(r.text))
    assert all(took[d] <= 2 * whole[d] for d in took)
    assert abs(sum(took.values()) - 1.5 * sum(whole.values())) <= 0.5 * before.select("source").distinct().count()

    before, after = kept["best-fit packing"]
    size = Counter()
    for r in before.collect():
        size[r.doc_id] += len(words(r.text)) + 1
    got = Counter()
    for r in after.collect():
        got[r.doc_id] += r.length
    assert got == size


def test_pipeline_on_odd_and_empty_rows(spark, messy, empty):
    """Each stage by itself on nulls, ties, repeated and very long rows."""
    rows = [(r.doc_id, r.text, r.source) for r in messy.collect()]
    for at, (name, stage) in enumerate(P.STAGES):
        assert stage(spark, empty, SF_SMALL).count() == 0
        got = stage(spark, messy, SF_SMALL)
        assert at == len(P.STAGES) - 1 or got.columns == messy.columns
        out = got.collect()
        if name == "quality classifier":
            assert not Counter((r.doc_id, r.text, r.source) for r in out) - Counter(rows)
        elif name == "near-dedup":
            want = Counter(t for d, t, s in rows for k in [d] if not words(t))  # wordless rows are linked with nothing
            for text in {" ".join(w.decode() for w in words(t)) for _, t, _ in rows if words(t)}:
                want[text] = 1
            assert Counter(" ".join(w.decode() for w in words(r.text)) if words(r.text) else r.text for r in out) == want
        elif name == "secret scan":
            assert Counter(r.doc_id for r in out) == Counter(d for d, _, _ in rows)
            assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in out)
        elif name == "source mixing":
            size, took = Counter(), Counter()
            for d, t, s in rows:
                size[d, s] += len(words(t))
            for r in out:
                took[r.doc_id, r.source] += len(words(r.text))
            assert all(took[k] <= 2 * size[k] for k in took)
            assert abs(sum(took.values()) - 1.5 * sum(size.values())) <= 0.5 * len({s for _, _, s in rows})
        else:
            want = Counter()
            for d, t, _ in rows:
                want[d] += len(words(t)) + 1
            got = Counter()
            for r in out:
                got[r.doc_id] += r.length
            assert got == want


def test_near_dedup_keeps_unrelated_texts(spark):
    docs = spark.createDataFrame([(i, f"alone {i} " + " ".join(f"w{i}x{j}" for j in range(30))) for i in range(20)], "doc_id long, text string")
    assert neardup.deduplicated(docs).count() == 20


def test_mix_equals_sql_and_follows_the_tree(spark, con):
    rows = QUERIES["op9_source_mix"](spark, SF_SMALL).collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = con.sql(mix.TAKEN_SQL)
    assert want.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert Counter(tuple(r)[:5] for r in rows) == Counter(want.fetchall())
    of = {d.doc_id: d for d in docs}
    assert len(of) == len(docs) == len(rows)
    by_source = defaultdict(list)
    for r in rows:
        by_source[of[r.doc_id].source].append(r)
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    sizes = [sum(r.size for r in by_source[s]) for s in names]
    take = [int(t + 0.5) for t in mix.targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2.0)]
    block = max(1, -(-sum(take) // mix.BLOCKS))
    quota = np.array(mix.split_tree([-(-t // block) for t in take], 64, 17))

    def place(r):
        text = hashlib.md5((of[r.doc_id].text or "").encode()).hexdigest()
        return hashlib.md5(f"{r.doc_id}:{text}".encode()).hexdigest()

    for i, s in enumerate(names):
        order = sorted(by_source[s], key=place)
        ends, at, got = np.cumsum(quota[:, i]), 0, np.zeros(64)
        for p in (1, 2):
            for r in order:
                n = max(0, min(r.size, take[i] - at))
                shard = int(np.sum(ends <= at // block)) if n else None
                assert (r[f"take_{p}"], r[f"shard_{p}"]) == (n, shard)
                if n:
                    got[shard] += n
                at += r.size
        # a document goes whole to the shard of its first block
        assert np.all(np.abs(got - quota[:, i] * block) <= 2 * max(r.size for r in order) + block)
    assert len({x for r in rows for x in (r.shard_1, r.shard_2) if x is not None}) > 32


def test_mix_of_repeated_ids_agrees_however_it_is_partitioned(spark):
    rows = [(7 if i % 3 else None, f"text {i % 90} " + "w " * 3, "s" + str(i % 2)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [Counter(tuple(r) for r in mix.mix(docs.repartition(n), shards=5).collect()) for n in (1, 7)]
    assert got[0] == got[1] and sum(got[0].values()) > 300


def test_mix_stage_lies_by_shard_and_shuffled(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    P.source_mixing(spark, docs, SF_SMALL).write.parquet(str(tmp_path / "mixed"))
    places = defaultdict(set)
    for r in mix.mix(docs).collect():
        places[r.doc_id, r.text].add((r.shard, r.shuffle_key))
    n = 0
    for file in (tmp_path / "mixed").glob("*.parquet"):
        last = (-1, 0)
        for r in pq.read_table(file, columns=["doc_id", "text"]).to_pylist():
            later = [x for x in places[r["doc_id"], r["text"]] if x > last]
            assert later
            last, n = min(later), n + 1
    assert n == sum(map(len, places.values()))
