"""Registered queries: one per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, kneser_ney, mix, naming, neardup, pack, phrases, quality, runs, secrets, shard, topk, toxicity
from .common import bound_batches, fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return deco


@register("op7_minimax_shards")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return shard.assign_shards(docs, shards=40).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@register("op8_best_fit_packing")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return pack.pack(table(spark, sf, "documents").select("doc_id", "text"))


@register("op9_source_mix")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    """What the mixture takes of every document, and behind it the words and
    the shard of each pass. The draws of the tree have no SQL; the tests hold
    the taken words against ``mix.TAKEN_SQL``, and shards against the tree."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    taken = (F.col("take_1") + F.col("take_2")).alias("taken")
    return mix.assign_mix(docs).select("doc_id", "size", "source_size", "target", taken, "take_1", "shard_1", "take_2", "shard_2")


@register("op5_block_topk", topk.ORACLE_SQL)
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@register("op10_permutation_index")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@register("op6_secret_lexing")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    bound_batches(spark)
    found = secrets.find_secrets(table(spark, sf, "documents").select("doc_id", "text")).drop("text")
    base = "filter(spans, s -> s.kind <> 'literal')"
    text = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    counts = {f"n_{k}": F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) AS long)") for k in ("assign", "access", "hex")}
    return found.select("doc_id", *[c.alias(n) for n, c in counts.items()], F.sha2(F.expr(text.format(base)), 256).alias("base_sha256"), F.expr(text.format("spans")).alias("spans"))


def _taught(spark: SparkSession, sf: str) -> DataFrame:
    """Labels that may be learned from."""
    return table(spark, sf, "labels").filter(fold("doc_id", 4) != 2)


@register("op1_toxic_neighbours")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    index = toxicity.train(docs, _taught(spark, sf), label="toxic")
    held = (fold("doc_id", 4) == 2).alias("held_out")
    scored = toxicity.score_toxicity(docs, index)
    return scored.select("doc_id", held, "score", F.expr("int(score >= 0.3)").alias("predicted"), "evidence")


@register("op3_byte_network")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    net = quality.train(docs, _taught(spark, sf), label="quality")
    held = (fold("doc_id", 4) == 2).alias("held_out")
    return quality.score_quality(docs, net).select("doc_id", held, "score", F.expr("int(score >= 0.7)").alias("predicted"))


@register("op2_tensored_minhash", neardup.ORACLE_SQL)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))


@register("op4_kneser_ney")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = kneser_ney.perplexities(docs, fold("doc_id", 10) != 0)
    held = (fold("doc_id", 10) == 0).alias("held_out")
    return scored.select("doc_id", held, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


@register("op11_rollup_phrases", phrases.ORACLE_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(table(spark, sf, "documents").select("lang", "text"), least=100, most=2000)


@register("op12_square_runs")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    docs = runs.looped(table(spark, sf, "documents").select("doc_id", "text"))
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    found = runs.periodic_runs(docs).select("doc_id", F.expr("cast(size(runs) AS long)").alias("n_runs"), runs.longest().alias("r"), F.sha2(F.expr(lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    milli = F.expr("r.length * 1000 div r.period").alias("exponent_milli")
    return found.select("doc_id", "n_runs", "r.start", "r.length", "r.period", milli, "runs_sha256", "collapsed_sha256")


@register("op13_block_naming", naming.ORACLE_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return naming.exact_duplicates(table(spark, sf, "documents").select("doc_id", "text"))
