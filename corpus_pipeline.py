"""Corpus pipeline: the documents table through five of the training-data operators.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; all but the last return the columns they were given. Columns
besides ``doc_id``, ``text`` and ``source`` are carried along; ``n_chars`` is
kept in step with a changed text. Empty tables pass through every stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import mix, neardup, pack, quality, secrets
from strata.llm.common import bound_batches, fold, stored, table

#: Documents less likely than this to be of good quality go.
KEEP_FROM = 0.7
#: Documents at least so similar (in percent, sets of five-word shingles) are one group.
SIMILAR = 80


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network rejects go. It learns from the labels of
    ids whose crc32 modulo 4 is not 2."""
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 4) != 2)
    net = quality.train(docs, labels, label="quality")
    return quality.score_quality(docs, net, out="__score").filter(F.col("__score") >= KEEP_FROM).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the smallest id."""
    return neardup.deduplicated(docs, percent=SIMILAR)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is masked; all documents stay."""
    bound_batches(spark)
    return _sized(secrets.redact(docs)).select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture to the target weights: a row for each document and pass, the
    last document of a source cut to meet its target. Rows lie shard after
    shard, each shard shuffled."""
    return _sized(mix.by_shard(mix.mix(docs, out=("__shard", "__key")), "__shard", "__key")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of the mixture in its place in a bin (see ``pack.pack``)."""
    return pack.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("near-dedup", near_dedup),
    ("secret scan", secret_scan),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: A fitted network and permuted blocks have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
