"""Shared helpers: table paths, the shared folder, label folds, batch bounds."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: A word: a run of bytes other than space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"

#: Most bytes of one Arrow batch sent to a Python worker (one longer row is a batch of its own).
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``name`` under ``sf_dir`` (any path or URI Spark reads)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, so that long texts cannot fill a worker.
    A session that sets a smaller bound itself keeps it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder the cluster shares (``spark.checkpoint.dir``)."""
    return f"{shared_dir(spark).rstrip('/')}/strata-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage is cut, and
    the rows survive the loss of any executor."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: str, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id counts as remainder -1 (in no fold)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % n, F.lit(-1))


def words(text: str | Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
