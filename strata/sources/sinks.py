"""Table sink: parquet / csv / json, any save mode, optional partition columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

FORMATS = ("parquet", "csv", "json", "orc")
MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


def save(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    header: bool = True,
) -> None:
    """Write ``df``. With ``partition_by`` rows are first clustered by the
    partition columns with a REBALANCE hint, so each task writes few
    directories, and AQE splits a partition value that holds a large share of
    the rows across several tasks instead of one."""
    if format not in FORMATS:
        raise ValueError(f"unknown format {format!r}; expected one of {FORMATS}")
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; expected one of {MODES}")
    out = df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    w = out.write.mode(mode).format(format)
    if format == "csv":
        w = w.option("header", header)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def save_bucketed(
    df: DataFrame, table: str, by: str, order: Sequence[str], buckets: int, path: str | None = None, mode: str = "overwrite"
) -> None:
    """Write ``df`` as a parquet table bucketed by ``by`` and sorted by
    ``order`` within each bucket. Rows are dealt by bucket first, so a bucket
    is one file; later windows and joins by ``by`` over the table need no
    shuffle. A key that holds most rows fills its bucket: choose the split
    plans for such a panel. ``path`` places the files outside the warehouse."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; expected one of {MODES}")
    w = df.repartition(buckets, by).write.mode(mode).format("parquet").bucketBy(buckets, by).sortBy(by, *order)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
