"""Sinks: parallel Parquet/CSV writes (no single-writer ``coalesce(1)``), metrics JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def sink_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, mode: str = "overwrite",
                 cluster_by: Sequence[str] | None = None, observe: Sequence[Column] = ()) -> dict:
    """Write Parquet in parallel; ``partition_by=['year']`` lets year filters prune folders.

    ``cluster_by`` range-partitions the rows first (sampled boundaries, so no
    skew): each task then holds a contiguous key range and writes one or two
    folders' worth of files instead of a small file in every folder, and row
    groups carry tight min/max statistics for pushed range filters.  The rows'
    hash is the last key, so one value with most rows is still split.

    ``observe``: named aggregates taken of the rows while they are written; their
    values are returned by name, without a second scan.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by, F.xxhash64(*df.columns))
    seen = Observation() if observe else None
    if seen is not None:
        df = df.observe(seen, *observe)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return seen.get if seen is not None else {}


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def sink_metrics(metrics: DataFrame, path: str) -> None:
    """The one-row metrics record as JSON (a single small file)."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


#: Name of the column that ``sink_bucketed`` adds to the keys.
SALT = "salt__"


def sink_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int, salts: int,
                  salt_by: str) -> DataFrame:
    """Write an external table bucketed and sorted by ``keys`` and a salt, and return it.

    Joins on the keys and the salt read the buckets as they lie, without a shuffle
    of these rows.  The salt (a hash of ``salt_by`` in ``salts`` values) deals a key
    with most rows to as many buckets, as a bucket cannot be split at run time.  Each
    bucket is one file, written by one task.
    """
    by = [*keys, SALT]
    rows = df.withColumn(SALT, F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    (rows.repartition(buckets, *by).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *by).sortBy(*by).saveAsTable(table))
    return df.sparkSession.table(table)
