"""Shared helpers: lineage cuts through the shared checkpoint folder, checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def materialize(df: DataFrame, tag: str = "tmp") -> DataFrame:
    """Write ``df`` once as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts lineage (a lost executor re-reads the files instead of recomputing the
    upstream joins) and computes the frame exactly once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{tag}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


#: Bytes of written Parquet up to which a side is broadcast.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only if it is at most ``max_bytes`` of Parquet; else leave it to a shuffle join.

    The frame is materialized first so the size is that of its files and the
    frame is computed once.
    """
    m = materialize(df, "bcast")
    # What the planner itself goes by: the bytes of the files read.
    size = int(m._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(m) if size <= max_bytes else m


def in_order(df: DataFrame, keys: list[str], at: str = "at") -> DataFrame:
    """``df`` written in the order of ``keys`` (nulls first) with ``at`` long, which ascends with it.

    Rows are cut into ranges of the keys and sorted there, so no key has to fit a
    task as long as the keys tell rows apart; ``at >> 33`` is the range's number.
    ``df`` should be narrow and read from files: its ranges are sampled first.
    """
    cols = [F.col(f"`{k}`") for k in keys]
    return materialize(df.repartitionByRange(*cols).sortWithinPartitions(*cols)
                       .withColumn(at, F.monotonically_increasing_id()), "ordered")


def positions(df: DataFrame, group: list[str], order: list[str], name: str = "pos") -> DataFrame:
    """``df`` with ``name`` long: a row's place, from 0, among its group's rows by ``order`` (nulls first).

    A group may have any share of the rows: it spreads over ranges of (group,
    order), and a range's first place is the sum of the counts before it.  Only
    (group, range) counts meet in a window: at most one row per range in a group.
    """
    placed = in_order(df, group + order, "at__")
    own = [F.col(f"`{g}`") for g in group]
    runs = placed.groupBy(*own, F.shiftright("at__", 33).alias("part__")).agg(
        F.min("at__").alias("low__"), F.count("*").alias("n__"))
    upto = Window.partitionBy(*own).orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("off__", F.coalesce(F.sum("n__").over(upto), F.lit(0)) - F.col("low__"))
    runs = broadcast_if_small(runs.select(*[c.alias(f"g{i}__") for i, c in enumerate(own)], "part__", "off__"))
    on = F.shiftright(placed["at__"], 33) == runs["part__"]
    for i, g in enumerate(group):
        on = on & placed[f"`{g}`"].eqNullSafe(runs[f"g{i}__"])
    return placed.join(runs, on).select(*[placed[f"`{c}`"] for c in df.columns],
                                        (F.col("at__") + F.col("off__")).alias(name))
