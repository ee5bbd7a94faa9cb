"""Shared pieces of the corpus operators: table access, written cuts, sorted-group streaming, components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators._util import in_order, materialize, positions

__all__ = ["WORD", "bit_sketch", "caller_row", "components", "in_order", "materialize", "maybe_in", "member_sketch", "only_caches_of",
           "pick", "positions", "rows_per_task", "small_batches", "sorted_groups", "table"]

#: A word: a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def pick(name: str):
    """The column called exactly ``name``, also when the name holds dots or blanks."""
    return F.col(f"`{name}`")


def caller_row(docs: DataFrame):
    """All columns of ``docs`` as one struct ``row``: beside it an operator's own names cannot meet the caller's."""
    return F.struct(*[pick(c) for c in docs.columns]).alias("row")


#: What an operator keeps in a reused Python worker: the functions that forget it, by owner.
_CACHES: dict[str, Callable[[], None]] = {}


def only_caches_of(owner: str, forget: Callable[[], None] | None = None) -> None:
    """Forget what other operators left in this Python worker; ``forget`` will do so for ``owner`` when another one comes."""
    for other in [k for k in _CACHES if k != owner]:
        _CACHES.pop(other)()
    if forget is not None:
        _CACHES[owner] = forget


def small_batches(spark: SparkSession, rows: int = 500, size: int = 8 << 20) -> None:
    """Bound the Arrow batches of this session: what a Python worker and the JVM beside it hold of long texts at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def rows_per_task(rows: int, per_task: int) -> int:
    """How many groups keep each near ``per_task`` rows."""
    return max(1, -(-int(rows) // per_task))


def member_sketch(df: DataFrame, key, buckets: int = 1 << 18) -> DataFrame:
    """At most ``buckets`` distinct hash buckets of ``key``: a broadcast whose size is bounded by construction.

    A row whose bucket is absent certainly has no equal key in ``df``; a row whose
    bucket is present may have one.  Column ``bucket`` is ``bucket_of(key)``.
    """
    return F.broadcast(df.select(bucket_of(key, buckets).alias("bucket")).distinct())


def bucket_of(key, buckets: int = 1 << 18):
    return F.pmod(F.xxhash64(F.lit(5), key), F.lit(buckets))


def bit_sketch(df: DataFrame, key, bits: int = 1 << 26) -> DataFrame:
    """``member_sketch`` in a bit a bucket: a broadcast of at most ``bits`` / 8 bytes, sharp up to millions of keys.

    One row per page of 4 KB that has a key; ``maybe_in`` asks it.
    """
    at = df.select(bucket_of(key, bits).alias("at"))
    return F.broadcast(at.select(F.bitmap_bucket_number("at").alias("page"), F.bitmap_bit_position("at").alias("bit"))
                       .repartition("page").groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")))


def maybe_in(df: DataFrame, sketch: DataFrame, key, bits: int = 1 << 26) -> DataFrame:
    """``df`` with ``maybe``: false if certainly no equal key is in what ``bit_sketch`` was made of (same ``bits``)."""
    bit = F.bitmap_bit_position("at")
    byte = F.conv(F.hex(F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (bit % 8).cast("int"))) > 0
    asked = df.withColumn("at", bucket_of(key, bits)).withColumn("page", F.bitmap_bucket_number("at"))
    return asked.join(sketch, "page", "left").withColumn("maybe", F.coalesce(hit, F.lit(False))).drop("at", "page", "bits")


def sorted_groups(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Groups of equal ``keys`` from batches sorted by them; a group may span batches.

    Holds one batch and the group that is open, nothing more.
    """
    held: list[pd.DataFrame] = []
    last = None
    for pdf in batches:
        if not len(pdf):
            continue
        cols = [pdf[k].to_numpy() for k in keys]
        change = cols[0][1:] != cols[0][:-1]
        for c in cols[1:]:
            change = change | (c[1:] != c[:-1])
        cuts = [0, *(change.nonzero()[0] + 1).tolist(), len(pdf)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[lo] for c in cols)
            if held and key != last:
                yield last, pd.concat(held) if len(held) > 1 else held[0]
                held = []
            last = key
            held.append(pdf.iloc[lo:hi])
    if held:
        yield last, pd.concat(held) if len(held) > 1 else held[0]


def _state(df: DataFrame) -> tuple:
    r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame, max_rounds: int = 100,
               note: Callable[[int, int], None] | None = None) -> DataFrame:
    """Connected components of undirected ``edges(u, v)`` as ``(u, root)`` for every node that is no root.

    Alternating large-star / small-star rounds: each points nodes at the least
    neighbour seen, so the edge set never grows and ends as one star per
    component around its least node.  Every round is written to the shared
    checkpoint folder, so lineage stays one round deep; only a count and a
    checksum reach the driver.  Self-loops and repeated edges are ignored; no
    edges give no rows.
    """
    e = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "edges")
    state = _state(e)
    for i in range(max_rounds):
        if not state[0]:
            break
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written first: both join sides are then plain exchanges, which AQE splits at a hub.
        least = materialize(sym.groupBy("u").agg(F.min("v").alias("m")), "least")
        large = (sym.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        large = materialize(large, "large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = materialize(small, "edges")
        now = _state(e)
        if note:
            note(i, now[0])
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select("u", F.col("v").alias("root"))
