"""Stored exact distinct counts: bitmaps of ids per part of the data, merged for any group without another scan.

``distinct_bitmaps`` keeps one bit per id that occurs in a part, 32,768 ids to a
bitmap of 4 KB.  Bitmaps of parts merge by OR, so a group's exact distinct count
comes from its parts' bitmaps, and counts of several columns need no row
expansion.  Integral keys are their own ids; others get dense ids from
``dictionary``.  Ids far apart cost a bitmap each: give sparse keys a dictionary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import broadcast_if_small, materialize, positions


def dictionary(df: DataFrame, value: str, name: str = "id") -> DataFrame:
    """(value, name): every distinct value but null, with dense ids from 0 in the values' order."""
    return positions(df.where(F.col(value).isNotNull()).select(value).distinct(), [], [value], name)


def distinct_bitmaps(df: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """(by, bucket, bitmap) of the long ``key`` per combination of ``by``.

    Repeated rows leave in a map-side aggregate first, so a hot combination costs
    its distinct ids.  A combination whose ids are all null keeps one empty bitmap.
    """
    ids = df.select(*by, F.col(key).cast("long").alias("id__")).distinct()
    return ids.groupBy(*by, F.bitmap_bucket_number("id__").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id__")).alias("bitmap"))


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups: ``by`` is a part of the columns they were made by."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def bitmap_counts(bitmaps: DataFrame, by: Sequence[str], out: str = "n_distinct") -> DataFrame:
    """(by, out): exact distinct ids per group, nulls not counted; without ``by`` one row, 0 for no bitmap."""
    n = F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0).cast("long")).alias(out)
    return merge_bitmaps(bitmaps, by).groupBy(*by).agg(n)


def overview(df: DataFrame, entity: str = "name", year: str = "year") -> DataFrame:
    """``summarize.overview`` by bitmaps: one scan of ``df``, whose (entity, year) counts are written; ``year`` is integral."""
    pairs = materialize(df.groupBy(entity, year).agg(F.count(F.lit(1)).alias("n")), "overview")
    named = pairs.join(broadcast_if_small(dictionary(pairs, entity)), entity, "left")
    entities = bitmap_counts(distinct_bitmaps(named, [], "id"), [])
    years = bitmap_counts(distinct_bitmaps(pairs, [], year), [])
    rows = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    return pairs.agg(F.min(year).alias("year_min"), F.max(year).alias("year_max"), rows("n").alias("n_rows"),
                     rows(F.when(F.col(entity).isNull(), F.col("n"))).alias("n_entity_nulls")).select(
        entities.scalar().alias("n_entities"), "n_entity_nulls", years.scalar().alias("n_years"),
        "year_min", "year_max", "n_rows")
