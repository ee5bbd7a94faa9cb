"""Aggregations, profiles, top-k and reshapes over the fact table.

Every summary is one ``groupBy().agg()`` (partial aggregation map-side, so a
hot key costs one partial row per task, not one task holding the whole key).
Global one-row results use a single ``agg``; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import fmt_pct, fmt_usd, hover_text, pct_round, round_scaled, valuation_class
from ._util import broadcast_if_small
from .clean import existing


# ---------------------------------------------------------------- grouped means
def yearly_stats(df: DataFrame, year: str = "year", value: str = "dollar_price") -> DataFrame:
    """Mean, min, max and row count of ``value`` per year, by year."""
    return (df.groupBy(year)
            .agg(F.avg(value).alias("avg_price"), F.min(value).alias("min_price"),
                 F.max(value).alias("max_price"), F.count(F.lit(1)).alias("n_obs"))
            .orderBy(year))


def mean_by_entity(df: DataFrame, entity: str = "name", value: str = "dollar_price",
                   out: str = "avg_price") -> DataFrame:
    return df.groupBy(entity).agg(F.avg(value).alias(out))


def top_k_entities(df: DataFrame, entity: str = "name", value: str = "dollar_price", k: int = 10,
                   ascending: bool = False, out: str = "avg_price") -> DataFrame:
    """k entities with the highest (or lowest) mean; the entity breaks ties."""
    m = mean_by_entity(df, entity, value, out)
    order = F.col(out).asc_nulls_last() if ascending else F.col(out).desc_nulls_last()
    return m.orderBy(order, F.col(entity).asc()).limit(k)


def index_by_entity(df: DataFrame, entity: str = "name", value: str = "USD_raw",
                    out: str = "avg_usd_raw", inclusive: bool = False) -> DataFrame:
    """Mean raw index per entity, ascending, with its over/under class."""
    m = mean_by_entity(df, entity, value, out)
    return (m.withColumn("valuation", valuation_class(out, inclusive=inclusive))
            .orderBy(F.col(out).asc_nulls_last(), F.col(entity)))


def entity_year_mean(df: DataFrame, entity: str = "name", year: str = "year",
                     value: str = "dollar_price", out: str = "avg_price") -> DataFrame:
    return df.groupBy(entity, year).agg(F.avg(value).alias(out))


def bucket_counts(df: DataFrame, value: str = "dollar_price", width: float = 1.0,
                  out: str = "price_bucket") -> DataFrame:
    """Rows per ``width``-wide bucket (floored), by bucket."""
    b = F.floor(F.col(value) / F.lit(float(width))) if width != 1 else F.floor(value)
    return df.groupBy(b.cast("long").alias(out)).agg(F.count(F.lit(1)).alias("count")).orderBy(out)


def support_count(df: DataFrame, entity: str = "name", value: str | None = None,
                  out: str = "cnt", rows: str | None = None) -> DataFrame:
    """Non-null ``value`` count per entity, or the row count when ``value`` is None; ``rows`` names a row count beside it."""
    c = F.count(value) if value else F.count(F.lit(1))
    more = [F.count(F.lit(1)).alias(rows)] if rows else []
    return df.groupBy(entity).agg(c.alias(out), *more)


def top_k_support(df: DataFrame, entity: str = "name", k: int = 10, value: str | None = None,
                  out: str = "cnt") -> DataFrame:
    return (support_count(df, entity, value, out)
            .orderBy(F.col(out).desc(), F.col(entity).asc()).limit(k))


def restrict_to_top(df: DataFrame, top: DataFrame, entity: str = "name") -> DataFrame:
    """Rows whose entity is in ``top``, which is broadcast if its written size allows."""
    return df.join(broadcast_if_small(top.select(entity)), on=entity, how="left_semi")


def map_frame(df: DataFrame, year: str = "year", code: str = "iso_a3", name: str = "name",
              index: str = "USD_raw", price: str = "dollar_price") -> DataFrame:
    """Mean index and price per (year, code, name); null index dropped; percent and label."""
    keys = [year, code, name]
    g = (df.filter(F.col(year).isNotNull() & F.col(code).isNotNull() & F.col(name).isNotNull())
         .groupBy(*keys).agg(F.avg(index).alias(index), F.avg(price).alias(price)))
    return map_from_means(g, name, index, price)


def map_from_means(g: DataFrame, name: str, index: str, price: str) -> DataFrame:
    """Percent and label for rows that hold the means."""
    g = g.filter(F.col(index).isNotNull()).withColumn(f"{index}_pct", pct_round(index, 1))
    return g.withColumn("hover", hover_text(name, f"{index}_pct", round_scaled(price, 2)))


def kpi_summary(df: DataFrame, entity: str = "name", code: str = "iso_a3", index: str = "USD_raw",
                price: str = "dollar_price") -> DataFrame:
    """One row: most over/under-valued entity (mean index), row-weighted means, entity count.

    One grouped pass carries per-group sums and counts, one global pass reads
    them: no second scan, no join of one-row frames.  Ties go to the smallest
    (entity, code).
    """
    g = df.groupBy(entity, code).agg(
        F.avg(index).alias("__m"),
        F.sum(index).alias("__si"), F.count(index).alias("__ci"),
        F.sum(price).alias("__sp"), F.count(price).alias("__cp"))
    return kpi_from_groups(g, entity, code)


def kpi_from_groups(g: DataFrame, entity: str, code: str) -> DataFrame:
    """The KPI row of groups with the mean, sum and count of the index and the sum and count of the price."""
    ok = F.col(entity).isNotNull() & F.col(code).isNotNull() & F.col("__m").isNotNull()
    hi_key = F.struct(-F.col("__m"), F.col(entity), F.col(code))
    lo_key = F.struct(F.col("__m"), F.col(entity), F.col(code))
    pick = F.struct(F.col(entity).alias("e"), F.col(code).alias("c"), F.col("__m").alias("m"))
    agg = g.agg(
        F.min_by(F.when(ok, pick), F.when(ok, hi_key)).alias("hi"),
        F.min_by(F.when(ok, pick), F.when(ok, lo_key)).alias("lo"),
        (F.sum("__si") / F.sum("__ci")).alias("global_index"),
        (F.sum("__sp") / F.sum("__cp")).alias("avg_price"),
        F.count_distinct(entity).alias("n_entities"),
    )
    return agg.select(
        F.col("hi.e").alias("top_name"), F.col("hi.c").alias("top_code"), F.col("hi.m").alias("top_index"),
        F.col("lo.e").alias("bottom_name"), F.col("lo.c").alias("bottom_code"), F.col("lo.m").alias("bottom_index"),
        "global_index", "avg_price", "n_entities",
        fmt_pct("hi.m").alias("top_text"), fmt_pct("lo.m").alias("bottom_text"),
        fmt_pct("global_index").alias("global_text"), fmt_usd("avg_price").alias("price_text"),
    )


def top_bottom(df: DataFrame, entity: str = "name", value: str = "USD_raw", n: int = 20,
               is_index: bool = True) -> DataFrame:
    """``n//2`` lowest and ``n//2`` highest entity means (one row can be in both halves).

    Each half is a ``TakeOrderedAndProject`` (per-partition top-k, then merge).
    """
    means = df.filter(F.col(entity).isNotNull()).groupBy(entity).agg(F.avg(value).alias(value))
    return top_bottom_of(means, entity, value, n, is_index)


def top_bottom_of(means: DataFrame, entity: str, value: str, n: int, is_index: bool) -> DataFrame:
    """The two halves of entities that already have their mean."""
    half = n // 2
    m = means.filter(F.col(value).isNotNull())
    low = m.orderBy(F.col(value).asc(), F.col(entity).asc()).limit(half).withColumn("half", F.lit("bottom"))
    high = m.orderBy(F.col(value).desc(), F.col(entity).asc()).limit(half).withColumn("half", F.lit("top"))
    out = low.unionByName(high)
    if is_index:
        out = out.withColumn("color", valuation_class(value, inclusive=True)).withColumn(
            "display", F.concat(F.format_string("%.1f", pct_round(value, 1)), F.lit("%")))
    else:
        out = out.withColumn("color", F.lit("neutral")).withColumn("display", fmt_usd(value))
    return out


def snapshot_stats(df: DataFrame, col: str = "GDP_dollar") -> DataFrame:
    """Non-null count, null count, min, max, mean of one column — one pass."""
    return df.agg(*snapshot_measures(col))


def snapshot_measures(col: str = "GDP_dollar") -> list[F.Column]:
    """The aggregates of ``snapshot_stats``, also for observing a write."""
    return [F.count(col).alias("count_non_null"), F.count_if(F.col(col).isNull()).alias("count_null"),
            F.min(col).alias("min"), F.max(col).alias("max"), F.avg(col).alias("mean")]


def preview(df: DataFrame, cols: Sequence[str], n: int = 10, order: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows of the existing display columns, in a fixed order."""
    sel = df.select(*existing(df, cols))
    order = list(order) if order else sel.columns
    return sel.orderBy(*order).limit(n)


# ---------------------------------------------------------------- profiles
def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, stddev (sample), min, max per column as doubles — one aggregate, long form."""
    cols = existing(df, cols)
    rows = [F.struct(F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"),
                     F.stddev_samp(c).alias("stddev"), F.min(F.col(c).cast("double")).alias("min"),
                     F.max(F.col(c).cast("double")).alias("max")) for c in cols]
    return df.agg(F.array(*rows).alias("__r")).select(F.inline("__r"))


def overview(df: DataFrame, entity: str = "name", year: str = "year") -> DataFrame:
    """Distinct entities and years, year span and row count in one aggregate.

    ``n_entities`` excludes null; ``n_entity_nulls`` reports them separately.
    """
    return df.agg(F.count_distinct(entity).alias("n_entities"),
                  F.count_if(F.col(entity).isNull()).alias("n_entity_nulls"),
                  F.count_distinct(year).alias("n_years"),
                  F.min(year).alias("year_min"), F.max(year).alias("year_max"),
                  F.count(F.lit(1)).alias("n_rows"))


def null_counts(df: DataFrame) -> DataFrame:
    """Null count per column (one aggregate), only columns with at least one null."""
    rows = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("n_null"))
            for c in df.columns]
    return df.agg(F.array(*rows).alias("__r")).select(F.inline("__r")).filter(F.col("n_null") > 0)


# ---------------------------------------------------------------- reshape
def pivot_entity_year(df: DataFrame, entity: str = "name", year: str = "year", value: str = "dollar_price",
                      k: int = 30, years: Sequence[int] | None = None) -> DataFrame:
    """Entity × year matrix of means for the ``k`` best-supported entities.

    Sorted by the last year's mean descending, missing last, then entity.
    Pass ``years`` to avoid a distinct-years job; otherwise one small job lists them.
    """
    top = top_k_support(df, entity, k)
    sub = restrict_to_top(df, top, entity)
    if years is None:
        years = [r[0] for r in sub.select(year).distinct().orderBy(year).collect() if r[0] is not None]
    years = sorted(years)
    wide = sub.groupBy(entity).pivot(year, years).agg(F.avg(value))
    wide = wide.toDF(entity, *[str(y) for y in years])
    if years:
        return wide.orderBy(F.col(str(years[-1])).desc_nulls_last(), F.col(entity))
    return wide.orderBy(entity)
