"""Filters, facets and per-key selections (latest row, ordered series, snapshots)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bin_ordinal, pct_round
from ..schemas import GDP_BIN_LABELS, NO_DATA_LABEL
from ._util import materialize, positions
from .clean import existing


def facet_filter(df: DataFrame, years: tuple[int, int] | None = None, regions: Sequence[str] | None = None,
                 bins: Sequence[str] | None = None, year_col: str = "year", region_col: str = "region",
                 bin_col: str = "gdp_level", date_col: str | None = "date",
                 null_label: str = NO_DATA_LABEL) -> DataFrame:
    """Inclusive year range AND region in set AND bin label in set.

    Choosing ``null_label`` also lets rows with a null label through.  When a
    date column exists the year range is also stated on the date, so it reaches
    the Parquet scan as a pushed filter (a predicate on ``year(date)`` is not).
    """
    cond = F.lit(True)
    if years is not None:
        lo, hi = years
        cond = cond & F.col(year_col).between(lo, hi)
        if date_col and date_col in df.columns:
            cond = cond & (F.col(date_col) >= F.make_date(F.lit(lo), F.lit(1), F.lit(1))) & (
                F.col(date_col) < F.make_date(F.lit(hi + 1), F.lit(1), F.lit(1)))
    if regions is not None:
        cond = cond & F.col(region_col).isin(*regions)
    if bins is not None:
        b = F.col(bin_col).isin(*bins)
        if null_label in bins:
            b = b | F.col(bin_col).isNull()
        cond = cond & F.coalesce(b, F.lit(False))
    return df.filter(cond)


def facet_options(df: DataFrame, year_col: str = "year", region_col: str = "region",
                  bin_col: str = "gdp_level", bin_labels: Sequence[str] = GDP_BIN_LABELS,
                  null_label: str = NO_DATA_LABEL) -> DataFrame:
    """(facet, value, ordinal): sorted distinct years and regions; bin labels present, in bin order.

    One aggregate over the rows: the combinations of the three that occur.
    """
    df = materialize(df.select(year_col, region_col, bin_col).distinct(), "facets")
    y = df.select(F.lit("year").alias("facet"), F.col(year_col).cast("string").alias("value"),
                  F.col(year_col).cast("int").alias("ordinal")).filter(F.col("value").isNotNull()).distinct()
    # region labels in order, however many: a label's place among them is its ordinal
    r = positions(df.select(F.col(region_col).alias("value")).filter(F.col("value").isNotNull()).distinct(), [], ["value"])
    r = r.select(F.lit("region").alias("facet"), "value", (F.col("pos") + 1).cast("int").alias("ordinal"))
    b = (df.select(F.col(bin_col).alias("value")).filter(F.col("value").isNotNull()).distinct()
         .select(F.lit("gdp_level").alias("facet"), "value",
                 bin_ordinal(F.col("value"), bin_labels, null_label).cast("int").alias("ordinal")))
    return y.unionByName(r).unionByName(b)


def filter_equals_fallback(df: DataFrame, choices: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows equal to the value of the first (column, value) choice whose column exists."""
    for col, val in choices:
        if col in df.columns:
            return df.filter(F.col(col) == F.lit(val))
    raise ValueError("none of the choice columns exist: " + ", ".join(c for c, _ in choices))


def ordered_series(df: DataFrame, order: str = "date", cols: Sequence[str] = ("year", "dollar_price", "date"),
                   ties: Sequence[str] = ()) -> DataFrame:
    """``cols`` by ``order``; a unique column in ``ties`` makes the order total and lets the sort split one date."""
    return df.select(*existing(df, cols)).orderBy(order, *ties)


def filter_selected(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Rows whose ``col`` is one of ``values``, however many; no values keep no rows."""
    return df.filter(F.col(col).isin(*values))


def filter_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(cols))


def snapshot_at(df: DataFrame, year_col: str = "year", year: int | None = None) -> DataFrame:
    """Rows of ``year``; by default the latest year (a scalar subquery)."""
    if year is not None:
        return df.filter(F.col(year_col) == F.lit(year))
    return df.filter(F.col(year_col) == df.agg(F.max(year_col)).scalar())


def latest_per_entity(df: DataFrame, mode: str, code: str = "iso_a3", year: str = "year", min_rows: int = 10,
                      cols: Sequence[str] = ("iso_a3", "name", "USD_raw", "year"),
                      tiebreak: Sequence[str] = ("name", "USD_raw"), index: str = "USD_raw") -> DataFrame:
    """``mode`` "year": the rows of the latest year; "per_key": the latest row per code.

    "enough": the first, or if that year has fewer than ``min_rows`` rows the second.
    Both branches are plans; the choice rides on a scalar subquery (latest
    year and its row count), so nothing reaches the driver.
    The per-code branch is a ``max_by`` aggregate (partial, skew-safe), not a
    window over a possibly huge code partition.  Ties: larger (tiebreak...) wins.
    """
    cols = existing(df, cols)
    base = df.select(*cols).na.drop()
    # one row: the latest year and its row count (a partial aggregate, then a
    # global one over at most one row per calendar year)
    latest = (base.groupBy(year).agg(F.count(F.lit(1)).alias("__n"))
              .agg(F.struct(F.max(year).alias("y"), F.max_by("__n", year).alias("n")).alias("s")).scalar())
    if mode not in ("year", "per_key", "enough"):
        raise ValueError("mode must be 'year', 'per_key' or 'enough'")
    whole_year = latest["n"] >= min_rows if mode == "enough" else F.lit(mode == "year")
    in_latest = base.filter((F.col(year) == latest["y"]) & whole_year)
    order_key = F.struct(*[F.col(c) for c in [year, *[t for t in tiebreak if t in cols]]])
    per_code = (base.groupBy(code).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order_key).alias("__r"))
                .select("__r.*"))
    fallback = per_code.filter(~whole_year)
    out = in_latest.unionByName(fallback)
    return out.withColumn(f"{index}_pct", pct_round(index, 1)) if index in cols else out
