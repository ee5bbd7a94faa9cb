"""The facet cube: mergeable sums per facet combination and entity, from which the dashboard's tables are read.

``facet_cube`` is one aggregate over the facts, at most one row per (year,
region, level, code, name) that occurs.  Written once, it answers every facet
choice: the choice filters cube rows (``select.facet_filter`` works on it), and
options, KPIs, map and ranking merge what is left.  Sums, counts, minima and
maxima merge exactly; the facts are not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .select import facet_filter, facet_options
from .summarize import kpi_from_groups, map_from_means, top_bottom_of

FACETS = ("year", "region", "gdp_level")


def facet_cube(df: DataFrame, index: str = "USD_raw", price: str = "dollar_price", entity: str = "name",
               code: str = "iso_a3", facets: Sequence[str] = FACETS) -> DataFrame:
    """(facets, code, entity, n) and sum, count, min and max of ``index`` and ``price``; null keys are groups of their own."""
    states = []
    for c in (index, price):
        states += [F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_count"), F.min(c).alias(f"{c}_min"),
                   F.max(c).alias(f"{c}_max")]
    return df.groupBy(*facets, code, entity).agg(F.count(F.lit(1)).alias("n"), *states)


def cube_rows(cube: DataFrame, years: tuple[int, int] | None = None, regions: Sequence[str] | None = None,
              bins: Sequence[str] | None = None) -> DataFrame:
    """The cube's rows of one facet choice, as ``facet_filter`` chooses facts."""
    return facet_filter(cube, years, regions, bins, date_col=None)


def merged_mean(c: str) -> Column:
    return F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_count"))


def cube_options(cube: DataFrame) -> DataFrame:
    return facet_options(cube)


def cube_kpis(cube: DataFrame, entity: str = "name", code: str = "iso_a3", index: str = "USD_raw",
              price: str = "dollar_price") -> DataFrame:
    """``kpi_summary`` of the facts behind the cube's rows."""
    g = cube.groupBy(entity, code).agg(
        merged_mean(index).alias("__m"), F.sum(f"{index}_sum").alias("__si"), F.sum(f"{index}_count").alias("__ci"),
        F.sum(f"{price}_sum").alias("__sp"), F.sum(f"{price}_count").alias("__cp"))
    return kpi_from_groups(g, entity, code)


def cube_map(cube: DataFrame, year: str = "year", code: str = "iso_a3", name: str = "name", index: str = "USD_raw",
             price: str = "dollar_price") -> DataFrame:
    """``map_frame`` of the facts behind the cube's rows."""
    known = F.col(year).isNotNull() & F.col(code).isNotNull() & F.col(name).isNotNull()
    g = cube.filter(known).groupBy(year, code, name).agg(merged_mean(index).alias(index), merged_mean(price).alias(price))
    return map_from_means(g, name, index, price)


def cube_top_bottom(cube: DataFrame, entity: str = "name", value: str = "USD_raw", n: int = 20,
                    is_index: bool = True) -> DataFrame:
    """``top_bottom`` of the facts behind the cube's rows."""
    means = cube.filter(F.col(entity).isNotNull()).groupBy(entity).agg(merged_mean(value).alias(value))
    return top_bottom_of(means, entity, value, n, is_index)
