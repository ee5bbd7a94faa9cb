"""Wide ↔ long reshapes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import canonical_key, parse_thousands
from ..schemas import year_columns


def unpivot_years(df: DataFrame, key: str, year_cols: Sequence[str] | None = None,
                  value_name: str = "value", key_name: str | None = None) -> DataFrame:
    """Wide (key, <year>...) → (key, year int, value double), non-null values only.

    Every year column is parsed as text first (thousands separators, blanks),
    so mixed inferred types never reach ``unpivot``.
    """
    cols = list(year_cols) if year_cols is not None else year_columns(df.columns[1:] if key == df.columns[0] else df.columns)
    parsed = df.select(F.col(key).alias(key_name or key), *[parse_thousands(F.col(f"`{c}`")).alias(c.strip()) for c in cols])
    long = parsed.unpivot([key_name or key], [c.strip() for c in cols], "__year", value_name)
    return (long.select(key_name or key, F.col("__year").cast("int").alias("year"), value_name)
            .filter(F.col(value_name).isNotNull()))


def unpivot_snapshots(df: DataFrame, key: str, col_by_year: Mapping[int, str], value_name: str = "value",
                      key_name: str = "key") -> DataFrame:
    """Snapshot columns ``{year: header}`` → (key upper-trimmed, year, value), non-null only."""
    years = sorted(col_by_year)
    parsed = df.select(canonical_key(F.col(f"`{key}`"), "upper").alias(key_name),
                       *[parse_thousands(F.col(f"`{col_by_year[y]}`")).alias(str(y)) for y in years])
    long = parsed.unpivot([key_name], [str(y) for y in years], "__year", value_name)
    return (long.select(key_name, F.col("__year").cast("int").alias("year"), value_name)
            .filter(F.col(value_name).isNotNull()))


def pivot_years(df: DataFrame, key: str, year: str, value: str, years: Sequence[int]) -> DataFrame:
    """Long → wide with one column per listed year (the inverse of ``unpivot_years``)."""
    w = df.groupBy(key).pivot(year, list(years)).agg(F.first(value))
    return w.toDF(key, *[str(y) for y in years])
