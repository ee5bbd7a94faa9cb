"""Projections and row-level cleaning (one ``select`` per step, no per-column loops of plans)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import nan_to_null
from ..schemas import FACT_KEY_COLS, FACT_NUMERIC_COLS
from ._util import broadcast_if_small


def existing(df: DataFrame, cols: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in cols if c in present]


def project_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep the wished-for columns that exist, in wish-list order."""
    return df.select(*existing(df, cols))


def normalize_names(df: DataFrame, replace: Sequence[str] = (" ", "-"), trim_only: bool = False) -> DataFrame:
    """Trim headers and turn spaces/hyphens into ``_`` in one rename; colliding headers raise."""
    names = []
    for c in df.columns:
        n = c.strip()
        if not trim_only:
            for ch in replace:
                n = n.replace(ch, "_")
        names.append(n)
    if len(set(names)) != len(names):
        dup = sorted({n for n in names if names.count(n) > 1})
        raise ValueError(f"normalised headers collide: {dup}")
    return df.toDF(*names)


def cast_numeric(df: DataFrame, cols: Sequence[str] = FACT_NUMERIC_COLS) -> DataFrame:
    """Cast the listed columns that exist to double (``try_cast``: junk → null, NaN → null)."""
    targets = set(existing(df, cols))
    return df.select(*[
        nan_to_null(F.col(c).try_cast("double")).alias(c) if c in targets else F.col(c)
        for c in df.columns
    ])


def parse_date_year(df: DataFrame, date_col: str = "date", year_col: str = "year") -> DataFrame:
    """Date column → ``DateType`` (text parsed leniently) and an int year column."""
    if date_col not in df.columns:
        return df
    dtype = df.schema[date_col].dataType
    if isinstance(dtype, T.StringType):
        d = F.try_to_date(F.col(date_col))
    else:
        d = F.to_date(F.col(date_col))
    out = df.withColumn(date_col, d)
    return out.withColumn(year_col, F.year(F.col(date_col)).cast("int"))


def drop_incomplete(df: DataFrame, keys: Sequence[str] = FACT_KEY_COLS) -> DataFrame:
    """Drop rows null (or NaN) in any existing key column."""
    keys = existing(df, keys)
    return df.na.drop(subset=keys) if keys else df


def clean_facts(df: DataFrame) -> DataFrame:
    """The whole cleaning chain: names, numeric casts, date/year, drop incomplete rows."""
    df = normalize_names(df)
    df = cast_numeric(df)
    df = parse_date_year(df)
    return drop_incomplete(df)


def fill_median(df: DataFrame, col: str, rel_err: float | None = 0.01, sketches: DataFrame | None = None) -> DataFrame:
    """Null ``col`` → its median; one scalar reaches the driver.

    ``sketches`` set: the median of these stored sketches of ``col``, without a scan.

    ``rel_err`` set: the approximate median of a mergeable sketch (the
    reference's 1 % setting); ``rel_err=None``: the exact median (bounded-work
    ``exact_quantiles``).
    """
    if col not in df.columns:
        return df
    if sketches is not None:
        from .sketches import sketch_quantiles

        row = sketch_quantiles(sketches, [0.5]).first()
        med = row["q0"] if row else None
    elif rel_err is None:
        from .distribution import exact_quantiles

        med = exact_quantiles(df, col, [0.5]).first()["q0"]
    else:
        accuracy = max(1, int(round(1.0 / rel_err)))
        med = df.agg(F.percentile_approx(col, 0.5, accuracy).alias("m")).first()["m"]
    return df if med is None else df.na.fill({col: float(med)})


def exclude_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Drop rows whose ``col`` is one of ``values``; null ``col`` rows are kept."""
    return df.filter(~F.coalesce(F.col(col).isin(*values), F.lit(False)))


def map_with_default(df: DataFrame, key: str, mapping: DataFrame, map_key: str, map_value: str,
                     out: str, default: str) -> DataFrame:
    """Left-join a code → label mapping; unmapped (or null) keys get ``default``.

    Two labels for one code raise when the mapping is written, which also says
    whether it is small enough to be broadcast; a repeated pair counts once.
    """
    m = mapping.filter(F.col(map_key).isNotNull()).groupBy(F.col(map_key).alias("__mk")).agg(
        F.min(map_value).alias("__mv"), F.max(map_value).alias("__hi"))
    clash = F.concat(F.lit("two labels for the code "), F.col("__mk").cast("string"), F.lit(": "),
                     F.col("__mv").cast("string"), F.lit(", "), F.col("__hi").cast("string"))
    label = F.when(F.col("__mv") == F.col("__hi"), F.col("__mv")).when(
        F.col("__mv").isNotNull(), F.raise_error(clash).cast(mapping.schema[map_value].dataType))
    m = broadcast_if_small(m.select("__mk", label.alias("__mv")))
    joined = df.join(m, df[key] == m["__mk"], "left")
    return joined.withColumn(out, F.coalesce(F.col("__mv"), F.lit(default))).drop("__mk", "__mv")
