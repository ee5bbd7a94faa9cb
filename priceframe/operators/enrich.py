"""Enrichment: raw index, per-key trend lines, per-capita panel, fill of missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clamp_min, guarded_ratio
from ._util import BROADCAST_BYTES, broadcast_if_small


def raw_index(df: DataFrame, price: str, entity: str, base: str, period: str,
              out: str = "USD_raw") -> DataFrame:
    """``(price − base_mean) / base_mean`` where base_mean is the base entity's mean per period.

    The base means are one row per period; they are broadcast if their written
    size allows (calendar years do), so the fact side is not shuffled then.
    ``df`` is read twice: pass a written frame if it is costly.
    """
    base_means = (df.filter(F.col(entity) == F.lit(base))
                  .groupBy(period).agg(F.avg(price).alias("__base")))
    joined = df.join(broadcast_if_small(base_means), on=period, how="left")
    return joined.withColumn(out, F.try_divide(F.col(price) - F.col("__base"), F.col("__base"))).drop("__base")


def trend_fit(df: DataFrame, key: str, x: str, y: str, center: float = 0.0) -> DataFrame:
    """Per key least-squares line ``y ~ x`` on a centred ``x`` (one aggregate, map-side partial).

    Output: key, slope, intercept (at ``x = center``), y_mean, n.  ``slope`` is
    null with one point or a constant ``x``; the extrapolation then uses the mean.
    Keys without any point produce no row.
    """
    pts = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    xc = F.col(x).cast("double") - F.lit(float(center))
    return pts.groupBy(key).agg(
        F.regr_slope(F.col(y), xc).alias("slope"),
        F.regr_intercept(F.col(y), xc).alias("intercept"),
        F.avg(y).alias("y_mean"),
        F.count(F.lit(1)).alias("n"),
    )


def year_grid(keys: DataFrame, key: str, lo: int, hi: int, year_col: str = "year") -> DataFrame:
    """Every year in ``[lo, hi]`` for each key (a generator, no join)."""
    return keys.select(key, F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias(year_col))


def trend_extrapolate(fit: DataFrame, key: str, lo: int, hi: int, floor: float | None = 1.0,
                      center: float = 0.0, year_col: str = "year", out: str = "estimate") -> DataFrame:
    """Evaluate each fitted line on ``[lo, hi]``; fitted values are floored at ``floor``.

    A key with a single point (null slope) is the constant mean, not floored.
    """
    grid = year_grid(fit, key, lo, hi, year_col).join(fit, on=key)
    line = F.col("intercept") + F.col("slope") * (F.col(year_col).cast("double") - F.lit(float(center)))
    fitted = clamp_min(line, floor) if floor is not None else line
    est = F.when(F.col("slope").isNull(), F.col("y_mean")).otherwise(fitted)
    return grid.select(key, F.col(year_col).cast("int").alias(year_col), est.alias(out))


def join_panel(left: DataFrame, right: DataFrame, on: Sequence[str], num: str, den: str,
               out: str, scale: float = 1.0) -> DataFrame:
    """Inner join two (key, year) panels and keep the guarded ratio ``num*scale/den``.

    Rows whose ratio is null (missing or non-positive denominator) are dropped.
    """
    j = left.join(right, on=list(on), how="inner")
    return (j.select(*on, guarded_ratio(num, den, scale).alias(out))
            .filter(F.col(out).isNotNull()))


def unique_panel(panel: DataFrame, keys: Sequence[str], value: str, order_by: str | None = None) -> DataFrame:
    """One row per key: the value of the smallest ``order_by``; without one, a key with two values raises."""
    if order_by is None:
        low, high = F.min(value), F.max(value)
        conflict = F.raise_error(F.concat(F.lit(f"two values of {value} for one key: "), low.cast("string"),
                                          F.lit(" and "), high.cast("string")))
        return panel.groupBy(*keys).agg(F.when(low.eqNullSafe(high), low).otherwise(conflict).alias(value))
    return panel.groupBy(*keys).agg(F.min_by(value, order_by).alias(value))


def join_fill(df: DataFrame, panel: DataFrame, df_keys: Sequence[str], panel_keys: Sequence[str],
              value: str, max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left join a (key, year) panel onto the facts; helper keys are dropped.

    The panel must be unique on its keys (use ``unique_panel``), so the fact row
    count never changes.  The panel is broadcast only after its bytes are
    checked against ``max_broadcast_bytes``; beyond that it is a shuffle join.
    """
    p = panel.select(*[F.col(k).alias(f"__pk{i}") for i, k in enumerate(panel_keys)], F.col(value))
    p = broadcast_if_small(p, max_broadcast_bytes)
    cond = None
    for i, k in enumerate(df_keys):
        c = df[k] == p[f"__pk{i}"]
        cond = c if cond is None else cond & c
    out = df.join(p, cond, "left")
    return out.drop(*[f"__pk{i}" for i in range(len(panel_keys))])


def join_fill_bucketed(df: DataFrame, panel: DataFrame, df_keys: Sequence[str], panel_keys: Sequence[str],
                       value: str, buckets: int, salts: int, salt: str) -> DataFrame:
    """``join_fill`` for facts bucketed by ``df_keys`` and ``salt``, with a panel beyond a broadcast.

    The panel, unique on its keys, is repeated once per salt and dealt to the
    facts' ``buckets``; the facts are not shuffled, however often they are joined.
    The columns of the keys must have one type on both sides.
    """
    names = [f"__pk{i}" for i in range(len(panel_keys))]
    p = panel.select(*[F.col(k).alias(n) for k, n in zip(panel_keys, names, strict=True)], F.col(value),
                     F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__ps"))
    p = p.repartition(buckets, *names, "__ps").hint("merge")
    cond = df[salt] == p["__ps"]
    for k, n in zip(df_keys, names, strict=True):
        cond = cond & (df[k] == p[n])
    return df.join(p, cond, "left").drop(*names, "__ps", salt)


def fill_from(df: DataFrame, target: str, source: str, zero_is_missing: bool = True) -> DataFrame:
    """``target = coalesce(target, source)``; an absent target becomes the source. Drops ``source``.

    ``zero_is_missing`` treats a source value of 0 as missing (zero-income cells).
    """
    src = F.col(source)
    if zero_is_missing:
        src = F.when(src != 0, src)
    if target in df.columns:
        return df.withColumn(target, F.coalesce(F.col(target), src)).drop(source)
    return df.withColumn(target, src).drop(source)
