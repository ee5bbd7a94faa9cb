"""Statistics behind the charts: correlation, OLS line, histogram, density, box and violin stats,
repeatable samples.

Per-group statistics are aggregates (map-side partial); the few results that
must meet the rows again (bin edges, fences, sample fraction) are one row per
group, joined back on the group key — or, ungrouped, attached as a scalar
subquery.  No operator here joins without a key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import decade_label, pct_round
from ._util import broadcast_if_small
from .clean import existing
from .sketches import sketch_quartiles

GROUP = "__g"
# Modulus and multiplier of the repeatable hash (two Park–Miller MINSTD steps,
# so small consecutive keys are spread too): integer arithmetic any SQL engine
# can repeat, every product stays below 2^62.
HASH_MOD = 2147483647
HASH_MUL = 48271


def _keyed(df: DataFrame, by: str | Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    if by is None:
        return df.withColumn(GROUP, F.lit(0)), [GROUP]
    keys = [by] if isinstance(by, str) else list(by)
    return df, keys


def _unkey(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.drop(GROUP) if keys == [GROUP] else df


def _attach(rows: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Put per-group statistics next to the rows.

    Ungrouped: the statistics are one row, attached as a scalar subquery
    (computed once, no join).  Grouped: one row per group, written once and
    measured; broadcast when its files are small enough (the rows
    are then never shuffled by a possibly hot group key), else a shuffle join
    that AQE's skew handling splits.
    """
    if keys == [GROUP]:
        cols = [c for c in stats.columns if c != GROUP]
        one = stats.select(F.struct(*cols).alias("__s")).scalar()
        return rows.select("*", *[one[c].alias(c) for c in cols])
    return rows.join(broadcast_if_small(stats), on=keys)


# ------------------------------------------------------------------ correlation / line
def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation with pairwise deletion (``F.corr``; nulls are skipped, not zeroed)."""
    return df.agg(F.corr(x, y).alias("corr"), F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form (col_a, col_b, corr) with listwise deletion; one aggregate.

    Fewer than two existing columns → empty result.
    """
    cols = existing(df, cols)
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    d = df.select(*cols).na.drop()
    cells = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            c = F.corr(a, b)
            cells.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), c.alias("corr")))
            if a != b:
                cells.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), c.alias("corr")))
    return d.agg(F.array(*cells).alias("__r")).select(F.inline("__r"))


def ols_line(df: DataFrame, x: str, y: str, by: str | None = None) -> DataFrame:
    """Least-squares line y ~ x (slope, intercept, r², n) and the x span to draw it over."""
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    aggs = [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
            F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"),
            F.min(x).alias("x_min"), F.max(x).alias("x_max")]
    return d.groupBy(by).agg(*aggs) if by else d.agg(*aggs)


# ------------------------------------------------------------------ histogram / density
def histogram(df: DataFrame, value: str, bins: int = 40, by: str | None = None) -> DataFrame:
    """Equal-width bins over [min, max] (last bin closed), every bin listed, zero counts included.

    Output: [by,] bin, lo, hi, count.  All values equal → a single bin holds them.
    """
    d, keys = _keyed(df.filter(F.col(value).isNotNull() & ~F.isnan(value)), by)
    st = d.groupBy(*keys).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    width = (F.col("__hi") - F.col("__lo")) / F.lit(bins)
    idx = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * F.lit(bins)),
                F.lit(bins - 1))).cast("int")
    counts = _attach(d, st, keys).groupBy(*keys, "__lo", "__hi", idx.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    # every bin listed: a per-group map bin → count (at most ``bins`` entries), exploded over all bins
    per_group = counts.groupBy(*keys, "__lo", "__hi").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "count"))).alias("__m"))
    out = per_group.select(*keys, "__lo", "__hi", "__m",
                           F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")).select(
        *keys, "bin",
        (F.col("__lo") + F.col("bin") * width).alias("lo"),
        (F.col("__lo") + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce(F.col("__m")[F.col("bin")], F.lit(0)).cast("long").alias("count"))
    return _unkey(out, keys)


def kde_curve(df: DataFrame, value: str, by: str | None = None, grid: int = 200, cells: int = 2000) -> DataFrame:
    """Gaussian density on ``grid`` points over [min, max] (cut = 0), Scott bandwidth σ·n^(−1/5).

    The data are first reduced to ``cells`` equal-width cells per group (count
    and mean per cell); the kernel sum then runs over cells × grid points,
    a fixed size per group whatever the row count.  Output: [by,] point, x, density.
    """
    d, keys = _keyed(df.filter(F.col(value).isNotNull() & ~F.isnan(value)), by)
    st = d.groupBy(*keys).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"),
                              F.count(F.lit(1)).alias("__n"), F.stddev_samp(value).alias("__sd"))
    span = F.col("__hi") - F.col("__lo")
    cell = F.when(span == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - F.col("__lo")) / span * F.lit(cells)), F.lit(cells - 1))).cast("int")
    bw = F.col("__sd") * F.pow(F.col("__n").cast("double"), F.lit(-0.2))
    cell_stats = (_attach(d, st.select(*keys, "__lo", "__hi", "__n", bw.alias("__h")), keys)
                  .groupBy(*keys, "__lo", "__hi", "__n", "__h", cell.alias("cell"))
                  .agg(F.count(F.lit(1)).alias("w"), F.avg(value).alias("m")))
    # each (≤ cells) cell contributes to every grid point: a generator, fixed size per group
    pts = cell_stats.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"))
    pts = pts.withColumn("x", F.col("__lo") + F.col("point") * (F.col("__hi") - F.col("__lo")) / F.lit(grid - 1))
    z = (F.col("x") - F.col("m")) / F.col("__h")
    contrib = F.col("w") * F.exp(F.lit(-0.5) * z * z)
    norm = F.lit(1.0 / math.sqrt(2 * math.pi)) / (F.col("__n") * F.col("__h"))
    dens = (pts.groupBy(*keys, "point", "x", "__n", "__h")
            .agg(F.sum(F.when(F.col("__h") > 0, contrib)).alias("__s"))
            .select(*keys, "point", "x", F.when(F.col("__h") > 0, F.col("__s") * norm).alias("density")))
    return _unkey(dens, keys)


# ------------------------------------------------------------------ box / violin
def _bucket(v: F.Column, lo: F.Column, hi: F.Column, buckets: int) -> F.Column:
    """0 for ``lo``, ``buckets + 1`` for ``hi``, else the slice 1..buckets of the window a value between them is in.

    A window that spans zero or more than a factor of four is sliced by sign and
    logarithm, so that a slice spans about a factor of two at most; any other one
    by equal widths.  Every double has its place, the infinite ones as ``lo`` or ``hi``.
    """
    top = F.lit(1.7976931348623157e308)

    def place(x):  # above 0 for the least positive double, and finite for all
        x = F.least(F.greatest(x, -top), top)
        return F.when(x == 0, F.lit(0.0)).otherwise(F.signum(x) * (F.log(F.abs(x)) + F.lit(746.0)))

    wide = (F.signum(lo) * F.signum(hi) <= 0) | (
        F.greatest(F.abs(lo), F.abs(hi)) / F.lit(4.0) > F.least(F.abs(lo), F.abs(hi)))
    share = F.when(wide, F.try_divide(place(v) - place(lo), place(hi) - place(lo))) \
        .otherwise(F.try_divide(v - lo, hi - lo))
    return (F.when(v == lo, F.lit(0)).when(v == hi, F.lit(buckets + 1))
            .otherwise(F.least(F.floor(share * F.lit(buckets)), F.lit(buckets - 1)) + 1)).cast("int")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: str | Sequence[str] | None = None,
                    buckets: int = 4096, small: int = 200_000) -> DataFrame:
    """Exact quantiles (linear interpolation, as ``percentile``) without holding a group in one task.

    The keys and values are written once.  Each needed order statistic (ranks
    ⌊(n−1)p⌋ and ⌈(n−1)p⌉ per group) gets a value window [lo, hi] and the count of
    values below it.  A round histograms every window into slices (``_bucket``)
    — a partial aggregate, so a hot group costs one small row per task — keeps the
    slice holding the rank, and writes the values that are still in a window,
    which the next round reads.  A window holding at most ``small`` values is
    resolved by sorting just those values.  The first round leaves a factor of two,
    each later one a 4096th, so a handful of rounds ends it for any values, infinite
    ones included.  The driver loop only sees window counts.
    Output: [by,] n, q0, q1, ... (one column per prob, in order).
    """
    from pyspark.sql import Window

    from ._util import materialize

    d, keys = _keyed(df.filter(F.col(value).isNotNull() & ~F.isnan(value)), by)
    d = materialize(d.select(*keys, F.col(value).cast("double").alias("__v")), "quantile-values")
    st = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
    pos = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]
    rank_cols = [F.floor(x).cast("long") for x in pos] + [F.ceil(x).cast("long") for x in pos]
    st = materialize(st, "quantile-stats")
    state = (st.select(*keys, "lo", "hi", "n", F.explode(F.array_distinct(F.array(*rank_cols))).alias("k"))
             .select(*keys, "k", "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("c")))
    wkeys = [*keys, "k"]
    wk = [*keys, "lo", "hi", "below", "c"]
    resolved = []
    while True:
        resolved.append(state.filter(F.col("lo") == F.col("hi")).select(*wkeys, F.col("lo").alias("val")))
        active = state.filter(F.col("lo") < F.col("hi"))
        cnt = active.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c") > small).alias("big")).first()
        if cnt["n"] == 0:
            break
        # Ranks whose windows coincide (all of a group's ranks in the first
        # round) share one histogram: rows meet each distinct window once.
        wins = broadcast_if_small(active.select(*wk).distinct())
        rows = d.join(wins, on=keys).filter((F.col("__v") >= F.col("lo")) & (F.col("__v") <= F.col("hi")))
        # one pass: small windows collect their (≤ small) values under bucket −1,
        # large windows count per slice
        few = F.col("c") <= small
        b = F.when(few, F.lit(-1)).otherwise(_bucket(F.col("__v"), F.col("lo"), F.col("hi"), buckets))
        agg = materialize(rows.groupBy(*wk, b.alias("__b")).agg(
            F.count(F.lit(1)).alias("cnt"), F.min("__v").alias("bmin"), F.max("__v").alias("bmax"),
            F.collect_list(F.when(few, F.col("__v"))).alias("__vs")), "quantile-round")
        per_rank = active.select(*wk, "k").join(agg, on=wk)
        resolved.append(per_rank.filter(F.col("__b") == -1).select(
            *wkeys, F.element_at(F.sort_array("__vs"), (F.col("k") - F.col("below") + 1).cast("int")).alias("val")))
        if cnt["big"] == 0:
            break
        hist = agg.filter(F.col("__b") >= 0).drop("__vs")
        w = Window.partitionBy(*wk).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("__before", F.coalesce(F.sum("cnt").over(w), F.lit(0)))
        start = F.col("below") + F.col("__before")
        chosen = active.select(*wk, "k").join(hist, on=wk).filter(
            (start <= F.col("k")) & (F.col("k") < start + F.col("cnt")))
        state = materialize(chosen.select(*wkeys, F.col("bmin").alias("lo"), F.col("bmax").alias("hi"),
                                          start.alias("below"), F.col("cnt").alias("c")), "quantile-state")
        # Only the values between the bounds of a window that is still open are read again, once each.
        left = broadcast_if_small(state.filter(F.col("lo") < F.col("hi"))
                                  .select(*[F.col(k).alias(f"__w{i}") for i, k in enumerate(keys)], "lo", "hi").distinct())
        inside = (F.col("__v") >= F.col("lo")) & (F.col("__v") <= F.col("hi"))
        for i, k in enumerate(keys):
            inside = inside & (F.col(k) == F.col(f"__w{i}"))
        d = materialize(d.join(left, inside, "left_semi"), "quantile-values")
    vals = resolved[0]
    for r in resolved[1:]:
        vals = vals.unionByName(r)
    # one row per group: rank → value (at most 2·len(probs) entries), one join back
    vmap = vals.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("k", "val"))).alias("__vm"))
    out = st.select(*keys, "n").join(vmap, on=keys)
    for i, p in enumerate(probs):
        r = (F.col("n") - 1) * F.lit(float(p))
        k0, k1 = F.floor(r).cast("long"), F.ceil(r).cast("long")
        v0, v1 = F.col("__vm")[k0], F.col("__vm")[k1]
        out = out.withColumn(f"q{i}", F.when((v0 == v1) | (r == k0), v0).otherwise(v0 + (r - k0) * (v1 - v0)))
    out = out.drop("__vm")
    return _unkey(out, keys)


def quartiles(df: DataFrame, value: str, by: str | None = None, approx: bool = False,
              accuracy: int = 100000) -> DataFrame:
    """q1, median, q3 (linear interpolation) per group.

    Exact by default (``exact_quantiles``: bounded work per task even for a
    hot group); ``approx`` uses the mergeable ``percentile_approx`` sketch.
    """
    if not approx:
        q = exact_quantiles(df, value, [0.25, 0.5, 0.75], by)
        return q.select(*[c for c in q.columns if c not in ("q0", "q1", "q2")],
                        F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    d, keys = _keyed(df.filter(F.col(value).isNotNull() & ~F.isnan(value)), by)
    probs = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    out = d.groupBy(*keys).agg(F.percentile_approx(value, probs, accuracy).alias("__q"),
                               F.count(F.lit(1)).alias("n")).select(
        *keys, "n", F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("median"), F.col("__q")[2].alias("q3"))
    return _unkey(out, keys)


def box_stats(df: DataFrame, by: str | None, value: str, whisker: float = 1.5,
              approx: bool = False, sketches: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Box statistics per group and the outlier rows.

    Pass 1: quartiles, from stored ``sketches`` (``sketches.quantile_sketches`` over parts of the groups) if given.  Pass 2 (join back on the group key): whiskers are the
    most extreme values inside ``[q1 − w·IQR, q3 + w·IQR]``; rows outside are outliers.
    """
    q = quartiles(df, value, by, approx) if sketches is None else sketch_quartiles(sketches, by)
    d, keys = _keyed(df.filter(F.col(value).isNotNull() & ~F.isnan(value)), by)
    q, _ = _keyed(q, by)
    iqr = F.col("q3") - F.col("q1")
    fences = q.select(*keys, "n", "q1", "median", "q3",
                      (F.col("q1") - F.lit(whisker) * iqr).alias("fence_lo"),
                      (F.col("q3") + F.lit(whisker) * iqr).alias("fence_hi"))
    j = _attach(d, fences.select(*keys, "fence_lo", "fence_hi"), keys)
    inside = (F.col(value) >= F.col("fence_lo")) & (F.col(value) <= F.col("fence_hi"))
    w = j.groupBy(*keys).agg(F.min(F.when(inside, F.col(value))).alias("whisker_lo"),
                             F.max(F.when(inside, F.col(value))).alias("whisker_hi"),
                             F.count_if(~inside).alias("n_outliers"))
    stats = _unkey(fences.join(w, on=keys), keys)
    outliers = _unkey(j.filter(~inside).drop("fence_lo", "fence_hi"), keys)
    return stats, outliers


def violin_stats(df: DataFrame, year: str, value: str, grid: int = 200, cells: int = 2000,
                 sketches: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Per decade: density limited to the data range (cut = 0) and the inner quartiles.

    ``sketches``: stored quantile sketches with the year among their keys; a decade's are merged.
    """
    d = df.filter(F.col(year).isNotNull()).withColumn("decade", decade_label(year))
    density = kde_curve(d, value, by="decade", grid=grid, cells=cells)
    if sketches is None:
        return density, quartiles(d, value, by="decade")
    parts = sketches.filter(F.col(year).isNotNull()).withColumn("decade", decade_label(year))
    return density, sketch_quartiles(parts, "decade")


# ------------------------------------------------------------------ repeatable sampling
def key_hash(df: DataFrame, key: str, seed: int = 42) -> F.Column:
    """Deterministic hash in [0, HASH_MOD) of a key of any type: independent of partitioning.

    Integers enter as they are, anything else through its 64-bit hash.
    """
    whole = isinstance(df.schema[key].dataType, T.IntegralType)
    k = F.col(key).cast("long") if whole else F.xxhash64(key)
    # Reduced before the seed is added: no overflow near the ends of the range.
    k = F.pmod(F.pmod(k, F.lit(HASH_MOD)) + F.lit(seed), F.lit(HASH_MOD))
    k = F.pmod(k * F.lit(HASH_MUL), F.lit(HASH_MOD))
    return F.pmod(k * F.lit(HASH_MUL), F.lit(HASH_MOD))


def sample_rows(df: DataFrame, key: str, fraction: float, seed: int = 42,
                dropna: Sequence[str] | None = None) -> DataFrame:
    """About ``fraction`` of the rows, chosen by a hash of ``key``: the same rows however the input is partitioned.

    Whether a row is in the sample does not depend on the other rows; rows
    null in a ``dropna`` column are left out of it.
    """
    d = df.na.drop(subset=list(dropna)) if dropna else df
    return d.filter(key_hash(df, key, seed) < F.lit(fraction * HASH_MOD))


def sample_fixed(df: DataFrame, key: str, k: int, seed: int = 42, dropna: Sequence[str] | None = None) -> DataFrame:
    """Exactly ``k`` rows (all, if there are fewer): those with the least hashes of ``key``, in that order.

    Every task keeps its own k least and they merge, so no count of the rows is
    needed and no task holds more.  The same rows on any partitioning if
    ``key`` is unique; a sample of fewer rows is part of a larger one.
    """
    d = df.na.drop(subset=list(dropna)) if dropna else df
    return d.orderBy(key_hash(df, key, seed), key).limit(k)


def split_train_test(df: DataFrame, key: str, ratio: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Repeatable split by key hash (same rows whatever the partitioning)."""
    train_cond = key_hash(df, key, seed) < F.lit(ratio * HASH_MOD)
    return df.filter(train_cond), df.filter(~train_cond)


def scatter_by_decade(df: DataFrame, fraction: float, x: str = "GDP_dollar", y: str = "USD_raw", year: str = "year",
                      key: str = "obs_id", name: str = "name", seed: int = 42) -> DataFrame:
    """A repeatable sample of the points with their decade, for drawing; ``scatter_cells`` counts all of them."""
    cols = existing(df, [x, y, year, name, key])
    s = sample_rows(df.select(*cols), key, fraction, seed, dropna=[c for c in cols if c != key])
    return s.withColumn("decade", decade_label(year))


def scatter_cells(df: DataFrame, x_width: float, y_width: float, x: str = "GDP_dollar", y: str = "USD_raw",
                  year: str = "year") -> DataFrame:
    """(decade, x_cell, y_cell, n): every point counted in the cell of the plane that it is in; one aggregate."""
    d = df.na.drop(subset=[x, y, year])
    return d.groupBy(decade_label(year).alias("decade"), F.floor(F.col(x) / F.lit(x_width)).alias("x_cell"),
                     F.floor(F.col(y) / F.lit(y_width)).alias("y_cell")).agg(F.count(F.lit(1)).alias("n"))


def scatter_snapshot(df: DataFrame, year: int | None = None, x: str = "GDP_dollar", y: str = "USD_raw",
                     year_col: str = "year", color: str = "region", size: str = "dollar_price",
                     name: str = "name") -> tuple[DataFrame, DataFrame]:
    """Points of one year (default latest) with percent index, plus the overall OLS line."""
    from .select import snapshot_at

    d = df.na.drop(subset=[x, y])
    snap = snapshot_at(d, year_col, year)
    pts = snap.select(*existing(snap, [name, year_col, x, y, color, size]),
                      pct_round(y, 1).alias(f"{y}_pct"))
    return pts, ols_line(snap.withColumn(f"{y}_pct", pct_round(y, 1)), x, f"{y}_pct")
