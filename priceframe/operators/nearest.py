"""Nearest name within a similarity cutoff: a search by growing edit distance, and banded MinHash candidates.

Both give ``(qkey, dkey, score)`` with ``score = 1 − lev(q, d) / max(|q|, |d|)``.

``nearest_keys`` (exact) asks for the best name only, so it looks for near ones
first.  Round 0 joins equal keys; round 1 joins keys that are equal after at
most one deletion in each, which all pairs at distance 1 are; a later round with
limit K joins on the 2K + 1 rarest bigrams of either key (two keys within K edits
share all but 2K of their padded bigrams).  The limit doubles from round to
round.  A query goes on only while something farther away could still beat or
tie with its best so far.  Names of one template that differ in a few characters
thus cost a query its own neighbours, not the whole cluster: pairs at distance 2
are never formed for a query with a name at distance 1.

``minhash_candidates`` (approximate, for dictionaries whose q-gram lists are too
long) joins keys that agree on all rows of a MinHash band over their bigrams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import broadcast_if_small, materialize

PAD_START, PAD_END = "\u0002", "\u0003"
#: 16 bands of 3 rows find a pair that shares 61 % of its bigrams (0.88 similar at worst) 98 times in 100.
BANDS, ROWS = 16, 3


def similarity(a: Column, b: Column) -> Column:
    """``1 − lev(a, b) / max(|a|, |b|)``; two empty strings are identical."""
    m = F.greatest(F.length(a), F.length(b))
    return F.when(m == 0, F.lit(1.0)).otherwise(F.lit(1.0) - F.try_divide(F.levenshtein(a, b), m))


def bigrams(key: Column) -> Column:
    """The bigrams of the padded key, in order, with repeats."""
    padded = F.concat(F.lit(PAD_START), key, F.lit(PAD_END))
    return F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, F.lit(2)))


def numbered_bigrams(keys: DataFrame) -> DataFrame:
    """``(key, len, token)``: each key's bigrams, a repeated one told apart by its number."""
    grams = keys.select("key", F.length("key").alias("len"), F.posexplode(bigrams(F.col("key"))).alias("at", "gram"))
    # One name's own bigrams: a window as long as the name.
    nth = F.row_number().over(Window.partitionBy("key", "gram").orderBy("at"))
    return grams.select("key", "len", F.concat("gram", F.lit("#"), nth.cast("string")).alias("token"))


def deletions(keys: DataFrame, out: str) -> DataFrame:
    """``(out, variant)``: the hashes of a key and of it without one character, once each."""
    n = F.length("key")
    cut = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(
        F.concat(F.substring("key", F.lit(1), i - 1), F.substring(F.col("key"), i + 1, n))))
    cut = F.when(n > 0, cut).otherwise(F.array().cast("array<bigint>"))
    return keys.select(F.col("key").alias(out), F.explode(F.array_distinct(F.concat(F.array(F.xxhash64("key")), cut))).alias("variant"))


def rarest(tokens: DataFrame, freq: DataFrame, limit: int) -> DataFrame:
    """``(key, len, token)``: each key's ``2 * limit + 1`` rarest tokens (all, if it has fewer); unlisted ones are rarest."""
    rank = F.row_number().over(Window.partitionBy("key").orderBy("freq", "token"))
    return tokens.join(freq, "token", "left").withColumn("freq", F.coalesce("freq", F.lit(0))).withColumn("r", rank) \
        .where(F.col("r") <= 2 * limit + 1).select("key", "len", "token")


def _by_deletions(q: DataFrame, d: DataFrame) -> DataFrame:
    """Every ``(qkey, dkey)`` within one edit, and some within two."""
    return deletions(q, "qkey").join(deletions(d, "dkey"), "variant").select("qkey", "dkey").distinct()


def _by_bigrams(q: DataFrame, d: DataFrame, dt: DataFrame, freq: DataFrame, limit: int) -> DataFrame:
    """Every ``(qkey, dkey)`` within ``limit`` edits, and others; ``dt`` and ``freq``: the dictionary's bigrams and their counts."""
    qr = rarest(numbered_bigrams(q), freq, limit).select(F.col("key").alias("qkey"), F.col("len").alias("qlen"), "token")
    # The partner's length is part of the join key: a band of 2 * limit + 1 lengths.
    band = F.sequence(F.greatest(F.col("qlen") - limit, F.lit(0)), F.col("qlen") + limit)
    qr = qr.withColumn("len", F.explode(band))
    dr = rarest(dt, freq, limit).withColumnRenamed("key", "dkey")
    found = qr.join(dr, ["token", "len"]).select("qkey", "dkey")
    # Keys so short that the edits may take all their bigrams: theirs are met by length alone.
    n = F.length("key")
    tiny_q = q.where(n + 1 <= 2 * limit).select(F.col("key").alias("qkey"), F.explode(
        F.sequence(F.greatest(n - limit, F.lit(0)), n + limit)).alias("len"))
    tiny_d = d.where(n + 1 <= 2 * limit).select(F.col("key").alias("dkey"), n.alias("len"))
    return found.unionByName(tiny_q.join(tiny_d, "len").select("qkey", "dkey")).distinct()


def nearest_keys(queries: DataFrame, dictionary: DataFrame, cutoff: float = 0.88, note=None) -> DataFrame:
    """``(qkey, dkey, score)``: the best dictionary key of every query key with one at ``cutoff`` or more; exact.

    ``queries(key)`` and ``dictionary(key)``; nulls are left out, repeats count
    once.  Ties go to the larger key.  ``note(limit, pairs)``, if given, is
    called with the number of pairs a round compares.  ``cutoff`` must be over 0.5.
    """
    if cutoff <= 0.5:
        raise ValueError("the nearest search needs a cutoff over 0.5")
    q, d = (materialize(x.select("key").where("key is not null").distinct(), "nearest-keys") for x in (queries, dictionary))
    best, limit, dt, freq = None, 0, None, None
    live = q
    while True:
        if limit > 1 and dt is None:
            dt = materialize(numbered_bigrams(d), "nearest-bigrams")
            freq = broadcast_if_small(dt.groupBy("token").agg(F.count("*").alias("freq")))
        pairs = live.join(d, "key").select(F.col("key").alias("qkey"), F.col("key").alias("dkey")) if limit == 0 else \
            _by_deletions(live, d) if limit == 1 else _by_bigrams(live, d, dt, freq, limit)
        pairs = materialize(pairs, "nearest-pairs")
        if note:
            note(limit, pairs.count())
        scored = pairs.where(F.levenshtein("qkey", "dkey", limit) >= 0) \
            .withColumn("score", similarity(F.col("qkey"), F.col("dkey"))).where(F.col("score") >= cutoff)
        found = scored if best is None else scored.unionByName(best)
        top = F.max_by(F.struct("dkey", "score"), F.struct("score", "dkey")).alias("b")
        best = materialize(found.groupBy("qkey").agg(top).select("qkey", "b.dkey", "b.score"), "nearest-best")
        # The best score at limit + 1 edits or more: a partner that is as much longer.
        n = F.length("key")
        reach = F.when(n + limit + 1 > 0, 1.0 - F.lit(limit + 1) / (n + limit + 1))
        live = q.where(reach >= cutoff - 1e-12).join(best.select(F.col("qkey").alias("key"), "score"), "key", "left") \
            .where(F.col("score").isNull() | (reach >= F.col("score") - 1e-12)).select("key")
        live = materialize(live, "nearest-live")
        if not live.head(1):
            return best
        limit = max(1, 2 * limit)


def minhash_bands(keys: DataFrame, out: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(out, band)``: one hash per band of the MinHash of the key's bigrams, of ``rows`` minima each."""
    grams = bigrams(F.col("key"))

    def hashed(i):
        return lambda g: F.xxhash64(F.lit(i), g)

    least = [F.array_min(F.transform("grams", hashed(i))) for i in range(bands * rows)]
    made = [F.xxhash64(F.lit(b), *least[b * rows:(b + 1) * rows]) for b in range(bands)]
    return keys.select("key", grams.alias("grams")).select(F.col("key").alias(out), F.explode(F.array(*made)).alias("band"))


def minhash_candidates(queries: DataFrame, dictionary: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(qkey, dkey)`` that agree on a band: most pairs with much in common, not all (recall is measured in the tests)."""
    q, d = (x.select("key").where("key is not null").distinct() for x in (queries, dictionary))
    return minhash_bands(q, "qkey", bands, rows).join(minhash_bands(d, "dkey", bands, rows), "band") \
        .select("qkey", "dkey").distinct()
