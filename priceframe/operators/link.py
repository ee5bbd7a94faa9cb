"""Name → code linkage: exact, alias and fuzzy tiers, cascaded.

Each tier works on *distinct* names only and hands what it could not resolve
to the next tier through a left-anti join.  The dictionary is ``(name, code)``;
duplicate names are resolved deterministically (smallest code).

Fuzzy tier without a cross product
----------------------------------
Similarity is ``1 − lev(a, b) / max(|a|, |b|)`` (``method="levenshtein"``) or
the Ratcliff–Obershelp ratio ``2M / (|a| + |b|)`` (``method="ratio"``).
Candidates come from an exact *prefix filter* over q-gram tokens (Gravano et
al., VLDB 2001, count filter; Vernica et al., SIGMOD 2010, prefix filter):

* a pair within the cutoff shares at least ``t(|a|)`` tokens, a bound that
  depends on the string's own length only;
* ordering each string's tokens by a global (rarest-first) order, two strings
  sharing ``t`` tokens must share one of their first ``n − t + 1`` tokens.

So each name emits a short, length-determined list of rare tokens; the
equi-join on token yields every qualifying pair (no pair is ever lost) while
common tokens stay out of the join.  Candidates are then verified exactly.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import canonical_key
from ._util import BROADCAST_BYTES, broadcast_if_small, materialize
from .nearest import bigrams, minhash_candidates, nearest_keys, similarity

def dictionary_keys(dictionary: DataFrame, name: str = "name", code: str = "code") -> DataFrame:
    """(key, code): canonical (lower, trimmed) name → smallest code."""
    return (dictionary.select(canonical_key(name, "lower").alias("key"), F.col(code).alias("code"))
            .filter(F.col("key").isNotNull() & F.col("code").isNotNull())
            .groupBy("key").agg(F.min("code").alias("code")))


def query_keys(names: DataFrame, name: str = "name") -> DataFrame:
    """(name, key): distinct query names with their canonical key."""
    return (names.select(F.col(name).alias("name")).filter(F.col("name").isNotNull()).distinct()
            .withColumn("key", canonical_key("name", "lower")))


def link_exact(names: DataFrame, dictionary: DataFrame, name: str = "name", dict_name: str = "name",
               dict_code: str = "code") -> DataFrame:
    """Tier 1: canonical name equality. Output (name, code, tier, score)."""
    q = query_keys(names, name)
    d = dictionary_keys(dictionary, dict_name, dict_code)
    return q.join(d, on="key").select("name", "code", F.lit("exact").alias("tier"), F.lit(1.0).alias("score"))


def link_alias(names: DataFrame, aliases: DataFrame, dictionary: DataFrame, name: str = "name",
               alias: str = "alias", target: str = "target", dict_name: str = "name",
               dict_code: str = "code") -> DataFrame:
    """Tier 2: alias → canonical dictionary name → code; aliases whose target is absent drop out."""
    q = query_keys(names, name)
    a = (aliases.select(canonical_key(alias, "lower").alias("key"), canonical_key(target, "lower").alias("tkey"))
         .filter(F.col("key").isNotNull() & F.col("tkey").isNotNull())
         .groupBy("key").agg(F.min("tkey").alias("tkey")))
    d = dictionary_keys(dictionary, dict_name, dict_code).withColumnRenamed("key", "tkey")
    return (q.join(a, on="key").join(d, on="tkey")
            .select("name", "code", F.lit("alias").alias("tier"), F.lit(1.0).alias("score")))


# ------------------------------------------------------------------ fuzzy tier
def _min_shared(length: F.Column, cutoff: float, method: str) -> F.Column:
    """Lower bound on tokens shared with any partner within the cutoff (from own length only)."""
    if method == "levenshtein":
        # bigrams of the padded string: shared ≥ M + 1 − 2·lev ≥ 1 + M(2c − 1) ≥ 1 + |a|(2c − 1)
        bound = F.ceil(F.lit(1.0) + length * F.lit(2 * cutoff - 1)) - 1  # −1 absorbs float error
    else:
        # characters: shared ≥ M ≥ c(|a|+|b|)/2 with |b| ≥ |a|·c/(2−c)  ⇒  shared ≥ c·|a|/(2−c)
        bound = F.ceil(length * F.lit(cutoff / (2 - cutoff))) - 1
    return F.greatest(bound, F.lit(1))


def _tokens(keys: DataFrame, method: str) -> DataFrame:
    """(key, len, token): q-gram tokens made unique by their occurrence number."""
    if method == "levenshtein":
        grams = bigrams(F.col("key"))
    else:
        grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length("key"), F.lit(1))),
                            lambda i: F.substring(F.col("key"), i, F.lit(1)))
    each = keys.select("key", F.length("key").alias("len"), F.posexplode(grams).alias("at", "gram"))
    # One name's own q-grams: a window as long as the name.
    nth = F.row_number().over(Window.partitionBy("key", "gram").orderBy("at"))
    return each.select("key", "len", F.concat("gram", F.lit("#"), nth.cast("string")).alias("token"))


def _prefixes(tok: DataFrame, freq: DataFrame, cutoff: float, method: str) -> DataFrame:
    """First ``n − t + 1`` tokens of each key in the global rarest-first order."""
    t = tok.join(freq, on="token")
    n_tokens = F.count(F.lit(1)).over(Window.partitionBy("key"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("freq", "token"))
    t = t.select("key", "len", "token", n_tokens.alias("n"), rank.alias("r"))
    keep = F.col("r") <= F.col("n") - _min_shared(F.col("len"), cutoff, method) + 1
    return t.filter(keep).select("key", "len", "token")


@F.pandas_udf(T.DoubleType())
def _ratio_udf(cand: pd.Series, query: pd.Series) -> pd.Series:
    """Ratcliff–Obershelp ratio of (candidate, query) — the per-pair scorer of ``method='ratio'``."""
    from difflib import SequenceMatcher

    out = []
    for a, b in zip(cand, query):
        out.append(SequenceMatcher(None, a, b).ratio() if a is not None and b is not None else None)
    return pd.Series(out, dtype="float64")


def fuzzy_candidates(qkeys: DataFrame, dkeys: DataFrame, cutoff: float, method: str) -> DataFrame:
    """Every (qkey, dkey) pair whose similarity can reach ``cutoff`` — exact superset, no cross join."""
    if cutoff <= 0.5:
        raise ValueError("prefix filtering needs cutoff > 0.5")
    qt = _tokens(qkeys.select("key").distinct(), method)
    dt = _tokens(dkeys.select("key").distinct(), method)
    # one row per distinct q-gram token: small, and joined to every token of every
    # name, so it is broadcast (size-checked) rather than shuffling by a common token
    freq = broadcast_if_small(qt.select("token").unionByName(dt.select("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("freq")))
    qp = _prefixes(qt, freq, cutoff, method).withColumnRenamed("key", "qkey").withColumnRenamed("len", "qlen")
    dp = _prefixes(dt, freq, cutoff, method).withColumnRenamed("key", "dkey").withColumnRenamed("len", "dlen")
    # The partner length is part of the join key: each query token is emitted once
    # per admissible partner length (a band a few lengths wide), so pairs outside
    # the length bound are never formed and join groups are (token, length).
    if method == "levenshtein":
        lo, hi = F.floor(F.col("qlen") * F.lit(cutoff)), F.ceil(F.col("qlen") / F.lit(cutoff))
    else:
        lo = F.floor(F.col("qlen") * F.lit(cutoff / (2 - cutoff)))
        hi = F.ceil(F.col("qlen") * F.lit((2 - cutoff) / cutoff))
    qp = qp.select("qkey", "qlen", "token", F.explode(F.sequence(lo.cast("int"), hi.cast("int"))).alias("dlen"))
    pairs = qp.join(dp, on=["token", "dlen"]).select("qkey", "qlen", "dkey", "dlen").distinct()
    # length filter (exact): lev ≥ |la − lb| ; ratio ≤ 2·min/(la+lb)
    if method == "levenshtein":
        ok = F.lit(1.0) - F.try_divide(F.abs(F.col("qlen") - F.col("dlen")), F.greatest("qlen", "dlen")) >= F.lit(cutoff)
    else:
        ok = F.try_divide(F.lit(2.0) * F.least("qlen", "dlen"), F.col("qlen") + F.col("dlen")) >= F.lit(cutoff)
    return pairs.filter(F.coalesce(ok, F.lit(False)) | (F.greatest("qlen", "dlen") == 0)).select("qkey", "dkey")


def best_match(scored: DataFrame, query: str = "qkey", candidate: str = "dkey", score: str = "score") -> DataFrame:
    """Highest score per query; ties go to the lexicographically larger candidate (an aggregate)."""
    order = F.struct(F.col(score), F.col(candidate))
    return scored.groupBy(query).agg(F.max_by(F.struct(F.col(candidate).alias(candidate), F.col(score).alias(score)),
                                              order).alias("__b")).select(query, f"__b.{candidate}", f"__b.{score}")


SEARCHES = ("prefix", "nearest", "minhash")


def link_fuzzy(names: DataFrame, dictionary: DataFrame, cutoff: float = 0.88, method: str = "levenshtein",
               name: str = "name", dict_name: str = "name", dict_code: str = "code", search: str = "prefix") -> DataFrame:
    """Tier 3: best dictionary name with similarity ≥ ``cutoff``. Output (name, code, tier, score).

    ``search`` says how pairs are found: "prefix", every pair within the cutoff
    (exact); "nearest", by growing distance, which leaves a query's farther
    names unformed (exact, "levenshtein" only; the choice for dictionaries with
    many alike names); "minhash", banded MinHash (not exact).
    """
    if method not in ("levenshtein", "ratio"):
        raise ValueError("method must be 'levenshtein' or 'ratio'")
    if search not in SEARCHES or (search == "nearest" and method != "levenshtein"):
        raise ValueError(f"search must be one of {SEARCHES}, and 'nearest' goes with 'levenshtein'")
    q = query_keys(names, name)
    d = dictionary_keys(dictionary, dict_name, dict_code)
    if search == "nearest":
        best = nearest_keys(q, d, cutoff)
    else:
        cand = fuzzy_candidates(q, d, cutoff, method) if search == "prefix" else minhash_candidates(q, d)
        score = similarity(F.col("qkey"), F.col("dkey")) if method == "levenshtein" else _ratio_udf(F.col("dkey"), F.col("qkey"))
        best = best_match(cand.withColumn("score", score).filter(F.col("score") >= F.lit(cutoff)))
    return (q.join(best.withColumnRenamed("qkey", "key"), on="key")
            .join(d.withColumnRenamed("key", "dkey"), on="dkey")
            .select("name", "code", F.lit("fuzzy").alias("tier"), "score"))


def link_names(names: DataFrame, dictionary: DataFrame, aliases: DataFrame | None = None,
               cutoff: float = 0.88, method: str = "levenshtein", name: str = "name",
               dict_name: str = "name", dict_code: str = "code") -> DataFrame:
    """Cascade: exact, then alias, then fuzzy; each tier only sees what is still unresolved.

    Output: one row per distinct query name — (name, code, tier, score); code
    and tier are null for unresolved names.  Tiers are disjoint by construction.
    """
    # The names, the dictionary and each tier are written once: what follows reads those files,
    # not the frames they came from.
    q = materialize(names.select(F.col(name).alias("name")).filter(F.col("name").isNotNull()).distinct(), "link-names")
    known = materialize(dictionary_keys(dictionary, dict_name, dict_code), "link-dictionary")
    exact = materialize(link_exact(q, known, "name", "key", "code"), "link-exact")
    rest = q.join(exact.select("name"), on="name", how="left_anti")
    parts = [exact]
    if aliases is not None:
        al = materialize(link_alias(rest, aliases, known, "name", dict_name="key", dict_code="code"), "link-alias")
        parts.append(al)
        rest = rest.join(al.select("name"), on="name", how="left_anti")
    # An empty list of unresolved names skips the fuzzy tier.
    rest = materialize(rest, "link-unresolved")
    if not rest.isEmpty():
        parts.append(link_fuzzy(rest, known, cutoff, method, "name", "key", "code"))
    resolved = parts[0]
    for p in parts[1:]:
        resolved = resolved.unionByName(p)
    return q.join(resolved, on="name", how="left")


def link_report(links: DataFrame) -> DataFrame:
    """Matched/total and per-tier counts of a ``link_names`` result (one row)."""
    return links.agg(F.count(F.lit(1)).alias("total"), F.count("code").alias("matched"),
                     F.count_if(F.col("tier") == "exact").alias("exact"),
                     F.count_if(F.col("tier") == "alias").alias("alias"),
                     F.count_if(F.col("tier") == "fuzzy").alias("fuzzy"))


def apply_link(df: DataFrame, links: DataFrame, name: str, code_out: str = "code",
               max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Attach the linked code; rows whose name did not resolve are dropped (inner join).

    The link table (one row per distinct name) is written and broadcast up to
    ``max_broadcast_bytes``, so the rows are not shuffled by a possibly hot name.
    """
    lk = links.filter(F.col("code").isNotNull()).select(F.col("name").alias(name), F.col("code").alias(code_out))
    return df.join(broadcast_if_small(lk, max_broadcast_bytes), on=name, how="inner")
