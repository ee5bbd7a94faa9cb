"""Linkage: tiers, cascade disjointness, and the fuzzy prefix filter against brute force."""

import difflib
import random

import pytest

from conftest import SF_SMALL
from priceframe.operators import link, nearest
from priceframe.plans import jobs


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def _brute(queries, dictionary, cutoff, method):
    best = {}
    for q in queries:
        k = q.strip().lower()
        cands = []
        for d in dictionary:
            if method == "levenshtein":
                m = max(len(k), len(d))
                s = 1.0 if m == 0 else 1.0 - _lev(k, d) / m
            else:
                s = difflib.SequenceMatcher(None, d, k).ratio()
            if s >= cutoff:
                cands.append((s, d))
        if cands:
            best[q] = max(cands)
    return best


def _words(rng, n):
    letters = "abcdefghij "
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 16))).strip() or "x" for _ in range(n)})


def test_fuzzy_prefix_filter_is_exact(spark):
    rng = random.Random(5)
    dictionary = _words(rng, 150)
    queries = []
    for d in dictionary[:120]:
        w = list(d)
        for _ in range(rng.randint(0, 2)):
            op = rng.random()
            pos = rng.randrange(len(w) + 1)
            if op < 0.4 and w:
                w.pop(min(pos, len(w) - 1))
            elif op < 0.7:
                w.insert(pos, rng.choice("abcxyz"))
            elif w:
                w[min(pos, len(w) - 1)] = rng.choice("abcxyz")
        queries.append("".join(w) or "q")
    queries += ["austria", "viet nam"]
    dictionary += ["australia", "vietnam"]
    qdf = spark.createDataFrame([(q,) for q in queries], "name string")
    ddf = spark.createDataFrame([(d, i) for i, d in enumerate(dictionary)], "name string, code long")
    code_of = {d: i for i, d in enumerate(dictionary)}
    for method, cutoff in (("levenshtein", 0.88), ("levenshtein", 0.7), ("ratio", 0.88), ("ratio", 0.75)):
        got = {r["name"]: (r["score"], r["code"]) for r in link.link_fuzzy(qdf, ddf, cutoff, method).collect()}
        want = _brute(set(queries), dictionary, cutoff, method)
        assert set(got) == set(want), (method, cutoff, set(got) ^ set(want))
        for q, (s, d) in want.items():
            assert abs(got[q][0] - s) < 1e-12 and got[q][1] == code_of[d]


def test_ratio_boundary_pairs(spark):
    qdf = spark.createDataFrame([("viet nam",), ("austria",)], "name string")
    ddf = spark.createDataFrame([("vietnam", 1), ("australia", 2)], "name string, code long")
    got = {r["name"]: r["code"] for r in link.link_fuzzy(qdf, ddf, 0.88, "ratio").collect()}
    assert got == {"viet nam": 1}   # 0.933 passes, austria/australia 0.875 does not


def test_cascade_tiers_disjoint_and_alias_target_absent(spark):
    names = spark.createDataFrame([(" CHILE ",), ("uk",), ("lao pdr",), ("Chilee",), ("nowhere",)], "name string")
    dictionary = spark.createDataFrame([("Chile", "CHL"), ("Britain", "GBR"), ("chile", "CHL2")], "name string, code string")
    aliases = spark.createDataFrame([("uk", "britain"), ("lao pdr", "laos")], "alias string, target string")
    out = {r["name"]: (r["code"], r["tier"]) for r in link.link_names(names, dictionary, aliases, 0.8).collect()}
    assert out[" CHILE "] == ("CHL", "exact")      # duplicates resolve to the smallest code
    assert out["uk"] == ("GBR", "alias")
    assert out["lao pdr"] == (None, None)          # alias target absent from the dictionary
    assert out["Chilee"] == ("CHL", "fuzzy")
    assert out["nowhere"] == (None, None)
    rep = link.link_report(link.link_names(names, dictionary, aliases, 0.8)).first()
    assert (rep["total"], rep["matched"], rep["exact"], rep["alias"], rep["fuzzy"]) == (5, 3, 1, 1, 1)


def test_similarity_counts_characters_not_bytes(spark):
    from pyspark.sql import functions as F

    pairs = [("türkiye", "turkiye"), ("côte d'ivoire", "cote d'ivoire"), ("são tomé", "sao tome")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(link.similarity(F.col("a"), F.col("b"))).collect()]
    for (a, b), s in zip(pairs, got):
        m = max(len(a), len(b))
        assert abs(s - (1.0 - _lev(a, b) / m)) < 1e-12


def _typos(rng, names, most):
    out = []
    for d in names:
        w = list(d)
        for _ in range(rng.randint(0, most)):
            pos = rng.randrange(len(w) + 1)
            if rng.random() < 0.5 and w:
                w.pop(min(pos, len(w) - 1))
            else:
                w.insert(pos, rng.choice("abcxyz"))
        out.append("".join(w) or "q")
    return out


@pytest.mark.parametrize("cutoff", [0.88, 0.7, 0.55])
def test_nearest_search_equals_brute_force(spark, cutoff):
    rng = random.Random(7)
    dictionary = _words(rng, 120) + ["a" * 30, "a" * 29 + "b", "aaaa bbbb cccc dddd eeee ffff gggg hhhh iiii jjjj kkkk llll"]
    queries = _typos(rng, dictionary, 3) + ["", "a" * 31, "aaa bbbb ccc dddd eee ffff ggg hhhh iiii jjjj kkkk llll"]
    qdf = spark.createDataFrame([(q,) for q in queries] + [(None,)] + [(queries[0],)], "key string")
    ddf = spark.createDataFrame([(d,) for d in dictionary] + [(None,), (dictionary[0],)], "key string")
    got = {r["qkey"]: (r["score"], r["dkey"]) for r in nearest.nearest_keys(qdf, ddf, cutoff).collect()}
    want = {}
    for q in set(queries):
        scored = [(1.0 - _lev(q, d) / max(len(q), len(d)) if q or d else 1.0, d) for d in dictionary]
        if max(scored)[0] >= cutoff:
            want[q] = max(scored)
    assert {k: (round(s, 12), d) for k, (s, d) in got.items()} == {k: (round(s, 12), d) for k, (s, d) in want.items()}


def test_nearest_search_forms_few_pairs_in_a_cluster(spark):
    """2,000 names of one template whose numbers differ in two digits or more; a letter is missing in every query."""
    def number(i):  # two check digits: any two numbers differ in at least two places
        return f"{i:04d}{sum(map(int, str(i))) % 10}{(i * 7 + i // 10 * 3) % 10}"
    names = [f"station {number(i)} north street" for i in range(2000)]
    queries = [n.replace("street", "steet") for n in names]
    rows = []
    qdf, ddf = (spark.createDataFrame([(x,) for x in xs], "key string") for xs in (queries, names))
    got = nearest.nearest_keys(qdf, ddf, 0.88, note=lambda limit, pairs: rows.append((limit, pairs)))
    assert {r["qkey"]: r["dkey"] for r in got.collect()} == dict(zip(queries, names))
    assert sum(n for _, n in rows) <= 3 * len(names), rows  # all pairs would be 4,000,000


def test_minhash_recall(spark):
    """Linked names of the driver's parts and of words with edits: at least 0.9 of the exact links, and no other."""
    q, d, _ = jobs.link_inputs(spark, SF_SMALL)
    rng = random.Random(3)
    words = sorted({" ".join("".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(3, 9))) for _ in range(3))
                    for _ in range(300)})
    wq = spark.createDataFrame([(w,) for w in _typos(rng, words, 2)], "name string")
    wd = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "name string, code long")
    for a, b in ((q, d), (wq, wd)):
        exact = {(r["name"], r["code"]) for r in link.link_fuzzy(a, b, 0.88).collect()}
        found = {(r["name"], r["code"]) for r in link.link_fuzzy(a, b, 0.88, search="minhash").collect()}
        assert len(exact) > 30 and len(found & exact) >= 0.9 * len(exact) and len(found - exact) <= 0.02 * len(exact)


def test_search_is_checked(spark):
    q = spark.createDataFrame([("a",)], "name string")
    d = spark.createDataFrame([("a", 1)], "name string, code long")
    with pytest.raises(ValueError):
        link.link_fuzzy(q, d, method="ratio", search="nearest")
    with pytest.raises(ValueError):
        link.link_fuzzy(q, d, search="best")
