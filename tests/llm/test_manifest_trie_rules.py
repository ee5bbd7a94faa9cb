"""Merkle manifest, prefix trie and rule ensemble against plain Python versions, and their defined edge cases."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from priceframe.llm import merkle, prefix_trie, rule_quality
from priceframe.llm.common import pick, positions, table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "\n".join(f"word{i} " * 50 for i in range(400))
EDGE = [(1, "a b c", "en", "s", 5), (2, None, None, None, None), (3, "", "en", "s", 0), (None, "x y", "en", "s", 3),
        (None, "x y", "en", "t", 3), (5, LONG, "de", "s", len(LONG)), (7, "same", "en", "s", 4), (7, "same", "en", "s", 4),
        (7, "other", "en", "s", 5), (8, "É ß 漢字", "xx", None, None), (9, "z", "", "s", 1), (14, "k", "en", "s", 1)]


@pytest.fixture(scope="module")
def edge(spark):
    names = ["id", "grp", "h", "other", "tie", "i", "g", "n", "path", "left", "w__", "l__", "n__", "score", "label", "words"]
    return spark.createDataFrame(EDGE, DOCS).select("*", *[F.lit(0).alias(n) for n in names])


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(level, arity):
    """All levels of one tree, and for every leaf its runs as (left, right) texts."""
    levels = [level]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([H("".join(low[i:i + arity])) for i in range(0, len(low), arity)])
    paths = []
    for i in range(len(level)):
        path = []
        for row in levels[:-1]:
            start = i - i % arity
            path.append(("".join(row[start:i]), "".join(row[i + 1:start + arity])))
            i //= arity
        paths.append(path)
    return levels[-1][0], paths


def plain_manifest(rows, arity):
    """One tuple a row: id, leaf, subroot, root, proof, folded root."""
    groups = {}
    for r in rows:
        bad = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
        leaf = [H(enc(r[0]) + enc(r[3]) + enc(r[2]) + enc(n) + enc(r[1])) for n in (r[4], r[4] + 1 if bad else r[4])]
        groups.setdefault(r[2], []).append((r[0], *leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = plain_tree([x[1] for x in groups[g]], arity)
    root, above = plain_tree([trees[g][0] for g in order], arity)
    out = []
    for k, g in enumerate(order):
        for (id_, leaf, other), path in zip(groups[g], trees[g][1]):
            path = path + above[k]
            acc = other
            for left, right in path:
                acc = H(left + acc + right)
            out.append((id_, leaf, trees[g][0], root, H("".join(a + b for a, b in path)), acc, acc == root))
    return sorted(out, key=str)


def spark_manifest(docs, arity):
    hit = F.coalesce(F.pmod(F.crc32(pick("doc_id").cast("string")), F.lit(7)) == 0, F.lit(False))
    got = merkle.verify(merkle.manifest(docs, arity=arity, changed={
        "n_chars": F.when(hit, pick("n_chars") + 1).otherwise(pick("n_chars"))}))
    return sorted(map(tuple, got.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()),
                  key=str)


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest_equals_plain_trees(spark, edge, arity):
    assert spark_manifest(edge, arity) == plain_manifest(EDGE, arity)


def test_manifest_whole_table(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    want = plain_manifest(rows, 2)
    assert spark_manifest(docs, 2) == want
    assert {w[-1] for w in want} == {True, False}


@pytest.mark.parametrize("rows", [EDGE[:1], EDGE[:2], [EDGE[0], EDGE[2]]])
def test_manifest_of_one_and_two_leaves(spark, rows):
    assert spark_manifest(spark.createDataFrame(rows, DOCS), 2) == plain_manifest(rows, 2)


def test_manifest_of_nothing(spark):
    assert spark_manifest(spark.createDataFrame([], DOCS), 2) == []


def test_positions_count_within_groups(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "a", "a", "b"]), rng.randrange(50), i) for i in range(3000)]
    got = positions(spark.createDataFrame(rows, "g string, o long, t long").repartition(7), ["g"], ["o", "t"]).collect()
    want, seen = {}, {}
    for g, o, t in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        want[t] = seen.get(g, 0)
        seen[g] = want[t] + 1
    assert {r["t"]: r["pos"] for r in got} == want


# ---- conversations ---------------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for c in own:
        own[c].sort(key=lambda t: (t[0], t[1], hashlib.sha256(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).digest()))
        own[c] = [t[2:] for t in own[c]]
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:])
    nodes = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    kids = {}
    for n in nodes:
        if n:
            kids.setdefault(n[:-1], []).append(n)
    out = set()
    sums = {}
    for n in sorted(nodes, key=len, reverse=True):
        below = [sums[k] for k in kids.get(n, [])]
        sums[n] = (sum(b[0] for b in below) or 1,
                   sum(b[1] for b in below) + (len(nodes[n]) - 1) * (len(n[-1][1]) if n else 0))
    for n, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if built[c] == n)
        out.add((min(members), len(n), min(nodes[n[:-1]]) if n else None, len(members), len(kids.get(n, [])),
                 *sums[n], H(ends)))
    return out


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 450), n) + [None]:
        stem = [("u", rng.choice("ab")) for _ in range(rng.choice([0, 1, 3, longest]))]
        for k, (role, text) in enumerate(stem + [(rng.choice(["u", None]), rng.choice(["x", "y", None, "zz é"]))]):
            rows.append((c, k if rng.random() < 0.9 else None, role, text))
    return rows + rows[:5]


@pytest.mark.parametrize("seed, n, longest, chunk", [(1, 60, 12, 4), (2, 120, 5, 32), (3, 30, 70, 3)])
def test_trie_equals_plain_version(spark, seed, n, longest, chunk):
    rows = conversations(seed, n, longest)
    df = spark.createDataFrame(rows, TURNS).select("*", *[F.lit(1).alias(x) for x in ("c", "pos", "t", "p", "q", "d", "n")])
    got = prefix_trie.trie(df, chunk=chunk)
    assert {tuple(r) for r in got.collect()} == plain_trie(rows)
    assert got.count() == len(plain_trie(rows))


def test_trie_of_nothing_and_of_turnless_members(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).collect() == []
    rows = [(c, 0, "u", "t") for c in range(101, 140)]  # base 100 is absent: many are left without a turn
    assert {tuple(r) for r in prefix_trie.trie(spark.createDataFrame(rows, TURNS)).collect()} == plain_trie(rows)


def test_contraction_on_chains_and_random_trees(spark):
    rng = random.Random(5)
    nodes = [(0, 0, None, None, 1)]
    for i in range(1, 260):  # a chain with a bush at its end and some twigs
        d, c = nodes[i - 1][:2] if i < 150 else rng.choice(nodes)[:2]
        nodes.append((d + 1 + (i % 3 == 0), i, d, c, rng.randrange(100)))
    nodes.append((4, 999, None, None, 7))  # a second root
    want = {n[1]: n[4] for n in nodes}
    for d, c, pd, pc, _ in sorted(nodes, key=lambda n: -n[0]):
        if pc is not None:
            want[pc] += want[c]
    df = spark.createDataFrame(nodes, "d long, c long, pd long, pc long, w long")
    assert {r["c"]: r["w"] for r in prefix_trie.subtree_sums(df, ["w"]).collect()} == want


def test_lists_are_hashed_in_pieces(spark):
    rows = [(0, bytes([i % 3]), i * 7 % 1000) for i in range(1000)]
    got = prefix_trie.hashed_lists(spark.createDataFrame(rows, "d long, p binary, c long"), ["d", "p"], "c", piece=16).collect()
    want = {bytes([k]): H(",".join(map(str, sorted(r[2] for r in rows if r[1] == bytes([k]))))) for k in range(3)}
    assert {bytes(r["p"]): r["sha256"] for r in got} == want


# ---- rules -----------------------------------------------------------------------------------------------------------

def test_rules_compile_to_what_they_say(spark, edge):
    model = rule_quality.Ensemble(0.25, [((("words", 0.5, 2.0),), 1.5), ((("chars", None, 1.0), ("lines", None, 0.5)), -2.0),
                                         ((("upper_share", 0.1, None),), 0.75)])
    stats = rule_quality.statistics(edge, keep=(pick("doc_id").alias("doc_id"),))
    got = stats.withColumn("s", rule_quality.compiled(model)).collect()
    assert len(got) == len(EDGE)
    for r in got:
        total = 0.25
        for rule, w in model.rules:
            total += w * all((lo is None or r[k] > lo) and (hi is None or r[k] <= hi) for k, lo, hi in rule)
        assert r["s"] == pytest.approx(1 / (1 + math.exp(-total)))


def test_statistics_by_hand(spark):
    text = "The Cat sat.\nThe Cat sat.\n--- ££ longerthantwelve!"
    r = rule_quality.statistics(spark.createDataFrame([(text,), ("",), (None,)], "text string")).collect()
    a = r[0].asDict()
    assert a["words"] == pytest.approx(math.log1p(9)) and a["lines"] == pytest.approx(math.log1p(3))
    assert a["distinct_words"] == pytest.approx(6 / 9) and a["distinct_lines"] == pytest.approx(2 / 3)
    assert a["capital_words"] == pytest.approx(4 / 9) and a["bare_words"] == pytest.approx(2 / 9)
    assert a["long_words"] == pytest.approx(1 / 9) and a["short_words"] == pytest.approx(6 / 9)
    assert a["marked_words"] == pytest.approx(3 / 9) and a["stops_share"] == pytest.approx(2 / len(text))
    assert a["marks_share"] == pytest.approx(6 / len(text)) and a["upper_share"] == pytest.approx(4 / len(text))
    assert all(v == 0 for x in r[1:] for v in x.asDict().values())


def test_every_rule_of_a_forest_is_a_path(spark):
    rows = spark.range(400).select((F.col("id") % 4 > 0).cast("int").alias("label"), *[
        (F.col("id") % 4 if k == "words" else F.pmod(F.xxhash64("id", F.lit(k)), F.lit(7))).cast("double").alias(k)
        for k in rule_quality.STATISTICS])
    model = rule_quality.train(rows, trees=4, depth=2)
    assert model.rules and any(any(k == "words" for k, _, _ in rule) for rule, _ in model.rules)
    got = rows.withColumn("s", rule_quality.compiled(model)).groupBy("label").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    by = {r["label"]: r for r in got.collect()}
    assert by[0]["hi"] < 0.5 < by[1]["lo"]


@pytest.mark.parametrize("labels, want", [([], 0.5), ([(1, 1, 0)], 2 / 3), ([(1, 0, 0), (3, 0, 0)], None)])
def test_quality_with_few_labels(spark, edge, labels, want):
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = rule_quality.quality(edge, known).collect()
    usable = [d for d, _, _ in labels if zlib.crc32(str(d).encode()) % 3 != 1]
    want = want if want and len(usable) == len(labels) else 1 / (2 + len(usable)) if usable and not labels[0][1] else 0.5
    assert len(got) == len(EDGE) and {round(r["score"], 9) for r in got} == {round(want, 9)}
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == int(r["score"] >= 0.5)


def test_quality_on_held_out_documents(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = rule_quality.quality(docs, labels)
    assert got.count() == docs.count()
    held = got.join(labels, "doc_id").where("held_out").select("quality", "predicted").collect()
    assert len(held) > 80 and sum(r["quality"] == r["predicted"] for r in held) / len(held) > 0.9


def test_quality_never_learns_held_out_labels(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    turned = labels.withColumn("quality", F.when(rule_quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r["doc_id"], r["score"]) for r in rule_quality.quality(docs, x).collect()) for x in (labels, turned))
    assert a == b


def test_quality_of_nothing(spark):
    assert rule_quality.quality(spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int")).collect() == []
