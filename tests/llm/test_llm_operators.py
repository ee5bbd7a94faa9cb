"""Corpus operators against brute force, round trips and held-out accuracy, and their defined edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF_SMALL
from priceframe.llm import (exact_dedup, fingerprints, line_dedup, mixing, packing, simhash_dedup, token_counts,
                            token_files, toxicity, url_filter)
from priceframe.llm.common import components, table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "\n".join(f"word{i} " * 50 for i in range(400))
EDGE = [(1, "a b c d e f g", "en", "s", 13), (2, None, None, None, None), (3, "", "en", "s", 0),
        (None, "x y z", "en", "s", 5), (None, "x y z", "en", "t", 5), (4, " \t\n ", "en", "s", 4), (5, LONG, "en", "s", 1),
        (6, LONG, "en", None, 1), (7, "a b c d e f g", "en", "s", 13), (7, "a b c d e f g", "en", "s", 13),
        (7, "other text", "en", "s", 10), (8, "É\u00a0ß 漢字 \ud83d\ude00".encode("utf-16", "surrogatepass").decode("utf-16"),
                                           "xx", "s", 9)]


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    extra = [F.lit(i).alias(n) for i, n in enumerate(["fp", "key", "line", "size", "h1", "bucket", "score", "a.b", "u", "n"])]
    return spark.createDataFrame(EDGE, DOCS).select("*", *extra)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_SMALL, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


def plain_components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ------------------------------------------------------------------ components
def test_components_of_random_graphs(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(5, 5)]
    got = {r["u"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = plain_components({x for p in links for x in p}, links)
    assert {n: got.get(n, n) for n in want} == want


# ------------------------------------------------------------------ 1 SimHash near-dedup
def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_query_equals_brute_force(spark, texts):
    fp = {d: slow_fingerprint(t) for d, t in texts.items()}
    ids = sorted(fp)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (fp[a] ^ fp[b]).bit_count() <= 3]
    want = plain_components(ids, links)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash_dedup.query(spark, SF_SMALL).collect()}
    assert got == {d: (f"{fp[d]:016x}", want[d]) for d in ids}


@pytest.mark.parametrize("max_bits,segments,block", [(3, 2, 8), (3, 4, 8), (5, 2, 16), (0, 1, 8)])
def test_simhash_links_lose_nothing_in_dense_buckets(spark, max_bits, segments, block):
    rng = random.Random(max_bits)
    fps = {0, (1 << 64) - 1}
    for centre in (rng.getrandbits(64), rng.getrandbits(64)):
        for _ in range(60):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = simhash_dedup.links(spark.createDataFrame([(x,) for x in signed], "fp long"), max_bits, segments, block)
    pairs = [(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in got.collect()]
    assert all((a ^ b).bit_count() <= max_bits for a, b in pairs)
    every = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= max_bits]
    assert plain_components(fps, pairs) == plain_components(fps, every)


def test_simhash_edge_cases(edge, empty):
    rows = simhash_dedup.near_dedup(edge).collect()
    assert len(rows) == len(EDGE)
    by = defaultdict(set)
    for r in rows:
        by[r["doc_id"]].add((r["fp"], r["component_id"]))
    assert by[2] == by[3] == by[4] == {(0, 2)}                       # no words: zero, linked
    assert {c for _, c in by[None]} == {None}                        # null ids only
    assert {c for _, c in by[5] | by[6]} == {5}
    assert (next(iter(by[1]))[0], 1) in by[7] and len(by[7]) == 2    # one id, two texts
    kept = simhash_dedup.keep_one(edge)
    assert kept.columns == edge.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert set(got.values()) == {1} and {d for d, _ in got} == {1, 2, None, 5, 7, 8} and (7, "other text") in got
    assert simhash_dedup.near_dedup(empty).count() == 0 and simhash_dedup.keep_one(empty).count() == 0


# ------------------------------------------------------------------ 2 toxicity
def test_toxicity_finds_held_out_toxic_texts(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 5 == 0
        t = [rng.choice(words) for _ in range(60)] + (["idiot"] if toxic else [])
        rng.shuffle(t)
        rows.append((i, " ".join(t), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    d, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(d, lab).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [(r["predicted"], int(r["doc_id"] % 5 == 0)) for r in got if r["held_out"]]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    # Labels of the held-out fold change nothing.
    flipped = lab.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in toxicity.toxicity(d, flipped).collect()}
    assert again == {r["doc_id"]: r["score"] for r in got}


@pytest.mark.parametrize("shards", [1, 2, 3, 4])
def test_toxicity_weights_are_the_mean_of_one_model_per_shard(spark, shards):
    rng = random.Random(shards)
    rows = [(str(i), " ".join(["idiot"] * (i % 3 == 0) + [f"w{rng.randrange(50)}" for _ in range(12)]), int(i % 3 == 0))
            for i in range(240)]
    d = spark.createDataFrame(rows, "key string, text string, label int")
    by = defaultdict(list)
    for r in d.withColumn("s", F.pmod(F.xxhash64(F.lit(toxicity.SEED), "key"), F.lit(shards))) \
            .orderBy(F.xxhash64(F.lit(toxicity.SEED + 1), "key")).collect():
        by[r["s"]].append((np.append(np.unique(toxicity.features(r["text"], 14)), 1 << 14), r["label"]))
    assert len(by) == shards
    want = np.zeros((1 << 14) + 1)
    for held in by.values():
        model = toxicity.Ftrl(14, 3.0, 1.0, 1.0, 0.0, toxicity.log_odds([y for _, y in held]))
        for _ in range(3):
            for at, y in held:
                model.learn(at, y)
        at, w = model.nonzero()
        want[at] += w / shards
    at, w = toxicity.train(d, bits=14, epochs=3, shard_rows=-(-240 // shards), l1=1.0)
    got = np.zeros_like(want)
    got[at] = w
    assert np.abs(want).max() > 0.5 and np.abs(got - want).max() < 2e-4


def test_toxicity_edge_cases(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (7, None, 0), (None, 1, 1), (5, 1, None), (99, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(edge, labels).collect()
    assert len(got) == len(EDGE) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (2, 3, 4)}) == 1
    none = toxicity.toxicity(edge, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert toxicity.toxicity(empty, labels).count() == 0
    model = (np.array([1 << toxicity.BITS]), np.array([-9.0]))
    assert toxicity.keep_clean(edge, model).collect() == edge.collect()


# ------------------------------------------------------------------ 3 fingerprints
def test_fingerprint_query_follows_its_contract(spark, texts):
    got = {r["doc_id"]: r for r in fingerprints.query(spark, SF_SMALL).collect()}
    ids = sorted(texts, reverse=True)
    assert sorted(got, reverse=True) == ids
    for d, after in zip(ids, [*ids[1:], ids[0]], strict=True):
        t, k, r = texts[d], len(texts[d]) // 3, got[d]
        edited = t[:len(t) - k] + texts[after][:k]
        own, changed, ahead = map(fingerprints.fingerprint, (t, edited, texts[after]))
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (own.hex(), changed.hex())
        assert (r["near_edited"], r["near_next"]) == (fingerprints.likeness(own, changed), fingerprints.likeness(own, ahead))
    bits = {d: int(r["fingerprint"], 16) for d, r in got.items()}
    for d, r in got.items():
        near = sum((bits[d] ^ b).bit_count() <= fingerprints.RADIUS for b in bits.values()) - 1
        assert r["n_near"] == (near if d % 100 == 0 else None)
    long = [r for r in got.values() if r["n_chars"] >= 200]
    assert sum(r["near_edited"] > r["near_next"] for r in long) >= 0.98 * len(long)


def test_fingerprint_search_finds_edited_copies(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(2000)]
    rows = []
    for i, size in enumerate((100, 300, 1000, 3000)):
        text = rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=size)
        rows.append((100 * i, " ".join(text)))
        for copy in range(1, 6):  # 1 % of the words replaced
            other = list(text)
            for at in rng.sample(range(size), size // 100):
                other[at] = rng.choice(words)
            rows.append((100 * i + copy, " ".join(other)))
    fps = {d: fingerprints.fingerprint(t).hex() for d, t in rows}
    df = spark.createDataFrame([(x,) for x in set(fps.values())], "fp string")
    got = [(r["q"], r["fp"]) for r in fingerprints.search(df.select(F.col("fp").alias("q")), df).collect()]
    assert len(got) == len(set(got))
    for d, fp in fps.items():  # the original of each copy, and no unrelated text
        assert {x for x, y in fps.items() if (fp, y) in got} <= {x for x in fps if x // 100 == d // 100}
        assert (fps[d - d % 100], fp) in got


@pytest.mark.parametrize("radius", [0, 2, 6, 14, 18])
def test_fingerprint_search_equals_brute_force(spark, radius):
    rng = random.Random(radius)
    fps = {0, (1 << 128) - 1}
    for centre in [rng.getrandbits(128) for _ in range(6)]:
        for _ in range(25):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(128), rng.randrange(0, radius + 4))))
    df = spark.createDataFrame([(f"{x:032x}",) for x in fps], "fp string")
    got = [(int(r["q"], 16), int(r["fp"], 16))
           for r in fingerprints.search(df.select(F.col("fp").alias("q")), df, radius).collect()]
    assert sorted(got) == sorted((a, b) for a in fps for b in fps if (a ^ b).bit_count() <= radius)


def test_fingerprint_edge_cases(spark, edge, empty):
    got = fingerprints.edited_fingerprints(edge).collect()
    assert len(got) == len(EDGE)
    assert {r["fingerprint"] for r in got if r["doc_id"] in (2, 3, 4)} == {"0" * 32}
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (5, 6)}) == 1
    assert fingerprints.edited_fingerprints(empty).count() == 0
    one = fingerprints.edited_fingerprints(edge.where("doc_id = 1")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


# ------------------------------------------------------------------ 4 exact dedup
def test_exact_groups_edge_cases(edge, empty):
    got = exact_dedup.exact_groups(edge, prefix=4).collect()
    assert len(got) == len(EDGE)
    by = defaultdict(set)
    for r in got:
        by[r["doc_id"]].add((r["keep_id"], r["group_size"], r["kept"]))
    assert by[1] == {(7, 3, False)} and by[7] == {(7, 3, True), (7, 1, True)}
    assert by[2] == {(3, 2, False)} and by[3] == {(3, 2, True)}      # null counts as empty
    assert by[None] == {(None, 2, True)} and by[5] == {(6, 2, False)} and by[4] == {(4, 1, True)}
    assert exact_dedup.exact_groups(empty).count() == 0


def test_exact_groups_in_a_saturated_sketch(edge):
    wide = sorted(map(tuple, exact_dedup.exact_groups(edge).na.fill(-1).collect()))
    assert sorted(map(tuple, exact_dedup.exact_groups(edge, prefix=1, sketch=1).na.fill(-1).collect())) == wide


# ------------------------------------------------------------------ 5 line dedup
def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def slow_line_dedup(rows, edits, min_chars):
    """rows (id, text): the positions cut per row."""
    first, at = {}, defaultdict(list)
    for d, text in sorted(rows):
        for i, line in enumerate((text or "").split("\n")):
            if re.search(r"[^ \t\n\x0b\f\r]", line):
                first.setdefault(line, (d, i))
                at[d].append((i, line))
    lines = list(first)
    links = [(a, b) for k, a in enumerate(lines) for b in lines[k + 1:] if min(len(a), len(b)) >= min_chars
             and abs(len(a) - len(b)) <= edits and edit_distance(a, b) <= edits]
    root = plain_components(lines, links)
    least = {}
    for line in lines:
        least[root[line]] = min(least.get(root[line], first[line]), first[line])
    return {d: [i for i, line in at[d] if (d, i) != least[root[line]]] for d, _ in rows}


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_line_dedup_equals_brute_force(spark, edits):
    rng = random.Random(edits)
    base = ["".join(rng.choice("abcde é漢") for _ in range(rng.randrange(8, 40))) for _ in range(25)]

    def vary(s):
        for _ in range(rng.randrange(0, edits + 2)):
            at, kind = rng.randrange(len(s) + 1), rng.randrange(3)
            s = s[:at] + (rng.choice("abc") if kind < 2 else "") + s[at + (kind > 0):]
        return s
    rows = [(d, "\n".join(vary(rng.choice(base)) for _ in range(8))) for d in range(30)]
    out = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), edits=edits, min_chars=10)
    want = slow_line_dedup(rows, edits, 10)
    for r in out.collect():
        lines = dict(rows)[r["doc_id"]].split("\n")
        assert r["dropped"] == want[r["doc_id"]]
        assert r["text"] == "\n".join(x for i, x in enumerate(lines) if i not in r["dropped"])


@pytest.mark.parametrize("edits", [0, 1, 2, 4])
def test_bit_parallel_distance(monkeypatch, edits):
    rng = random.Random(edits)
    pairs = [("", ""), ("", "a"), ("ab", ""), ("漢字", "漢")]
    for _ in range(150):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 14)))
        b = list(a)
        for _ in range(rng.randrange(0, 5)):
            b.insert(rng.randrange(len(b) + 1), rng.choice("abc"))
            b.pop(rng.randrange(len(b)))
            if b and rng.random() < 0.4:
                b.pop()
        pairs.append((a, "".join(b)))
    long = "".join(rng.choice("abc é漢") for _ in range(400))
    pairs += [(long[:n] + x + long[n:], long[:m] + long[m + k:]) for n in (0, 31, 399) for m in (0, 30, 397)
              for x in ("", "z", "zz") for k in (0, 1, 2)]
    lines = [x for pair in pairs for x in pair]
    ia = np.arange(0, len(lines), 2)
    want = [edit_distance(a, b) <= edits for a, b in pairs]
    assert line_dedup.within(lines, ia, ia + 1, edits).tolist() == want
    monkeypatch.setattr(line_dedup, "CELLS", 500)  # many small slices
    assert line_dedup.within(lines, ia, ia + 1, edits).tolist() == want


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_line_dedup_folds_crowded_keys_like_brute_force(spark, edits):
    rng = random.Random(40 + edits)
    stem = "the cat sat on one long mat by the river"
    rows = []
    for i in range(60):
        line = list(stem)
        for _ in range(rng.randrange(0, edits + 3)):
            at = rng.randrange(len(line))
            line[at:at + 1] = rng.choice([[], ["x"], [" "], [line[at], "y"], [line[at], " "]])
        rows.append((i, "".join(line)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = slow_line_dedup(rows, edits, 10)
    for hot, block in ((1, 4), (8, 1000), (1000, 128)):
        out = line_dedup.line_dedup(frame, edits=edits, min_chars=10, hot=hot, block=block)
        assert {r["doc_id"]: r["dropped"] for r in out.collect()} == want


def test_crowded_keys_give_no_more_links_than_lines_a_chunk_pair(spark):
    n, block = 600, 128
    lines = [(i, f"opened on day {i:04d} of the long season by the keeper of the gate") for i in range(n)]
    docs = spark.createDataFrame(lines, "doc_id long, text string")
    line = F.col("line")
    distinct = line_dedup._lines(docs, "doc_id", "text").withColumn("n", F.char_length("line")).select(
        F.xxhash64(line).alias("h1"), line_dedup.letter_counts(line).alias("sig"),
        F.array(*line_dedup.index_keys(line, F.col("n"))).alias("ks"),
        F.array(*line_dedup.probe_keys(line, F.col("n"))).alias("ps"))
    links = line_dedup.line_links(docs, distinct, "doc_id", "text", 2, 16, block=block).collect()
    chunks = -(-n // block)
    # Two shared segments and their shifted twins, n - 1 links a chunk pair at most; all pairs would be 179,700.
    assert len(links) <= 2 * (chunks + 1) * n
    out = line_dedup.line_dedup(docs).where("size(dropped) = 0").collect()
    assert [r["doc_id"] for r in out] == [0]  # numbers one digit apart chain all lines into one class


def test_line_dedup_links_two_edits_by_default(spark):
    rows = [(1, "the quick brown fox jumps over it\nopened on day 17 of the month"),
            (2, "the quikc brown fox jumps over it\nopened on day 28 of the month"),    # two swapped letters, two digits
            (3, "the quick brown foxes jump over it\nopened on day 28 of each month"),  # three edits from any other
            (4, "a short line 17\na short line 28")]                                   # below MIN_CHARS
    out = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = slow_line_dedup(rows, 2, line_dedup.MIN_CHARS)
    assert {r["doc_id"]: r["dropped"] for r in out} == want == {1: [], 2: [0, 1], 3: [], 4: []}


def test_line_dedup_edge_cases(edge, empty):
    out = line_dedup.line_dedup(edge)
    assert out.columns == [*edge.columns, "dropped"]
    got = [(r["doc_id"], r["text"], r["dropped"]) for r in out.collect()]
    by = defaultdict(list)
    for d, t, cut in got:
        by[d].append((t, cut))
    assert by[2] == [(None, [])] and by[3] == [("", [])] and by[4] == [(" \t\n ", [])]
    assert by[1] == [("a b c d e f g", [])] and sorted(by[7]) == [("", [0]), ("", [0]), ("other text", [])]
    # The long text's numbered lines are within an edit of each other, and equal in both documents.
    assert by[6][0][0] == "" and len(by[6][0][1]) == 400
    assert sorted(by[None]) == [("x y z", []), ("x y z", [])]        # one occurrence
    assert line_dedup.line_dedup(empty).count() == 0


# ------------------------------------------------------------------ 6 mixing
def test_mixing_meets_its_targets(spark, texts, docs):
    rows = mixing.query(spark, SF_SMALL).collect()
    source = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in texts.items()}
    assert {r["doc_id"]: r["size"] for r in rows} == size
    of, taken, biggest, target = Counter(), Counter(), Counter(), {}
    for d, s in source.items():
        of[s] += size[d]
        biggest[s] = max(biggest[s], size[d])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(of))}
    cut = set()
    while True:
        share = (sum(of.values()) - sum(3 * of[s] for s in cut)) / sum(w for s, w in weight.items() if s not in cut)
        target = {s: 3.0 * of[s] if s in cut else weight[s] * share for s in of}
        above = {s for s in of if target[s] > 3 * of[s]}
        if not above:
            break
        cut |= above
    for r in rows:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        assert r["source_size"] == of[s] and r["target"] == pytest.approx(target[s])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    assert all(abs(taken[s] - target[s]) <= biggest[s] for s in of)
    assert sorted(mixing.query(spark, SF_SMALL).repartition(3).collect()) == sorted(rows)


def test_mixing_keeps_expected_copies(spark):
    rows = [(i, "w " * (1 + i % 7), "en", "ab"[i % 4 == 0], 0) for i in range(200)]
    d = spark.createDataFrame(rows, DOCS)
    total = Counter()
    for seed in range(12):
        for r in mixing.copies(d, seed=seed, fan=8).collect():
            total[r["source"], r["doc_id"] % 2] += r["copies"]
            ratio = r["target"] / r["source_size"]
            assert int(ratio) <= r["copies"] <= int(ratio) + 1
    got = total["a", 0] / total["a", 1]  # odd and even documents of a source alike
    assert 0.35 < got < 0.65  # a third of a's documents are even


def test_mixing_edge_cases(edge, empty):
    got = mixing.copies(edge).collect()
    assert len(got) == len(EDGE)
    assert all(r["copies"] == 0 for r in got if r["size"] == 0)
    assert len({r["copies"] for r in got if r["doc_id"] == 7 and r["size"] == 7}) == 1
    mixed = mixing.mix(edge)
    assert mixed.columns == edge.columns
    want = Counter()
    for r in got:
        want[r["doc_id"], r["size"]] += r["copies"]
    have = Counter((r["doc_id"], len((r["text"] or "").split())) for r in mixed.collect() if r["doc_id"] != 8)
    assert have == Counter({k: v for k, v in want.items() if v and k[0] != 8})
    assert mixing.copies(empty).count() == 0 and mixing.mix(empty).count() == 0


# ------------------------------------------------------------------ 7 URL filter
def plain_rule(host, path):
    fit = [r for r in url_filter.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: len(r[0] + r[1]), default=None)
    return (best[0] + best[1], best[2]) if best else (None, None)


def test_url_rules_and_parts(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1?x#y", "https://a.example.com/en/", "x://net/es/a",
            "x://b.net/fr/#/es/", "x://planet/es/", "x://example.com?en/", "x://example.com#/en/", "x://com/", "x://com",
            "x://example.com/EN/", "a://b://c/d", "x://É.com/é", "x://www.example.com.evil.org/en/"]
    rows = [(i, u, None if i % 2 else "<p>some words</p>") for i, u in enumerate(urls)]
    got = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, u, _ in rows:
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.split("[/?#]", rest)[0]
            path = re.split("[?#]", rest[len(host):])[0]
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        rule, verdict = plain_rule(host, path)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), u
        assert r["verdict"] in ("allow", "block") and (verdict is None or r["verdict"] == verdict)


def test_url_bayes_learns_from_seeds(spark):
    got = url_filter.query(spark, SF_SMALL).where("rule is null").select("host", "verdict").distinct().collect()
    bad = {r["verdict"] for r in got if re.search("casino|pills|bets|spam|ads", r["host"])}
    good = {r["verdict"] for r in got if not re.search("casino|pills|bets|spam|ads", r["host"])}
    assert bad <= {"block"} and good == {"allow"}
    seg = url_filter.Segmenter.of_counts({"cheap": 50, "pills": 40, "the": 900, "casino": 10})
    assert seg.split("cheappills") == ("cheap", "pills") and seg.split("") == ()


def test_url_segments_are_the_cheapest():
    rng = random.Random(5)
    seg = url_filter.Segmenter.of_counts({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 4))): rng.randrange(1, 50)
                                          for _ in range(12)})

    def cuts(s):
        if not s:
            yield ()
        for i in range(1, len(s) + 1):
            for rest in cuts(s[i:]):
                yield (s[:i], *rest)
    for _ in range(30):
        s = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))
        cost = lambda words: sum(seg._word(w) for w in words)
        assert cost(seg.split(s)) == pytest.approx(min(map(cost, cuts(s))))


# ------------------------------------------------------------------ 8 packing
def test_packing_places_every_id_once(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.encoder(packing.VOCABULARY) and __import__("public_tokenizers").path(packing.VOCABULARY))
    rows = packing.pack(table(spark, SF_SMALL, "documents"), with_ids=True, group=64).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for d, t in texts.items():
        ids = tok.encode(t, add_special_tokens=False).ids + [1]
        parts = sorted(by_doc[d], key=lambda r: r["start"])
        assert [i for p in parts for i in np.frombuffer(p["ids"], "<u2").tolist()] == ids
        at = 0
        for p in parts:
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at:at + p["length"]], "<u4").tobytes())
            at += p["length"]
    for seq in by_seq.values():
        at = 0
        for p in sorted(seq, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= packing.LENGTH
    tokens = sum(r["length"] for r in rows)
    assert tokens >= 0.95 * packing.LENGTH * len(by_seq)


def test_first_fit_decreasing_equals_a_plain_scan():
    rng = random.Random(2)
    for n in (0, 1, 2, 57):
        lengths = sorted((rng.randrange(1, 101) for _ in range(n)), reverse=True)
        room, want = [], []
        for x in lengths:
            b = next((i for i, r in enumerate(room) if r >= x), len(room))
            if b == len(room):
                room.append(100)
            room[b] -= x
            want.append(b)
        assert packing.first_fit_decreasing(lengths, 100)[0] == want


def test_packing_edge_cases(edge, empty):
    rows = packing.pack(edge).collect()
    assert sum(r["start"] == 0 for r in rows) == len(EDGE)
    assert {(r["length"], r["doc_tokens"]) for r in rows if r["doc_id"] in (2, 3)} == {(1, 1)}
    assert packing.pack(empty).count() == 0


@pytest.mark.parametrize("name", [packing.VOCABULARY, token_files.VOCABULARY])
def test_chunked_ids_equal_whole_ids(name, texts):
    enc = packing.encoder(name)
    odd = ["", " ", "  a", "a  b", "a \n b", "\n\na", "a\u00a0 b", "a \u00a0b", "x<|endoftext|> y <|endoftext|>", "it's  we'll ",
           "é e\u0301 \u0301x", "Σας ΣΑΣ σ", "a\x1cb \x1d c", "\u3000漢 字\u3000", "12 345\t6", "İ ı", "a\r\nb", " a", "a "]
    for t in [*odd, *odd, *list(texts.values())[:60]]:
        assert enc.encode(t) == enc.whole(t) if t else enc.encode(t) == b"", repr(t)


# ------------------------------------------------------------------ 9 token counts
def test_token_counts_equal_the_unigram_tokenizer(spark, texts):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = token_counts.load_pieces(token_counts.VOCABULARY)
    tok = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces, *[(f"<0x{b:02X}>", 0.0) for b in range(256)]], 0, True))
    tok.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.query(spark, SF_SMALL).collect()}
    assert got == {d: len(tok.encode(t, add_special_tokens=False).ids) for d, t in texts.items()}
    c = token_counts.counter(token_counts.VOCABULARY)
    for t in ["a  b", " lead", "trail ", "漢字 \U0001f600\u0301", "tab\tand\nline", "▁mark", "x" * 300, "\u0378\u0379 \u0378"]:
        assert c.text(t) == len(tok.encode(t, add_special_tokens=False).ids), repr(t)


def test_token_counts_ties_and_unknowns():
    from tokenizers import Tokenizer, models

    rng = random.Random(4)
    for _ in range(60):
        vocab = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 4))): -float(rng.randrange(1, 4)) for _ in range(8)}
        c = token_counts.UnigramCounter(list(vocab.items()))
        tok = Tokenizer(models.Unigram([("<unk>", 0.0), *vocab.items(), *[(f"<0x{b:02X}>", 0.0) for b in range(256)]], 0, True))
        for _ in range(10):
            w = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9)))
            assert c.word(w) == len(tok.encode(w, add_special_tokens=False).ids), (vocab, w)


def test_token_counts_edge_cases(edge, empty):
    got = token_counts.token_counts(edge).collect()
    assert len(got) == len(EDGE) and {(r["n_chars"], r["n_tokens"]) for r in got if r["doc_id"] in (2, 3)} == {(0, 0)}
    assert token_counts.token_counts(empty).count() == 0


# ------------------------------------------------------------------ 10 token files
def test_token_files_round_trip(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(__import__("public_tokenizers").path(token_files.VOCABULARY))
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.query(spark, SF_SMALL).collect()}
    at, want = 0, {}
    for d in sorted(texts):
        ids = tok.encode(texts[d], add_special_tokens=False).ids + [2]
        want[d] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got == want


def test_token_files_edge_cases(spark, edge, empty, tmp_path):
    token_files.write_token_files(edge, f"file://{tmp_path}/edge")
    rows = sorted(token_files.read_token_files(spark, f"file://{tmp_path}/edge", with_ids=True).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:]) and len(ids) == len(EDGE)
    assert all(r["ids"][-1] == 2 and len(r["ids"]) == r["n_tokens"] for r in rows)
    assert [r["ids"] for r in rows if r["doc_id"] in (2, 3)] == [[2], [2]]
    token_files.write_token_files(empty, f"file://{tmp_path}/empty")
    assert token_files.read_token_files(spark, f"file://{tmp_path}/empty").count() == 0


def test_lexicon_takes_whole_count_classes(spark):
    html = "<p>" + "alpha " * 40 + "beta " * 20 + "gamma delta" + "</p>"
    pages = spark.createDataFrame([(1, None, html), (2, "http://alpha.org/x", None)],
                                  "page_id long, url string, html string")
    full = url_filter.lexicon(pages, seeds=("spam",))
    assert full == {"alpha": 41, "beta": 20, "gamma": 1, "delta": 1, "org": 1, "spam": 64 // 5}
    # Three words are seen once: with room for four words they all stay out.
    assert set(url_filter.lexicon(pages, size=4, seeds=())) == {"alpha", "beta"}
    assert url_filter.lexicon(pages, size=0, seeds=("spam",)) == {"spam": 1}
    assert url_filter.lexicon(pages.limit(0), seeds=()) == {}


def test_hosts_are_cut_by_all_words_however_rare(spark):
    rng = random.Random(6)
    many = sorted({"".join(rng.choice("bcdfgh") for _ in range(9)) for _ in range(70_000)})
    assert len(many) > url_filter.LEXICON
    texts = [" ".join(many[i::20]) for i in range(20)] + ["zebra quokka the the the"]
    urls = ["http://zebraquokka.the.org/x", "http://quokkacasino.org/", None, *["http://the.org/"] * 18]
    pages = spark.createDataFrame([(i, u, f"<p>{t}</p>") for i, (u, t) in enumerate(zip(urls, texts, strict=True))],
                                  "page_id long, url string, html string")
    counts = Counter(w for t in texts for w in t.split())
    for h in ("zebraquokka.the.org", "quokkacasino.org", "the.org"):
        counts.update(h.split("."))
    typical = sum(counts.values()) // len(counts)
    seg = url_filter.Segmenter.of_counts(counts | {s: max(typical, counts[s]) for s in url_filter.SEEDS})
    got = {r["host"]: tuple(r["words"]) for r in url_filter.host_segments(pages).collect()}
    assert got == {h: tuple(url_filter.host_words(h, seg)) for h in ("zebraquokka.the.org", "quokkacasino.org", "the.org", "")}
    judged = {r["page_id"]: (r["words"], r["verdict"]) for r in url_filter.judge(pages).collect()}
    assert {i: tuple(w) for i, (w, _) in judged.items()} == {i: got[(u or "").partition("://")[2].partition("/")[0]]
                                                             for i, u in enumerate(urls)}


def test_pipeline_keeps_documents_without_a_toxic_label(spark, edge, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, quality int, toxic int"
    held = next(i for i in range(1, 9) if zlib.crc32(str(i).encode()) % 4 == 2)
    for i, labels in enumerate(([], [(1, 1, None), (None, 1, 1)], [(held, 1, 1)], [(d, 1, 0) for d in range(1, 9)])):
        spark.createDataFrame(labels, schema).write.parquet(f"{tmp_path}/{i}/labels.parquet")
        got = corpus_pipeline.drop_toxic(spark, edge, f"{tmp_path}/{i}")
        assert got.columns == edge.columns and got.count() == len(EDGE)
