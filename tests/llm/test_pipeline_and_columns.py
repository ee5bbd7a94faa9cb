"""The pipeline's stages against plain versions, the caller's columns, few labels, and FTRL against a plain one."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from priceframe.llm import line_dedup, mixing, packing, simhash_dedup, tokens, toxicity
from priceframe.llm.common import table
from test_llm_operators import DOCS, EDGE

LABELS = "doc_id long, quality int, toxic int"
#: Every name that the operators give a column or a struct of their own.
OWN = ["row", "id", "key", "order", "score", "cut", "tk", "bucket", "bucket__", "__k", "__n", "__id", "__key", "__score", "__size",
       "__copies", "__x", "__of", "__source", "__dropped", "size", "copies", "line", "pos", "h1", "u", "v", "a.b", "n", "o"]


@pytest.fixture(scope="module")
def crowded(spark):
    return spark.createDataFrame(EDGE, DOCS).select("*", *[F.lit(f"mine-{n}").alias(n) for n in OWN])


def mine(df):
    return all(r[n] == f"mine-{n}" for r in df.collect() for n in OWN)


def test_columns_of_the_caller_come_back(spark, crowded):
    model = (np.array([1 << toxicity.BITS]), np.array([-9.0]))
    for made in (toxicity.keep_clean(crowded, model), simhash_dedup.keep_one(crowded), mixing.mix(crowded)):
        assert made.columns == crowded.columns and made.count() > 0 and mine(made)
    cut = line_dedup.line_dedup(crowded)
    assert cut.columns == [*crowded.columns, "dropped"] and cut.count() == len(EDGE) and mine(cut)
    assert packing.pack(crowded).count() >= len(EDGE)


def test_one_of_many_equal_rows_stays(spark):
    rows = [(1, "a b c d", "en", "s", 7)] * 300 + [(1, "a b c d", "en", "t", 7), (None, "a b c d", "en", "s", 7)]
    assert [r["doc_id"] for r in simhash_dedup.keep_one(spark.createDataFrame(rows, DOCS)).collect()] == [1]


def save(spark, folder, docs, labels):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_on_edge_rows_and_on_nothing(spark, crowded, tmp_path):
    labels = spark.createDataFrame([(1, 1, 1), (2, None, None), (None, 0, 1), (5, 1, 0), (7, 1, 0)], LABELS)
    at = save(spark, tmp_path / "edge", crowded, labels)
    docs = table(spark, at, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, at)
        assert made.columns == docs.columns and mine(made), name
        docs = made
    got = corpus_pipeline.run(spark, at).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert got and {r["doc_id"] for r in got} <= {r[0] for r in EDGE}
    empty = save(spark, tmp_path / "none", crowded.limit(0), labels.limit(0))
    assert corpus_pipeline.run(spark, empty).count() == 0


def plain_lines(rows):
    """Texts without later equal lines (those of under 16 code points and all that differ more than two edits)."""
    seen, out = set(), {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        kept = []
        for line in r["text"].split("\n"):
            if line.strip() and line in seen:
                continue
            if line.strip():
                seen.add(line)
            kept.append(line)
        out[r["doc_id"]] = "\n".join(kept)
    return out


def test_every_stage_on_its_own_input(spark, tmp_path):
    """Texts of the driver's small table, whose lines differ by many edits or not at all, and whose ids are unique."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(4000)]
    lines = [" ".join(rng.choice(words) for _ in range(8)) for _ in range(300)]
    rows, labels = [], []
    for i in range(240):
        own = [" ".join(rng.choice(words) for _ in range(8)) for _ in range(3)] + ([rng.choice(lines)] if i % 3 else [])
        bad = i % 6 == 0
        text = "\n".join(own) + (" idiot" if bad else "")
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, 1, int(bad)))
    rows += [(1000 + i, rows[i][1], "en", "s0", rows[i][4]) for i in (1, 2, 7)]
    at = save(spark, tmp_path / "t", spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    docs = table(spark, at, "documents")
    stages = dict(corpus_pipeline.STAGES)

    clean = stages["toxicity"](spark, docs, at)
    learnt = [(i, t, y) for (i, t, *_), (_, _, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert sum(y for *_, y in learnt) > 5
    model = toxicity.train(toxicity.labelled(docs, table(spark, at, "labels")))
    weights = dict(zip(model[0].tolist(), model[1].tolist()))
    def plain_score(text):
        found = set(toxicity.features(text).tolist())
        return 1 / (1 + math.exp(-sum(weights.get(f, 0.0) for f in found) - weights.get(1 << toxicity.BITS, 0.0)))
    want = {r[0] for r in rows if plain_score(r[1]) < 0.3 or plain_score(r[1]) <= plain_score("") + 1e-9}
    assert {r["doc_id"] for r in clean.collect()} == want

    cut = stages["line_dedup"](spark, clean, at).collect()
    assert {r["doc_id"]: r["text"] for r in cut} == plain_lines(clean.collect())
    assert all(r["n_chars"] == len(r["text"]) for r in cut)

    cut = spark.createDataFrame(cut, DOCS)
    kept = stages["near_dedup"](spark, cut, at).collect()
    prints = {r["doc_id"]: int(r["fingerprint"], 16) for r in
              simhash_dedup.near_dedup(cut).select("doc_id", F.lower(F.hex("fp")).alias("fingerprint")).collect()}
    root = {d: d for d in prints}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert sorted(r["doc_id"] for r in kept) == sorted({find(d) for d in prints})

    kept = spark.createDataFrame(kept, DOCS)
    mixed = stages["mix"](spark, kept, at)
    decided = {r["doc_id"]: r["copies"] for r in mixing.copies(kept).collect()}
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert times == Counter({d: n for d, n in decided.items() if n})

    enc = tokens.ChunkEncoder(packing.VOCABULARY)
    packed = stages["pack"](spark, mixed, at).collect()
    ids = defaultdict(list)
    for r in packed:
        ids[r["doc_id"]].append((r["start"], bytes(r["ids"])))
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    for d, n in times.items():
        assert len(ids[d]) == n and {i for _, i in ids[d]} == {enc.whole(texts[d]) + enc.pack([packing.END_ID])}
    used = defaultdict(list)
    for r in packed:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in used.values():
        at_ = 0
        for offset, length in sorted(pieces):
            assert offset == at_
            at_ += length
        assert at_ <= packing.LENGTH


@pytest.mark.parametrize("n", [1, 2, 5, 20])
def test_few_labels_leave_the_documents(spark, tmp_path, n):
    docs = table(spark, SF_SMALL, "documents")
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2][:n]
    labels = spark.createDataFrame([(d, 1, int(k == 0)) for k, d in enumerate(ids)], LABELS)
    scores = {r["score"] for r in toxicity.toxicity(docs, labels).collect()}
    assert all(0 < s < 1 for s in scores)
    at = save(spark, tmp_path / "few", docs, labels)
    assert corpus_pipeline.drop_toxic(spark, docs, at).count() == docs.count()


def test_ftrl_equals_a_plain_one(spark):
    """One shard, weights by the published update over dictionaries; features by a plain hash of words and skip-grams."""
    rng = random.Random(8)
    alpha, beta, l1, bits = 0.5, 1.0, 0.7, 18
    rows = [(str(i), " ".join(rng.choice("ab cd ef gh ij kl".split()) for _ in range(6)) + (" Bad!" if i % 4 == 0 else ""),
             int(i % 4 == 0)) for i in range(60)]

    def plain_features(text):
        mask = (1 << 64) - 1
        mix = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]
        h = [xxhash.xxh64_intdigest(w, toxicity.SEED) for w in "".join(c.lower() if c.isalnum() else " " for c in text).split()]
        made = list(h)
        for gap in (1, 2, 3):
            made += [((a * mix[0] + b * mix[gap]) & mask) ^ (b >> 29) for a, b in zip(h, h[gap:])]
        return {((x * mix[0]) & mask) >> (64 - bits) for x in made}

    assert all(plain_features(t) == set(toxicity.features(t, bits).tolist()) for _, t, _ in rows)
    good = sum(y for *_, y in rows)
    start = math.log((good + 0.5) / (len(rows) - good + 0.5))
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        bound = 0.0 if i == "bias" else l1
        w = 0.0 if abs(z[i]) <= bound else (math.copysign(bound, z[i]) - z[i]) / ((beta + math.sqrt(n[i])) / alpha)
        return w

    df = spark.createDataFrame(rows, "key string, text string, label int")
    dealt = df.orderBy(F.xxhash64(F.lit(toxicity.SEED + 1), "key")).collect()
    for _ in range(4):
        for r in dealt:
            at = [*plain_features(r["text"]), "bias"]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-(sum(w.values()) + start))) - r["label"]
            for i in at:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
    at, w = toxicity.train(df, bits=bits, epochs=4, alpha=alpha, beta=beta, l1=l1)
    got = dict(zip(at.tolist(), w.tolist()))
    want = {i: weight(i) for i in z if i != "bias" and abs(weight(i)) > 1e-3} | {1 << bits: weight("bias") + start}
    assert len(want) > 3 and all(abs(got.get(i, 0.0) - x) < 1e-2 * max(1, abs(x)) for i, x in want.items())
