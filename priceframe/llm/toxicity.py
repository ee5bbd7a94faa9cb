"""Operator 2: toxicity scores by FTRL-proximal logistic regression.

Features of a text are the hashes of its words, word pairs and skip-grams (two
words with one or two between), each present or not.  FTRL-proximal keeps a
learning rate per coordinate and an L1 threshold, so most weights stay exactly
0 and the model is a short list.

Training: a bounded sample of labelled rows (``SAMPLE``, drawn by id hash) is
dealt over shards; each shard runs its own FTRL passes, Spark averages the
non-zero weights per coordinate, and the averages are the model.  What reaches the
driver and is broadcast is at most 2**BITS weights and in practice some
hundreds.  Scoring is a map over the scan: no shuffle of texts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import caller_row, materialize, only_caches_of, pick, rows_per_task, table

BITS = 24             #: feature space 2**BITS
SAMPLE = 24_000       #: labelled rows that are learnt from, expected at most
SHARD_ROWS = 8_000    #: labelled rows of one shard, about
EPOCHS = 8            #: passes over a shard
ALPHA, BETA, L1, L2 = 3.0, 1.0, 15.0, 0.0
THRESHOLD = 0.3       #: score from which a text is predicted toxic
SEED = 2

#: ASCII letters lower-cased, other ASCII but digits a blank; bytes of other characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b > 127 else 32 for b in range(256))
#: Odd multipliers that tell apart the roles of a word in a feature.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def _word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, SEED)


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Hashed features of one text, with repeats; none for a text without words."""
    words = (text or "").encode("utf-8", "replace").translate(_FOLD).split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    h = np.array(list(map(_word_hash, words)), dtype=np.uint64)
    parts = [h]
    for gap in (1, 2, 3):  # neighbours, then one and two words between
        if len(h) > gap:
            parts.append((h[:-gap] * _MIX[0] + h[gap:] * _MIX[gap]) ^ (h[gap:] >> np.uint64(29)))
    return ((np.concatenate(parts) * _MIX[0]) >> np.uint64(64 - bits)).astype(np.int64)


def log_odds(labels) -> float:
    """What is known of a row before its text: the log-odds of label 1, half a row of either kind added."""
    good = sum(labels)
    return math.log((good + 0.5) / (len(labels) - good + 0.5))


class Ftrl:
    """FTRL-proximal logistic regression; state per coordinate (z, n).

    The bias, coordinate 2**bits, starts at ``bias`` and has no L1 threshold: a
    base rate is no feature that must earn its place.
    """

    def __init__(self, bits: int, alpha: float, beta: float, l1: float, l2: float, bias: float = 0.0):
        self.last = 1 << bits
        self.z, self.n = np.zeros(self.last + 1, np.float32), np.zeros(self.last + 1, np.float32)
        self.alpha, self.beta, self.l1, self.l2, self.bias = alpha, beta, l1, l2, bias

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == self.last, 0.0, self.l1)
        w = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))
        return w + np.where(at == self.last, self.bias, 0.0)

    def learn(self, at: np.ndarray, y: int) -> None:
        """One row: ``at`` its distinct coordinates, the bias (last) among them."""
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        n = self.n[at]
        moved = w - np.where(at == self.last, self.bias, 0.0)
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * moved
        self.n[at] = n + g * g

    def nonzero(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.append(np.flatnonzero(np.abs(self.z[:-1]) > self.l1), self.last)
        return at, self.weights(at)


def train(rows: DataFrame, bits: int = BITS, epochs: int = EPOCHS, shard_rows: int = SHARD_ROWS, alpha: float = ALPHA,
          beta: float = BETA, l1: float = L1, l2: float = L2) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, weights) learnt from ``rows(key, text, label)``; the bias has coordinate 2**bits.

    Rows go to shards by the hash of ``key``.  No rows give no weights: every
    score is then 0.5.  Rows too few for any feature to pass the L1 threshold give
    the bias alone, their base rate.
    """
    rows = materialize(rows, "toxic-sample")
    shards = rows_per_task(rows.count(), shard_rows)

    def fit(held):
        model = Ftrl(bits, alpha, beta, l1, l2, log_odds([y for _, y in held]))
        for _ in range(epochs):
            for at, y in held:
                model.learn(at, y)
        at, w = model.nonzero()
        return pd.DataFrame({"at": at.astype("int64"), "w": w.astype("float64")})

    def run(batches):
        only_caches_of("toxicity")  # a partition may hold several shards, one after the other: a model each
        held, open_ = [], None
        for pdf in batches:
            for shard, text, label in zip(pdf["shard"], pdf["text"], pdf["label"], strict=True):
                if held and shard != open_:
                    yield fit(held)
                    held = []
                open_ = shard
                held.append((np.append(np.unique(features(text, bits)), 1 << bits).astype(np.int32), int(label)))
        if held:
            yield fit(held)

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(SEED), "key"), F.lit(shards))) \
        .repartition(shards, "shard").sortWithinPartitions("shard", F.xxhash64(F.lit(SEED + 1), "key"))
    # As many models are fitted as there are shards with rows.
    busy = max(1, rows.select(F.pmod(F.xxhash64(F.lit(SEED), "key"), F.lit(shards)).alias("s")).distinct().count())
    mean = (dealt.select("shard", "text", "label").mapInPandas(run, "at long, w double")
            .groupBy("at").agg((F.sum("w") / busy).alias("w")).where("abs(w) > 1e-4"))
    got = mean.orderBy("at").toPandas()
    return got["at"].to_numpy(dtype=np.int64), got["w"].to_numpy(dtype=np.float64)


def _scores(texts, model: tuple[np.ndarray, np.ndarray], bits: int) -> np.ndarray:
    """Probabilities of texts; the model's coordinates are ascending."""
    only_caches_of("toxicity")
    at, w = model
    known, weight, bias = at[at < 1 << bits], w[at < 1 << bits], float(w[at == 1 << bits].sum())
    # One bit for every 64 neighbouring coordinates: most features need no search.
    near = np.zeros((1 << bits) // 64 + 1, bool)
    near[known >> 6] = True
    sums = []
    for text in texts:
        f = features(text, bits)
        f = np.unique(f[near[f >> 6]])
        place = np.searchsorted(known, f)
        hit = place < len(known)
        hit[hit] = known[place[hit]] == f[hit]
        sums.append(bias + float(weight[place[hit]].sum()))
    return 1.0 / (1.0 + np.exp(-np.clip(np.array(sums, dtype=np.float64), -35, 35)))


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text_col: str = "text", bits: int = BITS,
          keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns, score double in 0..1 and predicted int, per row of ``docs``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for pdf in batches:
            out = pdf.drop(columns="__text")
            out["score"] = _scores(pdf["__text"], shared.value, bits)
            yield out

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    sent = docs.select(*[pick(c).cast("string").alias(f"k{i}") for i, c in enumerate(keep)],
                       pick(text_col).cast("string").alias("__text"))
    schema = ", ".join(f"k{i} string" for i in range(len(keep))) + ", score double"
    return sent.mapInPandas(run, schema).select(
        *[F.col(f"k{i}").cast(kinds[c]).alias(c) for i, c in enumerate(keep)],
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text_col: str = "text", bits: int = BITS,
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` below the threshold, all columns as they were.

    A row goes only for something in its text: one that no feature raises above
    the model's base rate stays, also where few labels make that rate high.
    """
    base = float(_scores([""], model, bits)[0])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(_scores(texts, shared.value, bits), dtype="float64")

    rows = docs.select(scored(pick(text_col).cast("string")).alias("score"), caller_row(docs))
    return rows.where((F.col("score") < threshold) | (F.col("score") <= base + 1e-12)).select("row.*")


def held_out(id_col: str = "doc_id"):
    """Whether a row's label is never learnt from: crc32 of the id as text leaves 2 modulo 4 (null: False)."""
    return F.coalesce(F.pmod(F.crc32(pick(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The training rows ``(key, text, label)``: labelled, not held out, about ``sample`` of them by id hash.

    A document with several labels is toxic if any says so; null labels and ids
    are left out; of rows that repeat an id and text one is used.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out()) \
        .groupBy("doc_id").agg(F.max("toxic").alias("label"))
    known = materialize(known, "toxic-labels")
    total = known.count()
    spread = 1 << 30
    bound = spread if total <= sample else int(spread * sample / total)
    known = known.where(F.pmod(F.xxhash64(F.lit(SEED + 2), "doc_id"), F.lit(spread)) < bound)
    # At most about ``sample`` ids and labels: bounded, so the documents are not shuffled.
    return (docs.select(pick("doc_id").alias("doc_id"), pick("text").alias("text"))
            .join(F.broadcast(known), "doc_id")
            .groupBy("doc_id", "text").agg(F.max("label").alias("label"))
            .select(F.col("doc_id").alias("key"), "text", "label"))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``, learnt from ``labels`` outside the held-out fold.

    Defined cases: a null or empty text has the bias's score, about the share of
    label 1; with a handful of labels every text has it; a null id is not
    held out and not learnt from; repeated rows get equal scores; without
    labels every score is 0.5; an empty table gives no rows; other columns are
    not read.
    """
    model = train(labelled(docs, labels, sample))
    return score(docs, model, threshold=threshold).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the whole ``documents`` table."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
