"""Operator 11: text quality by a sparse ensemble of rules.

A text is described by some twenty statistics (``STATISTICS``), all Spark
column expressions.  A random forest of shallow trees is fitted to the
statistics of labelled texts; every path from a root to a node is a rule, a
conjunction of bounds.  A logistic regression with an L1 penalty (lasso) over
the rules' truth values then leaves few of them with a weight, and these are
compiled into one Spark column expression.  Scoring is a projection over the
scan: no Python, no shuffle, no model object on the executors.

Learning: a bounded sample of labelled rows (``SAMPLE``, by id hash) as narrow
rows of numbers, fitted by Spark's own MLlib.  What reaches the driver is the
trees (``TREES`` of depth ``DEPTH``) and a weight a rule.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, pick, table

SAMPLE = 20_000     #: labelled rows that are learnt from, expected at most
TREES, DEPTH = 16, 3
LASSO = 0.002       #: weight of the L1 penalty
STEPS = 60          #: of the logistic regression
THRESHOLD = 0.5     #: score from which a text is predicted good
SEED = 11

_WORDS = r"[\x20\x09-\x0D]+"
#: What is left of a text by these patterns is counted, per code point of the text.
_KEPT = {"upper": r"[^\p{Lu}]+", "letters": r"[^\p{L}]+", "digits": r"[^\p{Nd}]+", "blanks": r"[^\s]+",
         "stops": r"[^.,;:?']+", "marks": r"[\p{L}\p{Nd}\s.,;:?']+"}

STATISTICS = ["chars", "words", "word_chars", "distinct_words", "long_words", "short_words", "capital_words", "bare_words",
              "lines", "line_words", "distinct_lines", "marked_words", *[f"{k}_share" for k in _KEPT]]


def statistics(df: DataFrame, text_col: str = "text", keep: tuple[Column, ...] = ()) -> DataFrame:
    """``keep`` columns and ``STATISTICS``, a double each, of every row's text (null: empty); shares of nothing are 0."""
    t = F.coalesce(pick(text_col).cast("string"), F.lit(""))
    parts = df.select(
        *keep, F.char_length(t).alias("n__"), F.filter(F.split(t, _WORDS), lambda w: w != "").alias("w__"),
        F.filter(F.split(t, "\n"), lambda x: x != "").alias("l__"),
        *[F.char_length(F.regexp_replace(t, p, "")).alias(f"{k}__") for k, p in _KEPT.items()])
    names = parts.columns[:len(keep)]
    # Counts over the words and lines, named before they are divided, so that each is computed once.
    counted = parts.select(
        *[pick(c) for c in names], "n__", *[f"{k}__" for k in _KEPT], F.size("w__").alias("words__"),
        F.size("l__").alias("lines__"), F.size(F.array_distinct("w__")).alias("dw__"),
        F.size(F.array_distinct("l__")).alias("dl__"),
        F.size(F.filter("w__", lambda w: F.char_length(w) > 12)).alias("long__"),
        F.size(F.filter("w__", lambda w: F.char_length(w) < 4)).alias("short__"),
        F.size(F.filter("w__", lambda w: w.rlike(r"^\p{Lu}"))).alias("capital__"),
        F.size(F.filter("w__", lambda w: w.rlike(r"^[^\p{L}\p{Nd}]+$"))).alias("bare__"),
        F.size(F.filter("w__", lambda w: w.rlike(r"[^\p{L}\p{Nd}.,;:?'][^\p{L}\p{Nd}]*$"))).alias("marked__"))

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0)).cast("double")

    made = {
        "chars": F.log1p("n__"), "words": F.log1p("words__"),
        "word_chars": F.when(F.col("words__") > 0, (F.col("n__") - F.col("blanks__")) / F.col("words__")).otherwise(0.0),
        "distinct_words": share("dw__", "words__"), "long_words": share("long__", "words__"),
        "short_words": share("short__", "words__"), "capital_words": share("capital__", "words__"),
        "bare_words": share("bare__", "words__"), "lines": F.log1p("lines__"), "line_words": share("words__", "lines__"),
        "distinct_lines": share("dl__", "lines__"), "marked_words": share("marked__", "words__"),
        **{f"{k}_share": share(f"{k}__", "n__") for k in _KEPT}}
    return counted.select(*[pick(c) for c in names], *[made[k].cast("double").alias(k) for k in STATISTICS])


#: A rule: per statistic a bound it must be above (or None) and one it must be at or below (or None).
Rule = tuple[tuple[str, float | None, float | None], ...]


@dataclass
class Ensemble:
    """``bias`` and weighted rules; the score is the logistic function of their sum."""

    bias: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)


def paths(model) -> list[Rule]:
    """The distinct rules of a fitted forest: the way to every node below a root, bounds on a statistic merged."""
    found: dict[Rule, None] = {}

    def walk(node, bounds: dict[str, tuple]):
        if bounds:
            found[tuple((k, *bounds[k]) for k in sorted(bounds))] = None
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, at = STATISTICS[split.featureIndex()], float(split.threshold())
        low, high = bounds.get(name, (None, None))
        walk(node.leftChild(), {**bounds, name: (low, at if high is None else min(high, at))})
        walk(node.rightChild(), {**bounds, name: (at if low is None else max(low, at), high)})

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(found)


def holds(rule: Rule) -> Column:
    """Whether a row's statistics keep within a rule's bounds."""
    made = F.lit(True)
    for name, low, high in rule:
        if low is not None:
            made = made & (F.col(name) > F.lit(low))
        if high is not None:
            made = made & (F.col(name) <= F.lit(high))
    return made


def train(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, steps: int = STEPS) -> Ensemble:
    """The ensemble learnt from ``rows(label, *STATISTICS)``.

    Without rows the bias is 0; with one label only it is the log-odds of
    (n + 1) / (n + 2), or its complement: nothing tells texts apart.
    """
    seen = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("good")).first()
    n, good = int(seen["n"]), int(seen["good"])
    if good in (0, n):
        return Ensemble(math.log((good + 1) / (n - good + 1)))
    marked = rows.select(F.col("label").cast("double").alias("label"), array_to_vector(F.array(*STATISTICS)).alias("x"), *STATISTICS)
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=SEED,
                                    featureSubsetStrategy="onethird", minInstancesPerNode=max(1, min(10, n // 20)))
    rules = paths(forest.fit(marked))
    if not rules:
        return Ensemble(math.log((good + 1) / (n - good + 1)))
    truth = marked.select("label", array_to_vector(F.array(*[holds(r).cast("double") for r in rules])).alias("r"))
    fitted = LogisticRegression(featuresCol="r", labelCol="label", maxIter=steps, regParam=lasso, elasticNetParam=1.0).fit(truth)
    weights = fitted.coefficients.toArray()
    return Ensemble(float(fitted.intercept), [(r, float(w)) for r, w in zip(rules, weights, strict=True) if w])


def compiled(model: Ensemble) -> Column:
    """The ensemble's score as one column expression over ``STATISTICS``."""
    total = F.lit(model.bias)
    for rule, weight in model.rules:
        total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row's label is never learnt from: crc32 of the id as text leaves 1 modulo 3 (null: False)."""
    return F.coalesce(F.pmod(F.crc32(pick(id_col).cast("string")), F.lit(3)) == 1, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(label, *STATISTICS)`` of about ``sample`` labelled rows, drawn by id hash, none held out.

    A document with several labels has what most of them say (a tie: 1); null
    labels and ids are left out; rows that repeat an id and statistics are one.
    """
    known = labels.where("doc_id is not null and quality is not null").where(~held_out()).groupBy("doc_id") \
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    known = materialize(known, "quality-labels")
    total, spread = known.count(), 1 << 30
    bound = spread if total <= sample else int(spread * sample / total)
    known = known.where(F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(spread)) < bound)
    # About ``sample`` ids and labels at most: bounded, so the texts are not shuffled.
    joined = docs.select(pick("doc_id").alias("doc_id"), pick("text").alias("text")).join(F.broadcast(known), "doc_id")
    return statistics(joined, keep=(F.col("doc_id").alias("doc_id"), F.col("label").alias("label"))) \
        .distinct().select("label", *STATISTICS)


def score(docs: DataFrame, model: Ensemble, keep: tuple[Column, ...], text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns, score double in 0..1 and predicted int per row of ``docs``."""
    rows = statistics(docs, text_col, keep)
    names = rows.columns[:len(keep)]
    rows = rows.select(*[pick(c) for c in names], compiled(model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``, learnt from ``labels`` outside the held-out fold.

    Defined cases: a null text is an empty one, whose statistics are all 0; a
    null id is not held out and not learnt from; repeated rows get equal
    scores; without labels every score is 0.5; with one label only every score
    is the same; an empty table gives no rows; other columns are not read,
    whatever their names.
    """
    model = train(materialize(labelled(docs, labels, sample), "quality-sample"))
    return score(docs, model, (pick("doc_id").alias("doc_id"), held_out().alias("held_out")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the whole ``documents`` table."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
