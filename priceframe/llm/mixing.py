"""Operator 6: mixing sources to target weights by pivotal dependent rounding, DataFrame functions only.

Each source gets a target of words.  A source whose target is r times its size
asks r copies of each of its documents: floor(r) for sure, the fraction by
rounding.  Pairs of documents with fractional copies trade words: mass moves at
random from one to the other, in the direction and amount that keeps each
expected copy count, until one of the two is 0 or 1.  A trade keeps the pair's
words exactly, so a source ends within one document of its target.

Scale: the trades run as a reduction tree.  A level hashes the open documents of
a source into groups of about ``FAN``, folds each group to one open document
with ``aggregate`` (bounded state), writes the decisions and passes the open
ones up; a hot source is just more groups.  Levels grow with the logarithm of
the largest source.  Only per-source rows and a level's counts reach a single
task.  Rows that repeat one id, source and size are one entry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, caller_row, materialize, pick, table

WEIGHTS = (5, 2, 1)   #: weights of the sources in their order, repeating
MAX_TIMES = 3         #: a target stops at this many times its source's size
FAN = 64              #: documents of a group of the tree, on average
SEED = 20


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_times: int = MAX_TIMES) -> DataFrame:
    """``(source, source_size, target)`` from rows ``(source, size)``: shares by weight, capped and reshared.

    Sources in the order of their code points, null last, weigh ``weights``
    repeating and share the sum of all sizes; a target stops at ``max_times`` its
    source's size and the excess goes to the others by weight until none is
    above.  The window runs over one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                         (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = materialize(per.withColumn("weight", cycle).withColumn("capped", F.lit(False)), "mix-sources")
    while True:
        t = per.agg(F.sum("source_size").alias("all"), F.sum(F.when(F.col("capped"), F.col("source_size"))).alias("cut"),
                    F.sum(F.when(~F.col("capped"), F.col("weight"))).alias("w")).first()
        share = ((t["all"] or 0) - max_times * (t["cut"] or 0)) / t["w"] if t["w"] else 0.0
        want = F.when(F.col("capped"), (F.col("source_size") * max_times).cast("double")) \
            .otherwise(F.col("weight") * F.lit(float(share)))
        per = per.withColumn("target", want)
        above = ~F.col("capped") & (F.col("target") > F.col("source_size") * max_times)
        if not per.where(above).limit(1).count():
            return per.select("source", "source_size", "target")
        per = materialize(per.withColumn("capped", F.col("capped") | above).drop("target"), "mix-sources")


def _trade(a, b, u):
    """Both entries after a trade; ``u`` uniform in [0, 1).  One ends at exactly 0 or 1."""
    def entry(x, p):
        return F.struct(x["h"].alias("h"), x["doc_id"].alias("doc_id"), x["size"].alias("size"), p.alias("p"))

    s, t, p, q = a["size"], b["size"], a["p"], b["p"]
    up_a, down_b = (1 - p) * s, q * t           # words a can gain, words b can give
    down_a, up_b = p * s, (1 - q) * t
    gain, loss = F.least(up_a, down_b), F.least(down_a, up_b)
    to_a = u * (gain + loss) < loss             # with probability loss / (gain + loss)
    full_a, empty_a = up_a <= down_b, down_a <= up_b
    new_p = F.when(to_a, F.when(full_a, F.lit(1.0)).otherwise(p + gain / s)) \
        .otherwise(F.when(empty_a, F.lit(0.0)).otherwise(p - loss / s))
    new_q = F.when(to_a, F.when(full_a, q - gain / t).otherwise(F.lit(0.0))) \
        .otherwise(F.when(empty_a, q + loss / t).otherwise(F.lit(1.0)))
    return entry(a, new_p), entry(b, new_q)


def _fold(level: int, seed: int):
    """The fold over a group's entries: ``open`` the entry still fractional, ``done`` the decided ones."""
    def step(state, x):
        a = state["open"]
        u = F.pmod(F.xxhash64(F.lit(seed + level), a["h"], x["h"]), F.lit(1 << 52)) / F.lit(float(1 << 52))
        na, nb = _trade(a, x, u)
        a_done = (na["p"] <= 0) | (na["p"] >= 1)
        return F.struct(F.when(a_done, nb).otherwise(na).alias("open"),
                        F.concat(state["done"], F.array(F.when(a_done, na).otherwise(nb))).alias("done"))

    def run(items):
        start = F.struct(items[0].alias("open"), F.slice(items, 1, 0).alias("done"))
        return F.aggregate(F.slice(items, 2, F.size(items)), start, step)
    return run


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights: tuple[int, ...] = WEIGHTS, max_times: int = MAX_TIMES, fan: int = FAN,
           seed: int = SEED) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies)`` per input row; the words taken are copies * size.

    Same input and parameters give the same copies whatever the partitions.

    Defined cases: a null text has size 0, as an empty one; a size of 0 gets 0
    copies; a null source is a source of its own; rows repeating an id, source
    and size are decided together and get the same copies; null ids of one
    source and size likewise; a table without words gets targets 0; an empty
    table gives no rows; other columns are not read.
    """
    size = F.coalesce(F.regexp_count(pick(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    sized = materialize(docs.select(pick(id_col).alias("doc_id"), pick(source_col).cast("string").alias("source"),
                                    size.alias("size")), "mix-sizes")
    targets = materialize(source_targets(sized, weights, max_times), "mix-targets")
    entries = sized.where("size > 0").groupBy("source", "doc_id", "size").agg(F.count("*").alias("rows"))
    ratio = targets.where("source_size > 0").select(
        F.col("source").alias("s"), (F.col("target") / F.col("source_size")).alias("ratio"))
    entries = entries.join(ratio, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", F.xxhash64(F.lit(seed), "doc_id", "size", "source").alias("h"), "doc_id",
        (F.col("size") * F.col("rows")).cast("double").alias("size"),
        (F.col("ratio") - F.floor("ratio")).alias("p"))
    live = materialize(entries.where("p > 0 and p < 1"), "mix-open")
    decided = []
    level = 0
    while True:
        counts = materialize(live.groupBy("source").agg(F.count("*").alias("n")), "mix-counts")
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            break
        # A seed per level: entries that met in one group don't all meet again.
        buckets = F.ceil(F.col("n") / F.lit(float(fan)))
        placed = live.join(counts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
            "source", F.pmod(F.xxhash64(F.lit(seed + 1000 + level), "h"), buckets).alias("bucket"),
            F.struct("h", "doc_id", "size", "p").alias("x"))
        folded = (placed.groupBy("source", "bucket").agg(F.array_sort(F.collect_list("x")).alias("items"))
                  .select("source", _fold(level, seed)(F.col("items")).alias("r")))
        out = materialize(folded.select("source", F.explode(F.concat(
            F.array(F.struct(F.lit(True).alias("live"), F.col("r.open").alias("x"))),
            F.transform("r.done", lambda x: F.struct(F.lit(False).alias("live"), x.alias("x"))))).alias("e"))
            .select("source", "e.live", "e.x.*"), "mix-level")
        settled = (F.col("p") <= 0) | (F.col("p") >= 1)
        decided.append(out.where(~F.col("live") | settled))
        live = materialize(out.where(F.col("live") & ~settled).drop("live"), "mix-open")
        level += 1
    # At most one open entry a source is left: one draw.
    last = F.pmod(F.xxhash64(F.lit(seed + 5000), "h"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    final = live.select("source", "h", (last < F.col("p")).cast("int").alias("more"))
    for d in decided:
        final = final.unionByName(d.select("source", "h", (F.col("p") >= 1).cast("int").alias("more")))
    extra = materialize(final.where("more = 1").select("h", "more").distinct(), "mix-more")
    rows = (sized.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
            .withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "size", "source")))
    whole = F.floor(F.col("target") / F.col("source_size"))
    return rows.join(extra, "h", "left").select(
        "doc_id", "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, (whole + F.coalesce("more", F.lit(0))).cast("long"))
        .otherwise(F.lit(0).cast("long")).alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        **how) -> DataFrame:
    """``docs`` with each row as many times as ``copies`` decides; columns unchanged."""
    size = F.coalesce(F.regexp_count(pick(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    chosen = copies(docs, id_col, text_col, source_col, **how).where("copies > 0").select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__of"),
        F.col("copies").alias("__copies")).distinct()
    chosen = materialize(chosen, "mix-chosen")
    rows = docs.select(pick(id_col).alias("id"), pick(source_col).cast("string").alias("source"), size.alias("size"),
                       caller_row(docs))
    on = (rows["id"].eqNullSafe(chosen["__id"]) & (rows["size"] == chosen["__of"])
          & rows["source"].eqNullSafe(chosen["__source"]))
    return rows.join(chosen, on).select(
        "row", F.explode(F.array_repeat(F.lit(1), F.col("__copies").cast("int")))).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of the whole ``documents`` table."""
    return copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source")
