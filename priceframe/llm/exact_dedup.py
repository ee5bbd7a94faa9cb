"""Operator 4: exact dedup by progressive refinement, DataFrame functions only.

Three passes, each over what the one before left undecided: group by length in
bytes, then by the hash of a prefix, then by the SHA-256 of the full text.  The
last reads full content only for rows whose (length, prefix hash) is shared.

Scale: the counts are partial aggregates, so a group of copies sends one row per
task.  Text is never shuffled: the surviving keys reach the scan as a hash
sketch of at most ``SKETCH`` rows (a broadcast bounded by construction), and only
keys and digests move.  Rows meet their group in a join whose both sides are
plain exchanges, so AQE splits a group that holds a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucket_of, materialize, member_sketch, pick, table

PREFIX = 256        #: code points that the prefix hash reads
SKETCH = 1 << 18    #: buckets of the broadcast sketch of surviving keys


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 carry: dict | None = None, prefix: int = PREFIX, sketch: int = SKETCH) -> DataFrame:
    """One row per input row: ``(doc_id, keep_id, group_size, kept)`` plus ``carry`` (name -> function of the text).

    Texts are equal when identical byte for byte; null counts as empty.  Of equal
    texts the row with the largest id stays.

    Defined cases: a null id is below every other; a group with null ids only has
    a null keep_id and keeps them all (they can't be told apart); repeated rows
    with the largest id are all kept and counted in group_size; an empty table
    gives no rows; other columns, whatever their names, are not read.
    """
    text = F.coalesce(pick(text_col).cast("string"), F.lit(""))
    rows = docs.select(pick(id_col).alias("doc_id"), text.alias("t"), F.octet_length(text).alias("len"))

    def prefix_hash(t):
        return F.xxhash64(F.substring(t, 1, prefix))

    # Lengths first: almost free, and a unique length needs no hash at all.
    by_len = rows.groupBy("len").agg(F.count("*").alias("n")).where("n > 1").select("len")
    by_len = materialize(by_len, "exact-len")
    len_sketch = member_sketch(by_len, F.col("len"), sketch)
    same_len = (rows.withColumn("bucket", bucket_of(F.col("len"), sketch)).join(len_sketch, "bucket", "left_semi")
                .select("len", prefix_hash(F.col("t")).alias("ph")))
    by_prefix = same_len.groupBy("len", "ph").agg(F.count("*").alias("n")).where("n > 1").select("len", "ph")
    by_prefix = materialize(by_prefix, "exact-prefix")

    # Full hashes where the sketch has the key: no true group is missed, a chance hit only costs a hash.
    both = F.xxhash64("len", "ph")
    full_sketch = member_sketch(by_prefix, both, sketch).withColumn("hit", F.lit(True))
    extra = [f(F.col("t")).alias(k) for k, f in (carry or {}).items()]
    hashed = (rows.withColumn("ph", prefix_hash(F.col("t"))).withColumn("bucket", bucket_of(both, sketch))
              .join(full_sketch, "bucket", "left")
              .select("doc_id", "len", "ph", F.when(F.col("hit"), F.sha2("t", 256)).alias("full"), *extra))
    groups = (hashed.where("full is not null").groupBy("len", "ph", "full")
              .agg(F.count("*").alias("n"), F.max("doc_id").alias("keep")).where("n > 1"))
    groups = materialize(groups, "exact-groups")
    return hashed.join(groups, ["len", "ph", "full"], "left").select(
        "doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (F.col("n").isNull() | F.col("keep").eqNullSafe(F.col("doc_id"))).alias("kept"), *(carry or {}))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of the whole ``documents`` table, dropped rows included, with the digest of each text."""
    return exact_groups(table(spark, sf_dir, "documents"), carry={"text_sha256": lambda t: F.sha2(t, 256)})


SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g ON d.t = g.t
"""
