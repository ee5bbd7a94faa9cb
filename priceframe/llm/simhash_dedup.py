"""Operator 1: SimHash near-dedup by multi-index hashing.

A document's 64-bit fingerprint is the bitwise majority of the XXH64 hashes of
its word shingles.  Documents whose fingerprints differ in at most ``max_bits``
bits are linked; a group is a connected component of links.

Search: the 64 bits are cut into ``segments`` parts.  Two fingerprints within
``max_bits`` agree up to ``max_bits // segments`` bits in at least one part, so
each fingerprint probes, per part, the table of that part's values with every
key in the small Hamming ball around its own value.  Probes that meet no table
entry end in one hash join.  The rest join the table's rows of their bucket,
and the complete distance of the fingerprints is verified there.

Scale: everything after the fingerprints works on distinct fingerprints, so a
group of equal texts is one row however large.  A bucket emits a spanning
forest of its links, never all pairs; a bucket larger than ``block`` is cut
into chunk pairs of at most about ``2 * block`` rows, each its own group, so no
task holds an unbounded group and no link between chunks is lost.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import caller_row, components, materialize, pick, sorted_groups, table

SHINGLE = 3      #: words a shingle
MAX_BITS = 3     #: fingerprints link at this many differing bits or fewer
SEGMENTS = 2     #: parts of the fingerprint that are indexed
BLOCK = 2048     #: fingerprints of one bucket compared in one group
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of one text; null and word-less texts give 0.

    Only A-Z is lower-cased; words are runs without ASCII white space; a text of
    fewer than ``shingle`` words is one shingle; repeats vote each time.
    """
    if not text:
        return 0
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    n, votes, part = 0, np.zeros(64, dtype=np.int64), []
    for g in grams:
        part.append(xxhash.xxh64_intdigest(g, SEED))
        if len(part) == 65536:
            n, votes, part = n + len(part), votes + _votes(part), []
    if part:
        n, votes = n + len(part), votes + _votes(part)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def _votes(hashes: list[int]) -> np.ndarray:
    h = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(h, axis=1).sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, text_key, fp)`` per row; ``text_key`` tells apart texts that share an id."""
    def run(batches):
        for pdf in batches:
            fps = np.array([fingerprint(t, shingle) for t in pdf["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text_key": pdf["text_key"], "fp": fps.view(np.int64)})

    # Ids pass through Python as text: exact also where a batch has nulls.
    rows = docs.select(pick(id_col).cast("long").cast("string").alias("doc_id"),
                       F.xxhash64(pick(text_col)).alias("text_key"), pick(text_col).cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id string, text_key long, fp long") \
        .withColumn("doc_id", F.col("doc_id").cast("long"))


def _widths(segments: int, bits: int = 64) -> list[int]:
    return [bits // segments + (i < bits % segments) for i in range(segments)]


def ball(width: int, radius: int) -> list[int]:
    """Every xor mask of ``width`` bits with 1 to ``radius`` bits set."""
    return [sum(1 << b for b in c) for r in range(1, radius + 1) for c in combinations(range(width), r)]


def forest(fps: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links (distance <= ``max_bits``) among distinct signed fingerprints."""
    us, vs = [], []
    if len(fps) == 2:  # the usual case, without arrays
        if ((int(fps[0]) ^ int(fps[1])) & 0xFFFFFFFFFFFFFFFF).bit_count() <= max_bits:
            return [int(fps[0])], [int(fps[1])]
        return us, vs
    rest = fps.view(np.uint64)
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            near = np.bitwise_count(rest ^ x) <= max_bits
            if near.any():
                found = rest[near]
                us += [int(np.uint64(x).astype(np.int64))] * len(found)
                vs += found.astype(np.int64).tolist()
                front += list(found)
                rest = rest[~near]
    return us, vs


def links(distinct: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS,
          block: int = BLOCK) -> DataFrame:
    """Links ``(u, v)`` that connect the distinct fingerprints ``fp`` exactly as all links would."""
    radius = max_bits // segments
    entry, probe, at = [], [], 64
    for s, w in enumerate(_widths(segments)):
        at -= w
        part = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << w) - 1)) if w < 64 else F.col("fp")
        own = distinct.select("fp", F.lit(s).alias("seg"), part.alias("key"))
        masks = ball(w, radius)
        entry.append(own)
        if masks:
            probe.append(own.withColumn("mask", F.explode(F.lit(masks).cast("array<long>")))
                         .select("fp", "seg", F.col("key").bitwiseXOR(F.col("mask")).alias("key")))
    entry = reduce(DataFrame.unionByName, entry)
    members = entry
    if probe:
        keys = entry.select("seg", "key").distinct().hint("shuffle_hash")
        hits = reduce(DataFrame.unionByName, probe).join(keys, ["seg", "key"], "left_semi")
        members = entry.unionByName(materialize(hits.select("fp", "seg", "key"), "hits"))
    sizes = materialize(members.groupBy("seg", "key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    chunks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    rows = (members.join(sizes, ["seg", "key"])
            .withColumn("g", F.pmod(F.xxhash64(F.lit(7), "fp"), chunks.cast("long")).cast("int"))
            .withColumn("o", F.explode(F.sequence(F.lit(0), chunks - 1)))
            .select("seg", "key", F.least("g", "o").alias("i"), F.greatest("g", "o").alias("j"), "fp"))
    group = ["seg", "key", "i", "j"]

    def run(batches):
        us, vs = [], []
        for _, g in sorted_groups(batches, group):
            if len(g) > 1:
                u, v = forest(g["fp"].to_numpy(dtype=np.int64), max_bits)
                us += u
                vs += v
            if len(us) > 50_000:
                yield pd.DataFrame({"u": us, "v": vs}, dtype="int64")
                us, vs = [], []
        yield pd.DataFrame({"u": us, "v": vs}, dtype="int64")

    return rows.repartition(*group).sortWithinPartitions(*group).mapInPandas(run, "u long, v long")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               max_bits: int = MAX_BITS, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """``(doc_id, text_key, fp, component_id, keep)`` per input row.

    component_id: least id reachable over links, the row's own included.  keep:
    whether the row's (id, text) is the component's least; equal rows share it.

    Defined cases: a null or empty text, or one of white space only, has
    fingerprint 0 and links like any other; a null id never becomes a component
    id unless all its component's ids are null (then null); repeated rows are
    each returned; an empty table gives no rows; other columns are ignored.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct = materialize(fps.groupBy("fp").agg(
        F.min("doc_id").alias("rep"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")), "simhash-fp")
    star = materialize(components(links(distinct.select("fp"), max_bits, segments, block)), "simhash-star")
    nodes = star.select(F.col("u").alias("fp"), "root").unionByName(
        star.select(F.col("root").alias("fp"), "root").distinct())
    linked = materialize(nodes.join(distinct, "fp"), "simhash-linked")
    least = linked.groupBy("root").agg(F.min("rep").alias("c"), F.min("first").alias("f"))
    label = linked.select("fp", "root").join(least, "root").select("fp", "c", "f")
    names = materialize(distinct.join(label, "fp", "left").select(
        "fp", F.when(F.col("f").isNull(), F.col("rep")).otherwise(F.col("c")).alias("component_id"),
        F.coalesce("f", "first").alias("first")), "simhash-name")
    return fps.join(names, "fp").select(
        "doc_id", "text_key", "fp", "component_id",
        (F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_key") == F.col("text_key"))).alias("keep"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each component: that of the least id (null last), its columns unchanged.

    Of repeated rows with that id and text, the one first in the order of its
    other columns' hash stays.
    """
    chosen = near_dedup(docs, id_col, text_col, **how).where("keep").select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    rows = docs.select(pick(id_col).cast("long").alias("id"), F.xxhash64(pick(text_col)).alias("key"),
                       F.xxhash64(*[pick(c) for c in docs.columns]).alias("order"), caller_row(docs))
    on = rows["id"].eqNullSafe(chosen["__id"]) & (rows["key"] == chosen["__key"])
    # A partial aggregate: however often a row repeats, a task hands on one of its copies.
    return rows.join(chosen, on, "left_semi").groupBy("id", "key").agg(F.min_by("row", "order").alias("row")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-dedup of the whole ``documents`` table by the fixed shingle and distance."""
    return near_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "keep")
