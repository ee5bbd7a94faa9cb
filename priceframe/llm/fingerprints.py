"""Operator 3: document fingerprints by SimHash over weighted terms, searched in permuted block tables.

A fingerprint has 128 bits.  Terms are pairs of neighbouring words (the text's
start and end count as words); a term votes +w or -w on every bit by its hash,
w = 1 + ln(occurrences), and a bit is 1 if its votes are above 0.  The share of
equal bits of two fingerprints estimates how alike the texts are.

Search: permuted block tables.  The bits are cut into ``radius`` + ``FRONT`` blocks;
two fingerprints within ``radius`` differ in at most ``radius`` of them, so at least
``FRONT`` blocks are equal.  There is a table for every choice of ``FRONT`` blocks,
keyed by these in front; a query meets the entries of each table that have its
front, and the complete distance is verified in the join.  At 14 bits blocks are
bytes and a front has 16 bits in each of 120 tables.  Tables are taken in
``PASSES`` passes, so the shuffle on disk at a time is that of 30 tables, at most
about 0.7 KB a distinct fingerprint; entries whose front no query of the pass has are left out
before it by a bit set of fixed size.  The radius covers copies with about 1 % of
their words replaced.

The next document in descending id order comes from one range-dealt sort: ids
are cut at their quantiles into buckets, each bucket is sorted by itself and
also gets the first document of the bucket after it, so no task sees all rows
and texts are shuffled once.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, pick, small_batches, table

BITS = 128
RADIUS = 14         #: of the search; unrelated texts are about 64 bits apart
FRONT = 2           #: blocks that make a table's key
PASSES = 4          #: in which the tables are searched
BLOCK_BITS = 20     #: of a block that enter a key at most; the rest is compared in the join
FRONT_BITS = FRONT * BLOCK_BITS
MARKS = 1 << 23     #: bits of the set of fronts asked for in a pass, 64 to a long
QUERY_EVERY = 100   #: rows whose id this divides are the search's queries
SEED = 3
CHUNK = 4096        #: terms whose bits are laid out at a time
_LEAST = -(1 << 63)  #: stands for a null id: last in descending order


def _word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, SEED)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (constants of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: str | None) -> bytes:
    """The 16 bytes of one text's fingerprint; a text without words has all bits 0."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return bytes(BITS // 8)
    h = np.array([1, *map(_word_hash, words), 2], dtype=np.uint64)
    terms, times = np.unique(_mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]), return_counts=True)
    weights = 1.0 + np.log(times)
    votes = np.zeros(BITS)
    for at in range(0, len(terms), CHUNK):
        t, w = terms[at:at + CHUNK], weights[at:at + CHUNK]
        both = np.stack([_mix(t + np.uint64(1)), _mix(t + np.uint64(2))], axis=1).astype(">u8")
        bits = np.unpackbits(both.view(np.uint8).reshape(len(t), BITS // 8), axis=1)
        votes += 2.0 * (w @ bits.astype(np.float64)) - w.sum()
    return np.packbits(votes > 1e-9).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal bits."""
    return 1.0 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / (8 * len(a))


def with_next(docs: DataFrame, id_col: str, text_col: str, run, schema: str) -> DataFrame:
    """``run(pairs)`` over all (row, next row) in descending id order, the last's next being the first.

    ``run`` gets an iterator of (id as text, text, next text) and yields data
    frames of ``schema``.  Rows of one id are in the order of their texts.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.coalesce(pick(id_col).cast("long"), F.lit(_LEAST)).alias("o"),
                       F.coalesce(pick(text_col).cast("string"), F.lit("")).alias("text"))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = np.unique(np.array(rows.select(F.col("o").cast("double")).approxQuantile(
        "o", [i / buckets for i in range(1, buckets)], 0.1 / buckets)))

    def at(o: pd.Series) -> np.ndarray:  # bucket 0 has the largest ids
        return len(cuts) - np.searchsorted(cuts, o.to_numpy(dtype="float64"), side="left")

    @F.pandas_udf("int")
    def bucket(o: pd.Series) -> pd.Series:
        return pd.Series(at(o).astype("int32"))

    heads = rows.select("o").groupBy(bucket("o").alias("b")).agg(F.max("o").alias("o")).orderBy("b").collect()
    # The first id of each bucket goes also to the end of the one before; the very first to the last's end.
    ends = {heads[i]["o"]: heads[i - 1]["b"] for i in range(len(heads))}

    @F.pandas_udf(T.StructType([T.StructField("b", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    def places(o: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"b": at(o).astype("int32"), "end": [ends.get(x, -1) for x in o.tolist()]})

    placed = rows.withColumn("p", places("o")).select("o", "text", F.explode(F.filter(F.array(
        F.struct(F.col("p.b").alias("b"), F.lit(False).alias("tail")),
        F.struct(F.col("p.end").alias("b"), F.lit(True).alias("tail"))), lambda x: x["b"] >= 0)).alias("x")) \
        .select("o", "text", "x.b", "x.tail")

    def pairs(batches):
        held, open_ = None, None
        for pdf in batches:
            for o, text, b, tail in zip(pdf["o"], pdf["text"], pdf["b"], pdf["tail"], strict=True):
                if held is not None and open_ == b:
                    yield held[0], held[1], text
                held, open_ = (None, None) if tail else ((o, text), b)

    def work(batches):
        yield from run(pairs(batches))

    return (placed.repartition("b").sortWithinPartitions("b", "tail", F.desc("o"), F.xxhash64("text"))
            .mapInPandas(work, schema))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` per row.

    The edited text has its last floor(n_chars / 3) code points replaced by the
    first as many (or all) of the next document's in descending id order.

    Defined cases: null counts as empty; null ids come last; repeated ids are in
    the order of their texts' hashes; a lone row is its own next; an empty table gives
    no rows; other columns are not read.
    """
    def run(pairs):
        out, size, known = [], 0, (None, b"")
        for doc, text, after in pairs:
            own = known[1] if known[0] is not None and known[0] == text else fingerprint(text)
            n = len(text)
            edited = text[:n - n // 3] + after[:n // 3]
            changed, ahead = fingerprint(edited), fingerprint(after)
            known = (after, ahead)
            out.append((doc, n, hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), own.hex(),
                        changed.hex(), likeness(own, changed), likeness(own, ahead)))
            size += 1
            if size >= 5000:
                yield pd.DataFrame(out, columns=names)
                out, size = [], 0
        yield pd.DataFrame(out, columns=names)

    names = ["o", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    got = with_next(docs, id_col, text_col, run, "o long, n_chars long, edited_sha256 string, fingerprint string, "
                    "edited_fingerprint string, near_edited double, near_next double")
    return got.select(F.when(F.col("o") != _LEAST, F.col("o")).alias("doc_id"), *names[1:])


def _halves(fp):
    """The two signed 64-bit halves of a fingerprint in hexadecimal."""
    return [F.conv(F.substring(fp, at, 16), 16, -10).cast("long") for at in (1, 17)]


def _cut(high, low, at: int, width: int):
    """Bits ``at`` to ``at + width`` of the 128 bits in two longs, from the lowest."""
    if at >= 64:
        v = F.shiftrightunsigned(high, at - 64)
    elif at + width <= 64:
        v = F.shiftrightunsigned(low, at)
    else:
        v = F.shiftrightunsigned(low, at).bitwiseOR(F.shiftleft(high, 64 - at))
    return v if width >= 64 else v.bitwiseAND(F.lit((1 << width) - 1))


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the blocks: ``FRONT`` more than can differ."""
    edges = [round(i * BITS / (radius + FRONT)) for i in range(radius + FRONT + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]


def asked_fronts(marks: DataFrame):
    """The set of numbers ``m`` below ``MARKS`` as one array of longs, 64 to each: a scalar of 1 MB whatever the input."""
    words = marks.groupBy(F.shiftright("m", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(m & 63 as int))")).alias("set"))
    every = marks.sparkSession.range(MARKS >> 6).withColumnRenamed("id", "word").join(words, "word", "left")
    whole = every.agg(F.array_sort(F.collect_list(F.struct("word", F.coalesce("set", F.lit(0).cast("long")).alias("set")))).alias("w"))
    return whole.select(F.transform("w", lambda x: x["set"])).scalar()


def search(queries: DataFrame, entries: DataFrame, radius: int = RADIUS, passes: int = PASSES) -> DataFrame:
    """``(q, fp)``: every ``fp`` of ``entries`` within ``radius`` bits (at most 60) of a query fingerprint ``q``, both distinct.

    Every pass reads both frames again, so they should be read from files.  A
    null fingerprint meets nothing; an empty side gives no rows.
    """
    blocks = _blocks(radius)
    tables = list(combinations(range(len(blocks)), FRONT))

    def halves(df, name):
        hi, lo = _halves(F.col(name))
        return df.select(hi.alias(f"{name}0"), lo.alias(f"{name}1"))

    def keyed(df, name, chosen):
        """``df`` once per chosen table, with its key: the table's number, then the blocks in front."""
        keys = []
        for t in chosen:
            key = F.lit(t << FRONT_BITS)
            for i, b in enumerate(tables[t]):
                at, width = blocks[b]
                key = key.bitwiseOR(F.shiftleft(_cut(F.col(f"{name}0"), F.col(f"{name}1"), at, min(width, BLOCK_BITS)), BLOCK_BITS * i))
            keys.append(key)
        return df.select(f"{name}0", f"{name}1", F.explode(F.array(*keys)).alias("key"))

    # A pair that meets in several tables counts in the one of its first equal blocks.
    differ = [F.col(f"q{h}").bitwiseXOR(F.col(f"fp{h}")) for h in (0, 1)]
    equal = F.lit(0).cast("long")
    for b, (at, width) in enumerate(blocks):
        equal = equal.bitwiseOR(F.when(_cut(*differ, at, width) == 0, F.lit(1 << b)).otherwise(F.lit(0)).cast("long"))
    number = F.shiftrightunsigned("key", FRONT_BITS).cast("int") + 1
    own = F.element_at(F.lit([sum(1 << b for b in t) for t in tables]).cast("array<long>"), number)
    upto = F.element_at(F.lit([(2 << t[-1]) - 1 for t in tables]).cast("array<long>"), number)
    apart = F.bit_count(differ[0]) + F.bit_count(differ[1])

    def text(name):
        return F.lower(F.concat(*[F.lpad(F.hex(f"{name}{h}"), 16, "0") for h in (0, 1)])).alias(name)

    asked, held = halves(queries, "q"), halves(entries, "fp")
    mark = F.pmod(F.xxhash64("key"), F.lit(MARKS))
    parts = []
    for p in range(min(passes, len(tables))):
        chosen = range(p, len(tables), passes)
        probes = keyed(asked, "q", chosen)
        asked_for = asked_fronts(probes.select(mark.alias("m")))
        index = keyed(held, "fp", chosen).withColumn("m", mark).where(F.getbit(
            F.element_at(asked_for, (F.shiftright("m", 6) + 1).cast("int")), F.col("m").bitwiseAND(F.lit(63)).cast("int")) == 1) \
            .select("key", "fp0", "fp1")
        # The planner does not see how many rows the tables make: never a broadcast.
        parts.append(materialize(probes.hint("merge").join(index, "key").where(
            (apart <= radius) & (equal.bitwiseAND(upto) == own)).select(text("q"), text("fp")), "fp-pass"))
    return reduce(DataFrame.unionByName, parts)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of the whole ``documents`` table and of the edited texts; n_near: for rows whose id
    ``QUERY_EVERY`` divides, how many other rows have a fingerprint within ``RADIUS`` bits (else null)."""
    rows = materialize(edited_fingerprints(table(spark, sf_dir, "documents")), "fingerprints")
    entries = materialize(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.count("*").alias("n")), "fp-tables")
    asked = F.col("doc_id") % QUERY_EVERY == 0
    queries = materialize(rows.where(asked).select(F.col("fingerprint").alias("q")).distinct(), "fp-queries")
    near = materialize(search(queries, entries.select("fp")).join(entries, "fp")
                       .groupBy("q").agg((F.sum("n") - 1).alias("n_near")), "fp-near")
    on = (rows["fingerprint"] == near["q"]) & (rows["doc_id"] % QUERY_EVERY == 0)
    return rows.join(near, on, "left").drop("q")
