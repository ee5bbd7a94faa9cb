"""Operator 8: packing documents into sequences by first-fit decreasing in randomised groups.

A document's ids are cut into pieces of the sequence length and one shorter rest;
each piece is placed whole.  Pieces are dealt to groups at random (by hash), and
each group is packed by itself: longest first, each into the first sequence
with room, found in a tournament tree of the sequences' free room in
logarithmic time.

Scale: tokenization is a map over the scan and is written once, so a lost
executor does not tokenize anew; only narrow piece rows are shuffled.  Groups
hold about ``GROUP`` pieces however many documents, sources or copies there are,
and a very long document spreads over all groups.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, pick, rows_per_task, small_batches, sorted_groups, table
from .tokens import encoder

LENGTH = 2048                      #: tokens a sequence holds
VOCABULARY = "byte_bpe_50k.json"
END_ID = 1                         #: appended to each document
GROUP = 2048                       #: pieces of a group, on average
SEED = 8
CACHE = 1 << 18                    #: chunks remembered by one Python worker; more of them take memory and save little


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
           end_id: int = END_ID, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """The cut documents: ``(doc_id, start, length, ids_crc32, doc_tokens[, ids])``, ids as packed unsigned integers."""
    def run(batches):
        enc = encoder(vocabulary, CACHE)
        end, width = enc.pack([end_id]), enc.dtype.itemsize
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                ids = enc.encode(text) + end
                n = len(ids) // width
                wide = memoryview(np.frombuffer(ids, enc.dtype).astype("<u4")).cast("B")
                for at in range(0, n, length):
                    to = min(at + length, n)
                    out.append((doc, at, to - at, zlib.crc32(wide[4 * at:4 * to]), n,
                                ids[at * width:to * width] if with_ids else None))
            got = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
            yield got

    # Ids pass through Python as text: exact also where a batch has nulls.
    rows = docs.select(pick(id_col).cast("long").cast("string").alias("doc_id"),
                       pick(text_col).cast("string").alias("text"))
    cut = rows.mapInPandas(run, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, ids binary")
    cut = cut.withColumn("doc_id", F.col("doc_id").cast("long"))
    return cut if with_ids else cut.drop("ids")


class RoomTree:
    """A tournament tree over bins: each node holds the most free room below it."""

    def __init__(self, bins: int, room: int):
        self.size = 1 << max(0, bins - 1).bit_length()
        self.top = [room] * (2 * self.size)

    def first_fit(self, need: int) -> int:
        """The first bin with at least ``need`` room; takes it from there."""
        top, at = self.top, 1
        while at < self.size:
            at *= 2
            if top[at] < need:
                at += 1
        bin_ = at - self.size
        top[at] -= need
        while at > 1:
            at //= 2
            top[at] = max(top[2 * at], top[2 * at + 1])
        return bin_


def first_fit_decreasing(lengths, room: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each of ``lengths`` (descending, none above ``room``)."""
    tree, used, bins, offsets = RoomTree(max(1, len(lengths)), room), {}, [], []
    for n in lengths:
        b = tree.first_fit(int(n))
        bins.append(b)
        offsets.append(used.get(b, 0))
        used[b] = offsets[-1] + int(n)
    return bins, offsets


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
         end_id: int = END_ID, length: int = LENGTH, group: int = GROUP, seed: int = SEED,
         with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids])`` per piece.

    Same rows and parameters give the same sequences whatever the partitions,
    but for repeated rows, which may swap places.

    Defined cases: a null or empty text is the end id alone, one piece of length
    1; a null id stays null; repeated rows are packed each; an empty table gives
    no rows; other columns are not read.
    """
    small_batches(docs.sparkSession)
    cut = materialize(pieces(docs, id_col, text_col, vocabulary, end_id, length, with_ids), "pieces")
    groups = rows_per_task(cut.count(), group)
    keyed = cut.withColumn("g", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", "ids_crc32", "doc_tokens"),
                                       F.lit(groups).cast("long")))
    names = [f.name for f in cut.schema.fields]

    def run(batches):
        for (g,), rows in sorted_groups(batches, ["g"]):
            bins, offsets = first_fit_decreasing(rows["length"].tolist(), length)
            out = rows[names].copy()
            out["sequence_id"] = np.array(bins, dtype="int64") + (int(g) << 32)
            out["offset"] = np.array(offsets, dtype="int64")
            yield out

    keyed = keyed.withColumn("doc_id", F.col("doc_id").cast("string"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema.fields if f.name != "g")
    return (keyed.repartition("g").sortWithinPartitions("g", F.desc("length"), "doc_id", "start", "ids_crc32")
            .mapInPandas(run, schema + ", sequence_id long, offset long")
            .withColumn("doc_id", F.col("doc_id").cast("long")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table packed."""
    return pack(table(spark, sf_dir, "documents"))
