"""Operator 10: token ids as flat binary files with 64-bit document offsets, read back by memory map.

Format, per shard ``NNNNN`` of a folder: ``NNNNN.tokens`` unsigned 16- or 32-bit
little-endian ids of its documents in a row, ``NNNNN.offsets`` unsigned 64-bit
first-id positions within the shard (one more than documents), ``NNNNN.ids``
signed 64-bit document ids, ``NNNNN.nulls`` one byte per document, 1 for a null
id.  Shards follow each other in ascending document id; ``index`` (Parquet) has
one row per shard with its counts and its bases, the prefix sums of the counts
before it, so that base + offset is a document's place in the whole.

Scale: one range shuffle of the texts; each task writes one shard in passing
and nothing returns but its counts.  A shard is written under a name of the
attempt's own and then renamed, so a retried or speculative task replaces it by
the same bytes.  Files go to the folder's file system through pyarrow when it is
not a mounted one.
"""

from __future__ import annotations

import os
import uuid
import zlib
from urllib.parse import urlparse

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import pick, table
from .tokens import encoder

VOCABULARY = "word_bpe_49k.json"
END_ID = 2        #: appended to each document
READ_ROWS = 8192  #: documents a reading task hands over at once


def _filesystem(uri: str):
    """(pyarrow file system, path within it, whether it is mounted here)."""
    from pyarrow import fs

    if urlparse(uri).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(uri).path if "://" in uri or uri.startswith("file:") else uri, True
    system, path = fs.FileSystem.from_uri(uri)
    return system, path, False


def write_token_files(docs: DataFrame, uri: str, id_col: str = "doc_id", text_col: str = "text",
                      vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Write the shards and the index under ``uri``; returns the index.

    Defined cases: a null or empty text is the end id alone; null ids come first
    and read back as null; rows that repeat an id are in the order of their
    texts; an empty table writes an index without rows; other columns are not
    read.
    """
    def run(batches):
        system, base, mounted = _filesystem(uri)
        ctx = TaskContext.get()
        shard, enc = ctx.partitionId(), encoder(vocabulary)
        own = f"{base}/.{shard:05d}-{ctx.taskAttemptId()}"
        kinds = ("tokens", "offsets", "ids", "nulls")
        end, docs_, at, out = enc.pack([end_id]), 0, 0, None
        try:
            for pdf in batches:
                if not len(pdf):
                    continue
                if out is None:
                    system.create_dir(base, recursive=True)
                    out = {k: system.open_output_stream(f"{own}.{k}") for k in kinds}
                    out["offsets"].write(np.zeros(1, "<u8").tobytes())
                coded = [enc.encode(t) + end for t in pdf["text"]]
                ends = at + np.cumsum([len(c) // enc.dtype.itemsize for c in coded], dtype="<u8")
                nulls = pdf["doc_id"].isna().to_numpy()
                for c in coded:
                    out["tokens"].write(c)
                out["offsets"].write(ends.astype("<u8").tobytes())
                out["ids"].write(np.array([int(i or 0) for i in pdf["doc_id"]], "<i8").tobytes())
                out["nulls"].write(nulls.astype("u1").tobytes())
                docs_, at = docs_ + len(pdf), int(ends[-1])
        finally:
            for f in (out or {}).values():
                f.close()
        if out is not None:
            for k in kinds:
                if mounted:
                    os.replace(f"{own}.{k}", f"{base}/{shard:05d}.{k}")
                else:
                    system.move(f"{own}.{k}", f"{base}/{shard:05d}.{k}")
            yield pd.DataFrame({"shard": [shard], "docs": [docs_], "tokens": [at], "width": [enc.dtype.itemsize]})

    rows = docs.select(pick(id_col).cast("long").alias("doc_id"), pick(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()) \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text") \
        .withColumn("doc_id", F.col("doc_id").cast("string"))  # exact through pandas also beside nulls
    spark = docs.sparkSession
    counts = ordered.mapInPandas(run, "shard int, docs long, tokens long, width int")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard: the window's single task is as small as the number of writing tasks.  The counts reach it by
    # the shuffle, so a shard's task leaves no file but the shard's, and a retried index does not tokenize anew.
    counts.select(
        "shard", "docs", "tokens", "width",
        F.coalesce(F.sum("docs").over(before), F.lit(0)).cast("long").alias("doc_base"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long").alias("token_base"),
    ).write.mode("overwrite").parquet(f"{uri}/index")
    return spark.read.parquet(f"{uri}/index")


def _flat(uri: str, name: str, dtype: str, count: int):
    """A file's values: a memory map where the folder is mounted, else its bytes."""
    system, base, mounted = _filesystem(uri)
    if mounted:
        return np.memmap(f"{base}/{name}", dtype=dtype, mode="r", shape=(count,))
    with system.open_input_file(f"{base}/{name}") as f:
        return np.frombuffer(f.read(), dtype=dtype, count=count)


def read_token_files(spark: SparkSession, uri: str, with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32[, ids])`` per document, from the files alone; a task per shard."""
    index = spark.read.parquet(f"{uri}/index")
    shards = max(1, index.count())

    def run(batches):
        for pdf in batches:
            for s in pdf.itertuples():
                tokens = _flat(uri, f"{s.shard:05d}.tokens", f"<u{s.width}", s.tokens)
                offsets = _flat(uri, f"{s.shard:05d}.offsets", "<u8", s.docs + 1).astype("int64")
                ids = _flat(uri, f"{s.shard:05d}.ids", "<i8", s.docs)
                nulls = _flat(uri, f"{s.shard:05d}.nulls", "u1", s.docs)
                for lo in range(0, s.docs, READ_ROWS):
                    hi = min(lo + READ_ROWS, s.docs)
                    bounds = offsets[lo:hi + 1]
                    parts = [tokens[a:b].astype("<u4").tolist() if with_ids else None
                             for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                    crcs = [zlib.crc32(tokens[a:b].astype("<u4").tobytes())
                            for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                    yield pd.DataFrame({
                        "doc_id": pd.Series(np.array(ids[lo:hi]), dtype="Int64").mask(np.array(nulls[lo:hi]) == 1),
                        "start": s.token_base + bounds[:-1], "n_tokens": np.diff(bounds), "ids_crc32": crcs,
                        "ids": parts})

    out = index.repartition(shards, "shard").mapInPandas(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<long>")
    return out if with_ids else out.drop("ids")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table written in the file format and read back."""
    uri = scratch_path(spark, f"token-files-{uuid.uuid4().hex}")
    write_token_files(table(spark, sf_dir, "documents"), uri)
    return read_token_files(spark, uri)
