"""Chunk look-ups of the tokenizers and the files that token shards leave."""

import os
import random

import pytest

from priceframe.llm import packing, token_files
from priceframe.llm.tokens import LONGEST, ChunkEncoder


def test_writing_shards_leaves_their_files_and_the_index_only(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} of many") for i in range(60)], "doc_id long, text string")
    uri = str(tmp_path / "shards")
    index = token_files.write_token_files(docs.repartition(4), uri).collect()
    left = {x.split(".")[-1] for x in os.listdir(uri)}
    assert left == {"tokens", "offsets", "ids", "nulls", "index"}  # no file of counts per writing task
    assert sum(r["docs"] for r in index) == 60
    assert [r["doc_base"] for r in sorted(index, key=lambda r: r["shard"])][0] == 0
    assert [r["doc_id"] for r in token_files.read_token_files(spark, uri).orderBy("start").collect()] == list(range(60))


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("cache", [0, 5, 1 << 20])
def test_chunk_lookups_equal_the_tokenizer(vocabulary, cache):
    rng = random.Random(cache)
    words = ["a", "the", "naïve", "漢字", "x-y,", "1234", "it's", "w" * (LONGEST + 1), "A", "\tb", "c\n"]
    enc = ChunkEncoder(vocabulary, cache)
    for _ in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 12)))
        assert enc.encode(text) == enc.whole(text)
    assert len(enc.later) <= cache and len(enc.first) <= cache
    assert not any(len(c) > LONGEST for c in [*enc.later, *enc.first])


def test_known_chunks_are_joined_without_a_list_of_finds():
    enc = ChunkEncoder("byte_bpe_50k.json")
    text = "one two three two one"
    enc.encode(text)
    assert isinstance(enc._look(enc.later, text.split(" ")[1:], " "), bytes)


def test_packing_bounds_what_a_worker_holds(spark, monkeypatch):
    """Few rows a batch and a cache of a quarter of the tokenizers' largest: else two workers filled an executor."""
    real = packing.encoder

    def bounded(name, cache=1 << 20):
        assert cache <= 1 << 18
        return real(name, cache)
    monkeypatch.setattr(packing, "encoder", bounded)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        docs = spark.createDataFrame([(i, f"text {i} of many") for i in range(1200)], "doc_id long, text string")
        assert packing.pack(docs, with_ids=True).select("doc_id").distinct().count() == 1200
        assert int(spark.conf.get(key)) <= 500
    finally:
        spark.conf.set(key, before)
