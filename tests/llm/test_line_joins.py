"""Line dedup: what its joins make, and the bit sets that narrow its scans."""

import random

import numpy as np
from pyspark.sql import functions as F

from priceframe.llm import line_dedup
from priceframe.llm.common import bit_sketch, maybe_in


def test_bit_sketch_loses_no_key_and_passes_few_others(spark):
    keys = spark.range(20000).select((F.col("id") * 7).alias("k"))
    got = maybe_in(spark.range(140000).select(F.col("id").alias("k"), F.lit("x").alias("mine")),
                   bit_sketch(keys, F.col("k")), F.col("k"))
    assert got.columns == ["k", "mine", "maybe"] and got.count() == 140000
    assert got.where("k % 7 = 0 and not maybe").count() == 0
    assert got.where("k % 7 <> 0 and maybe").count() < 400  # by chance 0.03 %; 2 ** 18 buckets would pass 7 %
    assert not maybe_in(keys, bit_sketch(keys.limit(0), F.col("k")), F.col("k")).where("maybe").count()


def test_lines_that_share_a_passage_are_no_pairs_unless_alike(spark, monkeypatch):
    """Lines of one length with a common third: the written pairs are few, and no link is lost."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(20)) for _ in range(60)]
    lines = ["one common passage--" + w + v for w, v in zip(words, reversed(words), strict=True)]
    lines += [lines[0][:-1] + "X", lines[1][:25] + "Y" + lines[1][26:-1] + "Z"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    seen, write = {}, line_dedup.materialize

    def noted(df, tag="tmp"):
        seen[tag] = write(df, tag)
        return seen[tag]
    monkeypatch.setattr(line_dedup, "materialize", noted)
    out = {r["doc_id"]: r["dropped"] for r in line_dedup.line_dedup(docs).collect()}
    assert [d for d, cut in sorted(out.items()) if cut] == [60, 61]
    # All pairs are 1,891; the counts of two letters passed most of them.
    assert 2 <= seen["line-pairs"].count() <= 60
    assert seen["line-texts"].schema["sig"].dataType.simpleString() == "bigint"


def test_links_come_from_columns_alone_and_equal_the_distance(spark):
    """No Python in the plan of the links, and the column for alike lines says what the bit-parallel distance says."""
    rng = random.Random(8)
    stem = "the cat sät on one long mat 漢字 by the river"
    lines = []
    for _ in range(40):
        line = list(stem)
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(line))
            line[at:at + 1] = rng.choice([[], ["x"], [line[at], "y"]])
        lines.append("".join(line))
    one = F.struct("k", line_dedup.letter_counts(F.col("line")).alias("sig"), F.char_length("line").alias("n"), "line")
    rows = spark.createDataFrame(list(enumerate(lines)), "k int, line string").select(one.alias("a"))
    near = rows.crossJoin(rows.select(F.col("a").alias("b"))).where("a.k < b.k") \
        .where(line_dedup.alike(F.col("a"), F.col("b"))).select("a.k", "b.k").collect()
    ia, ib = np.triu_indices(len(lines), 1)
    want = line_dedup.within(lines, ia, ib)
    assert {tuple(r) for r in near} == set(zip(ia[want].tolist(), ib[want].tolist(), strict=True)) and want.any()

    docs = spark.createDataFrame([(i, f"opened on day {i:03d} of the long season") for i in range(80)], "doc_id long, text string")
    line = F.col("line")
    distinct = line_dedup._lines(docs, "doc_id", "text").withColumn("n", F.char_length("line")).select(
        F.xxhash64(line).alias("h1"), F.array(*line_dedup.index_keys(line, F.col("n"))).alias("ks"),
        F.array(*line_dedup.probe_keys(line, F.col("n"))).alias("ps"))
    links = line_dedup.line_links(docs, distinct, "doc_id", "text", 2, 16, hot=8)
    plan = links._jdf.queryExecution().toString()
    assert "MapInPandas" not in plan and "Python" not in plan
    assert links.count()
