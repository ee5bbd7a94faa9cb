"""Exact distinct counts by bitmaps, and joins with a panel that leave bucketed facts where they are."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from priceframe.operators import bitmaps, enrich, summarize as S
from priceframe.operators._util import materialize
from priceframe.plans import bindings as B, jobs as J
from priceframe.session import scratch_path
from priceframe.sources import writers


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(6)
    # Ids around the ends of a bitmap, negative and null ones; one group has a third of the rows, one only nulls.
    ids = [None, 0, 1, -1, 32767, 32768, 32769, 65536, 65537, 1 << 40, -(1 << 40), *range(100, 160)]
    made = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([1, 2, None]), rng.choice(ids)) for _ in range(2000)]
    made += [("void", 1, None)] * 3
    return materialize(spark.createDataFrame(made, "g string, p int, k long"), "bits"), made


def test_bitmaps_count_exactly_for_any_group(spark, rows):
    df, made = rows
    b = materialize(bitmaps.distinct_bitmaps(df, ["g", "p"], "k"), "bits")
    for by, at in ((["g", "p"], (0, 1)), (["g"], (0,)), (["p"], (1,)), ([], ())):
        want = {}
        for r in made:
            want.setdefault(tuple(r[i] for i in at), set()).add(r[2])
        got = {tuple(r[c] for c in by): r["n_distinct"] for r in bitmaps.bitmap_counts(b, by).collect()}
        assert got == {k: len(v - {None}) for k, v in want.items()}
    assert got[()] == len({r[2] for r in made} - {None})


def test_merged_bitmaps_equal_those_of_the_whole(rows):
    df, _ = rows
    parts = bitmaps.merge_bitmaps(bitmaps.distinct_bitmaps(df, ["g", "p"], "k"), ["g"])
    whole = bitmaps.distinct_bitmaps(df, ["g"], "k")
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))


def test_dictionary_ids_are_dense_and_ordered(spark):
    names = [f"n{i:04d}" for i in range(500)]
    df = materialize(spark.createDataFrame([(n,) for n in [*names, *names[:100], None]], "v string"), "names")
    assert [(r["v"], r["id"]) for r in bitmaps.dictionary(df, "v").orderBy("id").collect()] == list(
        zip(names, range(500), strict=True))


def test_overview_by_bitmaps_without_expanded_rows(spark):
    facts = spark.createDataFrame([("a", 2000), ("a", 2001), (None, 2001), ("b", None), ("a", 2000)], "name string, year int")
    empty = facts.limit(0)
    for df in (facts, empty, B.facts_snapshot(spark, SF_SMALL)):
        by_bits = bitmaps.overview(df)
        assert by_bits.collect() == S.overview(df).collect()
        assert "Expand" not in plan(by_bits)
    assert "Expand" in plan(S.overview(facts))


def test_bucketed_facts_are_not_shuffled(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table, buckets = B.bucketed_snapshot(spark, SF_SMALL)
        assert B.bucketed_snapshot(spark, SF_SMALL)[0].inputFiles() == table.inputFiles()  # written once
        panel = materialize(J.per_capita_panel(spark, SF_SMALL), "panel")
        args = (panel, ["iso_a3", "year"], ["iso", "year"], "per_capita")
        got = enrich.join_fill_bucketed(table, *args, buckets, B.BUCKET_SALTS, writers.SALT)
        p = plan(got)
        assert "Bucketed: true" in p and "SortMergeJoin" in p
        assert p.count("Exchange hashpartitioning") == 1 and "__ps" in p.split("Exchange hashpartitioning")[1].split("\n")[0]
        raw = B.raw_snapshot(spark, SF_SMALL)
        plain = enrich.join_fill(raw, *args, max_broadcast_bytes=0)
        assert plan(plain).count("Exchange hashpartitioning") == 2
        cols = ["obs_id", "iso_a3", "year", "per_capita"]
        assert sorted(got.select(*cols).collect(), key=str) == sorted(plain.select(*cols).collect(), key=str)
        assert sorted(got.columns) == sorted(plain.columns)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_hot_key_lies_in_many_buckets(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), "id")).alias("k"))
    name = "hot_keys_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    t = writers.sink_bucketed(df, name, scratch_path(spark, name), ["k"], 16, 16, "id")
    files = t.where("k = 'hot'").select(F.input_file_name().alias("f"), "id").groupBy("f").count().collect()
    assert len(files) >= 6 and max(r["count"] for r in files) <= 600
    panel = spark.createDataFrame([("hot", 1.5)], "k string, v double")
    got = enrich.join_fill_bucketed(t, panel, ["k"], ["k"], "v", 16, 16, writers.SALT)
    assert got.count() == 4000 and got.where("v = 1.5").count() == df.where("k = 'hot'").count()
    spark.sql(f"DROP TABLE {name}")


def test_released_scratch_takes_the_bucketed_table_along(spark):
    name = B.bucketed_snapshot(spark, SF_SMALL)[0].inputFiles()[0].split("/")[-2]
    assert spark.catalog.tableExists(name)
    B.forget_snapshots(spark)
    assert not spark.catalog.tableExists(name)
    assert B.bucketed_snapshot(spark, SF_SMALL)[0].count() == B.raw_snapshot(spark, SF_SMALL).count()
