"""Restarts, conflicts and keys: what must not be lost or picked silently."""

import uuid

import pytest
from pyspark.sql import functions as F

from priceframe.operators import distribution as D, enrich, select
from priceframe.schemas import header_role, key_column, snapshot_columns
from priceframe.session import scratch_path
from priceframe.streaming import enrich_stream
from conftest import SF_SMALL


def test_stream_restart_takes_each_row_once(spark):
    from priceframe.plans import bindings as B, jobs as J

    raw = B.raw_snapshot(spark, SF_SMALL)
    src = scratch_path(spark, f"restart-src-{uuid.uuid4().hex}")
    out = scratch_path(spark, f"restart-out-{uuid.uuid4().hex}")
    panel = J.per_capita_panel(spark, SF_SMALL)
    for part in (F.col("obs_id") % 2 == 0, F.col("obs_id") % 2 == 1):  # a file arrives between two starts
        raw.where(part).write.mode("append").option("header", True).csv(src)
        enrich_stream(spark, src, panel, out, raw.schema).awaitTermination()
    got = [r["obs_id"] for r in spark.read.parquet(out).select("obs_id").collect()]
    want = [r["obs_id"] for r in J.enrich_facts(spark, SF_SMALL).select("obs_id").collect()]
    assert sorted(got) == sorted(want)


def test_conflicting_panel_raises(spark):
    same = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 2.0), ("b", 1, None)], "k string, y int, v double")
    assert enrich.unique_panel(same, ["k", "y"], "v").count() == 2
    two = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 9.0)], "k string, y int, v double")
    with pytest.raises(Exception, match="two values of v"):
        enrich.unique_panel(two, ["k", "y"], "v").collect()


def test_selection_of_any_length(spark):
    d = spark.range(100).withColumn("s", F.col("id").cast("string"))
    assert select.filter_selected(d, "s", [str(i) for i in range(60)]).count() == 60
    assert select.filter_selected(d, "s", []).count() == 0


def test_key_hash_takes_any_key(spark):
    d = spark.createDataFrame([(2 ** 63 - 1, "x"), (-2 ** 63, "y"), (5, None)], "i long, s string")
    for key in ("i", "s"):
        assert all(0 <= r[0] < D.HASH_MOD for r in d.select(D.key_hash(d, key)).na.drop().collect())


def test_header_roles():
    assert header_role("2020 Population") == ("snapshot", 2020) and header_role("pop_1999") == ("snapshot", 1999)
    assert header_role("World Population Percentage") == ("other", None) and header_role("2020") == ("other", None)
    assert header_role("CCA3") == header_role(" iso3 ") == ("code", None)
    assert snapshot_columns(["CCA3", "2022 Population", "1980 Population"], [1980, 2022]) == {
        1980: "1980 Population", 2022: "2022 Population"}
    with pytest.raises(ValueError, match="two columns"):
        snapshot_columns(["2020 Population", "Pop 2020"], [2020])
    with pytest.raises(ValueError, match="key columns"):
        key_column(["a", "b"])
