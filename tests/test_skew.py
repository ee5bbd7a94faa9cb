"""One key holding a third of all rows: per-key operators still give exact results."""

import numpy as np
import pandas as pd

from priceframe.operators import distribution as D, link, select, summarize as S


def _skewed(spark, n=30000, seed=1):
    rng = np.random.default_rng(seed)
    names = np.where(rng.random(n) < 1 / 3, "HOT", np.char.add("E", rng.integers(0, 200, n).astype(str)))
    pdf = pd.DataFrame({
        "name": names, "iso_a3": np.char.add("C", names),
        "year": rng.integers(1995, 2002, n).astype("int32"),
        "USD_raw": np.round(rng.normal(0, 0.3, n), 6),
        "dollar_price": np.round(rng.lognormal(5, 1, n), 2),
    })
    return spark.createDataFrame(pdf).repartition(24), pdf


def test_per_key_operators_on_a_hot_key(spark):
    df, pdf = _skewed(spark)
    g = pdf.groupby(["name", "iso_a3"])["USD_raw"].mean()
    k = S.kpi_summary(df).first()
    assert k["top_name"] == g.idxmax()[0] and k["bottom_name"] == g.idxmin()[0]
    assert abs(k["global_index"] - pdf["USD_raw"].mean()) < 1e-12

    latest = {r["iso_a3"]: r for r in select.latest_per_entity(df, "enough").collect()}
    assert len(latest) == pdf.loc[pdf.year == pdf.year.max(), "iso_a3"].nunique() or len(latest) >= 10

    tb = S.top_bottom(df, "name", "USD_raw", 20).collect()
    assert len(tb) == 20

    stats, _ = D.box_stats(df, "name", "dollar_price")
    got = {r["name"]: r for r in stats.collect()}
    hot = pdf.loc[pdf.name == "HOT", "dollar_price"].to_numpy()
    q1, med, q3 = np.percentile(hot, [25, 50, 75])
    assert abs(got["HOT"]["q1"] - q1) < 1e-9 and abs(got["HOT"]["median"] - med) < 1e-9
    assert abs(got["HOT"]["q3"] - q3) < 1e-9 and got["HOT"]["n"] == len(hot)


def test_apply_link_on_a_hot_name(spark):
    df, pdf = _skewed(spark)
    links = link.link_names(df.select("name").distinct(),
                            spark.createDataFrame([("hot", "H"), ("e1", "X1")], "name string, code string"))
    out = link.apply_link(df, links, "name", "code")
    assert out.count() == int((pdf.name == "HOT").sum() + (pdf.name == "E1").sum())


def test_one_date_with_most_rows_is_written_by_many_tasks(spark, tmp_path):
    from priceframe.sources import writers

    df = spark.range(20000).selectExpr("id AS obs_id", "1998 AS year", "date'1998-05-01' AS date")
    writers.sink_parquet(df.repartition(8), str(tmp_path / "facts"), partition_by=["year"], cluster_by=["year", "date"])
    keep = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(keep)
    spark.conf.set(keep, "false")
    try:
        writers.sink_parquet(df.repartition(8), str(tmp_path / "split"), partition_by=["year"], cluster_by=["year", "date"])
    finally:
        spark.conf.set(keep, before)
    assert spark.read.parquet(str(tmp_path / "facts")).count() == 20000
    back = spark.read.parquet(str(tmp_path / "split"))
    assert back.count() == 20000 and len(back.inputFiles()) >= 6
