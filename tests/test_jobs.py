"""The batch jobs on hand-made input files of the reference's three kinds."""

import os
import tempfile

from pyspark.sql import functions as F

from priceframe.plans import batch

FACTS = """date,iso_a3,currency_code,name,local price,dollar_ex,dollar_price,USD_raw,GDP_dollar,adj_price
2000-04-01,ARG,ARS,Argentina,2.5,1.0,2.5,-0.1,,2.4
2000-10-01,ARG,ARS,Argentina,2.6,1.0,2.6,-0.05,,2.5
2001-04-01,ARG,ARS,Argentina,2.7,1.0,2.7,0.0,8000.5,2.6
2000-04-01,KOR,KRW,South Korea,3000,1100,2.72,-0.02,,2.7
2000-04-01,VNM,VND,Vietnam,,15000,1.5,-0.4,,1.4
2001-04-01,VNM,VND,Vietnam,30000,15000,2.0,-0.3,,1.9
2011-04-01,ARG,ARS,Argentina,3.0,1.0,3.0,0.1,,2.9
2000-04-01,USA,USD,United States,2.9,1.0,2.9,0.0,,2.9
2000-04-01,CHL,CLP,Chile,1000,500,2.0,-0.2,,1.8
"""
GDP = '''Country,1999,2000,2001,2010,2012
Argentina,"283,523.0","284,204.0","268,697.0",0,0
Korea,1.0,"561,633.0",1.0,1.0,1.0
Viet Nam,30.0,31.2,32.7,1.0,1.0
United Statees,"9,600,000","10,250,000","10,580,000",1.0,1.0
Chile,0,0,0,0,0
'''
POP = '''Rank,CCA3,Country/Territory,2022 Population,2020 Population,2000 Population,World Population Percentage
1,ARG,Argentina,"45,510,318","45,036,032","37,070,774",0.57
2,KOR,South Korea,"51,815,810","51,844,690","46,788,591",0.65
3,VNM,Vietnam,"98,186,856","96,648,685","79,001,142",1.23
4,USA,United States,"338,289,857","335,942,003","282,398,554",4.24
5,CHL,Chile,"19,603,733","19,300,315","15,351,799",0.25
'''


def _write(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_enrich_profile_model_dashboard(spark):
    d = tempfile.mkdtemp(prefix="pf-jobs-")
    facts_p, gdp_p, pop_p = _write(d, "facts.csv", FACTS), _write(d, "gdp.csv", GDP), _write(d, "pop.csv", POP)
    out = os.path.join(d, "out")
    enriched, links = batch.enrich_job(spark, facts_p, gdp_p, pop_p, out)
    tiers = {r["name"]: (r["code"], r["tier"]) for r in links.collect()}
    assert tiers["Argentina"] == ("ARG", "exact")
    assert tiers["Korea"] == ("KOR", "alias") and tiers["Viet Nam"] == ("VNM", "alias")
    assert tiers["United Statees"] == ("USA", "fuzzy")
    rows = {(r["iso_a3"], str(r["date"])): r["GDP_dollar"] for r in enriched.collect()}
    assert len(rows) == 8                                   # the Vietnam row without local price is dropped
    pop = batch.population_estimate(spark, pop_p).filter("cca3 = 'ARG' AND year = 2000").first()["population_est"]
    assert abs(rows[("ARG", "2000-04-01")] - 284204.0 * 1e9 / pop) < 1e-6 * rows[("ARG", "2000-04-01")]
    assert rows[("ARG", "2001-04-01")] == 8000.5            # existing value kept
    assert rows[("ARG", "2011-04-01")] is None              # no GDP column for the gap year
    assert rows[("CHL", "2000-04-01")] is None              # zero GDP is missing, not an income of 0
    assert os.path.isdir(os.path.join(out, "enriched_snapshot.csv"))

    prof = batch.profile_job(enriched)
    assert prof["overview"].first()["n_rows"] == 8
    assert {r["column"] for r in prof["null_counts"].collect()} >= {"GDP_dollar"}

    m = batch.model_job(enriched.withColumn("k", F.monotonically_increasing_id()), "k", out, ratio=0.7)
    rec = m["metrics"].collect()
    assert len(rec) <= 1

    dash = batch.dashboard_job(enriched, years=(2000, 2001), regions=["South America", "Asia", "Other"],
                               bins=["No data", "Medium ($5k-$20k)"], selected=["Argentina"])
    k = dash["kpis"].first()
    # only Argentina 2001 (medium income) and Chile (no income) pass the facets
    assert (k["top_name"], k["bottom_name"], k["n_entities"]) == ("Argentina", "Chile", 2)
    assert k["top_text"] == "+0.0%" and k["bottom_text"] == "-20.0%"
    assert dash["timeline"].count() == 1
    regions = {r["value"] for r in dash["options"].filter("facet = 'region'").collect()}
    assert regions == {"South America", "Asia", "North America"}


def test_stream_matches_batch_over_several_triggers(spark):
    import uuid

    from priceframe.plans import bindings as B, jobs as J
    from priceframe.session import scratch_path
    from priceframe.streaming import enrich_stream
    from conftest import SF_SMALL

    raw = B.raw_snapshot(spark, SF_SMALL)
    src = J.write_wide(raw.repartition(4), "stream-test-src")
    out = scratch_path(spark, f"stream-test-out-{uuid.uuid4().hex}")
    panel = J.per_capita_panel(spark, SF_SMALL)
    q = enrich_stream(spark, src, panel, out, raw.schema, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.lastProgress is not None
    cols = ["obs_id", "GDP_dollar", "year"]
    streamed = sorted(tuple(r) for r in spark.read.parquet(out).select(*cols).collect())
    batch = sorted(tuple(r) for r in J.enrich_facts(spark, SF_SMALL).select(*cols).collect())
    assert streamed == batch


def test_scan_facts_keeps_corrupt_lines(spark):
    from pyspark.sql import types as T

    from priceframe.sources import readers

    d = tempfile.mkdtemp(prefix="pf-corrupt-")
    p = _write(d, "f.csv", "name,dollar_price\nA,1.5\nB,not-a-number\n")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("dollar_price", T.DoubleType())])
    rows = {r["name"]: r for r in readers.scan_facts(spark, p, schema, corrupt_column="_corrupt").collect()}
    assert rows["A"]["_corrupt"] is None and rows["B"]["dollar_price"] is None
    assert rows["B"]["_corrupt"] == "B,not-a-number"


def test_release_scratch_removes_intermediates(spark):
    from priceframe.session import scratch_path, release_scratch

    p = scratch_path(spark, "release-test")
    spark.range(3).write.mode("overwrite").parquet(p)
    assert os.path.isdir(p) or p.startswith("hdfs")
    assert release_scratch(spark) >= 1
    assert not os.path.exists(p)


def test_years_outside_the_usual_span_are_filled(spark):
    """Facts of 1995: their population is extrapolated too, so their income is not left out."""
    d = tempfile.mkdtemp(prefix="pf-jobs-")
    facts = FACTS + "1995-04-01,ARG,ARS,Argentina,1.9,1.0,1.9,0.0,,1.8\n"
    gdp = GDP.replace("Country,1999", "Country,1995,1999").replace("Argentina,", 'Argentina,"258,000.0",')
    for line in ("Korea,", "Viet Nam,", "United Statees,", "Chile,"):
        gdp = gdp.replace(line, line + "1.0,")
    paths = _write(d, "facts.csv", facts), _write(d, "gdp.csv", gdp), _write(d, "pop.csv", POP)
    enriched, _ = batch.enrich_job(spark, *paths)
    pop = batch.population_estimate(spark, paths[2], 1995, 1995).filter("cca3 = 'ARG'").first()["population_est"]
    got = enriched.filter("year = 1995").first()["GDP_dollar"]
    assert abs(got - 258000.0 * 1e9 / pop) < 1e-6 * got
