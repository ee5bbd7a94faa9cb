"""Facet cube, stored quantile sketches, observed writes, quarantined lines and fixed-size samples."""

import random

import pytest
from pyspark.sql import functions as F

from priceframe.functions import columns as C
from priceframe.operators import clean, cube, distribution as D, select, sketches, summarize as S
from priceframe.operators._util import materialize, positions
from priceframe.sources import readers, writers

FACTS = "year int, region string, gdp_level string, iso_a3 string, name string, USD_raw double, dollar_price double"


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(3000):
        n = rng.choice([0] * 6 + list(range(12)))  # one entity has a third of the rows
        rows.append((rng.choice([1999, 2000, 2001, None]), rng.choice(["A", "B", "C", None]), rng.choice(["low", "high", "none"]),
                     None if n == 11 else f"c{n}", None if n == 10 else f"n{n}",
                     rng.choice([None, rng.randrange(-900, 900) / 1000]), rng.randrange(100, 9000) / 100))
    return materialize(spark.createDataFrame(rows, FACTS), "facts")


def near(a, b):
    a, b = ([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in x.collect()] for x in (a, b))
    assert sorted(a, key=str) == sorted(b, key=str) and a


CHOICES = [{}, {"years": (2000, 2001)}, {"regions": ["A", "C"], "bins": ["low"]}]


@pytest.mark.parametrize("choice", CHOICES)
def test_cube_answers_any_facet_choice(spark, facts, choice):
    written = materialize(cube.facet_cube(facts), "cube")
    assert written.count() < facts.count()
    rows = cube.cube_rows(written, **choice)
    chosen = select.facet_filter(facts, **choice, date_col=None)
    near(cube.cube_kpis(rows), S.kpi_summary(chosen))
    near(cube.cube_map(rows), S.map_frame(chosen))
    near(cube.cube_top_bottom(rows, n=6), S.top_bottom(chosen, n=6))
    near(cube.cube_options(rows), select.facet_options(chosen))
    assert rows.agg(F.sum("n")).first()[0] == chosen.count()


def test_cube_of_nothing(spark):
    none = cube.facet_cube(spark.createDataFrame([], FACTS))
    assert cube.cube_map(none).count() == 0 and cube.cube_top_bottom(none).count() == 0 and cube.cube_options(none).count() == 0
    assert cube.cube_kpis(none).first()["n_entities"] == 0


def test_positions_without_a_group(spark):
    df = materialize(spark.createDataFrame([(i * 7919 % 1000,) for i in range(1000)], "v long"), "v")
    assert {r["v"]: r["pos"] for r in positions(df, [], ["v"]).collect()} == {i: i for i in range(1000)}


@pytest.mark.parametrize("k, worst", [(200, 0.0266), (1024, 0.006)])
def test_sketch_rank_error(spark, k, worst):
    """Merged over 12 parts a group, the rank of an answer is off by no more than the sketch's normal error, twice."""
    rng = random.Random(9)
    rows = [(g, p, rng.lognormvariate(0, 2) + (5 if p % 3 else 0)) for g in ("a", "b") for p in range(12) for _ in range(1500)]
    df = materialize(spark.createDataFrame(rows + [("a", 0, None), ("b", 1, float("nan"))], "g string, p int, v double"), "v")
    states = materialize(sketches.quantile_sketches(df, ["g", "p"], "v", k), "sketches")
    assert states.count() == 24
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = {r["g"]: r for r in sketches.sketch_quantiles(states, probs, "g").collect()}
    exact = {r["g"]: r for r in D.exact_quantiles(df, "v", probs, "g").collect()}
    for g in ("a", "b"):
        values = sorted(v for h, _, v in rows if h == g)
        assert got[g]["n"] == exact[g]["n"] == len(values)
        for i, p in enumerate(probs):
            rank = sum(v <= got[g][f"q{i}"] for v in values) / len(values)
            assert abs(rank - p) <= worst, (g, p, rank)
    whole = sketches.sketch_quantiles(states, [0.5]).first()
    assert abs(sum(v <= whole["q0"] for _, _, v in rows) / len(rows) - 0.5) <= worst


def test_sketches_serve_box_violin_and_median(spark):
    rows = [(1990 + i % 20, float(i % 997)) for i in range(6000)]
    df = materialize(spark.createDataFrame(rows, "year int, v double"), "v")
    states = materialize(sketches.quantile_sketches(df, ["year"], "v", 4096), "sketches")
    stats, _ = D.box_stats(df, "year", "v", sketches=states)
    exact, _ = D.box_stats(df, "year", "v")
    want = {r["year"]: r for r in exact.collect()}
    for r in stats.collect():
        assert r["n"] == want[r["year"]]["n"] and abs(r["median"] - want[r["year"]]["median"]) < 25
    _, quart = D.violin_stats(df, "year", "v", sketches=states)
    assert {r["decade"]: r["n"] for r in quart.collect()} == {"1990s": 3000, "2000s": 3000}
    holes = spark.createDataFrame([(None,), (1.0,)], "v double")
    filled = [r["v"] for r in clean.fill_median(holes, "v", sketches=states).collect()]
    assert abs(filled[0] - 498) < 20 and filled[1] == 1.0
    none = sketches.quantile_sketches(spark.createDataFrame([], "year int, v double"), ["year"], "v")
    assert [r["v"] for r in clean.fill_median(holes, "v", sketches=none).collect()] == [None, 1.0]


def test_a_write_is_observed(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 10 > 0, F.col("id")).alias("GDP_dollar"))
    seen = writers.sink_parquet(df, str(tmp_path / "a"), partition_by=["k"], cluster_by=["k"], observe=S.snapshot_measures())
    assert seen == S.snapshot_stats(spark.read.parquet(str(tmp_path / "a"))).first().asDict()
    assert writers.sink_parquet(df, str(tmp_path / "b")) == {}


def test_bad_lines_are_quarantined(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good, bad = ["1,2.5", "2,", "3,4"], ["x,1.0", "4,5,6", "5,five"]
    for i, part in enumerate(([*good[:2], bad[0]], [good[2], *bad[1:]], [])):
        (tmp_path / "in" / f"{i}.csv").write_text("\n".join(["id,v", *part]) + "\n")
    schema = spark.createDataFrame([], "id long, v double").schema
    rows, lines, counts = readers.scan_split(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"))
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, 2.5), (2, None), (3, 4.0)] and rows.columns == ["id", "v"]
    assert sorted(r["line"] for r in lines.collect()) == sorted(bad)
    assert counts == {"accepted": 3, "rejected": 3}
    # Without a bad line the quarantine is empty.
    rows, lines, counts = readers.scan_split(spark, str(tmp_path / "in" / "2.csv"), schema, str(tmp_path / "none"))
    assert rows.count() == lines.count() == 0 and counts == {"accepted": 0, "rejected": 0}


def test_fixed_samples_nest_and_do_not_depend_on_partitions(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"))
    take = lambda d, n: [r["k"] for r in D.sample_fixed(d, "k", n, dropna=["v"]).collect()]
    a = take(df, 400)
    assert len(set(a)) == 400 and all(k % 5 for k in a) and a == take(df.repartition(13), 400)
    assert take(df, 150) == a[:150] and len(take(df, 10000)) == 4000
    assert "TakeOrderedAndProject" in D.sample_fixed(df, "k", 9)._jdf.queryExecution().executedPlan().toString()


def test_two_labels_for_a_code_raise(spark):
    df = spark.createDataFrame([("a",), (None,)], "code string")
    twice = spark.createDataFrame([("a", "x"), ("a", "x"), (None, "z")], "k string, v string")
    got = clean.map_with_default(df, "code", twice, "k", "v", "out", "other").collect()
    assert sorted(r["out"] for r in got) == ["other", "x"]
    clash = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, v string")
    with pytest.raises(Exception, match="two labels for the code a"):
        clean.map_with_default(df, "code", clash, "k", "v", "out", "other").collect()


def test_percent_ties_go_to_the_even_digit(spark):
    df = spark.createDataFrame([(0.0025,), (0.0075,), (-0.0025,), (-0.00001,), (0.00125,)], "x double")
    got = [tuple(r) for r in df.select(C.pct_round("x", 1), C.pct_round("x", 1, half_even=False), C.fmt_pct("x")).collect()]
    assert got[0] == (0.2, 0.3, "+0.2%") and got[1] == (0.8, 0.8, "+0.8%") and got[2] == (-0.2, -0.3, "-0.2%")
    assert got[3][2] == "+0.0%" and got[4][0] == 0.1


def test_buckets_beyond_an_int(spark):
    df = spark.createDataFrame([(1e15,), (1e15 + 0.5,), (-1e15,)], "dollar_price double")
    assert [tuple(r) for r in S.bucket_counts(df).collect()] == [(-10 ** 15, 1), (10 ** 15, 2)]
