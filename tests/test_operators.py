"""Operators on hand-made frames: cleaning, reshape, enrichment, summaries, selections."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from priceframe.operators import clean, distribution as D, enrich, reshape, select, summarize as S


def test_normalize_names_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`dollar price` int, `local-price` int")
    assert clean.normalize_names(df).columns == ["dollar_price", "local_price"]
    bad = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError):
        clean.normalize_names(bad)


def test_cast_numeric_nan_and_junk(spark):
    df = spark.createDataFrame([("1.5", "x"), ("NaN", "2")], "local_price string, other string")
    out = clean.cast_numeric(df, ["local_price", "missing_col"]).collect()
    assert out[0]["local_price"] == 1.5 and out[1]["local_price"] is None
    assert out[0]["other"] == "x"


def test_drop_incomplete_drops_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (float("nan"), 1.0, 1.0), (1.0, None, 1.0)],
                               "local_price double, dollar_price double, dollar_ex double")
    assert clean.drop_incomplete(df).count() == 1


def test_parse_date_year_from_text(spark):
    df = spark.createDataFrame([("2001-07-01",), ("junk",)], "date string")
    out = clean.parse_date_year(df).collect()
    assert out[0]["year"] == 2001 and out[1]["year"] is None


def test_exclude_values_keeps_null(spark):
    df = spark.createDataFrame([("UAE",), ("Chile",), (None,)], "name string")
    assert clean.exclude_values(df, "name", ["UAE", "Britain"]).count() == 2


def test_map_with_default(spark):
    df = spark.createDataFrame([("ARG",), ("ZZZ",), (None,)], "code string")
    m = spark.createDataFrame([("ARG", "South America")], "k string, v string")
    out = {r["code"]: r["region"] for r in clean.map_with_default(df, "code", m, "k", "v", "region", "Other").collect()}
    assert out == {"ARG": "South America", "ZZZ": "Other", None: "Other"}


def test_unpivot_pivot_roundtrip(spark):
    wide = spark.createDataFrame([("A", "1,000.5", "", "0"), ("B", "7", "2,500", None)],
                                 "Country string, `1999` string, `2000` string, `2001` string")
    long = reshape.unpivot_years(wide, "Country", None, "gdp")
    got = sorted((r[0], r[1], r[2]) for r in long.collect())
    assert got == [("A", 1999, 1000.5), ("A", 2001, 0.0), ("B", 1999, 7.0), ("B", 2000, 2500.0)]
    back = reshape.pivot_years(long, "Country", "year", "gdp", [1999, 2000, 2001])
    again = reshape.unpivot_years(back.select("Country", *[F.col(c).cast("string").alias(c) for c in ["1999", "2000", "2001"]]),
                                  "Country", ["1999", "2000", "2001"], "gdp")
    assert sorted(tuple(r) for r in again.collect()) == got


def test_unpivot_snapshots_skips_non_year_pop_column(spark):
    from priceframe.schemas import snapshot_columns
    cols = ["Rank", "CCA3", "2022 Population", "2020 Population", "World Population Percentage"]
    found = snapshot_columns(cols, [2020, 2022])
    assert found == {2020: "2020 Population", 2022: "2022 Population"}
    df = spark.createDataFrame([(1, " arg ", "45,510,318", "45,036,032", "0.57")], ", ".join(f"`{c}` string" if c != "Rank" else "Rank int" for c in cols))
    long = reshape.unpivot_snapshots(df, "CCA3", found, "population", "cca3").collect()
    assert sorted((r[0], r[1], r[2]) for r in long) == [("ARG", 2020, 45036032.0), ("ARG", 2022, 45510318.0)]


def test_trend_fit_matches_polyfit_and_edge_counts(spark):
    rng = np.random.default_rng(7)
    rows = []
    for k in range(20):
        years = sorted(rng.choice(np.arange(1970, 2023), size=8, replace=False).tolist())
        for y in years:
            rows.append((f"K{k}", int(y), float(1e6 + k * 1e5 + 3e4 * (y - 1990) + rng.normal(0, 1e4))))
    rows += [("ONE", 2000, 500.0), ("DECL", 1990, 100.0), ("DECL", 2000, 10.0)]
    df = spark.createDataFrame(rows, "key string, year int, pop double")
    fit = enrich.trend_fit(df, "key", "year", "pop", center=1998)
    est = {(r[0], r[1]): r[2] for r in enrich.trend_extrapolate(fit, "key", 1999, 2022, 1.0, 1998).collect()}
    for k in range(20):
        pts = [(y, p) for kk, y, p in rows if kk == f"K{k}"]
        coef = np.polyfit([p[0] for p in pts], [p[1] for p in pts], 1)
        for y in (1999, 2010, 2022):
            assert abs(est[(f"K{k}", y)] - max(1.0, np.polyval(coef, y))) <= 1e-6 * abs(est[(f"K{k}", y)])
    assert est[("ONE", 2022)] == 500.0            # one point → constant, not clamped
    assert est[("DECL", 2022)] == 1.0              # steep decline → floored at 1
    assert len([k for k in est if k[0] == "ONE"]) == 24


def test_fill_from_never_changes_non_null_or_rows(spark):
    facts = spark.createDataFrame([("A", 2000, 5.0), ("A", 2001, None), ("B", 2011, None), ("C", 2000, None)],
                                  "code string, year int, GDP_dollar double")
    panel = spark.createDataFrame([("A", 2000, 99.0), ("A", 2001, 7.0), ("C", 2000, 0.0)],
                                  "iso string, year int, per_capita double")
    j = enrich.join_fill(facts, panel, ["code", "year"], ["iso", "year"], "per_capita")
    out = {(r["code"], r["year"]): r["GDP_dollar"] for r in enrich.fill_from(j, "GDP_dollar", "per_capita").collect()}
    assert out == {("A", 2000): 5.0, ("A", 2001): 7.0, ("B", 2011): None, ("C", 2000): None}
    absent = enrich.fill_from(j.drop("GDP_dollar"), "GDP_dollar", "per_capita", zero_is_missing=False)
    assert absent.count() == 4 and "per_capita" not in absent.columns


def test_raw_index(spark):
    df = spark.createDataFrame([("BASE", 2000, 2.0), ("BASE", 2000, 4.0), ("X", 2000, 4.5), ("X", 2001, 1.0)],
                               "name string, year int, price double")
    out = {(r["name"], r["year"], r["price"]): r["idx"] for r in enrich.raw_index(df, "price", "name", "BASE", "year", "idx").collect()}
    assert out[("X", 2000, 4.5)] == 0.5 and out[("X", 2001, 1.0)] is None


def test_kpi_ties_and_null_keys(spark):
    df = spark.createDataFrame([("A", "a", 0.5, 1.0), ("B", "b", 0.5, 3.0), ("C", "c", -0.2, 2.0), (None, "n", 9.0, 2.0)],
                               "name string, iso_a3 string, USD_raw double, dollar_price double")
    k = S.kpi_summary(df).first()
    assert (k["top_name"], k["bottom_name"], k["n_entities"]) == ("A", "C", 3)
    assert abs(k["global_index"] - (0.5 + 0.5 - 0.2 + 9.0) / 4) < 1e-12 and k["top_text"] == "+50.0%"


def test_top_bottom_overlap_when_few_entities(spark):
    df = spark.createDataFrame([("A", 0.1), ("B", -0.2), ("C", 0.3)], "name string, USD_raw double")
    out = S.top_bottom(df, "name", "USD_raw", 20).collect()
    assert len(out) == 6  # every entity is in both halves


def test_latest_per_entity_branches(spark):
    few = [("X", "x", 0.1, 2000), ("X", "x", 0.2, 2001), ("Y", "y", 0.3, 1999)]
    df = spark.createDataFrame(few, "iso_a3 string, name string, USD_raw double, year int")
    got = sorted((r["iso_a3"], r["year"]) for r in select.latest_per_entity(df, "enough").collect())
    assert got == [("X", 2001), ("Y", 1999)]   # < 10 rows in 2001 → latest row per code
    many = [(f"C{i}", f"c{i}", 0.01 * i, 2001) for i in range(10)] + [("Z", "z", 0.5, 1999)]
    df2 = spark.createDataFrame(many, "iso_a3 string, name string, USD_raw double, year int")
    assert select.latest_per_entity(df2, "enough").count() == 10


def test_histogram_edges(spark):
    one = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    h = D.histogram(one, "x", 40).collect()
    assert sum(r["count"] for r in h) == 2 and len(h) == 40
    df = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    h = D.histogram(df, "x", 40).collect()
    assert sum(r["count"] for r in h) == 101 and max(h, key=lambda r: r["bin"])["count"] >= 1


def test_box_stats_matches_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(10, 2, 500), [40.0, -30.0]])
    df = spark.createDataFrame([(int(i % 3), float(v)) for i, v in enumerate(vals)], "g int, v double")
    stats, outliers = D.box_stats(df, "g", "v")
    for r in stats.collect():
        x = np.array([v for i, v in enumerate(vals) if i % 3 == r["g"]])
        q1, med, q3 = np.percentile(x, [25, 50, 75])
        assert abs(r["q1"] - q1) < 1e-9 and abs(r["median"] - med) < 1e-9 and abs(r["q3"] - q3) < 1e-9
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert r["whisker_lo"] == x[x >= lo].min() and r["whisker_hi"] == x[x <= hi].max()
        assert r["n_outliers"] == int(((x < lo) | (x > hi)).sum())
    assert outliers.count() == stats.agg(F.sum("n_outliers")).first()[0]


def test_kde_close_to_exact_gaussian_sum(spark):
    rng = np.random.default_rng(11)
    x = rng.gamma(2.0, 3.0, 3000)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    k = D.kde_curve(df, "v").orderBy("point").collect()
    h = x.std(ddof=1) * len(x) ** (-0.2)
    for r in k[::37]:
        exact = np.exp(-0.5 * ((r["x"] - x) / h) ** 2).sum() / (len(x) * h * np.sqrt(2 * np.pi))
        assert abs(r["density"] - exact) <= 1e-3 * exact + 1e-12


def test_corr_pairwise_vs_listwise(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, None, 2.0), (3.0, 7.0, 3.0), (4.0, 5.0, None)],
                               "a double, b double, c double")
    p = D.pearson(df, "a", "b").first()
    assert p["n"] == 3
    m = {(r[0], r[1]): r[2] for r in D.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(m) == 9 and m[("a", "b")] == m[("b", "a")]
    assert D.corr_matrix(df, ["a"]).count() == 0


def test_sample_and_split_are_partition_independent(spark):
    df = spark.range(0, 20000).withColumnRenamed("id", "k")
    a = set(r[0] for r in D.sample_rows(df, "k", 0.15).collect())
    b = set(r[0] for r in D.sample_rows(df.repartition(7), "k", 0.15).collect())
    assert a == b and 2500 < len(a) < 3500
    tr, te = D.split_train_test(df, "k", 0.8)
    n_tr, n_te = tr.count(), te.count()
    assert n_tr + n_te == 20000 and 15500 < n_tr < 16500


def test_exact_quantiles_narrowing_rounds_hot_group(spark):
    rng = np.random.default_rng(9)
    hot = np.round(rng.lognormal(3, 1.5, 6000), 1)            # one group holds most rows, many ties
    cold = rng.normal(0, 1, 300)
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in cold] + [("one", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["g"]: r for r in D.exact_quantiles(df, "v", probs, "g", buckets=8, small=40).collect()}
    for g, x in (("hot", hot), ("cold", cold), ("one", np.array([5.0]))):
        want = np.percentile(x, [p * 100 for p in probs])
        for i, w in enumerate(want):
            assert abs(got[g][f"q{i}"] - w) <= 1e-9 * max(1.0, abs(w)), (g, probs[i])
        assert got[g]["n"] == len(x)


def test_latest_year_nine_versus_ten_rows(spark):
    def frame(n_latest):
        rows = [(f"C{i}", f"c{i}", 0.1 * i, 2001) for i in range(n_latest)]
        rows += [(f"C{i}", f"c{i}", -0.1, 2000) for i in range(12)]
        return spark.createDataFrame(rows, "iso_a3 string, name string, USD_raw double, year int")
    assert select.latest_per_entity(frame(10), "enough").count() == 10                 # the latest year's rows
    out = select.latest_per_entity(frame(9), "enough").collect()                       # latest row per code
    assert len(out) == 12 and sum(1 for r in out if r["year"] == 2001) == 9
    assert select.latest_per_entity(frame(9), mode="year").count() == 9
    assert select.latest_per_entity(frame(10), mode="per_key").count() == 12


def test_exact_quantiles_with_infinities_and_heavy_tails(spark):
    rng = np.random.default_rng(4)
    tails = 10.0 ** rng.uniform(-300, 300, 400) * rng.choice([-1, 1], 400)
    groups = {"inf": np.concatenate([rng.normal(0, 1, 200), [np.inf] * 30, [-np.inf] * 30]), "tails": tails,
              "zero": np.concatenate([np.zeros(100), [5e-324, -5e-324, 1.0]]), "ends": np.array([-np.inf] * 50 + [np.inf] * 50),
              "top": np.array([1.7976931348623157e308] * 40 + [np.inf] * 21)}
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in x], "g string, v double")
    probs = [0.0, 0.05, 0.3, 0.75, 1.0]
    got = {r["g"]: r for r in D.exact_quantiles(df, "v", probs, "g", buckets=16, small=5).collect()}
    for g, x in groups.items():
        x = np.sort(x)
        for i, p in enumerate(probs):
            r = (len(x) - 1) * p
            lo, hi = x[int(np.floor(r))], x[int(np.ceil(r))]
            want = lo if lo == hi else lo + (r - np.floor(r)) * (hi - lo)
            have = got[g][f"q{i}"]
            assert have == want or abs(have - want) <= 1e-9 * abs(want), (g, p, have, want)


def test_scatter_cells_count_every_point(spark):
    df = spark.createDataFrame([(1999, 1.0, 1.0), (1999, 9.9, 0.5), (2001, -1.0, 25.0), (2001, None, 1.0)],
                               "year int, x double, y double")
    got = {tuple(r) for r in D.scatter_cells(df, 10.0, 10.0, "x", "y").collect()}
    assert got == {("1990s", 0, 0, 2), ("2000s", -1, 2, 1)}


def test_trend_keys_without_points_and_same_year_rows(spark):
    rows = [("NONE", 2000, None), ("SAME", 2000, 10.0), ("SAME", 2000, 20.0)]
    df = spark.createDataFrame(rows, "key string, year int, pop double")
    fit = enrich.trend_fit(df, "key", "year", "pop", 1998)
    est = enrich.trend_extrapolate(fit, "key", 1999, 2001, 1.0, 1998).collect()
    assert {r["key"] for r in est} == {"SAME"} and all(r["estimate"] == 15.0 for r in est)


def test_top_k_ties_broken_by_entity(spark):
    df = spark.createDataFrame([("b", 5.0), ("a", 5.0), ("c", 5.0), ("d", 1.0)], "name string, dollar_price double")
    assert [r["name"] for r in S.top_k_entities(df, k=2).collect()] == ["a", "b"]
    assert [r["name"] for r in S.top_k_entities(df, k=2, ascending=True).collect()] == ["d", "a"]


def test_histogram_single_row_and_max_value_bin(spark):
    one = D.histogram(spark.createDataFrame([(7.0,)], "x double"), "x", 40).collect()
    assert [r["count"] for r in one if r["count"]] == [1] and [r["bin"] for r in one if r["count"]] == [0]
    h = D.histogram(spark.createDataFrame([(0.0,), (10.0,)], "x double"), "x", 4).collect()
    assert {r["bin"]: r["count"] for r in h} == {0: 1, 1: 0, 2: 0, 3: 1}   # x = max lands in the last bin


def test_box_stats_approx_within_rank_error(spark):
    rng = np.random.default_rng(21)
    vals = rng.lognormal(4, 1, 20000)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    approx = D.quartiles(df, "v", approx=True, accuracy=10000).first()
    srt = np.sort(vals)
    for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        rank = np.searchsorted(srt, approx[name])
        assert abs(rank - p * len(vals)) <= len(vals) / 10000 + 2


def test_fallbacks_and_facet_null_label(spark, tmp_path):
    from priceframe.sources import readers

    raw = tmp_path / "raw.csv"
    raw.write_text("name,dollar_price\nA,1.0\n")
    got = readers.scan_multipart(spark, str(tmp_path / "missing-snapshot"), str(raw))
    assert [r["name"] for r in got.collect()] == ["A"]
    parts = tmp_path / "snap"
    spark.createDataFrame([("P", 2.0), ("Q", 3.0)], "name string, dollar_price double").repartition(2) \
        .write.option("header", True).csv(str(parts))
    assert readers.scan_multipart(spark, str(parts), str(raw)).count() == 2

    df = spark.createDataFrame([("USD", 1.0), ("EUR", 2.0)], "currency_code string, dollar_price double")
    out = select.filter_equals_fallback(df, [("iso_a3", "USA"), ("currency_code", "USD")]).collect()
    assert [r["dollar_price"] for r in out] == [1.0]

    f = spark.createDataFrame([(2000, "Asia", "Low (< $5k)"), (2000, "Asia", None), (2003, "Asia", None)],
                              "year int, region string, gdp_level string")
    assert select.facet_filter(f, (2000, 2001), ["Asia"], ["Low (< $5k)"], date_col=None).count() == 1
    assert select.facet_filter(f, (2000, 2001), ["Asia"], ["No data"], date_col=None).count() == 1
    assert select.facet_filter(f, (2000, 2003), ["Asia"], ["Low (< $5k)", "No data"], date_col=None).count() == 3
