"""Registered queries: one per operator id, each with its DuckDB oracle SQL where SQL can say it.

Every query reads the driver's tables under ``sf_dir`` (or data Spark derives
from them).  Output values are normalised for cross-engine comparison: dates
as ISO text, doubles rounded to about ten significant digits.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..operators import bitmaps, clean, cube, distribution as D, enrich, link, model, select, summarize as S
from ..schemas import CORR_COLS, DESCRIBE_COLS, MODEL_FEATURES, MODEL_REG_PARAM, PREVIEW_COLS
from ..sources import readers, writers
from . import bindings as B
from . import jobs as J

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Offset (in units of the last kept digit) added before rounding check outputs.
# Averages of cent amounts are rationals that often sit exactly on a .5 tie,
# where summation-order noise would decide the direction differently per
# engine; shifted by this odd constant, no such rational is near a tie.
TIE_SHIFT = 0.01234567


def qround(c, d: int):
    """Check-output rounding: ``round(c + TIE_SHIFT·10^-d, d)`` as both engines compute it."""
    return C.round_scaled(c + F.lit(TIE_SHIFT / 10 ** d), d)


def norm(df: DataFrame, digits: dict[str, int] | None = None, default: int = 6) -> DataFrame:
    """Dates → 'YYYY-MM-DD', doubles rounded (per-column digits), other types unchanged."""
    digits = digits or {}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            out.append(F.date_format(c, "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(qround(c, digits.get(f.name, default)).alias(f.name))
        else:
            out.append(c.alias(f.name))
    return df.select(*out)


def W(body: str) -> str:
    return B.with_facts(body)


# Price-scale values (~1e5) keep 2 decimals, per-row products 4, ratios 6.
PRICE = {c: 2 for c in ("dollar_price", "avg_price", "min_price", "max_price", "adj_price", "GDP_dollar",
                        "local_price", "mean", "min", "max", "whisker_lo", "whisker_hi")}
FACT_DIGITS = {"dollar_price": 2, "local_price": 4, "dollar_ex": 6, "GDP_dollar": 2, "adj_price": 4,
               "USD_raw": 9}
FACT_COLS = ["obs_id", "date", "year", "iso_a3", "name", "currency_code", "local_price", "dollar_ex",
             "dollar_price", "GDP_dollar", "adj_price", "USD_raw"]
FACT_SQL_COLS = ("obs_id, strftime(date, '%Y-%m-%d') AS date, year, iso_a3, name, currency_code, "
                 "round(local_price, 4) AS local_price, round(dollar_ex, 6) AS dollar_ex, "
                 "round(dollar_price, 2) AS dollar_price, round(GDP_dollar, 2) AS GDP_dollar, "
                 "round(adj_price, 4) AS adj_price, round(USD_raw, 9) AS USD_raw")


# ============================================================ sources / cleaning
@query("yearly_stats", W("""
SELECT year, round(avg(dollar_price), 2) AS avg_price, round(min(dollar_price), 2) AS min_price,
       round(max(dollar_price), 2) AS max_price, count(*) AS n_obs
FROM facts GROUP BY year"""))
def q_yearly_stats(spark, sf):
    return norm(S.yearly_stats(B.facts_snapshot(spark, sf)), PRICE)


@query("clean_facts", W(f"SELECT {FACT_SQL_COLS} FROM facts"))
def q_clean_facts(spark, sf):
    return norm(B.facts(spark, sf).select(*FACT_COLS), FACT_DIGITS)


@query("scan_facts", W(f"SELECT {FACT_SQL_COLS} FROM facts"))
def q_scan_facts(spark, sf):
    """Raw facts written as CSV with spaced headers, scanned with a declared schema, cleaned."""
    raw = B.raw_facts(spark, sf).withColumnRenamed("dollar_price", "dollar price")
    path = J.write_wide(raw, "facts-csv")
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in ("date",) else f.dataType)
                           for f in raw.schema.fields])
    df = clean.clean_facts(readers.scan_facts(spark, path, schema))
    return norm(df.select(*FACT_COLS), FACT_DIGITS)


@query("drop_incomplete", W("SELECT count(*) AS n_rows, count(GDP_dollar) AS n_gdp FROM facts"))
def q_drop_incomplete(spark, sf):
    df = clean.drop_incomplete(clean.cast_numeric(B.raw_facts(spark, sf)))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count("GDP_dollar").alias("n_gdp"))


@query("parse_thousands", """
WITH t AS (
  SELECT n.n_name AS country_name, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) / 100.0 AS gdp
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2)
SELECT country_name, year, round(gdp, 2) AS gdp FROM t""")
def q_parse_thousands(spark, sf):
    return norm(J.gdp_long(spark, sf), {"gdp": 2})


QUERIES["unpivot_years"] = q_parse_thousands
ORACLE["unpivot_years"] = ORACLE["parse_thousands"]
QUERIES["scan_wide_years"] = q_parse_thousands
ORACLE["scan_wide_years"] = ORACLE["parse_thousands"]

POP_SNAP_SQL = """
snaps AS (
  SELECT CAST(n.n_nationkey AS VARCHAR) AS cca3, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(count(*) AS DOUBLE) AS population
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE year(o.o_orderdate) IN (1995, 1996, 1998, 2001)
  GROUP BY 1, 2)"""

TREND_SQL = POP_SNAP_SQL + """,
fit AS (
  SELECT cca3, regr_slope(population, year - 1998) AS slope, regr_intercept(population, year - 1998) AS intercept,
         avg(population) AS y_mean, count(*) AS n
  FROM snaps GROUP BY cca3),
est AS (
  SELECT cca3, CAST(y AS INTEGER) AS year,
         CASE WHEN slope IS NULL THEN y_mean ELSE greatest(intercept + slope * (y - 1998), 1.0) END AS population_est
  FROM fit, (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1)) AS y FROM orders) t)"""


@query("unpivot_snapshots", "WITH " + POP_SNAP_SQL + " SELECT cca3, year, population FROM snaps")
def q_unpivot_snapshots(spark, sf):
    return norm(J.pop_snapshots(spark, sf))


QUERIES["scan_wide_snapshots"] = q_unpivot_snapshots
ORACLE["scan_wide_snapshots"] = ORACLE["unpivot_snapshots"]


@query("trend_fit", "WITH " + TREND_SQL + """
SELECT cca3, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(y_mean, 6) AS y_mean, n FROM fit""")
def q_trend_fit(spark, sf):
    fit = enrich.trend_fit(J.pop_snapshots(spark, sf), "cca3", "year", "population", J.TREND_CENTER)
    return norm(fit)


@query("trend_extrapolate", "WITH " + TREND_SQL + " SELECT cca3, year, round(population_est, 6) AS population_est FROM est")
def q_trend_extrapolate(spark, sf):
    return norm(J.pop_estimate(spark, sf))


QUERIES["year_grid"] = q_trend_extrapolate
ORACLE["year_grid"] = ORACLE["trend_extrapolate"]

PANEL_SQL = TREND_SQL + """,
gdp AS (
  SELECT n.n_name AS country_name, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) / 100.0 AS gdp
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2),
dict AS (SELECT lower(trim(name)) AS key, min(iso_a3) AS code FROM facts GROUP BY 1),
gdp_iso AS (SELECT g.*, d.code AS iso FROM gdp g JOIN dict d ON lower(trim(g.country_name)) = d.key),
panel AS (
  SELECT g.iso, g.year, min(CASE WHEN e.population_est > 0 THEN g.gdp * 1.0 / e.population_est END) AS per_capita
  FROM gdp_iso g JOIN est e ON g.iso = e.cca3 AND g.year = e.year
  WHERE e.population_est > 0
  GROUP BY 1, 2)"""


@query("join_panel", W(", " + PANEL_SQL + " SELECT iso, year, round(per_capita, 3) AS per_capita FROM panel"))
def q_join_panel(spark, sf):
    return norm(J.per_capita_panel(spark, sf), {"per_capita": 3})


QUERIES["guarded_ratio"] = q_join_panel
ORACLE["guarded_ratio"] = ORACLE["join_panel"]

ENRICHED_SQL = PANEL_SQL + """,
enriched AS (
  SELECT f.* REPLACE (coalesce(f.GDP_dollar, CASE WHEN p.per_capita <> 0 THEN p.per_capita END) AS GDP_dollar)
  FROM facts f LEFT JOIN panel p ON f.iso_a3 = p.iso AND f.year = p.year)"""


@query("join_fill", W(", " + ENRICHED_SQL + f" SELECT {FACT_SQL_COLS} FROM enriched"))
def q_join_fill(spark, sf):
    return norm(J.enrich_facts(spark, sf).select(*FACT_COLS), FACT_DIGITS)


@query("join_fill_bucketed", ORACLE["join_fill"])
def q_join_fill_bucketed(spark, sf):
    return norm(J.enrich_bucketed(spark, sf).select(*FACT_COLS), FACT_DIGITS)


QUERIES["fill_from"] = q_join_fill
ORACLE["fill_from"] = ORACLE["join_fill"]


@query("snapshot_stats", W(", " + ENRICHED_SQL + """
SELECT count(GDP_dollar) AS count_non_null, count(*) FILTER (WHERE GDP_dollar IS NULL) AS count_null,
       round(min(GDP_dollar), 2) AS min, round(max(GDP_dollar), 2) AS max, round(avg(GDP_dollar), 2) AS mean
FROM enriched"""))
def q_snapshot_stats(spark, sf):
    return norm(S.snapshot_stats(J.enrich_facts(spark, sf), "GDP_dollar"), PRICE)


@query("snapshot_stats_observed", ORACLE["snapshot_stats"])
def q_snapshot_stats_observed(spark, sf):
    """The same figures, observed while the enriched snapshot is written: no scan after the write."""
    filled = J.enrich_facts(spark, sf)
    seen = J.observed_snapshot(spark, filled, S.snapshot_measures("GDP_dollar"))
    shape = S.snapshot_stats(filled, "GDP_dollar").schema
    return norm(spark.createDataFrame([tuple(seen[c] for c in shape.names)], shape), PRICE)


@query("preview", W("""
SELECT strftime(date, '%Y-%m-%d') AS date, year, name, iso_a3, currency_code, round(local_price, 4) AS local_price,
       round(dollar_price, 2) AS dollar_price, round(GDP_dollar, 2) AS GDP_dollar
FROM facts ORDER BY date, year, name, iso_a3, currency_code, local_price, dollar_price, GDP_dollar LIMIT 10"""))
def q_preview(spark, sf):
    return norm(S.preview(B.facts_snapshot(spark, sf), PREVIEW_COLS, 10), FACT_DIGITS)


@query("sink_parquet", W("SELECT year, count(*) AS n_rows, round(sum(dollar_price), 2) AS total FROM facts GROUP BY year"))
def q_sink_parquet(spark, sf):
    snap = J.snapshot_roundtrip(spark, sf)
    return norm(snap.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("dollar_price").alias("total")), {"total": 2})


# ============================================================ projections / classes
@query("decade_label", W("""
SELECT CAST(floor(year / 10) * 10 AS INTEGER) || 's' AS decade, count(*) AS n FROM facts GROUP BY 1"""))
def q_decade_label(spark, sf):
    return B.facts_snapshot(spark, sf).groupBy(C.decade_label("year").alias("decade")).agg(F.count(F.lit(1)).alias("n"))


@query("bin_label", W("""
SELECT CASE WHEN GDP_dollar IS NULL OR isnan(GDP_dollar) THEN 'No data'
            WHEN GDP_dollar < 5000.0 THEN 'Low (< $5k)'
            WHEN GDP_dollar >= 5000.0 AND GDP_dollar < 20000.0 THEN 'Medium ($5k-$20k)'
            WHEN GDP_dollar >= 20000.0 THEN 'High (> $20k)' END AS gdp_level, count(*) AS n
FROM facts GROUP BY 1"""))
def q_bin_label(spark, sf):
    d = J.dashboard_frame(spark, sf)
    return d.groupBy("gdp_level").agg(F.count(F.lit(1)).alias("n"))


@query("region_map", W("""
SELECT coalesce(r.r_name, 'Other') AS region, count(*) AS n
FROM facts f LEFT JOIN nation n ON f.iso_a3 = CAST(n.n_nationkey AS VARCHAR)
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE NOT coalesce(f.name IN ('UAE', 'Britain'), false) GROUP BY 1"""))
def q_region_map(spark, sf):
    return J.dashboard_frame(spark, sf).groupBy("region").agg(F.count(F.lit(1)).alias("n"))


@query("map_with_default", W("""
SELECT f.iso_a3, coalesce(r.r_name, 'Unmapped') AS region, count(*) AS n
FROM facts f LEFT JOIN nation n ON f.iso_a3 = CAST(n.n_nationkey AS VARCHAR)
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey AND r.r_name <> 'ASIA' GROUP BY 1, 2"""))
def q_map_with_default(spark, sf):
    """A mapping that lacks the codes of one region: their rows get the default."""
    known = J.region_map(spark, sf).where(F.col("region") != "ASIA")
    d = clean.map_with_default(B.facts_snapshot(spark, sf), "iso_a3", known, "code", "region", "region", "Unmapped")
    return d.groupBy("iso_a3", "region").agg(F.count(F.lit(1)).alias("n"))


@query("exclude_values", W("""
SELECT name, count(*) AS n FROM facts WHERE NOT coalesce(name IN ('NATION_3', 'NATION_7'), false) GROUP BY name"""))
def q_exclude_values(spark, sf):
    d = clean.exclude_values(B.facts_snapshot(spark, sf), "name", ["NATION_3", "NATION_7"])
    return d.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("clamp_min", W("""
SELECT obs_id, round(CASE WHEN GDP_dollar < 5000.0 THEN 5000.0 ELSE GDP_dollar END, 2) AS GDP_dollar
FROM facts WHERE GDP_dollar IS NOT NULL"""))
def q_clamp_min(spark, sf):
    d = B.facts_snapshot(spark, sf).where("GDP_dollar is not null")
    return norm(d.select("obs_id", C.clamp_min("GDP_dollar", 5000.0).alias("GDP_dollar")), PRICE)


@query("cast_numeric", W("""
SELECT obs_id, round(CASE WHEN obs_id % 10 <> 0 THEN dollar_price END, 2) AS dollar_price FROM facts"""))
def q_cast_numeric(spark, sf):
    """Prices as text, one in ten of them no number."""
    text = F.when(F.col("obs_id") % 10 != 0, F.col("dollar_price").cast("string")).otherwise("n/a")
    return norm(clean.cast_numeric(B.facts_snapshot(spark, sf).select("obs_id", text.alias("dollar_price"))), PRICE)


@query("valuation_class", W("""
SELECT obs_id, (0.0 + round_even(USD_raw * 100 * 10, 0) / 10) AS USD_raw_pct,
       CASE WHEN USD_raw >= 0 THEN 'Overvalued' ELSE 'Undervalued' END AS dash_class,
       CASE WHEN USD_raw > 0 THEN 'Overvalued' ELSE 'Undervalued' END AS chart_class,
       round(dollar_price - adj_price, 4) AS residual
FROM facts WHERE USD_raw IS NOT NULL"""))
def q_valuation_class(spark, sf):
    d = B.facts_snapshot(spark, sf).filter(F.col("USD_raw").isNotNull())
    return norm(d.select("obs_id", C.pct_round("USD_raw", 1).alias("USD_raw_pct"),
                         C.valuation_class("USD_raw", True).alias("dash_class"),
                         C.valuation_class("USD_raw", False).alias("chart_class"),
                         C.residual("dollar_price", "adj_price").alias("residual")), {"residual": 4})


QUERIES["pct_round"] = q_valuation_class
ORACLE["pct_round"] = ORACLE["valuation_class"]
QUERIES["residual"] = q_valuation_class
ORACLE["residual"] = ORACLE["valuation_class"]


@query("canonical_key", W("""
SELECT upper(trim('  ' || lower(iso_a3) || ' ')) AS code_key, lower(trim(' ' || upper(name) || '  ')) AS name_key, count(*) AS n
FROM facts GROUP BY 1, 2"""))
def q_canonical_key(spark, sf):
    d = B.facts_snapshot(spark, sf)
    return d.groupBy(C.canonical_key(F.concat(F.lit("  "), F.lower("iso_a3"), F.lit(" ")), "upper").alias("code_key"),
                     C.canonical_key(F.concat(F.lit(" "), F.upper("name"), F.lit("  ")), "lower").alias("name_key")
                     ).agg(F.count(F.lit(1)).alias("n"))


# ============================================================ filters
@query("facet_filter", W("""
, d AS (
  SELECT f.*, coalesce(r.r_name, 'Other') AS region,
         CASE WHEN GDP_dollar IS NULL OR isnan(GDP_dollar) THEN 'No data'
              WHEN GDP_dollar < 5000.0 THEN 'Low (< $5k)'
              WHEN GDP_dollar >= 5000.0 AND GDP_dollar < 20000.0 THEN 'Medium ($5k-$20k)'
              WHEN GDP_dollar >= 20000.0 THEN 'High (> $20k)' END AS gdp_level
  FROM facts f LEFT JOIN nation n ON f.iso_a3 = CAST(n.n_nationkey AS VARCHAR)
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE NOT coalesce(f.name IN ('UAE', 'Britain'), false))
SELECT obs_id, year, region, gdp_level FROM d
WHERE year BETWEEN 1996 AND 1999 AND region IN ('ASIA', 'EUROPE', 'AMERICA')
  AND (gdp_level IN ('Low (< $5k)', 'Medium ($5k-$20k)', 'No data') OR gdp_level IS NULL)"""))
def q_facet_filter(spark, sf):
    return J.dashboard_filtered(spark, sf).select("obs_id", "year", "region", "gdp_level")


DASH_SQL = """
, d AS (
  SELECT f.*, coalesce(r.r_name, 'Other') AS region,
         CASE WHEN GDP_dollar IS NULL OR isnan(GDP_dollar) THEN 'No data'
              WHEN GDP_dollar < 5000.0 THEN 'Low (< $5k)'
              WHEN GDP_dollar >= 5000.0 AND GDP_dollar < 20000.0 THEN 'Medium ($5k-$20k)'
              WHEN GDP_dollar >= 20000.0 THEN 'High (> $20k)' END AS gdp_level
  FROM facts f LEFT JOIN nation n ON f.iso_a3 = CAST(n.n_nationkey AS VARCHAR)
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE NOT coalesce(f.name IN ('UAE', 'Britain'), false))"""


@query("facet_options", W(DASH_SQL + """
SELECT 'year' AS facet, CAST(year AS VARCHAR) AS value, year AS ordinal FROM (SELECT DISTINCT year FROM d)
UNION ALL
SELECT 'region', region, CAST(dense_rank() OVER (ORDER BY region) AS INTEGER) FROM (SELECT DISTINCT region FROM d)
UNION ALL
SELECT 'gdp_level', gdp_level, CASE gdp_level WHEN 'Low (< $5k)' THEN 0 WHEN 'Medium ($5k-$20k)' THEN 1
       WHEN 'High (> $20k)' THEN 2 WHEN 'No data' THEN 3 END FROM (SELECT DISTINCT gdp_level FROM d)"""))
def q_facet_options(spark, sf):
    return select.facet_options(J.dashboard_frame(spark, sf))


@query("filter_equals_fallback", W("""
SELECT year, round(dollar_price, 2) AS dollar_price, strftime(date, '%Y-%m-%d') AS date, obs_id
FROM facts WHERE name = 'NATION_7'"""))
def q_filter_equals_fallback(spark, sf):
    """The first choice names a column the facts lack, so the second decides."""
    d = select.filter_equals_fallback(B.facts_snapshot(spark, sf), [("country", "7"), ("name", "NATION_7")])
    return norm(d.select("year", "dollar_price", "date", "obs_id"), PRICE)


@query("ordered_series", W("""
SELECT year, round(dollar_price, 2) AS dollar_price, strftime(date, '%Y-%m-%d') AS date, obs_id
FROM facts WHERE iso_a3 = '7'"""))
def q_ordered_series(spark, sf):
    d = select.filter_equals_fallback(B.facts_snapshot(spark, sf), [("iso_a3", "7"), ("name", "NATION_7")])
    return norm(select.ordered_series(d, "date", ["year", "dollar_price", "date", "obs_id"], ["obs_id"]), PRICE)


SELECTED_NATIONS = tuple(f"NATION_{i}" for i in range(1, 25) if i % 5)  # 20 of 25: more than any short list


@query("filter_selected", W(f"""
SELECT name, year, round(avg(dollar_price), 2) AS avg_price FROM facts
WHERE name IN {SELECTED_NATIONS} GROUP BY name, year"""))
def q_filter_selected(spark, sf):
    d = select.filter_selected(B.facts_snapshot(spark, sf), "name", SELECTED_NATIONS)
    return norm(S.entity_year_mean(d, "name", "year", "dollar_price"), PRICE)


@query("filter_not_null", W("""
SELECT count(*) AS n FROM raw_facts WHERE GDP_dollar IS NOT NULL AND USD_raw IS NOT NULL AND local_price IS NOT NULL"""))
def q_filter_not_null(spark, sf):
    return select.filter_not_null(B.raw_snapshot(spark, sf), ["GDP_dollar", "USD_raw", "local_price"]).agg(
        F.count(F.lit(1)).alias("n"))


@query("snapshot_at", W("""
SELECT obs_id, year, name, round(GDP_dollar, 2) AS GDP_dollar, round(USD_raw, 9) AS USD_raw
FROM facts WHERE year = (SELECT max(year) FROM facts)"""))
def q_snapshot_at(spark, sf):
    return norm(select.snapshot_at(B.facts_snapshot(spark, sf)).select("obs_id", "year", "name", "GDP_dollar", "USD_raw"),
                FACT_DIGITS)


@query("restrict_to_top", W("""
, top AS (SELECT name FROM facts GROUP BY name ORDER BY count(dollar_price) DESC, name LIMIT 10)
SELECT name, year, round(avg(dollar_price), 2) AS avg_price FROM facts WHERE name IN (SELECT name FROM top)
GROUP BY name, year"""))
def q_restrict_to_top(spark, sf):
    d = B.facts_snapshot(spark, sf)
    sub = S.restrict_to_top(d, J.top_support(d, 10), "name")
    return norm(S.entity_year_mean(sub, "name", "year", "dollar_price"), PRICE)


QUERIES["entity_year_mean"] = q_restrict_to_top
ORACLE["entity_year_mean"] = ORACLE["restrict_to_top"]


# ============================================================ aggregations
@query("mean_by_entity", W("SELECT name, round(avg(dollar_price), 2) AS avg_price FROM facts GROUP BY name"))
def q_mean_by_entity(spark, sf):
    return norm(S.mean_by_entity(B.facts_snapshot(spark, sf)), PRICE)


@query("top_k_entities", W("""
SELECT * FROM (SELECT name, round(avg(dollar_price), 2) AS avg_price, 'high' AS side FROM facts GROUP BY name
               ORDER BY avg(dollar_price) DESC, name LIMIT 10)
UNION ALL
SELECT * FROM (SELECT name, round(avg(dollar_price), 2), 'low' FROM facts GROUP BY name
               ORDER BY avg(dollar_price) ASC, name LIMIT 10)"""))
def q_top_k_entities(spark, sf):
    d = B.facts_snapshot(spark, sf)
    hi = S.top_k_entities(d, k=10).withColumn("side", F.lit("high"))
    lo = S.top_k_entities(d, k=10, ascending=True).withColumn("side", F.lit("low"))
    return norm(hi.unionByName(lo), PRICE)


@query("top_k_chart", W("""
SELECT * FROM (SELECT name, round(avg(dollar_price), 2) AS avg_price, 'high' AS side FROM facts GROUP BY name
               ORDER BY avg(dollar_price) DESC, name LIMIT 15)
UNION ALL
SELECT * FROM (SELECT name, round(avg(dollar_price), 2), 'low' FROM facts GROUP BY name
               ORDER BY avg(dollar_price) ASC, name LIMIT 15)"""))
def q_top_k_chart(spark, sf):
    d = B.facts_snapshot(spark, sf)
    hi = S.top_k_entities(d, k=15).withColumn("side", F.lit("high"))
    lo = S.top_k_entities(d, k=15, ascending=True).withColumn("side", F.lit("low"))
    return norm(hi.unionByName(lo), PRICE)


@query("bucket_counts", W("""
SELECT CAST(floor(dollar_price / 10000.0) AS BIGINT) AS price_bucket, count(*) AS count FROM facts GROUP BY 1"""))
def q_bucket_counts(spark, sf):
    return S.bucket_counts(B.facts_snapshot(spark, sf), "dollar_price", width=10000.0)


@query("index_by_entity", W("""
SELECT name, round(avg(USD_raw), 9) AS avg_usd_raw,
       CASE WHEN avg(USD_raw) > 0 THEN 'Overvalued' ELSE 'Undervalued' END AS valuation
FROM facts GROUP BY name"""))
def q_index_by_entity(spark, sf):
    return norm(S.index_by_entity(B.facts_snapshot(spark, sf)), {"avg_usd_raw": 9})


@query("support_count", W("SELECT name, count(dollar_price) AS cnt, count(*) AS n_rows FROM facts GROUP BY name"))
def q_support_count(spark, sf):
    return S.support_count(B.facts_snapshot(spark, sf), "name", "dollar_price", rows="n_rows")


@query("top_k_support", W("""
SELECT * FROM (SELECT name, count(dollar_price) AS cnt, 10 AS k FROM facts GROUP BY name ORDER BY cnt DESC, name LIMIT 10)
UNION ALL
SELECT * FROM (SELECT name, count(*) AS cnt, 30 AS k FROM facts GROUP BY name ORDER BY cnt DESC, name LIMIT 30)"""))
def q_top_k_support(spark, sf):
    d = B.facts_snapshot(spark, sf)
    a = S.top_k_support(d, "name", 10, "dollar_price").withColumn("k", F.lit(10))
    b = S.top_k_support(d, "name", 30, None).withColumn("k", F.lit(30))
    return a.unionByName(b)


@query("map_frame", W(DASH_SQL + """
, g AS (SELECT year, iso_a3, name, avg(USD_raw) AS USD_raw, avg(dollar_price) AS dollar_price FROM d
        WHERE year IS NOT NULL AND iso_a3 IS NOT NULL AND name IS NOT NULL GROUP BY 1, 2, 3)
SELECT year, iso_a3, name, round(USD_raw, 9) AS USD_raw, round(dollar_price, 2) AS dollar_price,
       (0.0 + round_even(USD_raw * 100 * 10, 0) / 10) AS USD_raw_pct,
       name || '<br>Valuation: ' || CASE WHEN round_even(USD_raw * 100 * 10, 0) >= 0 THEN '+' ELSE '' END
       || printf('%.1f', (0.0 + round_even(USD_raw * 100 * 10, 0) / 10)) || '%<br>Price: $'
       || CAST(CAST(floor(dollar_price + 0.005) AS BIGINT) AS VARCHAR) AS hover
FROM g WHERE USD_raw IS NOT NULL"""))
def q_map_frame(spark, sf):
    return _map_check(S.map_frame(J.dashboard_frame(spark, sf)))


def _map_check(m: DataFrame) -> DataFrame:
    """The label is compared up to the price's dots: cents of a mean can sit on a rounding tie (``hover_text`` has them)."""
    m = m.withColumn("hover", F.regexp_replace("hover", r"\.\d\d$", ""))
    return norm(m, {"USD_raw": 9, "dollar_price": 2, "USD_raw_pct": 1})


@query("kpi_summary", W(DASH_SQL + """
, g AS (SELECT name, iso_a3, avg(USD_raw) AS m, sum(USD_raw) AS si, count(USD_raw) AS ci,
               sum(dollar_price) AS sp, count(dollar_price) AS cp FROM d GROUP BY name, iso_a3),
ok AS (SELECT * FROM g WHERE name IS NOT NULL AND iso_a3 IS NOT NULL AND m IS NOT NULL),
hi AS (SELECT name, iso_a3, m FROM ok ORDER BY m DESC, name, iso_a3 LIMIT 1),
lo AS (SELECT name, iso_a3, m FROM ok ORDER BY m ASC, name, iso_a3 LIMIT 1),
gl AS (SELECT sum(si) / sum(ci) AS gi, sum(sp) / sum(cp) AS ap, count(DISTINCT name) AS ne FROM g)
SELECT hi.name AS top_name, hi.iso_a3 AS top_code, round(hi.m, 9) AS top_index,
       lo.name AS bottom_name, lo.iso_a3 AS bottom_code, round(lo.m, 9) AS bottom_index,
       round(gl.gi, 9) AS global_index, round(gl.ap, 2) AS avg_price, gl.ne AS n_entities,
       CASE WHEN round_even(hi.m * 100 * 10, 0) >= 0 THEN '+' ELSE '' END || printf('%.1f', (0.0 + round_even(hi.m * 100 * 10, 0) / 10)) || '%' AS top_text,
       CASE WHEN round_even(lo.m * 100 * 10, 0) >= 0 THEN '+' ELSE '' END || printf('%.1f', (0.0 + round_even(lo.m * 100 * 10, 0) / 10)) || '%' AS bottom_text,
       CASE WHEN round_even(gl.gi * 100 * 10, 0) >= 0 THEN '+' ELSE '' END || printf('%.1f', (0.0 + round_even(gl.gi * 100 * 10, 0) / 10)) || '%' AS global_text,
       '$' || printf('%.2f', (0.0 + ROUND(gl.ap, 2))) AS price_text
FROM hi, lo, gl"""))
def q_kpi_summary(spark, sf):
    return _kpi_check(S.kpi_summary(J.dashboard_frame(spark, sf)))


def _kpi_check(k: DataFrame) -> DataFrame:
    return norm(k, {"top_index": 9, "bottom_index": 9, "global_index": 9, "avg_price": 2})


@query("describe_numeric", W(" " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), {d}) AS mean, round(stddev_samp({c}), {d}) AS stddev, "
    f"round(min({c}), {d}) AS min, round(max({c}), {d}) AS max FROM facts"
    for c, d in [("local_price", 2), ("dollar_price", 2), ("dollar_ex", 6), ("USD_raw", 9), ("GDP_dollar", 3), ("adj_price", 2)])))
def q_describe_numeric(spark, sf):
    d = S.describe_numeric(B.facts_snapshot(spark, sf), DESCRIBE_COLS)
    digits = {"local_price": 2, "dollar_price": 2, "dollar_ex": 6, "USD_raw": 9, "GDP_dollar": 3, "adj_price": 2}
    r = lambda c: F.coalesce(*[F.when(F.col("column") == k, qround(c, v)) for k, v in digits.items()])
    return d.select("column", "count", r(F.col("mean")).alias("mean"), r(F.col("stddev")).alias("stddev"),
                    r(F.col("min")).alias("min"), r(F.col("max")).alias("max"))


@query("overview", W("""
SELECT count(DISTINCT name) AS n_entities, count(*) FILTER (WHERE name IS NULL) AS n_entity_nulls,
       count(DISTINCT year) AS n_years, min(year) AS year_min, max(year) AS year_max, count(*) AS n_rows FROM facts"""))
def q_overview(spark, sf):
    return S.overview(B.facts_snapshot(spark, sf))


@query("overview_bitmaps", ORACLE["overview"])
def q_overview_bitmaps(spark, sf):
    return bitmaps.overview(B.facts_snapshot(spark, sf))


@query("distinct_users", """
SELECT event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type
UNION ALL SELECT NULL, count(DISTINCT user_id) FROM events""")
def q_distinct_users(spark, sf):
    """Exact distinct users per event type and of all events, both from the bitmaps of (type, day)."""
    b = J.user_bitmaps(spark, sf)
    whole = bitmaps.bitmap_counts(b, [], "n_users").select(F.lit(None).cast("string").alias("event_type"), "n_users")
    return bitmaps.bitmap_counts(b, ["event_type"], "n_users").unionByName(whole)


@query("distinct_parts", """
SELECT l_returnflag, year(l_shipdate) AS year, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY 1, 2
UNION ALL SELECT l_returnflag, NULL, count(DISTINCT l_partkey) FROM lineitem GROUP BY 1""")
def q_distinct_parts(spark, sf):
    """Exact distinct parts per return flag, by year and of all years, from the bitmaps of (flag, status, year)."""
    b = J.part_bitmaps(spark, sf)
    whole = bitmaps.bitmap_counts(b, ["l_returnflag"], "n_parts").withColumn("year", F.lit(None).cast("int"))
    return bitmaps.bitmap_counts(b, ["l_returnflag", "year"], "n_parts").unionByName(whole)


@query("null_counts", W("""
SELECT * FROM (
  SELECT 'local_price' AS "column", count(*) FILTER (WHERE local_price IS NULL) AS n_null FROM raw_facts
  UNION ALL SELECT 'GDP_dollar', count(*) FILTER (WHERE GDP_dollar IS NULL) FROM raw_facts
  UNION ALL SELECT 'adj_price', count(*) FILTER (WHERE adj_price IS NULL) FROM raw_facts
  UNION ALL SELECT 'USD_raw', count(*) FILTER (WHERE USD_raw IS NULL) FROM raw_facts) WHERE n_null > 0"""))
def q_null_counts(spark, sf):
    return S.null_counts(B.raw_snapshot(spark, sf))


# ============================================================ windows / top-k
@query("latest_per_entity", W("""
, lb AS (SELECT iso_a3, name, USD_raw, year FROM facts
           WHERE iso_a3 IS NOT NULL AND name IS NOT NULL AND USD_raw IS NOT NULL AND NOT isnan(USD_raw) AND year IS NOT NULL),
py AS (SELECT year, count(*) AS n FROM lb GROUP BY year),
lt AS (SELECT max(year) AS y, arg_max(n, year) AS n FROM py),
a AS (SELECT b.* FROM lb b, lt WHERE b.year = lt.y AND lt.n >= 10),
r AS (SELECT *, row_number() OVER (PARTITION BY iso_a3 ORDER BY year DESC, name DESC, USD_raw DESC) AS rn FROM lb),
b AS (SELECT iso_a3, name, USD_raw, year FROM r, lt WHERE rn = 1 AND lt.n < 10),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT iso_a3, name, round(USD_raw, 9) AS USD_raw, year, (0.0 + round_even(USD_raw * 100 * 10, 0) / 10) AS USD_raw_pct FROM u"""))
def q_latest_per_entity(spark, sf):
    return norm(select.latest_per_entity(B.facts_snapshot(spark, sf), "enough"), {"USD_raw": 9, "USD_raw_pct": 1})


@query("latest_per_key", W("""
, lb AS (SELECT iso_a3, name, USD_raw, year FROM facts
           WHERE iso_a3 IS NOT NULL AND name IS NOT NULL AND USD_raw IS NOT NULL AND NOT isnan(USD_raw) AND year IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY iso_a3 ORDER BY year DESC, name DESC, USD_raw DESC) AS rn FROM lb)
SELECT iso_a3, name, round(USD_raw, 9) AS USD_raw, year, (0.0 + round_even(USD_raw * 100 * 10, 0) / 10) AS USD_raw_pct FROM r WHERE rn = 1"""))
def q_latest_per_key(spark, sf):
    d = select.latest_per_entity(B.facts_snapshot(spark, sf), mode="per_key")
    return norm(d, {"USD_raw": 9, "USD_raw_pct": 1})


@query("top_bottom", W(DASH_SQL + """
, m AS (SELECT name, avg(USD_raw) AS USD_raw FROM d WHERE name IS NOT NULL GROUP BY name HAVING avg(USD_raw) IS NOT NULL),
lo AS (SELECT *, 'bottom' AS half FROM m ORDER BY USD_raw ASC, name LIMIT 10),
hi AS (SELECT *, 'top' AS half FROM m ORDER BY USD_raw DESC, name LIMIT 10)
SELECT name, round(USD_raw, 9) AS USD_raw, half, CASE WHEN USD_raw >= 0 THEN 'Overvalued' ELSE 'Undervalued' END AS color,
       printf('%.1f', (0.0 + round_even(USD_raw * 100 * 10, 0) / 10)) || '%' AS display
FROM (SELECT * FROM lo UNION ALL SELECT * FROM hi)"""))
def q_top_bottom(spark, sf):
    return norm(S.top_bottom(J.dashboard_frame(spark, sf), "name", "USD_raw", 20), {"USD_raw": 9})


# The same four tables from the facet cube, which is written once: no scan of the facts.
@query("cube_facet_options", ORACLE["facet_options"])
def q_cube_facet_options(spark, sf):
    return cube.cube_options(J.dashboard_cube(spark, sf))


@query("cube_kpi_summary", ORACLE["kpi_summary"])
def q_cube_kpi_summary(spark, sf):
    return _kpi_check(cube.cube_kpis(J.dashboard_cube(spark, sf)))


@query("cube_map_frame", ORACLE["map_frame"])
def q_cube_map_frame(spark, sf):
    return _map_check(cube.cube_map(J.dashboard_cube(spark, sf)))


@query("cube_top_bottom", ORACLE["top_bottom"])
def q_cube_top_bottom(spark, sf):
    return norm(cube.cube_top_bottom(J.dashboard_cube(spark, sf)), {"USD_raw": 9})


FACET_SQL = """
  WHERE year BETWEEN 1996 AND 1999 AND region IN ('ASIA', 'EUROPE', 'AMERICA')
  AND (gdp_level IN ('Low (< $5k)', 'Medium ($5k-$20k)', 'No data') OR gdp_level IS NULL)"""


@query("cube_kpi_of_choice", ORACLE["kpi_summary"].replace("FROM d GROUP BY", "FROM d" + FACET_SQL + " GROUP BY"))
def q_cube_kpi_of_choice(spark, sf):
    """The KPI row of one facet choice, from the same cube."""
    chosen = cube.cube_rows(J.dashboard_cube(spark, sf), J.FACET_YEARS, J.FACET_REGIONS, J.FACET_BINS)
    return _kpi_check(cube.cube_kpis(chosen))


@query("pivot_entity_year", W("""
, top AS (SELECT name FROM facts GROUP BY name ORDER BY count(*) DESC, name LIMIT 30)
SELECT name,
""" + ",\n".join(f"round(avg(dollar_price) FILTER (WHERE year = {y}), 2) AS \"{y}\"" for y in range(1995, 2002)) + """
FROM facts WHERE name IN (SELECT name FROM top) GROUP BY name"""))
def q_pivot_entity_year(spark, sf):
    years = J.year_span(spark, sf)
    p = S.pivot_entity_year(B.facts_snapshot(spark, sf), "name", "year", "dollar_price", 30, years)
    return norm(p, default=2)


@query("raw_index", W("SELECT obs_id, round(USD_raw, 9) AS USD_raw FROM raw_facts"))
def q_raw_index(spark, sf):
    return norm(B.raw_facts(spark, sf).select("obs_id", "USD_raw"), {"USD_raw": 9})


# ============================================================ statistics
@query("pearson", W("""
SELECT round(corr(GDP_dollar, dollar_price), 9) AS corr,
       count(*) FILTER (WHERE GDP_dollar IS NOT NULL AND dollar_price IS NOT NULL) AS n FROM facts"""))
def q_pearson(spark, sf):
    return norm(D.pearson(B.facts_snapshot(spark, sf), "GDP_dollar", "dollar_price"), {"corr": 9})


_CORR = ["local_price", "dollar_price", "dollar_ex", "USD_raw", "GDP_dollar", "adj_price"]


@query("corr_matrix", W("""
, d AS (SELECT * FROM facts WHERE """ + " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in _CORR) + """)
""" + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS corr FROM d"
    for a in _CORR for b in _CORR)))
def q_corr_matrix(spark, sf):
    return norm(D.corr_matrix(B.facts_snapshot(spark, sf), CORR_COLS), {"corr": 9})


@query("ols_line", W("""
SELECT round(regr_slope(dollar_price, GDP_dollar), 6) AS slope, round(regr_intercept(dollar_price, GDP_dollar), 4) AS intercept,
       round(regr_r2(dollar_price, GDP_dollar), 9) AS r2, regr_count(dollar_price, GDP_dollar) AS n,
       round(min(GDP_dollar), 2) AS x_min, round(max(GDP_dollar), 2) AS x_max
FROM facts WHERE GDP_dollar IS NOT NULL AND dollar_price IS NOT NULL"""))
def q_ols_line(spark, sf):
    return norm(D.ols_line(B.facts_snapshot(spark, sf), "GDP_dollar", "dollar_price"),
                {"slope": 6, "intercept": 4, "r2": 9, "x_min": 2, "x_max": 2})


HIST_SQL = """
, li AS (SELECT l_extendedprice AS v FROM lineitem),
st AS (SELECT min(v) AS lo, max(v) AS hi FROM li),
b AS (SELECT CAST(CASE WHEN st.hi = st.lo THEN 0 ELSE least(floor((v - st.lo) / (st.hi - st.lo) * 40), 39) END AS INTEGER) AS bin
      FROM li, st),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT g.bin, round(st.lo + g.bin * (st.hi - st.lo) / 40, 4) AS lo, round(st.lo + (g.bin + 1) * (st.hi - st.lo) / 40, 4) AS hi,
       coalesce(c.n, 0) AS count
FROM st, (SELECT CAST(range AS INTEGER) AS bin FROM range(0, 40)) g LEFT JOIN c ON g.bin = c.bin"""


@query("histogram", "WITH x AS (SELECT 1)" + HIST_SQL)
def q_histogram(spark, sf):
    li = B.table(spark, sf, "lineitem")
    return norm(D.histogram(li, "l_extendedprice", 40), {"lo": 4, "hi": 4})


KDE_SQL = """
, d AS (SELECT CAST(floor(year / 10) * 10 AS INTEGER) || 's' AS decade, dollar_price AS v FROM facts),
st AS (SELECT decade, min(v) AS lo, max(v) AS hi, count(*) AS n, stddev_samp(v) AS sd FROM d GROUP BY decade),
cells AS (
  SELECT d.decade, CAST(CASE WHEN st.hi = st.lo THEN 0 ELSE least(floor((v - st.lo) / (st.hi - st.lo) * 2000), 1999) END AS INTEGER) AS cell,
         count(*) AS w, avg(v) AS m
  FROM d JOIN st ON d.decade = st.decade GROUP BY 1, 2),
pts AS (
  SELECT decade, CAST(p AS INTEGER) AS point, lo + p * (hi - lo) / 199 AS x, n, sd * pow(CAST(n AS DOUBLE), -0.2) AS h
  FROM st, range(0, 200) t(p))
SELECT pts.decade, pts.point, round(pts.x, 4) AS x,
       round(CASE WHEN h > 0 THEN sum(CASE WHEN h > 0 THEN w * exp(-0.5 * ((x - m) / h) * ((x - m) / h)) END)
                                  * (1.0 / sqrt(2 * pi())) / (n * h) END * 1e6, 6) AS density_e6
FROM pts JOIN cells ON pts.decade = cells.decade
GROUP BY pts.decade, pts.point, pts.x, n, h"""


@query("kde_curve", W(KDE_SQL))
def q_kde_curve(spark, sf):
    d = B.facts_snapshot(spark, sf).withColumn("decade", C.decade_label("year"))
    k = D.kde_curve(d, "dollar_price", by="decade")
    return norm(k.select("decade", "point", "x", (F.col("density") * 1e6).alias("density_e6")),
                {"x": 4, "density_e6": 6})


@query("violin_stats", W("""
SELECT CAST(floor(year / 10) * 10 AS INTEGER) || 's' AS decade, count(*) AS n,
       round(quantile_cont(dollar_price, 0.25), 4) AS q1, round(quantile_cont(dollar_price, 0.5), 4) AS median,
       round(quantile_cont(dollar_price, 0.75), 4) AS q3
FROM facts GROUP BY 1"""))
def q_violin_stats(spark, sf):
    _, q = D.violin_stats(B.facts_snapshot(spark, sf), "year", "dollar_price")
    return norm(q, {"q1": 4, "median": 4, "q3": 4})


BOX_SQL = """
, q AS (SELECT year, count(*) AS n, quantile_cont(dollar_price, 0.25) AS q1, quantile_cont(dollar_price, 0.5) AS median,
               quantile_cont(dollar_price, 0.75) AS q3 FROM facts GROUP BY year),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS fence_lo, q3 + 1.5 * (q3 - q1) AS fence_hi FROM q)"""


@query("box_stats", W(BOX_SQL + """
, w AS (SELECT x.year, min(CASE WHEN dollar_price BETWEEN fence_lo AND fence_hi THEN dollar_price END) AS whisker_lo,
               max(CASE WHEN dollar_price BETWEEN fence_lo AND fence_hi THEN dollar_price END) AS whisker_hi,
               count(*) FILTER (WHERE NOT (dollar_price BETWEEN fence_lo AND fence_hi)) AS n_outliers
        FROM facts x JOIN f ON x.year = f.year GROUP BY x.year)
SELECT f.year, n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(fence_lo, 4) AS fence_lo,
       round(fence_hi, 4) AS fence_hi, round(whisker_lo, 2) AS whisker_lo, round(whisker_hi, 2) AS whisker_hi, n_outliers
FROM f JOIN w ON f.year = w.year"""))
def q_box_stats(spark, sf):
    stats, _ = D.box_stats(B.facts_snapshot(spark, sf), "year", "dollar_price")
    return norm(stats, {"q1": 4, "median": 4, "q3": 4, "fence_lo": 4, "fence_hi": 4, "whisker_lo": 2, "whisker_hi": 2})


@query("box_outliers", W(BOX_SQL + """
SELECT x.obs_id, x.year, round(x.dollar_price, 2) AS dollar_price FROM facts x JOIN f ON x.year = f.year
WHERE NOT (x.dollar_price BETWEEN fence_lo AND fence_hi)"""))
def q_box_outliers(spark, sf):
    _, out = D.box_stats(B.facts_snapshot(spark, sf).select("obs_id", "year", "dollar_price"), "year", "dollar_price")
    return norm(out.select("obs_id", "year", "dollar_price"), PRICE)


HASH = "(((((({key} + 42) % 2147483647) * 48271) % 2147483647) * 48271) % 2147483647)"


SAMPLE_FRACTION = 0.05


@query("sample_fixed", W("""
SELECT obs_id, round(GDP_dollar, 2) AS GDP_dollar, round(dollar_price, 2) AS dollar_price
FROM facts WHERE GDP_dollar IS NOT NULL ORDER BY """ + HASH.format(key="obs_id") + ", obs_id LIMIT 3000"))
def q_sample_fixed(spark, sf):
    """The reference's 3,000 points, exactly as many whatever the number of rows."""
    d = B.facts_snapshot(spark, sf).select("obs_id", "GDP_dollar", "dollar_price")
    return norm(D.sample_fixed(d, "obs_id", 3000, 42, dropna=["GDP_dollar"]), PRICE)


@query("sample_rows", W("""
SELECT obs_id, round(GDP_dollar, 2) AS GDP_dollar, round(dollar_price, 2) AS dollar_price
FROM facts WHERE GDP_dollar IS NOT NULL AND """ + HASH.format(key="obs_id") + f" < {SAMPLE_FRACTION} * 2147483647"))
def q_sample_rows(spark, sf):
    d = B.facts_snapshot(spark, sf).select("obs_id", "GDP_dollar", "dollar_price")
    return norm(D.sample_rows(d, "obs_id", SAMPLE_FRACTION, 42, dropna=["GDP_dollar", "dollar_price"]), PRICE)


@query("scatter_by_decade", W("""
SELECT obs_id, name, year, round(GDP_dollar, 2) AS GDP_dollar, round(USD_raw, 9) AS USD_raw,
       CAST(floor(year / 10) * 10 AS INTEGER) || 's' AS decade
FROM facts WHERE GDP_dollar IS NOT NULL AND USD_raw IS NOT NULL AND name IS NOT NULL AND """
                                        + HASH.format(key="obs_id") + f" < {SAMPLE_FRACTION} * 2147483647"))
def q_scatter_by_decade(spark, sf):
    s = D.scatter_by_decade(B.facts_snapshot(spark, sf), SAMPLE_FRACTION)
    return norm(s, {"GDP_dollar": 2, "USD_raw": 9})


@query("scatter_cells", W("""
SELECT CAST(floor(year / 10) * 10 AS INTEGER) || 's' AS decade, CAST(floor(GDP_dollar / 500.0) AS BIGINT) AS x_cell,
       CAST(floor(dollar_price / 10000.0) AS BIGINT) AS y_cell, count(*) AS n
FROM facts WHERE GDP_dollar IS NOT NULL AND dollar_price IS NOT NULL GROUP BY 1, 2, 3"""))
def q_scatter_cells(spark, sf):
    return D.scatter_cells(B.facts_snapshot(spark, sf), 500.0, 10000.0, y="dollar_price")


@query("scatter_snapshot", W(DASH_SQL + """
, s AS (SELECT * FROM d WHERE GDP_dollar IS NOT NULL AND USD_raw IS NOT NULL),
y AS (SELECT * FROM s WHERE year = (SELECT max(year) FROM s))
SELECT name, year, round(GDP_dollar, 2) AS GDP_dollar, round(USD_raw, 9) AS USD_raw, region,
       round(dollar_price, 2) AS dollar_price, (0.0 + round_even(USD_raw * 100 * 10, 0) / 10) AS USD_raw_pct FROM y"""))
def q_scatter_snapshot(spark, sf):
    pts, _ = D.scatter_snapshot(J.dashboard_frame(spark, sf))
    return norm(pts, {"GDP_dollar": 2, "USD_raw": 9, "dollar_price": 2, "USD_raw_pct": 1})


@query("split_train_test", W("""
SELECT CASE WHEN """ + HASH.format(key="obs_id") + """ < 0.8 * 2147483647 THEN 'train' ELSE 'test' END AS split,
       count(*) AS n FROM facts WHERE GDP_dollar IS NOT NULL GROUP BY 1"""))
def q_split_train_test(spark, sf):
    d = model.model_frame(B.facts_snapshot(spark, sf), keep=["obs_id"])
    tr, te = D.split_train_test(d, "obs_id", 0.8, 42)
    return (tr.select(F.lit("train").alias("split")).unionByName(te.select(F.lit("test").alias("split")))
            .groupBy("split").agg(F.count(F.lit(1)).alias("n")))


LINE_SQL = """
, m AS (SELECT obs_id, GDP_dollar, dollar_ex, year, dollar_price FROM facts WHERE GDP_dollar IS NOT NULL),
tr AS (SELECT * FROM m WHERE """ + HASH.format(key="obs_id") + """ < 0.8 * 2147483647),
te AS (SELECT * FROM m WHERE NOT (""" + HASH.format(key="obs_id") + """ < 0.8 * 2147483647)),
fit AS (SELECT regr_slope(dollar_price, GDP_dollar) AS b, regr_intercept(dollar_price, GDP_dollar) AS a FROM tr),
pred AS (SELECT te.*, fit.a + fit.b * te.GDP_dollar AS prediction FROM te, fit)"""


@query("eval_regression", W(LINE_SQL + """
SELECT round(sqrt(avg((dollar_price - prediction) * (dollar_price - prediction))), 4) AS rmse,
       round(1 - sum((dollar_price - prediction) * (dollar_price - prediction)) / (var_pop(dollar_price) * count(*)), 9) AS r2,
       round(avg(abs(dollar_price - prediction)), 4) AS mae, count(*) AS n FROM pred"""))
def q_eval_regression(spark, sf):
    d = model.model_frame(B.facts_snapshot(spark, sf), keep=["obs_id"])
    tr, te = D.split_train_test(d, "obs_id", 0.8, 42)
    p = model.line_predictions(tr, te, "GDP_dollar", "dollar_price")
    return norm(model.eval_regression(p), {"rmse": 4, "r2": 9, "mae": 4})


@query("residual_frame", W(LINE_SQL + """
SELECT round(dollar_price, 2) AS dollar_price, round(prediction, 4) AS prediction,
       round(dollar_price - prediction, 4) AS residual FROM pred"""))
def q_residual_frame(spark, sf):
    d = model.model_frame(B.facts_snapshot(spark, sf), keep=["obs_id"])
    tr, te = D.split_train_test(d, "obs_id", 0.8, 42)
    rows, _ = model.residual_frame(model.line_predictions(tr, te, "GDP_dollar", "dollar_price"))
    return norm(rows, {"dollar_price": 2, "prediction": 4, "residual": 4})


# Ridge on standardised columns: (R + lambda I) beta = r with R, r the correlations on the training rows and
# lambda = penalty / population deviation of the label; solved by Cramer's rule.
RIDGE_SQL = """
, m AS (SELECT obs_id, GDP_dollar, dollar_ex, year, dollar_price FROM facts WHERE GDP_dollar IS NOT NULL),
tr AS (SELECT * FROM m WHERE """ + HASH.format(key="obs_id") + """ < 0.8 * 2147483647),
te AS (SELECT * FROM m WHERE NOT (""" + HASH.format(key="obs_id") + f""" < 0.8 * 2147483647)),
s AS (SELECT avg(dollar_price) AS ym, stddev_samp(dollar_price) AS ys, 1 + {MODEL_REG_PARAM} / stddev_pop(dollar_price) AS q,
             avg(GDP_dollar) AS m1, avg(dollar_ex) AS m2, avg(year) AS m3,
             stddev_samp(GDP_dollar) AS s1, stddev_samp(dollar_ex) AS s2, stddev_samp(year) AS s3,
             corr(GDP_dollar, dollar_ex) AS a, corr(GDP_dollar, year) AS b, corr(dollar_ex, year) AS c,
             corr(GDP_dollar, dollar_price) AS u, corr(dollar_ex, dollar_price) AS v, corr(year, dollar_price) AS w FROM tr),
dt AS (SELECT *, q * (q * q - c * c) - a * (a * q - b * c) + b * (a * c - b * q) AS det FROM s),
k AS (SELECT *, ys * (u * (q * q - c * c) - a * (v * q - w * c) + b * (v * c - w * q)) / det AS c1,
                ys * (q * (v * q - w * c) - u * (a * q - b * c) + b * (a * w - b * v)) / det AS c2,
                ys * (q * (q * w - c * v) - a * (a * w - b * v) + u * (a * c - b * q)) / det AS c3 FROM dt),
pred AS (SELECT te.*, ym + c1 * (GDP_dollar - m1) / s1 + c2 * (dollar_ex - m2) / s2 + c3 * (year - m3) / s3 AS prediction
         FROM te, k)"""
MODEL_DIGITS = {"prediction": 3, "coefficient": 3, "intercept": 3}


def _price_model(spark, sf):
    """(fitted pipeline, test rows) of the price model on the 80 % split."""
    d = model.model_frame(B.facts_snapshot(spark, sf), keep=["obs_id"])
    tr, te = D.split_train_test(d, "obs_id", 0.8, 42)
    return model.fit_price_model(tr), te


@query("fit_price_model", W(RIDGE_SQL + """
SELECT round(avg(prediction), 3) AS mean_prediction, round(min(prediction), 3) AS lowest, round(max(prediction), 3) AS highest,
       count(*) AS n FROM pred"""))
def q_fit_price_model(spark, sf):
    m, te = _price_model(spark, sf)
    return norm(model.predict(m, te).agg(
        F.avg("prediction").alias("mean_prediction"), F.min("prediction").alias("lowest"),
        F.max("prediction").alias("highest"), F.count(F.lit(1)).alias("n")), default=3)


@query("predict", W(RIDGE_SQL + """
SELECT obs_id, round(dollar_price, 2) AS dollar_price, round(prediction, 3) AS prediction FROM pred"""))
def q_predict(spark, sf):
    m, te = _price_model(spark, sf)
    return norm(model.predict(m, te).select("obs_id", "dollar_price", "prediction"),
                {**MODEL_DIGITS, "dollar_price": 2})


@query("model_coefficients", W(RIDGE_SQL + """
SELECT 'intercept' AS term, round(ym, 3) AS coefficient, CAST(NULL AS DOUBLE) AS raw_coefficient FROM k
UNION ALL SELECT 'GDP_dollar', round(c1, 3), round(c1 / s1, 6) FROM k
UNION ALL SELECT 'dollar_ex', round(c2, 3), round(c2 / s2, 3) FROM k
UNION ALL SELECT 'year', round(c3, 3), round(c3 / s3, 3) FROM k"""))
def q_model_coefficients(spark, sf):
    m, _ = _price_model(spark, sf)
    raw = F.when(F.col("term") == "GDP_dollar", qround(F.col("raw_coefficient"), 6)) \
        .otherwise(qround(F.col("raw_coefficient"), 3))
    return model.model_coefficients(m, MODEL_FEATURES).select(
        "term", qround(F.col("coefficient"), 3).alias("coefficient"), raw.alias("raw_coefficient"))


# ============================================================ linkage
LINK_SQL = """
WITH p AS (SELECT p_partkey, p_name, p_type FROM part),
q AS (SELECT DISTINCT CASE WHEN p_type = 'ECONOMY' THEN '  ' || upper(p_name) || ' '
                           WHEN p_type = 'PROMO' THEN array_to_string(list_reverse(string_split(p_name, ' ')), ' ')
                           WHEN p_type IN ('SMALL', 'MEDIUM') THEN substring(p_name, 1, 2) || substring(p_name, 4)
                           ELSE p_name END AS name FROM p),
qk AS (SELECT name, lower(trim(name)) AS key FROM q),
dict AS (SELECT lower(trim(p_name)) AS key, min(p_partkey) AS code FROM p GROUP BY 1),
al AS (SELECT lower(trim(array_to_string(list_reverse(string_split(p_name, ' ')), ' '))) AS key,
              min(lower(trim(p_name))) AS tkey FROM p GROUP BY 1),
ex AS (SELECT qk.name, d.code, 'exact' AS tier, 1.0 AS score FROM qk JOIN dict d ON qk.key = d.key),
r1 AS (SELECT * FROM qk WHERE name NOT IN (SELECT name FROM ex)),
als AS (SELECT r1.name, d.code, 'alias' AS tier, 1.0 AS score FROM r1 JOIN al ON r1.key = al.key JOIN dict d ON al.tkey = d.key),
r2 AS (SELECT * FROM r1 WHERE name NOT IN (SELECT name FROM als)),
sc AS (SELECT r2.name, d.key AS dkey, d.code,
              CASE WHEN greatest(length(r2.key), length(d.key)) = 0 THEN 1.0
                   ELSE 1.0 - levenshtein(r2.key, d.key) / greatest(length(r2.key), length(d.key)) END AS score
       FROM r2, dict d),
fz AS (SELECT name, arg_max(code, (score, dkey)) AS code, 'fuzzy' AS tier, max(score) AS score FROM sc WHERE score >= 0.88 GROUP BY name),
res AS (SELECT * FROM ex UNION ALL SELECT * FROM als UNION ALL SELECT * FROM fz)"""


@query("link_names", LINK_SQL + """
SELECT q.name, res.code, res.tier, round(res.score, 9) AS score FROM q LEFT JOIN res ON q.name = res.name""")
def q_link_names(spark, sf):
    return norm(J.linked_names(spark, sf), {"score": 9})


@query("link_exact", LINK_SQL + " SELECT name, code FROM ex")
def q_link_exact(spark, sf):
    q, d, _ = J.link_inputs(spark, sf)
    return link.link_exact(q, d).select("name", "code")


@query("link_alias", LINK_SQL + """
, r1b AS (SELECT * FROM qk WHERE name NOT IN (SELECT name FROM ex))
SELECT r1b.name, d.code FROM r1b JOIN al ON r1b.key = al.key JOIN dict d ON al.tkey = d.key""")
def q_link_alias(spark, sf):
    q, d, a = J.link_inputs(spark, sf)
    rest = q.select("name").distinct().join(link.link_exact(q, d).select("name"), "name", "left_anti")
    return link.link_alias(rest, a, d).select("name", "code")


@query("link_fuzzy", LINK_SQL + """
, sc2 AS (SELECT qk.name, d.key AS dkey, d.code,
              CASE WHEN greatest(length(qk.key), length(d.key)) = 0 THEN 1.0
                   ELSE 1.0 - levenshtein(qk.key, d.key) / greatest(length(qk.key), length(d.key)) END AS score
       FROM qk, dict d)
SELECT name, arg_max(code, (score, dkey)) AS code, round(max(score), 9) AS score FROM sc2 WHERE score >= 0.88 GROUP BY name""")
def q_link_fuzzy(spark, sf):
    q, d, _ = J.link_inputs(spark, sf)
    return norm(link.link_fuzzy(q, d, 0.88).select("name", "code", "score"), {"score": 9})


@query("link_nearest", ORACLE["link_fuzzy"])
def q_link_nearest(spark, sf):
    """The same links by the search of growing distance."""
    q, d, _ = J.link_inputs(spark, sf)
    return norm(link.link_fuzzy(q, d, 0.88, search="nearest").select("name", "code", "score"), {"score": 9})


@query("link_minhash")
def q_link_minhash(spark, sf):
    """Links over banded MinHash candidates. Not exact, so no SQL twin: recall against ``link_fuzzy`` is tested."""
    q, d, _ = J.link_inputs(spark, sf)
    return norm(link.link_fuzzy(q, d, 0.88, search="minhash").select("name", "code", "score"), {"score": 9})


QUERIES["best_match"] = q_link_fuzzy
ORACLE["best_match"] = ORACLE["link_fuzzy"]


@query("link_report", LINK_SQL + """
SELECT count(*) AS total, count(res.code) AS matched, count(*) FILTER (WHERE tier = 'exact') AS exact,
       count(*) FILTER (WHERE tier = 'alias') AS alias, count(*) FILTER (WHERE tier = 'fuzzy') AS fuzzy
FROM q LEFT JOIN res ON q.name = res.name""")
def q_link_report(spark, sf):
    return link.link_report(J.linked_names(spark, sf))


@query("apply_link", LINK_SQL + """
, qa AS (SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN '  ' || upper(p_name) || ' '
                           WHEN p_type = 'PROMO' THEN array_to_string(list_reverse(string_split(p_name, ' ')), ' ')
                           WHEN p_type IN ('SMALL', 'MEDIUM') THEN substring(p_name, 1, 2) || substring(p_name, 4)
                           ELSE p_name END AS name FROM p)
SELECT qa.p_partkey, qa.name, res.code FROM qa JOIN res ON qa.name = res.name""")
def q_apply_link(spark, sf):
    q, _, _ = J.link_inputs(spark, sf)
    return link.apply_link(q, J.linked_names(spark, sf), "name", "code").select("p_partkey", "name", "code")


# ============================================================ added sources / sinks / fills
@query("scan_multipart", W("""
SELECT year, count(*) AS n_rows, round(sum(dollar_price), 2) AS total FROM raw_facts GROUP BY year"""))
def q_scan_multipart(spark, sf):
    """Raw facts written as a multi-part CSV folder, read back through ``scan_multipart``."""
    raw = B.raw_snapshot(spark, sf).select("obs_id", "year", "dollar_price")
    path = J.write_wide(raw, "facts-parts")
    schema = T.StructType([T.StructField("obs_id", T.LongType()), T.StructField("year", T.IntegerType()),
                           T.StructField("dollar_price", T.DoubleType())])
    df = readers.scan_multipart(spark, path, path + "-missing", schema=schema)
    return norm(df.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("dollar_price").alias("total")),
                {"total": 2})


# Every fiftieth line has a price that is no number, every seventieth a field too many.
BAD_SQL = "(obs_id % 50 = 0 OR obs_id % 70 = 0)"


@query("scan_split", W(f"""
SELECT 'accepted' AS kind, year, count(*) AS n_rows, round(sum(dollar_price), 2) AS total FROM raw_facts
WHERE NOT {BAD_SQL} GROUP BY year
UNION ALL SELECT 'rejected', year, count(*), NULL FROM raw_facts WHERE {BAD_SQL} GROUP BY year
UNION ALL SELECT 'observed', NULL, count(*) FILTER (WHERE NOT {BAD_SQL}), count(*) FILTER (WHERE {BAD_SQL}) FROM raw_facts"""))
def q_scan_split(spark, sf):
    """Raw facts as CSV lines, some malformed: accepted rows and quarantined raw lines from one pass, both counts observed."""
    raw = B.raw_snapshot(spark, sf).select("obs_id", "year", "dollar_price")
    accepted, lines, counts = J.split_lines(spark, raw)
    kept = accepted.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("dollar_price").alias("total"))
    bad = lines.groupBy(F.split("line", ",")[1].cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n_rows"))
    both = spark.createDataFrame([("observed", None, counts["accepted"], float(counts["rejected"]))],
                                 "kind string, year int, n_rows long, total double")
    out = kept.select(F.lit("accepted").alias("kind"), "year", "n_rows", "total") \
        .unionByName(bad.select(F.lit("rejected").alias("kind"), "year", "n_rows", F.lit(None).cast("double").alias("total"))) \
        .unionByName(both)
    return norm(out, {"total": 2})


@query("sink_metrics", W(RIDGE_SQL + """
, e AS (SELECT sqrt(avg((dollar_price - prediction) * (dollar_price - prediction))) AS rmse,
       1 - sum((dollar_price - prediction) * (dollar_price - prediction)) / (var_pop(dollar_price) * count(*)) AS r2,
       avg(abs(dollar_price - prediction)) AS mae FROM pred)
SELECT round(rmse, 3) AS rmse, round(r2, 8) AS r2, round(mae, 3) AS mae, round(ym, 3) AS intercept,
       round(c1, 3) AS coef_gdp, round(c2, 3) AS coef_ex, round(c3, 3) AS coef_year FROM e, k"""))
def q_sink_metrics(spark, sf):
    """The price model's metrics record, written as JSON and read back."""
    from ..session import scratch_path
    import uuid

    m, te = _price_model(spark, sf)
    record = model.metrics_frame(model.eval_regression(model.predict(m, te)),
                                 model.model_coefficients(m, MODEL_FEATURES))
    path = scratch_path(spark, f"metrics-{uuid.uuid4().hex}")
    writers.sink_metrics(record, path)
    back = spark.read.schema(record.schema).json(path)
    coef = [F.col("coefficients")[f].alias(n) for f, n in zip(MODEL_FEATURES, ("coef_gdp", "coef_ex", "coef_year"))]
    return norm(back.select("rmse", "r2", "mae", "intercept", *coef), {"r2": 8}, default=3)


@query("fill_median", W("""
, med AS (SELECT quantile_cont(GDP_dollar, 0.5) AS m FROM facts)
SELECT obs_id, round(coalesce(GDP_dollar, med.m), 4) AS GDP_dollar FROM facts, med"""))
def q_fill_median(spark, sf):
    d = clean.fill_median(B.facts_snapshot(spark, sf).select("obs_id", "GDP_dollar"), "GDP_dollar", rel_err=None)
    return norm(d, {"GDP_dollar": 4})


@query("residual_limits", W(LINE_SQL + """
SELECT round(least(min(dollar_price), min(prediction)) - 0.5, 4) AS lim_lo,
       round(greatest(max(dollar_price), max(prediction)) + 0.5, 4) AS lim_hi FROM pred"""))
def q_residual_limits(spark, sf):
    d = model.model_frame(B.facts_snapshot(spark, sf), keep=["obs_id"])
    tr, te = D.split_train_test(d, "obs_id", 0.8, 42)
    _, lim = model.residual_frame(model.line_predictions(tr, te, "GDP_dollar", "dollar_price"))
    return norm(lim, {"lim_lo": 4, "lim_hi": 4})


@query("scatter_line", W(DASH_SQL + """
, s AS (SELECT * FROM d WHERE GDP_dollar IS NOT NULL AND USD_raw IS NOT NULL),
y AS (SELECT *, (0.0 + round_even(USD_raw * 100 * 10, 0) / 10) AS pct FROM s WHERE year = (SELECT max(year) FROM s))
SELECT round(regr_slope(pct, GDP_dollar), 9) AS slope, round(regr_intercept(pct, GDP_dollar), 6) AS intercept,
       round(regr_r2(pct, GDP_dollar), 9) AS r2, regr_count(pct, GDP_dollar) AS n,
       round(min(GDP_dollar), 2) AS x_min, round(max(GDP_dollar), 2) AS x_max FROM y"""))
def q_scatter_line(spark, sf):
    _, line = D.scatter_snapshot(J.dashboard_frame(spark, sf))
    return norm(line, {"slope": 9, "intercept": 6, "r2": 9, "x_min": 2, "x_max": 2})


QUERIES["violin_density"] = q_kde_curve
ORACLE["violin_density"] = ORACLE["kde_curve"]


@query("hover_text", W(DASH_SQL + """
SELECT obs_id, name || '<br>Valuation: ' || CASE WHEN p >= 0 THEN '+' ELSE '' END || printf('%.1f', p)
       || '%<br>Price: $' || printf('%.2f', (0.0 + ROUND(dollar_price, 2))) AS hover
FROM (SELECT obs_id, name, dollar_price, (0.0 + round_even(USD_raw * 100 * 10, 0) / 10) AS p FROM d WHERE USD_raw IS NOT NULL)"""))
def q_hover_text(spark, sf):
    """Per-row labels (exact cent prices: no rounding tie can depend on summation order)."""
    d = J.dashboard_frame(spark, sf).filter(F.col("USD_raw").isNotNull())
    return d.select("obs_id", C.hover_text("name", C.pct_round("USD_raw", 1), "dollar_price").alias("hover"))


@query("fmt_pct", W(DASH_SQL + """
, g AS (SELECT name, iso_a3, avg(USD_raw) AS m FROM d GROUP BY name, iso_a3),
ok AS (SELECT * FROM g WHERE name IS NOT NULL AND iso_a3 IS NOT NULL AND m IS NOT NULL)
SELECT name, CASE WHEN p >= 0 THEN '+' ELSE '' END || printf('%.1f', p) || '%' AS index_text FROM (
  SELECT name, (0.0 + round_even(m * 100 * 10, 0) / 10) AS p FROM ok)"""))
def q_fmt_pct(spark, sf):
    g = S.mean_by_entity(J.dashboard_frame(spark, sf).filter(F.col("iso_a3").isNotNull()), "name", "USD_raw", "m")
    return g.filter(F.col("name").isNotNull() & F.col("m").isNotNull()).select("name", C.fmt_pct("m").alias("index_text"))


@query("fmt_usd", W(DASH_SQL + """
SELECT obs_id, '$' || printf('%.2f', (0.0 + ROUND(dollar_price, 2))) AS price_text,
       '$' || printf('%.2f', (0.0 + ROUND(local_price, 2))) AS local_text FROM d"""))
def q_fmt_usd(spark, sf):
    d = J.dashboard_frame(spark, sf)
    return d.select("obs_id", C.fmt_usd("dollar_price").alias("price_text"), C.fmt_usd("local_price").alias("local_text"))


@query("enrich_stream", ORACLE["join_fill"])
def q_enrich_stream(spark, sf):
    """Raw facts arrive as CSV files; the streaming enrichment appends the filled snapshot."""
    from ..session import scratch_path
    from ..streaming import enrich_stream
    import uuid

    raw = B.raw_snapshot(spark, sf)
    src = J.write_wide(raw, "stream-src")
    out = scratch_path(spark, f"stream-out-{uuid.uuid4().hex}")
    panel = J.per_capita_panel(spark, sf)
    q = enrich_stream(spark, src, panel, out, raw.schema)
    q.awaitTermination()
    return norm(spark.read.parquet(out).select(*FACT_COLS), FACT_DIGITS)


# Ids whose operator runs inside another registered query get that query as their key.
for _alias, _target in [("normalize_names", "scan_facts"), ("parse_date_year", "scan_facts"),
                        ("project_existing", "preview"), ("sink_csv", "scan_multipart")]:
    QUERIES[_alias] = QUERIES[_target]
    if _target in ORACLE:
        ORACLE[_alias] = ORACLE[_target]


@query("link_fuzzy_ratio")
def q_link_fuzzy_ratio(spark, sf):
    """difflib-ratio scoring (parity mode). No SQL twin: checked against brute force in tests."""
    q, d, _ = J.link_inputs(spark, sf)
    return norm(link.link_fuzzy(q, d, 0.88, method="ratio").select("name", "code", "score"), {"score": 9})


# ============================================================ the same operators on ``events``
@query("histogram_by_type", """
WITH e AS (SELECT event_type, value AS v FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
st AS (SELECT event_type, min(v) AS lo, max(v) AS hi FROM e GROUP BY event_type),
b AS (SELECT e.event_type, CAST(CASE WHEN st.hi = st.lo THEN 0
             ELSE least(floor((v - st.lo) / (st.hi - st.lo) * 40), 39) END AS INTEGER) AS bin
      FROM e JOIN st ON e.event_type = st.event_type),
c AS (SELECT event_type, bin, count(*) AS n FROM b GROUP BY 1, 2)
SELECT st.event_type, g.bin, round(st.lo + g.bin * (st.hi - st.lo) / 40, 6) AS lo,
       round(st.lo + (g.bin + 1) * (st.hi - st.lo) / 40, 6) AS hi, coalesce(c.n, 0) AS count
FROM st CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(0, 40)) g
LEFT JOIN c ON c.event_type = st.event_type AND c.bin = g.bin""")
def q_histogram_by_type(spark, sf):
    ev = B.table(spark, sf, "events")
    return norm(D.histogram(ev, "value", 40, by="event_type"), {"lo": 6, "hi": 6})


@query("quartiles_by_type", """
SELECT event_type, count(*) AS n, round(quantile_cont(value, 0.25), 6) AS q1,
       round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3
FROM events WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY event_type""")
def q_quartiles_by_type(spark, sf):
    return norm(D.quartiles(B.table(spark, sf, "events"), "value", by="event_type"), {"q1": 6, "median": 6, "q3": 6})


@query("top_bottom_users", """
WITH m AS (SELECT user_id, avg(value) AS value FROM events WHERE user_id IS NOT NULL GROUP BY user_id
           HAVING avg(value) IS NOT NULL),
lo AS (SELECT *, 'bottom' AS half FROM m ORDER BY value ASC, user_id LIMIT 10),
hi AS (SELECT *, 'top' AS half FROM m ORDER BY value DESC, user_id LIMIT 10)
SELECT user_id, round(value, 6) AS value, half, 'neutral' AS color FROM (SELECT * FROM lo UNION ALL SELECT * FROM hi)""")
def q_top_bottom_users(spark, sf):
    t = S.top_bottom(B.table(spark, sf, "events"), "user_id", "value", 20, is_index=False)
    return norm(t.drop("display"), {"value": 6})


@query("box_stats_sketch")
def q_box_stats_sketch(spark, sf):
    """Box statistics with quartiles from stored KLL sketches (no SQL twin; rank error tested against the exact ranks)."""
    stats, _ = D.box_stats(B.facts_snapshot(spark, sf), "year", "dollar_price", sketches=J.price_sketches(spark, sf))
    return norm(stats, {"q1": 2, "median": 2, "q3": 2, "fence_lo": 2, "fence_hi": 2, "whisker_lo": 2, "whisker_hi": 2})


@query("box_stats_approx")
def q_box_stats_approx(spark, sf):
    """Box statistics from the mergeable ``percentile_approx`` sketch (rows-only; tested against exact)."""
    stats, _ = D.box_stats(B.facts_snapshot(spark, sf), "year", "dollar_price", approx=True)
    return norm(stats, {"q1": 2, "median": 2, "q3": 2, "fence_lo": 2, "fence_hi": 2, "whisker_lo": 2, "whisker_hi": 2})


def _oracle_rounding(sql: str) -> str:
    """Rewrite every two-argument ``round(a, d)`` as ``(0.0 + round((a) + TIE_SHIFT·10^-d, d))``.

    Same tie shift as ``qround``; ``0.0 +`` turns DuckDB's rounded -0.0 into 0.0
    as Spark's rounding gives.  One-argument ``round(x)`` is left alone, and so
    is upper-case ``ROUND``, which the oracles use where rounding is the
    operator's own semantics (``pct_round``), not output normalisation.
    """
    out, i = [], 0
    pat = re.compile(r"(?<![\w.])round\(")
    while True:
        m = pat.search(sql, i)
        if not m:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:m.start()])
        j, depth, comma = m.end(), 1, None
        while depth:
            ch = sql[j]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = j
            j += 1
        inner = sql[m.end():j - 1]
        if comma is None:
            out.append("round(" + _oracle_rounding(inner) + ")")
        else:
            arg = _oracle_rounding(sql[m.end():comma])
            d = int(sql[comma + 1:j - 1].strip())
            out.append(f"(0.0 + round(({arg}) + {TIE_SHIFT / 10 ** d!r}, {d}))")
        i = j


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: _oracle_rounding(v) for k, v in ORACLE.items()}
