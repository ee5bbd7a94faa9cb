"""Jobs composed from the operators, bound to the driver's tables.

``gdp_wide``/``pop_wide`` build the two wide reference matrices from the
order data (nation × year totals with thousands separators; order counts at
snapshot years), ``enrich`` runs the whole enrichment chain on them, and the
dashboard/profile/model jobs read the result.  Wide files are written as CSV
under the shared checkpoint folder and read back through the real sources.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import bitmaps, clean, cube, enrich, link, reshape, select, sketches, summarize
from ..operators._util import materialize
from ..schemas import DEFAULT_REGION, GDP_BIN_EDGES, GDP_BIN_LABELS, NO_DATA_LABEL, key_column, snapshot_columns
from ..functions.columns import bin_label
from ..session import scratch_path
from ..sources import readers, writers
from . import bindings

SNAPSHOT_YEARS = [1995, 1996, 1998, 2001]
TREND_CENTER = 1998


def year_span(spark: SparkSession, sf_dir: str) -> list[int]:
    """Calendar years covered by the orders (one scalar aggregate)."""
    r = bindings.raw_snapshot(spark, sf_dir).agg(F.min("year").alias("lo"), F.max("year").alias("hi")).first()
    return list(range(r["lo"], r["hi"] + 1))


def nation_year_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_name, year, total) with the total summed in integer cents (exact in any order)."""
    j = bindings.raw_snapshot(spark, sf_dir)
    cents = F.round(F.col("dollar_price") * 100).cast("long")
    return (j.groupBy(F.col("name").alias("n_name"), "year")
            .agg(F.sum(cents).alias("cents"))
            .select("n_name", "year", (F.col("cents") / F.lit(100.0)).alias("total")))


def gdp_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide text matrix: Country, then one column per year; totals printed with thousands commas."""
    years = year_span(spark, sf_dir)
    t = nation_year_totals(spark, sf_dir).withColumn("txt", F.format_number("total", 2))
    w = t.groupBy("n_name").pivot("year", years).agg(F.first("txt"))
    return w.toDF("Country", *[str(y) for y in years])


def pop_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide snapshot matrix: CCA3, Country, '<year> Population' counts at snapshot years, and a
    'World Population Percentage' column that must not be taken for a snapshot."""
    j = bindings.raw_snapshot(spark, sf_dir).filter(F.col("year").isin(*SNAPSHOT_YEARS))
    counts = j.groupBy(F.col("iso_a3").alias("CCA3"), F.col("name").alias("Country"),
                       "year").agg(F.count(F.lit(1)).alias("n"))
    w = counts.groupBy("CCA3", "Country").pivot("year", SNAPSHOT_YEARS).agg(F.format_number(F.first("n"), 0))
    w = w.toDF("CCA3", "Country", *[f"{y} Population" for y in SNAPSHOT_YEARS])
    return w.withColumn("World Population Percentage", F.lit("0.5"))


def write_wide(df: DataFrame, tag: str) -> str:
    path = scratch_path(df.sparkSession, f"{tag}-{uuid.uuid4().hex}")
    writers.sink_csv(df, path)
    return path


def gdp_long(spark: SparkSession, sf_dir: str, via_files: bool = True) -> DataFrame:
    """Wide GDP text matrix → (country_name, year, gdp) with ``parse_thousands``.

    ``via_files`` writes the matrix as CSV and reads it back through the wide-file
    source (the reference's input path); otherwise the derived frame is unpivoted directly.
    """
    wide = gdp_wide(spark, sf_dir)
    if via_files:
        wide, years = readers.scan_wide_years(spark, write_wide(wide, "gdp-wide"))
    else:
        wide, years = wide.withColumnRenamed("Country", "country_name"), wide.columns[1:]
    return reshape.unpivot_years(wide, "country_name", years, "gdp")


def pop_snapshots(spark: SparkSession, sf_dir: str, via_files: bool = True) -> DataFrame:
    wide = pop_wide(spark, sf_dir)
    if via_files:
        wide, key, cols = readers.scan_wide_snapshots(spark, write_wide(wide, "pop-wide"), SNAPSHOT_YEARS)
    else:
        key, cols = key_column(wide.columns), snapshot_columns(wide.columns, SNAPSHOT_YEARS)
    return reshape.unpivot_snapshots(wide, key, cols, "population", "cca3")


def pop_estimate(spark: SparkSession, sf_dir: str, via_files: bool = True) -> DataFrame:
    fit = enrich.trend_fit(pop_snapshots(spark, sf_dir, via_files), "cca3", "year", "population", TREND_CENTER)
    years = year_span(spark, sf_dir)
    return enrich.trend_extrapolate(fit, "cca3", years[0], years[-1], floor=1.0, center=TREND_CENTER,
                                    out="population_est")


def per_capita_panel(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    """(iso, year, per_capita): GDP names linked to codes, joined to the population estimate."""
    facts = facts if facts is not None else bindings.facts_snapshot(spark, sf_dir)
    g = gdp_long(spark, sf_dir, via_files=False)
    links = link.link_names(g.select(F.col("country_name").alias("name")),
                            facts.select("name", F.col("iso_a3").alias("code")))
    g = link.apply_link(g, links, "country_name", "iso")
    pop = pop_estimate(spark, sf_dir, via_files=False).withColumnRenamed("cca3", "iso")
    panel = enrich.join_panel(g, pop, ["iso", "year"], "gdp", "population_est", "per_capita", scale=1.0)
    return enrich.unique_panel(panel, ["iso", "year"], "per_capita")


def enrich_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with missing ``GDP_dollar`` filled from the per-capita panel (row count unchanged)."""
    facts = bindings.facts_snapshot(spark, sf_dir)
    panel = per_capita_panel(spark, sf_dir, facts)
    filled = enrich.join_fill(facts, panel, ["iso_a3", "year"], ["iso", "year"], "per_capita")
    return enrich.fill_from(filled, "GDP_dollar", "per_capita", zero_is_missing=True)


def enrich_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``enrich_facts`` over the bucketed snapshot: no join with a panel shuffles the facts."""
    table, buckets = bindings.bucketed_snapshot(spark, sf_dir)
    panel = materialize(per_capita_panel(spark, sf_dir), "per-capita")
    filled = enrich.join_fill_bucketed(clean.drop_incomplete(table), panel, bindings.BUCKET_KEYS, ["iso", "year"],
                                       "per_capita", buckets, bindings.BUCKET_SALTS, writers.SALT)
    return enrich.fill_from(filled, "GDP_dollar", "per_capita", zero_is_missing=True)


def user_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmaps of the users per (event type, day), written; any group of these merges from them."""
    ev = bindings.table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"), "user_id")
    return materialize(bitmaps.distinct_bitmaps(ev, ["event_type", "day"], "user_id"), "user-bitmaps")


def part_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmaps of the parts per (return flag, line status, year), written."""
    li = bindings.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("year"), "l_partkey")
    return materialize(bitmaps.distinct_bitmaps(li, ["l_returnflag", "l_linestatus", "year"], "l_partkey"), "part-bitmaps")


def region_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code → region label (nation ⋈ region; 25 rows at every scale)."""
    return bindings.nations(spark, sf_dir).select(F.col("n_nationkey").cast("string").alias("code"),
                                                  F.col("r_name").alias("region"))


def dashboard_frame(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    """Facts without the duplicate-entity names, with region (default for unmapped) and income level."""
    df = facts if facts is not None else bindings.facts_snapshot(spark, sf_dir)
    df = clean.exclude_values(df, "name", ["UAE", "Britain"])
    df = clean.map_with_default(df, "iso_a3", region_map(spark, sf_dir), "code", "region", "region", DEFAULT_REGION)
    return df.withColumn("gdp_level", bin_label("GDP_dollar", GDP_BIN_EDGES, GDP_BIN_LABELS, NO_DATA_LABEL))


def dashboard_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facet cube of the dashboard frame, written once beside the fact snapshot; the facts are scanned this once."""
    return bindings.derived(spark, sf_dir, "facet-cube", lambda: cube.facet_cube(dashboard_frame(spark, sf_dir)))


def price_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantile sketches of the price per (year, month), written once beside the fact snapshot."""
    return bindings.derived(spark, sf_dir, "price-sketches", lambda: sketches.quantile_sketches(
        bindings.facts_snapshot(spark, sf_dir).withColumn("month", F.month("date")), ["year", "month"], "dollar_price"))


# Facet choice used by the dashboard queries.
FACET_YEARS = (1996, 1999)
FACET_REGIONS = ["ASIA", "EUROPE", "AMERICA"]
FACET_BINS = [GDP_BIN_LABELS[0], GDP_BIN_LABELS[1], NO_DATA_LABEL]


def dashboard_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.facet_filter(dashboard_frame(spark, sf_dir), FACET_YEARS, FACET_REGIONS, FACET_BINS)


def link_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(queries, dictionary, aliases) from ``part``.

    dictionary = (p_name, p_partkey); each part row contributes one query
    spelling by its type: ECONOMY upper-cased and padded (exact tier), PROMO
    words reversed (alias tier; the alias list maps reversed spellings back),
    SMALL/MEDIUM with the third character removed (fuzzy tier), else as is.
    """
    p = bindings.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    reversed_words = F.array_join(F.reverse(F.split(F.col("p_name"), " ")), " ")
    drop3 = F.concat(F.substring("p_name", 1, 2), F.expr("substring(p_name, 4)"))
    spelling = (F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")))
                .when(F.col("p_type") == "PROMO", reversed_words)
                .when(F.col("p_type").isin("SMALL", "MEDIUM"), drop3)
                .otherwise(F.col("p_name")))
    queries = p.select("p_partkey", spelling.alias("name"))
    dictionary = p.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("code"))
    aliases = p.select(reversed_words.alias("alias"), F.col("p_name").alias("target")).distinct()
    return queries, dictionary, aliases


def linked_names(spark: SparkSession, sf_dir: str, method: str = "levenshtein") -> DataFrame:
    q, d, a = link_inputs(spark, sf_dir)
    return link.link_names(q, d, a, cutoff=0.88, method=method)


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched facts written as year-partitioned Parquet, read back (the saved snapshot)."""
    path = scratch_path(spark, f"snapshot-{uuid.uuid4().hex}")
    writers.sink_parquet(bindings.facts_snapshot(spark, sf_dir), path, partition_by=["year"])
    return spark.read.parquet(path)


def observed_snapshot(spark: SparkSession, df: DataFrame, measures: list) -> dict:
    """Write a snapshot by year and return ``measures`` as observed while it was written."""
    path = scratch_path(spark, f"observed-{uuid.uuid4().hex}")
    return writers.sink_parquet(df, path, partition_by=["year"], observe=measures)


def split_lines(spark: SparkSession, raw: DataFrame) -> tuple[DataFrame, DataFrame, dict]:
    """(obs_id, year, dollar_price) as CSV lines, some spoilt, read back through ``scan_split``."""
    price = F.when(F.col("obs_id") % 50 == 0, F.lit("n.a.")).otherwise(F.col("dollar_price").cast("string"))
    line = F.concat_ws(",", F.col("obs_id").cast("string"), F.col("year").cast("string"), price,
                       F.when(F.col("obs_id") % 70 == 0, F.lit("surplus")))
    path = scratch_path(spark, f"lines-{uuid.uuid4().hex}")
    raw.select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("obs_id", T.LongType()), T.StructField("year", T.IntegerType()),
                           T.StructField("dollar_price", T.DoubleType())])
    return readers.scan_split(spark, path, schema, scratch_path(spark, f"split-{uuid.uuid4().hex}"), header=False)


def top_support(df: DataFrame, k: int = 10) -> DataFrame:
    return summarize.top_k_support(df, "name", k, value="dollar_price")
