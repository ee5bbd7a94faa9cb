"""The reference's workflow on its own kinds of input files, as Spark jobs.

``enrich_job``   fact CSV + wide GDP CSV + wide population CSV → enriched snapshot
                 (Parquet partitioned by year, and CSV) with missing income filled;
``profile_job``  the profile tables (describe, overview, top-k, yearly, buckets,
                 correlation, nulls);
``model_job``    hash split, MLlib ridge pipeline, metrics record (JSON);
``dashboard_job`` facet filter and the dashboard's result tables.

Every result is a DataFrame; only model coefficients reach the driver.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import bin_label
from ..operators import clean, distribution as D, enrich, link, model, reshape, select, summarize as S
from ..schemas import (CORR_COLS, DEFAULT_REGION, DESCRIBE_COLS, ESTIMATE_YEAR_MAX, ESTIMATE_YEAR_MIN,
                       EXCLUDED_NAMES, FUZZY_CUTOFF, GDP_BIN_EDGES, GDP_BIN_LABELS, GDP_SCALE, MODEL_FEATURES,
                       NAME_ALIASES, NO_DATA_LABEL, POP_SNAPSHOT_YEARS, REGION_BY_CODE)
from ..sources import readers, writers


def alias_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NAME_ALIASES, "alias string, target string")


def region_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGION_BY_CODE, "code string, region string")


def load_facts(spark: SparkSession, path: str) -> DataFrame:
    """Fact CSV of unknown column order: read as text, then the cleaning chain types it."""
    return clean.clean_facts(readers.scan_facts(spark, path, schema=None))


def population_estimate(spark: SparkSession, pop_path: str, lo: int = ESTIMATE_YEAR_MIN,
                        hi: int = ESTIMATE_YEAR_MAX, center: int | None = None) -> DataFrame:
    """(cca3, year, population_est) for every year in [lo, hi] from the snapshot columns."""
    wide, key, cols = readers.scan_wide_snapshots(spark, pop_path, POP_SNAPSHOT_YEARS)
    snaps = reshape.unpivot_snapshots(wide, key, cols, "population", "cca3")
    c = (lo + hi) // 2 if center is None else center
    fit = enrich.trend_fit(snaps, "cca3", "year", "population", c)
    return enrich.trend_extrapolate(fit, "cca3", lo, hi, floor=1.0, center=c, out="population_est")


def enrich_job(spark: SparkSession, facts_path: str, gdp_path: str | None = None, pop_path: str | None = None,
               out_dir: str | None = None, cutoff: float = FUZZY_CUTOFF, method: str = "levenshtein",
               zero_is_missing: bool = True) -> tuple[DataFrame, DataFrame]:
    """Clean the facts and, given both reference files, fill missing ``GDP_dollar``.

    GDP names are linked to the facts' codes (exact → alias → fuzzy), GDP is
    divided by the per-year population estimate (× 1e9, GDP is in billions), and
    the per-capita panel fills only null incomes.  Returns (enriched facts, link
    table).  With ``out_dir`` the snapshot is written as year-partitioned
    Parquet and CSV, in parallel.
    """
    facts = load_facts(spark, facts_path)
    links = spark.createDataFrame([], "name string, code string, tier string, score double")
    if gdp_path and pop_path:
        wide, years = readers.scan_wide_years(spark, gdp_path)
        gdp = reshape.unpivot_years(wide, "country_name", years, "gdp_billions")
        dictionary = facts.select("name", F.col("iso_a3").alias("code"))
        links = link.link_names(gdp.select(F.col("country_name").alias("name")), dictionary,
                                alias_frame(spark), cutoff, method)
        gdp_iso = link.apply_link(gdp, links, "country_name", "iso")
        # Every year of the facts gets an estimate, whatever the span.
        span = facts.agg(F.min("year").alias("lo"), F.max("year").alias("hi")).first()
        lo, hi = (ESTIMATE_YEAR_MIN, ESTIMATE_YEAR_MAX) if span["lo"] is None else (span["lo"], span["hi"])
        pop = population_estimate(spark, pop_path, lo, hi).withColumnRenamed("cca3", "iso")
        panel = enrich.join_panel(gdp_iso, pop, ["iso", "year"], "gdp_billions", "population_est",
                                  "gdp_per_capita", scale=GDP_SCALE)
        panel = enrich.unique_panel(panel, ["iso", "year"], "gdp_per_capita")
        filled = enrich.join_fill(facts, panel, ["iso_a3", "year"], ["iso", "year"], "gdp_per_capita")
        facts = enrich.fill_from(filled, "GDP_dollar", "gdp_per_capita", zero_is_missing)
    if out_dir:
        writers.sink_parquet(facts, os.path.join(out_dir, "enriched_snapshot.parquet"), partition_by=["year"],
                             cluster_by=["year", "date"])
        writers.sink_csv(facts, os.path.join(out_dir, "enriched_snapshot.csv"))
        facts = spark.read.parquet(os.path.join(out_dir, "enriched_snapshot.parquet"))
    return facts, links


def profile_job(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "describe": S.describe_numeric(df, DESCRIBE_COLS),
        "overview": S.overview(df),
        "top_high": S.top_k_entities(df, k=10),
        "top_low": S.top_k_entities(df, k=10, ascending=True),
        "yearly": S.yearly_stats(df),
        "buckets": S.bucket_counts(df),
        "pearson": D.pearson(df, "GDP_dollar", "dollar_price"),
        "corr_matrix": D.corr_matrix(df, CORR_COLS),
        "null_counts": S.null_counts(df),
        "snapshot_stats": S.snapshot_stats(df, "GDP_dollar"),
    }


def model_job(df: DataFrame, key: str, out_dir: str | None = None, ratio: float = 0.8,
              seed: int = 42) -> dict[str, DataFrame]:
    """Split by key hash, fit the ridge pipeline, evaluate; optionally write the metrics JSON."""
    frame = model.model_frame(df, MODEL_FEATURES, keep=[key])
    train, test = D.split_train_test(frame, key, ratio, seed)
    fitted = model.fit_price_model(train)
    pred = model.predict(fitted, test)
    metrics = model.eval_regression(pred)
    coef = model.model_coefficients(fitted, clean.existing(frame, MODEL_FEATURES))
    record = model.metrics_frame(metrics, coef)
    if out_dir:
        writers.sink_metrics(record, os.path.join(out_dir, "regression_metrics.json"))
    rows, limits = model.residual_frame(pred)
    return {"predictions": pred, "metrics": record, "coefficients": coef, "residuals": rows, "limits": limits}


def dashboard_frame(df: DataFrame, regions: DataFrame) -> DataFrame:
    df = clean.exclude_values(df, "name", EXCLUDED_NAMES)
    df = clean.map_with_default(df, "iso_a3", regions, "code", "region", "region", DEFAULT_REGION)
    return df.withColumn("gdp_level", bin_label("GDP_dollar", GDP_BIN_EDGES, GDP_BIN_LABELS, NO_DATA_LABEL))


def dashboard_job(df: DataFrame, years: tuple[int, int] | None = None, regions: list[str] | None = None,
                  bins: list[str] | None = None, selected: list[str] | None = None,
                  metric: str = "USD_raw", top_n: int = 20, snapshot_year: int | None = None) -> dict[str, DataFrame]:
    spark = df.sparkSession
    base = dashboard_frame(df, region_frame(spark))
    f = select.facet_filter(base, years, regions, bins)
    pts, line = D.scatter_snapshot(f, snapshot_year)
    out = {
        "options": select.facet_options(base),
        "kpis": S.kpi_summary(f),
        "map": S.map_frame(f),
        "ranking": S.top_bottom(f, "name", metric, top_n, is_index=(metric == "USD_raw")),
        "scatter_points": pts,
        "scatter_line": line,
    }
    if selected:
        out["timeline"] = S.entity_year_mean(select.filter_selected(f, "name", selected), value=metric, out=metric)
    return out
