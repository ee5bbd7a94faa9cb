"""Physical-plan properties the scale design relies on."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from priceframe.operators import distribution as D, link, select, summarize as S
from priceframe.plans import bindings as B, jobs as J


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_facet_filter_prunes_year_folders_and_pushes_dates(spark):
    p = _plan(J.dashboard_filtered(spark, SF_SMALL).select("obs_id", "year"))
    assert "PartitionFilters: [isnotnull(year" in p and "(year#" in p
    assert "GreaterThanOrEqual(date,1996-01-01)" in p and "LessThan(date,2000-01-01)" in p


def test_snapshot_scan_reads_only_needed_columns(spark):
    p = _plan(S.yearly_stats(B.facts_snapshot(spark, SF_SMALL)))
    assert "partial_avg" in p                       # map-side partial aggregation
    assert "adj_price" not in p.split("ReadSchema")[1].split("\n")[0]


def test_hot_key_selections_use_aggregates_not_windows(spark):
    f = B.facts_snapshot(spark, SF_SMALL)
    for df in (select.latest_per_entity(f, "enough"), S.kpi_summary(f)):
        p = _plan(df)
        assert "Window" not in p and "SortMergeJoin" not in p
    q, d, _ = J.link_inputs(spark, SF_SMALL)
    scored = link.fuzzy_candidates(link.query_keys(q), link.dictionary_keys(d), 0.88, "levenshtein")
    best = link.best_match(scored.withColumn("score", link.similarity(F.col("qkey"), F.col("dkey"))))
    assert "max_by" in _plan(best) and "CartesianProduct" not in _plan(best)


def test_one_row_statistics_are_scalar_subqueries(spark):
    li = B.table(spark, SF_SMALL, "lineitem")
    f = B.facts_snapshot(spark, SF_SMALL)
    for df in (D.histogram(li, "l_extendedprice"),
               D.kde_curve(li, "l_extendedprice"), select.latest_per_entity(f, "enough"), select.snapshot_at(f)):
        p = _plan(df)
        assert "Subquery" in p
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p and "SortMergeJoin" not in p


def test_exact_quartiles_do_not_hold_groups(spark):
    f = B.facts_snapshot(spark, SF_SMALL)
    p = _plan(D.quartiles(f, "dollar_price", "year"))
    assert "percentile(" not in p


def test_no_cross_joins_anywhere_in_the_catalog_plans(spark):
    import __spark_entry__ as E

    for name in ("kpi_summary", "link_names", "kde_curve", "box_stats", "join_fill", "latest_per_entity"):
        p = _plan(E.queries()[name](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_names_are_linked_from_written_tiers(spark):
    p = _plan(J.linked_names(spark, SF_SMALL))
    assert "part.parquet" not in p and "p_name" not in p   # names, dictionary and tiers are read from their files


def test_orders_are_joined_once_for_the_raw_facts(spark):
    p = B.raw_facts(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "o_custkey" not in p and "c_custkey" not in p   # both reads of the index are of the written panel


def test_broadcast_goes_by_bytes(spark):
    from priceframe.operators._util import broadcast_if_small

    df = spark.range(1000).toDF("k")
    hinted = lambda d: "hint" in d._jdf.queryExecution().analyzed().toString().lower()
    assert hinted(broadcast_if_small(df)) and not hinted(broadcast_if_small(df, 10))
