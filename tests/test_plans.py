"""Plans: what is read, what is pushed down, where rows are exchanged."""

import re

import pytest
from pyspark.sql import functions as F

from skylag.operators import delays, weather
from skylag.plans import catalog, views
from skylag.session import CLUSTER_CONF
from skylag.streaming import jobs, runs

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange (?!RoundRobin|Broadcast)\w*partitioning", plan(df)))


def test_filters_and_columns_reach_the_scan(spark):
    rows = catalog.QUERIES["parquet_scan"](spark, SF)
    text = plan(rows.filter(F.col("l_orderkey") >= 1000))
    assert "GreaterThanOrEqual(l_orderkey,1000)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_linenumber:int" in text or (
        "l_extendedprice" not in text
    )
    text = plan(catalog.QUERIES["date_cutoff_filter"](spark, SF))
    assert "LessThan(o_orderdate" in text and "GreaterThanOrEqual(o_orderdate" in text


@pytest.mark.parametrize("rollup", [delays.daily, delays.monthly, delays.by_entity])
def test_a_rollup_has_one_exchange_after_partial_sums(spark, rollup):
    df = rollup(views.prepared(spark, SF))
    assert exchanges(df) == 1 and "partial_sum" in plan(df)


def test_station_days_have_one_exchange(spark):
    assert exchanges(weather.station_day(views.hourly(spark, SF))) == 1


def test_projections_have_none(spark):
    for name in ("safe_ratio", "iso_floor", "lenient_int", "feed_payload_normalise", "board_json_flatten",
                 "station_rules_on_texts", "date_chunks", "columnar_json_to_rows"):
        assert exchanges(catalog.QUERIES[name](spark, SF)) == 0, name


def test_no_python_in_plans(spark):
    for name in ("daily_features", "feed_payload_normalise", "tsv61_scan", "board_json_flatten"):
        assert "Python" not in plan(catalog.QUERIES[name](spark, SF)), name


def test_top_k_keeps_only_k_rows(spark):
    assert "TakeOrderedAndProject" in plan(catalog.QUERIES["top_entities"](spark, SF))


def test_cluster_state_store(spark, path):
    """The state store that cluster sessions use gives the same de-duplication."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.range(200).select(
        (F.col("id") % 9).alias("k"), F.timestamp_seconds(F.lit(1777593600) + F.col("id") % 9).alias("ts")
    ).write.parquet(f"{path}/in")
    stream = spark.readStream.schema("k bigint, ts timestamp").parquet(f"{path}/in")
    spark.conf.set(name, CLUSTER_CONF[name])
    try:
        assert runs.run_bounded(jobs.drop_repeats(stream, "k", "ts")).count() == 9
    finally:
        spark.conf.set(name, before)


def test_a_limit_takes_its_bound_from_the_order_columns(spark, path):
    from skylag.operators import ranking

    rows = spark.range(60_000).select(
        (F.col("id") * 7919 % 60_000).alias("id"), F.when(F.col("id") % 1000 > 0, F.col("id") % 50).alias("ts"), F.lit("x" * 50).alias("payload")
    )
    rows.write.parquet(f"{path}/t")
    table = spark.read.parquet(f"{path}/t")
    expected = sorted(((r.ts is not None, r.ts, r.id) for r in table.collect()), key=lambda v: (v[0], v[1] or 0, v[2]))
    for n in (1, 40, 3_000, 59_999, 60_000, 70_000):
        got = ranking.limit_records(table, n, "ts", "id").collect()
        assert sorted(((r.ts is not None, r.ts, r.id) for r in got), key=lambda v: (v[0], v[1] or 0, v[2])) == expected[:n]
    bound = ranking._bound(table, 3_000, ["ts", "id"])
    kept = table.filter(ranking._until(table, ["ts", "id"], bound))
    assert 3_000 <= kept.count() < 9_000
    assert "PushedFilters: [Or(IsNull(ts),LessThanOrEqual(ts" in kept._jdf.queryExecution().executedPlan().toString()


def test_a_scan_reads_the_columns_asked_for_and_pushes_filters(spark):
    from skylag.plans import queries_sources

    rows = queries_sources.parquet_scan(spark, "/root/testdata/sf0.001")
    plan = rows.filter("l_quantity > 40")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:" in plan and "l_extendedprice" not in plan
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40" in plan
