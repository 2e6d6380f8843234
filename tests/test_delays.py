import pytest
from pyspark.sql import functions as F

from skylag import fixed, schemas
from skylag.functions import measures
from skylag.operators import delays
from skylag.plans import views
from datetime import datetime

SF = "/root/testdata/sf0.001"


def fact(day, entity, flights, total, delayed=None, **causes):
    row = {f.name: None for f in schemas.DELAY_FACTS.fields}
    row.update(FLT_DATE=datetime(2025, *day), ENTITY_NAME=entity, ENTITY_TYPE="ANSP",
               FLT_ERT_1=flights, DLY_ERT_1=total, FLT_ERT_1_DLY=delayed)
    row.update({measures.cause_column(code): value for code, value in causes.items()})
    return row


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(
        [
            fact((1, 1), "A", 10, 100.0, 3, W=10.0, D=5.0, I=2.0, N=3.0, P=80.0),
            fact((1, 1), "A", 10, 20.0, None, C=1.0, S=2.0, T=3.0, R=4.0),
            fact((1, 2), "A", None, None, None),
            fact((2, 1), "B", 0, 7.0, 1, O=7.0),
        ],
        schemas.DELAY_FACTS,
    )


def test_daily(facts):
    rows = {(r.date.day, r.ENTITY_NAME): r for r in delays.daily(delays.prepare_facts(facts)).collect()}
    first = rows[(1, "A")] if rows[(1, "A")].date.month == 1 else None
    assert (first.total_flights, first.total_delay, first.weather_delay) == (20, 120.0, 15.0)
    assert (first.industrial_delay, first.atc_delay, first.other_delay) == (5.0, 10.0, 90.0)
    assert (first.delayed_flights, first.delayed_flights_15) == (3, 0)
    assert first.delay_per_flight == 6.0
    # flights are not filled: a group without any stays null and its ratio is 0
    empty = rows[(2, "A")]
    assert empty.total_flights is None and empty.total_delay == 0.0 and empty.delay_per_flight == 0.0
    assert rows[(1, "B")].delay_per_flight == 0.0


def test_fill_zero_refuses_text_columns(facts):
    with pytest.raises(TypeError, match="DLY_ERT_W_1"):
        delays.fill_zero(facts.withColumn("DLY_ERT_W_1", F.lit("3")))


def test_rollups_agree(spark):
    prepared = views.prepared(spark, SF)
    daily = delays.daily(prepared)
    for direct, from_daily in (
        (delays.monthly(prepared), delays.monthly_from_daily(daily)),
        (delays.by_entity(prepared), delays.by_entity_from_daily(daily)),
    ):
        assert sorted(direct.collect(), key=str) == sorted(from_daily.collect(), key=str)
    total = prepared.agg(F.sum(fixed.TOTAL_DELAY)).first()[0]
    assert daily.agg(F.sum("total_delay")).first()[0] == total


def test_parts_add_up_to_the_total(spark):
    daily = views.daily(spark, SF)
    off = daily.filter(
        F.col("weather_delay") + F.col("industrial_delay") + F.col("atc_delay") + F.col("other_delay")
        != F.col("total_delay")
    )
    assert off.count() == 0


def test_cause_breakdown(facts):
    rows = {r.code: r for r in delays.cause_breakdown(delays.fill_zero(facts)).collect()}
    assert set(rows) == set(fixed.CAUSE_CODES)
    assert rows["P"].delay == 80.0 and rows["P"].cause_group == "other_delay"
    assert rows["W"].share == 10.0 / 127.0 and rows["R"].cause_group == "atc_delay"
    assert rows["NA"].delay == 0.0


def test_ranking_and_top(facts):
    ranked = delays.top_entities(delays.by_entity(delays.prepare_facts(facts)), 1).collect()
    assert [r.ENTITY_NAME for r in ranked] == ["A"]


def test_summary(facts):
    row = delays.delay_summary(delays.prepare_facts(facts)).first()
    assert row.total_delay == 127.0 and row.mapped_share + row.other_share == pytest.approx(1)


def test_facts_plan_reads_needed_columns_once(spark):
    plan = delays.monthly(views.prepared(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 4  # lines and three dimensions
    assert "l_tax" not in plan and "l_partkey" not in plan
