"""Rules as a table against plain substring search."""

import random

import pytest
from pyspark.sql import functions as F

from skylag import fixed
from skylag.functions import rules
from skylag.operators import rule_tables as R


def words(rng, n):
    return [
        "".join(rng.choices(["a", "b", "é", "ü", " ", "x", "\U0001F600"], k=rng.randrange(1, 9))) for _ in range(n)
    ]


@pytest.mark.parametrize("n", [1, 3, 4, 7])
def test_matches_are_those_of_a_plain_search(spark, n):
    rng = random.Random(n)
    texts = [(i, "".join(words(rng, 6))) for i in range(150)] + [(900, None), (901, ""), (902, "ab" * 200_000)]
    terms = sorted({w for w in words(rng, 80)})
    table = [(t, rng.randrange(20), f"r{t}") for t in terms] + [(None, 0, "null"), ("", 0, "empty")]
    df = spark.createDataFrame(texts, "id long, text string").repartition(3)
    rule_df = spark.createDataFrame(table, "term string, priority int, result string")
    got = sorted((r.id, r.term) for r in R.rule_matches(df, rule_df, "id", "text", n).collect())
    expected = sorted((i, t) for i, text in texts if text for t, _, _ in table if t and t in text)
    assert got == expected and expected
    best = {r.id: r.result for r in R.classify_by_table(df, rule_df, "id", "text", n=n).collect()}
    for i, text in texts:
        found = sorted((p, t.encode(), r) for t, p, r in table if t and t in (text or ""))
        assert best[i] == (found[0][2] if found else None)


def test_the_fixed_rules_give_the_same_as_the_case_expression(spark):
    terms = [t for _, ts in fixed.STATION_RULES for t in ts]
    texts = [(i, f"x{a} {b}y") for i, (a, b) in enumerate(zip(terms, reversed(terms)))] + [(999, "none")]
    df = spark.createDataFrame(texts, "id long, key string")
    for order in (fixed.STATION_RULES, rules.specific_first()):
        got = R.classify_by_table(df, R.rule_rows(spark, order), "id", "key", "station")
        plain = df.withColumn("station", rules.classify("key", order, strict_order=True))
        assert sorted(got.select("id", "station").collect()) == sorted(plain.select("id", "station").collect())


def test_shadowed_rules_are_those_of_the_list(spark):
    table = R.shadowed_rules(R.rule_rows(spark, fixed.STATION_RULES))
    assert sorted((r.term, r.earlier) for r in table.collect()) == sorted(rules.shadowed_terms())


def test_no_rules_and_no_texts(spark):
    df = spark.createDataFrame([(1, "abc")], "id long, text string")
    none = spark.createDataFrame([], "term string, priority int, result string")
    assert R.rule_matches(df, none, "id", "text").collect() == []
    assert [tuple(r) for r in R.classify_by_table(df, none, "id", "text").collect()] == [(1, "abc", None)]
    some = spark.createDataFrame([("b", 1, "r")], none.schema)
    assert R.rule_matches(df.limit(0), some, "id", "text").collect() == []


def test_the_plan_has_no_nested_loop(spark):
    df = spark.range(100).select("id", F.col("id").cast("string").alias("text"))
    some = spark.createDataFrame([("7", 1, "r"), ("42", 0, "s")], "term string, priority int, result string")
    plan = R.classify_by_table(df, some, "id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
