"""Delay facts: zero fill, cause groups and rollups.

All rollups share one set of sums. Sums of sums are the same sums, so the month and
entity tables can be rolled up from the written day table, and the facts are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag import fixed
from skylag.functions import dates, measures

ZERO_FILLED = (
    fixed.TOTAL_DELAY,
    *(measures.cause_column(code) for code in fixed.CAUSE_CODES),
    fixed.DELAYED_FLIGHTS,
    fixed.DELAYED_FLIGHTS_15,
)
# output column: source column, summed in every rollup
FACT_SUMS = {
    "total_flights": fixed.FLIGHTS,
    "total_delay": fixed.TOTAL_DELAY,
    **{name: name for name in fixed.CAUSE_GROUPS},
    "delayed_flights": fixed.DELAYED_FLIGHTS,
    "delayed_flights_15": fixed.DELAYED_FLIGHTS_15,
}
ROLLED_SUMS = {name: name for name in FACT_SUMS}
ENTITY_KEYS = ("ENTITY_NAME", "ENTITY_TYPE")
DAILY_KEYS = (fixed.DATE, *ENTITY_KEYS)


def fill_zero(df: DataFrame, columns=ZERO_FILLED) -> DataFrame:
    """Null to 0 in number columns. `fillna` skips a text column silently, so that is an error."""
    texts = [
        f.name
        for f in df.schema.fields
        if f.name in columns and not isinstance(f.dataType, T.NumericType)
    ]
    if texts:
        raise TypeError(f"not numeric: {', '.join(texts)}")
    return df.fillna(0, subset=list(columns))


def prepare_facts(facts: DataFrame) -> DataFrame:
    """Facts with zero-filled delays, a date and the cause groups."""
    return (
        fill_zero(facts)
        .withColumn(fixed.DATE, dates.to_day("FLT_DATE"))
        .withColumns(measures.cause_rollup())
    )


def with_ratio_and_residual(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "delay_per_flight": measures.safe_ratio("total_delay", "total_flights"),
            "other_delay": measures.residual_cause(),
        }
    )


def delay_rollup(df: DataFrame, keys: list[str | Column], sums: dict[str, str]) -> DataFrame:
    """Seven sums per key, the delay per flight and the unexplained rest."""
    return with_ratio_and_residual(
        df.groupBy(*keys).agg(*[F.sum(source).alias(name) for name, source in sums.items()])
    )


def month_keys(date: str) -> list[Column]:
    return [F.year(date).alias("year"), F.month(date).alias("month")]


def daily(prepared: DataFrame) -> DataFrame:
    return delay_rollup(prepared, list(DAILY_KEYS), FACT_SUMS)


def monthly(prepared: DataFrame) -> DataFrame:
    return delay_rollup(prepared, month_keys(fixed.DATE), FACT_SUMS)


def by_entity(prepared: DataFrame) -> DataFrame:
    return delay_rollup(prepared, list(ENTITY_KEYS), FACT_SUMS)


def monthly_from_daily(daily_delays: DataFrame) -> DataFrame:
    return delay_rollup(daily_delays, month_keys(fixed.DATE), ROLLED_SUMS)


def by_entity_from_daily(daily_delays: DataFrame) -> DataFrame:
    return delay_rollup(daily_delays, list(ENTITY_KEYS), ROLLED_SUMS)


LEVELS = ("day", "month", "entity")


def all_levels(prepared: DataFrame) -> DataFrame:
    """Day, month and entity delays in one pass over the facts, one below another, told by `level`.

    Keys that a level does not have are null. Each fact is counted in three groups before the exchange;
    where days are few beside facts, rolling the other two up from the day table, as the batch job
    does, moves less. `level_table` gives one level with its own columns.
    """
    day, names = fixed.DATE, list(ENTITY_KEYS)
    keyed = prepared.withColumns({"year": F.year(day), "month": F.month(day)})
    keys = [day, *names, "year", "month"]
    sums = [F.sum(source).alias(name) for name, source in FACT_SUMS.items()]
    # a bit for each key, the first one highest: set where the key is not part of the level
    level = F.when(F.col("_level") == 0b00011, LEVELS[0]).when(F.col("_level") == 0b11100, LEVELS[1]).otherwise(LEVELS[2])
    grouped = keyed.groupingSets([[day, *names], ["year", "month"], names], *keys).agg(
        *sums, F.grouping_id(*keys).alias("_level")
    )
    return with_ratio_and_residual(grouped.withColumn("level", level).drop("_level"))


def level_table(levels: DataFrame, level: str) -> DataFrame:
    """One level of `all_levels` with the columns of its own table."""
    keys = {LEVELS[0]: DAILY_KEYS, LEVELS[1]: ("year", "month"), LEVELS[2]: ENTITY_KEYS}[level]
    return levels.filter(F.col("level") == level).select(*keys, *FACT_SUMS, "delay_per_flight", "other_delay")


def sort_daily(df: DataFrame) -> DataFrame:
    return df.orderBy(fixed.DATE, "ENTITY_NAME")


def sort_monthly(df: DataFrame) -> DataFrame:
    return df.orderBy("year", "month")


def rank_entities(df: DataFrame) -> DataFrame:
    """Largest total delay first; ties by name, so that the order is always the same."""
    return df.orderBy(F.desc("total_delay"), *ENTITY_KEYS)


def top_entities(df: DataFrame, k: int) -> DataFrame:
    return rank_entities(df).limit(k)


def cause_breakdown(filled: DataFrame, codes=fixed.CAUSE_CODES) -> DataFrame:
    """Total and share of each cause code.

    One pass sums all codes side by side; only that single row is turned into one row per
    code, so the facts are never multiplied.
    """
    totals = filled.agg(
        F.sum(fixed.TOTAL_DELAY).alias("grand_total"),
        *[F.sum(measures.cause_column(code)).alias(code) for code in codes],
    )
    mapped = {c: name for name, members in fixed.CAUSE_GROUPS.items() for c in members}
    group = F.create_map(*[F.lit(x) for pair in mapped.items() for x in pair])
    return totals.unpivot("grand_total", list(codes), "code", "delay").select(
        "code",
        F.coalesce(group[F.col("code")], F.lit("other_delay")).alias("cause_group"),
        "delay",
        measures.safe_ratio("delay", "grand_total").alias("share"),
    )


def delay_summary(prepared: DataFrame) -> DataFrame:
    """One row: mean delay per flight, and the explained and unexplained shares."""
    sums = with_ratio_and_residual(
        prepared.agg(*[F.sum(source).alias(name) for name, source in FACT_SUMS.items()])
    )
    return sums.select(
        "total_flights",
        "total_delay",
        "delay_per_flight",
        measures.safe_ratio(
            F.col("total_delay") - F.col("other_delay"), "total_delay"
        ).alias("mapped_share"),
        measures.safe_ratio("other_delay", "total_delay").alias("other_share"),
    )
