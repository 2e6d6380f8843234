"""Checked queries: delay rollups, weather, features, sorts, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from skylag import fixed
from skylag.functions import dates, keys, measures, rules, text
from skylag.operators import checks, delays, features, ranking, rule_tables, weather
from skylag.plans import sql_views as sv
from skylag.plans import views
from skylag.plans.registry import query, rounded, rounds

REGION = list(fixed.REGION_DAY_MEASURES)
STATION = list(fixed.STATION_DAY_MEASURES)
FEATURE = list(fixed.FALLBACK_FEATURES)
NOISY = REGION + FEATURE
DELAY_COLUMNS = (
    "total_flights, total_delay, weather_delay, industrial_delay, atc_delay, delayed_flights, "
    "delayed_flights_15, delay_per_flight, other_delay"
)
FEATURE_COLUMNS = (
    f"date, ENTITY_NAME, ENTITY_TYPE, {DELAY_COLUMNS}, weather_station_icao, "
    f"weather_station_name, {', '.join(STATION)}, weather_match_level, {rounds(NOISY)}"
)


# --- flagship ------------------------------------------------------------------------------


@query("daily_features", f"WITH {sv.FEATURES} SELECT {FEATURE_COLUMNS} FROM features")
def daily_features(spark, sf):
    return rounded(views.feature_rows(spark, sf), *NOISY)


@query(
    "daily_features_no_weather_level",
    f"""WITH {sv.FEATURES}
    SELECT date, ENTITY_NAME, ENTITY_TYPE,
           CASE WHEN weather_station_name IS NULL AND max_wind_gusts_europe IS NULL
                THEN 'no_weather' ELSE weather_match_level END AS weather_match_level
    FROM features""",
)
def no_weather_level(spark, sf):
    return views.feature_rows(spark, sf, name_missing_weather=True).select(
        "date", "ENTITY_NAME", "ENTITY_TYPE", "weather_match_level"
    )


# --- projections on facts ---------------------------------------------------------------------


@query(
    "fill_zero_subset",
    f"""WITH {sv.FACTS}
    SELECT date, ENTITY_NAME, FLT_ERT_1, DLY_ERT_1, W AS DLY_ERT_W_1, P AS DLY_ERT_P_1,
           CAST(0 AS DOUBLE) AS DLY_ERT_NA_1, dly AS FLT_ERT_1_DLY, dly15 AS FLT_ERT_1_DLY_15
    FROM prepared""",
)
def fill_zero_subset(spark, sf):
    return delays.fill_zero(views.facts(spark, sf)).select(
        dates.to_day("FLT_DATE").alias("date"), "ENTITY_NAME", "FLT_ERT_1", "DLY_ERT_1",
        "DLY_ERT_W_1", "DLY_ERT_P_1", "DLY_ERT_NA_1", "FLT_ERT_1_DLY", "FLT_ERT_1_DLY_15",
    )


@query(
    "cause_rollup",
    f"""WITH {sv.FACTS}
    SELECT date, ENTITY_NAME, DLY_ERT_1, W + D AS weather_delay, I + N AS industrial_delay,
           C AS atc_delay FROM prepared""",
)
def cause_rollup(spark, sf):
    return views.prepared(spark, sf).select(
        "date", "ENTITY_NAME", "DLY_ERT_1", *fixed.CAUSE_GROUPS
    )


@query(
    "safe_ratio",
    f"""WITH {sv.FACTS}
    SELECT date, ENTITY_NAME, FLT_ERT_1, DLY_ERT_1,
           CASE WHEN FLT_ERT_1 > 0 THEN DLY_ERT_1 / FLT_ERT_1 ELSE 0.0 END AS delay_per_flight
    FROM prepared""",
)
def safe_ratio(spark, sf):
    return delays.fill_zero(views.facts(spark, sf)).select(
        dates.to_day("FLT_DATE").alias("date"), "ENTITY_NAME", "FLT_ERT_1", "DLY_ERT_1",
        measures.safe_ratio("DLY_ERT_1", "FLT_ERT_1").alias("delay_per_flight"),
    )


@query(
    "residual_cause",
    f"""WITH {sv.FACTS}
    SELECT date, ENTITY_NAME, DLY_ERT_1, DLY_ERT_1 - (W + D + I + N + C) AS other_delay
    FROM prepared""",
)
def residual_cause(spark, sf):
    return views.prepared(spark, sf).select(
        "date", "ENTITY_NAME", "DLY_ERT_1", measures.residual_cause("DLY_ERT_1").alias("other_delay")
    )


@query(
    "column_select_rename",
    f"""WITH {sv.STATION_DAYS}
    SELECT date, icao AS weather_station_icao, airport AS weather_station_name,
           {', '.join(STATION)} FROM station_days""",
)
def column_select_rename(spark, sf):
    return features.local_weather(views.station_days(spark, sf))


@query(
    "required_columns",
    "SELECT o_orderkey, o_orderdate FROM orders",
)
def required_columns(spark, sf):
    orders = checks.required_columns(views.table(spark, sf, "orders"), "o_orderkey", "o_orderdate")
    return orders.select("o_orderkey", "o_orderdate")


# --- rollups ------------------------------------------------------------------------------------


@query("daily_entity_delay", f"WITH {sv.DAILY} SELECT * FROM daily")
def daily_entity_delay(spark, sf):
    return views.daily(spark, sf)


MONTHLY_SQL = f"""WITH {sv.FACTS}
SELECT * FROM ({sv.rollup(
    "CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month",
    "year(date), month(date)")})"""
ENTITY_SQL = f"WITH {sv.FACTS} SELECT * FROM ({sv.rollup('ENTITY_NAME, ENTITY_TYPE')})"


@query("monthly_delay", MONTHLY_SQL)
def monthly_delay(spark, sf):
    return delays.monthly(views.prepared(spark, sf))


@query("monthly_delay_from_daily", MONTHLY_SQL)
def monthly_delay_from_daily(spark, sf):
    return delays.monthly_from_daily(views.daily(spark, sf))


@query(
    "delay_levels",
    " UNION ALL BY NAME ".join([
        f"SELECT 'day' AS level, * FROM (WITH {sv.DAILY} SELECT * FROM daily)", f"SELECT 'month' AS level, * FROM ({MONTHLY_SQL})",
        f"SELECT 'entity' AS level, * FROM ({ENTITY_SQL})",
    ]),
)
def delay_levels(spark, sf):
    """Day, month and entity delays by one pass over the facts."""
    return delays.all_levels(views.prepared(spark, sf))


@query("entity_delay_ranking", f"{ENTITY_SQL} ORDER BY total_delay DESC, 1, 2")
def entity_delay_ranking(spark, sf):
    return delays.rank_entities(delays.by_entity(views.prepared(spark, sf)))


@query("entity_delay_from_daily", ENTITY_SQL)
def entity_delay_from_daily(spark, sf):
    return delays.by_entity_from_daily(views.daily(spark, sf))


@query(
    "cause_breakdown",
    f"""WITH {sv.FACTS},
    totals AS (
      SELECT sum(DLY_ERT_1) AS grand_total, sum(W) AS W, sum(D) AS D, sum(I) AS I, sum(N) AS N,
             sum(C) AS C, sum(P) AS P,
             {', '.join(f'CAST(0 AS DOUBLE) AS {c}' for c in
                        ('A', 'E', 'G', 'M', 'O', 'R', 'S', 'T', 'V', 'NA'))}
      FROM prepared)
    SELECT code,
           CASE WHEN code IN ('W', 'D') THEN 'weather_delay'
                WHEN code IN ('I', 'N') THEN 'industrial_delay'
                WHEN code IN ('C', 'S', 'T', 'R') THEN 'atc_delay' ELSE 'other_delay' END
             AS cause_group,
           delay, CASE WHEN grand_total > 0 THEN delay / grand_total ELSE 0.0 END AS share
    FROM (UNPIVOT totals ON A, C, D, E, G, I, M, N, O, P, R, S, T, V, W, NA
          INTO NAME code VALUE delay)""",
)
def cause_breakdown(spark, sf):
    return delays.cause_breakdown(delays.fill_zero(views.facts(spark, sf)))


@query(
    "delay_summary",
    f"""WITH {sv.FACTS}
    SELECT total_flights, total_delay, total_delay / total_flights AS delay_per_flight,
           mapped / total_delay AS mapped_share, (total_delay - mapped) / total_delay
             AS other_share
    FROM (SELECT CAST(sum(FLT_ERT_1) AS BIGINT) AS total_flights, sum(DLY_ERT_1) AS total_delay,
                 sum(W + D + I + N + C) AS mapped FROM prepared)""",
)
def delay_summary(spark, sf):
    return delays.delay_summary(views.prepared(spark, sf))


# --- weather --------------------------------------------------------------------------------------


@query(
    "hour_key",
    f"""WITH {sv.HOURLY}
    SELECT icao, CAST(time AS DATE) AS date, CAST(hour(time) AS INTEGER) AS hour,
           icao || '|' || strftime(time, '%Y-%m-%d') || '|' || strftime(time, '%H')
             AS weather_join_key, temperature_2m
    FROM hourly""",
)
def hour_key(spark, sf):
    return weather.hourly_keyed(views.hourly(spark, sf)).select(
        "icao", "date", "hour", "weather_join_key", "temperature_2m"
    )


@query("station_day_weather", f"WITH {sv.STATION_DAYS} SELECT * FROM station_days")
def station_day_weather(spark, sf):
    return views.station_days(spark, sf)


@query(
    "europe_day_weather",
    f"WITH {sv.REGION_DAYS} SELECT date, {rounds(REGION)} FROM region_days",
)
def europe_day_weather(spark, sf):
    return rounded(views.region_days(spark, sf))


@query(
    "sort_weather",
    f"WITH {sv.STATION_DAYS} SELECT * FROM station_days ORDER BY icao, date, airport",
)
def sort_weather(spark, sf):
    return weather.sort_station_days(views.station_days(spark, sf))


@query(
    "sort_region_weather",
    f"WITH {sv.REGION_DAYS} SELECT date, {rounds(REGION)} FROM region_days ORDER BY date",
)
def sort_region_weather(spark, sf):
    return rounded(weather.sort_region_days(views.region_days(spark, sf)))


# --- station assignment and joins ---------------------------------------------------------------------


@query(
    "ordered_rule_classify",
    f"""WITH {sv.DAILY}
    SELECT date, ENTITY_NAME, ENTITY_TYPE, {sv.NATION_CASE} AS weather_station_icao FROM daily""",
)
def ordered_rule_classify(spark, sf):
    return features.assign_station(views.daily(spark, sf), views.NATION_RULES).select(
        "date", "ENTITY_NAME", "ENTITY_TYPE", "weather_station_icao"
    )


@query(
    "ordered_rule_classify_strict",
    f"""WITH {sv.DAILY}
    SELECT date, ENTITY_NAME, ENTITY_TYPE, {sv.NATION_CASE_STRICT} AS weather_station_icao
    FROM daily""",
)
def ordered_rule_classify_strict(spark, sf):
    assigned = features.assign_station(views.daily(spark, sf), views.NATION_RULES, True)
    return assigned.select("date", "ENTITY_NAME", "ENTITY_TYPE", "weather_station_icao")


def _rules_case(ordered) -> str:
    return "\n".join(
        "WHEN " + " OR ".join(f"contains(key, '{t}')" for t in terms) + f" THEN '{code}'"
        for code, terms in ordered
    )


# the one rule the list order shadows, moved ahead of the rule that shadows it
_CORRECTED = [r for r in fixed.STATION_RULES if r[0] != "UKBB"]
_CORRECTED.insert([r[0] for r in _CORRECTED].index("EGLL"), ("UKBB", ("ukraine",)))


STATION_TEXTS_SQL = f"""SELECT doc_id, CASE {_rules_case(_CORRECTED)} END AS station,
               CASE {_rules_case(fixed.STATION_RULES)} END AS station_strict
        FROM (SELECT doc_id, lower(trim(text)) AS key FROM documents)"""


@query("station_rules_on_texts", STATION_TEXTS_SQL)
def station_rules_on_texts(spark, sf):
    """The whole rule table against whole texts."""
    keyed = views.table(spark, sf, "documents").select("doc_id", text.normalise("text").alias("key"))
    return keyed.select(
        "doc_id",
        rules.classify("key").alias("station"),
        rules.classify("key", strict_order=True).alias("station_strict"),
    )


@query("station_rules_by_index", STATION_TEXTS_SQL)
def station_rules_by_index(spark, sf):
    """The same rules as a table, in both orders by one search of the texts."""
    keyed = views.table(spark, sf, "documents").select("doc_id", text.normalise("text").alias("key"))
    listed = rule_tables.rule_rows(spark, fixed.STATION_RULES)
    ordered = rule_tables.rule_rows(spark, rules.specific_first()).select("term", F.col("priority").alias("first"))
    found = rule_tables.rule_matches(keyed, listed.join(ordered, "term"), "doc_id", "key")
    best = found.groupBy("doc_id").agg(
        F.min_by("result", "first").alias("station"), F.min_by("result", "priority").alias("station_strict")
    )
    return keyed.select("doc_id").join(best, "doc_id", "left")


# terms of two tables: pieces of passages that documents repeat, and names that none has
TABLE_RULES_SQL = """rules AS (
  SELECT term, min(priority) AS priority, arg_min(result, priority) AS result FROM (
    SELECT substr(lower(text), 5, 8) AS term, item_id AS priority, 'passage ' || item_id AS result FROM benchmark
    UNION ALL SELECT lower(p_name), 1000000 + p_partkey, 'part ' || p_partkey FROM part)
  GROUP BY term)"""


def table_rules(spark, sf):
    passages = views.table(spark, sf, "benchmark").select(
        F.substring(F.lower("text"), 5, 8).alias("term"), F.col("item_id").alias("priority"),
        F.concat(F.lit("passage "), F.col("item_id").cast("string")).alias("result"),
    )
    parts = views.table(spark, sf, "part").select(
        F.lower("p_name").alias("term"), (F.col("p_partkey") + 1000000).alias("priority"),
        F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("result"),
    )
    rows = passages.unionByName(parts)
    return rows.groupBy("term").agg(
        F.min("priority").alias("priority"), F.min_by("result", "priority").alias("result")
    )


@query(
    "rules_from_table",
    f"""WITH {TABLE_RULES_SQL},
    texts AS (SELECT doc_id, lower(trim(text)) AS key FROM documents),
    found AS (SELECT doc_id, arg_min(result, priority) AS result
              FROM texts JOIN rules ON contains(key, term) GROUP BY doc_id)
    SELECT doc_id, result FROM texts LEFT JOIN found USING (doc_id)""",
)
def rules_from_table(spark, sf):
    """The first rule of a table, which may have any number of them, whose term is in the text."""
    keyed = views.table(spark, sf, "documents").select("doc_id", text.normalise("text").alias("key"))
    return rule_tables.classify_by_table(keyed, table_rules(spark, sf), "doc_id", "key").select("doc_id", "result")


@query(
    "rule_matches",
    f"""WITH {TABLE_RULES_SQL}
    SELECT doc_id, term, priority, result FROM (SELECT doc_id, lower(trim(text)) AS key FROM documents)
    JOIN rules ON contains(key, term)""",
)
def rule_matches(spark, sf):
    """Every pair of a text and a rule whose term it contains."""
    keyed = views.table(spark, sf, "documents").select("doc_id", text.normalise("text").alias("key"))
    return rule_tables.rule_matches(keyed, table_rules(spark, sf), "doc_id", "key")


@query(
    "text_normalise",
    "SELECT doc_id, md5(lower(trim(text))) AS clean, length(lower(trim(text))) AS n FROM documents",
)
def text_normalise(spark, sf):
    clean = text.normalise("text")
    return views.table(spark, sf, "documents").select(
        "doc_id", F.md5(clean.cast("binary")).alias("clean"), F.length(clean).cast("bigint").alias("n")
    )


@query(
    "station_weather_left_join",
    f"""WITH {sv.FEATURES}
    SELECT date, ENTITY_NAME, ENTITY_TYPE, total_delay, weather_station_icao,
           weather_station_name, {', '.join(STATION)} FROM joined""",
)
def station_weather_left_join(spark, sf):
    assigned = features.assign_station(views.daily(spark, sf), views.NATION_RULES)
    return features.join_station_weather(assigned, views.station_days(spark, sf)).select(
        "date", "ENTITY_NAME", "ENTITY_TYPE", "total_delay", "weather_station_icao",
        "weather_station_name", *STATION,
    )


@query(
    "europe_weather_left_join",
    f"""WITH {sv.FEATURES}
    SELECT date, ENTITY_NAME, ENTITY_TYPE, total_delay, {rounds(REGION)} FROM joined""",
)
def europe_weather_left_join(spark, sf):
    joined = features.join_region_weather(views.daily(spark, sf), views.region_days(spark, sf))
    return rounded(
        joined.select("date", "ENTITY_NAME", "ENTITY_TYPE", "total_delay", *REGION), *REGION
    )


@query(
    "coalesce_fallback",
    f"WITH {sv.FEATURES} SELECT date, ENTITY_NAME, ENTITY_TYPE, {rounds(FEATURE)} FROM features",
)
def coalesce_fallback(spark, sf):
    return rounded(
        views.feature_rows(spark, sf).select("date", "ENTITY_NAME", "ENTITY_TYPE", *FEATURE)
    )


@query(
    "match_level",
    f"""WITH {sv.FEATURES}
    SELECT date, ENTITY_NAME, ENTITY_TYPE, weather_match_level FROM features""",
)
def match_level(spark, sf):
    return views.feature_rows(spark, sf).select(
        "date", "ENTITY_NAME", "ENTITY_TYPE", "weather_match_level"
    )


@query(
    "match_quality_count",
    f"WITH {sv.FEATURES} SELECT weather_match_level, count(*) AS count FROM features GROUP BY 1",
)
def match_quality_count(spark, sf):
    return features.match_quality(views.feature_rows(spark, sf))


# --- sorts, limits, sets ----------------------------------------------------------------------------------


@query("sort_daily", f"WITH {sv.DAILY} SELECT * FROM daily ORDER BY date, ENTITY_NAME")
def sort_daily(spark, sf):
    return delays.sort_daily(views.daily(spark, sf))


@query("sort_monthly", f"{MONTHLY_SQL} ORDER BY year, month")
def sort_monthly(spark, sf):
    return delays.sort_monthly(delays.monthly(views.prepared(spark, sf)))


@query("top_entities", f"{ENTITY_SQL} ORDER BY total_delay DESC, 1, 2 LIMIT 10")
def top_entities(spark, sf):
    return delays.top_entities(delays.by_entity(views.prepared(spark, sf)), 10)


@query(
    "sample_show",
    f"""WITH {sv.DAILY} SELECT date, ENTITY_NAME, total_delay FROM daily
    ORDER BY date, ENTITY_NAME, ENTITY_TYPE LIMIT 20""",
)
def sample_show(spark, sf):
    return ranking.sample_rows(
        views.daily(spark, sf), "date", "ENTITY_NAME", "ENTITY_TYPE"
    ).select("date", "ENTITY_NAME", "total_delay")


@query(
    "union_by_name",
    """SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE year(o_orderdate) < 1998
    UNION ALL BY NAME
    SELECT o_orderdate, o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) >= 1997""",
)
def union_by_name(spark, sf):
    """Two overlapping year ranges in different column order; rows in both stay twice."""
    orders = views.table(spark, sf, "orders")
    year = F.year("o_orderdate")
    early = orders.filter(year < 1998).select("o_orderkey", "o_totalprice", "o_orderdate")
    late = orders.filter(year >= 1997).select("o_orderdate", "o_orderkey", "o_totalprice")
    return early.unionByName(late)


@query("distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem")
def distinct(spark, sf):
    return (
        views.table(spark, sf, "lineitem")
        .select("l_returnflag", "l_linestatus", "l_quantity").distinct()
    )


@query(
    "distinct_dates",
    "SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem ORDER BY date",
)
def distinct_dates(spark, sf):
    return (
        views.table(spark, sf, "lineitem")
        .select(dates.to_day("l_shipdate").alias("date")).distinct().orderBy("date")
    )


@query(
    "record_limit",
    """SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id LIMIT 500""",
)
def record_limit(spark, sf):
    return ranking.limit_records(
        views.table(spark, sf, "events"), 500, "ts", "event_id"
    ).select("event_id", "ts", "event_type")


@query(
    "record_limit_half",
    """SELECT event_id, event_type FROM events
       QUALIFY row_number() OVER (ORDER BY ts, event_id) <= (SELECT count(*) // 2 FROM events)""",
)
def record_limit_half(spark, sf):
    """A limit that grows with the table."""
    events = views.table(spark, sf, "events")
    return ranking.limit_records(events, events.count() // 2, "ts", "event_id").select(
        "event_id", "event_type"
    )


# --- scalar functions -----------------------------------------------------------------------------------------


@query(
    "to_date",
    """SELECT event_id, CAST(ts AS DATE) AS date,
              CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS date_of_text
       FROM events""",
)
def to_date(spark, sf):
    written = F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return views.events(spark, sf).select(
        "event_id",
        dates.to_day("ts").alias("date"),
        dates.to_day(written.otherwise(F.lit("2024-13-45"))).alias("date_of_text"),
    )


@query(
    "year_month",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
              CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
)
def year_month(spark, sf):
    return views.table(spark, sf, "orders").select("o_orderkey", *delays.month_keys("o_orderdate"))


@query(
    "calendar_features",
    """SELECT o_orderkey, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week,
              CAST(month(o_orderdate) AS INTEGER) AS month_of_year,
              CAST(day(o_orderdate) AS INTEGER) AS day_of_month,
              CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year FROM orders""",
)
def calendar_features(spark, sf):
    columns = dates.calendar_features("o_orderdate")
    return views.table(spark, sf, "orders").withColumns(columns).select("o_orderkey", *columns)


@query(
    "iso_floor",
    f"""WITH {sv.METAR}
    SELECT event_id, CASE WHEN event_type <> 'signup' THEN CAST(ts AS DATE) END AS date,
           observation_hour AS hour FROM metar""",
)
def iso_floor(spark, sf):
    e = views.events(spark, sf)
    raw = views.metar(e).select("raw_text", "observation_time")
    return raw.select(
        F.split("raw_text", " ")[1].cast("bigint").alias("event_id"),
        dates.iso_date("observation_time").alias("date"),
        dates.iso_hour("observation_time").alias("hour"),
    )


@query(
    "metar_join_key",
    f"""WITH {sv.METAR}
    SELECT raw_text,
           station_id || '|' || coalesce(observation_date, '') || '|'
             || coalesce(observation_hour, '') AS join_key,
           coalesce(station_id, 'None') || '|' || coalesce(observation_date, '') || '|'
             || coalesce(observation_hour, '') AS join_key_word
    FROM metar""",
)
def metar_join_key(spark, sf):
    raw = views.metar(views.events(spark, sf))
    day = dates.iso_date("observation_time")
    hour = dates.iso_hour("observation_time")
    return raw.select(
        "raw_text",
        keys.metar_join_key("station_id", day, hour).alias("join_key"),
        keys.metar_join_key("station_id", day, hour, "None").alias("join_key_word"),
    )


@query(
    "dedup_key",
    f"""WITH {sv.METAR}
    SELECT raw_text, coalesce(station_id, 'None') || '|' || observation_time AS dedup_key
    FROM metar""",
)
def dedup_key(spark, sf):
    return views.metar(views.events(spark, sf)).select(
        "raw_text", keys.dedup_key("station_id", "observation_time").alias("dedup_key")
    )


@query(
    "first_non_empty_key",
    f"""WITH {sv.FEED}
    SELECT event_id, coalesce(nullif(flight_iata, ''), flight_icao, flight_number,
             nullif(dep_iata, ''), departure_iata, arr_iata, arrival_iata, 'unknown-flight')
             AS flight_key FROM feed""",
)
def first_non_empty_key(spark, sf):
    return views.flights_feed(views.events(spark, sf)).select(
        "event_id", keys.flight_key().alias("flight_key")
    )


@query(
    "lenient_int",
    f"""WITH {sv.FEED}
    SELECT event_id, CASE event_type WHEN 'click' THEN whole WHEN 'view' THEN 0 END AS delay,
           CASE event_type WHEN 'view' THEN CAST(k AS BIGINT) END AS dep_delay,
           CASE event_type WHEN 'purchase' THEN -whole END AS arrival_delay FROM feed""",
)
def lenient_int(spark, sf):
    return views.flights_feed(views.events(spark, sf)).select(
        "event_id",
        *[measures.lenient_int(c).alias(c) for c in ("delay", "dep_delay", "arrival_delay")],
    )


@query(
    "delay_minutes_pick",
    f"WITH {sv.FEED} SELECT event_id, CAST(minutes AS BIGINT) AS minutes FROM feed_ok",
)
def delay_minutes_pick(spark, sf):
    return views.flights_feed(views.events(spark, sf)).select(
        "event_id",
        measures.delay_minutes("delay", "dep_delay", "arrival_delay", "delay_minutes").alias(
            "minutes"
        ),
    )


@query(
    "lenient_bool",
    """SELECT event_id,
              CASE k % 10 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false
                          WHEN 4 THEN true WHEN 5 THEN false WHEN 6 THEN true
                          WHEN 7 THEN false WHEN 8 THEN NULL END AS has_more
       FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
    """,
)
def lenient_bool(spark, sf):
    """Every event carries one of ten payload forms."""
    variants = [
        '{"has_more": true}', '{"has_more": 0}', '{"request": {"has_more": 2.5}}',
        '{"has_more": "maybe", "request": {"has_more": " No "}}', '{"response": {"has_more": "Y"}}',
        '{"response": {"request": {"has_more": "n"}}}', '{"has_more": null, "response": '
        '{"request": {"has_more": 1}}}', '{"has_more": "0"}', '{"has_more": "2"}', '{"has_more": tru',
    ]
    number = F.col("k") % 10
    payload = F.lit(None).cast("string")
    for n, variant in enumerate(variants):
        payload = F.when(number == n, F.lit(variant)).otherwise(payload)
    return (
        views.events(spark, sf)
        .select("event_id", payload.alias("payload"))
        .select("event_id", text.has_more("payload").alias("has_more"))
    )


@query(
    "epoch_hhmm",
    """SELECT event_id, CASE WHEN event_type = 'error' OR event_type = 'view' THEN 'Brak'
              ELSE strftime(ts, '%H:%M') END AS at FROM events""",
)
def epoch_hhmm(spark, sf):
    seconds = F.unix_timestamp("ts")
    kind = F.col("event_type")
    return views.events(spark, sf).select(
        "event_id",
        dates.epoch_hhmm(
            F.when(kind == "error", F.lit(0).cast("bigint")).when(kind != "view", seconds)
        ).alias("at"),
    )


@query(
    "date_chunks",
    """SELECT o_orderkey, CAST(s AS DATE) AS chunk_start,
              least(CAST(s AS DATE) + 29, last) AS chunk_end
       FROM (SELECT o_orderkey, first, last,
                    unnest(generate_series(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP),
                           INTERVAL 30 DAY)) AS s
             FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS first,
                          CAST(o_orderdate AS DATE) + CAST(o_custkey % 100 AS INTEGER) AS last
                   FROM orders))""",
)
def date_chunks(spark, sf):
    ranges = views.table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("first"),
        F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_custkey") % 100).cast("int")).alias(
            "last"
        ),
    )
    return ranges.select(
        "o_orderkey", F.explode(dates.date_chunks("first", "last", 30)).alias("chunk")
    ).select("o_orderkey", "chunk.chunk_start", "chunk.chunk_end")


@query(
    "end_cap_today",
    """SELECT o_orderkey, least(CAST(o_orderdate AS DATE) + 10227, current_date) AS capped
       FROM orders""",
)
def end_cap_today(spark, sf):
    shifted = F.date_add(F.col("o_orderdate").cast("date"), 10227)
    return views.table(spark, sf, "orders").select(
        "o_orderkey", dates.end_cap_today(shifted).alias("capped")
    )


@query(
    "date_series_paths",
    """SELECT o_orderkey, 'base/events/' || strftime(s, '%Y%m%d') || '.export.CSV.zip' AS path
       FROM (SELECT o_orderkey, unnest(generate_series(o_orderdate, o_orderdate
                      + to_days(CASE WHEN o_orderstatus = 'P' THEN 0
                                     ELSE CAST(o_custkey % 5 AS INTEGER) END),
                      INTERVAL 1 DAY)) AS s FROM orders)""",
)
def date_series_paths(spark, sf):
    first = F.col("o_orderdate").cast("date")
    last = F.when(
        F.col("o_orderstatus") != "P", F.date_add(first, (F.col("o_custkey") % 5).cast("int"))
    )
    paths = dates.date_series_paths(first, last, "base/events/")
    return views.table(spark, sf, "orders").select("o_orderkey", F.explode(paths).alias("path"))
