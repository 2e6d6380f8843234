"""The test tables seen as delay facts, hourly weather, observations, feeds and boards.

Values are whole numbers or halves, so sums do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag import fixed
from skylag.functions import measures
from skylag.operators import delays, features, weather
from skylag.session import written

# Substring rules over the nation names. "_12" comes after "_1", which is part of it.
NATION_RULES = (
    ("click", ("_1",)),
    ("error", ("_20", "_21")),
    ("view", ("_12",)),
    ("purchase", ("_3",)),
    ("nowhere", ("_4",)),
)
# (return flag, line status): cause code
CAUSE_OF_FLAGS = {
    ("A", "F"): "W", ("A", "O"): "D", ("N", "F"): "I",
    ("N", "O"): "N", ("R", "F"): "C", ("R", "O"): "P",
}
# from the first day of events (2024-01-01) to a day inside the shipments (1998-01-01)
WEATHER_SHIFT_DAYS = 9496


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delay facts. The dimensions are joined one by one, so each is broadcast by its own size."""
    lines = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    minutes = F.floor("l_extendedprice").cast("double")
    flights = F.col("l_quantity").cast("bigint")
    causes = {code: None for code in fixed.CAUSE_CODES}
    for (flag, status), code in CAUSE_OF_FLAGS.items():
        causes[code] = F.when(
            (F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status), minutes
        )
    return (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("l_shipdate").cast("timestamp").alias("FLT_DATE"),
            F.col("n_name").alias("ENTITY_NAME"),
            F.col("r_name").alias("ENTITY_TYPE"),
            F.nullif(flights - 1, F.lit(49).cast("bigint")).alias(fixed.FLIGHTS),
            minutes.alias(fixed.TOTAL_DELAY),
            *[
                (F.lit(None).cast("double") if value is None else value).alias(
                    measures.cause_column(code)
                )
                for code, value in causes.items()
            ],
            F.when(F.col("l_discount") >= 0.03, flights).alias(fixed.DELAYED_FLIGHTS),
            F.when(F.col("l_discount") >= 0.06, flights).alias(fixed.DELAYED_FLIGHTS_15),
        )
    )


def prepared(spark, sf_dir):
    return delays.prepare_facts(facts(spark, sf_dir))


def daily(spark, sf_dir):
    return delays.daily(prepared(spark, sf_dir))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Small rows dealt to twice as many tasks as there are cores, before each grows to a long text.

    A compressed table has few splits, or one more than there are cores, so that a few tasks would
    write and parse all texts; a .gz file that such a task writes is also read by one task.
    """
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def events(spark, sf_dir) -> DataFrame:
    """Events with the number in `props` and a UTC time stamp (watermarks need that type)."""
    return event_columns(table(spark, sf_dir, "events"))


def event_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def hourly(spark, sf_dir) -> DataFrame:
    """Hourly weather: one station per event type."""
    k = F.col("k").cast("double")
    v = F.floor("value").cast("double")
    return events(spark, sf_dir).select(
        F.col("event_type").alias("icao"),
        F.concat(F.lit("Station "), F.col("event_type")).alias("airport"),
        F.lit(50.5).alias("latitude"),
        F.lit(10.25).alias("longitude"),
        (F.col("ts") - F.make_dt_interval(F.lit(WEATHER_SHIFT_DAYS))).alias("time"),
        (v / 2 - 20).alias("temperature_2m"),
        F.nullif(k, F.lit(0.0)).alias("relative_humidity_2m"),
        (k / 4 - 10).alias("dew_point_2m"),
        (k % 7).alias("precipitation"),
        (k % 5).alias("rain"),
        F.nullif(k % 3, F.lit(2.0)).alias("snowfall"),
        F.nullif(k, F.lit(50.0)).alias("cloud_cover"),
        (k / 2 + 1000).alias("pressure_msl"),
        (k / 2 + 990).alias("surface_pressure"),
        (v / 4).alias("wind_speed_10m"),
        (v + k).alias("wind_gusts_10m"),
    )


def station_days(spark, sf_dir):
    return weather.station_day(hourly(spark, sf_dir))


def region_days(spark, sf_dir):
    return weather.region_day(station_days(spark, sf_dir))


def feature_rows(spark, sf_dir, **options) -> DataFrame:
    """Features. Station days serve both joins, so they are written once, as the batch job does."""
    days = written(station_days(spark, sf_dir), "station-days")
    return features.build_features(
        daily(spark, sf_dir), days, weather.region_day(days), NATION_RULES, **options
    )


def metar(events_view: DataFrame) -> DataFrame:
    """Raw METAR records, all texts: `Z` times, times with an offset, and bad and empty ones."""
    kind, k = F.col("event_type"), F.col("k")
    clock = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    v = F.floor("value").cast("string")
    return events_view.select(
        F.when(kind != "purchase", kind).otherwise(
            F.when(k < 90, kind)
        ).alias("station_id"),
        F.when(kind == "error", F.concat(clock, F.lit("+02:00")))
        .when(kind == "signup", F.when(k < 50, F.lit("not a time")).otherwise(F.lit("")))
        .otherwise(F.concat(clock, F.lit("Z")))
        .alias("observation_time"),
        F.concat(F.upper(kind), F.lit(" "), F.col("event_id").cast("string")).alias("raw_text"),
        F.lit("50.5").alias("latitude"),
        F.lit("10.25").alias("longitude"),
        v.alias("temp_c"),
        k.cast("string").alias("dewpoint_c"),
        ((k * 36) % 360).cast("string").alias("wind_dir_degrees"),
        (k % 40).cast("string").alias("wind_speed_kt"),
        F.when(k >= 50, (k % 60).cast("string")).alias("wind_gust_kt"),
        F.when(k % 2 == 0, F.lit("6+")).otherwise(F.lit("3")).alias("visibility_statute_mi"),
        F.lit("29.92").alias("altim_in_hg"),
        F.when(k != 7, (k + 980).cast("string")).alias("sea_level_pressure_mb"),
        F.when(F.col("value") < 20, F.lit("VFR")).otherwise(F.lit("IFR")).alias(
            "flight_category"
        ),
        F.lit("METAR").alias("metar_type"),
        F.col("user_id").cast("string").alias("elevation_m"),
    )


def metar_documents(events_view: DataFrame) -> DataFrame:
    """One CSV document per event, columns in an order of its own: two lines and a short one."""
    kind, k = F.col("event_type"), F.col("k").cast("string")
    station = F.when(kind == "view", F.lit('"VI,""EW"')).otherwise(kind)
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    event = F.col("event_id").cast("string")
    header = F.lit("temp_c,sky,station_id,observation_time,sky,raw_text")
    line = F.concat_ws(",", k, F.lit("first"), station, time, F.lit("last"), event)
    body = F.concat_ws("\n", header, line, F.lit(""), F.concat_ws(",", k, F.lit("short"), event))
    return events_view.select(
        F.when(kind == "error", F.lit(" \n")).otherwise(F.concat(body, F.lit("\r\n"))).alias("value")
    )


def flights_feed(events_view: DataFrame) -> DataFrame:
    """Delayed-flight records: missing and empty ids, and delays as numbers, words and texts."""
    kind, k, user = F.col("event_type"), F.col("k"), F.col("user_id").cast("string")
    whole = F.floor("value").cast("string")
    return events_view.select(
        "event_id",
        F.when(kind == "click", F.lit(""))
        .when(kind.isin("purchase", "signup"), F.concat(F.lit("FL"), user))
        .alias("flight_iata"),
        F.when(kind == "click", F.concat(F.lit("IC"), user)).alias("flight_icao"),
        F.when(kind == "view", user).alias("flight_number"),
        F.when(kind == "error", F.lit("")).otherwise(F.lit("WAW")).alias("dep_iata"),
        F.when((kind == "error") & (k >= 30), F.concat(F.lit("D"), k.cast("string"))).alias(
            "departure_iata"
        ),
        F.lit(None).cast("string").alias("dep"),
        F.when((kind == "error") & (k >= 20), F.lit("FRA")).alias("arr_iata"),
        F.when((kind == "error") & (k >= 10), F.lit("MUC")).alias("arrival_iata"),
        F.when(kind == "view", F.lit("CDG")).alias("arr"),
        F.when(kind == "click", F.concat(whole, F.lit(".7")))
        .when(kind == "view", F.lit("0"))
        .when(kind == "purchase", F.lit("x"))
        .when(kind == "signup", F.lit(""))
        .alias("delay"),
        F.when(kind == "view", k.cast("string")).when(kind == "signup", F.lit("inf")).alias(
            "dep_delay"
        ),
        F.when(kind == "purchase", F.concat(F.lit("-"), whole, F.lit(".9"))).alias(
            "arrival_delay"
        ),
        F.when(kind.isin("signup", "view"), F.lit("0")).alias("delay_minutes"),
    )


FEED_FIELDS = (
    "flight_iata", "flight_icao", "flight_number", "dep_iata", "departure_iata", "dep",
    "arr_iata", "arrival_iata", "arr", "delay", "dep_delay", "arrival_delay", "delay_minutes",
)


def _json(column):
    return F.to_json(column, {"ignoreNullFields": "false"})


def feed_messages(events_view: DataFrame) -> DataFrame:
    """One message per event: JSON bytes by topic, some of them cut off and undecodable."""
    feed = flights_feed(events_view)
    body = _json(
        F.struct(
            "event_id", *FEED_FIELDS,
            F.lit(fixed.FEED_SOURCE).alias("_source"),
            F.col("event_id").alias("_fetched_at"),
        )
    )
    topic = (
        F.when(F.col("flight_icao").isNotNull(), F.lit("EGLL"))
        .when(F.col("flight_number").isNotNull(), F.lit("EDDB"))
        .when(F.col("flight_iata").isNull(), F.lit("EPWA"))
        .when(F.col("delay") == "x", F.lit("EDDF"))
        .otherwise(F.lit("other"))
    )
    # the error records (topic EPWA) without an arrival airport lose the end of their text, so
    # that the decoder has undecodable messages to drop
    cut = (topic == "EPWA") & F.col("arrival_iata").isNull()
    text = F.when(cut, F.substring(body, 1, 25)).otherwise(body)
    return feed.select(
        F.concat(F.lit("key-"), F.col("event_id").cast("string")).alias("key"),
        text.cast("binary").alias("value"),
        topic.alias("topic"),
    )


def feed_payloads(events_view: DataFrame) -> DataFrame:
    """One payload per event, its record list under a different key for each event type."""
    feed = flights_feed(events_view)
    one = F.array(F.struct(*FEED_FIELDS))
    wrapped = (
        F.when(F.col("flight_icao").isNotNull(), _json(F.struct(one.alias("response"))))
        .when(F.col("flight_number").isNotNull(), _json(F.struct(one.alias("flights"))))
        .when(
            F.col("delay") == "x",
            _json(F.struct(F.struct(one.alias("data"), F.lit(1).alias("page")).alias("response"))),
        )
        .when(
            F.col("flight_iata").isNull() & F.col("arrival_iata").isNull(),
            F.lit('{"response": [{"flight_iata": '),
        )
        .when(F.col("flight_iata").isNull(), F.lit('{"response": {"data": {"a": 1}}}'))
        .otherwise(
            _json(
                F.struct(
                    F.lit("none").alias("response"),
                    F.array(F.struct(*FEED_FIELDS), F.struct(*FEED_FIELDS)).alias("data"),
                )
            )
        )
    )
    return feed.select("event_id", wrapped.alias("payload"))


def event_log_lines(events_view: DataFrame) -> DataFrame:
    """Tab-separated lines: 61 cells, or 60, or 62, quoted cells, empty last cells, empty lines."""
    kind, k = F.col("event_type"), F.col("k").cast("string")
    event = F.col("event_id").cast("string")
    first = F.when(kind == "click", F.lit("")).otherwise(event)
    url = F.when((kind == "click") & (F.col("k") < 30), F.lit("")).otherwise(
        F.concat(F.lit("http://x/"), event)
    )
    name = F.when(kind == "purchase", F.concat(F.lit('"A\t"" '), k, F.lit('"'))).otherwise(k)
    cells = [
        first, F.date_format("ts", "yyyyMMdd"), F.date_format("ts", "yyyyMM"), k, F.lit(""),
        F.lit("C1"), name,
    ]
    cells += [F.lit(f"v{n}") for n in range(len(cells), 59)]
    line = F.concat_ws("\t", *cells, F.date_format("ts", "yyyyMMdd"))
    return events_view.select(
        F.when(kind == "error", F.when(F.col("k") < 50, F.lit("")).otherwise(line))
        .when(kind == "view", F.concat_ws("\t", line, url, F.lit("extra")))
        .otherwise(F.concat_ws("\t", line, url))
        .alias("value")
    )


def boards(spark, sf_dir, dealt: bool = True) -> DataFrame:
    """One airport board per order, with one arrival and one departure; some levels missing."""
    orders = table(spark, sf_dir, "orders")
    if dealt:
        orders = spread(orders, "o_orderkey", "o_custkey")
    orders = orders.withColumn("at", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")))
    key = F.col("o_orderkey").cast("string")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    open_order = F.col("o_orderstatus") == "O"

    def end(code):
        return F.struct(
            F.struct(code.alias("iata")).alias("code"),
            F.struct(F.struct(F.concat(F.lit("City "), code).alias("city")).alias("region")).alias(
                "position"
            ),
        )

    def flight(prefix, seconds):
        return F.struct(
            F.struct(
                F.struct(
                    F.struct(F.concat(F.lit(prefix), key).alias("default")).alias("number"),
                    F.when(urgent, F.concat(F.lit("CS"), key)).alias("callsign"),
                ).alias("identification"),
                F.when(
                    ~open_order,
                    F.struct(
                        F.when(urgent, F.lit("")).otherwise(F.lit("Long Air")).alias("name"),
                        F.lit("LA").alias("short"),
                    ),
                ).alias("airline"),
                F.struct(
                    end(F.col("o_orderstatus")).alias("origin"),
                    F.when(~urgent, end(F.substring("o_orderpriority", 1, 1))).alias(
                        "destination"
                    ),
                ).alias("airport"),
                F.struct(F.col("o_orderpriority").alias("text")).alias("status"),
                F.when(
                    F.col("o_orderpriority") != "2-HIGH",
                    F.struct(
                        F.struct(
                            F.when(open_order, F.lit(0).cast("bigint"))
                            .otherwise(seconds)
                            .alias("departure"),
                            (seconds + 5400).alias("arrival"),
                        ).alias("scheduled")
                    ),
                ).alias("time"),
            ).alias("flight")
        )

    at = F.col("at") + F.pmod(F.col("o_custkey"), F.lit(1440)) * 60
    arrivals = F.struct(F.array(flight("A", at)).alias("data"))
    departures = F.when(
        F.col("o_orderstatus") != "P", F.struct(F.array(flight("D", at + 60)).alias("data"))
    )
    schedule = F.struct(arrivals.alias("arrivals"), departures.alias("departures"))
    nested = schedule
    for name in ("schedule", "pluginData", "airport", "response", "result"):
        nested = F.struct(nested.alias(name))
    codes = F.array(*[F.lit(t) for t in fixed.BOARD_TOPICS])
    airport = codes[F.pmod(F.col("o_custkey"), F.lit(len(fixed.BOARD_TOPICS))).cast("int")]
    return orders.select(
        "o_orderkey", airport.alias("airport"), F.to_json(nested).alias("payload")
    )


def live_positions(spark, sf_dir) -> DataFrame:
    """Live positions, some of them exactly on the border of the box."""
    e = events(spark, sf_dir)
    k = F.col("k")
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("CS"), F.col("user_id").cast("string")).alias("callsign"),
        F.upper(F.substring("event_type", 1, 3)).alias("airline_icao"),
        F.lit("B738").alias("aircraft_code"),
        F.lit("WAW").alias("origin_airport_iata"),
        F.col("event_type").alias("destination_airport_iata"),
        (F.col("user_id") % 16 + 45).cast("double").alias("latitude"),
        (k % 20 + 10).cast("double").alias("longitude"),
        (k * 400).alias("altitude"),
        (k + 300).alias("ground_speed"),
        ((k * 36) % 360).alias("heading"),
        (k - 50).alias("vertical_speed"),
        F.lit("7000").alias("squawk"),
        "ts",
    )


def payload_texts(spark, sf_dir) -> DataFrame:
    """Weather payloads from the vectors: metric arrays shorter and longer than the times."""
    v = F.col("values")
    start = F.to_timestamp(F.lit("2025-01-01"))
    base = table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("values")
    )
    times = F.transform(
        v, lambda _, i: F.date_format(start + F.make_dt_interval(hours=i), "yyyy-MM-dd'T'HH:mm")
    )
    hourly = F.struct(
        F.when(F.col("label") != 9, times).otherwise(F.slice(times, 1, 0)).alias("time"),
        v.alias("temperature_2m"),
        F.slice(v, F.lit(1), F.col("label") + 1).alias("relative_humidity_2m"),
        F.concat(v, v).alias("wind_speed_10m"),
    )
    return base.select("vec_id", F.to_json(F.struct(hourly.alias("hourly"))).alias("payload"))
