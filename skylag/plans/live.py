"""The streaming jobs between landed files, topics and tables.

    spark-submit --packages <Kafka package> --py-files skylag.zip bin/live.py publish weather \
        --servers host:9092 --input landing/metar
    spark-submit ... bin/live.py enrich --servers host:9092 --weather warehouse \
        --out warehouse/observations

Files land in a folder and are published to topics; topics are shown, saved or enriched. Each
job keeps its position in a checkpoint under `spark.checkpoint.dir` or `--checkpoint`.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag import fixed, schemas
from skylag.functions import text
from skylag.operators import feeds
from skylag.plans import batch
from skylag.session import build_session
from skylag.sources import archives, files, kafka
from skylag.streaming import jobs, runs
from skylag.streaming.first_rows import first_rows

WEATHER, DELAYS = "weather", "delays"
# copies of one observation are first reduced in so many groups
SALTS = 16


# --- landed files to messages -----------------------------------------------------------------


def weather_out(spark: SparkSession, folder: str, salts: int = SALTS, forget: str = "") -> DataFrame:
    """METAR CSV files to messages, an observation that polls repeat only once.

    With `forget`, an observation is known until it has not come again for that time, however long
    the polls repeat it.
    """
    documents = spark.readStream.text(folder, wholetext=True)
    events = feeds.metar_events(feeds.metar_records(documents))
    if forget:
        kept = first_rows(events, "station_id", "observation_time", forget=forget)
        return feeds.weather_messages(kept.filter("is_first"))
    # Keys expire by arrival time: a poll repeats an observation within the look-back, and no
    # observation is late, however old its own time is or whether it can be read at all.
    arrived = events.withColumn("_arrived", F.current_timestamp())
    fresh = jobs.drop_repeats(arrived, "station_id", "observation_time", ts="_arrived", salts=salts)
    return feeds.weather_messages(fresh.drop("_arrived"))


def delays_out(spark: SparkSession, folder: str) -> DataFrame:
    """Feed payload files (one JSON document each) to messages."""
    payloads = spark.readStream.text(folder, wholetext=True)
    return feeds.delay_messages(payloads, "value")


def boards_out(spark: SparkSession, folder: str) -> DataFrame:
    """Board files in one folder per airport (`airport=EPWA/…`) to messages per airport."""
    boards = spark.readStream.schema("value string, airport string").text(folder, wholetext=True)
    return feeds.board_messages(feeds.board_rows(boards, "value"), "airport")


def event_log_out(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.event_log_messages(files.tsv_records(archives.event_log_lines(spark, folder, stream=True)))


PUBLISHED = {
    "weather": weather_out, "delays": delays_out, "boards": boards_out, "event-log": event_log_out,
}


# --- messages to lines, files and tables --------------------------------------------------------


def weather_lines(messages: DataFrame) -> DataFrame:
    return feeds.decode_json(messages, schemas.METAR_EVENT).select(text.metar_line().alias("line"))


SHOWN = {
    "weather": ((WEATHER,), "earliest", weather_lines),
    "delays": ((DELAYS,), "earliest", jobs.delay_alerts),
    "boards": (fixed.BOARD_TOPICS, "latest", jobs.board_lines),
}


def delay_records(messages: DataFrame) -> DataFrame:
    """Delayed flights as flat rows for CSV: nested fields are JSON texts, and undeclared ones are JSON
    in `rest`, so no field of a message is lost."""
    return feeds.nested_to_json(feeds.open_columns(feeds.variant_records(messages), schemas.FEED_RECORD))


def flights_with_weather(
    delays: DataFrame, observations: DataFrame, station_field: str = "dep_icao", time_field: str = "dep_time_utc",
    reach: str = "1 hour", late_by: str = fixed.METAR_LOOK_BACK,
) -> DataFrame:
    """Delayed flights of a topic with the observations of their airport in the time before departure.

    Flights without an airport or a time that can be read are left out; they can meet nothing.
    """
    record = F.col("record")
    flights = feeds.variant_records(delays, keep=("key",)).select(
        F.col("key").alias("flight"), F.try_variant_get(record, f"$.{station_field}", "string").alias("station"),
        F.try_variant_get(record, f"$.{time_field}", "string").try_cast("timestamp").alias("ts"),
        F.try_variant_get(record, "$.delay", "string").try_cast("double").alias("delay"),
    ).filter(F.isnotnull("station") & F.isnotnull("ts"))
    seen = feeds.metar_typed(feeds.decode_json(observations, schemas.METAR_EVENT)).select(
        "station", "ts", "temp_c", "wind_speed_kt"
    ).filter(F.isnotnull("station") & F.isnotnull("ts"))
    return jobs.join_recent_weather(flights, seen, reach, late_by)


def enrich_batch(out: str, tables: str):
    """Writes one batch of weather messages with the weather of their stations' hours.

    The table is opened anew for each batch, so a batch sees what the batch job has replaced since,
    and reads only the years that its dates lie in. It is an ordinary join, so AQE splits a hot station
    hour. A batch that is repeated after a failure replaces its own folder.
    """

    def write(messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        observed = feeds.metar_typed(feeds.decode_json(messages, schemas.METAR_EVENT))
        # one wrong date opens one year more, not all years up to it
        years = [r["y"] for r in observed.select(F.year("date").alias("y")).distinct().collect() if r["y"] is not None]
        hours = batch.read_table(spark, tables, batch.STATION_HOUR, years=years)
        joined = jobs.join_hourly_weather(observed, hours)
        joined.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch_id}")

    return write


def enrich(messages: DataFrame, out: str, tables: str, checkpoint: str, **trigger):
    return (
        messages.writeStream.foreachBatch(enrich_batch(out, tables))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or runs.POLL)).start()
    )


def main() -> None:
    parser = argparse.ArgumentParser(description="Streaming jobs")
    parser.add_argument("job", choices=["publish", "show", "save", "enrich", "match"])
    parser.add_argument("feed", nargs="?", default="weather", choices=sorted({*PUBLISHED, *SHOWN}))
    parser.add_argument("--servers", required=True)
    parser.add_argument("--input", help="landing folder of publish")
    parser.add_argument("--weather", help="folder of the batch job's tables, for enrich")
    parser.add_argument("--out", help="result folder of save and enrich")
    parser.add_argument("--checkpoint", help="folder that keeps the job's position")
    parser.add_argument("--max-per-trigger", type=int, default=0, help="messages of one batch at most")
    parser.add_argument("--forget", default="", help="how long a published observation stays known after its last poll")
    parser.add_argument("--reach", default="1 hour", help="age of the observations that match joins to a flight")
    parser.add_argument("--salts", type=int, default=SALTS, help="groups that reduce copies first")
    parser.add_argument("--state-partitions", type=int, default=200,
                        help="tasks of a stateful step, fixed for the life of a checkpoint")
    args = parser.parse_args()
    spark = build_session(
        f"skylag-{args.job}-{args.feed}", **{"spark.sql.shuffle.partitions": str(args.state_partitions)}
    )
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not (args.checkpoint or base):
        parser.error("set spark.checkpoint.dir or --checkpoint")
    checkpoint = args.checkpoint or f"{base}/{args.job}-{args.feed}"
    if args.job == "publish":
        query = kafka.write_topics(
            PUBLISHED[args.feed](spark, args.input, **({"salts": args.salts, "forget": args.forget} if args.feed == "weather" else {})),
            args.servers, checkpoint,
        )
    elif args.job == "show":
        topics, starting, lines = SHOWN[args.feed]
        query = runs.console(lines(kafka.read_topics(spark, args.servers, topics, starting=starting)))
    elif args.job == "save":
        rows = delay_records(kafka.read_topics(spark, args.servers, (DELAYS,), max_per_trigger=args.max_per_trigger))
        query = runs.start(rows, args.out, checkpoint, "csv")
    elif args.job == "match":
        topics = [
            kafka.read_topics(spark, args.servers, (t,), max_per_trigger=args.max_per_trigger) for t in (DELAYS, WEATHER)
        ]
        query = runs.start(flights_with_weather(*topics, reach=args.reach), args.out, checkpoint)
    else:
        messages = kafka.read_topics(
            spark, args.servers, (WEATHER,), max_per_trigger=args.max_per_trigger
        )
        query = enrich(messages, args.out, args.weather, checkpoint)
    query.awaitTermination()


if __name__ == "__main__":
    main()
