"""Message feeds: decode, flatten, project, filter, route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag import fixed, schemas
from skylag.functions import dates, keys, text

# --- messages -------------------------------------------------------------------------


def decode_json(
    messages: DataFrame, schema: T.StructType, value: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """JSON bytes or text to columns. What is not UTF-8 or not one JSON object is dropped.

    A field of another type than declared is null and does not drop the message.
    """
    body = F.col(value).cast("string")
    # Parsed as a list of one, because the parser ignores text after a complete object.
    listed = F.concat(F.lit("["), body, F.lit("]"))
    parsed = F.from_json(listed, T.ArrayType(schema), {"allowSingleQuotes": "false"})
    # An unfolded list instead of a filter on the parser's result: Spark moves such a filter
    # below the result and would parse every message once more for it.
    single = F.flatten(F.filter(F.array(parsed), lambda records: F.size(records) == 1))
    return (
        messages.filter(F.is_valid_utf8(body) & body.rlike(r"(?s)^\s*\{.*\}\s*$"))
        .select(*keep, F.explode(single).alias("_record"))
        .select(*keep, "_record.*")
    )


def decode_or_reject(
    messages: DataFrame, schema: T.StructType, value: str = "value", keep: tuple[str, ...] = (),
    observe: str = "",
) -> DataFrame:
    """A row for each message: its fields, `decoded`, and in `rejected` the text that did not decode.

    The messages that `decode_json` drops are kept beside the others, so one write, partitioned by
    `decoded`, gives both outputs, and each message is parsed once. Bytes that are not UTF-8 are shown
    as replacement characters. With `observe`, the counts of messages, decoded and rejected are metrics
    of that name, which a query reports for each batch.
    """
    body = F.col(value).cast("string")
    whole = F.is_valid_utf8(body) & body.rlike(r"(?s)^\s*\{.*\}\s*$")
    listed = F.when(whole, F.concat(F.lit("["), body, F.lit("]")))
    parsed = F.from_json(listed, T.ArrayType(schema), {"allowSingleQuotes": "false"})
    single = F.flatten(F.filter(F.array(parsed), lambda records: F.size(records) == 1))
    # an unfolded list of no or one record, as in decode_json, but one row even for none
    rows = messages.select(*keep, F.make_valid_utf8(body).alias("_body"), F.explode_outer(single).alias("_record"))
    decoded = F.isnotnull("_record")
    out = rows.select(
        *keep, "_record.*", decoded.alias("decoded"), F.when(~decoded, F.coalesce("_body", F.lit(""))).alias("rejected")
    )
    if observe:
        out = out.observe(
            observe, F.count("*").alias("messages"), F.count_if("decoded").alias("decoded"),
            F.count_if(~F.col("decoded")).alias("rejected"),
        )
    return out


def json_messages(df: DataFrame, key: Column, topic, fields: list[str] | None = None) -> DataFrame:
    """Rows as (key, value, topic) messages; `topic` may differ per row. Nulls stay in the JSON."""
    names = fields or df.columns
    body = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    route = F.lit(topic) if isinstance(topic, str) else topic
    return df.select(
        key.cast("string").alias("key"), body.alias("value"), route.alias("topic")
    )


def envelope(source: str, fmt: str, record: Column) -> Column:
    """`{source, format, record}` as JSON text."""
    return F.to_json(
        F.struct(
            F.lit(source).alias("source"), F.lit(fmt).alias("format"), record.alias("record")
        ),
        {"ignoreNullFields": "false"},
    )


def event_log_messages(records: DataFrame, topic: str = "gdelt_raw") -> DataFrame:
    record = F.struct(*fixed.EVENT_LOG_FIELDS)
    return records.select(
        keys.event_key().alias("key"),
        envelope(fixed.EVENT_LOG_SOURCE, fixed.EVENT_LOG_FORMAT, record).alias("value"),
        F.lit(topic).alias("topic"),
    )


def nested_to_json(df: DataFrame) -> DataFrame:
    """Struct, array and map columns as JSON text; plain columns unchanged."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(
        *[
            F.to_json(f.name, {"ignoreNullFields": "false"}).alias(f.name)
            if isinstance(f.dataType, nested)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- delayed-flight feed -----------------------------------------------------------------


def feed_records(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per record of a feed payload, as a variant column `record`.

    The list may sit under several keys, on the top level or one level down; the first key
    that holds a list wins, even an empty one. The text is parsed once.
    """
    kept = [c for c in payloads.columns if c != payload]
    nested_keys = [k for k in fixed.FEED_LIST_KEYS if k != fixed.FEED_NESTING_KEY]
    paths = [f"$.{k}" for k in fixed.FEED_LIST_KEYS]
    paths += [f"$.{fixed.FEED_NESTING_KEY}.{k}" for k in nested_keys]
    document = payloads.select(*kept, F.try_parse_json(payload).alias("_document"))
    lists = [F.try_variant_get("_document", p, "array<variant>") for p in paths]
    return document.select(*kept, F.explode(F.coalesce(*lists)).alias("record"))


def record_columns(records: DataFrame, schema=schemas.FEED_RECORD, record="record") -> DataFrame:
    """Known fields of a variant record as text columns, read once per field."""
    kept = [c for c in records.columns if c != record]
    return records.select(
        *kept,
        *[F.try_variant_get(record, f"$.{f.name}", "string").alias(f.name) for f in schema.fields],
    )


def variant_records(messages: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON messages as a variant column `record`. What is not UTF-8 or not one JSON object is dropped."""
    body = F.col(value).cast("string")
    parsed = F.try_parse_json(F.when(F.is_valid_utf8(body), body))
    # unfolded instead of filtered, so that each message is parsed once
    single = F.filter(F.array(parsed), lambda r: F.schema_of_variant(r).startswith("OBJECT"))
    return messages.select(*keep, F.explode(single).alias("record"))


def open_schema(records: DataFrame, record: str = "record") -> T.StructType:
    """The fields of variant records as the data has them, in code point order.

    All tasks merge the types of their records; one merged type is fetched. Numbers with a fraction
    are doubles. A field that is nested, or of different types in different records, is text (JSON).
    Fields whose names differ in capitals only cannot be columns beside each other; the first one is
    taken, and the others stay among the rest.
    """
    found = records.filter(_fields_of(record).isNotNull()).select(F.schema_of_variant_agg(record)).first()[0]
    if not found or not found.upper().startswith("OBJECT<"):
        return T.StructType()
    kind = T.DataType.fromDDL(found.replace("OBJECT<", "STRUCT<"))
    plain = (T.StringType, T.LongType, T.DoubleType, T.BooleanType, T.DateType, T.TimestampType)
    fields: dict[str, T.StructField] = {}
    for field in sorted(kind.fields, key=lambda f: f.name):
        data_type = field.dataType
        if isinstance(data_type, (T.DecimalType, T.FloatType)):
            data_type = T.DoubleType()
        elif not isinstance(data_type, plain):
            data_type = T.StringType()
        fields.setdefault(field.name.lower(), T.StructField(field.name, data_type))
    return T.StructType(list(fields.values()))


def _fields_of(record) -> Column:
    return F.try_variant_get(record, "$", "map<string,variant>")


def open_columns(
    records: DataFrame, schema: T.StructType | None = None, record: str = "record", rest: str = "rest"
) -> DataFrame:
    """All fields of variant records as columns: those of `schema`, and the others as JSON in `rest`.

    Without `schema` it is found in the records, in a pass of its own, so nothing has to be declared. A
    field that came up after the schema was found, or whose value does not fit its column, is in
    `rest`, so no field is lost. A record that is not an object has only nulls and itself in `rest`.
    """
    if schema is None:
        schema = open_schema(records, record)
    kept = [c for c in records.columns if c != record]
    rows = records.select(*kept, F.col(record).alias("_record"), _fields_of(record).alias("_fields"))

    def value(field: T.StructField) -> Column:
        cell = F.col("_fields")[F.lit(field.name)]
        if isinstance(field.dataType, T.StringType):
            nested = F.schema_of_variant(cell).rlike("^(OBJECT|ARRAY)")
            return F.when(nested, F.to_json(cell)).otherwise(F.try_variant_get(cell, "$", "string"))
        return F.try_variant_get(cell, "$", field.dataType.simpleString())

    names = schema.fieldNames()
    typed = rows.withColumns({f"_value_{i}": value(f) for i, f in enumerate(schema.fields)})
    # a value that is there, but not in its column
    misfit = [
        F.when(F.isnull(f"_value_{i}") & F.isnotnull(F.col("_fields")[n]) & ~F.is_variant_null(F.col("_fields")[n]), F.lit(n))
        for i, n in enumerate(names)
    ]
    left = F.array_compact(F.array(*misfit)) if names else F.array().cast("array<string>")
    known = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    others = F.map_filter("_fields", lambda n, _: ~F.array_contains(known, n) | F.array_contains(left, n))
    return typed.select(
        *kept, *[F.col(f"_value_{i}").alias(n) for i, n in enumerate(names)],
        F.when(F.isnull("_fields"), F.to_json("_record"))
        .when(F.size(others) > 0, F.to_json(others, {"ignoreNullFields": "false"})).alias(rest),
    )


def provenance(
    threshold: int = fixed.FEED_THRESHOLD_MINUTES,
    kind: str = fixed.FEED_TYPE,
    source: str = fixed.FEED_SOURCE,
    fetched_at: Column | None = None,
) -> dict[str, Column]:
    """Where and when a feed record came from, for `withColumns`."""
    now = F.unix_timestamp(F.current_timestamp()) if fetched_at is None else fetched_at
    return {
        "_source": F.lit(source),
        "_fetched_at": now.cast("bigint"),
        "_airlabs_delay_threshold": F.lit(threshold),
        "_airlabs_type": F.lit(kind),
    }


def with_fields(record: Column, fields: dict[str, Column]) -> Column:
    """JSON text of a variant record with fields added; an added one replaces its namesake."""
    known = F.try_variant_get(record, "$", "map<string,variant>")
    kept = F.map_filter(known, lambda name, _: ~name.isin(*fields))
    added = [x for name, value in fields.items() for x in (F.lit(name), value.cast("variant"))]
    return F.to_json(F.map_concat(kept, F.create_map(*added)), {"ignoreNullFields": "false"})


def delay_messages(
    payloads: DataFrame, payload: str = "payload", topic: str = "delays", **origin
) -> DataFrame:
    """Feed payloads as messages: each record whole, with its provenance, under its flight key."""
    record = F.col("record")
    candidates = [F.try_variant_get(record, f"$.{n}", "string") for n in keys.FLIGHT_KEY_FIELDS]
    return feed_records(payloads.select(payload), payload).select(
        keys.first_non_empty(*candidates, default=fixed.FEED_UNKNOWN_KEY).alias("key"),
        with_fields(record, provenance(**origin)).alias("value"),
        F.lit(topic).alias("topic"),
    )


def delayed_at_least(df: DataFrame, minutes: int, kind: str, delay: str, kind_column: str):
    """Records of one kind (departures or arrivals) whose delay reaches the threshold."""
    return df.filter((F.col(delay) >= minutes) & (F.col(kind_column) == kind))


# --- METAR observations -------------------------------------------------------------------


def csv_documents(documents: DataFrame, value: str = "value") -> DataFrame:
    """Small CSV documents, each with its own header, to one row per record.

    The new column `record` maps column names to texts. Columns may come in any order; of two
    with one name the last counts; a short record has nulls; an empty document has no rows. A line
    end inside quotes belongs to its cell.
    """
    kept = [c for c in documents.columns if c != value]
    body = F.btrim(F.col(value), F.lit(text.BLANKS + text.LINE_ENDS))
    # runs without a line end, where quoted parts may hold some; a quote that never closes is a character
    lines = F.regexp_extract_all(body, F.lit(f'(?:[^"{text.LINE_ENDS}]++|"[^"]*+"|")++'), F.lit(0))
    parts = documents.select(
        *kept,
        text.cells(F.get(lines, F.lit(0)), ",").alias("_names"),
        F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))).alias("_lines"),
    )
    rows = parts.select(*kept, "_names", F.explode("_lines").alias("_line"))
    split = rows.select(*kept, "_names", text.cells(F.col("_line"), ",").alias("_cells"))
    last = F.reverse("_names")
    names = F.array_distinct("_names")
    texts = F.transform(
        names,
        lambda n: F.get("_cells", (F.size("_names") - F.array_position(last, n)).cast("int")),
    )
    return split.select(*kept, F.map_from_arrays(names, texts).alias("record"))


def metar_records(documents: DataFrame, value: str = "value") -> DataFrame:
    """METAR documents to raw records, with the untouched record as a map."""
    rows = csv_documents(documents, value)
    record = F.col("record")
    return rows.select(
        *[record[name].alias(name) for name in schemas.METAR_RAW.fieldNames()],
        record.alias("full_record"),
    )


def metar_events(raw: DataFrame, ingested_at: Column | str | None = None) -> DataFrame:
    """Raw METAR texts to events: 21 fields, the full record, and the join key.

    The full record is the column of that name, or else all columns of `raw`.
    """
    if ingested_at is None:
        ingested_at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    elif isinstance(ingested_at, str):
        ingested_at = F.lit(ingested_at)
    if "full_record" in raw.columns:
        full = F.col("full_record")
    else:
        full = F.create_map(*[x for c in raw.columns for x in (F.lit(c), F.col(c).cast("string"))])
    day = dates.iso_date("observation_time").cast("string")
    hour = dates.iso_hour("observation_time")
    return raw.select(
        F.lit(fixed.METAR_SOURCE).alias("source"),
        F.lit(fixed.METAR_DATA_SOURCE).alias("data_source"),
        ingested_at.alias("ingested_at"),
        "station_id",
        "observation_time",
        day.alias("observation_date"),
        hour.alias("observation_hour"),
        *[
            F.col(name) if name in raw.columns else F.lit(None).cast("string").alias(name)
            for name in fixed.METAR_FIELDS
        ],
        full.alias("full_record"),
        keys.metar_join_key("station_id", day, hour).alias("feature_join_key"),
    )


def weather_messages(events: DataFrame, topic: str = "weather") -> DataFrame:
    """METAR events as messages under station and observation time."""
    return json_messages(
        events,
        keys.dedup_key("station_id", "observation_time"),
        topic,
        schemas.METAR_EVENT.fieldNames(),
    )


def metar_typed(events: DataFrame, *keep: str) -> DataFrame:
    """Events with the typed columns that joins and windows need, and the columns in `keep`.

    The text keys of events and of hourly weather differ in form and never match, so the
    join uses station, date and hour (UTC) as columns.
    """
    instant = dates.iso_instant("observation_time")
    return events.select(
        *keep,
        F.col("station_id").alias("station"),
        instant.alias("ts"),
        instant.cast("date").alias("date"),
        F.hour(instant).alias("hour"),
        F.col("temp_c").try_cast("double").alias("temp_c"),
        F.col("wind_speed_kt").try_cast("double").alias("wind_speed_kt"),
    )


# --- airport boards and live positions -----------------------------------------------------


def board_rows(boards: DataFrame, payload: str = "payload") -> DataFrame:
    """Airport board to flat arrival and departure rows. Any level may be missing.

    Both lists become one array before the explode, so the payload is parsed and read once.
    """
    kept = [c for c in boards.columns if c != payload]
    parsed = boards.select(*kept, F.from_json(payload, schemas.BOARD).alias("_board"))
    schedule = "_board.result.response.airport.pluginData.schedule"

    def side(name, direction):
        return F.transform(
            f"{schedule}.{name}.data",
            lambda entry: F.struct(F.lit(direction).alias("direction"), entry["flight"].alias("f")),
        )

    sides = F.array(side("arrivals", "arrival"), side("departures", "departure"))
    both = F.flatten(F.filter(sides, lambda part: part.isNotNull()))
    rows = parsed.select(*kept, F.explode(both).alias("_row")).select(
        *kept, "_row.direction", "_row.f"
    )
    return rows.select(
        *kept,
        "direction",
        F.col("f.identification.number.default").alias("flight_number"),
        F.col("f.identification.callsign").alias("callsign"),
        keys.first_non_empty("f.airline.name", "f.airline.short", default="").alias("airline"),
        F.col("f.airport.origin.code.iata").alias("origin_iata"),
        F.col("f.airport.origin.position.region.city").alias("origin_city"),
        F.col("f.airport.destination.code.iata").alias("dest_iata"),
        F.col("f.airport.destination.position.region.city").alias("dest_city"),
        F.col("f.status.text").alias("status"),
        dates.epoch_hhmm("f.time.scheduled.departure").alias("scheduled_departure"),
        dates.epoch_hhmm("f.time.scheduled.arrival").alias("scheduled_arrival"),
    )


def board_messages(rows: DataFrame, airport: str) -> DataFrame:
    """Board rows as messages: one topic per airport, the direction as key."""
    fields = schemas.BOARD_ROW.fieldNames()
    return json_messages(rows, F.col("direction"), F.col(airport), fields)


def positions(df: DataFrame, seen_at: Column | None = None) -> DataFrame:
    """Live positions, 14 columns."""
    moment = F.current_timestamp() if seen_at is None else seen_at
    return df.select(
        *[F.col(field).alias(name) for name, field in fixed.POSITION_FIELDS.items()],
        moment.alias("timestamp"),
    )


def airline_positions(df: DataFrame, airline: str) -> DataFrame:
    """Live positions of one airline, 8 columns."""
    return df.filter(F.col("airline_icao") == airline).select(
        *[F.col(field).alias(name) for name, field in fixed.AIRLINE_POSITION_FIELDS.items()]
    )


def in_box(df: DataFrame, box=fixed.POSITION_BOX, lat="latitude", lon="longitude") -> DataFrame:
    """Rows inside a latitude and longitude box (south, north, west, east), border included."""
    south, north, west, east = box
    return df.filter(F.col(lat).between(south, north) & F.col(lon).between(west, east))


def find_flight(df: DataFrame, flight: str, airline: str | None, *order) -> DataFrame:
    """The first position whose callsign or id is `flight`, of one airline or of any."""
    hits = df.filter((F.col("callsign") == flight) | (F.col("id") == flight))
    if airline is not None:
        hits = hits.filter(F.col("airline_icao") == airline)
    return hits.orderBy(*order).limit(1)
