"""Join, message and de-duplication keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skylag import fixed


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def non_empty(value) -> Column:
    """Null for empty text, so that coalesce can skip it."""
    return F.nullif(_col(value), F.lit(""))


def hour_key(station, date, hour) -> Column:
    """`station|date|HH`; null when a part is missing (concat, unlike concat_ws, keeps that)."""
    return F.concat(
        _col(station), F.lit("|"), _col(date).cast("string"), F.lit("|"),
        F.lpad(_col(hour).cast("string"), 2, "0"),
    )


def metar_join_key(station, date, hour, missing_station: str | None = None) -> Column:
    """`station|date|hour` with empty text for a missing date or hour.

    A missing station gives null; pass `missing_station="None"` to print a word instead.
    """
    name = _col(station)
    if missing_station is not None:
        name = F.coalesce(name, F.lit(missing_station))
    return F.concat(
        name, F.lit("|"), F.coalesce(_col(date).cast("string"), F.lit("")),
        F.lit("|"), F.coalesce(_col(hour), F.lit("")),
    )


def dedup_key(station, observation_time, missing: str = "None") -> Column:
    return F.concat_ws(
        "|",
        F.coalesce(_col(station), F.lit(missing)),
        F.coalesce(_col(observation_time).cast("string"), F.lit(missing)),
    )


def first_non_empty(*candidates, default: str) -> Column:
    return F.coalesce(*[non_empty(c) for c in candidates], F.lit(default))


# fixed values: fields that may name a flight, in order
FLIGHT_KEY_FIELDS = (
    "flight_iata", "flight_icao", "flight_number", "dep_iata", "departure_iata", "arr_iata",
    "arrival_iata",
)


def flight_key(default: str = fixed.FEED_UNKNOWN_KEY) -> Column:
    """Message key of a delayed flight."""
    return first_non_empty(*FLIGHT_KEY_FIELDS, default=default)


def event_key(default: str = "unknown") -> Column:
    """Message key of an event-log record."""
    return first_non_empty("GLOBALEVENTID", "SOURCEURL", default=default)
