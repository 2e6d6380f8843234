"""Dates, hours, calendar columns and date ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skylag import fixed

# date and time without offset, then the offset
_ISO = (
    r"^(\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)?)"
    r"(Z|[+-](?:[01]\d|2[0-3]):?[0-5]\d)?$"
)
_HOUR_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_day(value) -> Column:
    """Timestamp or text to date; malformed text gives null instead of an error."""
    return _col(value).try_cast("date")


def iso_local(value) -> Column:
    """The local clock time of an ISO text, without its offset."""
    return F.nullif(F.regexp_extract(_col(value), _ISO, 1), F.lit("")).try_cast("timestamp_ntz")


def iso_date(value) -> Column:
    """Date of an ISO text in the record's own offset; null for bad or empty text."""
    return iso_local(value).cast("date")


def iso_hour(value) -> Column:
    """ISO text cut to the hour, offset kept (`Z` is written `+00:00`)."""
    offset = F.regexp_extract(_col(value), _ISO, 2)
    digits = F.replace(offset, F.lit(":"), F.lit(""))
    suffix = (
        F.when(offset == "", F.lit(""))
        .when(offset == "Z", F.lit("+00:00"))
        .otherwise(F.concat(F.substring(digits, 1, 3), F.lit(":"), F.substring(digits, 4, 2)))
    )
    floor = F.date_trunc("hour", iso_local(value).cast("timestamp"))
    return F.concat(F.date_format(floor, _HOUR_FORMAT), suffix)


def iso_instant(value) -> Column:
    """The instant an ISO text names (text without offset is UTC), for event time."""
    return F.when(iso_local(value).isNotNull(), _col(value).try_cast("timestamp"))


def calendar_features(date: str = fixed.DATE) -> dict[str, Column]:
    """Calendar columns of a date, for `withColumns`. Sunday is day 1."""
    return {
        "day_of_week": F.dayofweek(date),
        "month_of_year": F.month(date),
        "day_of_month": F.dayofmonth(date),
        "day_of_year": F.dayofyear(date),
    }


def epoch_hhmm(seconds, missing: str = fixed.NO_TIME) -> Column:
    """`HH:MM` in session time; the word `missing` for null or 0."""
    ts = _col(seconds)
    return F.when(ts.isNull() | (ts == 0), F.lit(missing)).otherwise(
        F.date_format(F.timestamp_seconds(ts), "HH:mm")
    )


def end_cap_today(end) -> Column:
    return F.least(_col(end), F.current_date())


def date_chunks(start, end, days: int, on_inverted: str = "error") -> Column:
    """Array of (chunk_start, chunk_end) that tiles [start, end] in steps of `days`.

    `on_inverted`: a range that ends before it starts is an "error", or "empty".
    """
    if days <= 0:
        raise ValueError("days must be > 0")
    first, last = _col(start), _col(end)
    starts = F.sequence(first, F.greatest(first, last), F.make_interval(days=F.lit(days)))
    chunks = F.transform(
        starts,
        lambda s: F.struct(
            s.alias("chunk_start"), F.least(F.date_add(s, days - 1), last).alias("chunk_end")
        ),
    )
    if on_inverted == "error":
        bad = F.raise_error(F.lit("start date cannot be after end date")).cast(
            "array<struct<chunk_start: date, chunk_end: date>>"
        )
        return F.when(first <= last, chunks).when(first > last, bad)
    return F.when(first <= last, chunks).otherwise(F.array().cast(
        "array<struct<chunk_start: date, chunk_end: date>>"
    ))


def date_series_paths(start, end, base: str, suffix: str = fixed.EVENT_LOG_SUFFIX) -> Column:
    """Array of one path per day, `<base>/YYYYMMDD.<suffix>`. A null end means one day."""
    first = _col(start)
    last = F.coalesce(_col(end), first)
    days = F.when(first <= last, F.sequence(first, last)).when(
        first > last,
        F.raise_error(F.lit("end date must be the same or later than start date")).cast(
            "array<date>"
        ),
    )
    root = base.rstrip("/") + "/"
    return F.transform(
        days, lambda d: F.concat(F.lit(root), F.date_format(d, "yyyyMMdd"), F.lit(f".{suffix}"))
    )
