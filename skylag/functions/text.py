"""Text clean-up, lenient booleans and message lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skylag import fixed
from skylag.functions.keys import first_non_empty
from skylag.functions.measures import delay_minutes

# line ends a text reader splits at, and the blanks it strips
LINE_ENDS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\N{LINE SEPARATOR}\N{PARAGRAPH SEPARATOR}"
BLANKS = " \t\x1f\xa0" + "".join(
    map(chr, [0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000])
)


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def normalise(value) -> Column:
    return F.lower(F.trim(_col(value)))


def station_list(value, default=fixed.DEFAULT_METAR_STATIONS) -> Column:
    """Comma or line separated codes as an array of trimmed, non-empty texts."""
    parts = F.split(_col(value), f"[,{LINE_ENDS}]")
    codes = F.filter(
        F.transform(parts, lambda p: F.btrim(p, F.lit(BLANKS))), lambda p: F.length(p) > 0
    )
    if default is None:
        return codes
    fallback = F.array(*[F.lit(code) for code in default])
    return F.when(F.size(codes) > 0, codes).otherwise(fallback)


def cells(line: Column, separator: str = "\t") -> Column:
    """Cells of a line. A cell may be quoted, with separators and doubled quotes inside."""
    # one cell after its separator: a quoted one with what follows the quote, or a plain one
    plain = f"[^{separator}]*"
    cell = f'{separator}("[^"]*+(?:""[^"]*+)*+"{plain}|{plain})'
    quoted = f'^"([^"]*+(?:""[^"]*+)*+)"({plain})$'

    def unquoted(found: Column) -> Column:
        inside = F.regexp_extract(found, quoted, 1)
        after = F.regexp_extract(found, quoted, 2)
        return F.when(
            found.rlike(quoted), F.concat(F.replace(inside, F.lit('""'), F.lit('"')), after)
        ).otherwise(found)

    all_found = F.regexp_extract_all(F.concat(F.lit(separator), line), F.lit(cell), 1)
    return F.when(line.contains('"'), F.transform(all_found, unquoted)).otherwise(
        F.split(line, separator)
    )


def lenient_bool_text(value) -> Column:
    """true/1/yes/y and false/0/no/n in any case and padding; other text is null."""
    word = F.lower(F.btrim(_col(value), F.lit(BLANKS + LINE_ENDS)))
    return F.when(word.isin(*fixed.TRUE_WORDS), F.lit(True)).when(
        word.isin(*fixed.FALSE_WORDS), F.lit(False)
    )


def has_more(payload) -> Column:
    """The paging flag of a JSON payload: the first place with a recognised value wins.

    The JSON type decides: a bool as it is, a number by being non-zero, a text by its word.
    """
    document = F.try_parse_json(_col(payload))
    found = []
    for path in fixed.HAS_MORE_PATHS:
        kind = F.schema_of_variant(F.try_variant_get(document, path, "variant"))
        text = F.try_variant_get(document, path, "string")
        found.append(
            F.when(kind == "BOOLEAN", text == "true")
            .when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), text.try_cast("double") != 0)
            .when(kind == "STRING", lenient_bool_text(text))
        )
    return F.coalesce(*found)


def _shown(value) -> Column:
    return F.coalesce(_col(value).cast("string"), F.lit("None"))


# --- fixed values: message lines ---------------------------------------------------
_DELAYED = "[+] Delayed flight %s: %s -> %s, delay=%s min (source=%s, fetched=%s, date_from=%s, date_to=%s)"
_NO_DELAY = "[+] Flight %s: %s -> %s (no numeric delay field) (source=%s)"
_ARRIVAL = "[%s] PRZYLOT | Lot: %s z %s | Status: %s"
_DEPARTURE = "[%s] ODLOT  | Lot: %s do %s | Status: %s"
_OTHER = "[%s] INNE   | Typ: %s | Dane: %s"
_METAR = "[%s] %s %sC %s"


def delay_alert() -> Column:
    """One line per delayed flight. No producer writes a date range, so both ends print None."""
    flight = first_non_empty("flight_iata", "flight_number", "flight_icao", default="unknown")
    dep = first_non_empty("dep_iata", "departure_iata", "dep", default="unknown")
    arr = first_non_empty("arr_iata", "arrival_iata", "arr", default="unknown")
    source = first_non_empty("_source", default="unknown")
    delay = delay_minutes("delay", "dep_delay", "arrival_delay", "delay_minutes")
    return F.when(
        delay.isNotNull(),
        F.format_string(
            _DELAYED, flight, dep, arr, delay.cast("string"), source, _shown("_fetched_at"),
            F.lit("None"), F.lit("None"),
        ),
    ).otherwise(F.format_string(_NO_DELAY, flight, dep, arr, source))


def board_line(topic="topic", key="key", data="value") -> Column:
    """One line per board message, by key: arrival, departure, anything else."""
    kind = _col(key)
    return (
        F.when(
            kind == "arrival",
            F.format_string(
                _ARRIVAL, _col(topic), _shown("flight_number"), _shown("origin_iata"),
                _shown("status"),
            ),
        )
        .when(
            kind == "departure",
            F.format_string(
                _DEPARTURE, _col(topic), _shown("flight_number"), _shown("dest_iata"),
                _shown("status"),
            ),
        )
        .otherwise(
            F.format_string(
                _OTHER, _col(topic), F.coalesce(kind, F.lit("UNKNOWN")), _shown(data)
            )
        )
    )


def metar_line() -> Column:
    return F.format_string(
        _METAR, _shown("station_id"), _shown("observation_time"), _shown("temp_c"),
        _shown("flight_category"),
    )
