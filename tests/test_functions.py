import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from skylag import fixed
from skylag.functions import dates, keys, measures, rules, text


def values(spark, rows, schema, column):
    """The results of one expression, in row order."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[1] for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_safe_ratio(spark):
    rows = [(6.0, 3), (6.0, 0), (6.0, None), (None, 3), (6.0, -1)]
    got = values(spark, rows, "n double, d bigint", measures.safe_ratio("n", "d"))
    assert got == [2.0, 0.0, 0.0, None, 0.0]


def test_lenient_int(spark):
    rows = [(x,) for x in (
        "12", "12.7", "-3.9", " 5 ", "", "x", "inf", "nan", None, "1e3", "12d", "0x1p3", ".5", "7.",
    )]
    got = values(spark, rows, "v string", measures.lenient_int("v"))
    assert got == [12, 12, -3, 5, None, None, None, None, None, 1000, None, None, 0, 7]


def test_delay_minutes_skips_zero_but_keeps_the_last(spark):
    rows = [("0", "5", None, None), ("x", "", "0", "0"), ("x", None, None, None), ("3", "9", "", "")]
    got = values(
        spark, rows, "a string, b string, c string, d string",
        measures.delay_minutes("a", "b", "c", "d"),
    )
    assert got == [5, 0, None, 3]


def test_residual_adds_up(spark):
    rows = [(10.0, 1.0, 2.0, 3.0)]
    got = values(
        spark, rows,
        "total_delay double, weather_delay double, industrial_delay double, atc_delay double",
        measures.residual_cause(),
    )
    assert got == [4.0]


def test_hour_key_is_null_when_a_part_is(spark):
    rows = [("A", date(2025, 3, 1), 5), ("A", None, 5), (None, date(2025, 3, 1), 5)]
    got = values(spark, rows, "s string, d date, h int", keys.hour_key("s", "d", "h"))
    assert got == ["A|2025-03-01|05", None, None]


def test_metar_keys(spark):
    rows = [("EPWA", "2026-05-01", "2026-05-01T13:00:00+00:00"), ("EPWA", None, None), (None, None, None)]
    schema = "s string, d string, h string"
    assert values(spark, rows, schema, keys.metar_join_key("s", "d", "h")) == [
        "EPWA|2026-05-01|2026-05-01T13:00:00+00:00", "EPWA||", None,
    ]
    assert values(spark, rows, schema, keys.metar_join_key("s", "d", "h", "None"))[2] == "None||"
    assert values(spark, rows, schema, keys.dedup_key("s", "d")) == [
        "EPWA|2026-05-01", "EPWA|None", "None|None",
    ]


def test_flight_and_event_keys(spark):
    names = ["flight_iata", "flight_icao", "flight_number", "dep_iata", "departure_iata", "arr_iata",
             "arrival_iata"]
    schema = ", ".join(f"{n} string" for n in names)
    rows = [
        tuple("k" if i == hit else ("" if i % 2 else None) for i in range(7)) for hit in range(7)
    ] + [("",) * 7]
    assert values(spark, rows, schema, keys.flight_key()) == ["k"] * 7 + ["unknown-flight"]
    rows = [("1", "u"), ("", "u"), ("", "")]
    got = values(spark, rows, "GLOBALEVENTID string, SOURCEURL string", keys.event_key())
    assert got == ["1", "u", "unknown"]


def test_iso(spark):
    texts = [
        "2026-05-01T13:42:10Z", "2026-05-01T23:42:10+02:00", "2026-05-01T13:42:10.5-0330",
        "2026-05-01 13:42", "2026-05-01", "2026-13-01T00:00:00Z", "", None, "noon", "2026-05",
        "2026-05-01T13:42:10+25:00",
    ]
    rows = [(t,) for t in texts]
    assert values(spark, rows, "t string", dates.iso_date("t")) == [date(2026, 5, 1)] * 5 + [None] * 6
    assert values(spark, rows, "t string", dates.iso_hour("t")) == [
        "2026-05-01T13:00:00+00:00", "2026-05-01T23:00:00+02:00", "2026-05-01T13:00:00-03:30",
        "2026-05-01T13:00:00", "2026-05-01T00:00:00", *[None] * 6,
    ]
    instants = values(spark, rows, "t string", dates.iso_instant("t").cast("timestamp_ntz"))
    assert instants[1] == datetime(2026, 5, 1, 21, 42, 10) and instants[8] is None


def test_to_day_gives_null_for_bad_text(spark):
    got = values(spark, [("2025-01-02 03:04:05",), ("2025-99-01",)], "t string", dates.to_day("t"))
    assert got == [date(2025, 1, 2), None]


def test_calendar(spark):
    df = spark.createDataFrame([(date(2025, 1, 5),)], "date date")  # a Sunday
    row = df.withColumns(dates.calendar_features()).first()
    assert row[1:] == (1, 1, 5, 5)


def test_epoch(spark):
    got = values(spark, [(None,), (0,), (3660,), (86399,)], "s bigint", dates.epoch_hhmm("s"))
    assert got == ["Brak", "Brak", "01:01", "23:59"]


@pytest.mark.parametrize("days", [1, 7, 30, 1000])
def test_date_chunks_tile_the_range(spark, days):
    first, last = date(2025, 1, 1), date(2026, 4, 4)
    chunks = values(spark, [(first, last)], "a date, b date", dates.date_chunks("a", "b", days))[0]
    assert chunks[0][0] == first and chunks[-1][1] == last
    for (_, end), (start, _) in zip(chunks, chunks[1:]):
        assert (start - end).days == 1
    assert all((end - start).days == days - 1 for start, end in chunks[:-1])


def test_date_chunks_errors(spark):
    with pytest.raises(ValueError):
        dates.date_chunks("a", "b", 0)
    rows = [(date(2025, 1, 2), date(2025, 1, 1))]
    with pytest.raises(Exception, match="start date"):
        values(spark, rows, "a date, b date", dates.date_chunks("a", "b", 5))
    assert values(spark, rows, "a date, b date", dates.date_chunks("a", "b", 5, "empty")) == [[]]


def test_date_paths(spark):
    rows = [(date(2025, 12, 31), date(2026, 1, 1)), (date(2025, 1, 1), None)]
    got = values(spark, rows, "a date, b date", dates.date_series_paths("a", "b", "x/"))
    assert got == [
        ["x/20251231.export.CSV.zip", "x/20260101.export.CSV.zip"], ["x/20250101.export.CSV.zip"],
    ]
    with pytest.raises(Exception, match="end date"):
        values(spark, [(date(2025, 1, 2), date(2025, 1, 1))], "a date, b date",
               dates.date_series_paths("a", "b", "x"))


def test_station_list(spark):
    rows = [("KJFK, KLAX\r\n\tEPWA\xa0,,\n",), (" \n",), ("",)]
    assert values(spark, rows, "t string", text.station_list("t")) == [
        ["KJFK", "KLAX", "EPWA"], list(fixed.DEFAULT_METAR_STATIONS),
        list(fixed.DEFAULT_METAR_STATIONS),
    ]


def test_has_more(spark):
    cases = {
        '{"has_more": true}': True, '{"has_more": false, "request": {"has_more": true}}': False,
        '{"has_more": 2}': True, '{"has_more": 0.0}': False, '{"has_more": " YES "}': True,
        '{"has_more": "n"}': False, '{"has_more": "2"}': None,
        '{"has_more": "maybe", "response": {"has_more": 1}}': True,
        '{"response": {"request": {"has_more": "no"}}}': False,
        '{"has_more": [1]}': None, "{": None, "[]": None,
    }
    got = values(spark, [(c,) for c in cases], "p string", text.has_more("p"))
    assert got == list(cases.values())


def test_lines(spark):
    record = ("LO1", "WAW", "CDG", "12.7", "s", "5")
    schema = "flight_iata string, dep_iata string, arr_iata string, delay string, _source string, _fetched_at string"
    df = spark.createDataFrame([record, ("", None, "", "x", None, None)], schema)
    for missing in ("flight_number", "flight_icao", "departure_iata", "dep", "arrival_iata", "arr",
                    "dep_delay", "arrival_delay", "delay_minutes"):
        df = df.withColumn(missing, F.lit(None).cast("string"))
    assert sorted(r[0] for r in df.select(text.delay_alert()).collect()) == [
        "[+] Delayed flight LO1: WAW -> CDG, delay=12 min (source=s, fetched=5, date_from=None, date_to=None)",
        "[+] Flight unknown: unknown -> unknown (no numeric delay field) (source=unknown)",
    ]


# --- rules ---------------------------------------------------------------------------------


def brute_force(key, ordered):
    return next((code for code, terms in ordered if any(t in key for t in terms)), None)


def test_only_one_rule_is_shadowed():
    assert rules.shadowed_terms() == [("ukraine", "uk")]
    assert rules.shadowed_terms(rules.specific_first()) == []
    assert len(fixed.STATION_RULES) == 39 and sum(len(t) for _, t in fixed.STATION_RULES) == 78


def test_classify_equals_brute_force(spark):
    pick = random.Random(1)
    terms = [t for _, ts in fixed.STATION_RULES for t in ts]
    texts = ["Ukraine UkSATSE", " DFS ", "nothing", "", None]
    texts += [" ".join(pick.choices(terms + ["x", "air"], k=pick.randint(1, 3))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn(
        "key", text.normalise("t")
    )
    rows = df.select("key", rules.classify("key"), rules.classify("key", strict_order=True)).collect()
    for key, corrected, strict in rows:
        if key is None:
            assert corrected is None and strict is None
            continue
        assert strict == brute_force(key, fixed.STATION_RULES)
        assert corrected == brute_force(key, rules.specific_first())
    by_key = {r[0]: r[1:] for r in rows}
    assert by_key["ukraine uksatse"] == ("UKBB", "EGLL")
    assert by_key["dfs"] == ("EDDF", "EDDF")
