import gzip
import json
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import types as T

from skylag import fixed, schemas
from skylag.sources import archives, files, kafka, stations, tables

SMALL = T.StructType(
    [
        T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType()),
        T.StructField("t", T.TimestampType()), T.StructField("z", T.StringType()),
    ]
)


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "one.csv").write_text("n,t,a,extra\n1,2025-03-30T02:00,x,e\n,2025-03-30,,e\n")
    rows = files.scan_csv(spark, str(tmp_path / "one.csv"), SMALL).collect()
    assert [tuple(r) for r in rows] == [
        ("x", 1, datetime(2025, 3, 30, 2), None), (None, None, datetime(2025, 3, 30), None),
    ]


def test_yearly_union(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,n\nx,1\nx,1\n")
    (tmp_path / "two.csv").write_text("n,z,a\n2,q,y\n")
    paths = [str(tmp_path / "one.csv"), str(tmp_path / "two.csv")]
    rows = files.scan_yearly(spark, paths, SMALL).select("a", "n", "z").collect()
    assert sorted(map(tuple, rows), key=str) == [("x", 1, None), ("x", 1, None), ("y", 2, "q")]


def test_csv_with_repeated_and_empty_names(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,,n,a\nold,e,1,new\n")
    row = files.scan_csv(spark, str(tmp_path / "one.csv"), SMALL).first()
    assert (row.a, row.n) == ("new", 1)
    (tmp_path / "none.csv").write_text("")
    assert files.scan_csv(spark, str(tmp_path / "none.csv"), SMALL).count() == 0


def test_inferred_csv(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,n\nx,1\n")
    assert dict(files.scan_csv(spark, str(tmp_path / "one.csv"), None).dtypes)["n"] == "int"


@pytest.mark.parametrize("compression", ["none", "bzip2", "gzip"])
def test_csv_keeps_texts(spark, path, compression):
    texts = ["", None, " padded ", 'q"uote', "back\\slash", "a,b", '"', "\\", 'x\\"y']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, a string")
    files.write_csv(df, f"{path}/t", compression=compression)
    got = files.scan_csv(spark, f"{path}/t", SMALL).select("n", "a").orderBy("n").collect()
    assert [r.a for r in got] == texts


# --- tab-separated event log ---------------------------------------------------------------

N = len(fixed.EVENT_LOG_FIELDS)


def cells(**changed):
    row = [f"c{i}" for i in range(N)]
    for position, value in changed.items():
        row[int(position[1:])] = value
    return row


LINES = [
    "\t".join(cells()),
    "",
    "\t".join(cells()[:-1]),
    "\t".join([*cells(_0="b"), "extra"]),
    "\t".join(cells(_0="", _59="", _60="")),
    "\t".join(cells(_0='"tab\there"', _1='"say ""hi"""', _2='mid"dle', _3='""', _4='"x"y')),
    # a quote that closes in a later cell joins the two cells, which makes the line too short
    "\t".join(cells(_0="joined", _3='"open', _4='"x"y')),
    '"' + "\t".join(cells()),
]


def check(rows):
    got = {r.GLOBALEVENTID: r for r in rows}
    assert set(got) == {"c0", "b", "", "tab\there", '"c0'} and len(rows) == 5
    assert got["c0"].SOURCEURL == "c60" and got["b"].SOURCEURL == "c60"
    assert got[""].DATEADDED == "" and got[""].SOURCEURL == ""
    quoted = got["tab\there"]
    assert (quoted.SQLDATE, quoted.MonthYear) == ('say "hi"', 'mid"dle')
    assert (quoted.Year, quoted.FractionDate) == ("", "xy")


def test_field_list():
    assert N == 61 and fixed.EVENT_LOG_FIELDS[0] == "GLOBALEVENTID"
    assert fixed.EVENT_LOG_FIELDS[15] == "Actor2Code" and fixed.EVENT_LOG_FIELDS[34] == "AvgTone"
    assert fixed.EVENT_LOG_FIELDS[51] == "ActionGeo_Type" and fixed.EVENT_LOG_FIELDS[60] == "SOURCEURL"


def test_tsv_plain_gz_zip(spark, tmp_path):
    body = ("\n".join(LINES) + "\n").encode()
    (tmp_path / "a.csv").write_bytes(body)
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(body))
    with zipfile.ZipFile(tmp_path / "a.csv.zip", "w") as archive:
        archive.writestr("first.csv", body)
    check(files.scan_tsv(spark, str(tmp_path / "a.csv")).collect())
    check(files.scan_tsv(spark, str(tmp_path / "a.csv.gz")).collect())
    check(archives.scan_tsv_zip(spark, str(tmp_path / "a.csv.zip")).collect())
    one = len(files.scan_tsv(spark, str(tmp_path / "a.csv")).collect())
    assert archives.scan_event_log(spark, str(tmp_path)).count() == 3 * one
    with zipfile.ZipFile(tmp_path / "b.ZIP", "w") as archive:
        archive.writestr("first.csv", body)
        archive.writestr("second.csv", "\t".join(cells(_0="no")))
    with pytest.raises(Exception, match="2 members"):
        archives.scan_event_log(spark, str(tmp_path)).count()
    assert archives.scan_event_log(spark, str(tmp_path), first_only=True).count() == 4 * one
    (tmp_path / "c.rar").write_bytes(b"x")
    with pytest.raises(ValueError, match="c.rar"):
        archives.scan_event_log(spark, str(tmp_path))


def test_bad_utf8_is_ignored(spark, tmp_path):
    bad = "\t".join(cells(_0="a#b\N{REPLACEMENT CHARACTER}é")).encode().replace(b"#", b"\xff\xfe")
    (tmp_path / "a.csv").write_bytes(bad + b"\n")
    row = files.scan_tsv(spark, str(tmp_path / "a.csv")).first()
    assert row.GLOBALEVENTID == "ab\N{REPLACEMENT CHARACTER}é"


def test_event_log_paths():
    assert files.event_log_paths("20251231", "20260101", "b/") == [
        "b/20251231.export.CSV.zip", "b/20260101.export.CSV.zip",
    ]
    assert len(files.event_log_paths("20251231", "", "b")) == 1
    with pytest.raises(ValueError):
        files.event_log_paths("20260101", "20251231", "b")
    with pytest.raises(ValueError):
        files.event_log_paths("2026-01-01", None, "b")


# --- stations -----------------------------------------------------------------------------------


def test_stations(spark, tmp_path):
    (tmp_path / "s.csv").write_text("airport,icao,latitude,longitude\nWarsaw,EPWA,52.1657,20.9671\n")
    (tmp_path / "s.json").write_text(
        json.dumps([{"icao": "EPWA", "airport": "Warsaw", "latitude": "52.1657", "longitude": 20.9671}])
    )
    for name in ("s.csv", "s.json"):
        rows = stations.load_stations(spark, str(tmp_path / name)).collect()
        assert [tuple(r) for r in rows] == [("EPWA", "Warsaw", 52.1657, 20.9671)]
    assert stations.load_stations(spark).count() == 39


def test_station_errors(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("icao,airport,latitude,longitude\n")
    (tmp_path / "short.csv").write_text("icao,airport\nEPWA,Warsaw\n")
    (tmp_path / "word.csv").write_text("icao,airport,latitude,longitude\nEPWA,Warsaw,north,1\n")
    with pytest.raises(ValueError, match="empty"):
        stations.load_stations(spark, str(tmp_path / "empty.csv"))
    with pytest.raises(ValueError, match="latitude"):
        stations.load_stations(spark, str(tmp_path / "short.csv"))
    with pytest.raises(Exception, match="north"):
        stations.load_stations(spark, str(tmp_path / "word.csv")).collect()


def test_station_code_files(spark, tmp_path):
    (tmp_path / "s.txt").write_text("KJFK,KLAX\nEPWA\n\n")
    (tmp_path / "blank.txt").write_text(" \n")

    def codes(path):
        return [r.station for r in stations.load_station_codes(spark, path).collect()]

    assert codes(str(tmp_path / "s.txt")) == ["KJFK", "KLAX", "EPWA"]
    assert codes(str(tmp_path / "none.txt")) == list(fixed.DEFAULT_METAR_STATIONS)
    assert codes(str(tmp_path / "blank.txt")) == codes(None) == list(fixed.DEFAULT_METAR_STATIONS)


# --- topics ----------------------------------------------------------------------------------------


def test_topic_options():
    options = kafka.source_options("h:9092", fixed.BOARD_TOPICS, starting="latest", max_per_trigger=5)
    assert options == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "EGLL,EDDB,EPWA,EDDF",
        "startingOffsets": "latest", "maxOffsetsPerTrigger": "5",
    }
    assert kafka.source_options("h", ["a"])["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        kafka.source_options("h", ["a"], starting="middle")


def test_schemas_match_fixed_names():
    assert [f.name for f in schemas.HOURLY_WEATHER.fields][5:] == list(fixed.HOURLY_METRICS)
    assert len(schemas.DELAY_FACTS.fields) == 23 and len(schemas.METAR_EVENT.fields) == 23


def test_bad_cells_fail_unless_they_are_asked_for(spark, tmp_path):
    from skylag import schemas

    def read(line, **options):
        path = tmp_path / f"f{abs(hash(line))}.csv"
        path.write_text(f"FLT_DATE,ENTITY_NAME,FLT_ERT_1,DLY_ERT_1\n{line}\n")
        return files.scan_csv(spark, str(path), schemas.DELAY_FACTS, **options).collect()[0]

    assert read("2025-02-01T00:00:00,A,12.0,3").FLT_ERT_1 == 12
    assert read("2025-02-01T00:00:00,A,,3").FLT_ERT_1 is None
    for line in (
        "2025-02-01T00:00:00,A,12,x7", "01-FEB-25,A,12,7", "2025-02-01T00:00:00,A,12.5,7",
        "2025-02-01T00:00:00,A,many,7", "2025-02-01T00:00:00,A",
    ):
        with pytest.raises(Exception):
            read(line)
        row = read(line, bad_lines="bad")
        assert row.bad is not None and "A" in row.bad
    assert read("2025-02-01T00:00:00,A,12,7", bad_lines="bad").bad is None


def test_event_log_stream_reads_all_kinds(spark, tmp_path):
    from skylag.plans import live
    from skylag.streaming import runs

    body = ("\n".join(LINES) + "\n").encode()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv.gz").write_bytes(gzip.compress(body))
    with zipfile.ZipFile(tmp_path / "in" / "b.CSV.zip", "w") as archive:
        archive.writestr("first.csv", body)
    one = files.tsv_records(spark.createDataFrame([(x,) for x in LINES], "value string")).count()
    assert runs.run_bounded(live.event_log_out(spark, str(tmp_path / "in"))).count() == 2 * one


def test_zip_code_needs_no_package_on_the_workers(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    (tmp_path / "code").write_bytes(cloudpickle.dumps(archives._unpack(False)))
    code = "import pickle; assert list(pickle.load(open('code', 'rb'))([])) == []"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": ""})


def test_batch_job_starts_from_another_folder(spark, tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    repo = Path(__file__).resolve().parents[1]
    with zipfile.ZipFile(tmp_path / "skylag.zip", "w") as archive:
        for file in (repo / "skylag").rglob("*.py"):
            archive.write(file, file.relative_to(repo))
    names = schemas.DELAY_FACTS.fieldNames()
    values = {"FLT_DATE": "2025-02-01T00:00:00", "ENTITY_NAME": "Poland", "ENTITY_TYPE": "x", "FLT_ERT_1": "12.0"}
    (tmp_path / "f.csv").write_text(",".join(names) + "\n" + ",".join(values.get(n, "1") for n in names) + "\n")
    import pyspark

    submit = Path(pyspark.__file__).parent / "bin" / "spark-submit"
    done = subprocess.run(
        [str(submit), "--master", "local[2]", "--conf", "spark.ui.enabled=false", "--py-files", "skylag.zip",
         str(repo / "bin" / "batch.py"), "delays", "--flights", "f.csv", "--out", "out"],
        cwd=tmp_path, capture_output=True, text=True, timeout=240,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    rows = tables.read_table(spark, str(tmp_path / "out" / "daily_delays")).collect()
    assert [(str(r.date), r.ENTITY_NAME, r.total_flights) for r in rows] == [("2025-02-01", "Poland", 12)]
