"""Event logs by file suffix. Spark reads .gz and .bz2 by itself, but not .zip."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag import schemas
from skylag.sources.files import tsv_records

_BATCH_LINES = 20_000
# file names are compared without regard to case
TEXT_SUFFIXES = ("tsv", "csv", "txt", "gz", "bz2")
_TEXT = "*.{" + ",".join(f"{s},{s.upper()}" for s in TEXT_SUFFIXES) + "}"
_ZIP = "*.{zip,ZIP}"


def _unpack(first_only: bool):
    # nested, so that it goes to the workers by value and they need not have this package
    def lines(batches: Iterator) -> Iterator:
        import io
        import zipfile

        import pyarrow as pa

        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                archive = zipfile.ZipFile(io.BytesIO(content.as_py()))
                members = archive.namelist()
                if len(members) > 1 and not first_only:
                    raise ValueError(f"{path.as_py()} has {len(members)} members: {members[:3]}")
                if not members:
                    continue
                with archive.open(members[0]) as member:
                    text = io.TextIOWrapper(member, encoding="utf-8", errors="ignore", newline="\n")
                    while chunk := [x.rstrip("\r\n") for _, x in zip(range(_BATCH_LINES), text)]:
                        yield pa.RecordBatch.from_pydict({"value": pa.array(chunk, pa.string())})

    return lines


def zip_lines(files: DataFrame, first_only: bool = False) -> DataFrame:
    """Lines of zip archives given as rows of Spark's binary files (`path`, `content`).

    A zip archive cannot be split, so each one is read by one task, and lines leave it in
    batches. Meant for daily files; a folder of them is spread over the executors. An archive
    with several members is an error, unless only the first is asked for.
    """
    return files.select("path", "content").mapInArrow(_unpack(first_only), "value string")


def scan_tsv_zip(spark: SparkSession, path: str, schema=schemas.EVENT_LOG, first_only: bool = False):
    return tsv_records(zip_lines(spark.read.format("binaryFile").load(path), first_only), schema)


def _files(reader, path, glob: str) -> DataFrame:
    return reader.format("binaryFile").option("pathGlobFilter", glob).load(path)


def event_log_lines(
    spark: SparkSession, path: str | list[str], first_only: bool = False, stream: bool = False
) -> DataFrame:
    """Lines of all files of a folder, or of paths, each read by its suffix: plain, .gz, .bz2, .zip.

    A suffix that is not known is an error. A stream checks the files that are there when it
    starts, and reads later ones of known suffixes.
    """
    # only names are listed here, no content is read
    names = spark.read.format("binaryFile").load(path).select("path")
    known = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*TEXT_SUFFIXES, "zip")
    other = names.filter(~known).first()
    if other:
        raise ValueError(f"neither text nor zip: {other.path}")
    reader = spark.readStream if stream else spark.read
    text = reader.format("text").option("pathGlobFilter", _TEXT)
    if stream:
        kind = "path string, modificationTime timestamp, length long, content binary"
        reader = spark.readStream.schema(kind)
    plain = text.load(path).select("value")
    return plain.unionByName(zip_lines(_files(reader, path, _ZIP), first_only))


def scan_event_log(
    spark: SparkSession, path: str | list[str], schema=schemas.EVENT_LOG, first_only: bool = False
) -> DataFrame:
    """The event log of a folder or of daily paths, whatever the kind of each file."""
    return tsv_records(event_log_lines(spark, path, first_only), schema)
