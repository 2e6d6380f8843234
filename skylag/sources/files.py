"""CSV, Parquet and tab-separated files."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag import fixed, schemas
from skylag.functions import text

# quotes inside a quoted cell are doubled, as other CSV tools do it, and blanks are kept
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# Written as "", an empty text differs from a null; Spark reads both as null without this.
_EMPTY = chr(0xFDD1)  # never used in text
# Written for a line end inside a cell: Spark splits files at line ends, quoted or not.
_LINE_ENDS = {"\n": chr(0xFDD2), "\r": chr(0xFDD3)}  # never used in text
_BAD_CHARACTER = "\N{REPLACEMENT CHARACTER}"
_KEPT_CHARACTER = chr(0xFDD0)  # never used in text


def _header(spark: SparkSession, path: str) -> tuple[list[str], bool]:
    """Column names of a CSV, and whether all are as in the file. Of two with one name the last
    keeps it."""
    first = spark.read.options(**{**CSV_OPTIONS, "header": False}).csv(path).first() or []
    names = [
        f"_c{i}" if not name or name in first[i + 1 :] else name for i, name in enumerate(first)
    ]
    return names, names == list(first)


def _whole_number(cell: Column, kind: T.DataType) -> tuple[Column, Column]:
    """(value, whether the cell is not a whole number); `12.0` is one."""
    plain = cell.try_cast(kind)
    real = cell.try_cast("double")
    # above 2**53 a double no longer tells neighbouring whole numbers apart
    exact = (real == F.floor(real)) & (F.abs(real) < 2.0**53)
    value = F.coalesce(plain, F.when(exact, real.try_cast(kind)))
    return value, F.isnotnull(cell) & (F.trim(cell) != "") & F.isnull(value)


def _with_line_ends(cell: Column) -> Column:
    for end, mark in _LINE_ENDS.items():
        cell = F.replace(cell, F.lit(mark), F.lit(end))
    return cell


def one_line_cells(df: DataFrame) -> DataFrame:
    """Texts with a mark in place of each line end, so that a record of a CSV file is one line.

    `scan_csv` puts the line ends back. Files stay splittable, whatever their cells hold.
    """
    def marked(name: str) -> Column:
        cell = F.col(f"`{name}`")
        for end, mark in _LINE_ENDS.items():
            cell = F.replace(cell, F.lit(end), F.lit(mark))
        return cell.alias(name)

    return df.select(*[
        marked(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields
    ])


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None,
    bad_lines: str | None = None,
    **options,
) -> DataFrame:
    """CSV with a header, plain or compressed (.gz, .bz2), under a declared schema.

    Only the header line is read up front. Columns are matched by name, so their order in
    the file does not matter; a declared column the file lacks is null, others are left out.
    A cell that does not parse, or a line with too few cells, ends the read with an error. With
    `bad_lines`, such cells are null instead, and a column of that name keeps the line; it is null
    for all good lines. Whole numbers may be written with a zero fraction.
    Without a schema, Spark infers one, which reads every file twice.
    """
    reader = spark.read.options(**CSV_OPTIONS, **options)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    header, as_in_file = _header(spark, path)
    if not header:
        empty = T.StructType(list(schema.fields))
        return spark.createDataFrame([], empty.add(bad_lines, "string") if bad_lines else empty)
    whole = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    declared = {
        f.name: T.StructField(f.name, T.StringType()) if isinstance(f.dataType, whole) else f
        for f in schema.fields
    }
    in_file = T.StructType([declared.get(n, T.StructField(n, T.StringType())) for n in header])
    if bad_lines:
        in_file = in_file.add(bad_lines, "string")
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=bad_lines)
        # the line is known only if all its cells are parsed
        as_in_file = False
    else:
        reader = reader.option("mode", "FAILFAST")
    # Every file of the path must have this header, or the read fails instead of mixing columns.
    # Names that occur twice or are empty cannot be compared.
    rows = (
        reader.options(emptyValue=_EMPTY, enforceSchema=not as_in_file).schema(in_file).csv(path)
    )
    faults: list[Column] = []

    def column(field: T.StructField) -> Column:
        if field.name not in header:
            return F.lit(None).cast(field.dataType).alias(field.name)
        cell = F.col(f"`{field.name}`")
        if isinstance(field.dataType, whole):
            cell = F.when(cell != _EMPTY, cell)
            value, bad = _whole_number(cell, field.dataType)
            if bad_lines:
                faults.append(bad)
                return value.alias(field.name)
            fault = F.raise_error(F.concat(F.lit(f"not a whole number in {field.name}: "), cell))
            return F.when(bad, fault.cast(field.dataType)).otherwise(value).alias(field.name)
        if not isinstance(field.dataType, T.StringType):
            return cell
        return F.when(cell == _EMPTY, F.lit("")).otherwise(_with_line_ends(cell)).alias(field.name)

    columns = [column(f) for f in schema.fields]
    if bad_lines:
        line = F.concat_ws(",", *[F.col(f"`{n}`").cast("string") for n in header])
        found = F.coalesce(F.col(bad_lines), F.when(reduce(or_, faults, F.lit(False)), line))
        columns.append(found.alias(bad_lines))
    return rows.select(*columns)


def scan_yearly(spark: SparkSession, paths: list[str], schema: T.StructType, **options):
    """Several files as one table, aligned by column name, duplicates kept."""
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [scan_csv(spark, path, schema, **options) for path in paths],
    )


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_csv(df: DataFrame, path: str, compression: str = "none", mode: str = "errorifexists"):
    """CSV with a header. Line ends inside cells are marked, see `one_line_cells`."""
    one_line_cells(df).write.options(**CSV_OPTIONS, compression=compression).mode(mode).csv(path)


def ignore_bad_utf8(line: Column) -> Column:
    """Text without the bytes that are not UTF-8; valid text is returned as it is."""
    # a replacement character that was in the text already is kept aside
    guarded = F.replace(line, F.lit(_BAD_CHARACTER), F.lit(_KEPT_CHARACTER))
    cleaned = F.replace(F.make_valid_utf8(guarded), F.lit(_BAD_CHARACTER), F.lit(""))
    restored = F.replace(cleaned, F.lit(_KEPT_CHARACTER), F.lit(_BAD_CHARACTER))
    return F.when(F.is_valid_utf8(line), line).otherwise(restored)


def tsv_records(
    lines: DataFrame, schema: T.StructType = schemas.EVENT_LOG, value: str = "value"
) -> DataFrame:
    """Tab-separated lines to text columns.

    Empty and short lines are skipped, surplus cells ignored, and empty cells stay empty text.
    """
    width = len(schema)
    line = F.col("_line")
    has_quote = line.contains('"')
    tabs = F.octet_length(line) - F.octet_length(F.replace(line, F.lit("\t"), F.lit("")))
    # Spark moves the filter below the split, so it counts tabs instead of splitting twice.
    count = F.when(has_quote, F.size(text.cells(line))).otherwise(tabs + 1)
    return (
        lines.select(ignore_bad_utf8(F.col(value)).alias("_line"))
        .filter(count >= width)
        .select(text.cells(line).alias("_row"))
        .select(*[F.get("_row", F.lit(i)).alias(f.name) for i, f in enumerate(schema.fields)])
    )


def scan_tsv(spark: SparkSession, path: str, schema: T.StructType = schemas.EVENT_LOG):
    """Tab-separated files, plain or .gz."""
    return tsv_records(spark.read.text(path), schema)


def event_log_paths(start: str, end: str | None, base: str, suffix: str = fixed.EVENT_LOG_SUFFIX):
    """Input paths of an event log, one per day of a range given as YYYYMMDD texts."""
    first = datetime.strptime(start, "%Y%m%d")
    last = datetime.strptime(end or start, "%Y%m%d")
    if last < first:
        raise ValueError("end date must be the same or later than start date")
    days = (first + timedelta(days=n) for n in range((last - first).days + 1))
    return [f"{base.rstrip('/')}/{day:%Y%m%d}.{suffix}" for day in days]
