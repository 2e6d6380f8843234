"""The first row of each key, whenever it comes, by keyed state with a forgetting time per key."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIRST, REPEATS = "is_first", "repeats"


# groups of keys, by their hash, whose state is kept as one value
GROUPS = 1 << 12


def _keeper(names: list[str], forget_ms: int):
    # made in a function, so that it goes to the workers by value and they need not have this package
    import json

    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor

    class Keeper(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            # the keys of a group, each with the time when it is to be forgotten, counted from its latest row
            self.until = handle.getValueState("until", "until string")

        def handleInputRows(self, key, rows, timerValues) -> Iterator:
            found = {}
            for row in rows:
                order, entry = (row["_arrived_ms"], row["_order"]), found.get(row["_key"])
                if entry is None:
                    found[row["_key"]] = [order, row, row["_latest_ms"], row["_number"]]
                    continue
                entry[2], entry[3] = max(entry[2], row["_latest_ms"]), entry[3] + row["_number"]
                if order < entry[0]:
                    entry[:2] = order, row
            state = self.until.get()
            kept = json.loads(state[0]) if state is not None else {}
            changed, out = False, []
            for name, (order, row, latest, number) in found.items():
                old = kept.get(name)
                # the timer comes after the rows of its batch, so the time is looked at here, too
                known = old is not None and not (forget_ms and order[0] > old)
                if old is None or (forget_ms and latest + forget_ms > old):
                    kept[name], changed = latest + forget_ms if forget_ms else 0, True
                if known:
                    out.append(Row(**{n: None for n in names}, **{FIRST: False, REPEATS: number}))
                else:
                    out.append(Row(**{n: row[n] for n in names}, **{FIRST: True, REPEATS: number - 1}))
            if changed:
                self.until.update((json.dumps(kept),))
            if forget_ms and state is None:
                # one timer for each group is enough; it asks for the group again as long as it has keys
                self.handle.registerTimer(min(kept.values()))
            return iter(out)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
            state = self.until.get()
            if state is not None:
                now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
                kept = {name: until for name, until in json.loads(state[0]).items() if until > now}
                if kept:
                    self.until.update((json.dumps(kept),))
                    self.handle.registerTimer(min(kept.values()))
                else:
                    self.until.clear()
            return iter(())

        def close(self) -> None:
            pass

    return Keeper()


def _reducer(most: int = 1 << 16):
    # made in a function, as the keeper is
    def reduced(table):
        import numpy as np
        import pyarrow as pa

        ordered = table.sort_by([("_arrived_ms", "ascending"), ("_order", "ascending")])
        found = (
            ordered.select(["_key", "_latest_ms", "_number"]).append_column("_at", pa.array(np.arange(len(ordered))))
            .group_by("_key", use_threads=False).aggregate([("_at", "min"), ("_latest_ms", "max"), ("_number", "sum")])
        )
        out = ordered.take(found["_at_min"])
        for name, value in (("_latest_ms", "_latest_ms_max"), ("_number", "_number_sum")):
            out = out.set_column(out.schema.get_field_index(name), out.schema.field(name), found[value])
        return out

    def reduce(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, rows, size = [], 0, 0
        for batch in batches:
            if not len(batch):
                continue
            part = reduced(pa.Table.from_batches([batch]))
            held.append(part)
            rows, size = rows + len(part), size + part.nbytes
            if rows > most or size > 1 << 25:
                table = reduced(pa.concat_tables(held)).combine_chunks()
                held, rows, size = [table], len(table), table.nbytes
                # few repeats: it goes on, so that a task holds a bounded part of its keys
                if rows > most // 2 or size > 1 << 24:
                    yield from table.to_batches(max_chunksize=10_000)
                    held, rows, size = [], 0, 0
        if held:
            yield from reduced(pa.concat_tables(held)).to_batches(max_chunksize=10_000)

    return reduce


def _key_text(df: DataFrame, names: tuple[str, ...]) -> Column | None:
    """A text that tells keys of plain types apart as grouping does; of others there is none."""
    parts = []
    for name in names:
        kind, value = df.schema[name].dataType, F.col(name)
        if isinstance(kind, T.TimestampType):
            value = F.unix_micros(value)
        elif isinstance(kind, T.BinaryType):
            value = F.hex(value)
        elif kind != T.StringType() and not isinstance(kind, (T.BooleanType, T.IntegralType, T.DateType, T.TimestampNTZType)):
            return None
        # hex, so that any text, even one that is not UTF-8, stays as it is
        parts.append(F.coalesce(F.hex(value.cast("string").cast("binary")), F.lit("-")))
    return F.concat_ws(",", *parts)


def first_rows(
    df: DataFrame, *key_columns: str, arrived: str | None = None, forget: str = "", late_by: str = "0 seconds"
) -> DataFrame:
    """The first row of each key of a stream, whatever its own time, and how many were dropped.

    Where `is_first` is true the result has a first row, and `repeats` of its key that came in the same
    batch and were dropped. Where it is false, all other columns are null and `repeats` counts what a
    later batch had of a key. So the kept rows are those with `is_first`, and the sum of `repeats` is
    the number dropped. Rows of one batch are told by arrival, and then by their hash.

    State is kept by key until no row of it has arrived for `forget` (such as "2 hours"), or else for
    good. Time is the time of arrival, so nothing is late: unlike a de-duplication by watermark on the
    rows' own times, it loses no first row. `arrived` names a column with arrival times, which must
    not go back by more than `late_by`; the default is the time of the batch.

    Copies of a key are first reduced in the tasks that they come in, in parts of bounded size, which
    leaves one row with counts; those of a key meet in one task. Of a key only its text and one number
    are kept, those of a group of keys (by hash, `GROUPS` of them) as one value, because each call for
    state costs far more than a row; a batch writes the values of its groups anew. Keys of nested types
    or fractions are kept one by one. A checkpoint belongs to this form.
    Null is a key, too. A table is reduced before its shuffle; of a key's rows that which arrived first
    stays. A stream needs the state store on RocksDB (`state_on_disk`).
    """
    names = df.columns
    time = F.col(arrived) if arrived else F.current_timestamp()
    # a hash tells rows of one arrival time apart, so that a batch that is repeated keeps the same row
    timed = (
        df.withColumns({"_arrived": time.cast("timestamp"), "_order": F.xxhash64(F.to_json(F.struct(*names)))})
        .withColumn("_arrived_ms", F.unix_millis("_arrived"))
    )
    timed = timed.withColumns({"_latest_ms": F.col("_arrived_ms"), "_number": F.lit(1).cast("bigint")})
    if not df.isStreaming:
        best = timed.groupBy(*[F.col(c).alias(f"_key_{c}") for c in key_columns]).agg(
            F.min_by(F.struct(*names), F.struct("_arrived_ms", "_order")).alias("_first"),
            (F.count("*") - 1).alias(REPEATS),
        )
        return best.select("_first.*", F.lit(True).alias(FIRST), REPEATS)
    schema = T.StructType([
        *df.schema.fields, T.StructField(FIRST, T.BooleanType()), T.StructField(REPEATS, T.LongType())
    ])
    text = _key_text(df, key_columns)
    if text is None:
        timed, grouped = timed.withColumn("_key", F.lit("")), key_columns
    else:
        timed = timed.withColumn("_key", text)
        # the time of a reduced row is its latest, as it is for the watermark
        timed = timed.mapInArrow(_reducer(), timed.schema).withColumns({
            "_arrived": F.timestamp_millis("_latest_ms"), "_group": F.pmod(F.xxhash64("_key"), F.lit(GROUPS)),
        })
        grouped = ("_group",)
    keyed = timed.withWatermark("_arrived", late_by).groupBy(*grouped)
    return keyed.transformWithState(
        _keeper(names, _millis(df.sparkSession, forget)), schema, "append", "EventTime" if forget else "None"
    )


def _millis(spark, interval: str) -> int:
    if not interval:
        return 0
    value = spark.sql(f"SELECT CAST(INTERVAL '{interval}' AS INTERVAL DAY TO SECOND) AS i").first()["i"]
    return int(value.total_seconds() * 1000)
