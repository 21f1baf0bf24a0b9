"""Operators with state of their own, on the state store, with event-time timers.

The time a row carries into them is a copy without the watermark, so that no row is dropped before the operator has seen
it: what is late is decided here, against the same watermark that fires the timers.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def _latest_of_batch(keys: list[str], order_by: list[str]):
    """Per Arrow batch the last row of every key, so a key with a third of the rows sends few of them to the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table.take(pc.sort_indices(table, [(name, "ascending") for name in order_by], null_placement="at_start"))
            places = table.select(keys).append_column("_at", pa.array(range(len(table)), pa.int64()))
            last = places.group_by(keys, use_threads=False).aggregate([("_at", "max")]).column("_at_max")
            yield from table.take(last.sort() if hasattr(last, "sort") else pc.sort(last)).combine_chunks().to_batches()
    return run


def _before(a: tuple, b: tuple) -> bool:
    """Order of rows by their order columns; NULL comes first."""
    for x, y in zip(a, b):
        if x != y:
            return y is not None and (x is None or x < y)
    return False


class LatestRow(StatefulProcessor):
    """The last row of a key. Emits it whenever it changes; forgets the key once it has been idle for ``keep``."""

    def __init__(self, keys: list[str], row: T.StructType, order_by: list[str], time: str, keep: timedelta):
        self.made = Row(*keys, *row.names)
        self.row, self.order_by, self.time, self.keep = row, order_by, time, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", self.row)
        self.deadline = handle.getValueState("deadline", "at long")

    def _order(self, values: tuple) -> tuple:
        return tuple(values[self.row.names.index(name)] for name in self.order_by)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = tuple(self.latest.get()) if self.latest.exists() else None
        best = known
        for row in rows:
            values = tuple(row[name] for name in self.row.names)
            if best is None or _before(self._order(best), self._order(values)):
                best = values
        if best is known:
            return
        self.latest.update(best)
        moment = best[self.row.names.index(self.time)]
        if self.deadline.exists():
            self.handle.deleteTimer(self.deadline.get()[0])
        if moment is not None:
            at = max(epoch_ms(moment + self.keep), timerValues.getCurrentWatermarkInMs() + 1)
            self.handle.registerTimer(at)
            self.deadline.update((at,))
        yield self.made(*key, *best)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.latest.clear()
        self.deadline.clear()
        return iter(())

    def close(self) -> None:
        pass


def epoch_ms(moment: datetime) -> int:
    """Session time is UTC, and a worker gets timestamps without a zone."""
    return int((moment if moment.tzinfo else moment.replace(tzinfo=UTC)).timestamp() * 1000)


def latest_rows(rows: DataFrame, keys: list[str], order_by: list[str], time: str, delay: str, keep: timedelta) -> DataFrame:
    """The last row of every key by ``order_by``, from state: a row per key whenever it changes.

    Late rows take part: they lose against what the state holds. A key idle for ``keep`` of event time is forgotten, which
    bounds the state; a still later straggler of it is emitted again, so a reader orders versions by ``order_by``. A row
    with a NULL ``time`` keeps its key for good. Use update mode.
    """
    if time not in order_by:
        raise ValueError("the time must be one of the order columns")
    zoned = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.TimestampType)]
    stamped = rows.withColumn("_seen", F.col(time).cast("timestamp")).withWatermark("_seen", delay)
    # in Python a time from the state has no zone, so none has one there
    stamped = stamped.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})
    others = [f for f in stamped.drop("_seen").schema.fields if f.name not in keys]
    row = T.StructType([T.StructField(f.name, f.dataType) for f in others])
    plain = T.StructType([*[T.StructField(k, stamped.schema[k].dataType) for k in keys], *row.fields])
    fewer = stamped.select(*plain.names).mapInArrow(_latest_of_batch(keys, order_by), plain)
    found = fewer.groupBy(*keys).transformWithState(LatestRow(keys, row, order_by, time, keep), plain, "Update", "EventTime")
    return found.withColumns({name: F.col(name).cast("timestamp") for name in zoned})


class WindowSums(StatefulProcessor):
    """Count and sum of one window and key. Emitted when the watermark reaches its end; rows after that are put out as late."""

    def __init__(self, size_ms: int, names: list[str]):
        self.size_ms, self.made = size_ms, Row(*names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "n long, total double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        end = key[0] + self.size_ms
        if end <= timerValues.getCurrentWatermarkInMs():
            for row in rows:
                yield self.made(*key, True, 1, row["_value"], row["_row"])
            return
        known = self.sums.exists()
        n, total = self.sums.get() if known else (0, None)
        for row in rows:
            n += 1
            if row["_value"] is not None:
                total = row["_value"] + (total or 0.0)
        self.sums.update((n, total))
        if not known:
            self.handle.registerTimer(end - 1)  # fires once the watermark is past it, so at the end

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        n, total = self.sums.get()
        self.sums.clear()
        yield self.made(*key, False, n, total, None)

    def close(self) -> None:
        pass


def windows_and_late(rows: DataFrame, keys: list[str], value: Column, size: timedelta, delay: str, time: str = "event_time",
                     salts: int = 8) -> DataFrame:
    """Tumbling windows that are final, and every row that came too late for its own, in one stream.

    ``window_start, <keys>, salt, late, n, total, row``: with ``late`` false the count and sum of a closed window, once per
    salt; with ``late`` true one row of the input, whole, as ``row``. Every input row with a time is in exactly one closed
    window, one still open, or one late row. Rows of a key are spread over ``salts`` by their content, so a hot key and
    window is not one task; ``final_windows`` adds them up. Rows without a time have no window and are late. Append mode.
    """
    size_ms = size // timedelta(milliseconds=1)
    row = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    moment = F.unix_micros(F.col(time).cast("timestamp"))
    start = F.coalesce(F.floor(moment / (1000 * size_ms)) * size_ms, F.lit(-size_ms)).cast("long")
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    stamped = rows.withColumn("_seen", F.col(time).cast("timestamp")).withWatermark("_seen", delay)
    keyed = stamped.select(start.alias("_start"), *keys, salt.alias("salt"), value.cast("double").alias("_value"),
                           F.struct(*[F.col(name).alias(name) for name in row.names]).cast(row).alias("_row"))
    schema = T.StructType([T.StructField("_start", T.LongType()), *[T.StructField(k, row[k].dataType) for k in keys],
                           T.StructField("salt", T.IntegerType()), T.StructField("late", T.BooleanType()), T.StructField("n", T.LongType()),
                           T.StructField("total", T.DoubleType()), T.StructField("row", row)])
    found = keyed.groupBy("_start", *keys, "salt").transformWithState(WindowSums(size_ms, schema.names), schema, "Append", "EventTime")
    return found.select(F.timestamp_millis("_start").cast("timestamp_ntz").alias("window_start"), *schema.names[1:])


def final_windows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """``window_start, <keys>, n, total`` of the closed windows in files that ``windows_and_late`` was written to."""
    closed = spark.read.parquet(path).filter("NOT late")
    return closed.groupBy("window_start", *keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came too late, as they were."""
    return spark.read.parquet(path).filter("late").select("row.*")
