"""Files by window that are finished at some point: a window's folder is marked once no more rows can come to it.

The sink keeps its own watermark, from the rows of the batches before, in a small file per batch. A row whose window has
been sealed goes to the late rows instead. Everything follows from the batch and the file before it, so a batch that is
replayed after a failure writes the same rows to the same places.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.sinks.manifests import SharedFiles, add_version, newest

PROGRESS = "_progress"
SEALED = "_SEALED"
STAMP = "%Y%m%d-%H%M%S"
_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def window_name(start_ms: int) -> str:
    return (_EPOCH + timedelta(milliseconds=start_ms)).strftime(STAMP)


def sealed_windows(path: str, line: Column, time: str, size: timedelta, delay: timedelta) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: lines into ``path/w=<start>/batch_id=<n>``, late ones into ``path/_late/batch_id=<n>``.

    A window is sealed, by an empty file ``_SEALED`` in its folder, when the latest time seen is ``delay`` past its end.
    Rows without a time are late. ``size`` is of whole seconds.
    """
    size_ms, delay_ms = size // timedelta(milliseconds=1), delay // timedelta(milliseconds=1)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        files = SharedFiles(spark)
        before = newest(files, f"{path}/{PROGRESS}", batch_id)
        watermark, open_windows = (before[1]["watermark"], before[1]["open"]) if before else (None, [])
        moment = F.floor(F.unix_micros(F.col(time).cast("timestamp")) / 1000)
        start = F.floor(moment / size_ms) * size_ms
        rows = batch.select(line.alias("value"), moment.alias("_at"), start.alias("_start"))
        rows = rows.withColumn("_late", F.coalesce(F.col("_start") + size_ms <= F.lit(watermark), F.col("_start").isNull())).persist()
        try:
            seen = rows.agg(F.max("_at")).first()[0]
            starts = [r[0] for r in rows.filter("NOT _late").select("_start").distinct().toLocalIterator()]
            stamp = F.date_format(F.timestamp_millis("_start"), "yyyyMMdd-HHmmss")
            on_time = rows.filter("NOT _late").select("value", stamp.alias("w"), F.lit(batch_id).alias("batch_id"))
            on_time = on_time.hint("rebalance", "w")  # a file or few per window, a large window cut in several
            on_time.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("w", "batch_id").text(f"{path}")
            rows.filter("_late").select("value").write.mode("overwrite").text(f"{path}/_late/batch_id={batch_id}")
        finally:
            rows.unpersist()
        reached = watermark if seen is None else max(seen - delay_ms, seen - delay_ms if watermark is None else watermark)
        waiting = sorted({*open_windows, *starts})
        done = [x for x in waiting if reached is not None and x + size_ms <= reached]
        for x in done:
            files.write_new(f"{path}/w={window_name(x)}/{SEALED}", "")
        # last of all: a replay finds either the same file before it, or, after this one, the same content here
        add_version(files, f"{path}/{PROGRESS}", batch_id, {"watermark": reached, "open": [x for x in waiting if x not in set(done)]})

    return write


def read_sealed(spark: SparkSession, path: str) -> DataFrame:
    """``value, w, batch_id`` of the sealed windows: rows that no later batch adds to."""
    files = SharedFiles(spark)
    done = [name for name in files.names(f"{path}") if name.startswith("w=") and files.exists(f"{path}/{name}/{SEALED}")]
    if not done:
        return spark.createDataFrame([], "value string, w string, batch_id int")
    rows = spark.read.schema("value string, w string, batch_id int").option("basePath", f"{path}")
    return rows.text([f"{path}/{name}" for name in done])


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """``value, batch_id`` of the rows whose window had been sealed."""
    return spark.read.schema("value string, batch_id int").text(f"{path}/_late")
