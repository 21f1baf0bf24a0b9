"""Starting streams: sources, sinks, checkpoints."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.sinks.keyed_log import upsert_each


def stream_files(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                 glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def open_rows(spark: SparkSession, folder: str, schema: T.StructType, streaming: bool, **options) -> DataFrame:
    """The mode switch: the same rows as a batch or as a stream."""
    if streaming:
        return stream_files(spark, folder, schema, **options)
    reader = spark.read.schema(schema).format(options.get("fmt", "parquet"))
    if options.get("glob"):
        reader = reader.option("pathGlobFilter", options["glob"])
    return reader.load(folder)


def write_stream_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                       partition_by: str | None = None, once: bool = False) -> StreamingQuery:
    """Append to files, exactly once. ``once`` takes what is there and stops."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def write_stream_upserts(df: DataFrame, path: str, checkpoint: str, once: bool = False,
                         mode: str = "update") -> StreamingQuery:
    """Changed rows of every micro-batch into a keyed log; read it with ``read_current``."""
    return write_stream_batches(df, upsert_each(path), checkpoint, once, mode)


def write_stream_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False,
                         mode: str = "append") -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def to_sinks(*writes: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """One micro-batch to several sinks: read and computed once, released when all have it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for each in writes:
                each(batch, batch_id)
        finally:
            batch.unpersist()
    return write


def wait_all(*queries: StreamingQuery) -> None:
    """Wait until every stream has ended. When one fails, the others are stopped and its error is raised."""
    running = list(queries)
    try:
        while running:
            running = [query for query in running if not query.awaitTermination(1)]
    finally:
        for query in running:
            query.stop()
