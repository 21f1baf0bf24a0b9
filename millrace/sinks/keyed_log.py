"""A keyed table as a log of batches: idempotent upserts without a merge-capable format.

Each batch is one folder. Writing a batch again replaces its folder, so a replay
after a failure changes nothing. Reading takes the last version of every key, which
each task does for its own rows before they are shuffled.
Old folders are never rewritten by an upsert: its cost follows the batch, not the
table. ``merge_levels`` keeps the cost of reading down: when enough batches have come
they are merged into a folder of the next level, and so on, so that a row is rewritten
once per level and a reader opens a few folders per level. What a reader takes is named
by the newest manifest. A merge writes its folder first and then adds a manifest, so it
is seen whole or not at all, and what it replaced stays until ``remove_merged``.
``compact`` copies a whole log into a new one.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.aggregates import latest_per_key
from millrace.sinks.manifests import SharedFiles, add_version, newest

BATCH = "batch_id"
MANIFESTS = "_versions"  # names that begin with _ are no data to Spark's readers
LEVELS = "_levels"


def upsert_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def upsert_each(path: str):
    """For ``writeStream.foreachBatch``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, path, batch_id)
    return write


def read_current(spark: SparkSession, path: str, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """The last row of every key.

    By default the row of the latest batch, as repeated upserts leave it. Rows that
    may arrive out of order are ordered by their own columns: name those, with
    ``batch_id`` at the end if equal rows of two batches may differ.
    """
    versions = read_versions(spark, path)
    columns = [name for name in versions.columns if name != BATCH]
    return latest_per_key(versions, keys, order_by or [BATCH]).select(*columns)


def _batches(files: SharedFiles, path: str) -> list[int]:
    return sorted(int(name.removeprefix(f"{BATCH}=")) for name in files.names(path) if name.startswith(f"{BATCH}="))


def _manifest(files: SharedFiles, path: str) -> tuple[int, dict]:
    return newest(files, f"{path}/{MANIFESTS}") or (-1, {"through": -1, "levels": [], "replaced": []})


def _read_batches(spark: SparkSession, path: str, batches: list[int]) -> DataFrame:
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/{BATCH}={b}" for b in batches])
    return rows.withColumn(BATCH, F.col(BATCH).cast("long"))


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows with their ``batch_id``: merged folders of the newest manifest, and the batches after it.

    A frame keeps reading the folders it was made with, so a merge in the meantime does not change it.
    """
    files = SharedFiles(spark)
    number, manifest = _manifest(files, path)
    if number < 0:
        return spark.read.option("basePath", path).parquet(path)
    parts = [spark.read.parquet(f"{path}/{LEVELS}/{x['name']}") for x in manifest["levels"]]
    batches = [b for b in _batches(files, path) if b > manifest["through"]]
    if batches:
        parts.append(_read_batches(spark, path, batches))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows


def merge_levels(spark: SparkSession, path: str, keys: list[str], order_by: list[str] | None = None, fan: int = 8,
                 hold: int = 1) -> int:
    """Merge every ``fan`` neighbouring batches or folders of a level into one of the next; the number of merges.

    The last ``hold`` batches stay as they are, since a stream that restarts writes its last batch again. Give the order
    that the log is read with. One merge is one version: whoever is second to add it leaves its folder unused and stops.
    A killed merge leaves an unused folder and nothing else.
    """
    files, merges = SharedFiles(spark), 0
    while True:
        number, manifest = _manifest(files, path)
        waiting = [b for b in _batches(files, path) if b > manifest["through"]]
        waiting = waiting[:len(waiting) - hold] if hold else waiting
        levels = manifest["levels"]
        full = [level for level in {x["level"] for x in levels} if sum(x["level"] == level for x in levels) >= fan]
        if full:
            level = min(full)
            taken = [x for x in levels if x["level"] == level][:fan]
            rows = spark.read.parquet(*[f"{path}/{LEVELS}/{x['name']}" for x in taken])
            first, last, through = taken[0]["first"], taken[-1]["last"], manifest["through"]
        elif len(waiting) >= fan:
            level, taken = 0, []
            rows = _read_batches(spark, path, waiting[:fan])
            first, last, through = waiting[0], waiting[fan - 1], waiting[fan - 1]
        else:
            return merges
        merged = {"name": f"{level + 1}-{first}-{last}-{uuid.uuid4().hex}", "level": level + 1, "first": first, "last": last}
        latest_per_key(rows, keys, order_by or [BATCH]).write.parquet(f"{path}/{LEVELS}/{merged['name']}")
        left = [x for x in levels if x not in taken]
        gone = [f"{LEVELS}/{x['name']}" for x in taken] or [f"{BATCH}={b}" for b in waiting[:fan]]
        version = {"through": through, "levels": sorted([*left, merged], key=lambda x: x["first"]),
                   "replaced": [*manifest["replaced"], *[[time.time(), name] for name in gone]]}
        if not add_version(files, f"{path}/{MANIFESTS}", number + 1, version):
            return merges
        merges += 1


def remove_merged(spark: SparkSession, path: str, after_seconds: float = 7 * 86400) -> int:
    """Delete the folders that merges replaced more than ``after_seconds`` ago; the number deleted.

    Choose a time that no reader outlasts. Only folders named in a manifest go; the next manifest forgets them.
    """
    files = SharedFiles(spark)
    number, manifest = _manifest(files, path)
    old = [x for x in manifest["replaced"] if x[0] <= time.time() - after_seconds]
    if not old:
        return 0
    version = manifest | {"replaced": [x for x in manifest["replaced"] if x not in old]}
    for _, name in old:
        files.delete(f"{path}/{name}")
    add_version(files, f"{path}/{MANIFESTS}", number + 1, version)
    return len(old)


def compact(spark: SparkSession, path: str, new_path: str, keys: list[str],
            order_by: list[str] | None = None) -> None:
    """The current rows as a new log. The newest batch id is kept, so a stream can go on with it."""
    last = read_versions(spark, path).agg(F.max(BATCH)).first()[0]
    upsert_batch(read_current(spark, path, keys, order_by), new_path, last)
