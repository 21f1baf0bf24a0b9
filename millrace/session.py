"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SHIPPED = "millrace.package.shipped"
ROCKSDB_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "millrace", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with UTC time, adaptive execution and a spilling state store.

    ``master`` is left to ``spark-submit`` when it is None, and so are executor
    sizes and shuffle partitions: a cluster job should set
    ``spark.sql.shuffle.partitions`` high (adaptive execution merges small ones).
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_STATE,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Make any session fit for the library: timestamps in UTC, state on disk, and the package known to the Python workers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STATE)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, as ``--py-files`` would."""
    if spark.conf.get(SHIPPED, None) == spark.sparkContext.applicationId:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="millrace-package-")) / f"millrace-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    spark.conf.set(SHIPPED, spark.sparkContext.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is only ever used with a local master, where the
    driver and the executors are one process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    local = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used before, below the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    Every later use sees the same rows whatever is recomputed, the lineage ends
    here, and the planner knows the size of what it reads.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
