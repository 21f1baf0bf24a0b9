"""Object-store paths."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from millrace.functions.text import without_prefix

SCHEME = "s3://"  # fixed value: the scheme that configuration files use


def bucket_name(path: str) -> str:
    """The bucket of ``s3://bucket/prefix``."""
    return path.removeprefix(SCHEME).split("/", 1)[0]


def spark_path(path: str) -> str:
    """The same object under the scheme of the Hadoop client."""
    return "s3a://" + path.removeprefix(SCHEME) if path.startswith(SCHEME) else path


def use_endpoint(spark: SparkSession, endpoint: str) -> None:
    """Point the Hadoop client at an S3-compatible store. Needs hadoop-aws with the job."""
    spark.conf.set("fs.s3a.endpoint", endpoint)
    spark.conf.set("fs.s3a.path.style.access", "true")


def bucket_column(path: Column, scheme: str = SCHEME) -> Column:
    return F.substring_index(without_prefix(path, scheme), "/", 1)


def key_column(path: Column, scheme: str = SCHEME) -> Column:
    """Everything after the bucket; empty when there is nothing."""
    rest = without_prefix(path, scheme)
    return F.when(F.contains(rest, F.lit("/")), F.substring(rest, F.locate("/", rest) + 1, F.length(rest))).otherwise("")
