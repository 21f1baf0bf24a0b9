"""The corpus pipeline: documents in languages it knows, one of each group of near copies, mixed and packed."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.jaccard import jaccard_components
from millrace.llm.language import identify_languages, learn_languages
from millrace.llm.match import rows_without
from millrace.llm.mixing import domain_of_labels, mixed_rows
from millrace.llm.packing import pack_documents
from millrace.session import prepare, stored

TARGETS = {"good": 0.88, "low": 0.07, "toxic": 0.05}
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_rows(docs: DataFrame) -> DataFrame:
    """The rows numbered, so that rows with equal or null ids stay apart. ``docs`` is a table that is read, so the numbers last."""
    return docs.withColumn("_row", F.monotonically_increasing_id())


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is recognised. A null text, one without letters, and one in no learned language go."""
    judged = identify_languages(docs.select(*COLUMNS), learn_languages(docs), keep=COLUMNS)
    return judged.filter("NOT rejected").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked texts, and every row that is linked with nothing."""
    rows = _with_rows(docs)
    extra = jaccard_components(rows, id_column="_row").filter("component_id <> _row").select("_row")
    return rows_without(rows, stored(extra, "extra"), "_row").select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or left out by their rates, so that the expected words of each domain match ``TARGETS``."""
    rows = _with_rows(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumn("domain", domain_of_labels())
    return mixed_rows(rows, labels, TARGETS, key="_row", columns=list(COLUMNS), label_id="doc_id")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows with their places in sequences of 4096 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("near_copies", near_copies), ("mixing", mixed), ("packing", packed)]

#: Classifiers, similarity joins and tokenizers are not SQL; a test holds the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return functools.reduce(lambda rows, stage: stored(stage[1](spark, rows, sf_dir), stage[0]), STAGES, docs)
