"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.text import WORD, words


def count_elements(df: DataFrame, element: Column, name: str = "element", count: str = "count") -> DataFrame:
    """How often each distinct element occurs."""
    return df.groupBy(element.alias(name)).agg(F.count(F.lit(1)).alias(count))


def explode_words(df: DataFrame, text: str, pattern: str = WORD, word: str = "word") -> DataFrame:
    """One row per word of the text, next to the other columns."""
    others = [name for name in df.columns if name != text]
    return df.select(*others, F.explode(words(F.col(text), pattern)).alias(word))


def count_words(text: str, pattern: str = WORD, word: str = "word", count: str = "count"):
    """A reusable step for ``DataFrame.transform``: lines in, word counts out.

    The counts are partial per task before the shuffle, so a word that makes up a
    third of the text sends one row per task.
    """
    def step(lines: DataFrame) -> DataFrame:
        return count_elements(explode_words(lines.select(text), text, pattern, word), F.col(word), word, count)
    return step


def mean_of(value: Column) -> Column:
    """The mean of the values as they are. Sums of doubles may differ in the last digits with the order of the rows."""
    return F.avg(value.cast("double"))


def total_of(value: Column) -> Column:
    return F.sum(value.cast("double"))


def any_flag(rule: Column) -> Column:
    """1 when the rule holds for at least one row of the group, else 0."""
    return F.max(F.when(rule, F.lit(1)).otherwise(F.lit(0)))


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The last row per key, as repeated writes to a key-value store leave it.

    ``max_by`` over a struct keeps one candidate per key and task before the shuffle.
    """
    others = [name for name in df.columns if name not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*others), F.struct(*order_by)).alias("_latest"))
    return picked.select(*keys, *[F.col(f"_latest.{name}").alias(name) for name in others])
