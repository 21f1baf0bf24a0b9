"""Joins of wide rows with a list of ids that spare most rows the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLOOM_BITS = 1 << 24


def _place(key: str) -> tuple[Column, Column]:
    bit = F.pmod(F.xxhash64(key), F.lit(BLOOM_BITS))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
    return F.shiftright(bit, 6).cast("int"), mask


def _marked(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``_maybe``: false only if the key is surely not in ``ids``.

    The marks are a Bloom filter of fixed size, at most ``BLOOM_BITS / 64`` rows whatever the input, and so broadcast.
    """
    word, mask = _place(key)
    bloom = ids.groupBy(word.alias("_word")).agg(F.bit_or(mask).alias("_mask"))
    joined = rows.withColumn("_word", word).join(F.broadcast(bloom), "_word", "left")
    return joined.withColumn("_maybe", F.coalesce(F.col("_mask").bitwiseAND(mask) != 0, F.lit(False))).drop("_word", "_mask")


def rows_perhaps_among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """All rows whose ``key`` is in ``ids``, and some others: for a join with ``ids`` that follows anyway. No row is shuffled."""
    return _marked(rows, ids, key).filter("_maybe").select(*rows.columns)


def rows_among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is in ``ids``; few others are shuffled. A null key is in no list."""
    return _marked(rows, ids, key).filter("_maybe").drop("_maybe").join(ids.select(key), key, "left_semi").select(*rows.columns)


def rows_without(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is not in ``ids``; only those that may be are shuffled. Null keys stay."""
    marked = _marked(rows, ids, key)
    unsure = marked.filter("_maybe").drop("_maybe").join(ids.select(key), key, "left_anti")
    return marked.filter("NOT _maybe").select(*rows.columns).unionByName(unsure.select(*rows.columns))
