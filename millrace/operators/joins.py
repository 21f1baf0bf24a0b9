"""Joins.

No join forces a broadcast, and only a salted one rules it out. Spark broadcasts a dimension when its size estimate,
or under adaptive execution its measured size, is below
``spark.sql.autoBroadcastJoinThreshold``; above it the join is a shuffle whose
skewed partitions adaptive execution splits. ``salts`` spreads a hot key ahead of
time where adaptive execution is off, as in a streaming query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.operators.clean import concat_rows, first_per_key
from millrace.operators.histories import CHUNK_ROWS, chunk_entry, collect_entries, place_in_chunks


def _salted(fact: DataFrame, dim: DataFrame, salts: int, salt_by: list[str]) -> tuple[DataFrame, DataFrame]:
    # The salt is a function of named columns, so a recomputed task gives the same one and the scan stays pruned.
    return (fact.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int")),
            dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))


def one_per_key(dim: DataFrame, on: list[str], order_by: list[str] | None = None) -> DataFrame:
    """The first row per key by ``order_by``, or by all other columns: a lookup must not multiply facts."""
    others = [field for field in dim.schema if field.name not in on]
    order = order_by or [f.name for f in others if not isinstance(f.dataType, T.MapType)]
    if not order:
        return dim.distinct()
    first = dim.groupBy(*on).agg(F.min_by(F.struct(*[f.name for f in others]), F.struct(*order)).alias("_first"))
    return first.select(*on, *[F.col("_first").getField(f.name).alias(f.name) for f in others])


def lookup_join(fact: DataFrame, dim: DataFrame, on: list[str], how: str = "left", salts: int = 1,
                salt_by: list[str] | None = None, dim_order: list[str] | None = None) -> DataFrame:
    """Attach the columns of a dimension: of several rows of a key the first by ``dim_order``, so facts keep their number.

    ``salts`` copies the dimension and is only for a shuffle join without adaptive execution, so that is what it gets;
    ``salt_by`` names the fact columns that tell the rows of a hot key apart.
    """
    dim = one_per_key(dim, on, dim_order)
    if salts <= 1:
        return fact.join(dim, on, how)
    if not salt_by:
        raise ValueError("salts need salt_by, columns that differ between the rows of a key")
    fact, dim = _salted(fact, dim, salts, salt_by)
    # Size estimates leave out the copies, so a salted dimension would be broadcast at many times the threshold.
    return fact.join(dim.hint("merge"), [*on, "_salt"], how).drop("_salt")


def lookup_struct(fact: DataFrame, dim: DataFrame, on: str, into: str, default: dict,
                  how: str = "left", salts: int = 1, salt_by: list[str] | None = None) -> DataFrame:
    """Nest the matching dimension row (less its key) under ``into``.

    A fact without a match gets ``default``; the fields it does not name are NULL,
    and so are left out of JSON output.
    """
    fields = [name for name in dim.columns if name != on]
    nested = one_per_key(dim, [on]).select(on, F.struct(*fields).alias(into))
    missing = F.struct(*[
        F.lit(default.get(name)).cast(dim.schema[name].dataType).alias(name) for name in fields])
    joined = lookup_join(fact, nested, [on], how, salts, salt_by)
    return joined.withColumn(into, F.coalesce(into, missing))


def join_first_left(left: DataFrame, right: DataFrame, on: list[str], left_order: list[Column]) -> DataFrame:
    """Inner join of the first left row per key with all the right rows."""
    return first_per_key(left, on, left_order).join(right, on, "inner")


def expand_keys(facts: DataFrame, dim: DataFrame, keys: list[str], on: list[str]) -> DataFrame:
    """Distinct fact keys joined to the dimension on a part of the key."""
    return facts.select(*keys).distinct().join(dim, on, "inner")


def co_group(sides: dict[str, DataFrame], keys: list[str], order_by: dict[str, list], chunk_rows: int = CHUNK_ROWS,
             items: dict[str, list[str]] | None = None, merged: bool = False) -> DataFrame:
    """All sides grouped by key, each as a sorted list of its rows: a full outer join.

    ``items`` names the columns a list entry holds, by default the whole row. The rows of a key form one sequence, side
    after side, or by their order alone if ``merged``, which needs orders of the same types. It is cut every
    ``chunk_rows`` rows: a ``chunk`` row has the rows of all sides in one stretch of it, an empty list where a side has
    none there, and nothing is dropped. The sides meet in a union, not in a chain of joins.
    """
    parts = []
    for number, (name, side) in enumerate(sides.items()):
        entry = chunk_entry(order_by[name], (items or {}).get(name, side.columns))
        parts.append(side.select(*keys, F.lit(number).alias("_side"), entry.alias(name)))
    rows = concat_rows(*parts)
    if merged:
        order = [F.coalesce(*[F.col(name).getField("at") for name in sides]), F.col("_side")]
    else:
        order = [F.col("_side"), *[F.col(name).getField("at") for name in sides]]
    named = rows.select("*", *[column.alias(f"_o{k}") for k, column in enumerate(order)])
    placed = place_in_chunks(named, keys, [f"_o{k}" for k in range(len(order))], chunk_rows)
    return collect_entries(placed.select(*keys, "chunk", *sides), keys, list(sides))
