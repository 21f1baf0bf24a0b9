"""Cleaning, de-duplication and fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F


def keep_present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where every named column has a value."""
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
    return df


def first_per_key(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """One row per key: the first in ``order_by``, which should be a total order.

    The rank filter is pushed below the shuffle (a partial window group limit), so
    every map task sends at most one row per key and a hot key costs no more than
    any other.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def top_per_key(df: DataFrame, keys: list[str], order_by: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows per key with their rank; pushed below the shuffle as well."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def clean_people(df: DataFrame) -> DataFrame:
    """Named people only, unknown age as 0, lower-case names, one row per id."""
    tidy = (keep_present(df, "name")
            .fillna({"age": 0})
            .withColumn("name", F.lower("name")))
    return first_per_key(tidy, ["id"], [F.col("name"), F.col("age")])


def fan_out(df: DataFrame, branches: dict[str, Column], branch: str = "branch") -> DataFrame:
    """Every row once per branch it belongs to, tagged with the branch name.

    One pass over the input feeds all branches: write the result with
    ``partitionBy(branch)`` instead of keeping the input in memory for one write
    per branch.
    """
    hits = F.array(*[F.when(rule, F.lit(name)) for name, rule in branches.items()])
    return df.withColumn(branch, F.explode(hits)).filter(F.col(branch).isNotNull())


def concat_rows(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column a frame lacks is NULL there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def split_valid(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass and rows that do not (an unknown verdict counts as a failure)."""
    verdict = F.coalesce(rule, F.lit(False))
    return df.filter(verdict), df.filter(~verdict)


def keep_counting(df: DataFrame, rule: Column, name: str = "rejects") -> tuple[DataFrame, Observation]:
    """The rows that pass, and a count of the others taken while they are read.

    ``observation.get["rejected"]`` has the number once an action has run; the
    input is not scanned a second time for it.
    """
    verdict = F.coalesce(rule, F.lit(False))
    seen = Observation(name)
    return df.observe(seen, F.count_if(~verdict).alias("rejected")).filter(verdict), seen
