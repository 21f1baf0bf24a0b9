"""Models as views or tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """A catalog table, replaced as a whole; at ``path`` when one is given."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def dependency_order(needs: Mapping[str, Iterable[str]]) -> list[str]:
    """The names so that each comes after those it needs; needs that are no names here are taken as given.

    Names that wait for nothing keep their order. A cycle is an error that names its members.
    """
    sorter = TopologicalSorter({name: [x for x in wanted if x in needs] for name, wanted in needs.items()})
    try:
        return list(sorter.static_order())
    except CycleError as error:
        raise ValueError(f"these need each other: {' -> '.join(error.args[1])}") from error


def build_models(spark: SparkSession, models: dict[str, tuple], table_root: str | None = None) -> None:
    """Register models, each after those it reads, so that it finds them by name.

    A model is ``(kind, function)`` or ``(kind, function, names it reads)``, with kind ``view`` or ``table`` and a function
    of the session. Models without names to read keep the given order.
    """
    for name in dependency_order({name: model[2] if len(model) > 2 else () for name, model in models.items()}):
        kind, model = models[name][:2]
        if kind == "view":
            as_view(model(spark), name)
        elif kind == "table":
            as_table(model(spark), name, f"{table_root}/{name}" if table_root else None)
        else:
            raise ValueError(f"unknown materialisation: {kind}")
