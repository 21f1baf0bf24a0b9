"""Running values per key that do not need a whole key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import stored


def running_totals(df: DataFrame, keys: list[str], order_by: list, count: str | None = "running_count",
                   sums: dict[str, str] | None = None) -> DataFrame:
    """Running row count and running sums per key, in ``order_by`` order; NULL is a key like any other.

    Rows are range partitioned by key and order, so a key with a third of all rows is spread over a third of the
    partitions, whatever its values. That table is written, because the sums depend on where it was cut. Totals per key
    and partition, of which a key has few, give every partition the value it starts from. The input is read twice, once
    for the ranges. Sum decimals or integers, not floats, to be independent of the row order; ``order_by`` should be
    total.
    """
    sums = sums or {}
    rows = stored(df.repartitionByRange(*keys, *order_by).withColumn("_part", F.spark_partition_id()), "ranges")
    rows = rows.withColumn("_cell", F.struct(*keys, "_part"))
    totals = rows.groupBy("_cell").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(source).alias(f"_t_{out}") for out, source in sums.items()])
    earlier = (Window.partitionBy(*[F.col(f"_cell.{key}") for key in keys])
               .orderBy("_cell._part").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select(
        "_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        *[F.sum(f"_t_{out}").over(earlier).alias(f"_s_{out}") for out in sums])
    inside = Window.partitionBy("_cell").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def running(out: str, source: str) -> Column:
        # NULL until the first value of the key, as in a plain window
        here, before = F.sum(source).over(inside), F.col(f"_s_{out}")
        return F.coalesce(before + here, before, here).alias(out)

    counted = [(F.col("_n0") + F.count(F.lit(1)).over(inside)).alias(count)] if count else []
    return rows.join(starts, "_cell").select(*df.columns, *counted, *[running(out, source) for out, source in sums.items()])
