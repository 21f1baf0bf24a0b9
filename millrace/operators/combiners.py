"""Aggregates of one's own: accumulators that are made per task, merged over a shuffle, and read out once per key.

What is shuffled are accumulators. A key that holds a third of all rows sends one per task (more only where a task meets
very many keys), these are merged in ``fan`` slots first and then once more, so no task ever sees all rows of a key.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema


class Combiner(ABC):
    """An accumulator is a tuple of the fields in ``state``. ``merge`` must not depend on order beyond rounding."""

    state: T.StructType
    result: T.DataType

    @abstractmethod
    def create(self) -> tuple: ...

    @abstractmethod
    def add(self, accumulator: tuple, values: pa.Array) -> tuple:
        """Take in some of a key's values, NULL among them."""

    @abstractmethod
    def merge(self, one: tuple, other: tuple) -> tuple: ...

    @abstractmethod
    def extract(self, accumulator: tuple) -> Any: ...


class Mean(Combiner):
    """The mean of the values that are not NULL; NULL without any."""

    state = T.StructType().add("total", "double").add("n", "long")
    result = T.DoubleType()

    def create(self):
        return 0.0, 0

    def add(self, accumulator, values):
        known = values.drop_null().to_numpy(zero_copy_only=False)
        return accumulator[0] + float(known.sum()), accumulator[1] + len(known)

    def merge(self, one, other):
        return one[0] + other[0], one[1] + other[1]

    def extract(self, accumulator):
        return accumulator[0] / accumulator[1] if accumulator[1] else None


class Moments(Combiner):
    """Count, mean and variance, from sums of squared gaps, so that large values with small spread keep their digits."""

    state = T.StructType().add("n", "long").add("mean", "double").add("gaps", "double")
    result = T.StructType().add("n", "long").add("mean", "double").add("variance", "double")

    def create(self):
        return 0, 0.0, 0.0

    def add(self, accumulator, values):
        known = values.drop_null().to_numpy(zero_copy_only=False)
        if not len(known):
            return accumulator
        mean = float(known.mean())
        return self.merge(accumulator, (len(known), mean, float(np.square(known - mean).sum())))

    def merge(self, one, other):
        n = one[0] + other[0]
        if not n:
            return self.create()
        gap = other[1] - one[1]
        return n, one[1] + gap * other[0] / n, one[2] + other[2] + gap * gap * one[0] * other[0] / n

    def extract(self, accumulator):
        n, mean, gaps = accumulator
        return (n, mean, gaps / n) if n else (0, None, None)


def combine_per_key(df: DataFrame, keys: list[str], value: Column, combiner: Combiner, into: str = "combined", fan: int = 64,
                    most_keys: int = 100_000) -> DataFrame:
    """``keys`` and the combined value of each: what ``groupBy(keys).agg`` is for the built-in aggregates.

    NULL is a key like any other. A task holds at most ``most_keys`` accumulators and hands them on when there are more.
    """
    if not keys:
        raise ValueError("combine_per_key needs a key; give a constant one for a single value")
    key_fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    partial = T.StructType([*key_fields, T.StructField("_slot", T.IntegerType()), T.StructField("_state", combiner.state)])
    final = T.StructType([*key_fields, T.StructField(into, combiner.result)])
    partial_arrow, final_arrow = to_arrow_schema(partial), to_arrow_schema(final)
    fields = combiner.state.names

    def as_record(names: list[str], values: Any) -> Any:
        return dict(zip(names, values)) if isinstance(values, tuple) else values

    def states(rows: list[tuple], slots: list[int]) -> pa.RecordBatch:
        made = [{**dict(zip(keys, key)), "_slot": slot, "_state": as_record(fields, state)} for (key, state), slot in zip(rows, slots)]
        return pa.RecordBatch.from_pylist(made, schema=partial_arrow)

    def flushed(held: dict, slot: int) -> pa.RecordBatch:
        batch = states(list(held.items()), [slot] * len(held))
        held.clear()
        return batch

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, slot = {}, TaskContext.get().partitionId() % fan
        for batch in batches:
            if not len(batch):
                continue
            groups = pa.Table.from_batches([batch]).group_by(keys, use_threads=False).aggregate([("_value", "list")])
            values = groups.column("_value_list").combine_chunks()
            for k, key in enumerate(zip(*[groups.column(name).to_pylist() for name in keys])):
                held[key] = combiner.add(held.get(key) or combiner.create(), values[k].values)
            if len(held) > most_keys:
                yield flushed(held, slot)
        if held:
            yield flushed(held, slot)

    def rows_of(batch: pa.RecordBatch) -> Iterator[tuple[tuple, tuple]]:
        found = zip(*[batch.column(name).to_pylist() for name in keys])
        return zip(found, (tuple(s[f] for f in fields) for s in batch.column("_state").to_pylist()))

    def per_slot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for key, state in rows_of(batch):
                held[key] = combiner.merge(held[key], state) if key in held else state
            if len(held) > most_keys:
                yield flushed(held, 0)
        if held:
            yield flushed(held, 0)

    def per_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows come in order of their keys, so one accumulator is held."""
        last, state = None, None

        def told(rows: list[tuple]) -> pa.RecordBatch:
            names = getattr(combiner.result, "names", [])
            return pa.RecordBatch.from_pylist(
                [{**dict(zip(keys, key)), into: as_record(names, combiner.extract(s))} for key, s in rows], schema=final_arrow)

        for batch in batches:
            done = []
            for key, found in rows_of(batch):
                if state is not None and key == last:
                    state = combiner.merge(state, found)
                else:
                    if state is not None:
                        done.append((last, state))
                    last, state = key, found
            yield told(done)
        if state is not None:
            yield told([(last, state)])

    partials = df.select(*keys, value.alias("_value")).mapInArrow(per_task, partial)
    merged = partials.repartition(*keys, "_slot").mapInArrow(per_slot, partial)
    return merged.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(per_key, final)
