"""Combiners, table functions, staged jobs, model order, log levels, the staged relational writer, repeated teams."""

import functools
import os
import sqlite3
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from millrace.operators.combiners import Combiner, Mean, Moments, combine_per_key
from millrace.operators.table_functions import Lines, RowMaker, Sessions, table_function
from millrace.plans import race_stream
from millrace.plans.race_history import race_histories
from millrace.plans.stages import Source, Stage, run_stages
from millrace.schemas import RACE_EVENT, TELEMETRY_V2
from millrace.sinks import keyed_log, tables
from millrace.sinks.manifests import SharedFiles, add_version, newest
from millrace.sinks.relational import Database
from millrace.sinks.staged_writer import StagedWriter, Target, write_staged
from millrace.streaming.runs import wait_all
from tests.test_streams import race_records


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# combiners

class Longest(Combiner):
    """The two longest texts, as an example with a nested state."""

    state = T.StructType().add("texts", T.ArrayType(T.StringType()))
    result = T.ArrayType(T.StringType())

    def create(self):
        return ([],)

    def _best(self, texts):
        return (sorted(set(texts), key=lambda x: (-len(x), x))[:2],)

    def add(self, accumulator, values):
        return self._best(accumulator[0] + values.drop_null().to_pylist())

    def merge(self, one, other):
        return self._best(one[0] + other[0])

    def extract(self, accumulator):
        return accumulator[0]


@pytest.mark.parametrize("fan, most_keys", [(64, 100_000), (2, 3), (1, 1)])
def test_combiner_equals_plain(spark, fan, most_keys):
    dice = np.random.default_rng(6)
    keys = np.where(np.arange(4000) % 3 == 0, "hot", np.char.add("k", (np.arange(4000) % 97).astype(str)))
    values = dice.normal(1e6, 1, 4000)
    data = [(str(k), None if i % 50 == 0 else float(v), i % 2) for i, (k, v) in enumerate(zip(keys, values))] + [(None, 5.0, 1), ("empty", None, 0)]
    df = spark.createDataFrame(data, "key string, v double, part int").repartition(13)
    got = {(r["key"], r["part"]): r["m"] for r in combine_per_key(df, ["key", "part"], F.col("v"), Moments(), "m", fan, most_keys).collect()}
    groups = {}
    for key, v, part in data:
        groups.setdefault((key, part), []).append(v)
    assert set(got) == set(groups)
    for key, all_values in groups.items():
        known = [v for v in all_values if v is not None]
        assert got[key]["n"] == len(known)
        if known:
            assert abs(got[key]["mean"] - np.mean(known)) < 1e-6 and abs(got[key]["variance"] - np.var(known)) < 1e-6
        else:
            assert got[key]["mean"] is None
    means = {r["key"]: r["combined"] for r in combine_per_key(df, ["key"], F.col("v"), Mean(), fan=fan, most_keys=most_keys).collect()}
    assert means["empty"] is None and means[None] == 5.0 and abs(means["hot"] - 1e6) < 1


def test_combiner_with_nested_state_and_no_rows(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "xyz"), ("a", "xy"), ("a", None), ("b", None)], "key string, combined string")
    assert rows(combine_per_key(df, ["key"], F.col("combined"), Longest())) == [("a", ["xyz", "xy"]), ("b", [])]
    assert combine_per_key(df.limit(0), ["key"], F.col("combined"), Longest()).count() == 0
    with pytest.raises(ValueError, match="needs a key"):
        combine_per_key(df, [], F.col("combined"), Longest())


def test_raw_rows_are_not_shuffled_by_the_combiner(spark):
    df = spark.range(100_000).select(F.lit("hot").alias("key"), F.col("id").cast("double").alias("v"))
    plan = combine_per_key(df, ["key"], F.col("v"), Mean())._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange"):]
    assert "MapInArrow" in below   # what is below the first shuffle has been combined already


# table functions

def test_lines_and_sessions(spark):
    texts = spark.createDataFrame([(1, "a b\n\n  c\n "), (2, None), (3, "")], "id int, text string")
    assert rows(texts.transform(table_function(lambda: Lines("text"), Lines.made, ["id"]))) == [(1, 1, 2, 3), (1, 3, 1, 3)]
    visits = spark.createDataFrame([("u", m) for m in (0, 5, 100, 104, 300)] + [("v", 7), ("w", None)], "user string, m int").withColumn(
        "at", F.timestamp_seconds(F.col("m") * 60).cast("timestamp_ntz")).repartition(3)
    sessions = visits.transform(table_function(lambda: Sessions("at", 1800), Sessions.made, ["user"], ["user"], ["at"]))
    assert rows(sessions.select("user", F.minute("first") + 60 * F.hour("first"), F.minute("last") + 60 * F.hour("last"), "n")) == [
        ("u", 0, 5, 2), ("u", 100, 104, 2), ("u", 300, 300, 1), ("v", 7, 7, 1)]


def test_a_table_function_takes_any_schema(spark):
    class Twice(RowMaker):
        made = T.StructType().add("k", "integer")

        def process(self, row):
            return [(k,) for k in range(row["odd name"] or 0)]

    df = spark.createDataFrame([(2, [1.5], None), (0, None, "x"), (None, None, "y")], "`odd name` int, v array<double>, s string")
    step = table_function(Twice, Twice.made, ["v", "odd name"])
    assert step(df).columns == ["v", "odd name", "k"] and rows(step(df)) == [([1.5], 2, 0), ([1.5], 2, 1)]
    grouped = table_function(Twice, Twice.made, ["s"], ["odd name"], ["s"])
    assert rows(grouped(df)) == [(None, 0), (None, 1)]


def test_grouped_rows_reach_python_in_batches_and_keys_may_span_them(spark):
    visits = spark.createDataFrame([("u", m) for m in range(0, 500, 50)] + [("v", 1), (None, 2), (None, 300)], "user string, m int").withColumn(
        "at", F.timestamp_seconds(F.col("m") * 60).cast("timestamp_ntz"))
    step = table_function(lambda: Sessions("at", 3600), Sessions.made, ["user"], ["user"], ["at"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert rows(step(visits).select("user", "n")) == rows(spark.createDataFrame([("u", 10), ("v", 1), (None, 1), (None, 1)], "user string, n int"))
        plan = step(visits)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "MapInArrow" in plan and "UDTF" not in plan   # one call per row and key took 300 microseconds a row


# staged jobs and model order

def test_a_rerun_starts_at_the_first_stale_stage(spark, folder):
    spark.range(5).write.parquet(f"{folder}/in")
    calls = []

    def stage(name, more=0):
        def run(*frames, add=0):
            calls.append(name)
            return frames[0].select((F.col("id") + add + more).alias("id"))
        return run

    def job(add=1, version=1):
        source = Source("numbers", f"{folder}/in", lambda s, path: s.read.parquet(path))
        return run_stages(spark, f"{folder}/work", [source], [
            Stage("c", stage("c"), ("b",)), Stage("a", stage("a"), ("numbers",)), Stage("b", stage("b"), ("a",), {"add": add}, version),
            Stage("other", stage("other"), ("numbers",))])

    first = job()
    assert set(first.executed) == {"a", "b", "c", "other"} and calls.index("a") < calls.index("b") < calls.index("c")
    assert rows(spark.read.parquet(first.paths["c"])) == [(k,) for k in range(1, 6)]
    assert job().executed == [] and len(calls) == 4
    assert job(add=2).executed == ["b", "c"]
    assert job(add=2, version=2).executed == ["b", "c"]
    spark.range(5, 7).write.mode("append").parquet(f"{folder}/in")
    assert set(job(add=2, version=2).executed) == {"a", "b", "c", "other"}
    with pytest.raises(ValueError, match="no source or stage is named nowhere"):
        run_stages(spark, folder, [], [Stage("a", stage("a"), ("nowhere",))])


def test_a_killed_stage_is_run_again(spark, folder):
    spark.range(3).write.parquet(f"{folder}/in")
    fail = [True]

    def broken(df):
        if fail[0]:
            raise RuntimeError("lost")
        return df

    def job():
        source = Source("numbers", f"{folder}/in", lambda s, path: s.read.parquet(path))
        return run_stages(spark, f"{folder}/work", [source], [Stage("a", lambda df: df, ("numbers",)), Stage("b", broken, ("a",))])

    with pytest.raises(RuntimeError):
        job()
    fail[0] = False
    assert job().executed == ["b"]


def test_models_in_the_order_of_their_references(spark):
    tables.build_models(spark, {
        "m_top": ("view", lambda s: s.table("m_mid").selectExpr("id + 1 AS id"), ("m_mid",)),
        "m_mid": ("view", lambda s: s.table("m_low").selectExpr("id * 10 AS id"), ("m_low", "seed_elsewhere")),
        "m_low": ("view", lambda s: s.range(2))})
    assert rows(spark.table("m_top")) == [(1,), (11,)]
    with pytest.raises(ValueError, match="need each other: .*a.*b"):
        tables.dependency_order({"a": ["b"], "b": ["a"], "c": []})
    assert tables.dependency_order({"z": [], "y": [], "x": ["z"]}) == ["z", "y", "x"]


# the keyed log

def log_of(spark, folder, batches):
    log = f"{folder}/log"
    for batch_id, pairs in enumerate(batches):
        keyed_log.upsert_batch(spark.createDataFrame(pairs, "id string, n int"), log, batch_id)
    return log


def test_log_levels(spark, folder):
    batches = [[(f"k{k}", 100 * b + k) for k in range(b % 3, 9, 2)] for b in range(11)]
    log = log_of(spark, folder, batches)
    whole = rows(keyed_log.read_current(spark, log, ["id"]))
    earlier = keyed_log.read_current(spark, log, ["id"])       # made before the merges
    assert keyed_log.merge_levels(spark, log, ["id"], fan=3) == 4    # 10 batches: three merges, then one of those three
    manifest = newest(SharedFiles(spark), f"{log}/_versions")[1]
    assert [x["level"] for x in manifest["levels"]] == [2] and manifest["through"] == 8
    assert rows(keyed_log.read_current(spark, log, ["id"])) == whole == rows(earlier)
    keyed_log.upsert_batch(spark.createDataFrame([("k1", -1)], "id string, n int"), log, 10)   # the held batch, written again
    assert ("k1", -1) in rows(keyed_log.read_current(spark, log, ["id"]))
    assert keyed_log.remove_merged(spark, log, after_seconds=3600) == 0
    assert keyed_log.remove_merged(spark, log, after_seconds=0) == 12
    assert sorted(x for x in os.listdir(log) if x.startswith("batch_id=")) == ["batch_id=10", "batch_id=9"]
    assert len(rows(keyed_log.read_current(spark, log, ["id"]))) == len(whole)
    keyed_log.compact(spark, log, f"{folder}/copy", ["id"])
    assert rows(keyed_log.read_current(spark, f"{folder}/copy", ["id"])) == rows(keyed_log.read_current(spark, log, ["id"]))


def test_log_merge_killed_between_its_steps(spark, folder, monkeypatch):
    log = log_of(spark, folder, [[("a", b), (f"k{b}", b)] for b in range(5)])
    whole = rows(keyed_log.read_current(spark, log, ["id"]))

    def killed(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(keyed_log, "add_version", killed)
        with pytest.raises(RuntimeError):
            keyed_log.merge_levels(spark, log, ["id"], fan=2)
    assert rows(keyed_log.read_current(spark, log, ["id"])) == whole      # the unused folder is not read
    assert keyed_log.merge_levels(spark, log, ["id"], fan=2) > 0
    assert rows(keyed_log.read_current(spark, log, ["id"])) == whole
    keyed_log.merge_levels(spark, log, ["id"], fan=2)
    with monkeypatch.context() as patch:
        patch.setattr(keyed_log, "add_version", killed)
        with pytest.raises(RuntimeError):
            keyed_log.remove_merged(spark, log, after_seconds=0)
    assert rows(keyed_log.read_current(spark, log, ["id"])) == whole


def test_a_version_is_added_once(spark, folder):
    files = SharedFiles(spark)
    assert add_version(files, f"{folder}/v", 0, {"a": 1}) and not add_version(files, f"{folder}/v", 0, {"a": 2})
    assert newest(files, f"{folder}/v") == (0, {"a": 1}) and newest(files, f"{folder}/none") is None
    assert add_version(files, f"{folder}/v", 10, {"a": 3}) and newest(files, f"{folder}/v", 10) == (0, {"a": 1})
    assert [name for name in sorted(os.listdir(f"{folder}/v")) if name.endswith(".json") and name[0] != "."] == ["000000000000.json", "000000000010.json"]


# the staged relational writer

def open_file(path):
    return sqlite3.connect(path, timeout=60)


def target_of(folder, batch_size=2):
    database = Database(functools.partial(open_file, f"{folder}/t.db"), "laps", 3, batch_size)
    return Target(database, {"id": "VARCHAR(255)", "n": "INTEGER"}, "id", "?")


def table_rows(folder, name="laps"):
    connection = open_file(f"{folder}/t.db")
    try:
        return sorted(connection.execute(f"SELECT id, n FROM {name}").fetchall())
    finally:
        connection.close()


def test_staged_upserts(spark, folder):
    target = target_of(folder)
    write_staged(spark.createDataFrame([(f"k{k}", k, "x") for k in range(20)] + [("k1", 99, "again")], "id string, n int, more string"), target)
    assert table_rows(folder) == sorted((f"k{k}", k) for k in range(20))      # of two rows of k1 the lesser
    write_staged(spark.createDataFrame([(-1, "k3"), (None, "new")], "n int, id string"), target)
    write_staged(spark.createDataFrame([], "id string, n int"), target)
    got = dict(table_rows(folder))
    assert got["k3"] == -1 and got["new"] is None and len(got) == 21 and table_rows(folder, "laps_staging") == []


def test_a_failing_task_leaves_nothing(spark, folder):
    target = target_of(folder)
    write_staged(spark.createDataFrame([("a", 1)], "id string, n int"), target)
    bad = spark.range(50).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") == 41, F.raise_error(F.lit("broken"))).cast("int").alias("n"))
    with pytest.raises(Exception):
        write_staged(bad, target)
    assert table_rows(folder) == [("a", 1)] and table_rows(folder, "laps_staging") == []


def test_only_attempts_that_the_driver_knows_are_moved(folder):
    target = target_of(folder)
    target.work(lambda cursor: [cursor.execute(s) for s in target.statements()])
    writer = StagedWriter(target, ["n", "id"])
    kept = writer.write(iter([(1, "a"), (2, "b"), (3, "c")]))
    writer.write(iter([(7, "a"), (8, "d")]))        # an attempt that was given up
    writer.commit([kept, None])
    assert kept.rows == 3 and table_rows(folder) == [("a", 1), ("b", 2), ("c", 3)] and table_rows(folder, "laps_staging") == []
    again = StagedWriter(target, ["id", "n"])
    again.write(iter([("z", 1)]))
    again.abort([])
    assert table_rows(folder) == [("a", 1), ("b", 2), ("c", 3)] and table_rows(folder, "laps_staging") == []


def open_with_decimals(path):
    sqlite3.register_adapter(Decimal, float)
    return open_file(path)


def test_race_telemetry_through_staging(spark, folder):
    record = {"HelicopterID": "HEL001", "RaceID": "r", "LapNumber": 1, "Time_s": 9.3, "Speed_km_h": 253.1}
    records = race_records(spark, folder, "telemetry_in", [record, record, dict(record, Time_s=10.0, Speed_km_h=9.5), dict(record, HelicopterID=None)])
    database = Database(functools.partial(open_with_decimals, f"{folder}/t.db"), "telemetry", 2)
    wait_all(*race_stream.start(race_records(spark, folder, "events_in", []), records, f"{folder}/out", f"{folder}/state", once=True,
                                database=database, staged_with="?"))
    connection = open_file(f"{folder}/t.db")
    try:
        assert connection.execute("SELECT HelicopterID, Speed_km_h FROM telemetry ORDER BY Speed_km_h").fetchall() == [("HEL001", 9.5), ("HEL001", 253.1)]
        assert connection.execute("SELECT count(*) FROM telemetry_staging").fetchone() == (0,)
    finally:
        connection.close()


# repeated teams

@pytest.mark.parametrize("scope", ["all", "telemetry"])
def test_a_repeated_team_does_not_multiply_histories(spark, scope):
    telemetry = spark.createDataFrame([{"RaceID": "r", "HelicopterID": "h", "Time_s": 1.0}], TELEMETRY_V2)
    events = spark.createDataFrame([], RACE_EVENT)
    teams = spark.createDataFrame([("h", "Reds"), ("h", "Blues"), ("h", "Blues")], "HelicopterID string, TeamName string")
    got = race_histories(telemetry, events, teams, scope).collect()
    assert [(r["HelicopterID"], r["TeamInfo"]["TeamName"]) for r in got] == [("h", "Blues")]
