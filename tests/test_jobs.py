"""The jobs, end to end on small files with results worked out by hand."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import quality
from millrace.plans import (
    convert, customer_etl, daily_mart, meter_readings, race_history, voltage_windows, weather_forecast, word_count)
from millrace.sources.meter_csv import parse_readings
from millrace.streaming.windows import window_means, with_event_time
from millrace.functions.times import parse_iso


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
    return path


def lines_of(spark, path):
    return sorted(r[0] for r in spark.read.text(path).collect())


METER_LINES = """id_meter,timestamp,consumption_kwh,voltage,status
 KX-7,2025-11-08T04:00:00Z,3.75,231,OK
KX-9,2025-11-08T04:00:30Z,41.5,229,OK
KX-7,2025-11-08T05:10:00Z, 6.2 ,233,OK
KX-4,2025-11-08T05:12:00Z,0.0,228,CHECK
KX-5,,1.5,230,OK
KX-6,2025-11-08T05:20:00Z,NULL,227,OK
only,two
"""


def test_meter_readings(spark, folder):
    source = put(folder, "in/readings.csv", METER_LINES)
    meter_readings.main(["--input", source, "--output", f"{folder}/out"])
    assert lines_of(spark, f"{folder}/out/branch=alerts") == [
        "DANGER: Meter kx-9 with 41.5kWh exceeded the limit of 10.0kWh"]
    assert [json.loads(line) for line in lines_of(spark, f"{folder}/out/branch=anomalies")] == [
        {"id": "kx-4", "ts": "2025-11-08T05:12:00Z", "kwh": 0.0, "v": 228, "status": "CHECK"}]
    assert lines_of(spark, f"{folder}/out/branch=history") == [
        "kx-4,2025-11-08T05:12:00Z,0.0,228,CHECK,SmartGrid-V1,My-Company",
        "kx-7,2025-11-08T04:00:00Z,3.75,231,OK,SmartGrid-V1,My-Company",
        "kx-7,2025-11-08T05:10:00Z,6.2,233,OK,SmartGrid-V1,My-Company",
        "kx-9,2025-11-08T04:00:30Z,41.5,229,OK,SmartGrid-V1,My-Company"]
    assert len(lines_of(spark, f"{folder}/out/branch=rejects")) == 3


def test_rejected_readings(spark):
    bad = ["a,2026,x,220,OK", "a,2026,1.0,220.5,OK", "a,2026,1.0,220", "a,2026,,220,OK", ""]
    valid, rejected = parse_readings(spark.createDataFrame([(line,) for line in bad], "value string"))
    assert valid.count() == 0 and rejected.count() == len(bad)


VOLTAGES = [("N-3", 240, "06:30:04"), ("N-3", 196, "06:30:41"), ("N-3", 176, "06:31:12"), ("N-8", 233, "06:30:09"),
            ("N-8", 235, "06:30:52"), ("N-8", 231, "06:31:33")]


def voltage_rows(spark):
    return spark.createDataFrame([(i, v, f"2025-11-09T{t}Z") for i, v, t in VOLTAGES], schemas.MONITORING)


def test_sliding_means(spark):
    timed = with_event_time(voltage_rows(spark), parse_iso(F.col("ts")))
    means = window_means(timed, ["id"], F.col("v"), "60 seconds", "30 seconds")
    got = {(r["id"], r["window_start"].strftime("%H:%M:%S")): r["mean"] for r in means.collect()}
    assert got == {
        ("N-3", "06:29:30"): 240.0, ("N-3", "06:30:00"): 218.0, ("N-3", "06:30:30"): 186.0, ("N-3", "06:31:00"): 176.0,
        ("N-8", "06:29:30"): 233.0, ("N-8", "06:30:00"): 234.0, ("N-8", "06:30:30"): 235.0, ("N-8", "06:31:00"): 231.0,
        ("N-8", "06:31:30"): 231.0}


def test_means_keep_small_values(spark):
    timed = with_event_time(spark.createDataFrame([("a", 0.004, "2025-11-09T06:30:04Z")] * 3, "id string, v double, ts string"), parse_iso(F.col("ts")))
    assert [r["mean"] for r in window_means(timed, ["id"], F.col("v"), "60 seconds").collect()] == [pytest.approx(0.004)]


def test_voltage_alerts_batch_and_stream(spark, folder):
    rows = [json.dumps({"id": i, "v": v, "ts": f"2025-11-09T{t}Z"}) for i, v, t in VOLTAGES]
    late = json.dumps({"id": "N-0", "v": 230, "ts": "2025-11-09T09:00:00Z"})  # moves the watermark on
    put(folder, "in/readings.json", "\n".join([*rows, late]) + "\n")
    expected = ["\U0001f6a8 [TECHNICAL ALERT] | Window: 06:30:30 - 06:31:30 | Transformer: N-3 | Average Voltage: 186.0V"
                " | ACTION: Dispatch crew immediately.",
                "\U0001f6a8 [TECHNICAL ALERT] | Window: 06:31:00 - 06:32:00 | Transformer: N-3 | Average Voltage: 176.0V"
                " | ACTION: Dispatch crew immediately."]
    voltage_windows.main(["--input", f"{folder}/in", "--output", f"{folder}/batch"])
    assert lines_of(spark, f"{folder}/batch") == expected

    from millrace.streaming.runs import stream_files, wait_all, write_stream_files
    readings = stream_files(spark, f"{folder}/in", schemas.MONITORING, "json")
    alerts = voltage_windows.voltage_alerts(readings, delay="0 seconds").select(F.col("message").alias("value"))
    wait_all(write_stream_files(alerts, f"{folder}/stream", f"{folder}/state", "text", once=True))
    assert lines_of(spark, f"{folder}/stream") == expected


METERS = """id_meter,location,customer_type,installation_date
 Z-11 ,Øster,Residential,2021-07-30
Z-12,Nordby,industrial,2021-08-02
Z-13,Mölle,RESIDENTIAL,2022-01-19
"""
READINGS = """reading_id,meter_id,voltage,kwh_consumption,recorded_at
Q-1,Z-11,231.25,0.125,2025-11-10 07:00:00
Q-2,Z-12,229.5,3.25,2025-11-10 07:04:00
Q-3,Z-11,189.75,0.5,2025-11-10 08:00:00
Q-4,Z-13,230.5,0.75,2025-11-11 08:30:00
Q-5,Z-12,228.5,2.5,2025-11-10 09:00:00
"""


def test_daily_mart(spark, folder):
    for _ in range(2):  # the second run is a full refresh
        daily_mart.main(["--meters", put(folder, "m.csv", METERS), "--readings", put(folder, "r.csv", READINGS),
                         "--tables", f"{folder}/tables"])
    first, second = datetime.datetime(2025, 11, 10), datetime.datetime(2025, 11, 11)
    assert sorted(tuple(r) for r in spark.table("fct_daily_monitoring").collect()) == [
        ("Mölle", "Z-13", second, 230.5, 0.75, 0), ("Nordby", "Z-12", first, 229.0, 5.75, 0), ("Øster", "Z-11", first, 210.5, 0.625, 1)]


def test_daily_mart_stops_on_bad_readings(spark, folder):
    bad = READINGS + "Q-1,Z-11,0,-1,2025-11-10 11:00:00\n"
    with pytest.raises(SystemExit, match="stg_readings"):
        daily_mart.main(["--meters", put(folder, "m.csv", METERS), "--readings", put(folder, "r.csv", bad),
                         "--tables", f"{folder}/tables"])


def test_every_check_can_fail(spark):
    meters = spark.createDataFrame(
        [("M-1", "x", "RESIDENTIAL"), ("M-1", "y", "OTHER"), (None, "z", "OTHER"), (None, "z", None)],
        "meter_id string, location_name string, customer_category string")
    report = {(r["check"], r["column"]): r["failures"]
              for r in quality.run_checks(meters, daily_mart.meter_checks()).collect()}
    assert report == {("unique", "meter_id"): 1, ("not_null", "meter_id"): 2, ("accepted_values", "customer_category"): 1}
    readings = spark.createDataFrame([("R-1", None, -1.0), ("R-2", 0.0, 1.0), (None, 220.0, None)],
                                     "reading_id string, voltage double, consumption double")
    report = {(r["check"], r["column"]): r["failures"]
              for r in quality.run_checks(readings, daily_mart.reading_checks()).collect()}
    assert report == {("unique", "reading_id"): 0, ("not_null", "reading_id"): 1, ("not_null", "voltage"): 1,
                      ("accepted_range", "consumption"): 1, ("voltage_is_positive", "voltage"): 1}
    assert quality.choose_route(quality.run_checks(readings, daily_mart.reading_checks())) == quality.REPROCESS
    assert quality.choose_route(quality.run_checks(readings, [quality.unique("reading_id")])) == quality.NORMAL_FLOW
    assert quality.offending(readings, daily_mart.reading_checks()[4]).count() == 1


def test_rows_go_where_the_verdict_sends_them(spark, folder):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    report = quality.run_checks(df, [quality.unique("id")])
    assert quality.write_by_route(df, report, f"{folder}/ok", f"{folder}/again") == quality.REPROCESS
    assert quality.write_by_route(df, report, f"{folder}/ok", f"{folder}/no", tolerance=1) == quality.NORMAL_FLOW
    assert sorted(os.listdir(folder)) == ["again", "ok"] and spark.read.parquet(f"{folder}/again").count() == 3


CUSTOMERS = """user_id,name_raw,location_code,order_value,is_active_flag
71,mIRA vOSS,US_NY,260.5,1
72,TOVE lind,GB_LDN,7.25,0
73,Sam O.,US_CA,830.75,1
74,Kai,FR_PAR,64.5,1
75,Uma,QQ,100.99,1
"""


def test_customer_etl(spark, folder):
    customer_etl.main(["--input", put(folder, "c.csv", CUSTOMERS), "--archive", f"{folder}/archive", "--run-id", "r1",
                       "--table", "warehouse_customers", "--table-path", f"{folder}/warehouse"])
    loaded = spark.table("warehouse_customers")
    assert loaded.columns == ["name", "country_city_code", "user_id", "order_value", "is_active_flag", "timezone",
                              "is_high_value"]
    assert sorted(tuple(r) for r in loaded.select("name", "timezone", "is_high_value").collect()) == [
        ("Kai", "Europe/Paris", False), ("Mira Voss", "America/New York", True), ("Sam O.", "America/Los Angeles", True),
        ("Tove Lind", "Europe/London", False), ("Uma", "Unknown", False)]
    assert spark.read.parquet(f"{folder}/archive/run_id=r1").count() == 5


def race_frames(spark):
    telemetry = spark.createDataFrame(
        [("HEL001", "r1", 20.0), ("HEL001", "r1", 10.0), ("HEL003", "r1", 5.0), ("HEL002", None, None)],
        "HelicopterID string, RaceID string, Time_s float")
    events = spark.createDataFrame([("e1", "r1", 30, "HEL001"), ("e2", "r2", 7, "HEL002")],
                                   "EventID string, RaceID string, Timestamp_s bigint, HelicopterID string")
    teams = spark.createDataFrame([("HEL001", "A", "CL"), ("HEL002", "B", "PE")],
                                  "HelicopterID string, TeamName string, Country string")
    return telemetry, events, teams


@pytest.mark.parametrize("scope, second_team", [("all", "B"), ("telemetry", "UNKNOWN")])
def test_race_histories(spark, scope, second_team):
    nested = race_history.race_histories(*race_frames(spark), team_scope=scope)
    got = {(r["RaceID"], r["HelicopterID"]): (
        r["TeamInfo"]["TeamName"], [x["Time_s"] for x in r["TelemetryHistory"]],
        [x["Timestamp_s"] for x in r["RaceEvents"]]) for r in nested.collect()}
    assert got == {
        ("r1", "HEL001"): ("A", [10.0, 20.0], [30]), ("r1", "HEL003"): ("UNKNOWN", [5.0], []),
        ("r2", "HEL002"): (second_team, [], [7]), ("unknown_race", "HEL002"): ("B", [None], [])}


def test_race_history_needs_a_helicopter(spark):
    telemetry, events, teams = race_frames(spark)
    broken = events.union(spark.createDataFrame([("e3", "r1", 1, None)], events.schema))
    with pytest.raises(Exception, match="record without HelicopterID"):
        race_history.race_histories(telemetry, broken, teams).collect()


def test_race_job_writes_json(spark, folder):
    put(folder, "events/race_01.json", '{"EventID":"e1","RaceID":"r1","Timestamp_s":3,"HelicopterID":"HEL001"}\n')
    put(folder, "events/race_02.json", '{"EventID":"e2","RaceID":"r2","Timestamp_s":4,"HelicopterID":"HEL009"}\n'
                                       '{"EventID":"e3","RaceID":"r2","Timestamp_s":4}\n')
    teams = put(folder, "teams.json", '{"HelicopterID":"HEL001","TeamName":"Ñandú","MaxSpeed_km_h":280}\n')
    race_history.main(["--events", f"{folder}/events/race_*.json", "--teams", teams, "--output", f"{folder}/out"])
    assert lines_of(spark, f"{folder}/out") == [
        '{"HelicopterID":"HEL001","EventID":"e1","RaceID":"r1","Timestamp_s":3,'
        '"TeamInfo":{"TeamName":"Ñandú","MaxSpeed_km_h":280}}',
        '{"HelicopterID":"HEL009","EventID":"e2","RaceID":"r2","Timestamp_s":4,"TeamInfo":{"TeamName":"UNKNOWN"}}']


def test_word_count_job(spark, folder):
    source = put(folder, "text.txt", "one two\ntwo don't\n")
    word_count.main(["--input", source, "--output", f"{folder}/plain"])
    word_count.main(["--input", source, "--output", f"{folder}/whole", "--apostrophes"])
    assert lines_of(spark, f"{folder}/plain") == ["don: 1", "one: 1", "t: 1", "two: 2"]
    assert lines_of(spark, f"{folder}/whole") == ["don't: 1", "one: 1", "two: 2"]


def point(**changes):
    item = {"dt_txt": "2026-04-13 12:00:00", "main": {"temp": 20.5, "temp_min": 18, "temp_max": 22, "humidity": 40},
            "weather": [{"main": "Clear", "description": "clear sky"}], "wind": {"speed": 3.5}, "pop": 0.2}
    item.update(changes)
    return {k: v for k, v in item.items() if v is not None}


def test_weather(spark, folder):
    cities = put(folder, "cities.csv", "city_name,country_code,lat,lon\nSantiago,CL,-33.4,-70.6\nLima,PE,-12.0,-77.0\n")
    put(folder, "landed/city=Santiago/a.json", json.dumps({"list": [point(), point(pop=None)]}))
    put(folder, "landed/city=Lima/a.json", json.dumps({"list": [point(weather=[])]}) + "\n{broken\n")
    for _ in range(2):  # the second run of a day replaces the first
        weather_forecast.main(["--cities", cities, "--responses", f"{folder}/landed", "--run-time", "2026-04-13T06:00:00",
                               "--output", f"{folder}/out", "--rejects", f"{folder}/rejects"])
    flat = spark.read.parquet(f"{folder}/out")
    assert sorted(os.listdir(f"{folder}/out"))[-1] == "p_ingestion_date=2026-04-13"
    got = sorted(flat.select("city", "country", "weather_main", "precipitation_probability").collect())
    assert [tuple(r) for r in got] == [("Santiago", "CL", "Clear", 0.0), ("Santiago", "CL", "Clear", 0.2)]
    rejects = spark.read.parquet(f"{folder}/rejects")
    assert sorted(r["_corrupt_record"] or "" for r in rejects.collect()) == ["", "{broken"]


def test_convert(spark, folder):
    schema = put(folder, "users.avsc", json.dumps({"type": "record", "name": "User", "fields": [
        {"name": "id", "type": "int"}, {"name": "name", "type": ["null", "string"]}, {"name": "active", "type": "boolean"}]}))
    source = put(folder, "users.json", '{"id":1,"name":"Ida","active":true,"email":"i@example.com"}\n{"id":2,"active":false}\n')
    convert.main(["--input", source, "--schema", schema, "--format", "parquet", "--output", f"{folder}/out", "--one-file"])
    assert sorted(tuple(r) for r in spark.read.parquet(f"{folder}/out").collect()) == [(1, "Ida", True), (2, None, False)]
    assert len([f for f in os.listdir(f"{folder}/out") if f.endswith(".parquet")]) == 1
    with pytest.raises(ValueError, match="unsupported format"):
        convert.main(["--input", source, "--schema", schema, "--format", "xml", "--output", f"{folder}/no"])
