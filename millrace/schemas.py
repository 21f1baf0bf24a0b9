"""Record layouts. The field names and types here are fixed values of the data formats."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(), "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType(), "TIMESTAMP": T.TimestampType(),
}


def _schema(text: str) -> T.StructType:
    """A flat layout from ``name TYPE`` pairs, without needing a session."""
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in (pair.split() for pair in text.split(","))])


CUSTOMER_PEOPLE = _schema("id INT, name STRING, age INT")
USERS = _schema("id INT, name STRING, email STRING, active BOOLEAN")
MONITORING = _schema("id STRING, v INT, ts STRING")


METERS_SEED = _schema("id_meter STRING, location STRING, customer_type STRING, installation_date STRING")
READINGS_SEED = _schema(
    "reading_id STRING, meter_id STRING, voltage DOUBLE, kwh_consumption DOUBLE, recorded_at STRING")

RAW_CUSTOMERS = _schema(
    "user_id STRING, name_raw STRING, location_code STRING, order_value STRING, is_active_flag STRING")

TELEMETRY_V2 = _schema(
    "HelicopterID STRING, RaceID STRING, LapNumber INT, Time_s FLOAT, Speed_km_h FLOAT, Altitude_m FLOAT, "
    "FuelLevel_percentage FLOAT, EngineTemp_c INT, RotorRPM INT, Latitude DOUBLE, Longitude DOUBLE")
# Telemetry as the records carry it: measures with their decimals, before any narrowing.
TELEMETRY_MESSAGE = _schema(
    "HelicopterID STRING, RaceID STRING, LapNumber INT, Time_s DOUBLE, Speed_km_h DOUBLE, Altitude_m DOUBLE, "
    "FuelLevel_percentage DOUBLE, EngineTemp_c DOUBLE, RotorRPM INT, Latitude DOUBLE, Longitude DOUBLE")
RACE_EVENT = _schema(
    "EventID STRING, RaceID STRING, Timestamp_s BIGINT, EventType STRING, Details STRING, "
    "HelicopterID STRING, Impact STRING")
TEAM = _schema(
    "HelicopterID STRING, TeamName STRING, PilotName STRING, Country STRING, AircraftModel STRING, "
    "MaxSpeed_km_h INT, Endurance_hours FLOAT, Sponsor STRING")

# The relational target of telemetry: column, SQL type.
TELEMETRY_TABLE = {
    "id": "VARCHAR(255)",
    "HelicopterID": "VARCHAR(255)",
    "LapNumber": "INTEGER",
    "Time_s": "NUMERIC(10,5)",
    "Speed_km_h": "NUMERIC(10,5)",
    "Altitude_m": "NUMERIC(10,5)",
    "FuelLevel_percentage": "NUMERIC(10,3)",
    "EngineTemp_c": "NUMERIC(10,3)",
    "RotorRPM": "INTEGER",
    "Latitude": "NUMERIC(10,5)",
    "Longitude": "NUMERIC(10,5)",
}

CITIES = _schema("city_name STRING, country_code STRING, lat DOUBLE, lon DOUBLE")
FORECAST_RESPONSE = T.StructType().add("list", T.ArrayType(
    T.StructType()
    .add("dt_txt", T.StringType())
    .add("main", _schema("temp DOUBLE, temp_min DOUBLE, temp_max DOUBLE, humidity DOUBLE"))
    .add("weather", T.ArrayType(_schema("main STRING, description STRING")))
    .add("wind", _schema("speed DOUBLE"))
    .add("pop", T.DoubleType())))

