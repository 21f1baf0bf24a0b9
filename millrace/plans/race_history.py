"""Race records: events with their team, and the full history per race and helicopter."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, functions as F

from millrace.functions.records import default_key, required_key
from millrace.operators.clean import split_valid
from millrace.operators.histories import CHUNK_ROWS
from millrace.operators.joins import co_group, expand_keys, lookup_struct, one_per_key
from millrace.schemas import RACE_EVENT, TEAM, TELEMETRY_V2
from millrace.session import build_session
from millrace.sinks.files import write_json_lines
from millrace.sources.files import read_json_lines

# What a record gets that has no race, or no known team.
UNKNOWN_RACE = "unknown_race"
UNKNOWN_TEAM = {"TeamName": "UNKNOWN"}
KEYS = ["RaceID", "HelicopterID"]


def events_with_team(events: DataFrame, teams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events with a nested ``TeamInfo``, and the skipped events that have no helicopter."""
    known, skipped = split_valid(events, F.col("HelicopterID") != "")
    return lookup_struct(known, teams, "HelicopterID", "TeamInfo", UNKNOWN_TEAM), skipped


def keyed(records: DataFrame, moment: str) -> DataFrame:
    """The key, the time to sort by (0 where it is missing) and the whole record.

    A record without a helicopter fails the job.
    """
    race = default_key(F.col("RaceID"), UNKNOWN_RACE) if "RaceID" in records.columns else F.lit(UNKNOWN_RACE)
    return records.select(
        race.alias("RaceID"), required_key(F.col("HelicopterID"), "record without HelicopterID").alias("HelicopterID"),
        F.coalesce(F.col(moment).cast("double"), F.lit(0.0)).alias("at"), F.struct(*records.columns).alias("record"))


def race_histories(telemetry: DataFrame, events: DataFrame, teams: DataFrame, team_scope: str = "all",
                   chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per race and helicopter with its sorted telemetry and events, and its team.

    ``team_scope='telemetry'`` gives a team only to keys that occur in the
    telemetry. ``chunk_rows`` bounds the lists: a longer history goes on, in time,
    in the rows with ``chunk`` 1, 2 and so on.
    """
    if team_scope not in ("all", "telemetry"):
        raise ValueError(f"unknown team scope: {team_scope}")
    sides = {"TelemetryHistory": keyed(telemetry, "Time_s"), "RaceEvents": keyed(events, "Timestamp_s")}
    nested = co_group(sides, KEYS, {name: ["at", F.xxhash64("record").alias("tie")] for name in sides}, chunk_rows,
                      {name: ["record"] for name in sides}, merged=True)
    nested = nested.withColumns({name: F.col(name).getField("record") for name in sides})
    if team_scope == "all":
        return lookup_struct(nested, teams, "HelicopterID", "TeamInfo", UNKNOWN_TEAM)
    info = [name for name in teams.columns if name != "HelicopterID"]
    scoped = expand_keys(sides["TelemetryHistory"], one_per_key(teams, ["HelicopterID"]), KEYS, ["HelicopterID"]).select(*KEYS, F.struct(*info).alias("TeamInfo"))
    missing = F.struct(*[F.lit(UNKNOWN_TEAM.get(f)).cast(teams.schema[f].dataType).alias(f) for f in info])
    return nested.join(scoped, KEYS, "left").withColumn("TeamInfo", F.coalesce("TeamInfo", missing))


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--events", required=True, help="glob of JSON Lines")
    parser.add_argument("--teams", required=True)
    parser.add_argument("--telemetry", help="adds the telemetry and writes histories instead of events")
    parser.add_argument("--team-scope", default="all", choices=["all", "telemetry"])
    parser.add_argument("--output", required=True)
    args = parser.parse_args(argv)
    spark = build_session("race-history")
    events = read_json_lines(spark, args.events, RACE_EVENT)
    teams = read_json_lines(spark, args.teams, TEAM)
    if args.telemetry:
        telemetry = read_json_lines(spark, args.telemetry, TELEMETRY_V2)
        result = race_histories(telemetry, events, teams, args.team_scope)
    else:
        result, _ = events_with_team(events, teams)
    write_json_lines(result, args.output)


if __name__ == "__main__":
    main()
