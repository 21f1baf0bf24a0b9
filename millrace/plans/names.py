"""Clean names and report their length."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, functions as F

from millrace.functions.text import clean_name
from millrace.session import build_session
from millrace.sinks.files import write_lines
from millrace.sources.files import read_lines


def name_lengths(names: DataFrame, name: str = "value") -> DataFrame:
    tidy = names.select(clean_name(F.col(name)).alias("name"))
    return tidy.withColumn("length", F.length("name"))


def name_line():
    return F.format_string("Name: %s, Length: %d", "name", "length")


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="text file with one name per line")
    parser.add_argument("--output", required=True)
    args = parser.parse_args(argv)
    spark = build_session("names")
    write_lines(name_lengths(read_lines(spark, args.input)), name_line(), args.output)


if __name__ == "__main__":
    main()
