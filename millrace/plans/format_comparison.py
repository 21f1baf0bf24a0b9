"""Time and size of one table in every format and codec."""

from __future__ import annotations

import argparse

from millrace.session import build_session
from millrace.sinks.format_report import compare_formats


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="Parquet table")
    parser.add_argument("--column", required=True, help="the column of the one-column scan")
    parser.add_argument("--scratch", required=True)
    args = parser.parse_args(argv)
    spark = build_session("format-comparison")
    compare_formats(spark.read.parquet(args.input), args.scratch, args.column).show(truncate=False)


if __name__ == "__main__":
    main()
