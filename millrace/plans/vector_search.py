"""Append embedded documents to a collection and report the nearest ones of each query."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from millrace.functions.numbers import round_half_even
from millrace.operators.vectors import add_documents, search
from millrace.session import build_session
from millrace.sinks.files import write_lines


def result_line():
    return F.format_string("%s | Result %d (Distance: %s): %s", "query_id", "rank",
                           round_half_even(F.col("distance"), 4).cast("string"), "document")


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--collection", required=True, help="Parquet folder with id, document, metadata, embedding")
    parser.add_argument("--add", help="Parquet rows of the same layout to append first")
    parser.add_argument("--queries", help="Parquet rows with id and embedding")
    parser.add_argument("--results", type=int, default=2)
    parser.add_argument("--metric", default="l2", choices=["l2", "cosine"])
    parser.add_argument("--output", help="where the results go")
    args = parser.parse_args(argv)
    spark = build_session("vector-search")
    if args.add:
        stored = spark.read.parquet(args.collection)
        add_documents(stored, spark.read.schema(stored.schema).parquet(args.add)).write.mode("append").parquet(args.collection)
    if args.queries:
        found = search(spark.read.parquet(args.collection), spark.read.parquet(args.queries), args.results, args.metric)
        write_lines(found, result_line(), args.output)


if __name__ == "__main__":
    main()
