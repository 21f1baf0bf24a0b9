"""JSON Lines to another format, by an Avro schema file."""

from __future__ import annotations

import argparse
import json

from millrace.session import build_session
from millrace.sinks.files import write_table
from millrace.sources.avro_schema import load_avro_schema, struct_from_avro
from millrace.sources.files import read_json_lines


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--schema", required=True, help="an .avsc file")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--output", required=True)
    parser.add_argument("--one-file", action="store_true")
    args = parser.parse_args(argv)
    spark = build_session("convert")
    declared = load_avro_schema(spark, args.schema)
    schema = struct_from_avro(declared)
    rows = read_json_lines(spark, args.input, schema)
    write_table(rows, args.output, args.format, schema=schema,
                avro_schema=json.dumps(declared) if args.format == "avro" else None, one_file=args.one_file)


if __name__ == "__main__":
    main()
