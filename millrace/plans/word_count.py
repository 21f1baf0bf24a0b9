"""Count the words of text files."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from millrace.functions.text import WORD, WORD_WITH_APOSTROPHE
from millrace.operators.aggregates import count_words
from millrace.session import build_session
from millrace.sinks.files import write_lines
from millrace.sources.files import read_lines


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--apostrophes", action="store_true", help="keep apostrophes inside words")
    args = parser.parse_args(argv)
    spark = build_session("word-count")
    pattern = WORD_WITH_APOSTROPHE if args.apostrophes else WORD
    counts = read_lines(spark, args.input).transform(count_words("value", pattern))
    write_lines(counts, F.format_string("%s: %d", "word", "count"), args.output)


if __name__ == "__main__":
    main()
