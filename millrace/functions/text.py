"""String columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The two word patterns of the word counts, and the runs title() works on.
WORD = "[a-zA-Z]+"
WORD_WITH_APOSTROPHE = "[a-zA-Z']+"
LETTER_RUNS = r"(\p{L}+|\P{L}+)"

# Every character that counts as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000")


def strip(value: Column) -> Column:
    """Remove every kind of whitespace at both ends (``trim`` alone removes spaces only)."""
    return F.trim(value, F.lit(WHITESPACE))


def title(value: Column) -> Column:
    """Capital at the start of each run of letters: ``o'neil`` becomes ``O'Neil``."""
    runs = F.regexp_extract_all(value, F.lit(LETTER_RUNS), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def clean_name(value: Column) -> Column:
    return title(strip(value))


def trimmed_text(value: Column) -> Column:
    """The SQL staging rule: text first, then spaces off both ends."""
    return F.trim(value.cast("string"))


def words(value: Column, pattern: str = WORD) -> Column:
    """All matches of ``pattern``, in order, as an array."""
    return F.regexp_extract_all(value, F.lit(pattern), F.lit(0))


def fields(line: Column, separator: str = ",") -> Column:
    """All fields of a delimited line."""
    return F.split(line, separator, -1)


def field(line: Column, position: int, separator: str = ",") -> Column:
    """One field of a delimited line by 0-based position; NULL past the end."""
    return F.get(fields(line, separator), F.lit(position))


def padded_id(prefix: str, number: Column, width: int = 3) -> Column:
    """``prefix`` and the number with leading zeros; longer numbers are kept whole."""
    return F.format_string(f"{prefix}%0{width}d", number)


def without_prefix(value: Column, prefix: str) -> Column:
    """Drop ``prefix`` where the value starts with it."""
    cut = F.substring(value, F.lit(len(prefix) + 1), F.length(value))
    return F.when(F.startswith(value, F.lit(prefix)), cut).otherwise(value)


def canonical_label(value: Column, labels: list[str]) -> Column:
    """Spell a category the way ``labels`` does, ignoring case; unknown ones stay as they are."""
    pairs = [F.lit(part) for label in labels for part in (label.lower(), label)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(value)), value)


def as_strings(values: Column) -> Column:
    """A list of numbers as a list of texts."""
    return F.transform(values, lambda item: item.cast("string"))


def csv_line(*columns: Column) -> Column:
    return F.concat_ws(",", *columns)
