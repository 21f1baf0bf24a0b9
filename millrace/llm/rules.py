"""Quality rules: a table of thresholds compiled into one projection, without user functions.

The measures of a text are built from native functions in one stage without a shuffle: each select below is a projection
over the row alone. A rule bounds one measure, or the ratio of two in percent, in whole numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 5
# Common words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "was", "on", "with", "be", "as", "by", "this", "are", "at", "from",
    "der", "die", "und", "den", "von", "zu", "das", "sich", "mit", "auf", "des", "für", "ist", "nicht", "im", "dem", "ein", "eine",
    "de", "la", "le", "et", "les", "en", "un", "du", "une", "que", "pour", "est", "qui", "dans", "par", "pas", "sur", "avec",
    "el", "y", "los", "se", "del", "las", "por", "no", "con", "su", "una", "es", "para", "al", "lo")


@dataclass(frozen=True)
class Rule:
    """``least <= measure <= most``; with ``of``, ``least <= 100 * measure / of <= most``. A ratio of nothing passes, and
    so does a text of fewer than ``from_words`` words. A ``base`` rule is one of those that alone make ``base_failed``.
    """

    name: str
    measure: str
    of: str | None = None
    least: int | None = None
    most: int | None = None
    base: bool = False
    from_words: int = 0

    def fails(self) -> Column:
        value = F.col(self.measure) * (1 if self.of is None else 100)
        unit = F.lit(1) if self.of is None else F.col(self.of)
        low = F.lit(False) if self.least is None else value < unit * self.least
        high = F.lit(False) if self.most is None else value > unit * self.most
        return (low | high) & (F.col("n_words") >= self.from_words)


RULES = (
    Rule("few_words", "n_words", least=10, base=True),
    Rule("repeated_words", "n_repeat_words", "n_words", most=20, base=True),
    Rule("many_words", "n_words", most=1_000_000),
    Rule("word_length", "word_chars", "n_words", least=200, most=1500),
    Rule("symbols", "n_symbols", "n_words", most=100),
    Rule("stop_words", "n_stop_words", "n_words", least=1, from_words=50),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=50),
)


def with_measures(docs: DataFrame, text: str, stop_words: tuple[str, ...]) -> DataFrame:
    """The row with its measures, all long. Words that a text repeats are found by sorting its windows, as 64-bit hashes.
    Stop words count in lower case, upper case and with a capital first letter."""
    forms = sorted({form for x in stop_words for form in (x, x.capitalize(), x.upper())})
    found = docs.withColumns({
        "_text": F.coalesce(text, F.lit("")),
        "_words": F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), ""),
        "_lines": F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    found = found.withColumn("_hashes", F.transform("_words", lambda x: F.xxhash64(x)))
    windows = F.transform(F.sequence(F.lit(0), F.size("_hashes") - WINDOW), lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)]))
    found = found.withColumn("_windows", F.when(F.size("_hashes") > WINDOW, windows))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    # (window, place) in order: equal neighbours are repeats
    found = found.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))))
    same = F.filter("_sorted", lambda x, k: (x["w"] == F.get("_sorted", k + 1)["w"]) | (x["w"] == F.get("_sorted", k - 1)["w"]))
    found = found.withColumn("_places", F.sort_array(F.transform(same, lambda x: x["i"])))
    covered = F.transform("_places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_places", k + 1) - p, F.lit(WINDOW))))
    symbols = F.length("_text") - F.length(F.regexp_replace("_text", "[#*$%&|<>]", ""))
    measures = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": symbols,
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)),
        "n_stop_words": F.size(F.filter("_words", lambda x: x.isin(*forms))),
    }
    return found.select(*docs.columns, *[value.cast("long").alias(name) for name, value in measures.items()])


def judge_texts(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, stop_words: tuple[str, ...] = STOP_WORDS,
                keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, the measures, ``failed`` (names of the rules that a text fails), ``base_failed`` and ``kept``.

    Words are runs of characters other than space and 0x09-0x0D, taken as they are. A null text is an empty one: without
    words it fails ``few_words``. Rows are judged one by one, so ties and repeated ids do not matter; an empty table gives
    an empty result, and only ``keep`` and the text are read, so other columns may have any name. A text is one value of
    one row: a task needs memory for about 60 times its length while it is judged.
    """
    inner = docs.select(F.col(text).alias("_in"), F.struct(*keep).alias("_keep"))
    names = F.filter(F.array(*[F.when(rule.fails(), F.lit(rule.name)) for rule in rules]), lambda x: x.isNotNull())
    base = [rule.name for rule in rules if rule.base]
    judged = with_measures(inner, "_in", stop_words).withColumn("failed", names)
    measured = [x for x in judged.columns if x not in ("_in", "_keep")]
    base_failed = F.arrays_overlap("failed", F.array(*map(F.lit, base))) if base else F.lit(False)
    return judged.select("_keep.*", *measured, base_failed.alias("base_failed"), (F.size("failed") == 0).alias("kept"))
