"""Fill-in-middle, whitening and quality rules against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm.feast import Spectrum, largest_eigenpairs
from millrace.llm.middle import Cuts, Memo, chunk_ends, fill_in_middle, restored
from millrace.llm.queries import QUERIES
from millrace.llm.rules import STOP_WORDS, Rule, judge_texts
from millrace.llm.whitening import fit_whitening, whiten

SF = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


# fill-in-middle

def plain_middle(doc_id, text, percent=50):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]
    units = UNIT.findall(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_texts():
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdé  \n𝄞") for _ in range(3000))
    texts = [None, "", " ", "\t\r\n", "x", " x", "x ", "a <P> b", "ends <", "<S", "ein Wort", "a\x1fb\x85c", "word " * 40_000,
             "é" * 20_000, " " * 20_000, "x" * 20_000 + " y", passage, "start " + passage, passage + passage]
    texts += ["".join(rng.choice("ab <>PSM\n\té") for _ in range(rng.randint(1, 400))) for _ in range(60)]
    return texts


def test_middle_against_plain(spark):
    rows = [(k, text) for k, text in enumerate(odd_texts())] + [(None, "no id here"), (3, "again"), (3, "again"), (-7, "below zero")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit(9), "form": F.lit("x"), "kept": F.lit(1)})
    for percent in (50, 100):
        made = fill_in_middle(docs, percent=percent)
        assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        got = made.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
        assert Counter(tuple(r)[:-1] for r in got) == Counter((k, *plain_middle(k, text, percent)) for k, text in rows)
        texts = Counter(text or "" for _, text in rows)
        assert Counter(r["back"] for r in got) == texts
    assert fill_in_middle(docs.filter("false")).count() == 0
    kept = fill_in_middle(docs.select("doc_id", "text", F.lit("q").alias("lang")), keep=("doc_id", "lang"))
    assert kept.columns[:2] == ["doc_id", "lang"]


def test_cuts_do_not_depend_on_the_memo():
    memo, small = Memo(), Memo(most_bytes=2_000)
    for text in odd_texts():
        data = (text or "").encode()
        one, other = Cuts(data, memo), Cuts(data, small)
        units = UNIT.findall(text or "")
        assert one.units == other.units == len(units)
        for k in {0, len(units) // 3, len(units) // 2, len(units)}:
            before = "".join(units[:k])
            assert one.place(k) == other.place(k) == (len(before.encode()), len(before))
    assert small.held <= 2_000 + 9 * 4096


def test_shared_passages_are_summarised_once():
    rng = random.Random(8)
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(4000)).encode()
    memo = Memo()
    Cuts(passage, memo)
    first = memo.misses
    Cuts(b"other words before it " + passage, memo)
    assert memo.misses - first <= 3 and memo.hits >= first - 3
    assert chunk_ends(np.frombuffer(b"a" * 50_000, np.uint8)).max() == 50_000


# whitening

def plain_whitening(vectors):
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    deviation = [int(((n * row - sums) ** 2).sum()) for row in x]
    y = np.array([[float(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    covariance = y.T @ y / n
    values, directions = np.linalg.eigh(covariance)
    return deviation, y, values[::-1], directions[:, ::-1], np.trace(covariance)


def test_whitening_against_eigh(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(400, 20)) * np.linspace(3, 0.1, 20) + 5).astype(np.float32)
    vectors[300:] = vectors[7]  # a quarter are copies
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(vectors)]
    odd = [(1000, None), (1001, []), (1002, [None] + [0.0] * 19), (1003, [float("nan")] * 20), (1004, [float("inf")] + [0.0] * 19),
           (1005, [1.0] * 19), (1006, [1e30] * 20)]
    table = spark.createDataFrame(rows + odd + [(None, rows[0][1]), (5, rows[5][1])], "vec_id long, embedding array<float>").repartition(7)
    table = table.withColumns({"component": F.lit("x"), "n": F.lit("y"), "kept": F.lit(0)})
    used = [v for _, v in rows] + [rows[0][1], rows[5][1]]
    deviation, y, values, directions, trace = plain_whitening(used)
    model = fit_whitening(table)
    got = whiten(table, model).collect()
    assert model.n == 402 and len(got) == 402 * 8
    assert np.allclose(model.values, values[:8], rtol=1e-12)
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(by_id) == set(range(400)) | {None}
    signs = [np.sign(model.vectors[c] @ directions[:, c]) for c in range(8)]
    for k in range(400):
        for c in range(8):
            r = by_id[k][c + 1]
            assert r["deviation"] == deviation[k]
            assert abs(r["whitened"] - signs[c] * (y[k] @ directions[:, c]) / np.sqrt(values[c])) < 1e-8
            assert abs(r["explained"] / (values[c] / trace) - 1) < 1e-10
    assert 0 <= got[0]["identity_error"] < 1e-9


def test_whitening_of_few_and_equal_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    nothing = spark.createDataFrame([], schema)
    assert fit_whitening(nothing) is None and whiten(nothing, None).count() == 0
    same = spark.createDataFrame([(k, [1.5, 2.5]) for k in range(5)], schema)
    assert len(fit_whitening(same).values) == 0 and whiten(same, fit_whitening(same)).count() == 0
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 7.0]) for k in range(5)], schema)
    got = whiten(line, fit_whitening(line)).collect()
    assert {r["component"] for r in got} == {1} and abs(got[0]["explained"] - 1) < 1e-9
    huge = spark.createDataFrame([(k, [float(2**29 - k), -float(2**29) + k * k]) for k in range(3000)], schema)
    deviations = {r["vec_id"]: int(r["deviation"]) for r in whiten(huge, fit_whitening(huge)).filter("component = 1").collect()}
    assert deviations == dict(enumerate(plain_whitening([r[1] for r in huge.collect()])[0]))


def test_eigenpairs():
    rng = np.random.default_rng(0)
    spectra = [rng.uniform(0, 1, 40), np.round(rng.uniform(0, 4, 30)), 10.0 ** rng.uniform(-12, 6, 25), 1 + rng.normal(size=20) * 1e-9,
               np.where(np.arange(30) < 3, 1.0, 0.0), np.ones(6), np.array([2.0]), np.array([3.0, -1.0])]
    for spectrum in spectra:
        turn = np.linalg.qr(rng.normal(size=(len(spectrum), len(spectrum))))[0]
        matrix = (turn * spectrum) @ turn.T
        matrix = (matrix + matrix.T) / 2
        right = np.linalg.eigvalsh(matrix)[::-1]
        values, vectors = largest_eigenpairs(matrix, 8)
        assert len(values) == min(8, int((right > 1e-12 * right[0]).sum()))
        assert np.abs(values - right[:len(values)]).max() < 1e-13 * 8 * right[0]
        assert np.abs(matrix @ vectors.T - vectors.T * values).max() < 1e-12 * right[0]
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
        assert [Spectrum(matrix).above(x) for x in (0.5, 1e-3)] == [int((right > x).sum()) for x in (0.5, 1e-3)]
    assert len(largest_eigenpairs(np.zeros((3, 3)), 2)[0]) == 0


def test_whitening_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("e")).collect()
    deviation, y, values, directions, trace = plain_whitening([r["e"] for r in rows])
    got = QUERIES["op12_embedding_whitening"](spark, SF).collect()
    assert len(got) == 8 * len(rows) and dict(QUERIES["op12_embedding_whitening"](spark, SF).dtypes)["deviation"] == "bigint"
    told = {r["vec_id"]: r["deviation"] for r in got}
    assert told == {r["vec_id"]: d for r, d in zip(rows, deviation)}
    for c in range(8):
        mine = np.array([{r["vec_id"]: r["whitened"] for r in got if r["component"] == c + 1}[r["vec_id"]] for r in rows])
        plain = y @ directions[:, c] / np.sqrt(values[c])
        assert min(np.abs(mine - plain).max(), np.abs(mine + plain).max()) < 1e-7


# quality rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    often = {w for w, c in Counter(windows).items() if c > 1}
    covered = {k + j for k, w in enumerate(windows) if w in often for j in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered),
            sum(w in {f for s in STOP_WORDS for f in (s, s.capitalize(), s.upper())} for w in words))


def test_measures_against_plain(spark):
    rng = random.Random(2)
    texts = odd_texts() + ["a b c d e " * 3, "a b c d e f a b c d e", "same line\nsame line\n \n\nsame line", "one\r\none\r\ntwo", "x " * 9,
                           "The the THE tHE", "a b c d e", "a a a a a a", " ".join(rng.choice("abc") for _ in range(300)), "## $ <>&|*%"]
    rows = list(enumerate(texts)) + [(None, "a b"), (1, "a b"), (1, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"failed": F.lit(1), "n_words": F.lit("x"), "_words": F.lit(2)})
    got = judge_texts(docs).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words"]
    assert Counter((r["doc_id"], *[r[x] for x in names]) for r in got) == Counter((k, *plain_measures(t)) for k, t in rows)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (not r["failed"]) and not (r["kept"] and r["base_failed"])
    assert judge_texts(docs.filter("false")).count() == 0


def test_rules_are_one_stage_without_functions(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    plan = judge_texts(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("rule, failing", [
    (Rule("r", "n_words", least=3), {1}), (Rule("r", "n_words", most=3), {2}), (Rule("r", "n_symbols", "n_words", most=50), {3}),
    (Rule("r", "n_symbols", "n_words", most=50, from_words=4), set()), (Rule("r", "n_lines", "n_symbols", least=1), set())])
def test_rule(spark, rule, failing):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b c d"), (3, "# # c")], "doc_id long, text string")
    assert {r["doc_id"] for r in judge_texts(docs, rules=(rule,)).filter("NOT kept").collect()} == failing
    assert judge_texts(docs, rules=(rule,)).filter("base_failed").count() == 0
