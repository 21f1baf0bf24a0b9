"""Language, packing, mixing, licences and the pipeline on small tables."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm.language import LanguageModel, fit, identify_languages, learn_languages
from millrace.llm.licences import NOTICES, scan_licences
from millrace.llm.mixing import copies, domain_of_labels, mixing_rates, rates_after, shares_of_sample, solve_rates, solve_steps
from millrace.llm.packing import BestFit, WordTokens, pack_documents
from millrace.llm.queries import QUERIES, TARGETS
from tests.llm.test_jaccard import plain_components, plain_set

SF = "/root/testdata/sf0.001"
TOKENS = public_tokenizers.path("word_bpe_49k.json")


def made(seed, syllables, n, words=(3, 60)):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(*words))) for _ in range(n)]


# language

def test_language_held_out(spark):
    own = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sche", "ung", "ver", "ein"], "cc": ["ção", "ões", "nha", "qué"]}
    rows = [(k, text, lang) for lang, syl in own.items() for k, text in enumerate(made(lang, syl, 300))]
    rows = [(k, text, lang) for k, (_, text, lang) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    model = learn_languages(docs.filter("doc_id % 3 <> 0"))
    got = {r["doc_id"]: r for r in identify_languages(docs, model).collect()}
    held = [(k, lang) for k, _, lang in rows if k % 3 == 0]
    assert np.mean([got[k]["lang_pred"] == lang for k, lang in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert np.mean([r["rejected"] for r in got.values()]) < 0.02


def test_language_odd_rows(spark):
    model = fit(["aa"] * 40 + ["bb"] * 40, [np.arange(k, k + 9, dtype=np.int32) for k in range(80)])
    rows = [(1, None), (2, ""), (3, "123 !? \n"), (None, "ka"), (5, "é"), (5, "é"), (6, "ka " * 700_000), (7, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = identify_languages(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (1, 2, 3))
        assert r["rejected"] or r["doc_id"] not in (1, 2, 3)
        assert r["score"] == 0 or r["doc_id"] not in (1, 2, 3)
    nothing = identify_languages(docs, LanguageModel((), np.zeros((1 << 16, 0), np.float32), 1.0, 0.0)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert learn_languages(docs.withColumn("lang", F.lit(None).cast("string"))).languages == ()
    assert identify_languages(docs.filter("false"), model).count() == 0
    kept = identify_languages(docs.withColumn("lang", F.lit("q")), model, keep=("doc_id", "text", "lang"))
    assert kept.columns == ["doc_id", "text", "lang", "lang_pred", "score", "rejected"]
    assert sorted(map(repr, map(tuple, kept.select("doc_id", "text").collect()))) == sorted(map(repr, rows))


def test_language_query(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op7_language_id"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"]]) > 0.9


# packing

def test_best_fit_closes_the_fullest():
    bins = BestFit(10, 2)
    assert [bins.place(n) for n in (6, 7, 5, 4, 3)] == [(0, 0), (1, 0), (2, 0), (0, 6), (2, 5)]
    bins = BestFit(10, 1000)
    placed = [bins.place(1 + k % 10) for k in range(2000)]
    assert len(set(placed)) == 2000 and len({b for b, _ in placed}) <= 1120


def test_tokens_equal_the_tokenizer():
    from tokenizers import Tokenizer
    whole, rng = Tokenizer.from_file(TOKENS), random.Random(3)
    letters = "aBÉßé\u0301\u0130\u017fªºµ×÷ÿΣς 012'sS'T!?.-_<|>endoftext|> \t\n\x0b\x1c\x85\xa0\u200b가你🙂½"
    own = WordTokens(TOKENS)
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(own.ids(text.encode()), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_packing(spark):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(TOKENS)
    texts = [None, "", "one two", "one two", "word " * 9000, *made(4, ["ka", "lo", "th"], 200, (1, 900))]
    rows = [(k if k != 2 else None, t, "x") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece string").repartition(3)
    got = pack_documents(docs, TOKENS).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for k, text, _ in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted(by[k], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(-(-len(ids) // 4096)))
        for r in pieces:
            part = ids[r["start"]:r["start"] + 4096].tobytes()
            assert (r["start"], r["length"], r["ids_crc32"], r["ids"]) == (4096 * r["piece"], len(part) // 4, zlib.crc32(part), part)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) <= sum(r["length"] for r in got) / 4096 + 4
    assert pack_documents(docs.filter("false"), TOKENS).count() == 0


@pytest.mark.parametrize("partitions", [1, 8, 64, 211])
def test_fill_hardly_depends_on_the_partitions(spark, partitions):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(partitions)
    got = pack_documents(docs, TOKENS, with_ids=False).toPandas()
    bound = -(-got["length"].sum() // 4096)
    ends = got.assign(end=got["offset"] + got["length"]).groupby("sequence_id").agg({"end": "max", "length": "sum"})
    assert (ends["end"] == ends["length"]).all() and ends["end"].max() <= 4096
    assert len(ends) <= 1.02 * bound + 1 and len(got.drop_duplicates(["doc_id", "piece"])) == len(got)


# mixing

def test_rates_match_targets(spark):
    rng = np.random.default_rng(1)
    shares, tokens = rng.dirichlet([2, 0.5, 0.3], 500), rng.integers(0, 900, 500)
    members = spark.createDataFrame([(k, int(t), s.tolist()) for k, (t, s) in enumerate(zip(tokens, shares, strict=True))],
                                    "id long, tokens long, posteriors array<double>")
    goal = np.array([0.6, 0.1, 0.3])
    rate = np.array([r["rate"] for r in solve_rates(members, goal).orderBy("id").collect()])
    assert (rate >= 0).all()
    assert np.abs((tokens * rate) @ shares / tokens.sum() - goal).max() < 2e-5
    # the nearest rates: plain projected gradient on the dual of the same problem
    moved = np.zeros(3)
    for _ in range(20_000):
        moved += 0.5 * ((tokens * rates_after(shares, moved)) @ shares / tokens.sum() - goal)
    assert np.abs(rates_after(shares, moved) - rate).max() < 1e-2


def nonnegative_least_squares(a, b):
    """Active sets, one more column at a time: the exact residual to hold the fit against."""
    x, used = np.zeros(a.shape[1]), []
    while True:
        gain = a.T @ (b - a @ x)
        best = int(gain.argmax())
        if gain[best] <= 1e-12 or best in used:
            return x
        used.append(best)
        while True:
            z = np.linalg.lstsq(a[:, used], b, rcond=None)[0]
            if (z > 0).all():
                break
            held = x[used]
            share = (held[z <= 0] / np.maximum(held[z <= 0] - z[z <= 0], 1e-300)).min()
            held = held + share * (z - held)
            used = [k for k, v in zip(used, held) if v > 1e-14]
            x[:] = 0
            x[used] = [v for v in held if v > 1e-14]
        x[:] = 0
        x[used] = z


@pytest.mark.parametrize("goal", [[0.0, 0.0, 1.0], [0.98, 0.01, 0.01], [0.3, 0.3, 0.4], [0.05, 0.9, 0.05]])
def test_rates_of_targets_that_cannot_be_reached(spark, goal):
    rng = np.random.default_rng(2)
    shares = rng.dirichlet([8, 1, 1], 400) * 0.8 + np.array([0.12, 0.04, 0.04])   # no document is of one domain alone
    tokens = rng.integers(0, 900, 400)
    members = spark.createDataFrame([(k, int(t), s.tolist()) for k, (t, s) in enumerate(zip(tokens, shares, strict=True))],
                                    "id long, tokens long, posteriors array<double>")
    fit = solve_steps(members, np.array(goal))
    a = (shares * (tokens / tokens.sum())[:, None]).T
    best = a @ nonnegative_least_squares(a, np.array(goal)) - goal
    assert abs(np.linalg.norm(fit.residual) - np.linalg.norm(best)) < 1e-4
    assert fit.reached == (np.abs(best).max() < 1e-9)
    if not fit.reached:
        assert np.abs(fit.residual - best).max() < 1e-4
    held = solve_steps(members, np.array(goal), most_squares=4.0)
    rate = rates_after(shares, held.moved)
    assert tokens @ rate ** 2 / tokens.sum() <= 4.0 and np.linalg.norm(held.residual) <= np.linalg.norm((tokens @ shares) / tokens.sum() - goal) + 1e-9


def test_mixing_query_meets_its_targets(spark):
    for scale in ("sf0.001", "sf0.01"):
        got = QUERIES["op2_mixing_rates"](spark, f"/root/testdata/{scale}").toPandas()
        shares = [(got["rate"] * got["tokens"] * got[x]).sum() / got["tokens"].sum() for x in TARGETS]
        assert np.abs(np.array(shares) - list(TARGETS.values())).max() < 2e-5 and (got["rate"] >= 0).all()


def test_rare_domains_are_in_the_sample():
    assert shares_of_sample({"good": 99_990, "toxic": 10}, 4000) == {"good": 1999, "toxic": 10}
    assert shares_of_sample({"a": 5000, "b": 5000, "c": 5000, "d": 5}, 400) == {"a": 66, "b": 66, "c": 66, "d": 5}
    assert sum(shares_of_sample({str(k): 10**6 for k in range(7)}, 4000).values()) <= 4000 and shares_of_sample({}, 10) == {}


def test_mixing(spark):
    good, bad = made(1, ["ka", "lo"], 80), made(2, ["zz", "xx"], 80)
    rows = [(k, t) for k, t in enumerate(good + bad)] + [(900, None), (901, ""), (None, good[0]), (5, good[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rate", F.lit("clash"))
    labels = spark.createDataFrame([(k, int(k < 80), 0) for k in range(0, 160, 2)] + [(None, 1, 0), (3, None, None)],
                                   "doc_id long, quality int, toxic int").withColumn("domain", domain_of_labels())
    got = mixing_rates(docs, labels, {"good": 3, "low": 1}).collect()
    assert len(got) == len(rows)
    total = sum(r["tokens"] for r in got)
    assert abs(sum(r["rate"] * r["tokens"] * r["posteriors"]["good"] for r in got) / total - 0.75) < 1e-4
    assert np.mean([r["rate"] > 1 for r in got if r["doc_id"] is not None and r["doc_id"] < 80]) > 0.9
    assert {r["rate"] for r in mixing_rates(docs, labels.filter("false"), {"good": 1}).collect()} == {1.0}
    assert mixing_rates(docs.filter("false"), labels, {"good": 1}).count() == 0
    assert {r["rate"] for r in mixing_rates(docs, labels, {"nowhere": 1}).collect()} == {1.0}
    partly = mixing_rates(docs, labels, {"good": 3, "low": 1, "nowhere": 9}).collect()
    assert sorted(r["rate"] for r in partly) == sorted(r["rate"] for r in got)


def test_copies_have_the_rate_as_mean(spark):
    rows = spark.range(20_000).select("id", copies(F.lit(1.3), "id").alias("n"))
    assert {r["n"] for r in rows.distinct().select("n").distinct().collect()} == {1, 2}
    assert abs(rows.agg(F.avg("n")).first()[0] - 1.3) < 0.02


# licences

def plain_scan(text, threshold=0.85):
    def grams(part):
        words = "".join(c.lower() if c.isascii() and c.isalnum() else " " if c.isascii() else c for c in part).split()
        return set(zip(words, words[1:])) if len(words) > 1 else {(w, None) for w in words}
    lines = (text or "").split("\n")
    full = [k for k, x in enumerate(lines) if grams(x)]
    units = {(k, k + 1) for k in full} | ({(full[0], full[-1] + 1)} if full else set())
    for k in full:
        if k - 1 not in full:
            end = k
            while end in full:
                end += 1
            units.add((k, end))
    found = {}
    for top, end in units:
        own = grams("\n".join(lines[top:end]))
        scores = {name: 2 * len(own & t) / (len(own) + len(t)) for name, t in ((n, grams(x)) for n, x in NOTICES.items())}
        name = min(scores, key=lambda x: (-scores[x], x))
        if scores[name] >= threshold:
            found[name] = max(found.get(name, 0), scores[name])
    return found


def test_licences(spark):
    mit, gpl = NOTICES["MIT"], NOTICES["GPL-3.0"]
    grant = NOTICES["MIT-grant"].split()
    texts = [None, "", "\n \n", "nothing here", mit, f"Intro text.\n{mit}\nMore text", f"{gpl.upper()}\n\n{mit}", f"so {mit} inline",
             "\n".join(" ".join(grant[k:k + 9]) for k in range(0, len(grant), 9)), "Released under the", "MIT " * 300_000, f"{mit}\n{mit}",
             f"é {gpl}\r\nx", "Licensed under CC BY 4.0!", "under under under"]
    rows = [(k, t, 1) for k, t in enumerate(texts)] + [(None, mit, 1)]
    got = {}
    for r in scan_licences(spark.createDataFrame(rows, "doc_id long, text string, licence int")).collect():
        got.setdefault(r["doc_id"], {})[r["licence"]] = r["dice"]
    for k, text, _ in rows:
        assert got.get(k if text is not None else -1, {}) == pytest.approx(plain_scan(text)), (k, text and text[:60])
    places = scan_licences(spark.createDataFrame(rows[5:6], "doc_id long, text string, x int")).first()
    assert texts[5].encode()[places["start_byte"]:places["start_byte"] + places["n_bytes"]].decode().strip() == mit
    assert scan_licences(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert scan_licences(spark.createDataFrame(rows, "doc_id long, text string, x int"), {}).count() == 0


def test_licence_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {}
    for r in QUERIES["op10_licence_scan"](spark, SF).collect():
        got.setdefault(r["doc_id"], {})[r["licence"]] = r["dice"]
    assert got == {k: pytest.approx(x) for k, x in ((k, plain_scan(t)) for k, t in docs.items()) if x}


# pipeline

def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    extra = spark.createDataFrame([(900_001, None, "en", "s", 0), (900_002, "12 34", "en", "s", 5), (None, "The of and that with on ing", None, None, None),
                                   (0, docs.filter("doc_id = 0").first()["text"], "en", "s", 1)], docs.schema)
    docs = docs.unionByName(extra)
    docs.write.parquet(f"{folder}/0")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = spark.read.parquet(f"{folder}/{k}")
        stage(spark, before, SF).write.parquet(f"{folder}/{k + 1}")
        after = spark.read.parquet(f"{folder}/{k + 1}")
        assert k == 3 or sorted(after.columns) == sorted(columns)
        old, new = ([tuple(r) for r in x.select("doc_id", "text").collect()] for x in (before, after.select("doc_id", *(["text"] if k < 3 else [F.lit(0).alias("text")]))))
        if name == "language":
            assert set(old) - set(new) >= {(900_001, None), (900_002, "12 34")} and len(new) >= len(old) - 6
        if name == "near_copies":
            numbered = list(enumerate(t for _, t in old))
            groups = {c for _, _, c in plain_components(numbered)}
            assert len(new) == len(groups) and set(new) <= set(old)
            texts = [plain_set(t) for _, t in new]
            assert all(100 * len(a & b) < 80 * len(a | b) for i, a in enumerate(texts) for b in texts[:i] if a)
        if name == "mixing":
            assert set(new) <= set(old) and 0.5 * len(old) < len(new) < 1.5 * len(old)
        if name == "packing":
            assert {x for x, _ in old} == {x for x, _ in new}


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "mixing", "packing"]
