"""The Jaccard join against all pairs of plain Python sets."""

import random

import numpy as np
import pytest

from millrace.llm import jaccard
from millrace.llm.components import connected_components
from millrace.llm.jaccard import choose_boundary, jaccard_components, packed, parities
from millrace.llm.words import shingle_sets, utf8
from millrace.session import stored


def plain_set(text, n=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        low = low.replace(space, " ")
    words = [w for w in low.split(" ") if w]
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def plain_components(rows):
    sets = [(key, plain_set(text)) for key, text in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for k, (key, _) in enumerate(sets):
        least[find(k)] = min(key, least.get(find(k), key))
    return sorted((key, len(own), least[find(k)]) for k, (key, own) in enumerate(sets))


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)] + ["Ünder", "ÉTÉ", "A", "a", "x\x00y", "\x1c"]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    texts = [None, "", "  \n\t", "one", "ONE", "one two three four", "one two  three\tfour", "one two three four five"]
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([4, 6, 9, 14, 20, 60, 200]))]
        if rng.random() < 0.3:
            base += passage
        for _ in range(rng.choice([1, 1, 2, 5])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "\n", "  "]).join(own))
    texts += ["long " * 40_000, "y" * 1_500_000, "y" * 1_500_000 + " "]
    keys = rng.sample(range(10_000), len(texts))
    return list(zip(keys, texts, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_all_pairs(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(k, t, "c", 7) for k, t in rows], "doc_id long, text string, component_id string, n int")
    got = jaccard_components(docs.repartition(5))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect())) == plain_components(rows)


def test_large_group_goes_through_rounds(spark):
    rng = random.Random(5)
    base = [f"b{rng.randrange(10_000)}" for _ in range(60)]
    rows = []
    for k in range(150):
        own = list(base)
        own[rng.randrange(5, 55)] = f"edit{k}"
        rows.append((k, " ".join(own)))
    rows += [(1000 + k, rows[0][1]) for k in range(50)]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), rounds=2, partners=3)
    assert sorted(map(tuple, got.collect())) == plain_components(rows)


def test_odd_rows(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, None), (None, None)]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(None, 2, 3), (3, 2, 3), (3, 2, 3), (4, 0, 4), (None, 0, None)]))
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_an_id_with_several_texts_unites_what_they_link_with(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    near = a.replace("a39", "a0")
    cases = [
        ([(5, a), (5, b), (3, b), (9, near)], {3: 3, 5: 3, 9: 3}),      # 5 is the first of one text and a copy of another
        ([(7, a), (1, a), (7, b), (3, b), (9, near), (8, c)], {7: 1, 1: 1, 3: 1, 9: 1, 8: 8}),   # the first of neither
        ([(2, a), (2, b)], {2: 2}),
        ([(4, a), (4, a), (4, None), (6, b)], {4: 4, 6: 6})]
    for rows, right in cases:
        got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert len(got) == len(rows) and {(r["doc_id"], r["component_id"]) for r in got} == set(right.items())


def test_boundary_follows_cost():
    assert choose_boundary({8: 1000}, 80, 50.0) > 8
    assert choose_boundary({500: 1000}, 80, 0.1) <= 500
    assert choose_boundary({}, 80, 0.0) in (0, 1)


def test_components(spark):
    edges = [(9, 8), (8, 7), (7, 7), (3, 2), (2, 3), (5, 5), (None, 4)] + [(k, k + 1) for k in range(100, 160)] + [(200, k) for k in range(201, 300)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {9: 7, 8: 7, 7: 7, 3: 2, 2: 2, 5: 5} | {k: 100 for k in range(100, 161)} | {k: 200 for k in range(200, 300)}
    assert got == want


def test_words_across_segments():
    import pyarrow as pa
    text = "ab " * 500_000 + "c" * 1_200_000 + " d"
    whole, parts = (shingle_sets(*utf8(pa.array(x)))[-1] for x in ([text], ["zz", text]))
    assert (whole == parts).all() and len(whole) == len(plain_set(text))
    assert len(packed(whole)) == 6 * len(whole)


def test_near_copies_share_few_lists_and_make_few_pairs(spark, monkeypatch):
    """A group of near copies has a list for nearly every shingle, with nearly the same members in each."""
    rng = random.Random(4)
    base, rows = [f"w{k}" for k in range(200)], []
    for key in range(60):
        own = list(base)
        own[rng.randrange(200)] = f"x{key}"
        rows.append((key, " ".join(own)))
    made = {}

    def counted(df, label):
        out = stored(df, label)
        made.setdefault(label, []).append(out.count())
        return out
    monkeypatch.setattr(jaccard, "stored", counted)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {0}
    assert made["lists"][-1] < 0.5 * made["lists"][0] and sum(made["pairs"]) <= 2 * len(rows)


def test_parity_bits_differ_in_no_more_places_than_the_sets():
    dice = np.random.default_rng(3)
    for n in (1, 5, 100, 3000):
        both, one, other = (np.unique(dice.integers(0, 2 ** 63, k, dtype=np.uint64) * np.uint64(2)) for k in (n, n // 3, n // 5 + 1))
        left, right = parities(np.concatenate([both, one])), parities(np.concatenate([both, other]))
        assert sum(int(x).bit_count() for x in (left ^ right).view(np.uint64)) <= len(one) + len(other)


def large_texts_apart():
    """Large texts that share most shingles and not enough of them, so that no two are linked."""
    base, rows = [f"w{k}" for k in range(3000)], []
    for key in range(12):
        own = list(base)
        for at in random.Random(key).sample(range(0, 3000, 5), 110):
            own[at] = f"x{key}-{at}"
        rows.append((key, " ".join(own)))
    return rows


def test_pairs_that_share_many_lists_meet_in_few(spark, monkeypatch):
    rows, made = large_texts_apart(), []
    kind = type(spark.range(1))
    distinct = kind.distinct

    def counted(df):
        if df.columns == ["a", "b"]:
            made.append(df.count())
        return distinct(df)
    monkeypatch.setattr(kind, "distinct", counted)
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), rounds=0).collect()
    assert sorted(map(tuple, got)) == plain_components(rows)
    assert 0 < sum(made) <= 66     # pairs of texts


def test_pairs_below_the_limit_bring_no_whole_sets_together(spark, monkeypatch):
    """Of large sets, few parity bits say little; the sketches, which grow with the sets, leave the pairs out."""
    rows = large_texts_apart()
    made = {}

    def counted(df, label):
        out = stored(df, label)
        made.setdefault(label, []).append(out.count())
        return out
    monkeypatch.setattr(jaccard, "stored", counted)
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == plain_components(rows)
    assert sum(made["pairs"]) > 0 and sum(made["sets"]) == 0


def test_sketches_differ_in_no_more_places_than_the_sets():
    dice = np.random.default_rng(4)
    for n in (1, 100, 127, 128, 3000, 90_000):
        both, one, other = (np.unique(dice.integers(0, 2 ** 63, k, dtype=np.uint64) * np.uint64(2)) for k in (n, n // 3, n // 5 + 1))
        left, right = jaccard.sketch(np.concatenate([both, one])), jaccard.sketch(np.concatenate([both, other]))
        assert jaccard.places_apart(left, right) == jaccard.places_apart(right, left) <= len(one) + len(other)
        assert jaccard.places_apart(left, left) == 0
