"""Chat pairs, URL rules, WARC captures and vectors against plain versions."""

import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.llm.chat import preference_pairs, swapped_replies
from millrace.llm.near_vectors import estimates, near_vectors, rotation, unit
from millrace.llm.queries import ORACLES, QUERIES
from millrace.llm.topk import exact_topk, upper_bounds
from millrace.llm.urls import judge_urls, open_prefixes
from millrace.llm.warc import archived_captures, assemble, read_archives, read_records, size_tiers, write_archives
from tools.check_oracles import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), name, SF) == []


def test_registered_under_the_operators_numbers():
    assert {f"op{k}" for k in range(1, 14)} == {x.split("_")[0] for x in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


# chat

def test_pairs(spark):
    rows = [(1, "chosen", 0, "user", "hi"), (1, "chosen", 1, "assistant", "yes"), (1, "rejected", 0, "user", "hi"),
            (1, "rejected", 1, "assistant", "no"), (1, "rejected", 2, "user", "why"), (1, "rejected", 3, "assistant", "so"),
            (2, "chosen", 0, "user", "a"), (3, "rejected", 5, None, None), (4, "chosen", 0, "user", "x"), (4, "rejected", 9, "user", "x"),
            (None, "chosen", 0, "user", "x"), (5, "other", 0, "user", "x"), (6, "chosen", None, "user", "x"),
            (7, "chosen", 0, "user", "p"), (7, "chosen", 0, "user", "p"), (7, "rejected", 0, "user", "p"), (8, "chosen", 0, "user", "w " * 500_000)]
    got = {r["pair_id"]: r for r in preference_pairs(spark.createDataFrame(rows, "pair_id long, side string, turn int, role string, text string")
                                                     .withColumn("prompt", F.lit(1))).collect()}
    assert set(got) == {1, 2, 3, 4, 7, 8}
    one = got[1]
    assert (one["common_turns"], one["prompt"]) == (1, "<|user|>\nhi<|end|>\n")
    assert one["chosen"] == "<|assistant|>\nyes<|end|>\n"
    for side, spoken in (("chosen", ["yes<|end|>\n"]), ("rejected", ["no<|end|>\n", "so<|end|>\n"])):
        assert [one[side][m["start"]:m["start"] + m["length"]] for m in one[f"{side}_mask"]] == spoken
    assert (got[2]["common_turns"], got[2]["prompt"], got[2]["chosen_mask"], got[2]["rejected"]) == (0, "", [], "")
    assert got[3]["rejected"] == "<||>\n<|end|>\n"
    assert (got[4]["common_turns"], got[4]["chosen"], got[4]["rejected"]) == (1, "", "")
    assert (got[7]["common_turns"], got[7]["chosen"]) == (1, "<|user|>\np<|end|>\n")
    assert preference_pairs(spark.createDataFrame([], "pair_id long, side string, turn int, role string, text string")).count() == 0


def test_swapped_replies(spark):
    rows = [(2, 0, "user", "q"), (2, 1, "assistant", "r"), (2, 2, "user", "t"), (3, 0, "user", "u"), (3, 1, "assistant", "v"), (6, 0, "user", "z"), (None, 0, "user", "n")]
    got = sorted(map(tuple, swapped_replies(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()))
    assert got == sorted([(2, "chosen", 0, "user", "q"), (2, "chosen", 1, "assistant", "r"), (2, "rejected", 0, "user", "q"), (2, "rejected", 1, "assistant", "v"),
                          (3, "chosen", 0, "user", "u"), (3, "chosen", 1, "assistant", "v"), (3, "rejected", 0, "user", "u"), (3, "rejected", 1, "assistant", "r"),
                          (6, "chosen", 0, "user", "z")])


# urls

def plain_verdict(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([k for k in map(rest.find, "/?#") if k >= 0], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:][:min([k for k in map(rest[cut:].find, "?#") if k >= 0], default=len(rest))]
    best = None
    for rule, verdict in rules:
        if rule and verdict and rule.split("/")[0]:
            at, prefix = rule.split("/", 1)[0].lower(), rule[len(rule.split("/")[0]):]
            if (host == at or host.endswith("." + at)) and path.startswith(prefix):
                best = max(best or (), (len(at), len(prefix), verdict, rule))
    return host, path, best and best[3], best[2] if best else "allow"


def test_urls(spark):
    rules = [("net/", "block"), ("example.net/en/", "allow"), ("example.net/en/a", "block"), ("Sub.example.net", "block"), ("org/fr/", "allow"),
             ("org/fr/", "block"), (None, "block"), ("/x", "block"), ("com", None), ("a.b.c.d.net/", "allow")]
    urls = [None, "", "net/", "http://net", "http://net/", "http://NET/x", "ftp://x.net?y#/", "a://example.net/en/", "a://w.example.net/en/abc?q", "a://examplenet/en/",
            "a://xexample.net/en/q", "a://sub.example.net/en/q", "a://deep.sub.example.net", "a://org/fr/1", "a://org/f", "a://b.org/fr/#z", "x://y://z.net/", "a://.net/",
            "a://net./", "a://É.net/ü", "http://a.b.c.d.net/" + "p" * 100_000, "a://net/\nb", "a:// .net/"]
    rows = [(k, u, "h") for k, u in enumerate(urls)] + [(None, "a://net/", "h"), (5, urls[5], "h")] + [(100 + k, "a://hot.net/", "h") for k in range(50)]
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string"), spark.createDataFrame(rules, "rule string, verdict string"))
    want = [(k, *plain_verdict(u, rules)) for k, u, _ in rows]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    assert {r["verdict"] for r in judge_urls(pages, spark.createDataFrame([], "rule string, verdict string"), default="block").collect()} == {"block"}
    assert judge_urls(pages.filter("false"), spark.createDataFrame(rules, "rule string, verdict string")).count() == 0


def test_sweep_over_many_partitions(spark):
    import random
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab.") for _ in range(rng.randint(1, 9))) for _ in range(800)})
    rules, points = words[::5], words
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frames = [spark.createDataFrame([(x,) for x in xs], "key string") for xs in (points, rules)]
        got = {r["key"]: r["open"] for r in open_prefixes(*frames).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {p: [r for r in sorted(rules, key=len) if p.startswith(r)] for p in points}
    assert got == {p: x for p, x in want.items() if x}


# warc

def test_round_trip(spark, folder):
    same, tricky = "ü" * 600, "WARC/1.1\r\n\r\n\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n" * 30
    rows = [(1, "http://a.net/x?y", same), (7, None, same), (3, "http://b\r\nX: y/", same), (4, "u", None), (5, "u", ""), (6, "u", "s" * 999), (8, "u", "s" * 999),
            (9, "u", tricky), (10, "v", tricky), (None, "n", tricky), (11, "\u20ac://\u20ac/", "z" * 3_000_000), (12, "u", same), (12, "u", same)]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, type string").coalesce(2)
    got = archived_captures(pages).collect()
    assert len(got) == len(rows)
    responses = {r["capture_id"]: r for r in got if r["capture"]["type"] == "response"}
    seen = []
    for r in got:
        page, kind = r["metadata"]["page_id"], r["capture"]["type"]
        payload = (r if kind == "response" else responses[r["capture"]["refers_to"]])["capture"]["payload"]
        assert (r["capture"]["payload_bytes"], r["capture"]["payload_digest"]) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert r["request"] is not None and (kind == "response") == (r["original"] is None)
        seen.append((page, payload.decode()))
        if kind == "revisit":
            assert len(payload) >= 1000 and r["original"]["page_id"] == max(x for x, _, h in rows if (h or "").encode() == payload and x is not None)
    assert sorted(map(repr, seen)) == sorted(repr((k, h or "")) for k, _, h in rows)
    assert sum(r["capture"]["type"] == "revisit" for r in got) == 3 + 2 + 1 - 0 - 1 + 1
    assert archived_captures(pages.filter("false")).count() == 0


def test_transactions_through_requests(spark):
    def row(kind, key, to=None, page=None):
        return (kind, key, to, None, None, page, 1 if kind == "response" else None, None, None)
    records = [row("response", "r1"), row("request", "q1", "r1"), row("metadata", "m1", "q1", 5), row("response", "r2"), row("metadata", "m2", "r2", 6),
               row("metadata", "m3", "r2", 7), row("metadata", "m4", "gone", 8), row("request", "q2", None), row("response", None)]
    schema = ("type string, record_id string, concurrent_to string, refers_to string, uri string, page_id long, payload_bytes long, "
              "payload_digest string, payload binary")
    got = {r["capture_id"]: r for r in assemble(spark.createDataFrame(records, schema)).collect()}
    assert set(got) == {"r1", "r2"}
    assert (got["r1"]["request"]["record_id"], got["r1"]["metadata"]["page_id"]) == ("q1", 5)
    assert (got["r2"]["request"], got["r2"]["metadata"]["page_id"]) == (None, 6)


def test_files_stay_small_whatever_the_pages(spark, folder):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("http://a.b/").alias("url"), F.when(
        F.col("id") % 100 == 7, F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), 400_000))).otherwise(F.col("id").cast("string")).alias("html"))
    write_archives(pages.coalesce(1), folder, file_bytes=1 << 20)
    files = [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.startswith("part-")]
    assert max(map(os.path.getsize, files)) <= 8 * (1 << 20) + 401_000 and len(files) < 60
    assert read_archives(spark, folder, False).groupBy("type").count().collect().__len__() == 3
    assert read_archives(spark, folder, False).filter("type = 'response'").agg(F.sum("payload_bytes")).first()[0] == 30 * 400_000 + sum(len(str(k)) for k in range(3000))


def test_size_tiers():
    for mean, most in ((0.0, 0), (5.0, 100), (2000.0, 10**6), (10.0, 2**31)):
        tiers = size_tiers(mean, most)
        assert tiers[0][0] < 0 and tiers[-1][1] >= most and len(tiers) <= 6
        assert all(a[1] == b[0] and b[1] <= 8 * b[2] for a, b in zip(tiers, tiers[1:]))


def test_damaged_archives():
    for content in (b"junk", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort"):
        with pytest.raises(ValueError):
            list(read_records(content, "f", True))


def test_archives_are_plain_warc(spark, folder):
    write_archives(spark.createDataFrame([(1, "u://h/p", "body")], "page_id long, url string, html string"), f"{folder}/w")
    kinds = sorted(r["type"] for r in read_archives(spark, f"{folder}/w").collect())
    assert kinds == ["metadata", "request", "response"]


# vectors

def plain_near(rows, threshold=0.95):
    good = [(k, np.array(v, float)) for k, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    units = [v / np.linalg.norm(v) for v in (w / np.abs(w).max() for _, w in good)]
    close = [[j for j in range(len(good)) if j != i and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold] for i in range(len(good))]
    group = list(range(len(good)))
    for _ in good:
        for i, mates in enumerate(close):
            low = min([group[i], *(group[j] for j in mates)])
            for j in (i, *mates):
                group[j] = min(group[j], low)
    least = {}
    for i, (k, _) in enumerate(good):
        least[group[i]] = min(least.get(group[i], k), k)
    told = [(k, len(close[i]), least[group[i]], k == least[group[i]]) for i, (k, _) in enumerate(good)]
    return sorted(told + [(k, 0, k, True) for k, v in rows if not (v and None not in v and np.isfinite(v).all() and any(v))])


def vectors(seed=0):
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(16).tolist() for _ in range(120)]
    rows += [(np.array(rows[k % 7]) * 3 + rng.standard_normal(16) * 0.2).tolist() for k in range(90)]
    rows += [rows[0]] * 30 + [None, [], [0.0] * 16, [1.0, None], [float("nan")] * 2, [float("inf"), 1.0], [1.0], [2.0], [-1.0], [1e200] * 3, [1e-200] * 3]
    keys = rng.permutation(5000)[:len(rows)].tolist()
    return list(zip(keys, rows, strict=True))


def test_near_vectors(spark):
    rows = vectors()
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<double>, n_links int").repartition(4)
    assert sorted(map(tuple, near_vectors(df).collect())) == plain_near(rows)
    assert near_vectors(df.filter("false")).count() == 0
    odd = near_vectors(spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0]), (None, None)], "vec_id long, embedding array<float>")).collect()
    assert sorted(map(repr, map(tuple, odd))) == sorted(map(repr, [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, False)]))


def test_a_hot_bucket_is_cut_into_tiles(spark, monkeypatch):
    from millrace.llm import near_vectors as module
    monkeypatch.setattr(module, "TILE", 16)
    rng = np.random.default_rng(8)
    base = rng.standard_normal(12)
    rows = [(k, (base + rng.standard_normal(12) * 0.15).tolist()) for k in range(120)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted(map(tuple, got.collect())) == plain_near(rows)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    x, y = (unit(rng.standard_normal((400, 64))) for _ in range(2))
    y[:200] = unit(x[:200] + y[:200] * 0.3)
    assert (estimates(x, y, rotation(64, 20)) >= x @ y.T - 1e-5).all()


def test_near_query(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op4_embedding_near_dedup"](spark, SF).collect())) == plain_near(rows)


def plain_topk(rows, asked, k=5):
    def whole(v):
        return np.floor(np.array(v, float) * 256).astype(object) if v and None not in v and np.isfinite(v).all() else None
    docs = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    out = []
    for i, v in asked:
        if i is None or whole(v) is None:
            continue
        scores = sorted((-int(sum(int(a) * int(b) for a, b in zip(whole(v), w, strict=True))), j) for j, w in docs if j != i and len(w) == len(whole(v)))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def test_topk(spark, monkeypatch):
    from millrace.llm import topk as module
    monkeypatch.setattr(module, "BLOCK", 8)
    monkeypatch.setattr(module, "GROUP", 2)
    rows = [(k, v) for k, v in vectors(3) if not v or None in v or max(map(abs, v)) < 1e6 or not np.isfinite(v).all()] + [(6000, [1e5] * 16), (6001, [-1e5] * 16)]
    df = spark.createDataFrame([(k, v, 1) for k, v in rows] + [(None, [1.0], 1)], "vec_id long, embedding array<double>, score int")
    asked = df.filter("vec_id % 4 = 0")
    got = exact_topk(df, asked)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain_topk(rows, [x for x in rows if x[0] % 4 == 0])
    assert exact_topk(df, df.filter("false")).count() == 0 == exact_topk(df.filter("false"), asked).count()
    few = spark.createDataFrame([(1, [1.0]), (2, [1.0]), (3, [1.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, exact_topk(few, few.filter("vec_id = 2")).collect())) == [(2, 1, 1, 65536), (2, 2, 3, 65536)]


def test_topk_bounds():
    rng = np.random.default_rng(5)
    x, y = rng.standard_normal((30, 8)), rng.standard_normal((50, 8))
    assert (upper_bounds(x, y.max(axis=0, keepdims=True), y.min(axis=0, keepdims=True))[:, 0] >= (x @ y.T).max(axis=1) - 1e-9).all()


def test_topk_query(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op9_exact_topk"](spark, SF).collect())) == plain_topk(rows, [x for x in rows if x[0] % 50 == 0])
