"""Every operator of this package over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.chat import preference_pairs, swapped_replies
from millrace.llm.jaccard import jaccard_components
from millrace.llm.language import identify_languages, learn_languages
from millrace.llm.licences import scan_licences
from millrace.llm.middle import fill_in_middle, restored
from millrace.llm.mixing import domain_of_labels, mixing_rates
from millrace.llm.near_vectors import near_vectors
from millrace.llm.packing import pack_documents
from millrace.llm.rules import STOP_WORDS, judge_texts
from millrace.llm.topk import exact_topk
from millrace.llm.urls import judge_urls
from millrace.llm.warc import archived_captures
from millrace.llm.whitening import fit_whitening, whiten

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op6_ngram_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"))


TARGETS = {"good": 0.88, "low": 0.07, "toxic": 0.05}


@query()
def op2_mixing_rates(spark, sf_dir):
    """``doc_id, tokens, good, low, toxic, rate`` of every document."""
    labels = table(spark, sf_dir, "labels").withColumn("domain", domain_of_labels())
    rated = mixing_rates(table(spark, sf_dir, "documents"), labels, TARGETS)
    return rated.select("doc_id", "tokens", *[F.col("posteriors")[x].alias(x) for x in TARGETS], "rate")


@query()
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    found = identify_languages(docs, learn_languages(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query()
def op8_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@query("""
WITH u AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(h, p, rule, verdict) AS (VALUES ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
                                  ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')),
m AS (SELECT p.host, p.path, arg_max(r.rule, length(r.h) * 1000 + length(r.p)) AS rule, arg_max(r.verdict, length(r.h) * 1000 + length(r.p)) AS verdict
      FROM (SELECT DISTINCT host, path FROM p) p JOIN r ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p)
      GROUP BY 1, 2)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN m USING (host, path)""")
def op3_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM f)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN top END AS refers_to
FROM w""")
def op5_warc_captures(spark, sf_dir):
    captures = archived_captures(table(spark, sf_dir, "pages"), with_payload=False)
    return captures.select(
        F.col("metadata.page_id").alias("page_id"), F.col("capture.payload_bytes").alias("payload_bytes"),
        F.col("capture.payload_digest").alias("payload_digest"), F.col("capture.type").alias("record_type"),
        F.col("original.page_id").alias("refers_to"))


@query()
def op4_embedding_near_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query()
def op9_exact_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk(vectors, vectors.filter("vec_id % 50 = 0"))


@query()
def op10_licence_scan(spark, sf_dir):
    return scan_licences(table(spark, sf_dir, "documents"))


@query("""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
e AS (SELECT conv_id, max(turn) AS latest, max(CASE WHEN role = 'assistant' THEN turn END) AS reply FROM t GROUP BY 1),
l AS (SELECT conv_id, coalesce(reply, latest) AS last, reply FROM e),
s AS (SELECT t.conv_id, 'chosen' AS side, t.turn, t.role, t.text FROM t JOIN l USING (conv_id) WHERE t.turn <= l.last
      UNION ALL SELECT t.conv_id, 'rejected', t.turn, t.role, t.text FROM t JOIN l USING (conv_id) WHERE t.turn < l.last
      UNION ALL SELECT l.conv_id, 'rejected', l.last, 'assistant', o.text
                FROM l JOIN l p ON p.conv_id = xor(l.conv_id, 1) AND p.reply IS NOT NULL
                JOIN (SELECT conv_id, turn, max(text) AS text FROM t WHERE role = 'assistant' GROUP BY 1, 2) o
                  ON o.conv_id = p.conv_id AND o.turn = p.reply),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, side ORDER BY turn, role, text) AS k FROM s),
d AS (SELECT conv_id, min(k) - 1 AS common FROM (
        SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.k, r.k) AS k
        FROM (SELECT * FROM n WHERE side = 'chosen') c FULL JOIN (SELECT * FROM n WHERE side = 'rejected') r
          ON c.conv_id = r.conv_id AND c.k = r.k
        WHERE c.text IS DISTINCT FROM r.text OR c.role IS DISTINCT FROM r.role) GROUP BY 1),
m AS (SELECT n.*, coalesce(d.common, max(n.k) OVER (PARTITION BY n.conv_id)) AS common FROM n LEFT JOIN d USING (conv_id)),
f AS (SELECT *, '<|' || role || '|>' || chr(10) AS head, text || '<|end|>' || chr(10) AS body FROM m),
g AS (SELECT *, sum(CASE WHEN k > common THEN length(head) + length(body) ELSE 0 END)
                  OVER (PARTITION BY conv_id, side ORDER BY k) - length(body) AS start FROM f)
SELECT conv_id, any_value(common)::INT AS common_turns,
       coalesce(string_agg(head || body, '' ORDER BY k) FILTER (side = 'chosen' AND k <= common), '') AS prompt,
       coalesce(string_agg(head || body, '' ORDER BY k) FILTER (side = 'chosen' AND k > common), '') AS chosen,
       coalesce(string_agg(head || body, '' ORDER BY k) FILTER (side = 'rejected' AND k > common), '') AS rejected,
       coalesce(string_agg(start || '+' || length(body), ' ' ORDER BY k) FILTER (side = 'chosen' AND k > common AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg(start || '+' || length(body), ' ' ORDER BY k) FILTER (side = 'rejected' AND k > common AND role = 'assistant'), '') AS rejected_mask
FROM g GROUP BY conv_id""")
def op1_preference_chat(spark, sf_dir):
    """Masks as text, ``start+length`` of each span."""
    pairs = preference_pairs(swapped_replies(table(spark, sf_dir, "conversations")).withColumnRenamed("conv_id", "pair_id"))

    def told(mask):
        return F.array_join(F.transform(mask, lambda x: F.concat(x["start"].cast("string"), F.lit("+"), x["length"].cast("string"))), " ")

    return pairs.withColumnRenamed("pair_id", "conv_id").withColumns({x: told(F.col(x)) for x in ("chosen_mask", "rejected_mask")})


@query(r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
                  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t FROM documents),
n AS (SELECT *, len(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
             ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                  WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, array_to_string(t[1:a], '') AS pre, array_to_string(t[a + 1:b], '') AS mid, array_to_string(t[b + 1:n], '') AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p""")
def op11_fill_in_middle(spark, sf_dir):
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    digests = {"output_sha256": F.col("output"), "restored_sha256": restored(F.col("output"), F.col("form"))}
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *[F.sha2(x, 256).alias(name) for name, x in digests.items()])


@query()
def op12_embedding_whitening(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return whiten(vectors, fit_whitening(vectors)).withColumn("deviation", F.col("deviation").try_cast("long"))


@query(r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
u AS (SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS x FROM d),
i AS (SELECT doc_id, i, concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS key, lead(x, 4) OVER o AS last
      FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
k AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, key) AS c FROM i WHERE last IS NOT NULL),
r AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM k CROSS JOIN range(0, 5) AS o(o) WHERE c > 1 GROUP BY 1),
m AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
             len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
             len(list_filter(w, lambda x: x IN ({forms}))) AS n_stop_words
      FROM d LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT *, NOT (base_failed OR n_words > 1000000 OR 100 * word_chars < 200 * n_words OR 100 * word_chars > 1500 * n_words OR 100 * n_symbols > 100 * n_words
               OR (n_words >= 50 AND 100 * n_stop_words < n_words) OR 100 * n_dup_lines > 50 * n_lines) AS kept
FROM b""".replace("{forms}", ", ".join(f"'{form}'" for x in STOP_WORDS for form in (x, x.capitalize(), x.upper()))))
def op13_quality_rules(spark, sf_dir):
    return judge_texts(table(spark, sf_dir, "documents")).drop("failed")
