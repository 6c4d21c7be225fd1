"""One query for each operator, over whole tables, and its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.llm import audio, byte_bpe, chat_format, decontamination, hard_negatives, language_id, pii, prefix_trie, quality_rules, sentence_dedup, simhash, substring_dedup, token_counts
from reelspark.llm.common import checkpoint, table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat_format.read_back(chat_format.format_turns(chat_format.canonical_turns(rows)))


#: Stands for a secret that a real run takes from its environment.
PII_KEY = "a key for tests"


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, PII_KEY)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    with substring_dedup.repeats_removed(table(spark, sf_dir, "documents")) as done:
        return checkpoint(substring_dedup.digests(done))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"))


def op7_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def _held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(~_held_out()))
    return language_id.identify(docs, model).select("doc_id", _held_out().alias("held_out"), "lang_pred", "score", F.transform("mixture", lambda x: x["lang"]).alias("languages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digests(decontamination.hit_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"), "embedding")
    return hard_negatives.mine(rows, anchors=F.col("vec_id") % 50 == 0)


def op12_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.digests(audio.features(audio.encode(audio.text_payload(table(spark, sf_dir, "documents")))))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    with prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns)) as nodes:
        return checkpoint(nodes)


_OP6 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), g AS (
  SELECT r, p, array_to_string(ws[p:p + 7], ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS p FROM w WHERE len(ws) >= 8)
), hit AS (
  SELECT DISTINCT r, q FROM (
    SELECT r, unnest(range(p, p + 8)) AS q
    FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1)
), s AS (
  SELECT w.r, doc_id, source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(h.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN (SELECT r, count(*) AS n FROM hit GROUP BY r) h ON h.r = w.r
), f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s
), hosts AS (
  SELECT source, count(*) AS n, sum(base_failed::BIGINT)::BIGINT AS k FROM f WHERE source IS NOT NULL GROUP BY source
), prior AS (
  SELECT sum(k)::DOUBLE / sum(n) AS m, var_pop(k::DOUBLE / n) AS v FROM hosts
), strength AS (
  SELECT m, CASE WHEN v > 0 THEN greatest(m * (1 - m) / v - 1, 1.0) ELSE 1.0 END AS a FROM prior
), verdict AS (
  SELECT source, (k + a * m) / (n + a) > 0.5 AS failed FROM hosts, strength
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(failed, false) AS kept
FROM f LEFT JOIN verdict USING (source)
"""

_OP10 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), i AS (
  SELECT item_id::VARCHAR AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, m, array_to_string(ws[p:p + m - 1], ' ') AS g
  FROM (SELECT item_id, ws, least(len(ws), 10) AS m, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS p FROM i WHERE len(ws) > 0)
), dw AS (
  SELECT r, p, m, array_to_string(ws[p:p + m - 1], ' ') AS g
  FROM (SELECT r, ws, m, unnest(range(1, len(ws) - m + 2)) AS p FROM d, (SELECT DISTINCT m FROM iw) WHERE len(ws) >= m)
), hit AS (
  SELECT r, p, dw.m, item_id FROM dw JOIN iw ON dw.m = iw.m AND dw.g = iw.g
), words AS (
  SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + m)) AS q FROM hit) GROUP BY r
), items AS (
  SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.r = d.r LEFT JOIN items ON items.r = d.r
"""

_OP11 = """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INT AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 3
"""

_OP13 = """
WITH c AS (
  SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce("text", '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce("text", ''))) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT c, t, xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END)) % 9 AS h
  FROM c
), r AS (
  SELECT h.c, list_concat(coalesce(g.t, [])[1:h.h], h.t[h.h + 1:]) AS t FROM h LEFT JOIN c g ON g.c = h.c - h.c % 5
), m AS (
  SELECT c, len(t) = d AS ended, d, t[1:d] AS p FROM (SELECT c, t, unnest(range(0, len(t) + 1)) AS d FROM r)
), n AS (
  SELECT p, d, min(c) AS c, count(*) AS n, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ended), '')) AS ends, CASE WHEN d > 0 THEN (count(*) - 1) * strlen(p[d].text) ELSE 0 END AS own
  FROM m GROUP BY p, d
), k AS (
  SELECT a.p, a.d, a.c, a.n, a.ends, a.own, b.c AS parent FROM n a LEFT JOIN n b ON b.d = a.d - 1 AND b.p = a.p[1:a.d - 1]
), f AS (
  SELECT d - 1 AS d, parent AS c, count(*) AS n FROM k WHERE d > 0 GROUP BY d, parent
), x AS (
  SELECT k.*, coalesce(f.n, 0) AS children FROM k LEFT JOIN f ON f.d = k.d AND f.c = k.c
), u AS (
  SELECT p[1:e] AS p, sum((children = 0)::BIGINT) AS leaves, sum(own) AS saved FROM (SELECT p, children, own, unnest(range(0, d + 1)) AS e FROM x) GROUP BY p[1:e]
)
SELECT x.c AS conv_id, x.d AS depth, x.parent AS parent_conv_id, x.n AS n_convs, x.children AS n_children, u.leaves::BIGINT AS n_leaves, u.saved::BIGINT AS saved_tokens, x.ends AS ends_sha256
FROM x JOIN u ON u.p = x.p
"""

QUERIES = {f.__name__: f for f in (op1_token_counts, op2_byte_bpe, op3_chat_format, op4_pii, op5_substring_dedup, op6_quality_rules, op7_sentence_dedup, op8_language_id, op9_simhash, op10_decontamination, op11_hard_negatives, op12_audio_features, op13_prefix_trie)}
ORACLES: dict[str, str] = {"op6_quality_rules": _OP6, "op10_decontamination": _OP10, "op11_hard_negatives": _OP11, "op13_prefix_trie": _OP13}
