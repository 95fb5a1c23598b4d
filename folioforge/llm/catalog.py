"""The registered queries of the operators: production parameters over whole tables."""

from __future__ import annotations

import zlib
from functools import cache

from pyspark.sql import functions as F

from folioforge.llm import bpe, chat, decontaminate, licenses, linededup, lm, media, quality, ranking, runs, simhash, urls, warc
from folioforge.llm.common import documents

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return keep


@cache
def tokenizer_path() -> str:
    """Where this installation has the public word-end BPE vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_bpe")
def op1_bpe(spark, sf_dir):
    return bpe.encode_decode(documents(spark, sf_dir), tokenizer_path(), keep_ids=False, keep_decoded=False)


#: CRC-32 of the id's digits, bit by bit.
CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substring(doc_id::VARCHAR, i, 1))::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda k, z: xor(k >> 1, CASE WHEN k & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))))"""
LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP2_SQL = rf"""
WITH docs AS (SELECT doc_id, {CRC_SQL} % 7 = 2 AS held_out, list_append(regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '[^ 	

]+'), NULL) AS w FROM documents),
tokens AS (SELECT doc_id, held_out, i, w[i] AS w, i = len(w) AS is_end, CASE WHEN i = 1 THEN NULL ELSE w[i - 1] END AS h, i = 1 AS is_first FROM (SELECT doc_id, held_out, w, unnest(range(1, len(w) + 1)) AS i FROM docs)),
words AS (SELECT w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY w),
sizes AS (SELECT sum(c) AS n, count(*) AS v, (SELECT count(*) FROM docs WHERE NOT held_out) AS starts FROM words),
pairs AS (SELECT h, w, is_first, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY h, w, is_first),
known AS (SELECT t.doc_id, t.held_out, coalesce(a.c, 0) AS c, coalesce(p.c, 0) AS cp, CASE WHEN t.is_first THEN starts ELSE coalesce(b.c, 0) END AS ch, n, v
  FROM tokens t CROSS JOIN sizes LEFT JOIN words a ON a.w IS NOT DISTINCT FROM t.w LEFT JOIN words b ON b.w IS NOT DISTINCT FROM t.h
  LEFT JOIN pairs p ON p.h IS NOT DISTINCT FROM t.h AND p.w IS NOT DISTINCT FROM t.w AND p.is_first = t.is_first)
SELECT doc_id, held_out, count(*)::BIGINT AS n_tokens, count(*) FILTER (c > 0)::BIGINT AS n_known, max(n)::BIGINT AS train_tokens,
  round(sum(log10((c + 1) / (n + v + 1))), 6) AS base_score, round(sum(log10((cp + {lm.MASS} * (c + 1) / (n + v + 1)) / (ch + {lm.MASS}))), 6) AS score
FROM known GROUP BY doc_id, held_out
"""


@query("op2_lm", OP2_SQL)
def op2_lm(spark, sf_dir):
    scores = lm.score_texts(documents(spark, sf_dir))
    return scores.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


@query("op5_simhash")
def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line, lower_az(line) AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
owners AS (SELECT key, min(doc_id) AS owner, count(DISTINCT doc_id) AS n FROM lines WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT lines.*, coalesce(n >= 2 AND owner <> doc_id, false) AS gone FROM lines LEFT JOIN owners USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""".replace("lower_az(line)", "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


@query("op6_line_dedup", OP6_SQL)
def op6_line_dedup(spark, sf_dir):
    return linededup.dedup_lines(documents(spark, sf_dir), keep=False)


@query("op3_licenses")
def op3_licenses(spark, sf_dir):
    return licenses.scan_licenses(documents(spark, sf_dir)).drop("spans")


@query("op4_urls")
def op4_urls(spark, sf_dir):
    return urls.filter_urls(documents(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


OP7_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
marked AS (
  SELECT *, regexp_matches(role || chr(0) || text, '<s>|</s>|\[INST\]|\[/INST\]') AS escaped FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(21 + length(role) + length(text) + CASE WHEN escaped THEN length(role || text) - length(translate(role || text, '~<[', '')) ELSE 0 END)::BIGINT AS formatted_chars, true AS identical
FROM marked GROUP BY conv_id
"""


@query("op7_chat", OP7_SQL)
def op7_chat(spark, sf_dir):
    conversations = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text")) for i, r in enumerate(("user", "assistant"))))).alias("r")).select("r.*")
    return chat.digests(chat.format_conversations(conversations.unionByName(more)))


@query("op8_media")
def op8_media(spark, sf_dir):
    return media.media_columns(documents(spark, sf_dir), keep=False)


@query("op9_decontamination")
def op9_decontamination(spark, sf_dir):
    return decontaminate.find_leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


@query("op10_quality")
def op10_quality(spark, sf_dir):
    return quality.score_quality(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, in every tenth document periodic from some word on."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    first = h // 10 % n
    period = 1 + (n - first) // (3 + h // 10 % 8)
    return words[:first] + [words[first + i % period] for i in range(n - first)]


@query("op11_runs")
def op11_runs(spark, sf_dir):
    return runs.periodic_runs(documents(spark, sf_dir), edit=planted_period, keep=False)


OP12_SQL = r"""
WITH bags AS (SELECT doc_id, regexp_extract_all(lower_az(coalesce(text, '')), '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+') AS w FROM documents),
docs AS (SELECT row_number() OVER () AS d, doc_id, w, len(w)::BIGINT AS n FROM bags WHERE len(w) > 0),
sizes AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
postings AS (SELECT d, doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT d, doc_id, n, unnest(w) AS t FROM docs) GROUP BY d, doc_id, n, t),
weights AS (SELECT t, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM postings CROSS JOIN sizes GROUP BY t, n_docs),
wanted AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all(lower_az(coalesce(text, '')), '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS t FROM benchmark),
scores AS (SELECT item_id, text, d, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM wanted JOIN postings USING (t) JOIN weights USING (t) CROSS JOIN sizes GROUP BY item_id, text, d, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 10
""".replace("lower_az(coalesce(text, ''))", LOWER_SQL.format("coalesce(text, '')")).replace("\\\\", "\\")


@query("op12_ranking", OP12_SQL)
def op12_ranking(spark, sf_dir):
    return ranking.rank_documents(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


#: SHA-1 digests as base32: 160 bits by five; DuckDB has the digest in hexadecimal.
OP13_SQL = """
WITH digests AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
bits AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: ('0b' || lpad(bin(strpos('0123456789abcdef', h[i]) - 1), 4, '0'))[3:]), '') AS b FROM digests),
named AS (SELECT page_id, payload_bytes, html, array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(range(1, 6), lambda k: b[5 * i + k]::BIGINT << (5 - k)))::BIGINT]), '') AS payload_digest FROM bits),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first, row_number() OVER (PARTITION BY html ORDER BY page_id) AS nth FROM named)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN nth > 1 THEN first END AS refers_to FROM firsts
"""


@query("op13_warc", OP13_SQL)
def op13_warc(spark, sf_dir):
    return warc.archive_pages(documents(spark, sf_dir, "pages")).select(F.col("key").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")
