"""The registered queries of the numbered operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.llm import (chunk_bpe, embedding_dedup, line_dedup, ngram_join, packing, pu_quality, quality_rules,
                         token_counts, toxicity, turn_repair, url_filter, warc, whitening)
from logtide.llm.common import fold, table
from logtide.session import scratch_path


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = pu_quality.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return pu_quality.pu_quality(docs, model).withColumn("held_out", fold("doc_id", 4) == 2)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.quality_rules(docs, model)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = toxicity.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return toxicity.toxicity(docs, net).withColumn("held_out", fold("doc_id", 3) == 1)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; the same on every machine of the cluster."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of its own, so that each run counts every distinct text
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                     scratch_path(spark, "token-cache"), limit=512)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(table(spark, sf_dir, "pages"))
    return back.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                       "record_type", F.col("refers_to").cast("long").alias("refers_to"))


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND last <> page_id THEN last END AS refers_to
FROM r
"""


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_links(table(spark, sf_dir, "embeddings"), threshold=0.95)


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id AS node, vec_id AS low FROM embeddings
  UNION
  SELECT links.b, reach.low FROM reach JOIN links ON links.a = reach.node),
lows AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(degree.n, 0) AS n_links, lows.component_id, e.vec_id = lows.component_id AS kept
FROM embeddings e JOIN lows ON lows.node = e.vec_id LEFT JOIN degree ON degree.a = e.vec_id
"""


def op8_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = chunk_bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return made.select("doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), limit=2048, end_id=0)


# The rules the query judges by.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


OP10_SQL = r"""
WITH parts AS (
  SELECT page_id, url,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
hp AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         list_filter(string_split(coalesce(CASE WHEN instr(split_part(url, '#', 1), '?') > 0
             THEN substr(split_part(url, '#', 1), instr(split_part(url, '#', 1), '?') + 1) END, ''), '&'),
             lambda p: p <> '') AS params
  FROM parts),
canon AS (
  SELECT *, CASE WHEN host <> '' THEN host || regexp_replace(regexp_replace(path, '\.html$', ''), '/+$', '')
      || CASE WHEN len(list_filter(params, lambda p: NOT regexp_matches(p, '^(utm_[a-z]+|ref)='))) > 0
              THEN '?' || array_to_string(list_sort(list_filter(params,
                   lambda p: NOT regexp_matches(p, '^(utm_[a-z]+|ref)='))), '&') ELSE '' END END AS canonical
  FROM hp),
listed AS (
  SELECT DISTINCT canonical FROM canon
  WHERE len(list_filter(params, lambda p: regexp_matches(p, '^(utm_[a-z]+|ref)='))) > 0 AND canonical IS NOT NULL),
ruled AS (
  SELECT canon.*, listed.canonical IS NOT NULL AS listed,
    CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/')
              THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM canon LEFT JOIN listed USING (canonical))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict,
       canonical, listed
FROM ruled
"""


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4, grid=256)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), least_chars=20, least_docs=3)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP12_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
spread AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT keyed.*, spread.keeper IS NOT NULL AND spread.keeper <> doc_id AS gone FROM keyed LEFT JOIN spread USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turn_repair.damaged(table(spark, sf_dir, "conversations"))
    return turn_repair.repair_report(rows, alive=F.col("alive"))


# The CRC is folded byte by byte; the repair is a recursion from a conversation's last row to its first that carries,
# for each state of the role grammar (0 nothing yet, 1 a system turn, 2 a user turn, 3 an assistant turn), the least
# (cost, audit) with its turns. No cheapest repair inserts more than two turns in a row.
OP13_SQL = r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
fated AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda ch: ascii(ch)::BIGINT)),
      lambda acc, b: list_reduce([xor(acc, b), 1, 1, 1, 1, 1, 1, 1, 1],
                                 lambda c, one: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 20 AS fate FROM named),
shaped AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(text, '.!?', '') ELSE text END AS text, fate
  FROM fated WHERE fate <> 0),
alive AS (SELECT * FROM shaped UNION ALL SELECT * FROM shaped WHERE fate = 3),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM alive),
copied AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS copy FROM placed),
judged AS (
  SELECT *, substr(role, 1, 1) AS c,
         CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN copy > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' END AS fault FROM copied),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND substr(before, 1, 1) || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
best AS (
  SELECT conv_id, n + 1 AS i,
         {'c': 0, 'w': '', 'o': []::VARCHAR[]} AS v0, {'c': 4, 'w': 'II', 'o': ['user:', 'assistant:']} AS v1,
         {'c': 2, 'w': 'I', 'o': ['assistant:']} AS v2, {'c': 0, 'w': '', 'o': []::VARCHAR[]} AS v3 FROM counted
  UNION ALL
  SELECT conv_id, i,
    list_min([b0, {'c': b2.c + 2, 'w': 'I' || b2.w, 'o': list_prepend('user:', b2.o)},
              {'c': b3.c + 4, 'w': 'II' || b3.w, 'o': list_concat(['user:', 'assistant:'], b3.o)}]),
    list_min([b1, {'c': b2.c + 2, 'w': 'I' || b2.w, 'o': list_prepend('user:', b2.o)},
              {'c': b3.c + 4, 'w': 'II' || b3.w, 'o': list_concat(['user:', 'assistant:'], b3.o)}]),
    list_min([b2, {'c': b3.c + 2, 'w': 'I' || b3.w, 'o': list_prepend('assistant:', b3.o)}]),
    list_min([b3, {'c': b2.c + 2, 'w': 'I' || b2.w, 'o': list_prepend('user:', b2.o)}])
  FROM (
    SELECT j.conv_id, j.i,
      list_min([{'c': v0.c + 3, 'w': 'D' || v0.w, 'o': v0.o},
                {'c': u.c, 'w': u.w, 'o': u.o},
                CASE WHEN j.c = 's' THEN {'c': v1.c + stays, 'w': 'K' || v1.w, 'o': list_prepend(line, v1.o)}
                     ELSE {'c': u.c, 'w': u.w, 'o': u.o} END]) AS b0,
      list_min([{'c': v1.c + 3, 'w': 'D' || v1.w, 'o': v1.o}, u]) AS b1,
      list_min([{'c': v2.c + 3, 'w': 'D' || v2.w, 'o': v2.o}, a]) AS b2,
      list_min([{'c': v3.c + 3, 'w': 'D' || v3.w, 'o': v3.o}, u]) AS b3
    FROM (
      SELECT j.*, v0, v1, v2, v3, role || ':' || text AS line,
        CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 WHEN fault = 'truncated' THEN 1 ELSE 0 END AS stays,
        CASE WHEN j.c = 'u' THEN {'c': v2.c + stays, 'w': 'K' || v2.w, 'o': list_prepend(role || ':' || text, v2.o)}
             ELSE {'c': v2.c + stays + 2, 'w': 'R' || v2.w, 'o': list_prepend('user:' || text, v2.o)} END AS u,
        CASE WHEN j.c = 'a' THEN {'c': v3.c + stays, 'w': 'K' || v3.w, 'o': list_prepend(role || ':' || text, v3.o)}
             ELSE {'c': v3.c + stays + 2, 'w': 'R' || v3.w, 'o': list_prepend('assistant:' || text, v3.o)} END AS a
      FROM best JOIN judged j ON j.conv_id IS NOT DISTINCT FROM best.conv_id AND j.i = best.i - 1) j))
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v0.c, 0)::BIGINT AS cost,
       coalesce(v0.w, '') AS audit, sha256(coalesce(array_to_string(v0.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN (SELECT * FROM best WHERE i = 1) b ON b.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


def queries() -> dict:
    return {f.__name__: f for f in (op1_pu_quality, op2_quality_rules, op3_toxicity, op4_ngram_join, op5_token_counts,
                                    op6_warc, op7_embedding_dedup, op8_chunk_bpe, op9_packing, op10_url_filter,
                                    op11_whitening, op12_line_dedup, op13_turn_repair)}


def oracle_sql() -> dict[str, str]:
    return {"op6_warc": OP6_SQL, "op7_embedding_dedup": OP7_SQL, "op10_url_filter": OP10_SQL,
            "op12_line_dedup": OP12_SQL, "op13_turn_repair": OP13_SQL}
