"""The registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import hmm, merkle, mixing, neardup, packing, pages, phrases, quality, srs, tokens, toxicity, urls, vafile
from .common import held_out, read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = held_out(3, 1)
    model = toxicity.fit_labels(docs, read(spark, sf_dir, "labels"), ~out)
    return toxicity.score(docs, model).select("doc_id", out.alias("held_out"), "score",
                                              (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return vafile.search(rows, rows.where(F.col("vec_id") % 100 == 0))


def op3_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = held_out(5, 0)
    model = quality.fit_labels(docs, read(spark, sf_dir, "labels"), ~out)
    return quality.score(docs, model).select("doc_id", out.alias("held_out"), "score",
                                             (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_url_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op5_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_page_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(read(spark, sf_dir, "pages"))


def op8_stable_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return srs.search(rows, rows.where(F.col("vec_id") % 100 == 0))


def op9_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return tokens.section_token_counts(read(spark, sf_dir, "documents"),
                                       public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048, 0)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(merkle.manifest(read(spark, sf_dir, "documents"), merkle.id_hit(7)))


def op12_setm_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op13_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_texts(read(spark, sf_dir, "documents"), held_out(10, 0))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_va_file, op3_rule_quality, op4_url_segments, op5_weighted_minhash, op6_mixing, op7_page_differences, op8_stable_projections, op9_token_attribution,
    op10_pattern_packing, op11_merkle_manifest, op12_setm_phrases, op13_hidden_markov)}
#: Integer scores and id ties are exact in SQL.
ORACLES = {
    "op2_va_file": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
""",
    # crc32 is spelled out bit by bit (polynomial 0xEDB88320); nodes are made level by level
    "op11_merkle_manifest": """
WITH RECURSIVE f AS (
  SELECT doc_id, lang, n_chars, doc_id::VARCHAR AS i, text AS t,
         coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-')
         || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
         || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-') AS head,
         coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS c,
         coalesce(strlen((n_chars + 1)::VARCHAR)::VARCHAR || ':' || (n_chars + 1)::VARCHAR, '-') AS c1,
         coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS tail
  FROM documents),
crc AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(i, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295) % 7 = 0 AS hit FROM f),
base AS (
  SELECT doc_id, lang, sha256(head || c || tail) AS leaf,
         CASE WHEN hit THEN sha256(head || c1 || tail) ELSE sha256(head || c || tail) END AS changed FROM crc),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT lang FROM base)),
placed AS (
  SELECT b.*, l.g, row_number() OVER (PARTITION BY l.g ORDER BY b.doc_id NULLS FIRST, b.leaf) - 1 AS pos,
         row_number() OVER () AS k
  FROM base b JOIN langs l ON b.lang IS NOT DISTINCT FROM l.lang),
nodes AS (
  SELECT g, 0 AS height, pos, leaf AS h FROM placed
  UNION ALL
  SELECT g, height + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM nodes) WHERE c > 1 GROUP BY g, height, pos // 2),
subroots AS (SELECT g, max(height) AS top, arg_max(h, height) AS subroot FROM nodes GROUP BY g),
above AS (
  SELECT 0 AS height, g AS pos, subroot AS h FROM subroots
  UNION ALL
  SELECT height + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS c FROM above) WHERE c > 1 GROUP BY height, pos // 2),
root AS (SELECT max(height) AS top, arg_max(h, height) AS root FROM above),
folded AS (
  SELECT p.k, p.g, p.pos, 0 AS height, s.top, p.changed AS h FROM placed p JOIN subroots s USING (g)
  UNION ALL
  SELECT f.k, f.g, f.pos // 2, f.height + 1, f.top,
         CASE WHEN n.h IS NULL THEN sha256(f.h) WHEN f.pos % 2 = 0 THEN sha256(f.h || n.h) ELSE sha256(n.h || f.h) END
  FROM folded f LEFT JOIN nodes n ON n.g = f.g AND n.height = f.height AND n.pos = xor(f.pos, 1)
  WHERE f.height < f.top),
folded_sub AS (SELECT k, g, arg_max(h, height) AS h FROM folded GROUP BY k, g),
lifted AS (
  SELECT k, g AS pos, 0 AS height, h FROM folded_sub
  UNION ALL
  SELECT f.k, f.pos // 2, f.height + 1,
         CASE WHEN n.h IS NULL THEN sha256(f.h) WHEN f.pos % 2 = 0 THEN sha256(f.h || n.h) ELSE sha256(n.h || f.h) END
  FROM lifted f LEFT JOIN above n ON n.height = f.height AND n.pos = xor(f.pos, 1)
  WHERE f.height < (SELECT top FROM root)),
folded_all AS (SELECT k, arg_max(h, height) AS folded_root FROM lifted GROUP BY k),
siblings AS (
  SELECT p.k, n.height, n.h FROM placed p JOIN nodes n ON n.g = p.g AND n.pos = xor(p.pos >> n.height, 1)
  UNION ALL
  SELECT p.k, 1000 + n.height, n.h FROM placed p JOIN above n ON n.pos = xor(p.g >> n.height, 1)),
proofs AS (SELECT k, sha256(string_agg(h, '' ORDER BY height)) AS proof_sha256 FROM siblings GROUP BY k)
SELECT p.doc_id, p.leaf, s.subroot, r.root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, a.folded_root,
       a.folded_root = r.root AS verified
FROM placed p JOIN subroots s USING (g) JOIN folded_all a USING (k) LEFT JOIN proofs q USING (k), root r
""",
    "op12_setm_phrases": """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
f AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, 1 AS k, unnest(ws) AS phrase FROM w
    UNION ALL
    SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
    UNION ALL
    SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))
    FROM w) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 10),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, c.cut, h.f AS l, t.f AS r,
         CAST((1000000::HUGEINT * c.f * c.f) // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(c.ws[:c.cut], ' ')
  JOIN f t ON t.lang = c.lang AND t.phrase = array_to_string(c.ws[c.cut + 1:], ' ')),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS phrase FROM c WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longer x ON x.lang = b.lang AND x.phrase = b.phrase
  WHERE x.f IS NULL OR 100 * x.f < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
""",
}
