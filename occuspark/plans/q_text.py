"""Queries for retrieval and text matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import pruned as PR
from ..operators import retrieval as RT
from .registry import query

TOK = TX.sql_tokenize
# Source-type intent rules for the driver corpus (terms that occur in it).
INTENT_RULES = [("src1", ["der", "die"]), ("src2", ["que", "la"]), ("src3", ["ci", "tion"])]

CORPUS_SQL = f"""
docs AS (SELECT doc_id, source AS source_type, lang || ' ' || source AS title, text FROM documents),
dt AS (SELECT doc_id, source_type, title, {TOK("title || ' ' || text")} AS tokens FROM docs),
dl AS (SELECT doc_id, greatest(1, len(tokens)) AS doc_len FROM dt),
stats AS (SELECT count(*) AS n_docs, avg(doc_len) AS avg_len FROM dl),
post AS (SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM dt) GROUP BY ALL),
dfq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
q AS (SELECT item_id AS query_id, text FROM benchmark),
qt AS (SELECT query_id, term, count(*) AS qw FROM (SELECT query_id, unnest({TOK("text")}) AS term FROM q) GROUP BY ALL),
bm AS (SELECT qt.query_id, p.doc_id,
         sum(ln(1.0 + (s.n_docs - d.df + 0.5) / (d.df + 0.5)) * ((p.tf * 2.2) / (p.tf + 1.2 * (0.25 + 0.75 * l.doc_len / s.avg_len))) * qt.qw) AS bm25,
         list_sort(list(qt.term)) AS matched_terms
       FROM qt JOIN post p USING (term) JOIN dfq d USING (term) JOIN dl l USING (doc_id) CROSS JOIN stats s GROUP BY ALL),
tb AS (SELECT bm.*, dt.source_type, dt.title, list_distinct({TOK("q.text")}) AS qset,
         len(list_intersect(list_distinct({TOK("q.text")}), list_distinct({TOK("dt.title")}))) AS title_overlap
       FROM bm JOIN q USING (query_id) JOIN dt USING (doc_id)),
ib AS (SELECT *, bm25 + 1.5 * title_overlap AS tscore,
         {" + ".join(f"CASE WHEN source_type = '{st}' AND list_has_any(qset, {terms}) THEN 3.0 ELSE 0.0 END" for st, terms in INTENT_RULES)} AS intent_boost
       FROM tb),
sc AS (SELECT *, tscore + intent_boost AS score FROM ib),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 4) DESC, source_type, title, doc_id) AS rank
        FROM sc) WHERE rank <= 6),
rel AS (SELECT DISTINCT item_id AS query_id, doc_id FROM benchmark b JOIN documents d ON position(b.text IN d.text) > 0),
ranks AS (SELECT q.query_id, coalesce(h.r, 0) AS relevant_rank FROM q LEFT JOIN (
          SELECT query_id, min(rank) AS r FROM top JOIN rel USING (query_id, doc_id) GROUP BY query_id) h USING (query_id)),
ev AS (SELECT query_id, relevant_rank, CAST(relevant_rank = 1 AS INTEGER) AS hit_at_1,
         CAST(relevant_rank > 0 AND relevant_rank <= 3 AS INTEGER) AS hit_at_3,
         CAST(relevant_rank > 0 AND relevant_rank <= 6 AS INTEGER) AS hit_at_6,
         CASE WHEN relevant_rank > 0 THEN 1.0 / relevant_rank ELSE 0.0 END AS reciprocal_rank FROM ranks)"""


def _w(sql):
    return f"WITH {CORPUS_SQL}\n{sql}"


def corpus(c):
    d = c.t("documents")
    return d.select("doc_id", F.col("source").alias("source_type"),
                    F.concat_ws(" ", "lang", "source").alias("title"), "text")


def bench_queries(c):
    return c.t("benchmark").select(F.col("item_id").alias("query_id"), "text")


def _dt(c):
    return c._memo("doc_tokens", lambda: RT.doc_tokens(corpus(c)))


def _post(c):
    return c._memo("postings", lambda: RT.postings(RT.doc_terms(corpus(c))))


def _query_post(c):
    """Postings of the benchmark's terms, from one pass over the texts."""
    return c._memo("query_postings", lambda: RT.vocabulary_postings(corpus(c), RT.query_terms(bench_queries(c))))


def _query_dt(c):
    return c._memo("query_doc_lengths", lambda: RT.doc_lengths(corpus(c), _query_post(c)))


def _bm25(c):
    return c._memo("bm25", lambda: RT.bm25(_query_dt(c), _query_post(c), bench_queries(c)))


def _scored(c):
    def build():
        tb = RT.title_boost(_bm25(c), corpus(c), bench_queries(c))
        return RT.intent_boost(tb, INTENT_RULES)
    return c._memo("scored", build)


def _search(c):
    return c._memo("search", lambda: PR.Search(corpus(c), bench_queries(c), INTENT_RULES, 6))


def _ranks(c):
    post = _search(c).post.withColumnRenamed("doc", "doc_id")  # of all terms of the passages
    rel = RT.contains_relevance(corpus(c), bench_queries(c), post)
    return RT.eval_ranks(_search(c).top(), rel, bench_queries(c))


@query("fn_tokenize", f"""
SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct FROM (SELECT doc_id, {TOK("text")} AS t FROM documents)""")
def fn_tokenize(c):
    t = TX.tokenize(F.col("text"))
    return c.t("documents").select("doc_id", F.size(t).alias("n_tokens"), F.size(F.array_distinct(t)).alias("n_distinct"))


@query("tx_corpus_stats", _w("SELECT term, df, n_docs, avg_len FROM dfq CROSS JOIN stats"))
def tx_corpus_stats(c):
    return RT.doc_freq(_post(c)).crossJoin(F.broadcast(RT.corpus_stats(_dt(c))))  # one-row statistics


@query("tx_bm25", _w("SELECT query_id, doc_id, bm25, len(matched_terms) AS n_matched FROM bm"))
def tx_bm25(c):
    return _bm25(c).select("query_id", "doc_id", "bm25", "n_matched")


@query("tx_title_boost", _w("SELECT query_id, doc_id, title_overlap, bm25 + 1.5 * title_overlap AS score FROM tb"))
def tx_title_boost(c):
    return RT.title_boost(_bm25(c), corpus(c), bench_queries(c)).select("query_id", "doc_id", "title_overlap", "score")


@query("tx_intent_boost", _w("SELECT query_id, doc_id, intent_boost, score FROM sc"))
def tx_intent_boost(c):
    return _scored(c).select("query_id", "doc_id", "intent_boost", "score")


@query("tx_topk", _w("SELECT query_id, rank, doc_id, source_type, title, score FROM top"))
def tx_topk(c):
    return _search(c).top().select("query_id", "rank", "doc_id", "source_type", "title", "score")


@query("tx_eval_ranks", _w("SELECT * FROM ev"))
def tx_eval_ranks(c):
    return _ranks(c)


@query("tx_eval_summary", _w("""SELECT count(*) AS queries, avg(hit_at_1) AS hit_at_1, avg(hit_at_3) AS hit_at_3,
  avg(hit_at_6) AS hit_at_6, avg(reciprocal_rank) AS mrr FROM ev"""))
def tx_eval_summary(c):
    return RT.eval_summary(_ranks(c))


@query("tx_relevance", "SELECT DISTINCT item_id AS query_id, doc_id FROM benchmark b JOIN documents d ON position(b.text IN d.text) > 0")
def tx_relevance(c):
    return RT.contains_relevance(corpus(c), bench_queries(c), _query_post(c))


@query("tx_citation", _w("""
SELECT t.query_id, t.rank, t.doc_id, t.title, t.source_type, round(t.score, 4) AS score,
  substr(d.text, 1, 320) AS preview, substr(d.text, 1, 500) AS long_preview,
  '- [' || CAST(t.doc_id AS VARCHAR) || '] ' || t.title || '. Source type: ' || t.source_type || '. Matched terms: '
    || array_to_string(t.matched_terms, ', ') || '. Content: ' || substr(d.text, 1, 900) AS context_line
FROM top t JOIN documents d USING (doc_id)"""))
def tx_citation(c):
    search = _search(c)
    t = search.matched_terms(search.top()).join(c.t("documents").select("doc_id", F.col("text").alias("_text")), "doc_id")
    line = F.concat(F.lit("- ["), F.col("doc_id").cast("string"), F.lit("] "), F.col("title"), F.lit(". Source type: "),
                    F.col("source_type"), F.lit(". Matched terms: "), F.array_join("matched_terms", ", "),
                    F.lit(". Content: "), F.substring("_text", 1, 900))
    return t.select("query_id", "rank", "doc_id", "title", "source_type", F.round("score", 4).alias("score"),
                    F.substring("_text", 1, 320).alias("preview"), F.substring("_text", 1, 500).alias("long_preview"),
                    line.alias("context_line"))


def library(c):
    p = c.t("part")
    slug = F.regexp_replace(F.lower(F.concat_ws("-", "p_name", F.col("p_partkey").cast("string"))), "[^a-z0-9]+", "-")
    return p.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"),
                    F.regexp_replace(slug, "-", " ").alias("slug"), F.col("p_brand").alias("muscle_group"),
                    F.col("p_type").alias("category"))


def name_queries(c):
    return c.t("part").select("p_name").distinct().select(
        F.xxhash64("p_name").alias("query_id"), F.col("p_name").alias("text"))


FIELDS = [("name", "name"), ("slug", "slug"), ("muscle_group", "muscle_group"), ("category", "category")]
FIELD_SQL = """
lib AS (SELECT p_partkey AS item_id, p_name AS name,
          replace(regexp_replace(lower(p_name || '-' || CAST(p_partkey AS VARCHAR)), '[^a-z0-9]+', '-', 'g'), '-', ' ') AS slug,
          p_brand AS muscle_group, p_type AS category FROM part),
fq AS (SELECT DISTINCT p_name AS text, lower(trim(p_name)) AS phrase FROM part),
f AS (SELECT item_id, name, unnest([{'field': 'name', 'val': lower(name)}, {'field': 'slug', 'val': lower(slug)},
        {'field': 'muscle_group', 'val': lower(muscle_group)}, {'field': 'category', 'val': lower(category)}], recursive := true) FROM lib),
m AS (SELECT fq.text, f.item_id, f.name, f.field,
        len(list_intersect(list_distinct(regexp_extract_all(fq.phrase, '[a-z0-9]+')), list_distinct(regexp_extract_all(f.val, '[a-z0-9]+')))) AS ov,
        position(fq.phrase IN f.val) > 0 AS ph FROM fq, f),
fs AS (SELECT text, item_id, name, sum(ov + CASE WHEN ph AND length(text) > 0 THEN 3 ELSE 0 END
         + CASE WHEN field IN ('name', 'slug') THEN 4 WHEN field IN ('muscle_group', 'category') THEN 2 ELSE 0 END) AS score,
         string_agg(field, ',' ORDER BY field) AS matched_fields FROM m WHERE ov > 0 OR ph GROUP BY ALL)"""


@query("tx_field_match", f"WITH {FIELD_SQL} SELECT text, item_id, score, matched_fields FROM fs")
def tx_field_match(c):
    q = name_queries(c)
    s = RT.field_match(library(c), q, FIELDS)
    return s.join(q.hint("merge"), "query_id").select("text", "item_id", "score", "matched_fields")


@query("tx_field_topk", f"""WITH {FIELD_SQL}
SELECT text, item_id, name, score, matched_fields, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY score DESC, name, item_id) AS rank FROM fs) WHERE rank <= 5""")
def tx_field_topk(c):
    q = name_queries(c)
    lib = library(c)
    top = PR.field_search(lib, q, FIELDS, 5)
    return top.join(q.hint("merge"), "query_id").select("text", "item_id", "name", "score", "matched_fields", "rank")


@query("tx_field_context", f"""WITH {FIELD_SQL},
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY score DESC, name, item_id) AS rank FROM fs) WHERE rank <= 5)
SELECT t.text, t.item_id, '- ' || l.p_name || ' (' || l.p_brand || ', ' || ['Beginner', 'Intermediate', 'Advanced'][l.p_size % 3 + 1]
  || '). Matched fields: ' || replace(t.matched_fields, ',', ', ') || '. Instructions:  Cues: . Common mistakes: . Source: '
  || coalesce(nullif(CASE WHEN l.p_size % 5 = 0 THEN 'local seed' ELSE '' END, ''), 'local seed') || ' . License: '
  || coalesce(nullif(CASE WHEN l.p_size % 2 = 0 THEN 'catalogue licence' ELSE '' END, ''), 'not specified') || '.' AS context_line
FROM top t JOIN part l ON l.p_partkey = t.item_id""")
def tx_field_context(c):
    q = name_queries(c)
    lib = library(c)
    top = PR.field_search(lib, q, FIELDS, 5).join(q.hint("merge"), "query_id")
    p = c.t("part").select(F.col("p_partkey").alias("item_id"), "p_brand", "p_size")
    j = top.join(p.hint("merge"), "item_id")
    diff = F.element_at(F.array(F.lit("Beginner"), F.lit("Intermediate"), F.lit("Advanced")), (F.col("p_size") % 3 + 1).cast("int"))
    src = F.coalesce(F.nullif(F.when(F.col("p_size") % 5 == 0, F.lit("local seed")).otherwise(F.lit("")), F.lit("")), F.lit("local seed"))
    lic = F.coalesce(F.nullif(F.when(F.col("p_size") % 2 == 0, F.lit("catalogue licence")).otherwise(F.lit("")), F.lit("")),
                     F.lit("not specified"))
    line = F.concat(F.lit("- "), F.col("name"), F.lit(" ("), F.col("p_brand"), F.lit(", "), diff, F.lit("). Matched fields: "),
                    F.replace("matched_fields", F.lit(","), F.lit(", ")),
                    F.lit(". Instructions:  Cues: . Common mistakes: . Source: "), src, F.lit(" . License: "), lic, F.lit("."))
    return j.select("text", "item_id", line.alias("context_line"))
