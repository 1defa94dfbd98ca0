"""Queries for catalogue curation and the catalogue rows of 2.2, 2.3, 2.5, 2.6, 2.8."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import catalogue as CT
from .registry import query


def sql_has_yt(u: str) -> str:
    return (f"((length(trim(coalesce({u}, ''))) = 11 AND regexp_full_match(trim(coalesce({u}, '')), '[A-Za-z0-9_-]+'))"
            f" OR contains(coalesce({u}, ''), 'youtube.com/watch') OR contains(coalesce({u}, ''), 'youtu.be/')"
            f" OR contains(coalesce({u}, ''), 'youtube-nocookie.com/embed/'))")


RICH_LIST = "[" + ", ".join(f"'{t}'" for t in CT.RICH_TYPES) + "]"
SQL_RICH = (f"(CASE WHEN trim(coalesce(media_url, '')) = '' THEN false WHEN {sql_has_yt('media_url')} THEN embed_allowed = 1 "
            f"WHEN lower(trim(media_type)) IN ('external_video', 'local_video', 'video') THEN embed_allowed = 1 "
            f"ELSE list_contains({RICH_LIST}, lower(trim(media_type))) END)")
SQL_KIND = (f"(CASE WHEN {sql_has_yt('media_url')} THEN 'youtube' WHEN contains(lower(trim(media_type)), 'gif') THEN 'gif' "
            f"WHEN contains(lower(trim(media_type)), 'video') THEN 'video' WHEN contains(lower(trim(media_type)), 'image') "
            f"THEN 'image' WHEN lower(trim(media_type)) <> '' THEN lower(trim(media_type)) ELSE 'unknown' END)")
SQL_RANK = (f"(CASE WHEN {sql_has_yt('media_url')} AND embed_allowed = 1 THEN 0 WHEN contains(lower(media_type), 'video') "
            f"AND coalesce(media_url, '') <> '' AND embed_allowed = 1 THEN 1 WHEN contains(lower(media_type), 'gif') AND "
            f"coalesce(media_url, '') <> '' THEN 2 WHEN contains(lower(media_type), 'image') AND coalesce(media_url, '') <> '' "
            f"THEN 3 ELSE 9 END)")
MEDIA_ORDER = "sort_order, media_url, media_type, source_name, embed_allowed"
NAME_KEY = "trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g'))"

DEDUPE_SQL = f"""
ext AS (SELECT DISTINCT item_id, 1 AS has_external_media FROM v_media WHERE {SQL_RICH} AND source_name <> 'generated reference'),
pri AS (SELECT l.*, coalesce(e.has_external_media, 0) AS has_external_media,
          CAST(l.source_name IN ('local seed', 'youtube seed') AS INTEGER) AS is_project_seed, {NAME_KEY} AS name_key
        FROM v_library l LEFT JOIN ext e USING (item_id)),
ded AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY name_key ORDER BY has_external_media DESC,
          is_project_seed DESC, has_anatomy DESC, muscle_group, name, item_id) AS r FROM pri) WHERE r = 1)"""


def visible(c):
    return c.library().filter(F.lower("source_name") != "wger")


@query("flt_visible", "SELECT item_id, slug FROM v_library WHERE lower(source_name) <> 'wger'")
def flt_visible(c):
    return visible(c).select("item_id", "slug")


@query("flt_library_search", """
SELECT item_id, name FROM v_library WHERE lower(source_name) <> 'wger' AND lower(muscle_group) = lower('Brand#1')
  AND (contains(lower(name), 'ring') OR contains(lower(category), 'ring') OR contains(lower(muscle_group), 'ring'))""")
def flt_library_search(c):
    needle = "ring"
    lib = visible(c).filter(F.lower("muscle_group") == "brand#1")
    hit = ((F.instr(F.lower("name"), needle) > 0) | (F.instr(F.lower("category"), needle) > 0)
           | (F.instr(F.lower("muscle_group"), needle) > 0))
    return lib.filter(hit).select("item_id", "name")


# Quick-filter parameters for the driver catalogue (groups are brands, names are "adjective noun").
UPPER = ("brand#1", "brand#2", "brand#3", "brand#4", "brand#5", "brand#6")
LOWER = ("brand#7", "brand#8", "brand#9", "brand#10")
PUSH_GROUPS, PUSH_TERMS = ("brand#11",), ("gear", "bolt")
PULL_GROUPS, PULL_TERMS = ("brand#12",), ("ring", "widget")
TEXT_FILTERS = ("Small", "Economy", "Promo")


def _in(xs):
    return "(" + ", ".join(f"'{x}'" for x in xs) + ")"


@query("flt_library_quick", f"""
WITH m AS (SELECT DISTINCT item_id FROM v_media WHERE {SQL_RICH} AND source_name <> 'generated reference'),
l AS (SELECT l.*, lower(muscle_group) AS g, lower(name) AS n, lower(name || ' ' || category || ' ' || muscle_group) AS s,
        (m.item_id IS NOT NULL OR l.youtube_video_id <> '') AS has_media FROM v_library l LEFT JOIN m USING (item_id))
SELECT item_id, 'With media' AS quick_filter FROM l WHERE has_media
UNION ALL SELECT item_id, 'Upper' FROM l WHERE g IN {_in(UPPER)}
UNION ALL SELECT item_id, 'Lower' FROM l WHERE g IN {_in(LOWER)}
UNION ALL SELECT item_id, 'Push' FROM l WHERE g IN {_in(PUSH_GROUPS)} OR {" OR ".join(f"contains(n, '{t}')" for t in PUSH_TERMS)}
UNION ALL SELECT item_id, 'Pull' FROM l WHERE g IN {_in(PULL_GROUPS)} OR {" OR ".join(f"contains(n, '{t}')" for t in PULL_TERMS)}
""" + "".join(f"UNION ALL SELECT item_id, '{f}' FROM l WHERE contains(s, '{f.lower()}')\n" for f in TEXT_FILTERS))
def flt_library_quick(c):
    lib = c.library()
    m = (c.media().filter(CT.is_rich() & (F.col("source_name") != CT.GENERATED_SOURCE)).select("item_id").distinct()
         .withColumn("_m", F.lit(True)))
    l = lib.join(m, "item_id", "left").withColumns({
        "g": F.lower("muscle_group"), "n": F.lower("name"),
        "s": F.lower(F.concat_ws(" ", "name", "category", "muscle_group")),
        "has_media": F.coalesce("_m", F.lit(False)) | (F.col("youtube_video_id") != "")})

    def any_term(terms):
        cond = None
        for t in terms:
            x = F.instr("n", t) > 0
            cond = x if cond is None else cond | x
        return cond
    rules = [("With media", F.col("has_media")), ("Upper", F.col("g").isin(*UPPER)), ("Lower", F.col("g").isin(*LOWER)),
             ("Push", F.col("g").isin(*PUSH_GROUPS) | any_term(PUSH_TERMS)),
             ("Pull", F.col("g").isin(*PULL_GROUPS) | any_term(PULL_TERMS))]
    rules += [(f, F.instr("s", f.lower()) > 0) for f in TEXT_FILTERS]
    tags = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]), lambda x: x.isNotNull())
    return l.select("item_id", F.explode(tags).alias("quick_filter"))


@query("agg_facets", """
SELECT 'muscle_group' AS facet, string_agg(DISTINCT muscle_group, '|' ORDER BY muscle_group) AS facet_values FROM v_library
UNION ALL SELECT 'category', string_agg(DISTINCT category, '|' ORDER BY category) FROM v_library
UNION ALL SELECT 'difficulty', string_agg(DISTINCT difficulty, '|' ORDER BY difficulty) FROM v_library""")
def agg_facets(c):
    lib = c.library()
    out = None
    for f in ("muscle_group", "category", "difficulty"):
        d = lib.agg(F.array_join(F.sort_array(F.collect_set(f)), "|").alias("facet_values")).select(
            F.lit(f).alias("facet"), "facet_values")
        out = d if out is None else out.unionByName(d)
    return out


@query("join_gallery", f"""
SELECT l.item_id, coalesce(g.n, 0) AS media_count, g.urls AS gallery_urls FROM v_library l LEFT JOIN (
  SELECT item_id, count(*) AS n, string_agg(media_url, ' ' ORDER BY {MEDIA_ORDER}) AS urls FROM v_media GROUP BY item_id) g
USING (item_id)""")
def join_gallery(c):
    g = CT.gallery(c.library(), c.media())
    return g.select("item_id", F.coalesce(F.size("gallery"), F.lit(0)).alias("media_count"),
                    F.array_join(F.transform("gallery", lambda x: x["media_url"]), " ").alias("gallery_urls")) \
        .withColumn("media_count", F.when(F.col("gallery_urls").isNull(), 0).otherwise(F.col("media_count")))


@query("topk_media_dedupe", f"""
SELECT item_id, media_type, media_url, sort_order, source_name FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, media_type, media_url ORDER BY {MEDIA_ORDER}) AS r FROM v_media) WHERE r = 1""")
def topk_media_dedupe(c):
    return CT.media_dedupe(c.media()).select("item_id", "media_type", "media_url", "sort_order", "source_name")


@query("topk_media_rank", f"""
SELECT item_id, media_url, media_type, media_rank FROM (
  SELECT *, {SQL_RANK} AS media_rank, row_number() OVER (PARTITION BY item_id ORDER BY {SQL_RANK}, {MEDIA_ORDER}) AS r
  FROM v_media) WHERE r = 1""")
def topk_media_rank(c):
    return CT.preferred_media(c.media())


@query("fn_media_kind", f"""
SELECT order_key, sort_order, item_id, media_url, {SQL_KIND} AS kind, {SQL_RICH} AS rich FROM v_media""")
def fn_media_kind(c):
    return c.media().select("order_key", "sort_order", "item_id", "media_url", CT.media_kind().alias("kind"),
                            CT.is_rich().alias("rich"))


@query("topk_name_dedupe", f"WITH {DEDUPE_SQL} SELECT name_key, item_id, has_external_media, is_project_seed FROM ded")
def topk_name_dedupe(c):
    return CT.name_dedupe(visible(c), c.media()).select("name_key", "item_id", "has_external_media", "is_project_seed")


COVER_SQL = f"""
WITH {DEDUPE_SQL.replace("FROM v_library l", "FROM (SELECT * FROM v_library WHERE lower(source_name) <> 'wger') l")},
per AS (SELECT item_id, count(*) AS ri, max(CAST(source_name <> 'generated reference' AS INTEGER)) AS ext,
          max(CAST(source_name = 'generated reference' AS INTEGER)) AS gen FROM v_media WHERE {SQL_RICH} GROUP BY item_id),
d AS (SELECT ded.*, coalesce(ri, 0) AS ri, coalesce(ext, 0) AS ext, coalesce(gen, 0) AS gen,
        greatest(CAST(coalesce(ri, 0) > 0 AS INTEGER), CAST(trim(youtube_video_id) <> '' AS INTEGER)) AS rich_media,
        greatest(coalesce(ext, 0), CAST(trim(youtube_video_id) <> '' AS INTEGER)) AS external_demo,
        CAST(trim(video_url) <> '' AS INTEGER) AS fallback_link FROM ded LEFT JOIN per USING (item_id))"""


@query("ct_coverage", COVER_SQL + """
SELECT count(*) AS member_visible_exercises, sum(rich_media) AS rich_media_exercises,
  sum(rich_media) / greatest(1, count(*)) AS rich_media_coverage, sum(external_demo) AS external_demo_media_exercises,
  sum(external_demo) / greatest(1, count(*)) AS external_demo_media_coverage, sum(gen) AS generated_reference_exercises,
  sum(fallback_link) AS fallback_link_exercises, sum(fallback_link) / greatest(1, count(*)) AS fallback_link_coverage,
  count(*) FILTER (WHERE rich_media = 0) AS missing_rich_media,
  CASE WHEN sum(external_demo) / greatest(1, count(*)) >= 0.8 THEN 'ok' ELSE 'below_target' END AS status FROM d""")
def ct_coverage(c):
    return CT.coverage(CT.name_dedupe(visible(c), c.media()), c.media())


@query("agg_media_kinds", COVER_SQL.replace("WITH ", "WITH ", 1) + f"""
, rm AS (SELECT m.* FROM v_media m JOIN ded USING (item_id) WHERE {SQL_RICH})
SELECT 'kind' AS dimension, {SQL_KIND} AS value, count(*) AS n FROM rm GROUP BY ALL
UNION ALL SELECT 'source', coalesce(nullif(trim(source_name), ''), 'unknown'), count(*) FROM rm GROUP BY ALL""")
def agg_media_kinds(c):
    ded = CT.name_dedupe(visible(c), c.media()).select("item_id")
    rm = c.media().join(ded, "item_id").filter(CT.is_rich())
    k = rm.groupBy(CT.media_kind().alias("value")).agg(F.count(F.lit(1)).alias("n")).withColumn("dimension", F.lit("kind"))
    src = F.coalesce(F.nullif(F.trim("source_name"), F.lit("")), F.lit("unknown"))
    s = rm.groupBy(src.alias("value")).agg(F.count(F.lit(1)).alias("n")).withColumn("dimension", F.lit("source"))
    return k.unionByName(s).select("dimension", "value", "n")


@query("fn_name_key", f"SELECT item_id, {NAME_KEY} AS name_key FROM v_library")
def fn_name_key(c):
    return c.library().select("item_id", S.name_key("name").alias("name_key"))


@query("fn_slug_regex", "SELECT item_id, trim(regexp_replace(lower(trim(name || ' / ' || category)), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM v_library")
def fn_slug_regex(c):
    return c.library().select("item_id", S.slug_regex(F.concat_ws(" / ", "name", "category")).alias("slug"))


@query("fn_slug_replace", """
SELECT item_id, replace(trim(replace(replace(replace(replace(lower(name || ' & ' || category || '_x/y'), '&', 'and'), '/', ' '), '_', ' '), '  ', ' ')), ' ', '-') AS slug FROM v_library""")
def fn_slug_replace(c):
    return c.library().select("item_id", S.slug_replace(F.concat(F.col("name"), F.lit(" & "), F.col("category"),
                                                                F.lit("_x/y"))).alias("slug"))


TITLE_IN = "name || '-' || lower(category) || '_ez'"


@query("fn_title_name", f"""
SELECT item_id, trim(array_to_string(list_transform(string_split(trim(regexp_replace(regexp_replace({TITLE_IN}, '[_\\-]+', ' ', 'g'),
  '\\s+', ' ', 'g')), ' '), lambda w: CASE WHEN list_contains(['trx', 'jm', 'ez', 'smr', 'tke'], lower(w)) THEN upper(w)
  ELSE upper(w[1]) || lower(w[2:]) END), ' ')) AS title FROM v_library""")
def fn_title_name(c):
    x = F.concat(F.col("name"), F.lit("-"), F.lower("category"), F.lit("_ez"))
    return c.library().select("item_id", S.title_name(x).alias("title"))


DISPLAY_IN = "lower(name) || ' of the ' || lower(category) || '-and-go'"


@query("fn_display_name", f"""
SELECT item_id, CASE WHEN v = '' OR regexp_matches(v, '[A-Z]') THEN v ELSE array_to_string(list_transform(range(1, len(w) + 1),
  lambda i: CASE WHEN i > 1 AND list_contains(['and', 'or', 'with', 'the', 'of', 'in', 'on', 'to', 'for'], lower(w[i])) THEN lower(w[i])
  ELSE upper(lower(w[i])[1]) || lower(w[i])[2:] END || coalesce(sep[i], '')), '') END AS display_name
FROM (SELECT item_id, v, regexp_split_to_array(v, '[ -]') AS w, regexp_extract_all(v, '[ -]') AS sep
      FROM (SELECT item_id, CASE WHEN item_id % 5 = 0 THEN upper(name) ELSE {DISPLAY_IN} END AS v FROM v_library))""")
def fn_display_name(c):
    v = F.when(F.col("item_id") % 5 == 0, F.upper("name")).otherwise(
        F.concat(F.lower("name"), F.lit(" of the "), F.lower("category"), F.lit("-and-go")))
    return c.library().select("item_id", S.display_name(v).alias("display_name"))


NAME_STOP = "[" + ", ".join(f"'{w}'" for w in S.NAME_STOPWORDS) + "]"


def sql_name_tokens(x: str) -> str:
    return (f"list_sort(list_distinct(list_filter(regexp_extract_all(lower({x}), '[a-z0-9]+'), "
            f"lambda t: length(t) > 1 AND NOT list_contains({NAME_STOP}, t))))")


TOKENS_IN = "name || ' with ' || category || ' a x'"


@query("fn_name_tokens", f"SELECT item_id, array_to_string({sql_name_tokens(TOKENS_IN)}, ' ') AS tokens FROM v_library")
def fn_name_tokens(c):
    x = F.concat(F.col("name"), F.lit(" with "), F.col("category"), F.lit(" a x"))
    return c.library().select("item_id", F.array_join(F.array_sort(S.name_tokens(x)), " ").alias("tokens"))


FUZZY_SQL = f"""
e AS (SELECT item_id, {sql_name_tokens('name')} AS etok, muscle_group AS eg FROM v_library WHERE item_id % 4 <> 0),
r AS (SELECT item_id AS record_id, {sql_name_tokens('name')} AS rtok, muscle_group AS rg FROM v_library WHERE item_id % 4 = 0),
p AS (SELECT e.item_id, r.record_id, len(list_intersect(etok, rtok)) / greatest(len(etok), len(rtok))
        + CASE WHEN eg = rg THEN 1.0 ELSE 0.0 END AS score
      FROM e, r WHERE len(etok) > 0 AND len(rtok) > 0 AND len(list_intersect(etok, rtok)) > 0),
best AS (SELECT item_id, record_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, record_id) AS rn FROM p) WHERE rn = 1 AND score >= 0.34)"""


def _fuzzy(c, ex, rec):
    return CT.fuzzy_match(ex, rec.withColumnRenamed("item_id", "record_id"))


@query("join_fuzzy_tokens", f"WITH {FUZZY_SQL} SELECT * FROM best")
def join_fuzzy_tokens(c):
    lib = c.library()
    return _fuzzy(c, lib.filter(F.col("item_id") % 4 != 0), lib.filter(F.col("item_id") % 4 == 0))


@query("ct_family_match", f"""
WITH {FUZZY_SQL.replace("FROM v_library WHERE item_id % 4 <> 0", "FROM v_library WHERE item_id NOT IN (SELECT item_id FROM v_media WHERE sort_order <= 2)").replace("FROM v_library WHERE item_id % 4 = 0", "FROM v_library WHERE item_id IN (SELECT item_id FROM v_media WHERE sort_order <= 2)")}
SELECT b.item_id, b.record_id, b.score, count(*) AS attached_media FROM best b
JOIN (SELECT * FROM v_media WHERE sort_order <= 2) m ON m.item_id = b.record_id GROUP BY ALL""")
def ct_family_match(c):
    lib = c.library()
    media = c.media().filter(F.col("sort_order") <= 2)
    with_media = media.select("item_id").distinct()
    ex = lib.join(with_media, "item_id", "left_anti")
    rec = lib.join(with_media, "item_id", "left_semi")
    best = _fuzzy(c, ex, rec)
    n = media.groupBy(F.col("item_id").alias("record_id")).agg(F.count(F.lit(1)).alias("attached_media"))
    return best.join(n, "record_id").select("item_id", "record_id", "score", "attached_media")
