"""Queries for catalogue curation rows of SURVEY 2.15 and the catalogue data-quality rules of 2.16."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import catalogue as CT
from .registry import query

# Anatomy rule tables for the driver catalogue (slugs are "<adjective>-<noun>-<key>").
OVERRIDES = (("small-ring-0", "chest-upper-left,chest-upper-right", "triceps-long-left,triceps-long-right"),
             ("red-widget-1", "quads-left,quads-right", "glutes-left,glutes-right"))
ISOLATION = (("blue-bolt-2", "biceps-left,biceps-right", ""), ("hot-gear-3", "lats-upper-left,lats-upper-right", ""))
PATTERNS = ((("ring",), "chest-upper-left,chest-upper-right", ""), (("gear", "bolt"), "lats-upper-left,lats-upper-right",
            "biceps-left,biceps-right"), (("widget",), "quads-left,quads-right", "hamstrings-left,hamstrings-right"))
ALIASES = (("small-gizmo-4", "deltoid-rear-left,deltoid-rear-right", ""),)
DEFAULTS = (("Brand#1", "abs-upper-left,abs-upper-right", ""), ("Brand#2", "calves-left,calves-right", ""),
            ("Brand#3", "glutes-left,glutes-right", "hamstrings-left,hamstrings-right"))
GROUP_RULES = ((("ring",), "Arms"), (("gear",), "Back"), (("bolt",), "Legs"))
EXEMPT_GROUPS = ("conditioning",)
EXEMPT_CATEGORIES = ("conditioning", "cardio", "recovery")


def _tbl(c, rows, key):
    df = c.spark.createDataFrame(list(rows), f"{key} string, p string, s string")
    return df.select(key, F.filter(F.split("p", ","), lambda x: x != "").alias("primary"),
                     F.filter(F.split("s", ","), lambda x: x != "").alias("secondary"))


def _resolve(c, lib):
    pats = [(needles, [x for x in p.split(",") if x], [x for x in s.split(",") if x]) for needles, p, s in PATTERNS]
    return CT.anatomy_resolve(lib, _tbl(c, OVERRIDES, "slug"), _tbl(c, ISOLATION, "slug"), pats, _tbl(c, ALIASES, "slug"),
                              _tbl(c, DEFAULTS, "muscle_group"))


def _values(rows, key):
    return "(VALUES " + ", ".join(f"('{a}', '{b}', '{s}')" for a, b, s in rows) + f") AS {{}}({key}, p, s)"


def _pattern_sql(idx):
    parts = " ".join(f"WHEN {' OR '.join(f'contains(slug, {chr(39)}{n}{chr(39)})' for n in needles)} THEN '{vals[idx]}'"
                     for needles, *vals in PATTERNS)
    return f"CASE {parts} END"


RESOLVE_SQL = f"""res AS (
SELECT l.*, CASE WHEN o.slug IS NOT NULL THEN 'override' WHEN i.slug IS NOT NULL THEN 'isolation'
    WHEN {_pattern_sql(0)} IS NOT NULL THEN 'pattern' WHEN a.slug IS NOT NULL THEN 'alias'
    WHEN d.muscle_group IS NOT NULL THEN 'group_default' ELSE 'none' END AS anatomy_level,
  coalesce(o.p, i.p, {_pattern_sql(0)}, a.p, d.p, '') AS primary_regions,
  coalesce(o.s, i.s, CASE WHEN {_pattern_sql(0)} IS NOT NULL THEN {_pattern_sql(1)} END, a.s, d.s, '') AS secondary_regions
FROM v_library l LEFT JOIN {_values(OVERRIDES, "slug").format("o")} USING (slug)
LEFT JOIN {_values(ISOLATION, "slug").format("i")} USING (slug) LEFT JOIN {_values(ALIASES, "slug").format("a")} USING (slug)
LEFT JOIN {_values(DEFAULTS, "muscle_group").format("d")} USING (muscle_group))"""


def _joined(df):
    return df.withColumns({"primary_regions": F.array_join("primary_regions", ","),
                           "secondary_regions": F.array_join("secondary_regions", ",")})


@query("ct_anatomy_resolve", f"WITH {RESOLVE_SQL} SELECT item_id, slug, anatomy_level, primary_regions, secondary_regions FROM res")
def ct_anatomy_resolve(c):
    return _joined(_resolve(c, c.library())).select("item_id", "slug", "anatomy_level", "primary_regions", "secondary_regions")


def _sql_group_refine():
    parts = " ".join(f"WHEN {' OR '.join(f'contains(slug, {chr(39)}{n}{chr(39)})' for n in needles)} THEN '{g}'" for needles, g in GROUP_RULES)
    return f"CASE {parts} ELSE muscle_group END"


@query("ct_group_refine", f"SELECT item_id, muscle_group AS previous_group, {_sql_group_refine()} AS next_group FROM v_library")
def ct_group_refine(c):
    lib = c.library()
    return lib.select("item_id", F.col("muscle_group").alias("previous_group"),
                      S.rule_group("slug", GROUP_RULES, default="\u0000").alias("_g")) \
        .join(lib.select("item_id", "muscle_group"), "item_id") \
        .select("item_id", "previous_group", F.when(F.col("_g") == "\u0000", F.col("muscle_group")).otherwise(F.col("_g")).alias("next_group"))


def _refined(c):
    lib = c.library()
    g = S.rule_group("slug", GROUP_RULES, default="\u0000")
    return lib.withColumn("previous_group", F.col("muscle_group")).withColumn(
        "muscle_group", F.when(g == "\u0000", F.col("muscle_group")).otherwise(g))


@query("ct_change_set", f"""WITH {RESOLVE_SQL.replace("FROM v_library l", "FROM (SELECT * EXCLUDE (muscle_group), muscle_group AS previous_group, " + _sql_group_refine() + " AS muscle_group FROM v_library) l")},
before AS (SELECT l.item_id, coalesce(CASE WHEN l.has_anatomy = 1 THEN d.p END, '') AS previous_primary
           FROM v_library l LEFT JOIN {_values(DEFAULTS, "muscle_group").format("d")} USING (muscle_group))
SELECT r.item_id, r.slug, r.previous_group, r.muscle_group AS next_group, b.previous_primary, r.primary_regions AS next_primary
FROM res r JOIN before b USING (item_id)
WHERE r.previous_group IS DISTINCT FROM r.muscle_group OR b.previous_primary IS DISTINCT FROM r.primary_regions""")
def ct_change_set(c):
    after = _joined(_resolve(c, _refined(c)))
    d = _tbl(c, DEFAULTS, "muscle_group").select("muscle_group", F.array_join("primary", ",").alias("_dp"))
    before = c.library().join(d, "muscle_group", "left").select(
        "item_id", F.coalesce(F.when(F.col("has_anatomy") == 1, F.col("_dp")), F.lit("")).alias("previous_primary"))
    j = after.join(before, "item_id")
    changed = (~F.col("previous_group").eqNullSafe(F.col("muscle_group"))) | (~F.col("previous_primary").eqNullSafe(F.col("primary_regions")))
    return j.filter(changed).select("item_id", "slug", "previous_group", F.col("muscle_group").alias("next_group"),
                                    "previous_primary", F.col("primary_regions").alias("next_primary"))


@query("ct_region_catalog", f"""WITH {RESOLVE_SQL}
SELECT muscle_group AS group_name, string_agg(DISTINCT r, ',' ORDER BY r) AS region_ids,
  string_agg(DISTINCT upper(r[1]) || replace(r[2:], '-', ' '), ',' ORDER BY upper(r[1]) || replace(r[2:], '-', ' ')) AS region_labels
FROM (SELECT muscle_group, unnest(string_split(primary_regions, ',')) AS r FROM res WHERE primary_regions <> '') GROUP BY muscle_group""")
def ct_region_catalog(c):
    r = _resolve(c, c.library()).select("muscle_group", F.explode("primary_regions").alias("r"))
    label = F.concat(F.upper(F.substring("r", 1, 1)), F.replace(F.substring("r", 2, 1 << 20), F.lit("-"), F.lit(" ")))
    return r.groupBy(F.col("muscle_group").alias("group_name")).agg(
        F.array_join(F.sort_array(F.collect_set("r")), ",").alias("region_ids"),
        F.array_join(F.sort_array(F.collect_set(label)), ",").alias("region_labels"))


ALLOWED = sorted({x for rows in (OVERRIDES, ISOLATION, ALIASES, DEFAULTS) for _, p, s in rows for x in (p + "," + s).split(",") if x}
                 | {x for _, p, s in PATTERNS for x in (p + "," + s).split(",") if x})
ALLOWED_SQL = "[" + ", ".join(f"'{a}'" for a in ALLOWED) + "]"


def _exempt_sql():
    return (f"(lower(trim(muscle_group)) IN ({', '.join(repr(g) for g in EXEMPT_GROUPS)}) OR "
            f"lower(trim(category)) IN ({', '.join(repr(x) for x in EXEMPT_CATEGORIES)}))")


@query("dq_region_valid", f"""WITH {RESOLVE_SQL}
SELECT item_id, len(list_filter(string_split(primary_regions || ',' || secondary_regions || CASE WHEN item_id % 97 = 0 THEN ',elbow-x' ELSE '' END, ','),
    lambda x: x <> '' AND NOT list_contains({ALLOWED_SQL}, x))) AS invalid_regions,
  CAST(primary_regions = '' AND NOT {_exempt_sql()} AS INTEGER) AS missing_primary FROM res""")
def dq_region_valid(c):
    r = _resolve(c, c.library())
    allowed = F.array(*[F.lit(a) for a in ALLOWED])
    extra = F.when(F.col("item_id") % 97 == 0, F.array(F.lit("elbow-x"))).otherwise(F.array().cast("array<string>"))
    regions = F.concat("primary_regions", "secondary_regions", extra)
    exempt = (F.lower(F.trim("muscle_group")).isin(*EXEMPT_GROUPS) | F.lower(F.trim("category")).isin(*EXEMPT_CATEGORIES))
    return r.select("item_id", F.size(F.filter(regions, lambda x: ~F.array_contains(allowed, x))).alias("invalid_regions"),
                    ((F.size("primary_regions") == 0) & ~exempt).cast("int").alias("missing_primary"))


@query("dq_catalogue_contract", f"""WITH {RESOLVE_SQL}
SELECT count(*) FILTER (WHERE primary_regions = '' AND NOT {_exempt_sql()}) AS records_without_primary,
  count(*) FILTER (WHERE slug IN ({', '.join(repr(o[0]) for o in OVERRIDES)}) AND primary_regions NOT IN ({', '.join(repr(o[1]) for o in OVERRIDES)})) AS named_slug_mismatches,
  count(*) AS records FROM res""")
def dq_catalogue_contract(c):
    r = _joined(_resolve(c, c.library()))
    exempt = (F.lower(F.trim("muscle_group")).isin(*EXEMPT_GROUPS) | F.lower(F.trim("category")).isin(*EXEMPT_CATEGORIES))
    named = F.col("slug").isin(*[o[0] for o in OVERRIDES]) & ~F.col("primary_regions").isin(*[o[1] for o in OVERRIDES])
    return r.agg(F.count(F.when((F.col("primary_regions") == "") & ~exempt, 1)).alias("records_without_primary"),
                 F.count(F.when(named, 1)).alias("named_slug_mismatches"), F.count(F.lit(1)).alias("records"))


@query("ct_translation_pick", """
SELECT source, doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN lang = 'en' THEN 0 ELSE 1 END, doc_id) AS rn
FROM documents WHERE length(trim(text)) > 0) WHERE rn = 1""")
def ct_translation_pick(c):
    d = c.t("documents").filter(F.length(F.trim("text")) > 0)
    w = Window.partitionBy("source").orderBy(F.when(F.col("lang") == "en", 0).otherwise(1), "doc_id")
    return d.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("source", "doc_id", "lang")


@query("ct_primary_media", f"""
WITH img AS (SELECT item_id, arg_min(media_url, (sort_order, media_url, media_type, source_name, embed_allowed)) AS url FROM v_media
             WHERE contains(lower(media_type), 'image') GROUP BY item_id)
SELECT l.item_id, CASE WHEN l.youtube_video_id <> '' THEN 'external_video' WHEN img.url IS NOT NULL THEN 'external_image'
    WHEN l.video_url <> '' THEN 'link' ELSE 'none' END AS media_type,
  CASE WHEN l.youtube_video_id <> '' THEN 'https://www.youtube.com/embed/' || l.youtube_video_id WHEN img.url IS NOT NULL THEN img.url
    WHEN l.video_url <> '' THEN l.video_url END AS media_url
FROM v_library l LEFT JOIN img USING (item_id)""")
def ct_primary_media(c):
    m = c.media().filter(F.instr(F.lower("media_type"), "image") > 0)
    img = m.groupBy("item_id").agg(F.min_by("media_url", F.struct(*CT.MEDIA_ORDER)).alias("url"))
    l = c.library().join(img, "item_id", "left")
    yt = F.col("youtube_video_id") != ""
    return l.select("item_id", F.when(yt, "external_video").when(F.col("url").isNotNull(), "external_image")
                    .when(F.col("video_url") != "", "link").otherwise("none").alias("media_type"),
                    F.when(yt, F.concat(F.lit("https://www.youtube.com/embed/"), "youtube_video_id"))
                    .when(F.col("url").isNotNull(), F.col("url")).when(F.col("video_url") != "", F.col("video_url")).alias("media_url"))


@query("ct_source_images", """
SELECT item_id, CAST(rn - 1 AS BIGINT) AS sort_order, media_url, name || ' image ' || CAST(rn AS VARCHAR) AS title FROM (
  SELECT m.item_id, m.media_url, l.name, row_number() OVER (PARTITION BY m.item_id ORDER BY m.sort_order, m.media_url, m.media_type,
    m.source_name, m.embed_allowed) AS rn
  FROM v_media m JOIN v_library l USING (item_id) WHERE contains(lower(m.media_type), 'image') AND trim(m.media_url) <> '') WHERE rn <= 2""")
def ct_source_images(c):
    """The first two images of each record as media rows with their place and title."""
    w = Window.partitionBy("item_id").orderBy(*CT.MEDIA_ORDER)
    m = c.media().filter((F.instr(F.lower("media_type"), "image") > 0) & (F.trim("media_url") != ""))
    m = m.withColumn("rn", F.row_number().over(w)).filter("rn <= 2").join(c.library().select("item_id", "name"), "item_id")
    return m.select("item_id", (F.col("rn") - 1).alias("sort_order"), "media_url",
                    F.concat("name", F.lit(" image "), F.col("rn").cast("string")).alias("title"))


IMPORT_SQL = """
rec AS (SELECT l.item_id, replace(trim(replace(replace(replace(replace(lower(l.name), '&', 'and'), '/', ' '), '_', ' '), '  ', ' ')), ' ', '-') AS slug,
          l.has_anatomy, l.muscle_group, l.category, coalesce(m.n, 0) AS media_count, coalesce(m.embed, 0) AS embed_ready
        FROM v_library l LEFT JOIN (SELECT item_id, count(*) AS n, max(embed_allowed) AS embed FROM v_media GROUP BY item_id) m USING (item_id)),
flt AS (SELECT *, has_anatomy = 0 AND NOT (lower(trim(muscle_group)) = 'conditioning' OR lower(trim(category)) IN ('conditioning', 'cardio', 'recovery')) AS needs_review
        FROM rec WHERE media_count > 0 AND embed_ready = 1),
kept AS (SELECT * FROM flt WHERE NOT needs_review AND slug <> ''),
win AS (SELECT slug, min(item_id) AS first_pos, arg_max(item_id, item_id) AS item_id, count(*) - 1 AS duplicates FROM kept GROUP BY slug)"""


@query("ct_import_filter", f"""WITH {IMPORT_SQL}
SELECT slug, item_id, first_pos FROM win""")
def ct_import_filter(c):
    return _import(c)[0]


def _import(c, limit: int = 0):
    """Winning slugs (the first ``limit`` of them, 0 = all) and the counters of what was skipped."""
    lib = c.library()
    m = c.media().groupBy("item_id").agg(F.count(F.lit(1)).alias("media_count"), F.max("embed_allowed").alias("embed_ready"))
    rec = lib.join(m, "item_id", "left").fillna(0, ["media_count", "embed_ready"]).withColumn("slug", S.slug_replace("name"))
    flt = rec.filter((F.col("media_count") > 0) & (F.col("embed_ready") == 1))
    exempt = (F.lower(F.trim("muscle_group")) == "conditioning") | F.lower(F.trim("category")).isin(*EXEMPT_CATEGORIES)
    flt = flt.withColumn("needs_review", (F.col("has_anatomy") == 0) & ~exempt)
    kept = flt.filter(~F.col("needs_review") & (F.col("slug") != ""))
    # Last record per slug wins, at the position of the slug's first record.
    win = kept.groupBy("slug").agg(F.min("item_id").alias("first_pos"), F.max("item_id").alias("item_id"),
                                   (F.count(F.lit(1)) - 1).alias("duplicates"))
    top = win.select("slug", "item_id", "first_pos")
    if limit > 0:
        top = top.orderBy("first_pos").limit(limit)
    counters = flt.agg(F.count(F.when(F.col("needs_review"), 1)).alias("skipped_missing_anatomy")).crossJoin(
        win.agg(F.sum("duplicates").alias("skipped_duplicate_slugs")))
    return top, counters


@query("ct_import_counters", f"""WITH {IMPORT_SQL}
SELECT (SELECT count(*) FROM flt WHERE needs_review) AS skipped_missing_anatomy, (SELECT sum(duplicates) FROM win) AS skipped_duplicate_slugs""")
def ct_import_counters(c):
    return _import(c)[1]


@query("ct_preview_records", """
SELECT l.item_id, l.slug, coalesce(m.n, 0) AS media_gallery_count, CAST(coalesce(m.n, 0) > 0 AS INTEGER) AS has_media,
  CAST(coalesce(m.embed, 0) = 1 AS INTEGER) AS has_embed_ready_media,
  CAST(l.has_anatomy = 0 AND NOT (lower(trim(l.muscle_group)) = 'conditioning'
    OR lower(trim(l.category)) IN ('conditioning', 'cardio', 'recovery')) AS INTEGER) AS requires_anatomy_review
FROM v_library l LEFT JOIN (SELECT item_id, count(*) AS n, max(embed_allowed) AS embed FROM v_media GROUP BY item_id) m USING (item_id)""")
def ct_preview_records(c):
    """The preview's flags of every record."""
    r = _preview_records(c)
    return r.select("item_id", "slug", F.col("n").alias("media_gallery_count"),
                    *[F.col(x).cast("int").alias(x) for x in ("has_media", "has_embed_ready_media", "requires_anatomy_review")])


def _preview_records(c):
    m = c.media().groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.max("embed_allowed").alias("embed"))
    exempt = (F.lower(F.trim("muscle_group")) == "conditioning") | F.lower(F.trim("category")).isin(*EXEMPT_CATEGORIES)
    return c.library().join(m, "item_id", "left").fillna(0, ["n", "embed"]).withColumns({
        "has_media": F.col("n") > 0, "has_embed_ready_media": F.col("embed") == 1,
        "requires_anatomy_review": (F.col("has_anatomy") == 0) & ~exempt})


@query("ct_preview_summary", """
SELECT count(*) AS records_total, count(*) FILTER (WHERE coalesce(m.n, 0) > 0) AS records_with_media,
  count(*) FILTER (WHERE coalesce(m.embed, 0) = 1) AS records_with_embed_ready_media,
  count(*) FILTER (WHERE l.has_anatomy = 0 AND NOT (lower(trim(l.muscle_group)) = 'conditioning'
    OR lower(trim(l.category)) IN ('conditioning', 'cardio', 'recovery'))) AS records_needing_anatomy_review
FROM v_library l LEFT JOIN (SELECT item_id, count(*) AS n, max(embed_allowed) AS embed FROM v_media GROUP BY item_id) m USING (item_id)""")
def ct_preview_summary(c):
    return _preview_records(c).agg(
        F.count(F.lit(1)).alias("records_total"), F.count(F.when(F.col("has_media"), 1)).alias("records_with_media"),
        F.count(F.when(F.col("has_embed_ready_media"), 1)).alias("records_with_embed_ready_media"),
        F.count(F.when(F.col("requires_anatomy_review"), 1)).alias("records_needing_anatomy_review"))


@query("ct_custom_slug", """
WITH ex AS (SELECT DISTINCT replace(trim(replace(replace(replace(replace(lower(name), '&', 'and'), '/', ' '), '_', ' '), '  ', ' ')), ' ', '-') AS base
            FROM v_library WHERE length(name) % 2 = 0),
nw AS (SELECT item_id, replace(trim(replace(replace(replace(replace(lower(name), '&', 'and'), '/', ' '), '_', ' '), '  ', ' ')), ' ', '-') AS base
       FROM v_library WHERE length(name) % 2 = 1),
r AS (SELECT nw.*, row_number() OVER (PARTITION BY base ORDER BY item_id) AS k, base IN (SELECT base FROM ex) AS taken FROM nw)
SELECT item_id, CASE WHEN NOT taken AND k = 1 THEN base WHEN taken THEN base || '-custom-' || CAST(k + 1 AS VARCHAR)
  ELSE base || '-custom-' || CAST(k AS VARCHAR) END AS slug FROM r""")
def ct_custom_slug(c):
    lib = c.library().withColumn("base", S.slug_replace("name"))
    even = F.length("name") % 2 == 0  # every item is on one side: names of even length exist, the others are new
    ex = lib.filter(even).select("base").distinct().withColumn("taken", F.lit(True))
    nw = lib.filter(~even).select("item_id", "base")
    r = nw.withColumn("k", F.row_number().over(Window.partitionBy("base").orderBy("item_id"))).join(ex, "base", "left") \
          .fillna(False, ["taken"])
    slug = (F.when(~F.col("taken") & (F.col("k") == 1), F.col("base"))
             .when(F.col("taken"), F.concat("base", F.lit("-custom-"), (F.col("k") + 1).cast("string")))
             .otherwise(F.concat("base", F.lit("-custom-"), F.col("k").cast("string"))))
    return r.select("item_id", slug.alias("slug"))


@query("ct_normalise_record")
def ct_normalise_record(c):
    """Raw HTML pages -> canonical catalogue rows (name, slug, group, steps, licence)."""
    p = c.t("pages")
    name = S.py_strip(S.strip_html(F.regexp_extract("html", "<title>(.*?)</title>", 1)))
    steps = S.instruction_steps(F.col("html"))
    group = S.rule_group(F.concat_ws(" ", name, "url"), [(("the", "and"), "Chest"), (("der", "und"), "Back"), (("que",), "Legs")])
    return p.select("page_id", name.alias("name"), S.slug_replace(name).alias("slug"), group.alias("muscle_group"),
                    F.lit("Unverified").alias("difficulty"), F.size(steps).alias("n_instructions"),
                    S.license_text(F.regexp_extract("url", "//([^/]+)/", 1), F.col("url"), F.lit("unknown")).alias("source_license"))


@query("ct_media_gallery", """
WITH p AS (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]+)"', 1) AS links FROM pages),
m AS (SELECT page_id, unnest(CASE WHEN len(links) = 0 THEN [{'media_type': 'link', 'media_url': url, 'sort_order': 0}]
    ELSE list_transform(links, lambda u, i: {'media_type': CASE WHEN regexp_matches(u, '(?i)\\.(mp4|webm)$') THEN 'external_video'
      ELSE 'external_image' END, 'media_url': u, 'sort_order': CAST(i - 1 AS INTEGER)}) END, recursive := true) FROM p)
SELECT page_id, media_type, media_url, sort_order FROM m""")
def ct_media_gallery(c):
    """Pages' links as an ordered media gallery: images (first), then videos; one fallback link when empty."""
    p = c.t("pages")
    links = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), 1)
    items = F.transform(links, lambda u, i: F.struct(
        F.when(u.rlike("(?i)\\.(mp4|webm)$"), "external_video").otherwise("external_image").alias("media_type"),
        u.alias("media_url"), i.alias("sort_order")))
    ordered = F.array_sort(items, lambda a, b: F.when(a["media_type"] < b["media_type"], 1)
                           .when(a["media_type"] > b["media_type"], -1)
                           .otherwise(a["sort_order"] - b["sort_order"]))
    gallery = F.when(F.size(items) > 0, ordered).otherwise(F.array(F.struct(
        F.lit("link").alias("media_type"), F.col("url").alias("media_url"), F.lit(0).alias("sort_order"))))
    return p.select("page_id", F.inline(gallery))
