"""Catalogue curation plus the catalogue joins and top-k rows of 2.3 / 2.6.

Library rows and their media are joined on the item key; every per-item
collection (gallery, kinds) is built with a grouped aggregate, and every
"best row per key" is a bounded window.  The fuzzy similarity join works on the
distinct (token set, group) signatures (:mod:`setjoin`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import setjoin

# Media types that count as rich media.
RICH_TYPES = ("external_image", "local_image", "image", "external_gif", "local_gif", "gif", "external_video",
              "local_video", "video", "youtube")
GENERATED_SOURCE = "generated reference"  # fixed value: media produced by the app itself
PROJECT_SEEDS = ("local seed", "youtube seed")  # fixed values: sources preferred by member de-duplication
COVERAGE_TARGET = 0.8  # fixed value


def media_kind(media_type="media_type", url="media_url") -> Column:
    v = F.lower(S.py_strip(F.col(media_type)))
    return (F.when(S.has_youtube_id(F.col(url)), "youtube").when(F.instr(v, "gif") > 0, "gif")
             .when(F.instr(v, "video") > 0, "video").when(F.instr(v, "image") > 0, "image")
             .when(v != "", v).otherwise("unknown"))


def is_rich(media_type="media_type", url="media_url", embed="embed_allowed") -> Column:
    v = F.lower(S.py_strip(F.col(media_type)))
    has_url = S.py_strip(F.coalesce(F.col(url), F.lit(""))) != ""
    emb = F.col(embed) == 1
    return (F.when(~has_url, F.lit(False)).when(S.has_youtube_id(F.col(url)), emb)
             .when(v.isin("external_video", "local_video", "video"), emb).otherwise(v.isin(*RICH_TYPES)))


def media_rank(media_type="media_type", url="media_url", embed="embed_allowed") -> Column:
    """Preferred media order: YouTube 0, video 1, gif 2, image 3, other 9."""
    v = F.lower(F.col(media_type))
    has_url = F.coalesce(F.col(url), F.lit("")) != ""
    emb = F.col(embed) == 1
    return (F.when(S.has_youtube_id(F.col(url)) & emb, 0).when((F.instr(v, "video") > 0) & has_url & emb, 1)
             .when((F.instr(v, "gif") > 0) & has_url, 2).when((F.instr(v, "image") > 0) & has_url, 3).otherwise(9))


MEDIA_ORDER = ["sort_order", "media_url", "media_type", "source_name", "embed_allowed"]


def gallery(library: DataFrame, media: DataFrame, key="item_id") -> DataFrame:
    """1:N ordered child collection per parent (left join keeps parents without media)."""
    g = media.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*MEDIA_ORDER))).alias("gallery"))
    return library.join(g, key, "left")


def media_dedupe(media: DataFrame, key="item_id") -> DataFrame:
    """Distinct by ``type::url`` per parent, keeping the first in gallery order."""
    w = Window.partitionBy(key, "media_type", "media_url").orderBy(*MEDIA_ORDER)
    return media.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def preferred_media(media: DataFrame, key="item_id") -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.col("_rank"), *MEDIA_ORDER)
    m = media.withColumn("_rank", media_rank())
    return (m.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
             .select(key, "media_url", "media_type", F.col("_rank").alias("media_rank")))


def member_priority(library: DataFrame, media: DataFrame, key="item_id") -> DataFrame:
    """(external rich media, project seed, anatomy) flags per library row."""
    ext = (media.filter(is_rich() & (F.col("source_name") != GENERATED_SOURCE))
                .select(key).distinct().withColumn("has_external_media", F.lit(1)))
    return (library.join(ext, key, "left").fillna(0, ["has_external_media"])
                   .withColumn("is_project_seed", F.col("source_name").isin(*PROJECT_SEEDS).cast("int")))


def name_dedupe(library: DataFrame, media: DataFrame, key="item_id") -> DataFrame:
    """One row per normalised name: highest priority wins, the first in (group, name) order on ties."""
    p = member_priority(library, media, key).withColumn("name_key", S.name_key("name"))
    w = Window.partitionBy("name_key").orderBy(F.col("has_external_media").desc(), F.col("is_project_seed").desc(),
                                               F.col("has_anatomy").desc(), "muscle_group", "name", key)
    return p.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def coverage(deduped: DataFrame, media: DataFrame, key="item_id") -> DataFrame:
    """Parent-level media coverage: rich / external / generated / fallback counts vs the target."""
    rich = media.filter(is_rich())
    per = rich.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rich_items"),
        F.max((F.col("source_name") != GENERATED_SOURCE).cast("int")).alias("_ext"),
        F.max((F.col("source_name") == GENERATED_SOURCE).cast("int")).alias("_gen"))
    d = deduped.join(per, key, "left").fillna(0, ["_rich_items", "_ext", "_gen"])
    yt = (S.py_strip(F.col("youtube_video_id")) != "").cast("int")
    d = d.withColumns({"rich_media": F.greatest((F.col("_rich_items") > 0).cast("int"), yt),
                       "external_demo": F.greatest(F.col("_ext"), yt),
                       "fallback_link": (S.py_strip(F.col("video_url")) != "").cast("int")})
    n = F.greatest(F.lit(1), F.count(F.lit(1)))
    return d.agg(
        F.count(F.lit(1)).alias("member_visible_exercises"), F.sum("rich_media").alias("rich_media_exercises"),
        (F.sum("rich_media") / n).alias("rich_media_coverage"), F.sum("external_demo").alias("external_demo_media_exercises"),
        (F.sum("external_demo") / n).alias("external_demo_media_coverage"),
        F.sum("_gen").alias("generated_reference_exercises"), F.sum("fallback_link").alias("fallback_link_exercises"),
        (F.sum("fallback_link") / n).alias("fallback_link_coverage"),
        F.count(F.when(F.col("rich_media") == 0, 1)).alias("missing_rich_media"),
        F.when(F.sum("external_demo") / n >= COVERAGE_TARGET, "ok").otherwise("below_target").alias("status"))


def fuzzy_match(exercises: DataFrame, records: DataFrame, threshold: float = 0.34, ex_key="item_id",
                rec_key="record_id") -> DataFrame:
    """Best record per exercise by token overlap / max(token counts) + 1 for the same group.

    Both sides are reduced to distinct (token set, group) signatures, the earliest record id
    standing for its signature (ties go to the earlier record), and matched by
    :func:`setjoin.best_match`.
    """
    tokens = S.name_tokens("name")
    ex = exercises.select(ex_key, "muscle_group", tokens.alias("tok"))
    rc = records.select(F.col(rec_key).alias("rec"), "muscle_group", tokens.alias("tok"))
    wanted = setjoin.signatures(ex, "tok", "muscle_group")
    best = setjoin.best_match(wanted, setjoin.signatures(rc, "tok", "muscle_group", F.min("rec").alias("rec")),
                              threshold, "rec")
    own = setjoin.signatures(ex, "tok", "muscle_group", F.collect_list(ex_key).alias("_ids"))
    return own.join(best, ["sig", "grp"]).select(F.explode("_ids").alias(ex_key), F.col("rec").alias(rec_key), "score")


def anatomy_resolve(library: DataFrame, overrides: DataFrame, isolation: DataFrame, patterns: list,
                    aliases: DataFrame, defaults: DataFrame, slug="slug", group="muscle_group") -> DataFrame:
    """Five-level cascade: exact override -> isolation list -> slug pattern -> alias -> group default.

    Rule tables are (slug, primary, secondary) / (group, primary, secondary)
    frames joined on their key; ``patterns`` is an ordered list of
    (substrings, primary, secondary) evaluated as one ``when`` chain.
    """
    def lv(t, k, name):
        return t.select(F.col(k).alias(k if k != "key" else k),
                        F.struct(F.col("primary"), F.col("secondary")).alias(name))
    d = (library.join(lv(overrides, "slug", "_o"), slug, "left").join(lv(isolation, "slug", "_i"), slug, "left")
                .join(lv(aliases, "slug", "_a"), slug, "left").join(lv(defaults, "muscle_group", "_d"), group, "left"))
    pat = F.lit(None).cast("struct<primary:array<string>,secondary:array<string>>")
    for needles, prim, sec in reversed(patterns):
        cond = None
        for n in needles:
            c = F.instr(F.col(slug), n) > 0
            cond = c if cond is None else (cond | c)
        val = F.struct(F.array(*[F.lit(x) for x in prim]).cast("array<string>").alias("primary"),
                       F.array(*[F.lit(x) for x in sec]).cast("array<string>").alias("secondary"))
        pat = F.when(cond, val).otherwise(pat)
    empty = F.struct(F.array().cast("array<string>").alias("primary"), F.array().cast("array<string>").alias("secondary"))
    level = (F.when(F.col("_o").isNotNull(), "override").when(F.col("_i").isNotNull(), "isolation")
              .when(pat.isNotNull(), "pattern").when(F.col("_a").isNotNull(), "alias")
              .when(F.col("_d").isNotNull(), "group_default").otherwise("none"))
    res = F.coalesce(F.col("_o"), F.col("_i"), pat, F.col("_a"), F.col("_d"), empty)
    return d.withColumn("_res", res).withColumn("anatomy_level", level) \
            .withColumn("primary_regions", F.col("_res.primary")).withColumn("secondary_regions", F.col("_res.secondary")) \
            .drop("_o", "_i", "_a", "_d", "_res")
