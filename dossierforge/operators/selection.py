"""Which pages to read, and what a company's pages amount to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab as V

_STATE = "struct<urls:array<struct<url:string,slug:string>>,collisions:array<struct<url:string,slug:string>>,used:map<string,int>>"


def select_urls(links: DataFrame, key: str = "company_id", homepage: str = "homepage") -> DataFrame:
    """links(key, homepage, link, ord) to selected and collisions, arrays of (url, slug), one row per key.

    Greedy, so a fold over a company's links, which are a site's homepage and sitemap links: tiers 1 and 2 by tier, depth,
    place in the tier and order, at most PREFIX_CAP of a tier path (address pages have no cap), up to MAX_URLS; then tier
    3 while there are fewer than MIN_PAGES, then unclassified links by depth. A slug that is taken is a collision, and counts for nothing.
    """
    d = links.withColumn("cls", T.classify(F.col("link"))).withColumn("depth", T.path_depth(F.col("link")))
    tier, position = F.coalesce("cls.tier", F.lit(4)), F.coalesce("cls.position", F.lit(0))
    item = F.struct(tier.alias("tier"), F.col("depth").alias("depth"), position.alias("position"), F.col("ord").alias("ord"), F.col("link").alias("url"), T.slugify_path(F.col("link")).alias("slug"))
    grouped = d.groupBy(key, homepage).agg(F.array_sort(F.collect_list(item)).alias("items"))

    def take(acc: Column, x: Column) -> Column:
        n = F.size(acc["urls"])
        early = x["tier"] <= 2
        prefix = F.concat_ws(":", x["tier"].cast("string"), x["position"].cast("string"))
        used = F.coalesce(F.try_element_at(acc["used"], prefix), F.lit(0))
        room = F.when(early, (n < V.MAX_URLS) & ((x["position"] == V.ADDRESS_POSITION) | (used < V.PREFIX_CAP))).otherwise(n < V.MIN_PAGES)
        taken = F.exists(acc["urls"], lambda u: u["slug"] == x["slug"])
        new = F.array(F.struct(x["url"].alias("url"), x["slug"].alias("slug")))
        added = F.struct(
            F.concat(acc["urls"], new).alias("urls"),
            acc["collisions"].alias("collisions"),
            F.when(early & (x["position"] != V.ADDRESS_POSITION), F.map_concat(F.map_filter(acc["used"], lambda k, _: k != prefix), F.create_map(prefix, used + 1))).otherwise(acc["used"]).alias("used"),
        ).cast(_STATE)
        clash = F.struct(acc["urls"].alias("urls"), F.concat(acc["collisions"], new).alias("collisions"), acc["used"].alias("used")).cast(_STATE)
        return F.when(~room, acc).when(taken, clash).otherwise(added)

    start = F.struct(
        F.array(F.struct(F.col(homepage).alias("url"), F.lit("index").alias("slug"))).alias("urls"),
        F.array().cast("array<struct<url:string,slug:string>>").alias("collisions"),
        F.create_map().cast("map<string,int>").alias("used"),
    ).cast(_STATE)
    return grouped.select(key, F.aggregate("items", start, take).alias("s")).select(key, F.col("s.urls").alias("selected"), F.col("s.collisions").alias("collisions"))


def content_status(pages: DataFrame, key: str = "company_id", text: str = "text") -> DataFrame:
    """pages_collected, total_chars and status of each key; thin pages (under THIN_CHARS) are dropped first."""
    kept = F.length(text) >= V.THIN_CHARS
    d = pages.groupBy(key).agg(F.count(F.when(kept, 1)).alias("pages_collected"), F.coalesce(F.sum(F.when(kept, F.length(text))), F.lit(0)).alias("total_chars"))
    n, chars = F.col("pages_collected"), F.col("total_chars")
    return d.withColumn("status", F.when((n >= V.MIN_PAGES) | ((n >= 1) & (chars >= V.SUBSTANTIAL_CHARS)), "ok").when(n >= 1, "thin").otherwise("fetch_failed"))


def merged_surfaces(surfaces: DataFrame, key: str = "company_id") -> DataFrame:
    """surfaces(key, slug, kind, text): of an address page the recall text if there is one, else the precision text; others precision."""
    d = surfaces.where("kind IN ('precision', 'recall')").groupBy(key, "slug").agg(F.max(F.when(F.col("kind") == "precision", F.col("text"))).alias("p"), F.max(F.when(F.col("kind") == "recall", F.col("text"))).alias("r"))
    use = F.when(T.is_address_intent(F.col("slug")), F.coalesce("r", "p")).otherwise(F.coalesce("p", "r"))
    return d.select(key, "slug", F.col("p").isNull().alias("recall_only"), use.alias("text"))


def _joined(df: DataFrame, key: str, order: Column, text: Column, chars: int) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("slug").alias("slug"), text.alias("t"))))
    return df.groupBy(key).agg(F.substring(F.array_join(F.transform(parts, lambda x: x["t"]), "\n\n"), 1, chars).alias("body"))


def dossier_input(pages: DataFrame, key: str = "company_id") -> DataFrame:
    """pages(key, slug, text) as one text: index first, then by slug, with headings, cut to DOSSIER_CHARS."""
    return _joined(pages, key, (F.col("slug") != "index").cast("int"), F.concat(F.lit("## ["), F.col("slug"), F.lit("]\n"), F.col("text")), V.DOSSIER_CHARS)


def fallback_surface(pages: DataFrame, key: str = "company_id") -> DataFrame:
    """The address pages as one text: the canonical slugs in their order, then others by slug, cut to FALLBACK_CHARS."""
    rank = F.array_position(F.array(*map(F.lit, V.ADDRESS_SLUGS)), F.col("slug"))
    order = F.when(rank > 0, rank).otherwise(F.lit(len(V.ADDRESS_SLUGS) + 1).cast("long"))
    return _joined(pages.where(T.is_address_intent(F.col("slug"))), key, order, F.col("text"), V.FALLBACK_CHARS)
