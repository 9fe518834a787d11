"""From stage tables to dataset records: joins, gates, lifecycle, guards, summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab as V
from ..functions.canonical import canonical_json


def resolve_websites(seed: DataFrame, hits: DataFrame) -> DataFrame:
    """seed(company_id, name, website) with website found and status: what is given stays, else the hit of the first engine.

    hits(company_id, engine_rank, url). Rows with a blank name fail; only rows that need a search meet the hits.
    """
    named, blank = F.coalesce(F.trim("name") != "", F.lit(False)), F.coalesce(F.trim("website"), F.lit("")) == ""
    best = hits.where("url IS NOT NULL").groupBy("company_id").agg(F.min_by("url", "engine_rank").alias("website"))
    searched = seed.where(named & blank).drop("website").join(best, "company_id", "left")
    given = seed.where(~(named & blank)).withColumn("website", F.when(~blank, F.col("website")))
    d = given.unionByName(searched)
    return d.withColumn("status", F.when(~named | F.col("website").isNull(), "failed"))


def dossier_gate(status: Column, body: Column, offline: bool) -> Column:
    """What becomes of a company before a model is asked; pending rows alone go to one."""
    rest = F.lit("empty" if offline else "pending")
    return F.when(F.coalesce(status, F.lit("")) != "ok", "upstream_failed").when(F.coalesce(F.trim(body), F.lit("")) == "", "empty").otherwise(rest)


def usable(present: Column, status: Column) -> Column:
    """A source counts unless it is missing or says that it failed; no status is no failure."""
    return F.coalesce(present, F.lit(False)) & ~F.coalesce(status.isin(V.FAILURES), F.lit(False))


def assemble(spine: DataFrame, key: str, **sources: DataFrame) -> DataFrame:
    """Left joins of one-row-per-key sources to the spine. Each source(key, status, payload) becomes its payload, null if unusable.

    All joins are on the spine's key, so that they share one partitioning.
    """
    d = spine
    for name, source in sources.items():
        s = source.select(key, F.lit(True).alias("__here"), F.col("status").alias("__status"), F.col("payload").alias("__payload"))
        d = d.join(s, key, "left").withColumn(name, F.when(usable(F.col("__here"), F.col("__status")), F.col("__payload"))).drop("__here", "__status", "__payload")
    return d


def record_status(fact_present: Column, blocks: list[Column]) -> Column:
    some = reduce(lambda a, b: a | b, (b.isNotNull() for b in blocks))
    return F.when(~F.coalesce(fact_present, F.lit(False)), "upstream_failed").when(some, "ok").otherwise("empty")


#: Columns that say when a record was made, not what it says.
TIMESTAMPS = {"created_at", "updated_at"}


def content_hash(d: DataFrame, columns: list[str]) -> Column:
    """SHA-256 of the record as canonical JSON without its timestamps; the same record has the same hash in any run, and outside Spark."""
    return F.sha2(canonical_json(d, [c for c in columns if c not in TIMESTAMPS]), 256)


def lifecycle(records: DataFrame, prior: DataFrame, run_at: str, key: str = "company_id") -> DataFrame:
    """records(key, content_hash) with created_at and updated_at: new now, unchanged as before, or updated now.

    prior(key, created_at, updated_at, content_hash); an incomplete prior row counts as none.
    """
    whole = F.lit(True)
    for c in ("created_at", "updated_at", "content_hash"):
        whole = whole & (F.coalesce(F.col(c), F.lit("")) != "")
    p = prior.where(whole).select(key, F.col("created_at").alias("p_created"), F.col("updated_at").alias("p_updated"), F.col("content_hash").alias("p_hash"))
    d = records.join(p, key, "left")
    state = F.when(F.col("p_hash").isNull(), "created").when(F.col("p_hash") == F.col("content_hash"), "unchanged").otherwise("updated")
    now = F.lit(run_at)
    return d.withColumns({"change": state, "created_at": F.coalesce("p_created", now), "updated_at": F.when(state == "unchanged", F.col("p_updated")).otherwise(now)}).drop("p_created", "p_updated", "p_hash")


def first_seen(*sources: DataFrame, key: str = "company_id") -> DataFrame:
    """Every key of sources(key, name), with the name of the first source that has it."""
    d = reduce(DataFrame.unionByName, (s.select(key, "name", F.lit(i).alias("rank")) for i, s in enumerate(sources)))
    return d.groupBy(key).agg(F.min_by("name", F.struct("rank", "name")).alias("name"))


def pending(upstream: DataFrame, done: DataFrame, key: str = "company_id") -> DataFrame:
    return upstream.join(done.select(key), key, "left_anti")


def duplicate_ids(records: DataFrame, key: str = "company_id") -> DataFrame:
    return records.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def name_collisions(new: DataFrame, existing: DataFrame, key: str = "company_id") -> DataFrame:
    """Keys that exist under another name."""
    e = existing.select(F.col(key), F.col("name").alias("existing_name"))
    return new.select(key, "name").join(e, key).where("NOT (name <=> existing_name)")


def require_none(bad: DataFrame, what: str) -> None:
    if rows := bad.limit(5).collect():
        raise ValueError(f"{what}: {[tuple(r) for r in rows]}")


def status_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("status").agg(F.count("*").alias("n"))


def geocode(asked: DataFrame, reference: DataFrame, key: str = "company_id", broadcast_rows: int = 100_000) -> DataFrame:
    """asked(key, postcode, street_name, house_no, city) to match_quality and the point: by postcode and number, then by street,
    number and city, then by postcode alone. reference(kind, postcode, street, house_no, city, centroid_wkt).

    A row with a null among a tier's keys meets nothing there; it is dealt by its own key, so that such rows don't fill one task."""
    known = reference.where("centroid_wkt IS NOT NULL").withColumns({"street_l": F.lower("street"), "city_l": F.lower("city")})

    def tier(d: DataFrame, kind: str, first: str, rest: list[str], name: str) -> DataFrame:
        t = known.where(F.col("kind") == kind).groupBy(F.col(first).alias("dealt"), *rest).agg(F.min("centroid_wkt").alias(name))
        t = F.broadcast(t) if t.limit(broadcast_rows + 1).count() <= broadcast_rows else t
        whole = reduce(Column.__and__, (F.col(c).isNotNull() for c in (first, *rest)))
        own = F.concat(F.lit("\0"), F.coalesce(F.col(key).cast("string"), F.lit("")))
        return d.withColumn("dealt", F.when(whole, F.col(first)).otherwise(own)).join(t, ["dealt", *rest], "left").drop("dealt")

    d = asked.withColumns({"street_l": F.lower("street_name"), "city_l": F.lower("city")})
    d = tier(d, "adres", "postcode", ["house_no"], "w_exact")
    d = tier(d, "adres", "street_l", ["house_no", "city_l"], "w_street")
    d = tier(d, "postcode", "postcode", [], "w_centre")
    quality = F.when(F.col("w_exact").isNotNull(), "exact").when(F.col("w_street").isNotNull(), "street").when(F.col("w_centre").isNotNull(), "postcode_centroid")
    return d.select(key, quality.alias("match_quality"), F.coalesce("w_exact", "w_street", "w_centre").alias("wkt"))


def translation_targets(tagline: DataFrame, scoring: DataFrame, key: str = "company_id") -> DataFrame:
    """A row per text to translate: key, path, text. tagline(key, status, tagline) and scoring(key, status, scores struct)."""
    ok = F.col("status") == "ok"
    a = tagline.where(ok).select(key, F.lit("tagline").alias("path"), F.col("tagline").alias("text"))
    axes = F.array(*(F.struct(F.lit(f"scores.{x}.reason").alias("path"), F.col(f"scores.{x}.reason").alias("text")) for x in V.AXES))
    b = scoring.where(ok).select(key, F.explode(axes).alias("t")).select(key, "t.path", "t.text")
    return a.unionByName(b).withColumn("text", F.trim("text")).where("text <> ''")


def translation_map(translated: DataFrame, key: str = "company_id") -> DataFrame:
    """(key, path, nl) rows as one map of path to struct(nl) for each key."""
    entry = F.struct(F.col("path"), F.struct(F.col("nl").alias("nl")))
    return translated.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("translations"))


def latest(records: DataFrame, key: str, order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return records.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
