"""Reading seeds, stage tables, dossiers, sitemaps and prompts; writing stage tables and exports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab as V
from ..operators import records as R
from .keyed import shared_dir

SEED = "name STRING, website STRING, notes STRING"


def read_seed(spark: SparkSession, path: str, schema: str = SEED) -> DataFrame:
    """A JSON array of companies, with company_id and their order. Anything but an array is refused."""
    raw = spark.read.text(path, wholetext=True).select(F.trim("value").alias("value"))
    R.require_none(raw.where(~F.col("value").rlike(r"(?s)^\s*\[.*\]\s*$")).select(F.substring("value", 1, 40)), "not a JSON array")
    items = raw.select(F.posexplode(F.from_json("value", f"array<struct<{', '.join(f.replace(' ', ':') for f in schema.split(', '))}>>")).alias("ord", "c"))
    return items.select("ord", "c.*").withColumn("company_id", T.company_id(F.col("name")))


def _settled(d: DataFrame, mode: str) -> DataFrame:
    """d, whose column `corrupt` holds what couldn't be read: those rows left out, marked, or a reason to stop."""
    if mode == "mark":
        return d
    if mode == "raise":
        R.require_none(d.where("corrupt IS NOT NULL").select(F.substring("corrupt", 1, 80)), "records that can't be read")
    elif mode != "skip":
        raise ValueError(f"mode is skip, raise or mark, not {mode}")
    return d.where("corrupt IS NULL").drop("corrupt")


def read_records(spark: SparkSession, path: str, schema: str, mode: str = "skip") -> DataFrame:
    """The records of JSON files, each an object or an array of objects.

    mode: what becomes of text that is neither, or has a value of another type: `skip` leaves it out, `raise` stops with ValueError, `mark` keeps it in a column
    `corrupt`, null for good records.
    """
    whole = spark.read.text(path, wholetext=True)
    items = F.when(F.col("value").rlike(r"^\s*\["), F.from_json("value", "array<string>"))
    return parse_records(whole.select(F.explode(F.coalesce(items, F.array("value"))).alias("text")), schema, mode)


def parse_records(d: DataFrame, schema: str, mode: str = "skip", text: str = "text") -> DataFrame:
    """read_records() for records in a column of text, beside the other columns. Null is corrupt, with an empty text."""
    found = F.from_json(F.col(text), f"{schema}, corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"})
    d = d.withColumn("__r", found).select(*(c for c in d.columns if c != text), "__r.*", F.col(text).alias("__text"))
    whole = F.when(F.col("__text").isNull(), "").otherwise(F.col("corrupt"))
    return _settled(d.withColumn("corrupt", whole).drop("__text"), mode)


def read_dossiers(spark: SparkSession, path: str, named: bool = False) -> DataFrame:
    """Dossier files as (company_id, meta, body). named: those whose front matter has no name are left out."""
    d = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.md$", 1).alias("company_id"), T.parse_frontmatter(F.col("value")).alias("p"))
    d = d.select("company_id", "p.meta", "p.body")
    return d.where(F.trim(F.try_element_at("meta", F.lit("name"))) != "") if named else d


def read_prompt(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()["value"]


def sitemap_url(robots: Column, base: Column) -> Column:
    """The first sitemap that robots.txt names, or the usual place."""
    named = F.regexp_extract(F.coalesce(robots, F.lit("")), r"(?im)^\s*sitemap\s*:\s*(\S+)", 1)
    return F.coalesce(F.nullif(named, F.lit("")), F.concat(base, F.lit("/sitemap.xml")))


def sitemap_locs(xml: Column, root: str, most: int) -> Column:
    """The first locations of a sitemap whose root element is this; no array from anything else, malformed text included."""
    ok = F.coalesce(xml, F.lit("")).rlike(rf"(?s)^\s*(?:<\?xml[^>]*>\s*)?(?:<!--.*?-->\s*)*<(?:\w+:)?{root}[\s>]")
    found = F.transform(F.regexp_extract_all(xml, F.lit(r"(?s)<(?:\w+:)?loc[^>]*>\s*(.*?)\s*</(?:\w+:)?loc>"), F.lit(1)), lambda x: F.replace(x, F.lit("&amp;"), F.lit("&")))
    return F.when(ok, F.slice(found, 1, most)).otherwise(F.array().cast("array<string>"))


def harvest_sitemaps(roots: DataFrame, fetched: DataFrame, key: str = "company_id") -> DataFrame:
    """roots(key, url) to (key, ord, loc): the locations of a urlset, or of an index's first children, one level down. fetched(url, html)."""
    top = roots.join(fetched, "url", "left")
    own = top.select(key, F.lit(0).alias("child"), F.posexplode(sitemap_locs(F.col("html"), "urlset", V.MAX_LOCS)).alias("pos", "loc"))
    kids = top.select(key, F.posexplode(sitemap_locs(F.col("html"), "sitemapindex", V.MAX_SITEMAPS)).alias("child", "url")).join(fetched, "url", "left")
    below = kids.select(key, F.col("child"), F.posexplode(sitemap_locs(F.col("html"), "urlset", V.MAX_LOCS)).alias("pos", "loc"))
    return own.unionByName(below)


def stored(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """df, written as Parquet in a new folder under root or in the shared folder, and read back."""
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}" if root else shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_stage(df: DataFrame, path: str, key: str = "company_id") -> None:
    """Write a stage's table once no key stands for two names."""
    if "name" in df.columns:
        R.require_none(df.where(f"{key} IS NOT NULL").groupBy(key).agg(F.countDistinct("name").alias("names")).where("names > 1"), "one id for several names")
    df.write.mode("overwrite").parquet(path)


def export_json(df: DataFrame, path: str) -> None:
    """One JSON object a line, in the order of the key."""
    df.orderBy("company_id").write.mode("overwrite").option("ignoreNullFields", "false").json(path)
