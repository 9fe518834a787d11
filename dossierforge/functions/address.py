"""Postal addresses in text: postcodes with their context, streets, cities and hints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import vocab as V
from .entities import unescape

POSTCODE = "(?<![A-Za-z0-9@])[0-9]{4}[ \\t\\xa0]*[A-Z]{2}(?![A-Za-z0-9.])"
_BLANK = "[ \\t\\r\\xa0]"


def _any_of(words: list[str]) -> str:
    return "|".join(w.replace(".", "[.]") for w in words)


def city_after(after: Column) -> Column:
    """The city in the text behind a postcode, or null."""
    c = F.regexp_replace(unescape(after), "^[ \\t\\r\\xa0,\\n|]+", "")
    c = F.regexp_replace(c, "(?s)[\\n,|()•·;:–—\\t].*$", "")
    c = F.regexp_replace(c, r"(?is)\b(kvk|btw|vat|tel|telefoon|phone|fax|e-?mail|©|copyright)\b.*$", "")
    c = F.regexp_replace(c, r"(?i)\s*(the\s+netherlands|netherlands|nederland)\s*$", "")
    return F.nullif(F.regexp_replace(c, "^[ \\t\\r\\xa0.\\-]+|[ \\t\\r\\xa0.\\-]+$", ""), F.lit(""))


def city_before(before: Column) -> Column:
    """The city above the street line, where that line has a number and the one above reads like a place."""
    lines = F.filter(F.transform(F.split(before, "\n"), lambda x: F.regexp_replace(x, f"^{_BLANK}+|{_BLANK}+$", "")), lambda x: x != "")
    street, city = F.get(lines, F.size(lines) - 1), F.get(lines, F.size(lines) - 2)
    fine = (F.size(lines) >= 2) & street.rlike("[0-9]") & city.rlike("^[A-Za-zÀ-ÿ'’.\\- ]{2,40}$")
    return F.when(fine, city)


def street_before(before: Column) -> Column:
    """The street in the text before a postcode: what follows its last line feed, or else its last bar."""
    c = F.regexp_replace(before, "[ \\t\\r\\n\\xa0,|]+$", "")
    c = F.when(c.contains("\n"), F.substring_index(c, "\n", -1)).otherwise(F.substring_index(c, "|", -1))
    return F.nullif(F.regexp_replace(c, f"^{_BLANK}+|{_BLANK}+$", ""), F.lit(""))


def is_postbus(street: Column) -> Column:
    return F.coalesce(street.rlike(r"(?i)^(postbus|p\.o\.\s*box|pb\.?)\b"), F.lit(False))


def candidates(surfaces: DataFrame, key: str = "company_id") -> DataFrame:
    """surfaces(key, surface, ord, text) to a row per postcode found, post boxes left out.

    surface is structured, footer or body; ord orders the surfaces of one kind. Text without a postcode gives no row.
    """
    d = surfaces.withColumns({"found": F.regexp_extract_all("text", F.lit(POSTCODE), F.lit(0)), "gaps": F.split("text", POSTCODE, -1)}).where(F.size("found") > 0)
    d = d.select(key, "surface", "ord", "text", "found", "gaps", F.posexplode("found").alias("i", "match"))

    def length(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0), lambda a, x: a + F.length(x))

    d = d.withColumn("start", length(F.slice("gaps", F.lit(1), F.col("i") + 1)) + length(F.slice("found", F.lit(1), F.col("i")))).drop("found", "gaps")
    before = F.expr(f"substring(text, greatest(start - {V.CONTEXT_BEFORE}, 0) + 1, least(start, {V.CONTEXT_BEFORE}))")
    after = F.expr(f"substring(text, start + length(match) + 1, {V.CONTEXT_AFTER})")
    near = F.lower(F.concat(
        F.substring_index(F.expr(f"substring(text, greatest(start - {V.HINT_WINDOW}, 0) + 1, least(start, {V.HINT_WINDOW}))"), "\n", -1),
        F.col("match"),
        F.substring_index(F.expr(f"substring(text, start + length(match) + 1, {V.HINT_WINDOW})"), "\n", 1),
    ))
    d = d.withColumns({"before": before, "after": after, "near": near})
    d = d.withColumns({
        "postcode": F.concat(F.substring("match", 1, 4), F.lit(" "), F.regexp_extract("match", "([A-Z]{2})$", 1)),
        "street": street_before(F.col("before")),
        "city": F.coalesce(city_after(F.col("after")), city_before(F.col("before"))),
        "boost": F.col("near").rlike(_any_of(V.BOOST_HINTS)),
        "demote": F.col("near").rlike(_any_of(V.DEMOTE_HINTS)),
        "snippet": F.substring(F.trim(F.concat("before", "match", "after")), 1, V.SNIPPET),
        "country": F.lit("NL"),
    })
    return d.where(~is_postbus(F.col("street"))).select(key, "surface", "ord", "i", "street", "postcode", "city", "country", "boost", "demote", "snippet")


def ranked(found: DataFrame, key: str = "company_id") -> DataFrame:
    """Candidates with rank from 1: boosted, plain, demoted; structured, footer, body; then in the order found."""
    hint = F.when(F.col("boost"), 0).when(F.col("demote"), 2).otherwise(1)
    kind = F.when(F.col("surface") == "structured", 0).when(F.col("surface") == "footer", 1).otherwise(2)
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(hint, kind, "ord", "i")))


def decide(found: DataFrame, spine: DataFrame, key: str = "company_id", offline: bool = True) -> DataFrame:
    """status and address of every key of spine(key, upstream): one candidate or one boosted decides; offline, any boost takes the
    first in rank and else nothing; otherwise `pending` rows wait for a completion over the first five."""
    r = ranked(found, key)
    first = F.struct("street", "postcode", "city", "country")
    sums = r.groupBy(key).agg(F.count("*").alias("n"), F.sum(F.col("boost").cast("int")).alias("boosted"), F.min_by(first, "rank").alias("best"), F.min_by("snippet", "rank").alias("snippet"))
    d = spine.join(sums, key, "left")
    n, boosted = F.coalesce("n", F.lit(0)), F.coalesce("boosted", F.lit(0))
    status = (
        F.when(F.col("upstream").isin("upstream_failed", "fetch_failed"), "upstream_failed")
        .when(n == 0, "empty" if offline else "pending_fallback")
        .when((n == 1) | (boosted == 1), "regex_single")
        .when(F.lit(offline) & (boosted > 0), "regex_disambiguated")
        .otherwise("empty" if offline else "pending_choice")
    )
    d = d.withColumn("status", status)
    done = F.col("status").isin(*V.FACT_SUCCESS)
    return d.select(key, "status", F.when(done, F.col("best")).alias("address"), F.when(done, F.substring("snippet", 1, V.SNIPPET)).alias("source"))


def prepare(street: Column, postcode: Column, city: Column, country: Column) -> Column:
    """struct(skip_reason, postcode, street_name, house_no, city) for a geocoder."""
    number = F.regexp_extract(street, "([0-9]+)", 1)
    name = F.nullif(F.trim(F.regexp_extract(street, "^([^0-9]*)[0-9]", 1)), F.lit(""))
    skip = F.when(F.coalesce(country, F.lit("NL")) != "NL", "non_nl").when(F.coalesce(F.nullif(F.trim(postcode), F.lit("")), F.nullif(F.trim(city), F.lit(""))).isNull(), "no_anchor")
    return F.struct(
        skip.alias("skip_reason"),
        F.nullif(F.regexp_replace(postcode, r"\s+", ""), F.lit("")).alias("postcode"),
        F.when(number != "", name).alias("street_name"),
        F.when(number != "", number.cast("int")).alias("house_no"),
        F.nullif(F.trim(city), F.lit("")).alias("city"),
    )
