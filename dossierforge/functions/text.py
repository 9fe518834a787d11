"""Scalar functions on names, URLs and text, as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V
from .letters import plain_letters


def _array(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with the value computed once however often f uses it, as a lambda's variable isn't inlined."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def slugify(c: Column) -> Column:
    """Lower case, letters spelled in a to z (see letters.plain_letters), other characters to single hyphens."""
    c = F.regexp_replace(plain_letters(c), r"(?<=[0-9]),(?=[0-9])", "")
    return F.regexp_replace(F.regexp_replace(c, r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def company_id(name: Column) -> Column:
    """The stable key of a company: its name as a slug, without one entity suffix; null for a blank name."""
    slug = slugify(F.trim(F.regexp_replace(name, V.ENTITY_SUFFIX, "")))
    return F.when(F.trim(name) != "", F.coalesce(F.nullif(slug, F.lit("")), slugify(name)))


_URL = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]+)([^?#]*)"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _URL, 1))


def netloc(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 2)


def url_path(url: Column) -> Column:
    """The path of a URL, / if it has none."""
    return F.coalesce(F.nullif(F.regexp_extract(url, _URL, 3), F.lit("")), F.lit("/"))


def segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def normalize_homepage(url: Column) -> Column:
    """Scheme and host, with a single locale segment if the path is one; null for a URL that isn't absolute."""
    parts = segments(url_path(url))
    locale = (F.size(parts) == 1) & F.element_at(parts, 1).rlike(r"(?i)^[a-z]{2}([-_][a-z]{2})?$")
    return F.when(url.rlike(_URL), F.concat(scheme(url), F.lit("://"), netloc(url), F.lit("/"), F.when(locale, F.element_at(parts, 1)).otherwise(F.lit(""))))


def canonical_base(url: Column) -> Column:
    """The URL without parameters, query and fragment."""
    return F.when(url.rlike(_URL), F.concat(scheme(url), F.lit("://"), netloc(url), F.regexp_replace(url_path(url), ";[^/]*$", "")))


def has_excluded_extension(path: Column) -> Column:
    last = F.substring_index(F.lower(path), "/", -1)
    return last.contains(".") & F.substring_index(last, ".", -1).isin(V.EXCLUDED_EXTENSIONS)


def path_depth(url: Column) -> Column:
    return F.greatest(F.size(segments(url_path(url))), F.lit(1))


def slugify_path(url: Column) -> Column:
    """The slug of a URL's path, or of a path; index for none."""
    path = F.when(url.contains("://"), url_path(url)).otherwise(F.regexp_replace(url, r"[?#].*$", ""))
    path = F.regexp_replace(path, "^/+|/+$", "")
    return F.when(path == "", F.lit("index")).otherwise(slugify(F.replace(path, F.lit("/"), F.lit("-"))))


def is_address_intent(slug: Column) -> Column:
    return bind(F.lower(slug), lambda s: s.rlike("|".join(V.ADDRESS_STEMS)) | F.arrays_overlap(F.split(s, "-"), _array(V.ADDRESS_TOKENS)))


def _tiers() -> dict[str, tuple[int, int]]:
    """Each tier path's (tier, position); a path that is named twice counts where it comes first."""
    found: dict[str, tuple[int, int]] = {}
    for t, tier in enumerate((V.TIER_1, V.TIER_2, V.TIER_3), 1):
        for i, path in enumerate(tier):
            found.setdefault(path, (t, i))
    return found


def _place(tier: int, position: int) -> Column:
    return F.struct(F.lit(tier).alias("tier"), F.lit(position).alias("position"))


def classify(url: Column) -> Column:
    """struct(tier, position) of the first tier path that the path is or lies below; (2, -1) for other address pages; null for the rest.

    The path's starts, cut at a slash, are looked up among the tier paths, one look for each depth that tier paths have."""
    tiers = _tiers()
    places = F.create_map(*(c for p, place in tiers.items() for c in (F.lit(p), _place(*place))))
    depths = sorted({p.count("/") for p in tiers})

    def hit(path: Column) -> Column:
        found = [F.try_element_at(places, F.substring_index(path, "/", d + 1)) for d in depths]
        return F.least(*found) if len(found) > 1 else found[0]

    path = F.regexp_replace(F.lower(url_path(url)), "/+$", "")
    return F.coalesce(bind(path, hit), F.when(is_address_intent(slugify_path(url)), _place(2, V.ADDRESS_POSITION)))


def collapse_lines(text: Column) -> Column:
    """One space for runs of blanks, lines trimmed, empty lines gone."""
    text = F.regexp_replace(text, "[ \\t\\xa0\\r\\f\\x0b]+", " ")
    return F.array_join(F.filter(F.transform(F.split(text, "\n"), F.trim), lambda s: s != ""), "\n")


def detect_language(text: Column) -> Column:
    """nl if over 6 % of the first 400 words are Dutch function words, else en; null without words."""
    words = F.slice(F.regexp_extract_all(F.lower(text), F.lit("[a-zà-ÿ]+"), F.lit(0)), 1, V.LANGUAGE_WORDS)
    dutch = F.size(F.filter(words, lambda w: w.isin(V.DUTCH)))
    return F.when(F.size(words) > 0, F.when(dutch / F.size(words) > V.DUTCH_SHARE, F.lit("nl")).otherwise(F.lit("en")))


def strip_fence(text: Column) -> Column:
    """The inside of a JSON code fence, trimmed."""
    t = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.regexp_replace(t, r"(?s)^```(?:json)?\s*(.*?)\s*```$", "$1")


# fixed values: how a completion's opening remark begins, and the fence around all of it
_REMARK = r"(?i)\A(?:here(?:'s| is)\b|below is\b|sure[,!.:])[^\n]*(?:\n|\z)"
_FENCE = r"(?s)\A```[a-zA-Z]*\s*\n(.*?)\n```\z"


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"\A\s+|\s+\z", "")


def strip_wrapper(text: Column) -> Column:
    """A completion without the line of its opening remark and the fence around it."""
    t = _stripped(F.regexp_replace(_stripped(text), _REMARK, ""))
    return F.when(t.rlike(_FENCE), _stripped(F.regexp_replace(t, _FENCE, "$1"))).otherwise(t)


def frontmatter_name(text: Column) -> Column:
    """The name in a dossier's head, read line by line: a bare null is none, a quoted one is a name; null without a head or a name in it."""
    def read(lines: Column) -> Column:
        ends = F.array_position(F.transform(lines, lambda x: F.trim(x) == "---"), True)
        head = F.when(ends > 0, F.slice(lines, F.lit(1), ends.cast("int"))).otherwise(lines)
        raw = F.trim(F.regexp_replace(F.get(F.filter(head, lambda x: x.startswith("name:")), F.lit(0)), "^name:", ""))
        inside = F.replace(F.replace(F.regexp_extract(raw, r'(?s)\A"(.*)"\z', 1), F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\"))
        return F.when(raw.rlike(r'(?s)\A".*"\z'), inside).when(raw != "null", raw)

    lines = F.split(text, "\n")
    return F.when(text.startswith("---"), bind(F.slice(lines, F.lit(2), F.size(lines)), read))


def quoted(c: Column) -> Column:
    """c between single quotes, or double ones if it holds single and no double quotes; None for null. Backslashes and line breaks are escaped."""
    inside = c
    for a, b in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\xa0", "\\xa0")):
        inside = F.replace(inside, F.lit(a), F.lit(b))
    single = F.concat(F.lit("'"), F.replace(inside, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), inside, F.lit('"'))
    return F.when(c.isNull(), "None").when(c.contains("'") & ~c.contains('"'), double).otherwise(single)


def yaml_scalar(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')))


def render_dossier(fields: dict[str, Column], body: Column) -> Column:
    """Front matter of quoted scalars and the body, ending with a line feed."""
    head = [F.concat(F.lit(f"{k}: "), yaml_scalar(v)) for k, v in fields.items()]
    text = F.concat(F.lit("---\n"), F.concat_ws("\n", *head), F.lit("\n---\n\n"), F.coalesce(body, F.lit("")))
    return F.when(text.endswith("\n"), text).otherwise(F.concat(text, F.lit("\n")))


def parse_frontmatter(text: Column) -> Column:
    """struct(meta map, body) of a dossier; a null scalar, quoted or not, is null."""
    head = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---\n", 1)
    lines = F.filter(F.split(head, "\n"), lambda x: x.contains(":"))

    def scalar(line: Column) -> Column:
        raw = F.trim(F.regexp_replace(line, r"^[^:]*:", ""))
        inner = F.when(raw.rlike(r'(?s)^".*"$'), F.regexp_replace(F.regexp_extract(raw, r'(?s)^"(.*)"$', 1), r'\\(["\\])', "$1")).otherwise(raw)
        return F.when(inner != "null", inner)

    meta = F.map_from_entries(F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)), scalar(x))))
    return F.struct(meta.alias("meta"), F.regexp_replace(F.regexp_replace(text, r"(?s)\A---\n.*?\n---\n", ""), r"^\n+", "").alias("body"))


def valid_postcode(c: Column) -> Column:
    """DDDD LL in upper case, or null."""
    rx = r"^([0-9]{4})\s*([A-Za-z]{2})$"
    t = F.trim(c)
    return F.when(t.rlike(rx), F.concat(F.regexp_extract(t, rx, 1), F.lit(" "), F.upper(F.regexp_extract(t, rx, 2))))


def wkt_point(c: Column) -> Column:
    """struct(lat, lng) of POINT(lng lat), or null."""
    rx = r"(?i)^\s*POINT\s*\(\s*([-+0-9.eE]+)\s+([-+0-9.eE]+)\s*\)\s*$"
    return F.when(c.rlike(rx), F.struct(F.regexp_extract(c, rx, 2).cast("double").alias("lat"), F.regexp_extract(c, rx, 1).cast("double").alias("lng")))


def release_tag(generated_at: Column) -> Column:
    return F.replace(generated_at, F.lit(":"), F.lit("-"))
