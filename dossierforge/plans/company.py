"""The company pipeline from seeds to dataset: every stage as a function of the tables before it, for stages.run."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import address as A
from ..functions import domains as D
from ..functions import text as T
from ..functions import trees as Tr
from ..functions import vocab as V
from ..operators import html as H
from ..operators import records as R
from ..operators import selection as S
from ..operators import validate as N
from ..sources import providers, tables
from ..sources import web as W
from ..sources.keyed import KeyedTable, update_lifecycle
from . import stages

KEY = "company_id"
#: What tables from outside have to hold; an absent table counts as an empty one.
HITS = "company_id string, engine_rank int, url string"
WEB = "url string, html string"  # and, where fetched, final_url, error_kind, and rendered, what a browser made of the page, each a string
ADDRESSES = "kind string, postcode string, street string, house_no int, city string, centroid_wkt string"
LIFECYCLE = "company_id string, created_at string, updated_at string, content_hash string"
#: Sitemap links come after all links of the homepage.
SITEMAP_ORD = 1_000_000


@dataclass
class Outside:
    """What the stages take from outside. Without a completion provider they run offline."""

    seed: DataFrame
    root: str
    run_at: str
    hits: DataFrame | None = None
    web: DataFrame | None = None
    addresses: DataFrame | None = None
    lifecycle: DataFrame | None = None
    complete: Callable[[], Callable[[str], str]] | None = None
    #: A geocoder asked with tier_request(), which answers POINT(lng lat) or nothing; it takes the place of `addresses`.
    locate: Callable[[], Callable[[str], str | None]] | None = None
    #: Search engines by name, in order; they take the place of `hits`.
    engines: Mapping[str, Callable[[], Callable[[str], str | None]]] = field(default_factory=dict)
    retry_after: float = 5.0
    search_gap: float = 1.5
    #: False: nothing is written but answers, and the lifecycle table stays as it is.
    write: bool = True
    prompts: Mapping[str, str] = field(default_factory=dict)

    @property
    def offline(self) -> bool:
        return self.complete is None

    def table(self, name: str, schema: str) -> DataFrame:
        t = getattr(self, name)
        return self.seed.sparkSession.createDataFrame([], schema) if t is None else t

    def ask(self, pending: DataFrame, stage: str, body: Column, prompt: Column | None = None) -> DataFrame:
        """(key, answer, error) of pending rows, written before use, so that a retried task doesn't ask again."""
        path = f"{self.root}/answers/{stage}-{uuid.uuid4().hex}"
        prompt = F.lit(self.prompts.get(stage, "")) if prompt is None else prompt
        request = messages(prompt, F.concat(F.lit(LEADS.get(stage, "")), body))
        providers.run_pending(pending.select(KEY, request.alias("request")), self.complete).write.parquet(path)
        return pending.sparkSession.read.parquet(path)


# fixed values: what stands before the text that a stage asks about
LEADS = {"content-summarization": "Company website content:\n\n", "tagline-extraction": "Company dossier:\n\n", "global-scoring": "Company dossier:\n\n", "tagging": "Company dossier:\n\n"}


def messages(prompt: str | Column, body: Column) -> Column:
    """A chat request as JSON: the prompt, then the text it is about."""
    system = F.lit(prompt) if isinstance(prompt, str) else prompt
    return F.to_json(F.array(F.struct(F.lit("system").alias("role"), system.alias("content")), F.struct(F.lit("user").alias("role"), body.alias("content"))))


def choices(top: Column) -> Column:
    """The candidates of an address, a line each, numbered from 0, their texts quoted."""

    def line(c: Column, i: Column) -> Column:
        fields = {f: c["address"][f] for f in ("street", "postcode", "city")} | {"context": c["snippet"]}
        return F.concat(i.cast("string"), F.lit(": "), F.concat_ws(", ", *(F.concat(F.lit(f"{f}="), T.quoted(x)) for f, x in fields.items())))

    return F.concat(F.lit("Candidates:\n"), F.array_join(F.transform(top, line), "\n"))


def functions(o: Outside) -> dict[str, stages.StageFn]:
    def bind(f):
        return lambda spark, done: f(o, done)

    return {name: bind(f) for name, f in zip(stages.ORDER, (resolution, collection, facts, summaries, geocoding, taglines, scoring, tagging, translation, dataset), strict=True)}


def run(spark: SparkSession, o: Outside, resume: bool = False) -> dict[str, DataFrame]:
    return stages.run(spark, o.root, functions(o), resume)


def resolution(o: Outside, done: Mapping[str, DataFrame]) -> DataFrame:
    """website, status and error of each company: what the seed gives, else the table of hits, or the first engine with a hit."""
    if not o.engines:
        return R.resolve_websites(o.seed, o.table("hits", HITS)).where(F.col(KEY).isNotNull())
    named = F.coalesce(F.trim("name") != "", F.lit(False))
    asked = o.seed.where(named & (F.coalesce(F.trim("website"), F.lit("")) == "")).groupBy(KEY).agg(F.min("name").alias("query"))
    found = W.search_chain(asked, list(o.engines.items()), KEY, o.retry_after, o.search_gap, path=f"{o.root}/answers")
    hits = found.select(KEY, F.lit(1).alias("engine_rank"), F.col("website").alias("url"))
    errors = found.where("error IS NOT NULL").select(KEY, F.concat(F.lit("search backend error: "), "error").alias("error"))
    d = R.resolve_websites(o.seed, hits).where(F.col(KEY).isNotNull()).join(errors, KEY, "left")
    return d.withColumn("error", F.when(F.col("status") == "failed", F.coalesce("error", F.lit("no search results"))))


# ---------------------------------------------------------------- websites


def site_links(sites: DataFrame, home: DataFrame, web: DataFrame) -> DataFrame:
    """(key, homepage, link, ord): the homepage's internal links in order, then those of the sitemap that the homepage lacks."""
    own = H.internal_links(home, "homepage", KEY).select(KEY, "link", F.col("pos").cast("long").alias("ord"))
    origin = F.regexp_extract("homepage", r"^([^:]+://[^/?#]+)", 1)
    robots = web.select(F.col("url").alias("robots_url"), F.col("html").alias("robots"))
    roots = sites.withColumns({"origin": origin, "robots_url": F.concat(origin, F.lit("/robots.txt"))}).join(robots, "robots_url", "left")
    locs = tables.harvest_sitemaps(roots.select(KEY, tables.sitemap_url(F.col("robots"), F.col("origin")).alias("url")), web, KEY)
    named = locs.join(sites.select(KEY, "homepage"), KEY).where(F.col("loc").rlike("(?i)^https?://") & (F.col("loc") != F.col("homepage")))
    named = named.where((D.registered_domain(F.col("loc")) == D.registered_domain(F.col("homepage"))) & ~T.has_excluded_extension(T.url_path(F.col("loc"))))
    named = named.select(KEY, F.col("loc").alias("link"), (F.lit(SITEMAP_ORD) * (1 + F.col("child")) + F.col("pos")).cast("long").alias("ord"))
    pool = own.unionByName(named).groupBy(KEY, "link").agg(F.min("ord").alias("ord"))
    return pool.join(sites.select(KEY, "homepage"), KEY)


def collection(o: Outside, done: Mapping[str, DataFrame]) -> DataFrame:
    """A row per company: status, pages_collected, footer and structured text and icon of the homepage, and pages with their surfaces."""
    web = o.table("web", WEB)
    given = {c: F.col(c) if c in web.columns else F.lit(None).cast("string") for c in ("final_url", "error_kind", "rendered")}
    web = web.select("url", "html", *(c.alias(n) for n, c in given.items()))
    found = done["website-resolution"].select(KEY, "name", "website")
    sites = found.withColumn("homepage", T.normalize_homepage(F.trim("website"))).where(F.col("homepage").isNotNull() & (F.trim("website") != ""))
    moved = F.coalesce(T.canonical_base(F.col("final_url")), F.col("homepage"))  # where redirects ended is the base of all else
    home = sites.select(KEY, "homepage").join(web.withColumnRenamed("url", "homepage"), "homepage").where("html IS NOT NULL OR rendered IS NOT NULL")
    # a homepage that can't be fetched, or has no links of its own, is taken as a browser shows it, and so are the site's other pages
    bare = F.col("html").isNull() | ~F.coalesce(F.col("html"), F.lit("")).rlike(r"(?is)<a\s[^>]*href")
    home = home.withColumn("js_site", bare & F.col("rendered").isNotNull()).withColumn("html", F.when(F.col("js_site"), F.col("rendered")).otherwise(F.col("html"))).where("html IS NOT NULL")
    home = home.select(KEY, "js_site", F.col("homepage").alias("asked"), moved.alias("homepage"), H.read_page("html").alias("page"))
    picked = S.select_urls(site_links(home.select(KEY, "homepage"), home, web), KEY)
    alone = F.array(F.struct(F.col("homepage").alias("url"), F.lit("index").alias("slug")))
    chosen = home.select(KEY, "homepage", "asked", "js_site").join(picked, KEY, "left").select(KEY, "asked", "js_site", F.coalesce("collisions", F.array().cast("array<struct<url:string,slug:string>>")).alias("collisions"), F.posexplode(F.coalesce("selected", alone)).alias("ord", "s"))
    chosen = chosen.select(KEY, "ord", "js_site", F.col("s.url").alias("page_url"), "s.slug", "collisions", F.when(F.col("ord") == 0, F.col("asked")).otherwise(F.col("s.url")).alias("url"))
    html = F.when(F.col("js_site"), F.col("rendered")).otherwise(F.col("html"))
    read = chosen.join(web, "url", "left").drop("url").withColumnRenamed("page_url", "url").withColumn("html", html).drop("rendered").select("*", H.read_page("html").alias("p"))
    intent = T.is_address_intent(F.col("slug"))
    thick = F.coalesce(F.length("p.markdown") >= V.THIN_CHARS, F.lit(False))
    state = F.when(F.col("html").isNull(), "error").when(thick, "written").otherwise("dropped_thin")
    page = F.struct(
        "ord", "slug", "url", state.alias("status"), F.when(thick, F.col("p.markdown")).alias("precision"),
        F.when(intent, F.nullif(F.trim("p.recall"), F.lit(""))).alias("recall"), F.when(intent, F.nullif(F.trim("p.visible_text"), F.lit(""))).alias("visible"),
        F.when(thick, F.struct("p.title", "p.description", "p.sitename")).alias("meta"), F.when(F.col("html").isNull(), F.col("error_kind")).alias("error_kind"),
    )
    index = F.col("ord") == 0
    icons = F.transform(F.col("p.icons"), lambda x, i: F.struct(H.favicon_rank(x["rel"], x["sizes"], i).alias("rank"), x["href"].alias("href")))
    best = F.get(F.array_sort(icons), F.lit(0))["href"]
    got = read.groupBy(KEY).agg(
        F.array_sort(F.collect_list(page)).alias("pages"), F.bool_or("js_site").alias("js_site"), F.first("collisions").alias("collisions"),
        F.max(F.when(index, F.col("p.footer_text"))).alias("footer_text"), F.max(F.when(index, F.col("p.structured_text"))).alias("structured_text"),
        F.max(F.when(index, F.coalesce(best, F.lit("/favicon.ico")))).alias("icon"), F.max(F.when(index, F.col("p.base"))).alias("icon_base"),
    )
    base = sites.select(KEY, "homepage").join(home.select(KEY, F.col("homepage").alias("moved")), KEY, "left").select(KEY, F.coalesce("moved", "homepage").alias("homepage"))
    d = found.join(base, KEY, "left").join(got, KEY, "left")
    texts = F.filter(F.col("pages.precision"), lambda x: x.isNotNull())
    n = F.when(F.col("pages").isNull(), 0).otherwise(F.size(texts))
    chars = F.aggregate(texts, F.lit(0), lambda a, x: a + F.length(x))
    status = F.when(F.coalesce(F.trim("website"), F.lit("")) == "", "upstream_failed").when((n >= V.MIN_PAGES) | ((n >= 1) & (chars >= V.SUBSTANTIAL_CHARS)), "ok").when(n >= 1, "thin").otherwise("fetch_failed")
    icon = H.absolute(F.col("icon_base"), F.col("homepage"), F.when(F.col("icon").isNotNull(), F.array("icon")))
    return d.select(KEY, "name", "website", status.alias("status"), n.alias("pages_collected"), F.col("homepage").alias("canonical_homepage_url"), "footer_text", "structured_text", F.try_element_at(icon, F.lit(1)).alias("favicon_url"), F.coalesce("js_site", F.lit(False)).alias("js_site"), "pages", "collisions")


# ---------------------------------------------------------------- facts


def surfaces(content: DataFrame) -> DataFrame:
    """(key, slug, kind, text) of all collected surfaces."""
    p = content.select(KEY, F.explode("pages").alias("p"))
    each = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"p.{k}").alias("text")) for k in ("precision", "recall", "visible")))
    return p.select(KEY, "p.slug", F.explode(each).alias("s")).select(KEY, "slug", "s.kind", "s.text").where("text IS NOT NULL")


def facts(o: Outside, done: Mapping[str, DataFrame]) -> DataFrame:
    """status, address and source of each company. Online, what the candidates leave open is asked: which of five, or an address in the address pages' text."""
    content = done["content-collection"]
    all_ = surfaces(content)
    merged = S.merged_surfaces(all_, KEY)
    parts = [content.select(KEY, F.lit(k).alias("surface"), F.lit("").alias("ord"), F.col(f"{k}_text").alias("text")) for k in ("structured", "footer")]
    parts.append(merged.select(KEY, F.lit("body").alias("surface"), F.concat(F.when(F.col("recall_only"), "1").otherwise("0"), "slug").alias("ord"), "text"))
    parts.append(all_.where("kind = 'visible'").select(KEY, F.lit("body").alias("surface"), F.concat(F.lit("2"), "slug").alias("ord"), "text"))
    pool = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    found = A.candidates(pool.where("text IS NOT NULL"), KEY)
    d = A.decide(found, content.select(KEY, F.col("status").alias("upstream")), KEY, o.offline)
    if not o.offline:
        d = _choose(o, d, A.ranked(found, KEY).where("rank <= 5"), S.fallback_surface(merged, KEY))
    return content.select(KEY, "name", "website", "favicon_url").join(d, KEY).select(KEY, "name", "website", "status", "address", "source", "favicon_url")


def _choose(o: Outside, d: DataFrame, top: DataFrame, fallback: DataFrame) -> DataFrame:
    one = F.struct("rank", F.struct("street", "postcode", "city", "country").alias("address"), "snippet")
    listed = top.groupBy(KEY).agg(F.array_sort(F.collect_list(one)).alias("top"))
    d = d.join(listed, KEY, "left").join(fallback, KEY, "left")
    blank = F.coalesce(F.trim("body"), F.lit("")) == ""
    d = d.withColumn("status", F.when((F.col("status") == "pending_fallback") & blank, "empty").otherwise(F.col("status")))
    waiting = d.where("status LIKE 'pending%'")
    choose = F.col("status") == "pending_choice"
    text = F.when(choose, choices(F.col("top"))).otherwise(F.concat(F.lit("Text:\n"), F.col("body")))
    usual = o.prompts.get("fact-extraction", "")
    prompt = F.when(choose, o.prompts.get("fact-extraction-choice", usual)).otherwise(o.prompts.get("fact-extraction-fallback", usual))
    d = d.join(o.ask(waiting, "fact-extraction", text, prompt), KEY, "left")
    v = N.parse(F.col("answer"))
    whole = F.schema_of_variant(F.try_variant_get(v, "$.hq_index", "variant")) == "BIGINT"
    pick = F.when(whole, F.try_variant_get(v, "$.hq_index", "int"))
    hit = F.when((pick >= 0) & (pick < F.size("top")), F.get("top", pick))
    address = F.struct(N.text_at(v, "$.street").alias("street"), T.valid_postcode(F.try_variant_get(v, "$.postcode", "string")).alias("postcode"), N.text_at(v, "$.city").alias("city"), N.text_at(v, "$.country").alias("country"))
    some = address["postcode"].isNotNull() | address["city"].isNotNull()
    choice, fall = F.col("status") == "pending_choice", F.col("status") == "pending_fallback"
    failed = (choice | fall) & (F.col("error").isNotNull() | v.isNull())
    return d.select(
        KEY,
        F.when(failed, "llm_error").when(choice & hit.isNotNull(), "regex_disambiguated").when(fall & some, "llm_fallback").when(choice | fall, "empty").otherwise(F.col("status")).alias("status"),
        F.when(choice, hit["address"]).when(fall & some, address).otherwise(F.col("address")).alias("address"),
        F.when(choice, hit["snippet"]).otherwise(F.col("source")).alias("source"),
    )


#: Tiers of a geocoder, what each needs of an address, and how it is asked.
TIERS = {"exact": ["postcode", "house_no"], "street": ["street_name", "house_no", "city"], "postcode_centroid": ["postcode"]}


def tier_request(tier: str) -> Column:
    """What a geocoder is asked in a tier, as JSON; null where the address lacks what the tier needs."""
    needs = F.lit(True)
    for c in TIERS[tier]:
        needs = needs & F.col(c).isNotNull()
    return F.when(needs, F.to_json(F.struct(F.lit(tier).alias("tier"), *(F.col(c) for c in TIERS[tier]))))


def geocoding(o: Outside, done: Mapping[str, DataFrame]) -> DataFrame:
    """status, latlng and match_quality of each company: from the table of addresses, or else tier by tier from a geocoder. A failed lookup, or a point that can't be read, is a lookup_error."""
    d = done["fact-extraction"].select(KEY, "name", F.col("status").alias("fact"), A.prepare(F.col("address.street"), F.col("address.postcode"), F.col("address.city"), F.col("address.country")).alias("p"))
    open_ = d.where(F.col("fact").isin(V.FACT_SUCCESS) & F.col("p.skip_reason").isNull()).select(KEY, "p.*")
    if o.locate is None:
        g = R.geocode(open_, o.table("addresses", ADDRESSES), KEY).withColumn("failed", F.lit(None).cast("string"))
    else:
        steps = [(t, o.locate, tier_request(t)) for t in TIERS]
        g = W.fall_through(open_, steps, KEY, attempts=1, path=f"{o.root}/answers").select(KEY, F.col("step").alias("match_quality"), F.col("answer").alias("wkt"), F.col("error").alias("failed"))
    g = g.withColumn("point", T.wkt_point(F.col("wkt")))
    odd = F.col("failed").isNotNull() | F.col("wkt").isNotNull() & F.coalesce(F.col("point.lat").isNull() | F.col("point.lng").isNull(), F.lit(True))
    status = F.when(~F.col("fact").isin(V.FACT_SUCCESS), "upstream_failed").when(odd, "lookup_error").when(F.col("point").isNotNull(), "ok").otherwise("empty")
    ok = F.col("status") == "ok"
    d = d.join(g, KEY, "left").withColumn("status", status)
    return d.select(KEY, "name", "status", F.when(ok, F.struct("point.lat", "point.lng")).alias("latlng"), F.when(ok, F.col("match_quality")).otherwise("none").alias("match_quality"), "p.skip_reason")


# ---------------------------------------------------------------- texts


def summaries(o: Outside, done: Mapping[str, DataFrame]) -> DataFrame:
    """The dossier of each company, written from its pages' precision text."""
    content = done["content-collection"]
    pages = surfaces(content).where("kind = 'precision'").select(KEY, "slug", "text")
    d = content.select(KEY, "name", "website", F.col("status").alias("upstream")).join(S.dossier_input(pages, KEY), KEY, "left")
    usable = F.when(F.col("upstream").isin("upstream_failed", "fetch_failed"), "upstream_failed").otherwise("ok")
    d = d.withColumns({"status": R.dossier_gate(usable, F.col("body"), o.offline), "source_language": T.detect_language(F.col("body"))})
    return _asked(o, d, "content-summarization", lambda a: F.nullif(F.trim(T.strip_wrapper(a)), F.lit("")), "dossier").select(KEY, "name", "website", "status", "source_language", F.col("dossier").alias("body"))


def _asked(o: Outside, d: DataFrame, stage: str, parse: Callable[[Column], Column], name: str) -> DataFrame:
    """d(key, status, body) with the parsed answer under name; pending rows become ok, or llm_error where there is no valid answer."""
    if o.offline:
        never = d.sparkSession.createDataFrame([], f"{KEY} string, answer string, error string")
        return d.join(never, KEY, "left").withColumn(name, parse(F.col("answer"))).drop("answer", "error")
    d = d.join(o.ask(d.where("status = 'pending'"), stage, F.col("body")), KEY, "left").withColumn(name, parse(F.col("answer")))
    status = F.when(F.col("status") != "pending", F.col("status")).when(F.col(name).isNotNull(), "ok").otherwise("llm_error")
    return d.withColumn("status", status).drop("answer", "error")


def _from_dossier(o: Outside, done: Mapping[str, DataFrame], stage: str, parse: Callable[[Column], Column], name: str) -> DataFrame:
    d = done["content-summarization"].select(KEY, "name", "website", "status", "body")
    d = d.withColumn("status", R.dossier_gate(F.col("status"), F.col("body"), o.offline))
    return _asked(o, d, stage, parse, name).select(KEY, "name", "website", "status", name)


def taglines(o: Outside, done: Mapping[str, DataFrame]) -> DataFrame:
    return _from_dossier(o, done, "tagline-extraction", N.tagline, "tagline")


def scoring(o: Outside, done: Mapping[str, DataFrame]) -> DataFrame:
    return _from_dossier(o, done, "global-scoring", N.scores, "scores")


def tagging(o: Outside, done: Mapping[str, DataFrame]) -> DataFrame:
    return _from_dossier(o, done, "tagging", N.tags, "capability_tags")


def translation(o: Outside, done: Mapping[str, DataFrame]) -> DataFrame:
    """Map of path to Dutch text for the tagline and the reasons of the scores."""
    line, scored = done["tagline-extraction"], done["global-scoring"]
    targets = R.translation_targets(line, scored, KEY).groupBy(KEY).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("path", "text")))).alias("targets"))
    d = R.first_seen(line, scored, key=KEY).join(targets, KEY, "left").withColumns({"keys": F.map_keys("targets"), "body": F.to_json("targets")})
    d = d.withColumn("status", R.dossier_gate(F.when(F.col("targets").isNull(), "upstream_failed").otherwise("ok"), F.col("body"), o.offline))
    d = _asked(o, d, "translation", lambda a: N.translations(a, F.col("keys")), "translations")
    return d.select(KEY, "name", "status", F.transform_values("translations", lambda _, v: F.struct(v.alias("nl"))).alias("translations"))


def dataset(o: Outside, done: Mapping[str, DataFrame]) -> DataFrame:
    """The records: one row per company of the fact stage with what each stage found, texts in a tree for each language, its hash and when it was made and changed."""
    fact = done["fact-extraction"].select(KEY, "name", "website", "favicon_url", "address")
    payload = {"line": ("tagline-extraction", "tagline"), "scored": ("global-scoring", "scores"), "tagged": ("tagging", "capability_tags"), "translated": ("translation", "translations")}
    sources = {k: done[s].select(KEY, "status", F.struct(F.col(c).alias("of")).alias("payload")) for k, (s, c) in payload.items()}
    sources["located"] = done["geocoding"].where("status = 'ok'").select(KEY, "status", F.struct("latlng", "match_quality").alias("payload"))
    d = R.assemble(fact, KEY, **sources)
    has = {k: F.col(k).isNotNull() for k in sources}
    pinned = F.col("located.latlng").isNotNull() & F.col("located.match_quality").isNotNull()
    some_address = F.coalesce(*(F.nullif(F.col(f"address.{f}"), F.lit("")) for f in ("street", "postcode", "city", "country"))).isNotNull()
    blocks = {
        "address": F.when(some_address, F.col("address")),
        "latlng": F.when(pinned, F.col("located.latlng")),
        "match_quality": F.when(pinned, F.col("located.match_quality")),
        "scores": F.when(has["scored"], Tr.scores_block(F.col("scored.of"))),
        "capability_tags": F.col("tagged.of"),
        "en": Tr.english(has["line"], F.col("line.of"), has["scored"], F.col("scored.of")),
        "nl": Tr.dutch(has["translated"], F.col("translated.of"), has["scored"]),
    }
    d = d.select(KEY, "name", "website", "favicon_url", *(c.alias(n) for n, c in blocks.items()))
    status = R.record_status(F.lit(True), [F.col(c) for c in blocks if c != "match_quality"])
    d = d.select(KEY, "name", "website", "favicon_url", status.alias("status"), *blocks)
    d = d.withColumn("content_hash", R.content_hash(d, d.columns))
    return R.lifecycle(d, lifecycle_state(o, d), o.run_at, KEY).drop("change")


def lifecycle_state(o: Outside, records: DataFrame) -> DataFrame:
    """What is known of when records were made and changed: the table under the root, which starts as the one from outside and takes this run's changes.

    It is updated before the records are written. If the run dies between, the next one finds its records unchanged since this run, as they are.
    """
    t = KeyedTable(records.sparkSession, f"{o.root}/lifecycle", KEY, name=None)
    given = o.table("lifecycle", LIFECYCLE)
    if not o.write:
        return t.read() if t.exists() else given
    if not t.exists():
        t.upsert(given)
    update_lifecycle(t, records.select(KEY, "content_hash"), o.run_at)
    t.vacuum()
    return t.read()
