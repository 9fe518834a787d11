import pytest
from pyspark.sql import functions as F

from dossierforge.operators import html as H
from dossierforge.operators import records as R
from dossierforge.operators import selection as S
from dossierforge.operators import validate as N
from dossierforge.sources import providers, tables
from dossierforge.sources.keyed import KeyedTable, update_lifecycle
from dossierforge.streaming.lifecycle import merge_stream

PAGE = """<html><head><title>T &amp; x</title><meta name="description" content="d"><link rel="shortcut icon" href="/a.ico" sizes="192x192"><link rel="apple-touch-icon" href="/b.png" sizes="192x192">
<script type="application/ld+json">{"@type": "PostalAddress", "streetAddress": "Laan 1", "postalCode": "1234 AB", "addressLocality": "Ede"}</script></head>
<body><nav><a href="/about?x=1">About</a><a href="https://other.nl/">o</a><a href="/about">again</a><a href="file.pdf">f</a><a href="mailto:x@y.nl">m</a></nav><p>Some text that is long enough, really.</p>
<footer>One<script>no</script> &copy;<br>two</footer><footer><a>LinkedIn</a><a>X</a></footer></body></html>"""


@pytest.fixture(scope="module")
def page(spark):
    return spark.createDataFrame([(1, "https://www.acme.nl/", PAGE), (2, "https://acme.nl/", None), (3, "https://acme.nl/", "<p>open <b")], "page_id long, url string, html string").withColumn("page", H.read_page("html"))


def test_page(page):
    r = page.where("page_id = 1").first()["page"]
    assert (r["title"], r["description"], r["structured_text"]) == ("T & x", "d", "Laan 1, 1234 AB, Ede")
    assert r["footer_text"] == "One ©\ntwo\nLinkedInX"
    assert "Some text" in r["markdown"] and "About" not in r["markdown"]
    assert page.where("page_id = 2").first()["page"]["visible_text"] is None


def test_links_and_favicon(page):
    assert [(r["pos"], r["link"]) for r in H.internal_links(page).where("page_id = 1").collect()] == [(0, "https://www.acme.nl/about")]
    icons = page.select("page_id", F.posexplode("page.icons").alias("pos", "icon")).select("page_id", "pos", "icon.*")
    assert [r["favicon_url"] for r in H.best_favicon(icons, "page_id").collect()] == ["/b.png"]


def greedy(links):
    """The selection told again, a step at a time."""
    from dossierforge.functions import vocab as V

    def cls(p):
        for t, tier in enumerate((V.TIER_1, V.TIER_2, V.TIER_3), 1):
            for i, x in enumerate(tier):
                if p == x or p.startswith(x + "/"):
                    return t, i
        slug = p.strip("/").replace("/", "-")
        return (2, -1) if any(s in slug for s in V.ADDRESS_STEMS) or set(slug.split("-")) & set(V.ADDRESS_TOKENS) else (4, 0)

    items = sorted((cls(p)[0], p.count("/"), cls(p)[1], i, p) for i, p in enumerate(links))
    chosen, clash, used = ["index"], [], {}
    for t, _, pos, _, p in items:
        slug = p.strip("/").replace("/", "-")
        if t <= 2:
            if len(chosen) >= V.MAX_URLS or pos != -1 and used.get((t, pos), 0) >= V.PREFIX_CAP:
                continue
        elif len(chosen) >= V.MIN_PAGES:
            continue
        if slug in chosen:
            clash.append(p)
            continue
        chosen.append(slug)
        if t <= 2 and pos != -1:
            used[t, pos] = used.get((t, pos), 0) + 1
    return chosen, clash


@pytest.mark.parametrize("links", [
    ["/blog", "/platform/a", "/platform/b", "/platform/c", "/about", "/about/", "/contact", "/support-contact", "/x/y", "/team"],
    ["/learn/roadmaps", "/learn"], [], ["/news", "/updates", "/blog"], [f"/platform/{i}" for i in range(9)] + ["/diensten", "/cases/a-b", "/cases/a/b"],
])
def test_select_urls(spark, links):
    d = spark.createDataFrame([("c", "https://h.nl/", f"https://h.nl{p}", i) for i, p in enumerate(links)], "company_id string, homepage string, link string, ord int")
    got = S.select_urls(d).collect()
    if not links:
        assert got == []
        return
    chosen, clash = greedy(links)
    assert [x["slug"] for x in got[0]["selected"]] == chosen
    assert [x["url"] for x in got[0]["collisions"]] == [f"https://h.nl{p}" for p in clash]


def test_scores_and_tags(spark):
    axes = ["substance", "ecology", "power", "embeddedness", "posture"]

    def answer(score, evidence, wrap=False, drop=None):
        body = ", ".join(f'"{a}": {{"score": {score if a == "power" else 50}, "evidence": "{evidence if a == "power" else "partial"}", "reason": {{"en": "r"}}}}' for a in axes if a != drop)
        return f'{{"scores": {{{body}}}}}' if wrap else f"```json\n{{{body}}}\n```"

    cases = [(answer(60, "no_signal"), (60, "partial")), (answer("null", "partial", True), (None, "no_signal")), (answer("70.0", "partial"), (70, "partial")), (answer("true", "partial"), None), (answer(101, "partial"), None), (answer(5, "odd"), None), (answer(5, "partial", drop="posture"), None), ("no", None)]
    d = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, a string").select("i", N.scores(F.col("a")).alias("s")).orderBy("i").collect()
    assert [r["s"] and (r["s"]["power"]["score"], r["s"]["power"]["evidence"]) for r in d] == [w for _, w in cases]
    t = [("[]", 0), ('[{"isco_code": "011", "prominence": "core", "confidence": "low"}]', 1), ('[{"isco_code": 11, "prominence": "core", "confidence": "low"}]', None), ('[{"isco_code": "011", "prominence": "core"}]', None), ("{}", None)]
    got = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(t)], "i int, a string").select("i", N.tags(F.col("a")).alias("x")).orderBy("i").collect()
    assert [None if r["x"] is None else len(r["x"]) for r in got] == [n for _, n in t]


def test_records_and_guards(spark):
    spine = spark.createDataFrame([("a",), ("b",), ("c",)], "company_id string")
    source = spark.createDataFrame([("a", "ok", "x"), ("b", "empty", "y"), ("c", None, "z")], "company_id string, status string, payload string")
    assert {r[0]: r[1] for r in R.assemble(spine, "company_id", tagline=source).collect()} == {"a": "x", "b": None, "c": "z"}
    with pytest.raises(ValueError):
        R.require_none(R.duplicate_ids(spine.union(spine)), "twice")


def test_seed_and_stage_tables(spark, tmp_path):
    (tmp_path / "seed.json").write_text('[{"name": "Acme B.V.", "website": "https://a.nl"}, {"name": "B"}]')
    assert [(r["ord"], r["company_id"]) for r in tables.read_seed(spark, str(tmp_path / "seed.json")).collect()] == [(0, "acme"), (1, "b")]
    (tmp_path / "bad.json").write_text('{"name": 1}')
    with pytest.raises(ValueError):
        tables.read_seed(spark, str(tmp_path / "bad.json"))
    two = spark.createDataFrame([("x", "A"), ("x", "B")], "company_id string, name string")
    with pytest.raises(ValueError):
        tables.write_stage(two, str(tmp_path / "t"))


def test_records_that_cannot_be_read(spark, tmp_path):
    for name, text in {"a.json": '{"name": "A", "n": 1}', "list.json": '[{"name": "B", "n": 2}, {"name": "C"}]', "bad.json": '{"name": "D"', "kind.json": '{"name": "E", "n": "x"}', "part.json": '[{"name": "F", "n": 3}, 7]', "open.json": '[{"name": "G"}, '}.items():
        (tmp_path / name).write_text(text)
    read = lambda mode: tables.read_records(spark, str(tmp_path / "*.json"), "name STRING, n INT", mode)
    assert sorted(map(tuple, read("skip").collect()), key=str) == [("A", 1), ("B", 2), ("C", None), ("F", 3)]
    assert read("mark").where("corrupt IS NOT NULL").count() == 4 and read("mark").count() == 8
    with pytest.raises(ValueError, match="can't be read"):
        read("raise")
    with pytest.raises(ValueError, match="mode"):
        read("odd")
    d = spark.createDataFrame([(1, '{"name": "A", "n": 1}'), (2, "{"), (3, None)], "i int, text string")
    assert [tuple(r) for r in tables.parse_records(d, "name STRING, n INT").collect()] == [(1, "A", 1)]
    assert tables.parse_records(d.where("i = 1"), "name STRING, n INT", "raise").count() == 1
    with pytest.raises(ValueError, match="can't be read"):
        tables.parse_records(d, "name STRING, n INT", "raise")
    for name, text in {"acme": '---\nname: "Acme"\n---\n\nBody\n', "anon": '---\nname: null\n---\n\nBody\n', "none": "no front matter"}.items():
        (tmp_path / f"{name}.md").write_text(text)
    ids = lambda **k: sorted(r["company_id"] for r in tables.read_dossiers(spark, str(tmp_path / "*.md"), **k).collect())
    assert ids() == ["acme", "anon", "none"] and ids(named=True) == ["acme"]


def test_retries():
    tried = []

    def call():
        tried.append(1)
        if len(tried) < 3:
            raise providers.Transient("busy", 7.0)
        return "ok"

    slept = []
    assert providers.with_retries(call, sleep=slept.append) == "ok" and slept == [7.0, 7.0]
    assert providers.delay(10, rand=lambda: 1.0) == 30.0 and providers.delay(0, rand=lambda: 1.0) == 0.5


def test_stream_merges_like_batch(spark, tmp_path):
    schema = "company_id string, content_hash string, seq long"
    spark.createDataFrame([("a", "1", 1), ("b", "2", 1), ("a", "0", 2)], schema).write.parquet(str(tmp_path / "in"))
    table = KeyedTable(spark, str(tmp_path / "life"), name=None)

    def go(at, checkpoint="cp"):
        q = merge_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "life"), at, str(tmp_path / checkpoint), "seq")
        q.awaitTermination(120)
        return {r["company_id"]: (r["content_hash"], r["created_at"], r["updated_at"]) for r in table.read().collect()}

    first = {"a": ("0", "T1", "T1"), "b": ("2", "T1", "T1")}
    assert go("T1") == first
    spark.createDataFrame([("b", "2", 3), ("c", "3", 3), ("a", "9", 4)], schema).write.mode("append").parquet(str(tmp_path / "in"))
    second = {"a": ("9", "T1", "T2"), "b": ("2", "T1", "T1"), "c": ("3", "T2", "T2")}
    assert go("T2") == second
    # the same micro-batch once more, as after a driver that died behind the commit
    batch = spark.createDataFrame([("a", "other", 9)], schema)
    version = table.versions()[-1]
    assert update_lifecycle(table, batch, "T3", "seq", (str(tmp_path / "cp"), 1)) == version and go("T3") == second
    update_lifecycle(table, batch.select("company_id", "content_hash"), "T3")  # a batch run on the same table
    assert {r["company_id"]: r["updated_at"] for r in table.read().collect()} == {"a": "T3", "b": "T1", "c": "T2"}


def test_geocode_rows_with_null_keys(spark):
    ask = spark.createDataFrame([(1, "1000 AA", "Dam", 1, "X"), (2, None, "dam", 1, "x"), (3, "1000 AA", None, None, None), (4, None, None, 1, None), (None, None, None, None, None)], "company_id int, postcode string, street_name string, house_no int, city string")
    ref = spark.createDataFrame([("adres", "1000 AA", "Dam", 1, "X", "a"), ("postcode", "1000 AA", None, None, None, "p"), ("adres", None, None, None, None, "n"), ("postcode", None, None, None, None, "n")], "kind string, postcode string, street string, house_no int, city string, centroid_wkt string")
    want = {(1, "exact", "a"), (2, "street", "a"), (3, "postcode_centroid", "p"), (4, None, None), (None, None, None)}
    for rows in (100, 0):
        assert {tuple(r) for r in R.geocode(ask, ref, broadcast_rows=rows).collect()} == want


def test_only_rows_that_need_a_search_meet_the_hits(spark):
    seed = spark.createDataFrame([(1, "a", "http://a"), (2, "b", " "), (3, " ", None), (4, "d", None), (5, None, "http://e"), (2, "b", None)], "company_id int, name string, website string")
    hits = spark.createDataFrame([(1, 1, "h1"), (2, 2, "h2"), (2, 1, "h1"), (3, 1, "h3"), (4, 1, None)], "company_id int, engine_rank int, url string")
    got = sorted((r.company_id, r.website, r.status) for r in R.resolve_websites(seed, hits).collect())
    assert got == [(1, "http://a", None), (2, "h1", None), (2, "h1", None), (3, None, "failed"), (4, None, "failed"), (5, "http://e", "failed")]
