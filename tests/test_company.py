"""The company pipeline as a whole, offline and with a provider, and its command line."""

import json

import pytest

from dossierforge import __main__ as cli
from dossierforge.functions import vocab as V
from dossierforge.plans import company, stages
from dossierforge.sources.keyed import Clash, KeyedTable

LONG = "We make sturdy wooden boats for canals and lakes, by hand, in a small yard near the river. " * 2


def _page(body: str, footer: str = "") -> str:
    return f"<html><head><title>Acme</title></head><body><main><p>{LONG}{body}</p></main><footer>{footer}</footer></body></html>"


def _world(spark, tmp_path):
    seed = tmp_path / "seed.json"
    seed.write_text(json.dumps([{"name": "Acme B.V.", "website": "https://acme.nl"}, {"name": "Beta"}, {"name": "Gone", "website": "https://gone.nl"}, {"name": " "}]))
    links = '<a href="/contact">c</a><a href="/about">a</a><a href="/x.pdf">x</a><a href="https://else.nl/about">e</a>'
    pages = [("https://acme.nl/", _page(links, "Kade 12\n1234 AB Ede")), ("https://acme.nl/contact", _page(" Mail us.")), ("https://acme.nl/about", _page(" We are old.")), ("https://acme.nl/robots.txt", "Sitemap: https://acme.nl/map.xml"), ("https://acme.nl/map.xml", "<urlset><url><loc>https://acme.nl/team</loc></url></urlset>"), ("https://acme.nl/team", _page(" A team."))]
    tables = {
        "hits": spark.createDataFrame([("beta", 2, "https://beta.nl/"), ("beta", 1, None)], company.HITS),
        "web": spark.createDataFrame(pages, company.WEB),
        "addresses": spark.createDataFrame([("adres", "1234AB", "Kade", 12, "Ede", "POINT(5.5 52.1)")], company.ADDRESSES),
    }
    for name, d in tables.items():
        d.write.parquet(str(tmp_path / name))
    return str(seed), {n: str(tmp_path / n) for n in tables}


def _args(tables):
    return [x for n, p in tables.items() for x in (f"--{n}", p)]


def test_offline_run_resume_and_stage(spark, tmp_path, capsys):
    seed, tables = _world(spark, tmp_path)
    root = str(tmp_path / "out")
    base = ["--input", seed, "--data-root", root, *_args(tables)]
    assert cli.main(["run", *base, "--publish"], spark) == 0
    rows = {r["company_id"]: r for r in stages.table(spark, root, "dataset-output").read().collect()}
    assert set(rows) == {"acme", "beta", "gone"}
    acme = rows["acme"]
    assert acme["status"] == "ok" and acme["address"]["postcode"] == "1234 AB" and acme["address"]["street"] == "Kade 12"
    assert acme["match_quality"] == "exact" and acme["latlng"]["lat"] == 52.1
    assert acme["en"] is None and acme["nl"] is None and acme["created_at"] == acme["updated_at"]
    content = {r["company_id"]: r for r in stages.table(spark, root, "content-collection").read().collect()}
    assert content["acme"]["status"] == "ok" and {p["slug"] for p in content["acme"]["pages"]} == {"index", "contact", "about", "team"}
    assert content["gone"]["status"] == content["beta"]["status"] == "fetch_failed" and content["beta"]["website"] == "https://beta.nl/"
    assert rows["gone"]["status"] == "empty"
    assert cli.main(["run", *base, "--resume"], spark) == 0
    assert stages.table(spark, root, "fact-extraction").read().count() == 3
    capsys.readouterr()
    assert cli.main(["stage", "geocoding", *base, "--company", "acme", "--dry-run"], spark) == 0
    out = capsys.readouterr().out.strip().splitlines()
    assert len(out) == 1 and json.loads(out[0])["status"] == "ok"


def _provider():
    axis = {"score": 50, "evidence": "partial", "reason": {"en": "why"}}

    def call(request: str) -> str:
        system = json.loads(request)[0]["content"]
        body = json.loads(request)[1]["content"]
        if system == "translate":
            return json.dumps({k: v.upper() for k, v in json.loads(body).items()})
        return {"sum": "# Dossier\nBoats.", "line": '{"en": "Boats by hand"}', "score": json.dumps({a: axis for a in V.AXES}), "tag": "no json"}[system]

    return call


def test_online_run(spark, tmp_path):
    seed, tables = _world(spark, tmp_path)
    given = {n: spark.read.parquet(p) for n, p in tables.items()}
    prompts = {"content-summarization": "sum", "tagline-extraction": "line", "global-scoring": "score", "tagging": "tag", "translation": "translate"}
    o = company.Outside(company.tables.read_seed(spark, seed), str(tmp_path / "out"), "2026-01-02T00:00:00Z", complete=_provider, prompts=prompts, **given)
    done = company.run(spark, o)
    acme = done["dataset-output"].where("company_id = 'acme'").first()
    assert acme["en"]["tagline"] == "Boats by hand" and acme["scores"]["power"] == ((50, "partial")) and acme["capability_tags"] is None
    assert acme["en"]["scores"]["ecology"]["reason"] == "why" and acme["nl"]["tagline"] == "BOATS BY HAND" and acme["nl"]["scores"]["posture"]["reason"] == "WHY"
    assert done["dataset-output"].where("company_id = 'gone'").select("en", "nl", "scores").first() == (None, None, None)
    assert done["tagging"].where("company_id = 'acme'").first()["status"] == "llm_error"
    assert done["tagging"].where("company_id = 'gone'").first()["status"] == "upstream_failed"


def search_engine():
    def call(query):
        if query == "Down":
            raise OSError("no line")
        return {"Beta": "https://beta.nl"}.get(query)

    return call


def geocoder():
    def call(request):
        q = json.loads(request)
        if q.get("house_no") == 99:
            raise OSError("no line")
        return {"exact": None, "street": "POINT(5.1 52.2)" if q.get("house_no") == 12 else "nonsense"}.get(q["tier"])

    return call


def test_providers_redirects_and_lookup_errors(spark, tmp_path):
    """Through the command line: engines, a geocoder, a site that moved."""
    seed = tmp_path / "seed.json"
    seed.write_text(json.dumps([{"name": "Beta"}, {"name": "Down"}, {"name": "Nobody"}, {"name": "Far", "website": "https://far.nl"}, {"name": "Odd", "website": "https://odd.nl"}]))
    foot = {"beta": "Kade 12\n1234 AB Ede", "far": "Laan 99\n1234 AC Ede", "odd": "Weg 7\n1234 AD Ede"}
    pages = [("https://beta.nl/", _page('<a href="/about">a</a><a href="https://beta.nl/x">x</a>', foot["beta"]), "https://www.newbeta.com/home?x=1", None), ("https://www.newbeta.com/about", _page(" About."), None, None), ("https://beta.nl/x", _page(" X."), None, None)]
    pages += [(f"https://{n}.nl/", _page('<a href="/contact">c</a>', foot[n]), None, None) for n in ("far", "odd")] + [("https://far.nl/contact", None, "https://far.nl/contact", "http_404")]
    spark.createDataFrame(pages, "url string, html string, final_url string, error_kind string").write.parquet(str(tmp_path / "web"))
    (tmp_path / "prompts").mkdir()
    (tmp_path / "prompts" / "tagging.md").write_text("tag it")
    root = str(tmp_path / "out")
    base = ["run", "--input", str(seed), "--data-root", root, "--web", str(tmp_path / "web")]
    options = ["--engine", "one=tests.test_company:search_engine", "--locate", "tests.test_company:geocoder", "--prompts", str(tmp_path / "prompts")]
    assert cli.main([*base, "--engine", "one=no.such:thing"], spark) == 2
    made = company.Outside.__init__.__defaults__  # seconds between calls are for real engines
    company.Outside.__init__.__defaults__ = tuple(0.0 if x in (5.0, 1.5) else x for x in made)
    try:
        assert cli.main([*base, *options], spark) == 0
    finally:
        company.Outside.__init__.__defaults__ = made
    at = lambda stage: {r["company_id"]: r for r in stages.table(spark, root, stage).read().collect()}
    sites = at("website-resolution")
    assert sites["beta"]["website"] == "https://beta.nl" and sites["down"]["error"] == "search backend error: OSError: no line" and sites["nobody"]["error"] == "no search results"
    content = at("content-collection")
    assert content["beta"]["canonical_homepage_url"] == "https://www.newbeta.com/home"
    assert {(p["slug"], p["url"], p["status"]) for p in content["beta"]["pages"]} == {("index", "https://www.newbeta.com/home", "written"), ("about", "https://www.newbeta.com/about", "written")}
    assert {(p["slug"], p["status"], p["error_kind"]) for p in content["far"]["pages"]} == {("index", "written", None), ("contact", "error", "http_404")}
    geo = at("geocoding")
    assert (geo["beta"]["status"], geo["beta"]["match_quality"], geo["beta"]["latlng"]["lat"]) == ("ok", "street", 52.2)
    assert {k: (geo[k]["status"], geo[k]["match_quality"], geo[k]["latlng"]) for k in ("far", "odd")} == {k: ("lookup_error", "none", None) for k in ("far", "odd")}
    rows = at("dataset-output")
    assert rows["beta"]["latlng"]["lng"] == 5.1 and rows["far"]["latlng"] is None and rows["far"]["address"]["postcode"] == "1234 AC"
    args = cli._parser().parse_args([*base, *options, "--offline"])
    assert cli._providers(spark, args) == {}
    assert cli._providers(spark, cli._parser().parse_args([*base, *options]))["prompts"] == {"tagging": "tag it"}


def test_runs_share_the_lifecycle_table_and_guard_names(spark, tmp_path):
    seed, tables = _world(spark, tmp_path)
    root = str(tmp_path / "out")

    def run(at, **changed):
        given = {n: spark.read.parquet(p) for n, p in tables.items()} | changed
        o = company.Outside(company.tables.read_seed(spark, seed), root, at, **given)
        return {r["company_id"]: (r["created_at"], r["updated_at"]) for r in company.run(spark, o)["dataset-output"].collect()}

    first, later = "2026-01-02T00:00:00Z", "2026-02-02T00:00:00Z"
    assert run(first) == {k: (first, first) for k in ("acme", "beta", "gone")}
    assert run(later) == {k: (first, first) for k in ("acme", "beta", "gone")}  # nothing changed
    moved = spark.createDataFrame([("adres", "1234AB", "Kade", 12, "Ede", "POINT(5.6 52.2)")], company.ADDRESSES)
    assert run(later, addresses=moved) == {"acme": (first, later), "beta": (first, first), "gone": (first, first)}
    t = KeyedTable(spark, f"{root}/lifecycle", name=None)
    assert {r["company_id"]: r["updated_at"] for r in t.read().collect()} == {"acme": later, "beta": first, "gone": first}
    before = stages.table(spark, root, "website-resolution").versions()
    with open(seed, "w") as f:
        json.dump([{"name": "ACME B.V."}], f)
    with pytest.raises(Clash, match="ACME"):
        run(later)
    assert stages.table(spark, root, "website-resolution").versions() == before


def test_rendered_sites_and_releases(spark, tmp_path, capsys):
    seed = tmp_path / "seed.json"
    seed.write_text(json.dumps([{"name": "App", "website": "https://app.nl"}, {"name": "Lost", "website": "https://lost.nl"}]))
    shell, link = "<html><body><div id=root></div></body></html>", '<a href="/about">a</a>'
    pages = [("https://app.nl/", shell, _page(link)), ("https://app.nl/about", shell, _page(" Made by a browser.")), ("https://lost.nl/", None, _page(link)), ("https://lost.nl/about", _page(" Static."), None)]
    web = spark.createDataFrame(pages, "url string, html string, rendered string")
    root = str(tmp_path / "out")
    o = company.Outside(company.tables.read_seed(spark, str(seed)), root, "2026-01-02T00:00:00Z", web=web)
    content = {r["company_id"]: r for r in company.collection(o, {"website-resolution": company.resolution(o, {})}).collect()}
    assert content["app"]["js_site"] and {p["slug"]: p["status"] for p in content["app"]["pages"]} == {"index": "written", "about": "written"}
    assert content["lost"]["js_site"] and {p["slug"]: p["status"] for p in content["lost"]["pages"]} == {"index": "written", "about": "error"}

    class Sink:
        taken, sent = set(), []

        def check(self):
            if not self.ready:
                raise ValueError("not signed in")

        def exists(self, tag):
            return tag in self.taken

        def upload(self, tag, paths):
            self.sent.append((tag, len(paths)))

    d, sink = spark.createDataFrame([("a", "A")], "company_id string, name string"), Sink()
    release = lambda at, **k: stages.publish(d, str(tmp_path / "rel"), at, "sha", sink, **k)
    sink.ready = False
    with pytest.raises(ValueError, match="signed in"):
        release("2026-01-02T00:00:00Z")
    assert release("2026-01-02T00:00:00Z", dry_run=True).first()["tag"] == "2026-01-02T00-00-00Z" and not (tmp_path / "rel").exists()
    sink.ready = True
    release("2026-01-02T00:00:00Z")
    with pytest.raises(ValueError, match="exists already"):
        release("2026-01-02T00:00:00Z")
    sink.taken = {"2026-01-03T00-00-00Z"}
    with pytest.raises(ValueError, match="exists already"):
        release("2026-01-03T00:00:00Z")
    assert sink.sent == [("2026-01-02T00-00-00Z", 2)]


def test_seed_that_is_no_array(spark, tmp_path):
    bad = tmp_path / "seed.json"
    bad.write_text('{"name": "x"}')
    assert cli.main(["run", "--input", str(bad), "--data-root", str(tmp_path / "out")], spark) == 2
