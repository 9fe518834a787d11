"""Queries over pages: titles as their SQL spells them, and what a task holds at once."""

import tracemalloc

import duckdb
import pyarrow as pa

from dossierforge.operators import html as H
from dossierforge.plans import catalog

HEADS = [
    "<title>A &quot;b&amp;amp; c&amp; d&amp</title>", "<title>token = &quot;1&quot;</title>", "\n<!-- <b>\n-->\n<title>\n Two\n\t lines  &#233; </title>\n<meta property='og:title' content='Other'>",
    "", "<title></title>", "<title>One</title><svg><title>Two</title></svg>", "<title>a <b>c</b></title>", "<title>never closed",
]


def test_page_title_spells_references_as_its_sql_does(spark, tmp_path):
    rows = [(i, f"https://a.nl/{i}", f"<html><head>{h}</head><body><p>x &quot;y&quot;</p></body></html>") for i, h in enumerate(HEADS)] + [(99, "https://a.nl/", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = dict(con.sql(catalog.ORACLES["page_title"]).fetchall())
    got = {r["page_id"]: r["title"] for r in catalog.QUERIES["page_title"](spark, str(tmp_path)).collect()}
    assert got == want
    assert got[0] == "A &quot;b&amp; c& d&amp" and got[2] == "Two lines &#233;"


def most(portions):
    """(results, most that was held while portions were read one after the other and let go)."""
    tracemalloc.start()
    n = sum(len(x) for x in portions)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return n, peak


def page(i):
    return f"<body><p>Text {i}, and more of it, as texts go.</p>{'<a href=/x>x</a>' * 20}<footer>Foot {i}</footer></body>"


def test_footers_of_a_large_batch_are_handed_on_in_portions(monkeypatch):
    monkeypatch.setattr(H, "ROWS", 64)
    few, many = (most(H._read(iter([pa.array([page(i) for i in range(n)])]))) for n in (200, 800))
    assert (few[0], many[0]) == (200, 800) and many[1] < 1.3 * few[1]
    assert [x["footer_text"] for a in H._read(iter([pa.array([page(i) for i in range(150)]), pa.array([None, page(150)])])) for x in a.to_pylist()] == [*(f"Foot {i}" for i in range(150)), None, "Foot 150"]


def linked(n):
    return iter([(pa.array([page(i) + "<a href=z>z</a>" * 50 for i in range(n)]), pa.array([f"https://a.nl/{i}" for i in range(n)]))])


def test_links_are_read_once_a_page(spark, tmp_path):
    spark.createDataFrame([(i, f"https://a.nl/{i}/", page(i)) for i in range(20)], "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    d = catalog.QUERIES["internal_links"](spark, str(tmp_path))
    assert d._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted((r["page_id"], r["pos"], r["link"]) for r in d.collect()) == [(i, 0, "https://a.nl/x") for i in range(20)]


def test_links_of_a_large_batch_are_handed_on_in_portions(monkeypatch):
    monkeypatch.setattr(H, "ROWS", 64)
    few, many = (most(H._page_links(linked(n))) for n in (200, 800))
    assert (few[0], many[0]) == (200, 800) and many[1] < 1.3 * few[1]
    odd = pa.array(["<base href='http://[bad'><a href=y>", None, "<a href='http://[x'></a><a href='b?c#d'>"]), pa.array(["http://a.nl/", "http://a.nl/", "http://a.nl/q"])
    assert [x for a in H._page_links(iter([odd])) for x in a.to_pylist()] == [[], [], ["http://a.nl/b?c#d"]]
    assert [x for a in H._absolute(iter([(pa.array([None, "/c/"]), pa.array(["http://a.nl/"] * 2), pa.array([["x"], ["x", "http://[y"]]))])) for x in a.to_pylist()] == [["http://a.nl/x"], ["http://a.nl/c/x"]]


def test_long_pages_end_a_portion_and_keep_their_whole_main_text(monkeypatch):
    monkeypatch.setattr(H, "CHARS", 20_000)
    long = "<main>" + "".join(f"<p>Paragraph {i}, with commas, and words.</p>" for i in range(H.CHARS // 40)) + "</main>"
    pages = [long, page(1), long, None, page(2)]
    portions = list(H._read(iter([pa.array(pages)])))
    assert [len(a) for a in portions] == [1, 2, 2]
    assert [(x["markdown"], x["recall"]) for a in portions for x in a.to_pylist()] == [H._main(H._parse(x)) for x in pages]
    assert portions[0][0].as_py()["markdown"].count("Paragraph") == H.CHARS // 40


def held(n):
    """(results, most bytes of Arrow's that were there when one of n batches had been read)."""
    start, top = pa.total_allocated_bytes(), 0

    def batches():
        nonlocal top
        for i in range(n):
            yield pa.array([page(20 * i + k) + " " * 50_000 for k in range(20)])
            top = max(top, pa.total_allocated_bytes() - start)

    return [x["markdown"] for a in H._read(batches()) for x in a.to_pylist()], top


def test_main_text_of_many_batches_holds_no_more_than_that_of_few():
    few, many = held(4), held(16)
    assert many[1] < 1.3 * few[1]
    assert many[0] == [f"Text {i}, and more of it, as texts go." for i in range(320)] and few[0] == many[0][:80]
