"""Polite fetching under a clock of its own and over HTTP, and the chain of engines."""

import json
import threading
import time
from collections import defaultdict
from dataclasses import replace
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from dossierforge.sources import web
from dossierforge.sources.providers import Completions, Transient, delay
from dossierforge.sources.web import Fetched, Retryable


class FakeClock:
    def __init__(self):
        self.t = 0.0

    def now(self):
        return self.t

    def sleep(self, seconds):
        self.t += max(seconds, 1e-3)


@pytest.mark.parametrize(("hosts", "concurrency", "ahead"), [(["a"] * 9, 4, 3), (["a", "b", "c"] * 4 + ["a"] * 8, 8, 4), (["a", "b"] * 5, 1, 100), ([f"h{i}" for i in range(40)], 3, 5), (["hot"] * 30 + ["x", "y", "z"], 2, 8), ([], 2, 2)])
def test_gap_between_requests_of_a_host(hosts, concurrency, ahead):
    clock, busy, most, lock = FakeClock(), defaultdict(int), defaultdict(int), threading.Lock()

    def call(row):
        with lock:
            busy[row[0]] += 1
            most[row[0]] = max(most[row[0]], busy[row[0]])
        time.sleep(0.001)
        with lock:
            busy[row[0]] -= 1
        return row[1]

    got = list(web.polite(((h, (h, i)) for i, h in enumerate(hosts)), call, 1.0, concurrency, ahead, clock))
    assert sorted(r[1] for r, _, _ in got) == list(range(len(hosts))) and all(r[1] == a for r, a, _ in got)
    assert all(n == 1 for n in most.values())
    starts = defaultdict(list)
    for (h, i), _, start in got:
        starts[h].append((start, i))
    for h, s in starts.items():
        assert s == sorted(s) and [i for _, i in s] == [i for i, x in enumerate(hosts) if x == h]  # in order
        assert all(b - a >= 1.0 - 1e-9 for (a, _), (b, _) in zip(s[:-1], s[1:], strict=True))
    if len(set(hosts)) == len(hosts):
        assert clock.t < 1.0  # hosts don't wait for one another


def test_errors_and_retries():
    def flaky(fails, kind="timeout"):
        left = [fails]

        def request(url):
            if left[0]:
                left[0] -= 1
                raise Retryable(kind, "gone")
            return Fetched(url + "/end", "<html>")

        return request

    assert web.fetched("u", flaky(0)) == (Fetched("u/end", "<html>"), 1)
    assert web.fetched("u", flaky(1)) == (Fetched("u/end", "<html>"), 2)
    assert web.fetched("u", flaky(2, "dns")) == (Fetched("u", None, "dns", "gone"), 2)
    assert web.fetched("u", lambda u: Fetched(u, None, "http_500", "HTTP 500")) == (Fetched("u", None, "http_500", "HTTP 500"), 1)
    assert web.fetched("u", lambda u: 1 / 0)[0].error_kind == "transport"


class _Site(BaseHTTPRequestHandler):
    def do_GET(self):  # noqa: N802
        if self.path == "/moved":
            self.send_response(302)
            self.send_header("Location", "/here")
            self.end_headers()
        elif self.path == "/slow":
            time.sleep(1.5)
        elif self.path == "/gone":
            self.send_error(404)
        else:
            body = f"<p>é {self.headers['User-Agent']}".encode("latin-1")
            self.send_response(200)
            self.send_header("Content-Type", "text/html; charset=latin-1")
            self.end_headers()
            self.wfile.write(body)

    def do_POST(self):  # noqa: N802
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        asked = body["messages"][0]["content"]
        said = {"busy": (429, ""), "broken": (200, "no json"), "empty": (200, json.dumps({"choices": [{"message": {"content": " "}}]}))}
        code, text = said.get(asked, (200, json.dumps({"choices": [{"message": {"content": f"{body['model']} {body['temperature']} {self.headers['Authorization']} {asked}"}}]})))
        self.send_response(code)
        self.send_header("Retry-After", "7")
        self.end_headers()
        self.wfile.write(text.encode())

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def site():
    s = ThreadingHTTPServer(("127.0.0.1", 0), _Site)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_over_http(site):
    request = web.http_request(timeout=0.3)
    ok, n = web.fetched(f"{site}/moved", request)
    assert ok.url == f"{site}/here" and ok.html == f"<p>é {web.USER_AGENT}" and n == 1
    assert web.fetched(f"{site}/gone", request) == (Fetched(f"{site}/gone", None, "http_404", "HTTP 404"), 1)
    late, n = web.fetched(f"{site}/slow", request)
    assert (late.error_kind, n) == ("timeout", 2)
    assert web.fetched("http://127.0.0.1:1/", request)[0].error_kind == "dns" and web.fetched("nonsense", request)[0].error_kind == "transport"


def test_completions_over_http(site, monkeypatch):
    ask = lambda c, text: c()(json.dumps([{"role": "user", "content": text}]))
    c = Completions(f"{site}/chat", "usual", model_env="TEST_MODEL", key_env="TEST_KEY")
    monkeypatch.setenv("TEST_KEY", "k")
    assert ask(c, "hi") == "usual 0.2 Bearer k hi"
    monkeypatch.setenv("TEST_MODEL", "other")
    assert ask(c, "hi") == "other 0.2 Bearer k hi" and replace(c, model="given").resolved_model() == "given"
    for text, asked in (("busy", 7.0), ("broken", None), ("empty", None)):
        with pytest.raises(Transient) as e:
            ask(c, text)
        assert e.value.retry_after == asked
    with pytest.raises(Transient):
        ask(replace(c, url="http://127.0.0.1:1/"), "hi")
    assert delay(0, 7.0, lambda: 1.0) == 7.0 and delay(9, 7.0, lambda: 1.0) == 30.0


@pytest.mark.parametrize("tasks", [1, 3])
def test_spark_keeps_the_gap_under_any_partitioning(spark, tasks):
    rows = [(f"https://{h}/p{i}",) for i in range(5) for h in ("hot.nl", "HOT.nl", "b.nl", "c.nl")] + [(None,), ("no url",), (None,), ("https://b.nl/p0",)]
    d = spark.createDataFrame(rows, "url string").repartition(7)

    def make():
        return lambda url: Fetched(url, "x")

    got = web.fetch_politely(d, make, gap=0.1, tasks=tasks).collect()
    assert sorted(r["url"] or "" for r in got) == sorted(u or "" for (u,) in rows)
    starts = defaultdict(list)
    for r in got:
        if r["html"] is None:
            assert (r["error_kind"], r["attempts"], r["error"]) == ("transport", 0, "no absolute URL")
        else:
            starts[r["url"].split("/")[2].lower()].append(r["started_at"])
    assert {h: len(s) for h, s in starts.items()} == {"hot.nl": 10, "b.nl": 6, "c.nl": 5}
    assert all(b - a >= 0.1 for s in map(sorted, starts.values()) for a, b in zip(s[:-1], s[1:], strict=True))
    assert web.fetch_politely(d.limit(0), make).count() == 0


def test_chain_asks_each_engine_only_for_what_is_open(spark, tmp_path):
    asked = spark.sparkContext.accumulator(0)

    def engine(hits, fails=()):
        def make():
            def call(query):
                asked.add(1)
                if query in fails:
                    raise OSError("down")
                return hits.get(query)

            return call

        return make

    q = spark.createDataFrame([(i, f"q{i}") for i in range(5)], "company_id int, query string")
    got = web.search_chain(q, [("one", engine({"q0": "u0", "q1": " "}, ("q3",))), ("two", engine({"q1": "u1", "q0": "no", "q3": "no"}))], wait_s=0.0, spacing=0.0, path=str(tmp_path))
    want = [(0, "u0", "one", 1, None), (1, "u1", "two", 1, None), (2, None, None, None, None), (3, None, "one", 2, "OSError: down"), (4, None, None, None, None)]
    assert sorted(map(tuple, got.collect())) == want
    assert asked.value == 6 + 3  # q3 twice; then 1, 2 and 4 of the second engine
    assert sorted(map(tuple, got.collect())) == want and asked.value == 9  # read, not asked
