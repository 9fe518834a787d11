"""The web from outside: fetching politely, host by host, with classified errors, and search through a chain of engines."""

from __future__ import annotations

import heapq
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .providers import run_pending
from .tables import stored

# fixed values: seconds between pages of a host and of a request, and tries of a request
GAP, TIMEOUT, ATTEMPTS = 1.0, 15.0, 2
#: fixed value: what a request says it comes from
USER_AGENT = "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/125.0.0.0 Safari/537.36"
#: Requests that a task keeps going, and rows that it reads ahead while their hosts are busy.
CONCURRENCY, AHEAD = 8, 256


@dataclass(frozen=True)
class Fetched:
    """What came of a request: html, or an error of a kind (timeout, dns, transport, http_<status>). url: where redirects ended."""

    url: str
    html: str | None = None
    error_kind: str | None = None
    error: str | None = None


class Retryable(Exception):
    """A failure of a connection; kind is its class."""

    def __init__(self, kind: str, message: str):
        super().__init__(message)
        self.kind = kind


def fetched(url: str, request: Callable[[str], Fetched], attempts: int = ATTEMPTS) -> tuple[Fetched, int]:
    """The outcome of a request and the tries it took. Lost connections are tried again; an answer of the server, whatever its status, stands."""
    for n in range(1, attempts + 1):
        try:
            return request(url), n
        except Retryable as e:
            last = Fetched(url, None, e.kind, str(e))
        except Exception as e:  # noqa: BLE001  a row's failure is that row's result
            return Fetched(url, None, "transport", f"{type(e).__name__}: {e}"), n
    return last, attempts


def http_request(timeout: float = TIMEOUT, user_agent: str = USER_AGENT) -> Callable[[str], Fetched]:
    """A request over HTTP that follows redirects."""
    import socket
    import urllib.error
    import urllib.request

    def request(url: str) -> Fetched:
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": user_agent}), timeout=timeout) as r:
                return Fetched(r.url, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace"))
        except urllib.error.HTTPError as e:
            return Fetched(e.url or url, None, f"http_{e.code}", f"HTTP {e.code}")
        except TimeoutError as e:
            raise Retryable("timeout", f"timeout after {timeout}s: {e}") from e
        except urllib.error.URLError as e:
            late = isinstance(e.reason, TimeoutError)
            lost = isinstance(e.reason, (socket.gaierror, ConnectionError))
            raise Retryable("timeout" if late else "dns" if lost else "transport", f"{'timeout' if late else 'connection' if lost else 'transport'} error: {e.reason}") from e
        except OSError as e:
            raise Retryable("dns", f"connection error: {e}") from e

    return request


class Clock(Protocol):
    def now(self) -> float: ...
    def sleep(self, seconds: float) -> None: ...


class RealClock:
    now = staticmethod(time.time)
    sleep = staticmethod(time.sleep)


def polite(rows: Iterable[tuple[str, object]], call: Callable[[object], object], gap: float, concurrency: int = CONCURRENCY, ahead: int = AHEAD, clock: Clock | None = None) -> Iterator[tuple[object, object, float]]:
    """(row, outcome, start) of call(row) for rows of (host, row), in the order they end.

    A host has one request at a time, and the next begins no sooner than `gap` after the last one's end. While a host rests others go on: `ahead` rows are held at
    most, each under its host. What is remembered of a host goes as soon as it has rested, so that memory is bounded by those and by hosts of the last `gap` seconds.
    """
    clock = clock or RealClock()
    source = iter(rows)
    queues: dict[str, deque] = {}  # rows held, by host
    ready: list[tuple[float, int, str]] = []  # when each host with rows may start, hosts at work left out
    rested: dict[str, float] = {}  # of hosts without rows
    going: dict[Future, tuple[str, object, float]] = {}
    held = turn = 0
    more = True

    def queue(host: str, at: float) -> None:
        nonlocal turn
        turn += 1
        heapq.heappush(ready, (at, turn, host))

    with ThreadPoolExecutor(concurrency) as pool:
        while more or held or going:
            while more and held < ahead:
                try:
                    host, row = next(source)
                except StopIteration:
                    more = False
                    break
                held += 1
                if host in queues:
                    queues[host].append(row)
                else:
                    queues[host] = deque([row])
                    if not any(h == host for h, _, _ in going.values()):
                        queue(host, rested.pop(host, 0.0))
            now = clock.now()
            while ready and len(going) < concurrency and ready[0][0] <= now:
                _, _, host = heapq.heappop(ready)
                row = queues[host].popleft()
                held -= 1
                if not queues[host]:
                    del queues[host]
                start = clock.now()
                going[pool.submit(call, row)] = (host, row, start)
            if going and (len(going) == concurrency or not ready):
                wait(going, return_when=FIRST_COMPLETED)
            elif ready and not any(f.done() for f in going):
                clock.sleep(min(max(0.0, ready[0][0] - clock.now()), gap))
            for f in [f for f in going if f.done()]:
                host, row, start = going.pop(f)
                end = clock.now() + gap
                if host in queues:
                    queue(host, end)
                else:
                    rested[host] = end
                yield row, f.result(), start
            if len(rested) > ahead:
                now = clock.now()
                rested = {h: t for h, t in rested.items() if t > now}


def by_host(requests: DataFrame, url: str = "url", order: str | None = None, tasks: int | None = None) -> DataFrame:
    """requests with host and turn: all rows of a host in one task, each host's first row first, then each one's second, and so on.

    A host's rows can't be dealt to several tasks, as its rate is the host's and not the cluster's: rows of a hot host wait on disk, sorted, and the others go between them.
    """
    d = requests.withColumn("host", F.lower(T.netloc(F.col(url))))
    d = d.repartition(tasks, "host") if tasks else d.repartition("host")
    d = d.withColumn("turn", F.row_number().over(Window.partitionBy("host").orderBy(*([order] if order else []), url)))
    return d.sortWithinPartitions("turn", "host")


def fetch_politely(requests: DataFrame, make: Callable[[], Callable[[str], Fetched]], gap: float = GAP, tasks: int | None = None, order: str | None = None, concurrency: int = CONCURRENCY) -> DataFrame:
    """(url, final_url, html, error_kind, error, attempts, turn, started_at) for each row of requests(url), asked of what make() gives.

    `gap` seconds at least lie between the end of a host's request and the start of its next, however many tasks and partitions there are. A url that is null or no absolute URL
    gives the error kind transport without a request. Rows may repeat; each is asked. Write the result before using it, so that a retried task doesn't ask twice.
    """
    names = ["url", "final_url", "html", "error_kind", "error", "attempts", "turn", "started_at"]
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        request = make()

        rows = ((h, (u, t)) for b in batches for u, h, t in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True))
        out = []
        for (url, turn), (f, n), start in polite(rows, lambda row: fetched(row[0], request), gap, concurrency):
            out.append((url, f.url, f.html, f.error_kind, f.error, n, turn, start))
            if len(out) == AHEAD:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    schema = "url string, final_url string, html string, error_kind string, error string, attempts int, turn int, started_at double"
    has_host = F.coalesce(T.netloc(F.col("url")) != "", F.lit(False))
    d = by_host(requests.where(has_host).select("url", *([order] if order and order != "url" else [])), "url", order, tasks)
    asked = d.select("url", "host", "turn").mapInArrow(run, schema)
    given = {"url": F.col("url"), "final_url": F.col("url"), "error_kind": F.lit("transport"), "error": F.lit("no absolute URL"), "attempts": F.lit(0)}
    never = requests.where(~has_host).select(*(given.get(f, F.lit(None)).cast(t).alias(f) for f, t in (x.split() for x in schema.split(", "))))
    return asked.unionByName(never)


# ---------------------------------------------------------------- search


Step = tuple[str, Callable[[], Callable[[str], str | None]], Column]


def fall_through(rows: DataFrame, steps: list[Step], key: str = "company_id", attempts: int = 2, wait_s: float = 5.0, spacing: float = 0.0, concurrency: int = 1, path: str | None = None) -> DataFrame:
    """(key, answer, step, attempts, error) for each row of rows, which has each key once: the first step (name, provider, request) with an answer ends it.

    A step is asked only for rows that the ones before left open and whose request isn't null. If it fails, it is asked again after `wait_s` seconds, up to `attempts` times in all; then
    the row ends with the error and the step that it came from. Rows that no step answers have neither. A provider is one host, so one task asks it, `spacing` seconds between
    calls. Each step's answers are written under `path` (by default in the shared folder) before the next one is asked, so that a retried task asks nobody twice.
    """
    open_, ended = rows, []
    for name, make, request in steps:
        waiting = open_.select(key, request.alias("request")).where("request IS NOT NULL")
        asked = stored(run_pending(waiting, _again(make, attempts, wait_s), key=key, concurrency=concurrency, tasks=1, spacing=spacing, retries=0), f"asked-{name}", path)
        part = F.split("answer", "\n", 2)
        answer = F.nullif(F.trim(F.get(part, F.lit(1))), F.lit(""))
        tries = F.coalesce(F.get(part, F.lit(0)).cast("int"), F.lit(attempts))
        ended.append(asked.select(key, answer.alias("answer"), F.lit(name).alias("step"), tries.alias("attempts"), "error").where("answer IS NOT NULL OR error IS NOT NULL"))
        open_ = open_.join(ended[-1].select(key), key, "left_anti")
    out = open_.select(key, *(F.lit(None).cast(t).alias(c) for c, t in (("answer", "string"), ("step", "string"), ("attempts", "int"), ("error", "string"))))
    for e in ended:
        out = out.unionByName(e)
    return out


def search_chain(queries: DataFrame, engines: list[tuple[str, Callable[[], Callable[[str], str | None]]]], key: str = "company_id", wait_s: float = 5.0, spacing: float = 1.5, concurrency: int = 1, path: str | None = None) -> DataFrame:
    """(key, website, engine, attempts, error) for each row of queries(key, query): the first engine with a hit answers, each asked once more if it fails (see fall_through)."""
    found = fall_through(queries, [(n, make, F.col("query")) for n, make in engines], key, 2, wait_s, spacing, concurrency, path)
    return found.select(key, F.col("answer").alias("website"), F.col("step").alias("engine"), "attempts", "error")


def _again(make: Callable[[], Callable[[str], str | None]], attempts: int, wait_s: float) -> Callable[[], Callable[[str], str]]:
    """The tries that a call took, and its answer, as one text."""

    def opened() -> Callable[[str], str]:
        call = make()

        def ask(request: str) -> str:
            for n in range(1, attempts + 1):
                try:
                    return f"{n}\n{call(request) or ''}"
                except Exception:  # noqa: BLE001  any failure is worth another try
                    if n == attempts:
                        raise
                    time.sleep(wait_s)
            raise AssertionError

        return ask

    return opened


def answered(hits: DataFrame, engines: list[str], key: str = "company_id") -> DataFrame:
    """search_chain() over a table of what engines answered: hits(key, engine, attempt, url, error). (key, website, engine, attempts, error) of keys with rows.

    One pass and one shuffle: a key's rows are folded in the engines' order. An engine without a row for a key has no hit.
    """
    rank = F.array_position(F.array(*map(F.lit, engines)), F.col("engine"))
    failed = F.col("error").isNotNull()
    each = hits.where(F.col("engine").isin(engines) & (F.col("attempt") <= 2)).groupBy(key, rank.alias("rank"), "engine").agg(
        F.max_by(F.struct("url", "error"), "attempt").alias("last"), F.max("attempt").cast("int").alias("attempts"), F.count_if(failed & (F.col("attempt") == 1)).alias("first_failed")
    )
    last = F.when(F.col("last.error").isNull(), F.nullif(F.trim("last.url"), F.lit("")))
    each = each.withColumns({"website": last, "error": F.when(F.col("attempts") == 2, F.col("last.error"))})
    ends = F.col("website").isNotNull() | F.col("error").isNotNull()
    best = F.min_by(F.when(ends, F.struct("website", "engine", "attempts", "error")), F.when(ends, F.col("rank")))
    return each.groupBy(key).agg(best.alias("b")).select(key, "b.website", "b.engine", "b.attempts", "b.error")
