"""Search, fetch, completion and geocoding from outside: protocols, and a runner that retries, limits and isolates calls."""

from __future__ import annotations

import json
import os
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BACKOFF_BASE, BACKOFF_CAP, RETRIES = 0.5, 30.0, 2


class SearchProvider(Protocol):
    def search(self, query: str) -> str | None: ...


class FetchProvider(Protocol):
    def fetch(self, url: str) -> dict: ...


class CompletionProvider(Protocol):
    def complete(self, messages: str) -> str: ...


class GeocodeProvider(Protocol):
    def locate(self, query: dict) -> dict | None: ...


class ReleaseSink(Protocol):
    #: check() raises if releases can't be made, before anything is; exists() says whether a tag is taken.
    def check(self) -> None: ...
    def exists(self, tag: str) -> bool: ...
    def upload(self, tag: str, paths: list[str]) -> None: ...


class Transient(Exception):
    """A failure worth another try; retry_after is what the other side asked for."""

    def __init__(self, message: str, retry_after: float | None = None):
        super().__init__(message)
        self.retry_after = retry_after


def delay(attempt: int, retry_after: float | None = None, rand: Callable[[], float] = random.random) -> float:
    """Full jitter under a doubling cap, and no less than the other side asked for."""
    return max(rand() * min(BACKOFF_CAP, BACKOFF_BASE * 2**attempt), retry_after or 0.0)


def with_retries(call: Callable[[], str], retries: int = RETRIES, sleep: Callable[[float], None] = time.sleep) -> str:
    for attempt in range(retries + 1):
        try:
            return call()
        except Transient as e:
            if attempt == retries:
                raise
            sleep(delay(attempt, e.retry_after))
    raise AssertionError


@dataclass(frozen=True)
class Completions:
    """How completions are asked for over HTTP. The model is what is given, or else the environment's, or else the default; the key is read where the call is made.

    model_env, key_env: names of environment variables.
    """

    url: str
    default_model: str
    model: str | None = None
    model_env: str | None = None
    key_env: str | None = None
    temperature: float = 0.2
    timeout: float = 60.0
    extra: tuple[tuple[str, object], ...] = ()

    def resolved_model(self) -> str:
        return self.model or (os.environ.get(self.model_env, "") if self.model_env else "") or self.default_model

    def __call__(self) -> Callable[[str], str]:
        """A function of the messages as JSON that gives the answer's text. Whatever goes wrong is worth another try; a busy server may say when."""
        model = self.resolved_model()

        def complete(messages: str) -> str:
            body = {"model": model, "messages": json.loads(messages), "temperature": self.temperature, **dict(self.extra)}
            headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {os.environ.get(self.key_env, '')}"} if self.key_env else {})
            try:
                with urllib.request.urlopen(urllib.request.Request(self.url, json.dumps(body).encode(), headers), timeout=self.timeout) as r:
                    text = json.loads(r.read())["choices"][0]["message"]["content"]
            except urllib.error.HTTPError as e:
                asked = e.headers.get("Retry-After") if e.code == 429 or 500 <= e.code < 600 else None
                raise Transient(f"HTTP {e.code}", _seconds(asked)) from e
            except (OSError, ValueError, KeyError, IndexError, TypeError) as e:
                raise Transient(f"{type(e).__name__}: {e}") from e
            if not isinstance(text, str) or not text.strip():
                raise Transient("empty completion")
            return text

        return complete


def _seconds(asked: str | None) -> float | None:
    try:
        return float(asked) if asked else None
    except ValueError:
        return None


def run_pending(df: DataFrame, make: Callable[[], Callable[[str], str]], request: str = "request", key: str = "company_id", concurrency: int = 8, tasks: int = 8, spacing: float = 0.0, retries: int = RETRIES) -> DataFrame:
    """(key, answer, error) for each row of df(key, request), which should hold pending rows only.

    make() opens a provider once a task; a task keeps `concurrency` calls going. A call that fails gives its row an
    error and nothing else. Write the result before using it, so that a retried task doesn't ask twice.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = make()

        def one(text: str):
            try:
                if spacing:
                    time.sleep(spacing)
                return with_retries(lambda: call(text), retries), None
            except Exception as e:  # noqa: BLE001  a row's failure is that row's result
                return None, f"{type(e).__name__}: {e}"

        with ThreadPoolExecutor(concurrency) as pool:
            for p in parts:
                got = list(pool.map(one, p[request]))
                yield pd.DataFrame({key: p[key], "answer": [a for a, _ in got], "error": [e for _, e in got]})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, request).repartition(tasks, F.col(key)).mapInPandas(run, f"{key} {kind}, answer string, error string")
