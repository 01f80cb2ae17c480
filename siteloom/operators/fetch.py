"""Fetching with injected clients, so many at a time and a host, and stored bodies in their place."""

from __future__ import annotations

import random
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pages, urls

NOT_PUBLIC, FAILED = "[ERROR] Internal/non-public domain", "[ERROR] All methods failed"
BAD_CERTIFICATE, BLOCKED = "[SKIP:CERT_MISMATCH]", "[SKIP:403_BLOCKED]"
#: Addresses that a task asks for at a time, and of one host.
AT_ONCE, OF_A_HOST = 8, 2
#: Characters of a refused page that are searched for signs of a wall.
LOOKED_AT = 16_000


class CertificateError(Exception):
    """The certificate isn't the host's."""


@dataclass(frozen=True)
class Response:
    """What a client got; retry_after in seconds, if it was told."""

    status: int | None
    body: str = ""
    retry_after: float = 0.0


@dataclass(frozen=True)
class Client:
    """get takes an address and the attempt, gives a Response and raises OSError for a network error.

    A plain client tries again so many times: for a busy status after base * 2 ** attempt seconds or what it was told,
    for a network error, if it does so at all, from error_base on. After a lenient client's second attempt any answer
    but a body sends the address on. A browser isn't shown addresses that aren't public, and what it shows counts
    whatever the status, but for missing pages and walls.
    """

    get: Callable[[str, int], Response]
    retries: int = 2
    base: float = 0.75
    error_base: float | None = 0.5
    lenient: bool = False
    browser: bool = False


def lenient(get: Callable[[str, int], Response]) -> Client:
    """A second client: one more attempt for a busy status, none for errors."""
    return Client(get, retries=1, error_base=None, lenient=True)


def browser(get: Callable[[str, int], Response]) -> Client:
    """A last client, which renders pages."""
    return Client(get, retries=0, browser=True)


def action(status: int | None, attempt: int, retries: int = 2) -> str:
    """The decision of functions.pages.http_action for one response."""
    if status is None or status in (401, 404, 410):
        return "skip"
    if 200 <= status < 300:
        return "body"
    if status in (403, 429) or 500 <= status < 600:
        return "retry" if attempt < retries else "fall_through"
    return "skip"


def backoff(attempt: int, base: float = 0.75, rng: random.Random | None = None) -> float:
    return base * 2**attempt * (rng or random).uniform(0.5, 1.5)


def rendered(got: Response) -> str | None:
    """What a browser's page counts as."""
    if got.status in (404, 410):
        return "[SKIP:404]"
    sample = got.body[:LOOKED_AT]
    walled = len(sample) < pages.BLOCKED_BELOW or any(sign in sample.lower() for sign in pages.BLOCKED)
    return BLOCKED if got.status in (401, 403) and walled else got.body or None


def asked(client: Client, url: str, wait: Callable[[float], None]) -> str | None:
    """A body or a mark from one client; None sends the address to the next one."""
    for attempt in range(client.retries + 1):
        try:
            got = client.get(url, attempt)
        except CertificateError:
            return None if client.lenient or client.browser else BAD_CERTIFICATE
        except OSError:  # timeouts among them
            if client.error_base is None or attempt == client.retries:
                return None
            wait(backoff(attempt, client.error_base))
            continue
        except Exception:  # noqa: BLE001  whatever else a client runs into is no answer
            return None
        if client.browser:
            return rendered(got)
        does = action(got.status, attempt, client.retries)
        if does == "body":
            return got.body or None
        if does == "skip":
            return None if client.lenient and attempt else f"[SKIP:{got.status}]"
        if does == "fall_through":
            return None
        wait(max(got.retry_after, backoff(attempt, client.base)))
    return None


def fetch_one(url: str, clients: list[Client], wait: Callable[[float], None] = time.sleep, public: bool = True) -> str:
    """The body from the first client that has one, a mark for an address to skip, or that all failed."""
    for client in clients:
        if client.browser and not public:
            return NOT_PUBLIC
        got = asked(client, url, wait)
        if got is not None:
            return got
    return FAILED


@dataclass
class _Hosts:
    """A gate for each host of a task, which lets so many through at a time."""

    gates: dict[str, threading.Semaphore] = field(default_factory=dict)
    lock: threading.Lock = field(default_factory=threading.Lock)

    def __call__(self, host: str) -> threading.Semaphore:
        with self.lock:
            return self.gates.setdefault(host, threading.Semaphore(OF_A_HOST))


def answers(clients: list[Client], wait: Callable[[float], None]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A task's work: (url, body) of addresses with their host and whether they are public, AT_ONCE at a time."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hosts = _Hosts()

        def one(address: str, public: bool, name: str) -> str:
            with hosts(name):
                return fetch_one(address, clients, wait, public)

        with ThreadPoolExecutor(AT_ONCE) as pool:
            for part in parts:
                yield pd.DataFrame({"url": part["url"], "body": list(pool.map(one, part["url"], part["_public"], part["_host"]))})

    return run


def fetch(rows: DataFrame, clients: list[Client], url: str = "page_url", wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """(url, body) of each distinct address.

    Rows are dealt by host, so the gates of a task hold for the whole run.
    """
    host = F.regexp_extract("url", r"://([^/]*)", 1)
    distinct = rows.select(F.col(url).alias("url")).distinct().withColumn("_public", ~urls.not_public(F.col("url"))).withColumn("_host", host)
    return distinct.repartition("_host").mapInPandas(answers(clients, wait), "url string, body string")


def fetched(rows: DataFrame, clients: list[Client], wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """rows with `body` from clients."""
    got = fetch(rows, clients, wait=wait).withColumnRenamed("url", "page_url")
    return rows.join(got, "page_url", "left")


def stored(rows: DataFrame, bodies: DataFrame) -> DataFrame:
    """rows with `body` and page_id from a table (url_hash, page_id, html), one for each page of the key; others have failed."""
    found = rows.join(bodies.select("url_hash", "page_id", "html"), "url_hash", "left")
    return found.withColumn("body", F.coalesce("html", F.lit(FAILED))).drop("html")


def with_text(rows: DataFrame, closed: bool = False) -> DataFrame:
    return rows.withColumn("page_text", pages.visible_text(F.col("body"), closed)).drop("body")
