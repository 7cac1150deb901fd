"""Fetching as a data source: rows of (url, status, body, error, attempts), partitioned by URL bucket.

The fetch itself is a plain function (url, timeout[, form]) -> (status, body bytes, headers), so that tests and
offline runs put their own in its place; everything downstream is a transformation of the rows. A form is posted.
A task keeps its session, its politeness delay and its breaker to itself: the whole rate is partitions x rate.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timezone
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawmill.functions.text import CHALLENGE_HEAD, NOT_FOUND, RETRYABLE, safe_decode, strip_bom

SCHEMA = "url string, form string, status int, body binary, error string, attempts int"
AGENTS = ("Mozilla/5.0 (compatible; lawmill)", "Mozilla/5.0 (X11; Linux x86_64; compatible; lawmill)")
Fetcher = Callable[..., tuple[int, bytes, dict]]


class Session:
    """A fetcher with cookies and an agent name of its own, which ``rotate`` gives up for new ones."""

    def __init__(self):
        self.turn = -1
        self.rotate()

    def rotate(self) -> None:
        from urllib.request import HTTPCookieProcessor, build_opener

        self.turn += 1
        self.opener = build_opener(HTTPCookieProcessor())
        self.opener.addheaders = [("User-Agent", AGENTS[self.turn % len(AGENTS)])]

    def __call__(self, url: str, timeout: float, form: str | None = None) -> tuple[int, bytes, dict]:
        from urllib.error import HTTPError
        from urllib.request import Request

        headers = {"Content-Type": "application/x-www-form-urlencoded", "X-Requested-With": "XMLHttpRequest"} if form is not None else {}
        try:
            with self.opener.open(Request(url, None if form is None else form.encode(), headers), timeout=timeout) as r:
                return r.status, r.read(), dict(r.headers)
        except HTTPError as e:
            return e.code, e.read(), dict(e.headers)


class LibrarySession(Session):
    """The same over a library of the requests kind, if it can be imported."""

    library = "requests"

    def rotate(self) -> None:
        import importlib

        module = importlib.import_module(self.library)
        self.turn += 1
        self.client = module.create_scraper() if hasattr(module, "create_scraper") else module.Session()
        self.client.headers["User-Agent"] = AGENTS[self.turn % len(AGENTS)]

    def __call__(self, url: str, timeout: float, form: str | None = None) -> tuple[int, bytes, dict]:
        r = self.client.get(url, timeout=timeout) if form is None else self.client.post(url, data=form, timeout=timeout, headers={"Content-Type": "application/x-www-form-urlencoded"})
        return r.status_code, r.content, dict(r.headers)


class ScraperSession(LibrarySession):
    library = "cloudscraper"


def transport(name: str = "auto") -> Callable[[], Fetcher]:
    """What makes a task's session: "urllib", "requests", "cloudscraper", or the last of them that is there for "auto"."""
    known = {"urllib": Session, "requests": LibrarySession, "cloudscraper": ScraperSession}
    if name != "auto":
        return known[name]

    def best() -> Fetcher:
        for kind in (ScraperSession, LibrarySession):
            try:
                return kind()
            except ImportError:
                continue
        return Session()

    return best


def is_challenge(body: bytes) -> bool:
    head = body[: 4 * CHALLENGE_HEAD].decode("utf-8", "replace")[:CHALLENGE_HEAD].lower()
    return "just a moment" in head and "cloudflare" in head or "cf-challenge" in head


def says_missing(body: bytes) -> bool:
    low = body.decode("utf-8", "replace").lower()
    return any(x in low for x in NOT_FOUND)


def asked_pause(headers: dict, now: Callable[[], datetime] = lambda: datetime.now(timezone.utc)) -> float:
    """Seconds that a Retry-After header asks for, a number or a date; 0 without one."""
    value = next((v for k, v in headers.items() if k.lower() == "retry-after"), "").strip()
    try:
        return max(0.0, float(value))
    except ValueError:
        pass
    try:
        return max(0.0, (parsedate_to_datetime(value) - now()).total_seconds())
    except (TypeError, ValueError):
        return 0.0


def attempt(url: str, fetch: Fetcher, retries: int, timeout: float, sleep: Callable[[float], None], form: str | None = None, missing: bool = False) -> tuple:
    """One URL, tried again after transport errors, challenge pages and retryable statuses only, each time with a new session
    if the fetcher has one; 404 is an answer, and so is a body that says so where ``missing`` asks for it."""
    error = None
    for n in range(1, retries + 2):
        try:
            status, body, headers = fetch(url, timeout) if form is None else fetch(url, timeout, form)
            challenged = status < 400 and is_challenge(body)
            if status not in RETRYABLE and not challenged:
                gone = status >= 400 or missing and says_missing(body)
                return url, form, status if status >= 400 or not gone else 404, None if gone else body, f"status {status if status >= 400 else 404}" if gone else None, n
            error = "challenge page" if challenged else f"status {status}"
            floor = {429: 8.0, 403: 5.0}.get(status, 1.0)
            pause = max(asked_pause(headers), min(120.0, floor * 2 ** (n - 1)))
        except Exception as e:  # noqa: BLE001 - whatever goes wrong is this row's error
            error, pause = str(e), 2.0 * 2**n
        getattr(fetch, "rotate", lambda: None)()
        if n <= retries:
            sleep(pause)
    return url, form, None, None, error, retries + 1


def fetch_all(
    urls: DataFrame, fetch: Fetcher | None = None, partitions: int = 16, retries: int = 3, timeout: float = 30.0, delay: float = 0.3,
    breaker: int = 5, breaker_pause: float = 60.0, sleep: Callable[[float], None] = time.sleep, missing: bool = False, session: Callable[[], Fetcher] = Session,
) -> DataFrame:
    """The answers to ``urls`` (url, and form where it is to be posted), each once. A failure is a row with its error, never an exception."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get, streak = fetch or session(), 0
        for b in batches:
            rows = []
            for u, form in zip(b["url"], b["form"]):
                row = attempt(u, get, retries, timeout, sleep, form, missing)
                streak = streak + 1 if row[2] is None else 0
                if streak >= breaker:
                    sleep(breaker_pause)
                    streak = 0
                sleep(delay)
                rows.append(row)
            yield pd.DataFrame(rows, columns=["url", "form", "status", "body", "error", "attempts"])

    form = F.col("form") if "form" in urls.columns else F.lit(None).cast("string").alias("form")
    return urls.select("url", form).where("url is not null").distinct().repartition(partitions, "url", "form").mapInPandas(run, SCHEMA)


def page_text(body: Column) -> Column:
    """An answer's text: UTF-8 without its byte-order mark, broken sequences replaced."""
    return strip_bom(safe_decode(body))


def pages(wanted: DataFrame, fetch: Fetcher | None = None, **options) -> DataFrame:
    """``wanted`` (url, form where posted, and other columns) with the page's text and the error, if any, of each."""
    keys = ["url", "form"] if "form" in wanted.columns else ["url"]
    a = fetch_all(wanted, fetch, **options).select(*keys, page_text(F.col("body")).alias("page"), F.col("error").alias("fetch_error"))
    on = [wanted[k].eqNullSafe(a[k]) for k in keys]
    return wanted.join(a, on, "left").drop(*(a[k] for k in keys))


def head(url: str, timeout: float) -> tuple[int, bytes, dict]:
    """A fetcher that asks whether a page exists and reads none of it."""
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url, method="HEAD", headers={"User-Agent": "lawmill"}), timeout=timeout) as r:
            return r.status, b"", dict(r.headers)
    except HTTPError as e:
        return e.code, b"", dict(e.headers)


def existing(urls: DataFrame, fetch: Fetcher = head, **options) -> DataFrame:
    """The URLs that answer."""
    return fetch_all(urls, fetch, **options).where("status < 400").select("url")
