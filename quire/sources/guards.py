"""Checks and retries at the edge to external services, as plain functions."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from pathlib import PurePosixPath
from urllib.parse import urlsplit, urlunsplit


class Permanent(Exception):
    """Trying again will not help."""


class Transient(Exception):
    """Trying again may help."""


def classify(status: int, code: int | None = None) -> None:
    """Raise for an HTTP status or an API code: 429 and 5xx are transient, other failures permanent."""
    if status == 429 or status >= 500:
        raise Transient(f"HTTP {status}")
    if status >= 400:
        raise Permanent(f"HTTP {status}")
    if code:
        raise Permanent(f"API code {code}")


def retry(call: Callable[[], object], times: int = 3, base: float = 2.0, longest: float = 30.0, sleep: Callable[[float], None] = time.sleep, rng: random.Random | None = None) -> object:
    """call(), again after transient failures with exponential backoff and full jitter."""
    rng = rng or random.Random()
    for n in range(1, times + 1):
        try:
            return call()
        except (Transient, ConnectionError, TimeoutError):
            if n == times:
                raise
            sleep(rng.uniform(0, min(longest, base * 2 ** (n - 1))))
    raise AssertionError("times must be positive")


def require_https(url: str) -> str:
    if urlsplit(url).scheme != "https":
        raise Permanent(f"not https: {redact(url)}")
    return url


def redact(url: str) -> str:
    """Without query and fragment, which may hold secrets."""
    s = urlsplit(url)
    return urlunsplit((s.scheme, s.netloc, s.path, "", ""))


def safe_member(name: str) -> str:
    """An archive member's name, unless it leads outside."""
    p = PurePosixPath(name.replace("\\", "/"))
    if p.is_absolute() or ".." in p.parts or (p.parts and p.parts[0].endswith(":")):
        raise Permanent(f"unsafe path: {name}")
    return str(p)


def within_limit(pages: int, most: int = 200) -> int:
    if pages > most:
        raise Permanent(f"{pages} pages; the limit is {most}")
    return pages


def one_mode(**modes: object) -> str | None:
    """The one mode that is set, or None; raises if there are several."""
    chosen = [k for k, v in modes.items() if v]
    if len(chosen) > 1:
        raise ValueError("choose one of " + ", ".join(chosen))
    return chosen[0] if chosen else None
