"""Ports for extraction passes that run elsewhere: a local program, or a service that is asked, polled and fetched from.

Nothing here starts a GPU or opens a connection; callers give the functions that do, tests give fakes.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Protocol

from .guards import Permanent, require_https, retry


class Extractor(Protocol):
    """Makes content lists of pages [first, last] of a file in a folder, or raises."""

    def run(self, pdf: str, first: int, last: int, out: str, timeout: float) -> None: ...


def run_chunks(extractor: Extractor, pdf: str, chunks: list[tuple[int, int]], out: str, timeout: float = 7_200.0) -> list[str]:
    """A pass over a book in chunks, each in a folder of its own; a chunk whose folder is complete is not run again. The folders, in order."""
    done = []
    for first, last in chunks:
        at = Path(out, f"pass_p{first}-{last}")
        if not (at / ".done").exists():
            at.mkdir(parents=True, exist_ok=True)
            extractor.run(pdf, first, last, str(at), timeout)
            (at / ".done").touch()
        done.append(str(at))
    return done


def token(given: str | None = None, variable: str = "QUIRE_TOKEN", file: str | None = None) -> str:
    """The service's token: as given, from the environment, or from a file; an error where there is none."""
    found = given or os.environ.get(variable) or (Path(file).read_text(encoding="utf-8").strip() if file and Path(file).exists() else "")
    if not found:
        raise ValueError("no token for the service")
    return found


@dataclass
class Service:
    """A service by its three calls: submit(name) -> (job, upload address), state(job) -> (state, result address or message), fetch(address) -> bytes; put(address, data) uploads."""

    submit: Callable[[str], tuple[str, str]]
    put: Callable[[str, bytes], None]
    state: Callable[[str], tuple[str, str]]
    fetch: Callable[[str], bytes]
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    log: list[str] = field(default_factory=list)


def run_service(service: Service, name: str, data: bytes, poll_seconds: float = 5.0, timeout: float = 1_800.0, attempts: int = 3) -> bytes:
    """Submit, upload, poll until it is done, fetch. Each call is tried again as `guards.retry` allows; a failed job or no end in time is `Permanent`. Addresses must be https."""
    call = lambda f: retry(f, times=attempts, sleep=service.sleep)
    job, to = call(lambda: service.submit(name))
    require_https(to)
    call(lambda: service.put(to, data))
    until = service.clock() + timeout
    while True:
        state, told = call(lambda: service.state(job))
        service.log.append(f"{job}: {state}")
        if state == "done":
            require_https(told)
            return call(lambda: service.fetch(told))
        if state == "failed":
            raise Permanent(f"{name}: {told}")
        if service.clock() >= until:
            raise Permanent(f"{name}: no end in {timeout:g} s")
        service.sleep(poll_seconds)
