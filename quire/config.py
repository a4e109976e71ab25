"""Settings of a run, read from TOML."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class Config:
    chunk_pages: int = 40
    run_pages: int = 25
    run_gap: int = 3
    sample_pages: int = 20
    seed: int = 42
    breaker: int = 3
    pass_timeout: int = 7_200
    page_limit: int = 200
    poll_timeout: int = 1_800
    poll_seconds: float = 5.0
    retries: int = 3
    retry_delay: float = 2.0
    vault: str = ""


def load(path: str | None = None, user: str | None = None, project: str | None = None) -> Config:
    """The settings of path alone if it is given, which then must exist; else of the user's file, and over them the project's, where those exist. Keys that are no setting are ignored."""
    files = [path] if path else [f for f in (user, project) if f and Path(f).exists()]
    known = {f.name for f in fields(Config)}
    out = Config()
    for f in files:
        found = tomllib.loads(Path(f).read_text(encoding="utf-8"))
        out = replace(out, **{k: v for k, v in found.items() if k in known})
    return out
