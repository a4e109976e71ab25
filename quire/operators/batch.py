"""A resumable batch over many books: what is to be done, and what became of it."""

from __future__ import annotations

import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("done", "convert_failed", "fetch_failed", "phase5_failed")


def to_do(books: DataFrame, manifest: DataFrame, only: str | None = None, at_most: int | None = None) -> DataFrame:
    """Books (pos, slug, ...) that are not done, in order; of one slug if only is given, at most at_most."""
    b = books if only is None else books.where(F.col("slug") == only)
    b = b.join(manifest.where("status = 'done'").select("slug"), "slug", "left_anti").orderBy("pos")
    return b if at_most is None else b.limit(at_most)


def error_classes(manifest: DataFrame) -> DataFrame:
    """(error_class, n) of what failed, most common first."""
    return manifest.where("status <> 'done'").groupBy(F.coalesce("error_class", F.lit("")).alias("error_class")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "error_class")


def vault_path(vault: Column, domain: Column, slug: Column) -> Column:
    return F.concat_ws("/", vault, F.when(domain != "", domain), slug)


def update(manifest: DataFrame, results: DataFrame) -> DataFrame:
    """The manifest with the results' rows in place of older ones of their slugs."""
    return manifest.join(results.select("slug"), "slug", "left_anti").unionByName(results, allowMissingColumns=True)


def run(slugs: list[str], work: Callable[[str], None], stop_file: str | None = None, breaker: int = 3, after: Callable[[dict], None] | None = None) -> list[dict]:
    """Results of work on each slug in turn; a failure is a row, not the end. Ends early at a stop file, or after breaker failures in a row. after gets each result as soon as it is there, to be written down."""
    out, streak = [], 0
    for s in slugs:
        if stop_file and Path(stop_file).exists():
            break
        began = time.monotonic()
        try:
            work(s)
            row = {"slug": s, "status": "done", "error": None, "error_class": None}
        except Exception as e:  # noqa: BLE001
            row = {"slug": s, "status": "convert_failed", "error": str(e)[-2000:], "error_class": type(e).__name__}
        out.append(row | {"minutes": round((time.monotonic() - began) / 60, 1)})
        if after is not None:
            after(out[-1])
        streak = 0 if row["status"] == "done" else streak + 1
        if streak >= breaker:
            break
    return out
