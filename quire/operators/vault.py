"""Queries over a vault of Markdown pages: domains, links, callouts, search, review findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import lines

CALLOUTS = ("bug", "contradiction", "gap", "warning")
SEVERITY = ("critical", "major", "minor", "info")


def with_place(pages: DataFrame) -> DataFrame:
    """pages (path, text) with domain and name: of wiki/domains/<domain>/.../<name>.md, null domain elsewhere."""
    d = F.regexp_extract("path", r"(?:\A|/)wiki/domains/([^/]+)/", 1)
    return pages.withColumn("domain", F.when(d != "", d)).withColumn("name", F.regexp_extract("path", r"([^/]*?)(?:\.md)?\z", 1))


def domains(pages: DataFrame) -> DataFrame:
    """(domain, n): what the vault covers."""
    return with_place(pages).where("domain IS NOT NULL").groupBy("domain").agg(F.count(F.lit(1)).alias("n"))


def links(pages: DataFrame) -> DataFrame:
    """(path, target): each [[target]], [[target|shown]] or [[target#part]] once."""
    found = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(r"\[\[([^\]|#\n]+)[^\]\n]*\]\]"), 1), lambda x: F.trim(x)))
    return pages.select("path", F.explode(found).alias("target"))


def broken_links(pages: DataFrame) -> DataFrame:
    """Links to names that no page has."""
    names = with_place(pages).select(F.col("name").alias("target")).distinct()
    return links(pages).join(names, "target", "left_anti")


def callouts(pages: DataFrame) -> DataFrame:
    """(path, line_no, kind, title): lines that open a trust callout."""
    rule = r"(?i)\A>\s*\[!(" + "|".join(CALLOUTS) + r")\][+-]?\s*(.*)\z"
    ls = pages.select("path", F.posexplode(lines(F.col("text"))).alias("line_no", "line")).where(F.col("line").rlike(rule))
    return ls.select("path", "line_no", F.lower(F.regexp_extract("line", rule, 1)).alias("kind"), F.regexp_extract("line", rule, 2).alias("title"))


def search(pages: DataFrame, words: list[str], limit: int = 20) -> DataFrame:
    """(path, score): pages by how many of the words their names (counting double) and texts hold; the best `limit`, ties by path."""
    low, name = F.lower("text"), F.lower("name")
    score = sum((F.when(name.contains(w.lower()), 2).otherwise(0) + F.when(low.contains(w.lower()), 1).otherwise(0) for w in words), F.lit(0))
    return with_place(pages).select("path", score.alias("score")).where("score > 0").orderBy(F.desc("score"), "path").limit(limit)


def coverage(signals: DataFrame, pages: DataFrame) -> DataFrame:
    """Signals (signal, domain) of a project whose domain the vault has."""
    return signals.join(domains(pages).select("domain"), "domain", "left_semi")


def findings(rows: DataFrame) -> DataFrame:
    """Findings (severity, place, page, claim) that cite both a file:line and a [[Page]], once each, ranked by severity, then place."""
    order: Column = F.coalesce(F.array_position(F.array(*(F.lit(s) for s in SEVERITY)), F.col("severity")), F.lit(0))
    order = F.when(order == 0, len(SEVERITY) + 1).otherwise(order)
    good = rows.where(F.col("place").rlike(r"\A[^:\s]+:\d+\z") & F.col("page").rlike(r"\A\[\[[^\]]+\]\]\z")).dropDuplicates(["place", "page", "claim"]).withColumn("__order", order)
    # ranks by severity and place: counts of what sorts before a place are few, one row for each
    places = good.groupBy("__order", "place").agg(F.count(F.lit(1)).alias("__n"))
    by_order = good.groupBy("__order").agg(F.count(F.lit(1)).alias("__m"))  # a row for each severity
    lower = by_order.withColumn("__below", F.coalesce(F.sum("__m").over(Window.orderBy("__order").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__order", "__below")
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("__order").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = places.withColumn("__before", before).join(F.broadcast(lower), "__order").select("__order", "place", (F.col("__before") + F.col("__below")).alias("__at"))
    within = F.row_number().over(Window.partitionBy("__order", "place").orderBy("claim", "page"))
    return good.join(at, ["__order", "place"]).withColumn("rank", (F.col("__at") + within).cast("int")).drop("__order", "__at")
