"""Title and year of documents from their first pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import lines, strip

YEAR = r"(?:19|20)[0-9]{2}"
RIGHTS = rf"(?iU)copyright\s*(?:©|\(c\))?\s*{YEAR}"


def _title_line(l: Column) -> Column:
    letters = F.length(F.regexp_replace(l, r"(?U)\P{Alpha}", ""))
    low = F.lower(l)
    bad = l.rlike(YEAR) | l.contains("©") | low.contains("http") | low.rlike(r"\A(?:all rights|copyright|isbn|www\.)")
    return (F.length(l) >= 8) & (F.length(l) <= 90) & ~bad & (letters / F.greatest(F.length(l), F.lit(1)) > 0.6)


def title_from(pages: Column, file: Column) -> tuple[Column, Column]:
    """(title, confidence) from an array of page texts: the first line of six pages that looks like one, else the file's name."""
    ls = F.flatten(F.transform(F.slice(pages, 1, 6), lambda p: F.transform(lines(p), strip)))
    found = F.get(F.filter(ls, _title_line), F.lit(0))
    name = F.regexp_replace(F.regexp_replace(F.regexp_extract(file, r"([^/]*)\z", 1), r"(?<=.)\.[^.]*\z", ""), r"\A[0-9]{10,13}-", "")
    return F.coalesce(found, strip(F.regexp_replace(name, "[_-]+", " "))), F.when(found.isNotNull(), "text").otherwise("filename-fallback")


def year_from(pages: Column) -> tuple[Column, Column]:
    """(year, confidence): the latest copyright year, else the latest year of the first of three pages that has one."""
    years = lambda p, r: F.transform(F.regexp_extract_all(p, F.lit(f"({r})"), 1), lambda m: F.regexp_extract(m, YEAR, 0).cast("int"))
    told = F.array_max(F.flatten(F.transform(pages, lambda p: years(p, RIGHTS))))
    loose = F.array_max(F.get(F.filter(F.transform(F.slice(pages, 1, 3), lambda p: years(p, YEAR)), lambda a: F.size(a) > 0), F.lit(0)))
    return F.coalesce(told, loose), F.when(told.isNotNull(), "copyright-line").when(loose.isNotNull(), "loose-year").otherwise("none-found")


def scan(books: DataFrame) -> DataFrame:
    """(file, pages, title, title_conf, year, year_conf, error) from file, npages, texts (array of up to ten page texts) and error; a book that could not be read keeps its error only."""
    texts = F.slice(F.coalesce("texts", F.array().cast("array<string>")), 1, 10)
    (t, tc), (y, yc) = title_from(texts, F.col("file")), year_from(texts)
    ok = F.col("error").isNull()
    return books.select("file", *(F.when(ok, c).alias(n) for n, c in (("pages", F.col("npages")), ("title", t), ("title_conf", tc), ("year", y), ("year_conf", yc))), "error")
