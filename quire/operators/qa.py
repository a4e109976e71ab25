"""Review queries over blocks."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank, lines, strip
from .render import assemble, brief


def flag(blocks: DataFrame) -> Column:
    """diverged before indent; null for code that is fine and all else."""
    return F.when(F.col("type") == "code", F.when(F.col("code_flag"), "diverged").when(F.col("indent_flag"), "indent"))


def flagged(blocks: DataFrame) -> DataFrame:
    """(book, rank, page, lang, flag, snippet): flagged code by page, pages from 1."""
    from pyspark.sql import Window

    w = Window.partitionBy("book").orderBy("page", "ord")
    snippet = F.left(F.coalesce(strip(F.get(F.filter(lines(F.coalesce("code_body", F.lit(""))), lambda l: ~blank(l)), F.lit(0))), F.lit("")), F.lit(80))
    f = blocks.withColumn("flag", flag(blocks)).where("flag IS NOT NULL").withColumn("page", F.coalesce("abs_page", F.lit(0)) + 1)
    return f.select("book", F.row_number().over(w).alias("rank"), "page", F.coalesce("sub_type", F.lit("")).alias("lang"), "flag", snippet.alias("snippet"))


def report(blocks: DataFrame) -> DataFrame:
    """(book, code_blocks, flagged, diverged, indent_suspect)."""
    f = flag(blocks)
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return blocks.groupBy("book").agg(n(F.col("type") == "code").alias("code_blocks"), n(f.isNotNull()).alias("flagged"), n(f == "diverged").alias("diverged"), n(f == "indent").alias("indent_suspect"))


def rank_books(reports: DataFrame, limit: int | None = None) -> DataFrame:
    """Reports, most flagged first; equal ones as they came (input_pos)."""
    out = reports.orderBy(F.desc("flagged"), "input_pos")
    return out if limit is None else out.limit(limit)


def review_pages(blocks: DataFrame, mapping: DataFrame) -> DataFrame:
    """(book, sample_idx, orig_page, md): the sampled pages' blocks in brief, empty where a page has none.

    mapping: book, sample_idx, orig_page and, if pages are mapped more than once, pos, of which the largest counts; without pos the
    largest orig_page.
    """
    last = F.max_by("orig_page", "pos") if "pos" in mapping.columns else F.max("orig_page")
    one = mapping.groupBy("book", "sample_idx").agg(last.alias("orig_page"))
    md = assemble(blocks.withColumn("md", brief(blocks)).withColumn("sample_idx", F.coalesce("abs_page", F.lit(0))), ["book", "sample_idx"])
    return one.join(md, ["book", "sample_idx"], "left").select("book", "sample_idx", "orig_page", F.coalesce("md", F.lit("")).alias("md"))


def pages_with_content(blocks: DataFrame) -> DataFrame:
    """(book, n_pages): distinct pages that have a block of any kind; blocks without a page are on page 0."""
    return blocks.groupBy("book").agg(F.count_distinct(F.coalesce("abs_page", F.lit(0))).alias("n_pages"))


def review_sheet(blocks: DataFrame, mapping: DataFrame) -> DataFrame:
    """(book, content): a text of all sampled pages in order, each under its page number in the book, from 1."""
    r = review_pages(blocks, mapping)
    part = F.concat(F.lit("=== page "), (F.col("orig_page") + 1).cast("string"), F.lit(" (sample "), F.col("sample_idx").cast("string"), F.lit(") ===\n"), "md")
    rows = F.array_sort(F.collect_list(F.struct("sample_idx", part.alias("part"))))
    return r.groupBy("book").agg(F.concat(F.array_join(F.transform(rows, lambda x: x["part"]), "\n\n"), F.lit("\n")).alias("content"))


def sample_pages(books: DataFrame, n: int = 20, seed: int = 42) -> DataFrame:
    """(book, page): n distinct pages from the middle nine tenths of each book, the same for a seed: those whose md5 with book and seed is least. books: book, npages; books without pages give none."""
    from pyspark.sql import Window

    low, high = F.floor(F.col("npages") * F.lit(0.05)), F.floor(F.col("npages") * F.lit(0.95))
    low, high = F.when(high > low, low).otherwise(0), F.when(high > low, high).otherwise(F.col("npages"))
    pages = books.where("npages > 0").select("book", F.explode(F.sequence(low.cast("int"), (high - 1).cast("int"))).alias("page"))
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("book").cast("string"), F.lit("")), F.lit(":"), F.col("page").cast("string")))
    w = Window.partitionBy("book").orderBy(draw, "page")
    return pages.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n).drop("r")


def sample_pages_compat(npages: int, n: int = 20, seed: int = 42) -> list[int]:
    """One book's sample by CPython's generator, for those who need its exact pages."""
    if npages < 1:
        raise ValueError("no pages")
    window = range(int(npages * 0.05), int(npages * 0.95)) or range(npages)
    return sorted(random.Random(seed).sample(window, min(n, len(window))))
