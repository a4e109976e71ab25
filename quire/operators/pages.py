"""Page-level relations: repeated lines, coverage, runs of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip

RICH = ("chart", "code", "equation", "image", "table")


def repeated_lines(blocks: DataFrame, pages: DataFrame, share: float = 0.6, least: int = 3, longest: int = 199) -> DataFrame:
    """(book, text, n_pages): short texts on at least max(least, floor(share * pages)) distinct pages of a book.

    blocks: book, abs_page, text; pages: book, npages. A null page is a page of its own. Distinct (text, page) pairs are reduced
    before the count, so a line on every page of a huge book makes one row per page, not one group in memory.
    """
    t = strip(F.col("text"))
    pairs = blocks.select("book", t.alias("text"), F.coalesce("abs_page", F.lit(-1)).alias("p")).where((F.length("text") > 0) & (F.length("text") <= longest)).distinct()
    return pairs.groupBy("book", "text").agg(F.count(F.lit(1)).alias("n_pages")).join(pages, "book").where(F.col("n_pages") >= F.greatest(F.lit(least), F.floor(F.lit(share) * F.col("npages")))).select("book", "text", "n_pages")


def drop_lines(blocks: DataFrame, repeated: DataFrame) -> DataFrame:
    """Blocks whose trimmed text is not one of the book's repeated lines."""
    r = repeated.select(F.col("book").alias("__b"), F.col("text").alias("__t"))
    return blocks.join(r, (F.col("book") == F.col("__b")) & (strip(F.col("text")) == F.col("__t")), "left_anti")


def scrub(md: Column, texts: Column) -> Column:
    """Each repeated line replaced by a space, longer ones first, then by code point."""
    order = F.array_sort(texts, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))
    return F.aggregate(order, md, lambda acc, w: F.replace(acc, w, F.lit(" ")))


def coverage_gaps(page_texts: DataFrame, blocks: DataFrame, least: int = 50) -> DataFrame:
    """(book, page) of pages with more than `least` characters of text but no block of any kind."""
    bearing = page_texts.where(F.length(strip(F.col("text"))) > least).select("book", "page")
    return bearing.join(blocks.select("book", F.col("abs_page").alias("page")).distinct(), ["book", "page"], "left_anti")


def covered_pages(blocks: DataFrame) -> DataFrame:
    """(book, n_pages): distinct pages that have a block."""
    return blocks.where("abs_page IS NOT NULL").groupBy("book").agg(F.count_distinct("abs_page").alias("n_pages"))


class CoverageError(ValueError):
    """Pages with text were dropped."""


def assert_covered(page_texts: DataFrame, blocks: DataFrame, least: int = 50) -> None:
    gaps = coverage_gaps(page_texts, blocks, least)
    few = gaps.orderBy("book", "page").limit(20).collect()
    if few:
        raise CoverageError("pages without blocks: " + ", ".join(f"{r['book']}:{r['page']}" for r in few))


def drawn_pages(pages: DataFrame, least: int = 20) -> DataFrame:
    """(book, page) of pages with tables, images or more than `least` drawings, from counts (book, page, tables, images, drawings)."""
    return pages.where((F.col("tables") > 0) | (F.col("images") > 0) | (F.col("drawings") > least)).select("book", "page")


def union_passes(passes: list[DataFrame]) -> DataFrame:
    """The blocks of passes over chunks of a book as one pass: pages are absolute, `ord` counts on from pass to pass by page."""
    all_ = passes[0]
    for p in passes[1:]:
        all_ = all_.unionByName(p, allowMissingColumns=True)
    w = Window.partitionBy("book").orderBy("abs_page", "ord")
    return all_.withColumn("ord", (F.row_number().over(w) - 1).cast("long"))


def rich_pages(blocks: DataFrame) -> DataFrame:
    """Distinct (book, page) with a table, image, chart, equation or code."""
    return blocks.where(F.col("type").isin(*RICH)).select("book", F.col("abs_page").alias("page")).distinct()


def group_runs(pages: DataFrame, gap: int = 3) -> DataFrame:
    """(book, a, b): runs of pages with at most gap pages between neighbours."""
    w = Window.partitionBy("book").orderBy("page")
    new = F.coalesce((F.col("page") - F.lag("page").over(w) > gap + 1).cast("int"), F.lit(1))
    return pages.withColumn("new", new).withColumn("run", F.sum("new").over(w)).groupBy("book", "run").agg(F.min("page").alias("a"), F.max("page").alias("b")).drop("run")


def cap_runs(runs: DataFrame, longest: int = 25) -> DataFrame:
    """Runs split into pieces of at most `longest` pages."""
    return runs.select("book", "b", F.explode(F.sequence("a", "b", F.lit(longest))).alias("a")).select("book", "a", F.least(F.col("a") + (longest - 1), F.col("b")).alias("b"))


def page_chunks(books: DataFrame, size: int = 40) -> DataFrame:
    """(book, a, b): the pages [first, last] of each book in chunks of size."""
    return cap_runs(books.select("book", F.col("first").alias("a"), F.col("last").alias("b")), size)


def failure_runs(attempts: DataFrame) -> DataFrame:
    """Attempts (book, seq, ok) with streak: how many failures in a row end here, 0 where it went well."""
    w = Window.partitionBy("book").orderBy("seq")
    block = F.sum(F.col("ok").cast("int")).over(w)
    s = attempts.withColumn("since", block)
    return s.withColumn("streak", F.sum((~F.col("ok")).cast("int")).over(Window.partitionBy("book", "since").orderBy("seq"))).drop("since")
