"""Heading repair from a table of contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip


def title_key(s: Column) -> Column:
    """Letters and digits of a title, without a leading chapter, appendix or part number."""
    low = F.lower(strip(F.coalesce(s, F.lit(""))))
    return F.regexp_replace(F.regexp_replace(low, r"(?U)\A(?:part|chapter|appendix)\s+[clxvi\d]+\s*[.:-]?\s*", ""), "[^a-z0-9]+", "")


def first_level(toc: DataFrame) -> DataFrame:
    """(book, seq, title, page): level-1 entries that have a destination, pages from 0."""
    return toc.where("level = 1 AND page1 >= 1").select("book", "seq", "title", (F.col("page1") - 1).alias("page"))


_PAIR = T.ArrayType(T.StructType([T.StructField("seq", T.LongType()), T.StructField("ord", T.LongType())]))


def match(blocks: DataFrame, entries: DataFrame) -> DataFrame:
    """(book, seq, ord): each entry, in order, takes the first text block that is left, has its title key and lies on its page - 1 to + 2.

    Only entries and blocks of one title compete; those few are settled by a fold over the entry order.
    """
    b = blocks.where("type = 'text'").select("book", F.col("ord").cast("long").alias("ord"), F.coalesce("abs_page", F.lit(-99)).alias("p"), title_key(F.col("text")).alias("key")).where("key <> ''")
    e = entries.select("book", F.col("seq").cast("long").alias("seq"), "page", title_key(F.col("title")).alias("key")).where("key <> ''")
    near = e.join(b, ["book", "key"]).where((F.col("p") >= F.col("page") - 1) & (F.col("p") <= F.col("page") + 2))
    groups = near.groupBy("book", "key").agg(F.array_sort(F.collect_list(F.struct("seq", "ord"))).alias("c"))
    free = lambda acc, x: ~F.exists(acc, lambda t: (t["seq"] == x["seq"]) | (t["ord"] == x["ord"]))
    taken = F.aggregate("c", F.array().cast(_PAIR), lambda acc, x: F.when(free(acc, x), F.concat(acc, F.array(x))).otherwise(acc))
    return groups.select("book", F.explode(taken).alias("t")).select("book", F.col("t.seq").alias("seq"), F.col("t.ord").alias("ord"))


SET = ("book", "ord", "type", "text", "text_level", "abs_page", "src")


def apply(blocks: DataFrame, entries: DataFrame, gate: int = 3) -> DataFrame:
    """blocks (book, ord, type, text, text_level, abs_page, src, and any others, null in new ones) with repaired headings, renumbered by `ord`.

    A matched block becomes level 1 with the entry's title. An entry without one becomes a new block before the first block of its page
    or later, if its page has text; several at one place come in reverse order. Where at least gate entries matched, other level-1
    texts of the book go to level 2.
    """
    e = entries.withColumn("seq", F.col("seq").cast("long"))
    m = match(blocks, e)
    named = m.join(e.select("book", "seq", "title"), ["book", "seq"]).select(F.col("book").alias("__b"), F.col("ord").alias("__o"), strip(F.col("title")).alias("__title"))
    n = m.groupBy("book").agg(F.count(F.lit(1)).alias("n_matched"))
    rest = e.where(title_key(F.col("title")) != "").join(m.select("book", "seq"), ["book", "seq"], "left_anti")
    # a page's own or next block: the least ord of this and later pages, by one window over distinct pages
    p = blocks.groupBy("book", F.coalesce("abs_page", F.lit(-99)).alias("p")).agg(F.min("ord").alias("o"), F.max((F.col("type") == "text").cast("int")).alias("has_text"))
    at = F.min("o").over(Window.partitionBy("book").orderBy("p").rowsBetween(Window.currentRow, Window.unboundedFollowing))
    p = p.withColumn("at", at).where("has_text = 1").select("book", F.col("p").alias("page"), "at")
    where = rest.join(p, ["book", "page"]).select("book", "seq", "title", "page", "at")
    joined = blocks.join(named, (F.col("book") == F.col("__b")) & (F.col("ord") == F.col("__o")), "left").join(n, "book", "left")
    level = F.when(F.col("__title").isNotNull(), 1).when((F.col("n_matched") >= gate) & (F.col("type") == "text") & (F.col("text_level") == 1), 2).otherwise(F.col("text_level"))
    kept = joined.select("book", F.col("ord").cast("long").alias("__at"), F.lit(1).alias("__k"), F.lit(0).cast("long").alias("__s"), "type", F.coalesce("__title", "text").alias("text"), level.cast("int").alias("text_level"), "abs_page", "src", *(c for c in blocks.columns if c not in SET))
    new = where.select("book", F.col("at").cast("long").alias("__at"), F.lit(0).alias("__k"), (-F.col("seq")).alias("__s"), F.lit("text").alias("type"), strip(F.col("title")).alias("text"), F.lit(1).alias("text_level"), F.col("page").cast("int").alias("abs_page"), F.lit("toc").alias("src"))
    w = Window.partitionBy("book").orderBy("__at", "__k", "__s")
    return kept.unionByName(new, allowMissingColumns=True).withColumn("ord", F.row_number().over(w) - 1).drop("__at", "__k", "__s")
