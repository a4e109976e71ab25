"""Chapters of a Markdown document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fences import in_code_lines
from ..functions.markdown import frontmatter, slug
from ..functions.text import blank, strip

TOP = r"(?U)\A# (.+)\z"
APPENDIX = r"(?U)\A## (Appendix [A-Z]\..+)\z"


def boundaries(docs: DataFrame, id_col: str, md_col: str = "md") -> DataFrame:
    """(id, line_no, title): first-level headings and lettered appendices outside of code."""
    ls = in_code_lines(docs, id_col, md_col)
    title = F.when(F.col("line").rlike(TOP), F.regexp_extract("line", TOP, 1)).when(F.col("line").rlike(APPENDIX), F.regexp_extract("line", APPENDIX, 1))
    return ls.where("NOT in_code").withColumn("title", strip(title)).where("title IS NOT NULL").select(id_col, "line_no", "title")


class NoBoundaries(ValueError):
    """Documents that cannot be split."""


def assert_bounded(docs: DataFrame, id_col: str, md_col: str = "md") -> None:
    """Raise if a document has no boundary; names the first twenty."""
    none = docs.select(id_col).join(boundaries(docs, id_col, md_col).select(id_col).distinct(), id_col, "left_anti")
    few = none.orderBy(id_col).limit(20).collect()
    if few:
        raise NoBoundaries("no chapter boundaries: " + ", ".join(str(r[0]) for r in few))


def split(docs: DataFrame, id_col: str, md_col: str = "md", book_col: str | None = None, source_col: str | None = None) -> DataFrame:
    """(id, chapter, title, file_name, content): chapters from 1, and what stands before the first, if not blank, as chapter 0.

    Headings become first level; newlines around the content are cut, one ends it. With book_col and source_col, constant in a
    document, the content begins with a head of title, book, chapter, source and tags. Documents without a boundary give no rows; see
    `assert_bounded`.
    """
    ls = in_code_lines(docs, id_col, md_col)
    raw = F.when(F.col("line").rlike(TOP), F.regexp_extract("line", TOP, 1)).when(F.col("line").rlike(APPENDIX), F.regexp_extract("line", APPENDIX, 1))
    ls = ls.withColumn("title", F.when(~F.col("in_code"), strip(raw)))
    w = Window.partitionBy(id_col).orderBy("line_no")
    ls = ls.withColumn("chapter", F.count("title").over(w)).withColumn("line", F.when(F.col("title").isNotNull(), F.concat(F.lit("# "), "title")).otherwise(F.col("line")))
    some = F.max("chapter").over(Window.partitionBy(id_col))
    ls = ls.withColumn("n", some).where("n > 0")
    g = ls.groupBy(id_col, "chapter").agg(F.max("title").alias("title"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("content"))
    g = g.where((F.col("chapter") > 0) | ~blank(F.col("content")))
    content = F.concat(F.regexp_replace("content", r"\A\n+|\n+\z", ""), F.lit("\n"))
    if book_col and source_col:
        about = docs.select(id_col, F.col(book_col).alias("__book"), F.col(source_col).alias("__source")).dropDuplicates([id_col])
        g = g.join(about, id_col)
        content = F.concat(frontmatter(F.coalesce("title", F.lit("Front matter")), F.col("__book"), F.col("chapter"), F.col("__source")), content)
    name = F.when(F.col("chapter") == 0, "00-front-matter.md").otherwise(F.concat(F.lpad(F.col("chapter").cast("string"), F.greatest(F.lit(2), F.length(F.col("chapter").cast("string"))), F.lit("0")), F.lit("-"), slug(F.col("title")), F.lit(".md")))
    return g.select(id_col, F.col("chapter").cast("long").alias("chapter"), "title", name.alias("file_name"), content.alias("content"))
