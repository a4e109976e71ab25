"""python -m quire.cli COMMAND: thin commands over the operators. Exit codes: 0 well, 1 some book failed, 2 wrong arguments."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config
from .operators import batch, chapters, graft, pages, qa, render, scan, toc
from .plans import chain
from .sources import readers


def convert(spark: SparkSession, base: str, model: str, book: str, out: str, texts: DataFrame | None = None, contents: DataFrame | None = None, images: DataFrame | None = None) -> None:
    """Splice a book's two passes and write <out>/blocks, <book>.md and <book>.blocks.json.

    texts: (book, page, text); pages with text that no block covers are an error. contents: (book, seq, level, title, page1), by which
    headings are repaired. images: (path) of files that are there; those that blocks name are copied to <out>/images.
    """
    of = lambda df: df.where(F.col("book") == book)
    start = readers.segment_start()
    b = readers.read_content_lists(spark, base, start).withColumn("book", F.lit(book))
    m = readers.read_content_lists(spark, model, start).withColumn("book", F.lit(book))
    b, m = pages.union_passes([b]), pages.union_passes([m])
    if texts is not None:
        pages.assert_covered(of(texts), b)
    n = b.groupBy("book").agg(F.count_distinct("abs_page").alias("npages"))
    repeated = pages.repeated_lines(b, n)
    merged = graft.merge(b, m, repeated).where("kept")
    if images is not None:
        merged = graft.with_images(merged, images)
    merged.write.mode("overwrite").parquet(f"{out}/blocks")
    done = spark.read.parquet(f"{out}/blocks")
    if images is not None:
        readers.copy_images(done.where("source IS NOT NULL"), out)
    if contents is not None:
        done = toc.apply(done, toc.first_level(of(contents)))
    noise = repeated.groupBy("book").agg(F.array_sort(F.collect_set("text")).alias("__noise"))
    md = render.assemble(done.withColumn("md", render.full(done)), ["book"]).join(noise, "book", "left")
    md = md.withColumn("md", pages.scrub(F.col("md"), F.coalesce("__noise", F.array().cast("array<string>"))))
    readers.write_named(md.select(F.concat("book", F.lit(".md")).alias("file_name"), F.col("md").alias("content")), out)
    readers.write_named(readers.blocks_json(done).select(F.concat("book", F.lit(".blocks.json")).alias("file_name"), "content"), out)


def _merge(spark: SparkSession, a: argparse.Namespace) -> int:
    texts = readers.read_pages(spark, a.texts) if a.texts else None
    contents = spark.read.parquet(a.contents) if a.contents else None
    images = readers.list_files(spark, a.images) if a.images else None
    convert(spark, a.base, a.model, a.book, a.out, texts, contents, images)
    return 0


def _clean(spark: SparkSession, a: argparse.Namespace) -> int:
    docs = readers.read_markdown(spark, a.md)
    if a.report:
        chain.full_report(docs, "path").show(1000, truncate=False, vertical=True)
    docs = chain.clean_table(docs)
    chapters.assert_bounded(docs, "path")
    docs = docs.withColumn("book", F.lit(a.book) if a.book else F.regexp_extract("path", r"([^/]*?)(?:\\.md)?\\z", 1)).withColumn("source", F.lit(a.source) if a.source else F.col("path"))
    c = chapters.split(docs, "path", book_col="book", source_col="source")
    if a.apply:
        readers.write_named(c, a.out)
    else:
        c.select("path", "chapter", "title", "file_name").orderBy("path", "chapter").show(1000, truncate=False)
    return 0


def _flags(spark: SparkSession, a: argparse.Namespace) -> int:
    b = spark.read.parquet(a.blocks)
    qa.rank_books(qa.report(b).withColumn("input_pos", F.col("book"))).show(1000, truncate=False)
    qa.flagged(b).orderBy("book", "rank").show(1000, truncate=False)
    return 0


def _sample(spark: SparkSession, a: argparse.Namespace) -> int:
    """Pages to be looked at, as a mapping from their place in the sample."""
    from pyspark.sql import Window

    books = spark.read.parquet(a.blocks).groupBy("book").agg((F.max("abs_page") + 1).cast("int").alias("npages"))
    s = qa.sample_pages(books, a.n, a.seed)
    place = F.row_number().over(Window.partitionBy("book").orderBy("page")) - 1
    s.select("book", place.alias("sample_idx"), F.col("page").alias("orig_page")).write.mode("overwrite").parquet(a.out)
    return 0


def _review(spark: SparkSession, a: argparse.Namespace) -> int:
    sheet = qa.review_sheet(spark.read.parquet(a.blocks), spark.read.parquet(a.mapping))
    readers.write_named(sheet.select(F.concat("book", F.lit(".review.txt")).alias("file_name"), "content"), a.out)
    return 0


def _scan(spark: SparkSession, a: argparse.Namespace) -> int:
    p = readers.read_pages(spark, a.pages).where("page < 10")
    books = p.groupBy(F.col("book").alias("file")).agg(F.count(F.lit(1)).cast("int").alias("npages"), F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda x: x["text"]).alias("texts")).withColumn("error", F.lit(None).cast("string"))
    r = scan.scan(books)
    r.orderBy("file").show(1000, truncate=False)
    return int(not r.where("error IS NOT NULL").isEmpty())


MANIFEST = "slug string, status string, domain string, minutes double, error string, error_class string, vault_path string"


def _batch(spark: SparkSession, a: argparse.Namespace) -> int:
    """Convert the books of a TOML file that are not done. <passes>/<slug>/base and /model hold their content lists. The manifest is written anew after each book."""
    books = readers.read_books(spark, a.books)
    had = readers.read_manifest(spark, a.manifest) if Path(a.manifest).exists() else spark.createDataFrame([], MANIFEST)
    state = {r["slug"]: r.asDict() for r in had.toLocalIterator()}
    todo = {r["slug"]: r.asDict() for r in batch.to_do(books, had, a.only, a.max).toLocalIterator()}

    def work(slug: str) -> None:
        at = f"{a.passes}/{slug}"
        convert(spark, f"{at}/base/*/*/*content_list.json", f"{at}/model/*/*/*content_list.json", slug, f"{a.out}/{slug}")
        if a.vault:
            readers.place_in_vault(f"{a.out}/{slug}", "/".join(x for x in (a.vault, todo[slug]["domain"], slug) if x))

    def told(row: dict) -> None:
        place = "/".join(x for x in (a.vault, todo[row["slug"]]["domain"], row["slug"]) if x) if a.vault and row["status"] == "done" else None
        state[row["slug"]] = row | {"domain": todo[row["slug"]]["domain"], "vault_path": place}
        print(f"{row['slug']}: {row['status']}", file=sys.stderr)
        readers.write_manifest(spark.createDataFrame(list(state.values()), MANIFEST), a.manifest)

    results = batch.run(list(todo), work, a.stop_file, config.load(a.config).breaker, told)
    return int(any(r["status"] != "done" for r in results))


COMMANDS = {
    "merge": (_merge, ("base", "model", "book", "out"), {"texts": str, "contents": str, "images": str}), "clean": (_clean, ("md", "out"), {"book": str, "source": str, "apply": bool, "report": bool}), "flags": (_flags, ("blocks",), {}), "sample": (_sample, ("blocks", "out"), {"n": int, "seed": int}),
    "review": (_review, ("blocks", "mapping", "out"), {}), "scan": (_scan, ("pages",), {}), "batch": (_batch, ("books", "manifest", "passes", "out"), {"vault": str, "only": str, "max": int, "stop_file": str, "config": str}),
}
DEFAULTS = {"n": 20, "seed": 42}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quire")
    sub = p.add_subparsers(dest="command", required=True)
    for name, (fn, args, options) in COMMANDS.items():
        s = sub.add_parser(name)
        for x in args:
            s.add_argument(x)
        for x, kind in options.items():
            flag = "--" + x.replace("_", "-")
            s.add_argument(flag, action="store_true") if kind is bool else s.add_argument(flag, type=kind, default=DEFAULTS.get(x))
        s.set_defaults(fn=fn)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("quire").getOrCreate()
    try:
        return a.fn(spark, a)
    except (pages.CoverageError, chapters.NoBoundaries) as e:
        print(e, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
