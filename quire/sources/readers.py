"""Readers of the engine's inputs, and exact-name writers of its outputs."""

from __future__ import annotations

import json
import os
import shutil
import tomllib
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = "type string, sub_type string, page_idx int, text string, text_level int, code_body string, table_body string, content string, img_path string, image_caption array<string>, table_caption array<string>, chart_caption array<string>, list_items array<string>, abs_page int"


def parse_blocks(json: Column) -> Column:
    """array<string>: the elements of a JSON array as they are written. Reading fails where it is none."""
    return F.from_json(json, "array<string>", {"mode": "FAILFAST"})


def block_columns(raw: Column) -> list[Column]:
    """The modelled keys of a block's JSON, its keys, and raw itself. A box may be an array or a string that holds one."""
    b = F.from_json(raw, BLOCK)
    box = F.coalesce(F.from_json(F.get_json_object(raw, "$.bbox"), "array<double>"))
    names = [x.split(" ")[0] for x in BLOCK.split(", ")]
    return [*(b[n].alias(n) for n in names), box.alias("bbox"), F.json_object_keys(raw).alias("keys"), raw.alias("raw")]


def read_content_lists(spark: SparkSession, glob: str, first_page: Column | int | None = 0, newest_only: bool = False) -> DataFrame:
    """A row for each block of content-list files: path, ord, `block_columns` and imgdir, the file's folder.

    abs_page counts from first_page: a number, or an expression on path for passes over segments of a book; None where pages are
    absolute already. newest_only: of the files below one output folder (three levels up) only the first by name is read.
    """
    t = spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value").where(~F.col("path").endswith("_content_list_v2.json"))
    if newest_only:
        top = F.regexp_replace("path", r"(/[^/]*){3}\z", "")
        first = t.groupBy(top.alias("__top")).agg(F.min("path").alias("path")).select("path")
        t = t.join(first, "path", "left_semi")
    rows = t.select("path", F.posexplode(parse_blocks(F.col("value"))).alias("ord", "raw"))
    start = F.lit(0) if first_page is None else first_page if isinstance(first_page, Column) else F.lit(first_page)
    out = rows.select("path", "ord", *block_columns(F.col("raw"))).withColumn("abs_page", F.coalesce("page_idx", F.lit(0)) + start)
    return out.withColumn("imgdir", F.regexp_replace("path", r"/[^/]*\z", ""))


def segment_start(pattern: str = r"_p(\d+)-\d+") -> Column:
    """The first page of the segment that a content list's path names, as `first_page`."""
    return F.coalesce(F.expr("try_cast(regexp_extract(path, '" + pattern.replace("\\", "\\\\") + "', 1) AS int)"), F.lit(0))


def read_blocks(spark: SparkSession, glob: str) -> DataFrame:
    """A row for each block of the engine's own blocks.json files: path, ord and `block_columns`; abs_page as it is written."""
    t = spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return t.select("path", F.posexplode(parse_blocks(F.col("value"))).alias("ord", "raw")).select("path", "ord", *block_columns(F.col("raw")))


#: keys of a block that merging sets, and the columns they come from
WRITTEN = {"abs_page": "abs_page", "text": "text", "text_level": "text_level", "sub_type": "sub_type", "code_body": "code_body", "table_body": "table_body", "content": "content", "img_path": "img_path", "_src": "src", "_code_flag": "code_flag", "_indent_flag": "indent_flag", "_reindented": "reindented", "_code_path": "code_path"}


def blocks_json(blocks: DataFrame) -> DataFrame:
    """(book, content): a book's blocks in order as a JSON array, a key to a line under one blank. Keys that the engine does not know keep their place and value (column raw); null values of known ones are left out unless they were there."""
    rows = F.array_sort(F.collect_list(F.struct("ord", F.coalesce("raw", F.lit("{}")).alias("raw"), F.to_json(F.struct(*(F.col(c).alias(k) for k, c in WRITTEN.items() if c in blocks.columns))).alias("new"), F.col("type"))))

    @F.pandas_udf("string")
    def shown(raw, new, kinds):
        def one(r: str, n: str, kind: str) -> dict:
            b = json.loads(r)
            return ({"type": kind} | b) | {k: v for k, v in json.loads(n).items() if v is not False or k in b}

        return pd.Series([json.dumps([one(*x) for x in zip(*z)], indent=1, ensure_ascii=False, default=str) + "\n" for z in zip(raw, new, kinds)])

    of = lambda k: F.transform("__r", lambda x: x[k])
    return blocks.groupBy("book").agg(rows.alias("__r")).select("book", shown(of("raw"), of("new"), of("type")).alias("content"))


def read_markdown(spark: SparkSession, glob: str) -> DataFrame:
    """(path, md): whole files."""
    return spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("md"))


def read_books(spark: SparkSession, path: str) -> DataFrame:
    """(pos, pdf, slug, domain) from a TOML file of [[book]] tables; pdf and slug are required."""
    books = tomllib.loads(Path(path).read_text(encoding="utf-8")).get("book", [])
    for b in books:
        if not b.get("pdf") or not b.get("slug"):
            raise ValueError(f"a book needs pdf and slug: {b}")
    return spark.createDataFrame([(i, b["pdf"], b["slug"], b.get("domain")) for i, b in enumerate(books)], "pos int, pdf string, slug string, domain string")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(slug, status, domain, minutes, error, error_class, vault_path) from a JSON object by slug. Raises if it is no such object."""
    kind = "map<string,struct<status:string,domain:string,minutes:double,error:string,error_class:string,vault_path:string>>"
    t = spark.read.text(path, wholetext=True).select(F.from_json("value", kind, {"mode": "FAILFAST"}).alias("m"))
    return t.select(F.explode("m").alias("slug", "v")).select("slug", "v.*")


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Write a manifest, which fits the driver (a row for each book of a batch), as a JSON object by slug: all of it, or the old one stays."""
    rows = {r["slug"]: {k: v for k, v in r.asDict().items() if k != "slug" and v is not None} for r in manifest.orderBy("slug").toLocalIterator()}
    part = f"{path}.part"
    Path(part).write_text(json.dumps(rows, indent=1, ensure_ascii=False) + "\n", encoding="utf-8")
    os.replace(part, path)


def list_files(spark: SparkSession, glob: str) -> DataFrame:
    """(path, size): files that a pattern names, sorted by path; nothing of them is read."""
    return spark.read.format("binaryFile").load(glob).select("path", F.col("length").alias("size")).orderBy("path")


def copy_images(images: DataFrame, folder: str) -> None:
    """Copy each source (a path that the tasks can read) to folder/img_path, as `graft.with_images` names them; missing sources are passed over."""

    def put(rows) -> None:
        for r in rows:
            at, to = r["source"].removeprefix("file://"), Path(folder, r["img_path"])
            if Path(folder).resolve() not in to.resolve().parents:
                raise ValueError(f"outside the folder: {to}")
            if os.path.exists(at):
                to.parent.mkdir(parents=True, exist_ok=True)
                shutil.copyfile(at, to)

    images.where("source IS NOT NULL").select("source", "img_path").distinct().foreachPartition(put)


def place_in_vault(folder: str, target: str) -> None:
    """Copy a finished book's folder to its place in a vault, over what is there."""
    shutil.copytree(folder, target, dirs_exist_ok=True)


def write_named(files: DataFrame, folder: str) -> None:
    """Write rows (file_name, content) as files of those names, each by the task that has it, complete or not at all."""
    from pyarrow import fs

    def put(rows) -> None:
        disk, at = fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder)
        disk.create_dir(at, recursive=True)
        for r in rows:
            name = r["file_name"]
            if "/" in name or name.startswith(".."):
                raise ValueError(f"not a file name: {name}")
            with disk.open_output_stream(f"{at}/.{name}.part") as f:
                f.write(r["content"].encode())
            disk.move(f"{at}/.{name}.part", f"{at}/{name}")

    files.select("file_name", "content").foreachPartition(put)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(book, page, text) from Parquet: text layers that an extractor wrote."""
    return spark.read.parquet(path).select("book", "page", "text")
