"""Documents, blocks and tables of contents derived from the driver's tables, the same in Spark and in DuckDB.

The tables hold no Markdown, no layout blocks and no page texts; these rules make some from them, by arithmetic on ids and positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NL = "chr(10)"

INJECT = [
    "'def f(x):' || chr(10) || '    return x'", "'$ pip install quire'", "'SELECT a FROM b'", "'Listing 3.1 A caption'", "'fn main() [ let mut x = 1; ]'", "'#include <stdio.h>'", "'x := 1'", "'const x = 1;'", "'A[\"say'  || chr(92) || 'n' || '\"] --> B[\"b &quot;'",
    "'kind: Pod'", "'key: v' || chr(10) || 'other: w'", "'run –dev − y ' || chr(92) || '$z ' || chr(92) || chr(92) || '_q'", "'[section]'", "'{\"a\": 1}'", "'# file: src/app.yml'", "'1 a' || chr(10) || '2 b' || chr(10) || '3 c \uf070\uf0a1'",
]
TAGS = ["", "c++", "mermaid", "java {highlight=2}", "python", "code", "sh", "text"]


def _case(on: str, values: list[str]) -> str:
    return f"CASE {on} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


_OPENINGS = ["''", "'\uf0a1 first item' || chr(10)", "'## \uf0a1 head' || chr(10)", "'an alphabet \uf0e5 of \uf070' || chr(10)", "'bad\ufdd0char' || chr(10)", "'one \uf0a1 two\uf0a1 three\uf0a1four' || chr(10)", "'odd \uf0ff and \uf0fe' || chr(10)"]
#: conv_id, turn, piece: a user's turn is a heading and prose, any other a fence.
PIECES = f"""
SELECT conv_id, turn, CASE WHEN role = 'user'
  THEN concat('# Turn ', turn, ': ', substr(replace(text, {NL}, ' '), 1, 40), {NL}, {NL}, {_case("(conv_id + turn) % 7", _OPENINGS)}, CASE WHEN conv_id % 11 = 3 AND turn < 2 THEN 'old' || chr(13) || {NL} ELSE '' END, text, {NL})
  ELSE concat('```', {_case("(conv_id + turn) % 8", [f"'{t}'" for t in TAGS])}, {NL}, {_case("(conv_id * 3 + turn) % 16", INJECT)}, {NL}, text, {NL}, '```', {NL}) END AS piece
FROM @conversations
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """spark.sql with @name standing for the tables given."""
    for name, df in tables.items():
        query = query.replace(f"@{name}", f"{{{name}}}")
    # braces that are text are not names to be filled in
    safe = query.replace("{", "{{").replace("}", "}}")
    for name in tables:
        safe = safe.replace(f"{{{{{name}}}}}", f"{{{name}}}")
    return spark.sql(safe, **tables)


def md_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, md)"""
    p = sql(spark, PIECES.replace("chr(92)", "char(92)"), conversations=table(spark, sf_dir, "conversations"))
    rows = F.array_sort(F.collect_list(F.struct("turn", "piece")))
    return p.groupBy("conv_id").agg(F.array_join(F.transform(rows, lambda r: r["piece"]), "").alias("md"))


MD_DOCS = f"md_docs AS (SELECT conv_id, string_agg(piece, '' ORDER BY turn) AS md FROM ({PIECES.replace('@', '')}) GROUP BY conv_id)"

_TYPES = "CASE pos % 3 WHEN 0 THEN 'code' WHEN 1 THEN CASE WHEN pos % 2 = 0 THEN 'table' ELSE 'text' END ELSE CASE pos % 5 WHEN 0 THEN 'image' WHEN 1 THEN 'equation' WHEN 2 THEN 'chart' WHEN 3 THEN 'list' ELSE 'header' END END"
_LINES_SPARK = "SELECT doc_id, source, pos, line FROM @documents LATERAL VIEW posexplode(split(text, '\\n', -1)) t AS pos, line WHERE text IS NOT NULL"
_LINES_DUCK = "SELECT doc_id, source, pos - 1 AS pos, ls[pos] AS line FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL), LATERAL (SELECT unnest(generate_series(1, len(ls))) AS pos)"


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


#: book, ord, abs_page, type and the columns of a block; side 0 is the base pass, 1 the model's.
def _block_sql(side: int) -> str:
    shift = "0" if side == 0 else "(pos % 4) * 5"
    width = "60 + length(line) % 50" if side == 0 else "CASE WHEN pos % 4 = 2 THEN 14 ELSE 60 + length(line) % 50 END"
    body = "line" if side == 0 else "CASE WHEN pos % 7 = 0 THEN replace(line, 'e', 'E') ELSE concat('  ', line, ' ') END"
    return f"""
SELECT doc_id AS book, CAST(pos AS BIGINT) AS ord, CAST(floor(pos / 8) AS INT) AS abs_page, {_TYPES} AS type,
  {_d("(pos % 3) * 10 + " + shift)} AS x0, {_d("(pos % 8) * 50")} AS y0, {_d("(pos % 3) * 10 + " + shift + " + " + width)} AS x1, {_d("(pos % 8) * 50 + 20 + length(line) % 30")} AS y1,
  line AS text, CASE WHEN pos % 4 = 1 THEN 2 END AS text_level, {body} AS code_body, CASE WHEN pos % 2 = 0 THEN 'python' ELSE 'text' END AS sub_type,
  concat('<table>', pos + {side}, '</table>') AS table_body, {"CASE WHEN pos % 2 = 0 THEN 'data' END" if side == 0 else "concat('mermaid ', pos)"} AS content, concat('img', pos, '.png') AS img_path, CASE WHEN pos % 2 = 0 THEN 'caption' ELSE '' END AS cap
FROM @lines {"WHERE pos % 5 <> 0" if side else ""}"""


def blocks(spark: SparkSession, sf_dir: str, side: int = 0) -> DataFrame:
    lines = sql(spark, _LINES_SPARK, documents=table(spark, sf_dir, "documents"))
    b = sql(spark, _block_sql(side), lines=lines)
    cap = F.array("cap")
    return b.withColumn("bbox", F.array("x0", "y0", "x1", "y1")).withColumn("image_caption", cap).withColumn("chart_caption", cap).withColumn("table_caption", cap).withColumn("list_items", F.split("text", " ")).drop("x0", "y0", "x1", "y1", "cap")


BLOCKS = f"lines AS ({_LINES_DUCK}), base AS ({_block_sql(0).replace('@', '')}), model AS ({_block_sql(1).replace('@', '')})"

TOC_BLOCKS = """
SELECT page_id % 40 AS book, CAST(page_id AS BIGINT) AS ord, CAST(page_id AS INT) AS abs_page, 'text' AS type,
  CASE WHEN page_id % 6 = 0 THEN concat('Part ', page_id % 9, ': ', regexp_extract(html, '<title>([^<]*)</title>', 1), '!') WHEN page_id % 6 = 1 THEN 'Elsewhere' ELSE regexp_extract(html, '<title>([^<]*)</title>', 1) END AS text,
  CASE WHEN page_id % 4 = 0 THEN 1 ELSE 2 END AS text_level, 'base' AS src
FROM @pages"""
TOC = """
SELECT page_id % 40 AS book, CAST(page_id AS BIGINT) AS seq, CAST(CASE WHEN page_id % 11 = 0 THEN 2 ELSE 1 END AS INT) AS level, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, CAST(CASE WHEN page_id % 13 = 0 THEN -1 ELSE page_id + 1 - page_id % 2 END AS INT) AS page1
FROM @pages"""
