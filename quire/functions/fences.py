"""The fence lexer and higher-order rewriting of fenced blocks, as Column expressions.

A fence opens on a line of at most three blanks, three or more backticks and an info string without backticks; it closes on the first
later line of at most three blanks and at least as many backticks. An opener that nothing closes is text, and scanning goes on behind
it. Tildes never fence. Only candidate lines enter the fold, so its arrays stay small.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import let, lines, strip, unlines

OPENS = r"\A[ \t]{0,3}`{3,}[^`]*\z"
CLOSES = r"\A[ \t]{0,3}`{3,}[ \t]*\z"
_PARTS = r"(?s)\A([ \t]{0,3})(`{3,})(.*)\z"


def fence_spans(ls: Column) -> Column:
    """array<struct<s:int,e:int>>: first and last line of each closed fence, given the document's lines."""
    ticks = lambda l: F.length(F.regexp_extract(l, "`{3,}", 0))
    marks = F.filter(
        F.transform(ls, lambda l, i: F.struct(i.alias("i"), F.when(l.rlike(OPENS), ticks(l)).otherwise(0).alias("n"), l.rlike(CLOSES).alias("bare"))), lambda c: c["n"] > 0
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("out"))
    end = lambda ms, c: F.array_min(F.transform(F.filter(ms, lambda d: (d["i"] > c["i"]) & d["bare"] & (d["n"] >= c["n"])), lambda d: d["i"]))
    fold = lambda acc, c: F.when((c["i"] >= acc["at"]) & c["e"].isNotNull(), F.struct((c["e"] + 1).alias("at"), F.concat(acc["out"], F.array(F.struct(c["i"].alias("s"), c["e"].alias("e")))).alias("out"))).otherwise(acc)
    return let(marks, lambda ms: F.aggregate(F.transform(ms, lambda c: F.struct(c["i"].alias("i"), end(ms, c).alias("e"))), start, fold, lambda acc: acc["out"]))


SEGMENT = "struct<code:boolean,s:int,e:int,indent:string,fence:string,info:string,body:string,closer:string,text:string>"


def segments(md: Column) -> Column:
    """The document as alternating text and code segments; joining their texts with newlines gives it back.

    A code segment has its parts apart: indent, fence, info, body (a newline after each line) and the closing line; s and e are line
    numbers. A text segment has text only.
    """
    return let(lines(md), lambda ls: let(fence_spans(ls), lambda spans: _cut(ls, spans)))


def _cut(ls: Column, spans: Column) -> Column:
    ends = F.concat(F.array(F.lit(-1)), F.transform(spans, lambda b: b["e"]))
    starts = F.concat(F.transform(spans, lambda b: b["s"]), F.array(F.size(ls)))
    none = [F.lit(None).cast("string").alias(c) for c in ("indent", "fence", "info", "body", "closer")]
    gaps = F.zip_with(ends, starts, lambda e, s: F.struct(F.lit(False).alias("code"), (e + 1).alias("s"), (s - 1).alias("e"), *none, unlines(F.slice(ls, e + 2, s - e - 1)).alias("text")))
    code = F.transform(spans, lambda b: _code(ls, b))
    return F.array_sort(F.concat(F.filter(gaps, lambda g: g["e"] >= g["s"]), code), lambda a, b: a["s"] - b["s"])


def _code(ls: Column, b: Column) -> Column:
    opener = F.element_at(ls, b["s"] + 1)
    body = F.slice(ls, b["s"] + 2, b["e"] - b["s"] - 1)
    return F.struct(
        F.lit(True).alias("code"), b["s"].alias("s"), b["e"].alias("e"), F.regexp_extract(opener, _PARTS, 1).alias("indent"), F.regexp_extract(opener, _PARTS, 2).alias("fence"), F.regexp_extract(opener, _PARTS, 3).alias("info"),
        F.when(F.size(body) > 0, F.concat(unlines(body), F.lit("\n"))).otherwise("").alias("body"), F.element_at(ls, b["e"] + 1).alias("closer"), F.lit(None).cast("string").alias("text"),
    )


def first_token(seg: Column) -> Column:
    """First token of the info string, as written."""
    return F.regexp_extract(strip(seg["info"]), r"(?U)\A\S*", 0)


def lang(seg: Column) -> Column:
    return F.lower(first_token(seg))


def is_mermaid(seg: Column) -> Column:
    return lang(seg) == "mermaid"


def rebuild(seg: Column, body: Column | None = None, tag: Column | None = None) -> Column:
    """The block's source, with a new body or first info token if given; the rest of the info string stays."""
    info = seg["info"]
    if tag is not None:
        rest = F.regexp_replace(strip(info), r"(?U)\A\S*\s*", "")
        info = F.concat(tag, F.when(rest != "", F.concat(F.lit(" "), rest)).otherwise(""))
    return F.concat(seg["indent"], seg["fence"], info, F.lit("\n"), seg["body"] if body is None else body, seg["closer"])


def transform_fences(md: Column, fn: Callable[[Column], Column]) -> Column:
    """Rewrite each code block with fn(segment), where null leaves it as it is; all other text is copied."""
    return F.array_join(F.transform(segments(md), lambda g: F.when(g["code"], F.coalesce(fn(g), rebuild(g))).otherwise(g["text"])), "\n")


def transform_text(md: Column, fn: Callable[[Column], Column]) -> Column:
    """Rewrite what is outside of code blocks with fn(text); blocks are copied."""
    return F.array_join(F.transform(segments(md), lambda g: F.when(g["code"], rebuild(g)).otherwise(fn(g["text"]))), "\n")


def fences(docs: DataFrame, id_col: str, md_col: str = "md") -> DataFrame:
    """A row for each block: id, k (from 0), s, e, lang, info, body."""
    d = docs.select(id_col, F.filter(segments(F.col(md_col)), lambda g: g["code"]).alias("gs"))
    return d.select(id_col, F.posexplode("gs").alias("k", "g")).select(id_col, "k", F.col("g.s").alias("s"), F.col("g.e").alias("e"), lang(F.col("g")).alias("lang"), F.col("g.info").alias("info"), F.col("g.body").alias("body"))


def in_code_lines(docs: DataFrame, id_col: str, md_col: str = "md") -> DataFrame:
    """A row for each line: id, line_no, line, in_code (fence lines included)."""
    d = docs.select(id_col, lines(F.col(md_col)).alias("ls")).withColumn("spans", fence_spans(F.col("ls")))
    return d.select(id_col, "spans", F.posexplode("ls").alias("line_no", "line")).select(id_col, "line_no", "line", F.exists("spans", lambda b: (b["s"] <= F.col("line_no")) & (F.col("line_no") <= b["e"])).alias("in_code"))
