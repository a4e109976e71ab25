"""Blocks to Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank, lstrip


def _s(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _words(c: str) -> Column:
    return F.array_join(F.coalesce(F.col(c), F.array().cast("array<string>")), " ")


def _heading() -> Column:
    n = F.coalesce("text_level", F.lit(0))
    return F.concat(F.when(n > 0, F.concat(F.repeat(F.lit("#"), n), F.lit(" "))).otherwise(""), _s("text"))


def _items() -> Column:
    return F.array_join(F.transform(F.coalesce("list_items", F.array().cast("array<string>")), lambda x: F.concat(F.lit("- "), x)), "\n")


def _caption(c: str, lead: str) -> Column:
    return F.when(_words(c) != "", F.concat(F.lit(lead), _words(c), F.lit("*"))).otherwise("")


def _picture(caption: str, kind: str, shown: Column) -> Column:
    more = F.concat(F.lit(f"\n\n<details><summary>{kind}</summary>\n\n"), _s("content"), F.lit("\n\n</details>"))
    return F.concat(F.lit("![]("), _s("img_path"), F.lit(")"), _caption(caption, "\n\n*"), F.when(shown, more).otherwise(""))


NOTE_TOKENS = "<!-- code-verify: the model pass differs from the text layer; tokens are the text layer's, "
NOTE_INDENT = "<!-- code-verify: this Python did not parse with the indentation given; check it. -->\n"


def full(blocks: DataFrame) -> Column:
    """Markdown of a block of `graft.merge`; unknown types are empty."""
    t = F.col("type")
    note = F.when(F.col("code_flag"), F.concat(F.lit(NOTE_TOKENS), F.when(F.col("reindented"), "indentation the model's").otherwise("as they stand"), F.lit(". -->\n"))).when(F.col("indent_flag"), NOTE_INDENT).otherwise("")
    fenced = F.concat(F.lit("```"), _s("sub_type"), F.lit("\n"), _s("code_body"), F.lit("\n```"))
    code = F.concat(note, F.when(lstrip(_s("code_body")).startswith("```"), _s("code_body")).otherwise(fenced))
    return (
        F.when(t == "text", _heading()).when(t == "code", code).when(t == "list", _items()).when(t == "equation", _s("text")).when(t == "chart", _picture("chart_caption", "chart data", ~blank(_s("content"))))
        .when(t == "image", _picture("image_caption", "diagram (mermaid)", _s("content").contains("mermaid"))).when(t == "table", F.concat(_s("table_body"), _caption("table_caption", "\n\n*"))).otherwise("")
    )


def brief(blocks: DataFrame) -> Column:
    """The shorter form of the review sheet."""
    t = F.col("type")

    def mark(kind: str, caption: str, more: Column, label: str) -> Column:
        return F.concat(F.lit(f"[{kind} "), _s("img_path"), F.lit("]"), F.when(_words(caption) != "", F.concat(F.lit(" — "), _words(caption))).otherwise(""), F.when(more, F.concat(F.lit(f"\n[+{label}]\n"), _s("content"))).otherwise(""))

    return (
        F.when(t == "text", _heading()).when(t == "code", F.concat(F.lit("```"), _s("sub_type"), F.lit("\n"), _s("code_body"), F.lit("\n```"))).when(t == "list", _items()).when(t == "equation", _s("text"))
        .when(t == "chart", mark("CHART", "chart_caption", ~blank(_s("content")), "DATA")).when(t == "image", mark("IMAGE", "image_caption", _s("content").contains("mermaid"), "MERMAID")).when(t == "table", F.concat(_s("table_body"), _caption("table_caption", "\n*"))).otherwise("")
    )


def assemble(rendered: DataFrame, by: list[str], sep: str = "\n\n") -> DataFrame:
    """(*by, md): the column md of rendered rows joined in the order of ord."""
    rows = F.array_sort(F.collect_list(F.struct("ord", "md")))
    return rendered.groupBy(*by).agg(F.array_join(F.transform(rows, lambda x: x["md"]), sep).alias("md"))
