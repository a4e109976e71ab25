"""The clean-up chain in its fixed order, with a report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import language, markdown
from ..functions.fences import is_mermaid, lang, rebuild, segments
from ..functions.text import let
from ..operators import chapters

#: One after another these are the chain; `clean` is the same in one pass over a document's segments.
STEPS = (markdown.strip_illegal, markdown.remap, markdown.lift_captions, markdown.remap, language.retag, markdown.fix_dashes, markdown.repair_diagrams, markdown.unescape_code)


def clean(md: Column) -> Column:
    """A document cleaned: illegal code points, glyphs, captions, glyphs that captions freed, tags, dashes, diagrams, escapes. The fences are found once; no step moves any."""
    return let(markdown.strip_illegal(md), lambda legal: let(markdown.has_crlf(legal), lambda crlf: _cleaned(legal, crlf)))


def _cleaned(md: Column, crlf: Column) -> Column:
    prose = lambda text: F.when(crlf, text).otherwise(markdown.remap_text(markdown.remap_text(text)))

    def code(g: Column) -> Column:
        return let(markdown.lift(g), lambda x: let(F.coalesce(x["body"], g["body"]), lambda body: shown(g, x, body)))

    def shown(g: Column, x: Column, body: Column) -> Column:
        new = F.when(is_mermaid(g), markdown.repaired(body)).otherwise(markdown.unescaped(markdown.dashed(body)))
        block = let(language.new_tag(g, body), lambda t: F.when(t.isNull(), rebuild(g, body=new)).otherwise(rebuild(g, body=new, tag=t)))
        caption = F.when(crlf, x["caption"]).otherwise(markdown.remap_text(x["caption"]))
        return F.when(x.isNull(), block).otherwise(markdown.set_before(caption, x["gone"], block))

    return F.array_join(F.transform(segments(md), lambda g: F.when(g["code"], code(g)).otherwise(prose(g["text"]))), "\n")


def clean_table(docs: DataFrame, md_col: str = "md") -> DataFrame:
    """docs with md_col cleaned."""
    return docs.withColumn(md_col, clean(F.col(md_col)))


def report(docs: DataFrame, id_col: str, md_col: str = "md") -> DataFrame:
    """id, illegal, glyphs, captions, blocks, diagram_issues, chapters: what the chain finds in each document."""
    md = F.col(md_col)
    n = chapters.boundaries(docs, id_col, md_col).groupBy(id_col).agg(F.count(F.lit(1)).alias("chapters"))
    issues = F.aggregate(markdown.mermaid_blocks(md), F.lit(0).cast("long"), lambda a, g: a + markdown.diagram_issues(g["body"]))
    r = docs.select(id_col, F.size(markdown.illegal_chars(md)).cast("long").alias("illegal"), markdown.remap_report(md)["glyphs"].alias("glyphs"), F.size(markdown.captions(md)).cast("long").alias("captions"), F.size(F.filter(segments(md), lambda g: g["code"])).cast("long").alias("blocks"), issues.alias("diagram_issues"))
    return r.join(n, id_col, "left").withColumn("chapters", F.coalesce("chapters", F.lit(0)).cast("long"))


def full_report(docs: DataFrame, id_col: str, md_col: str = "md") -> DataFrame:
    """What each step of the chain does to each document.

    id; illegal_counts, illegal_word_joins; symbols and symbols_after_captions (structs of `markdown.remap_report`, of the two passes);
    captions; retags (`language.retag_changes`); dashes, escapes (`markdown.line_changes`); diagrams_changed, score_before, score_after;
    titles and files of the chapters, empty where there is none.
    """
    d = docs.select(id_col, F.col(md_col).alias("__0"))
    for k, step in enumerate(STEPS):
        d = d.withColumn(f"__{k + 1}", step(F.col(f"__{k}")))
    symbols = lambda c: F.struct(*(v.alias(k) for k, v in markdown.remap_report(F.col(c)).items()))
    score = lambda c: F.aggregate(markdown.mermaid_blocks(F.col(c)), F.lit(0).cast("long"), lambda a, g: a + markdown.diagram_issues(g["body"]))
    bodies = lambda c: F.transform(markdown.mermaid_blocks(F.col(c)), lambda g: g["body"])
    changed = F.aggregate(F.zip_with(bodies("__6"), bodies("__7"), lambda a, b: (a != b).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    r = d.select(
        id_col, markdown.illegal_counts(F.col("__0")).alias("illegal_counts"), markdown.illegal_word_joins(F.col("__0")).alias("illegal_word_joins"), symbols("__1").alias("symbols"), markdown.captions(F.col("__2")).alias("captions"), symbols("__3").alias("symbols_after_captions"),
        language.retag_changes(F.col("__4")).alias("retags"), markdown.dash_changes(F.col("__5")).alias("dashes"), changed.alias("diagrams_changed"), score("__6").alias("score_before"), score("__7").alias("score_after"), markdown.unescape_changes(F.col("__7")).alias("escapes"),
    )
    c = chapters.split(d.select(id_col, F.col(f"__{len(STEPS)}").alias("md")), id_col).groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("chapter", "title", "file_name"))).alias("__c"))
    listed = lambda name: F.coalesce(F.transform("__c", lambda x: x[name]), F.array().cast("array<string>"))
    return r.join(c, id_col, "left").withColumn("titles", F.filter(listed("title"), lambda t: t.isNotNull())).withColumn("files", listed("file_name")).drop("__c")


def decisions(docs: DataFrame, md_col: str = "md") -> DataFrame:
    """(lang, why, n): how the tags of all blocks were decided."""
    g = docs.select(F.explode(F.filter(segments(F.col(md_col)), language.may_retag)).alias("g"))
    d = language.detect(lang(F.col("g")), F.col("g.body"))
    return g.select(d[0].alias("lang"), d[1].alias("why")).groupBy("lang", "why").agg(F.count(F.lit(1)).alias("n"))
