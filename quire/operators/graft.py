"""Splicing two extraction passes: the base pass keeps its tokens, the model pass lends layout.

Matching is an equi-join on book, page and class with the geometry as a residual; of the candidates of a block that reach a threshold
the first of the best is found by one window over the block's own key, which is small. Books of any size spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.code import indent_suspect, normal_form, strip_callouts, strip_listing_numbers, transplant_indent
from ..functions.geometry import area, containment, iou
from ..functions.text import blank, strip

NOISE = ("footer", "header", "page_number")
#: What of the model's columns is matched by or lent; others needn't travel.
LENT = ("book", "ord", "abs_page", "type", "bbox", "text", "content", "code_body", "table_body", "sub_type", "keys")
COUNTERS = ["table_swapped", "table_kept", "mermaid_attached", "images", "eq_swapped", "eq_kept", "chart_enriched", "charts", "noise_dropped", "code_verified", "code_flagged", "code_pipeline_only", "code_indent_flagged"]


def without_noise(blocks: DataFrame) -> DataFrame:
    return blocks.where(~F.coalesce(F.col("type"), F.lit("")).isin(*NOISE))


def candidates(model: DataFrame) -> DataFrame:
    """Model blocks that can lend something."""
    t, text = F.col("type"), F.col("text")
    content = F.coalesce("content", F.lit(""))
    keep = (t == "table") | ((t == "image") & content.contains("mermaid")) | ((t == "equation") & (F.coalesce(text, F.lit("")) != "")) | ((t == "chart") & ~blank(content)) | ((t == "code") & (F.coalesce("code_body", F.lit("")) != ""))
    return model.where(F.coalesce(keep, F.lit(False)))


def best_match(base: DataFrame, model: DataFrame, min_iou: float = 0.3, min_containment: float = 0.8) -> DataFrame:
    """base left-joined to its partner: m_ord, m_iou, m_containment and the partner's columns as m_*; nulls without one.

    The partner is the first in order of those with the greatest IoU, if that is over min_iou; for code else the first with the
    greatest containment, if over min_containment. A model block may be the partner of many. base and model: book, ord, abs_page,
    type, bbox, ...; (book, ord) is unique.
    """
    m = candidates(model)
    m = m.select(F.col("book").alias("m_book"), F.col("abs_page").alias("m_page"), F.col("type").alias("m_type"), F.col("ord").alias("m_ord"), F.struct(*m.columns).alias("m"))
    slim = base.select("book", "ord", "abs_page", "type", "bbox")
    page = lambda c: F.coalesce(F.col(c), F.lit(0))
    both = slim.join(m, (F.col("book") == F.col("m_book")) & (page("abs_page") == page("m_page")) & (F.col("type") == F.col("m_type")))
    both = both.withColumn("m_iou", iou(F.col("bbox"), F.col("m.bbox"))).withColumn("m_containment", containment(F.col("bbox"), F.col("m.bbox")))
    by_iou = F.col("m_iou") > min_iou
    by_box = (F.col("type") == "code") & (F.col("m_containment") > min_containment)
    both = both.withColumn("how", F.when(by_iou, 0).when(by_box, 1)).where("how IS NOT NULL")
    w = Window.partitionBy("book", "ord").orderBy("how", F.desc(F.when(F.col("how") == 0, F.col("m_iou")).otherwise(F.col("m_containment"))), "m_ord")
    pick = both.withColumn("first", F.row_number().over(w)).where("first = 1")
    pick = pick.select(F.col("book").alias("__b"), F.col("ord").alias("__o"), "m_ord", "m_iou", "m_containment", "m")
    return base.join(pick, (F.col("book") == F.col("__b")) & (F.col("ord") == F.col("__o")), "left").drop("__b", "__o")


def merge(base: DataFrame, model: DataFrame, repeated: DataFrame | None = None, tiny: int = 2500) -> DataFrame:
    """The spliced blocks, with `event` (the counter a block adds to, or null), and code_path, code_flag, indent_flag, reindented.

    Dropped for noise are repeated lines and tiny images without a caption; they stay as rows with event noise_dropped, so that
    counters can be taken from the same plan; filter on `kept`.
    """
    b = without_noise(base)
    if repeated is not None:
        r = repeated.select(F.col("book").alias("__b"), F.col("text").alias("__t"), F.lit(True).alias("__hit"))
        b = b.join(r, (F.col("book") == F.col("__b")) & (strip(F.col("text")) == F.col("__t")), "left").withColumn("noise", F.coalesce("__hit", F.lit(False))).drop("__b", "__t", "__hit")
    else:
        b = b.withColumn("noise", F.lit(False))
    t = F.col("type")
    captions = F.coalesce("image_caption", F.array().cast("array<string>"))
    b = b.withColumn("noise", F.col("noise") | F.coalesce((t == "image") & ~F.exists(captions, lambda c: F.coalesce(c, F.lit("")) != "") & (area(F.col("bbox")) < tiny), F.lit(False)))
    j = best_match(b, model.select(*(c for c in model.columns if c in LENT)))
    hit = F.col("m").isNotNull() & ~F.col("noise")
    code = (t == "code") & ~F.col("noise")
    same = normal_form(F.col("code_body")) == normal_form(F.col("m.code_body"))
    path = F.when(code & hit & same, "verified").when(code & hit, "flagged").when(code, "pipeline_only")
    j = j.withColumn("code_path", path)
    flagged = F.col("code_path") == "flagged"
    j = j.withColumn("moved", F.when(flagged, transplant_indent(F.when(flagged, F.col("m.code_body")), F.when(flagged, F.coalesce("code_body", F.lit(""))))))
    j = j.withColumn("indent_flag", F.coalesce(indent_suspect(F.when(F.col("code_path") == "verified", F.col("m.code_body"))), F.lit(False)))
    event = (
        F.when(F.col("noise"), "noise_dropped").when(t == "table", F.when(hit, "table_swapped").otherwise("table_kept")).when(t == "equation", F.when(hit, "eq_swapped").otherwise("eq_kept"))
        .when(t == "chart", F.when(hit, "chart_enriched").otherwise("charts")).when(t == "image", F.when(hit, "mermaid_attached").otherwise("images")).when(code, F.concat(F.lit("code_"), F.col("code_path")))
    )
    has_key = lambda k: F.coalesce(F.array_contains(F.col("m.keys"), k), F.lit(True)) if "keys" in model.columns else F.lit(True)
    cols = {
        "table_body": F.when(hit & (t == "table") & has_key("table_body"), F.col("m.table_body")).otherwise(F.col("table_body")),
        "text": F.when(hit & (t == "equation"), F.col("m.text")).otherwise(F.col("text")),
        "content": F.when(hit & t.isin("chart", "image"), F.col("m.content")).otherwise(F.col("content")),
        "sub_type": F.when(hit & code & has_key("sub_type"), F.col("m.sub_type")).otherwise(F.col("sub_type")),
        "code_body": F.when(F.col("code_path") == "verified", F.col("m.code_body")).when(flagged, F.col("moved.body")).when(F.col("code_path") == "pipeline_only", strip_callouts(strip_listing_numbers(F.col("code_body")))).otherwise(F.col("code_body")),
    }
    return j.select(
        *(cols[c].alias(c) if c in cols else F.col(c) for c in base.columns), event.alias("event"), "code_path", F.coalesce(flagged, F.lit(False)).alias("code_flag"), "indent_flag", F.coalesce("moved.reindented", F.lit(False)).alias("reindented"), (~F.col("noise")).alias("kept"), F.lit("base").alias("src"), "m_ord",
    )


def counters(merged: DataFrame) -> DataFrame:
    """One row a book with every counter, zero where nothing happened."""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    e = F.col("event")
    rules = {c: e == c for c in COUNTERS} | {"charts": F.col("kept") & (F.col("type") == "chart"), "images": F.col("kept") & (F.col("type") == "image"), "code_indent_flagged": F.col("indent_flag")}
    return merged.groupBy("book").agg(*(n(rules[c]).alias(c) for c in COUNTERS))


def with_images(blocks: DataFrame, existing: DataFrame) -> DataFrame:
    """blocks with img_path set to images/<name> where imgdir/img_path is among existing (path), and source, the file to copy; other rows as they are."""
    full = F.concat_ws("/", "imgdir", "img_path")
    e = existing.select(F.col("path").alias("__p")).distinct()
    j = blocks.join(e, full == F.col("__p"), "left")
    name = F.regexp_extract("img_path", r"([^/]*)\z", 1)
    return j.withColumn("source", F.col("__p")).withColumn("img_path", F.when(F.col("__p").isNotNull(), F.concat(F.lit("images/"), name)).otherwise(F.col("img_path"))).drop("__p")
