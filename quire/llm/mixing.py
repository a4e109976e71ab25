"""Mixing sources to target weights by Pareto order sampling.

Targets: the sources, in code-point order with null last, weigh 5, 2, 1, 5, 2, 1, ... and share the words of the whole corpus; a
source gets at most `MAX_COPIES` times its words, and what is above that is reshared by weight until nothing is.

Within a source a document's expected number of copies grows with the class of its length (`class_weight`), at most `MAX_COPIES`, such
that the expected words are the source's target. The whole part of that number is allocated for certain; for the fractional part f
the documents are ranked by their random odds divided by their inclusion odds, (u / (1 - u)) / (f / (1 - f)), and the sample is the
head of that order whose words make up what is left of the target, so its size is fixed, not random. The order is never sorted as a
whole: the cut is found by two rounds of counting words in 4096 bins, and only the bin that holds it is sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk
from .cluster import input_bytes, places, settle

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
CLASSES = 8
BINS = 4096
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20
SALTS = 16


def word_sizes(docs: DataFrame, text_col: str = "text", out: str = "size", keep_text: bool = False) -> DataFrame:
    """docs, without text_col unless it is kept, with the number of its words [^\\x20\\x09-\\x0D]+ as `out`; 0 for null. No shuffle."""
    rest = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index("__text")
            b = pa.RecordBatch.from_arrays([batch.column(k)], ["text"]).append_column("id", pa.nulls(batch.num_rows))
            n = [np.diff(tk.words(p)[2]) for p in tk.pieces(b, "id", "text")]
            sizes = np.concatenate([np.zeros(0, np.int64), *n])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns) if keep_text or i != k), pa.array(sizes.astype(np.int64))], schema.names)

    source = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)), F.col(f"`{text_col}`").cast("string").alias("__text"))
    schema = T.StructType([*(source if keep_text else source.drop("__text")).schema.fields, T.StructField("__size", T.LongType())])
    done = source.mapInArrow(run, schema)
    return done.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(rest)), *([F.col("__text").alias(text_col)] if keep_text else []), F.col("__size").alias(out))


def ranked(keys: DataFrame, col: str) -> DataFrame:
    """keys with `rank`, their place from 0 by code point, null last; sorted across tasks, never in one."""
    return places(keys.orderBy(F.col(col).asc_nulls_last())).withColumnRenamed("place", "rank")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size), by sharing in proportion to weight and resharing the excess over most times the size."""
    big = "decimal(38,0)"
    w = F.element_at(F.array(*(F.lit(x) for x in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    s = settle(ranked(sizes, "source").withColumn("w", w.cast(big)).withColumn("cap", (F.col("source_size") * most).cast(big)), "targets", free=False)
    total = s.agg(F.sum(F.col("source_size").cast(big))).first()[0] or 0
    rest, wsum, capped = total, None, F.lit(False)
    while True:
        row = s.agg(F.sum(F.when(capped, F.col("cap"))).alias("c"), F.sum(F.when(~capped, F.col("w"))).alias("w"), F.sum(F.when(capped, 1).otherwise(0)).alias("n")).first()
        rest, now = total - (row["c"] or 0), row["w"] or 0
        if now == wsum or not now:
            break
        wsum = now
        capped = F.col("cap") * F.lit(wsum).cast(big) < F.col("w") * F.lit(rest).cast(big)
    if not wsum:
        return s.select("source", "source_size", F.lit(0.0).alias("target"))
    share = (F.col("w") * F.lit(rest).cast(big)).cast("double") / F.lit(float(wsum))
    return s.select("source", "source_size", F.when(capped, F.col("cap").cast("double")).otherwise(share).alias("target"))


def class_of(size: Column) -> Column:
    """Length class 0 to 7: a step for each factor of four in words."""
    out = F.lit(0)
    for k in range(1, CLASSES):
        out = F.when(size >= 4**k, k).otherwise(out)
    return out


def class_weight(cls: Column) -> Column:
    """Expected copies are in proportion to this: 8 for texts of under 4 words to 15 for the longest."""
    return cls + 8


def _attach(docs: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """docs left-joined null-safely to a table that has one row for each key: broadcast if it is small (it is written, its rows and bytes are counted), else salted, as one key may hold a third of docs."""
    s = settle(small.select(*(F.col(k).alias(f"__{k}") for k in keys), *(c for c in small.columns if c not in keys)), "keys", free=False)
    same = [docs[k].eqNullSafe(F.col(f"__{k}")) for k in keys]
    if s.count() <= BROADCAST_ROWS and input_bytes(s) <= BROADCAST_BYTES:
        joined = docs.join(F.broadcast(s), same, "left")
    else:
        salted = s.withColumn("__salt", F.explode(F.array(*(F.lit(i) for i in range(SALTS)))))
        joined = docs.withColumn("__mine", F.pmod(F.xxhash64("doc_id", "u"), F.lit(SALTS))).join(salted, [*same, F.col("__mine") == F.col("__salt")], "left").drop("__mine", "__salt")
    return joined.drop(*(f"__{k}" for k in keys))


def mix(docs: DataFrame, keep: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 1) -> DataFrame:
    """A row for each row of docs: doc_id, size, source_size, target, taken (words, repeats counted), copies, and the columns in keep.

    Null texts have 0 words; null sources are a source of their own, sorted last; null ids draw by the text; repeated
    rows draw equal numbers and are interchangeable; an empty table gives an empty one. The same rows and seed give the same mix.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), *(F.col(c).alias(f"k_{c}") for c in keep if c != text_col), F.col(text_col).alias("__t"))
    slim = slim.withColumn("__d", F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("n"), F.md5(F.coalesce(F.col("__t").cast("string"), F.lit(""))))))
    draw = F.md5(F.concat("__d", F.lit(f":{seed}")))
    u = (F.conv(F.substring(draw, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    base = settle(word_sizes(slim, "__t", keep_text=text_col in keep).withColumn("u", u).withColumn("cls", class_of(F.col("size"))), "mix-sizes")
    by_class = settle(base.groupBy("source", "cls").agg(F.sum("size").alias("words")), "mix-classes", free=False)
    goal = targets(by_class.groupBy("source").agg(F.sum("words").alias("source_size")))
    # copies per class: the longest classes that reach the most copies are held there, the others share the rest by weight
    t = by_class.withColumnRenamed("source", "src").join(goal, F.col("src").eqNullSafe(F.col("source"))).drop("src").withColumn("wt", class_weight(F.col("cls")))
    one = Window.partitionBy("source").orderBy(F.desc("wt"))  # at most 8 rows a source
    rev = Window.partitionBy("source").orderBy("wt")
    t = t.withColumn("held", F.sum("words").over(one) - F.col("words")).withColumn("open", F.sum(F.col("words") * F.col("wt")).over(rev))
    t = t.withColumn("c", F.when(F.col("open") > 0, (F.col("target") - F.lit(float(MAX_COPIES)) * F.col("held")) / F.col("open")))
    valid = F.when(F.col("c") * F.col("wt") <= MAX_COPIES, F.col("wt"))
    t = t.withColumn("top", F.max(valid).over(Window.partitionBy("source")))
    t = t.withColumn("rate", F.max(F.when(F.col("wt") == F.col("top"), F.col("c"))).over(Window.partitionBy("source")))
    expected = F.when(F.col("top").isNull() | (F.col("wt") > F.col("top")), F.lit(float(MAX_COPIES))).otherwise(F.greatest(F.col("rate") * F.col("wt"), F.lit(0.0)))
    t = t.withColumn("m", expected).withColumn("whole", F.floor("m")).withColumn("f", F.col("m") - F.col("whole"))
    t = t.withColumn("rest", F.col("target") - F.sum(F.col("whole") * F.col("words")).over(Window.partitionBy("source")))
    plan = settle(t.select("source", "cls", "source_size", "target", "whole", "f", "rest"), "mix-plan", free=False)
    d = _attach(base, plan, ["source", "cls"])
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("f") / (1 - F.col("f")))
    d = d.withColumn("p", F.when((F.col("f") > 0) & (F.col("size") > 0), odds / (1 + odds)))
    d = d.withColumn("b1", F.floor(F.col("p") * BINS)).withColumn("b2", F.floor((F.col("p") * BINS - F.col("b1")) * BINS))
    first = _cut(d, ["source"], "b1", F.lit(0).cast("long"))
    d1 = _attach(d, first, ["source"])
    inside = d1.where("b1 = cut_b1").withColumnRenamed("before_b1", "base_before")
    second = _cut(inside, ["source"], "b2", F.col("base_before"))
    d2 = _attach(d1, second, ["source"])
    # the bin of the bin: a 16-millionth of a source
    tie = Window.partitionBy("source").orderBy("p", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = (F.col("b1") == F.col("cut_b1")) & (F.col("b2") == F.col("cut_b2"))
    sure = F.coalesce(F.col("p").isNotNull() & F.col("rest").isNotNull() & (F.col("cut_b1").isNull() | (F.col("b1") < F.col("cut_b1")) | ((F.col("b1") == F.col("cut_b1")) & (F.col("cut_b2").isNull() | (F.col("b2") < F.col("cut_b2"))))), F.lit(False))
    is_edge = F.coalesce(edge, F.lit(False))
    rows = d2.where(~is_edge).withColumn("extra", sure.cast("int"))
    last = d2.where(is_edge).withColumn("cum", F.col("before_b2") + F.sum("size").over(tie) - F.col("size"))
    last = last.withColumn("extra", (F.col("cum") + F.col("size") / 2.0 <= F.col("rest")).cast("int")).drop("cum")
    out = rows.unionByName(last)
    copies = (F.coalesce(F.col("whole"), F.lit(0)) + F.col("extra")).cast("long")
    return out.select("doc_id", F.col("size").cast("long").alias("size"), F.col("source_size").cast("long").alias("source_size"), "target", (F.col("size") * copies).cast("long").alias("taken"), copies.alias("copies"), *(F.col("__t" if c == text_col else f"k_{c}").alias(c) for c in keep))


def _cut(d: DataFrame, keys: list[str], bin_col: str, before: Column) -> DataFrame:
    """For each source the bin in which its words, in order of the bins, pass `rest` (none if they never do), and the words before it."""
    sums = d.where(F.col(bin_col).isNotNull()).groupBy(*keys, bin_col).agg(F.sum("size").alias("words"), F.any_value("rest").alias("r"), F.any_value(before).alias("b"))
    w = Window.partitionBy(*keys).orderBy(bin_col)  # at most 4096 rows
    s = sums.withColumn("upto", F.col("b") + F.sum("words").over(w))
    over = s.where(F.col("upto") > F.col("r"))
    return over.groupBy(*keys).agg(F.min(bin_col).alias(f"cut_{bin_col}"), F.min(F.col("upto") - F.col("words")).alias(f"before_{bin_col}"))


def op4_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed by source."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("copies")


OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         (CAST('0x' || substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), 'n' || md5(coalesce(text, ''))), ':1')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM documents),
dc AS (SELECT *, CASE WHEN size >= 16384 THEN 7 WHEN size >= 4096 THEN 6 WHEN size >= 1024 THEN 5 WHEN size >= 256 THEN 4 WHEN size >= 64 THEN 3 WHEN size >= 16 THEN 2 WHEN size >= 4 THEN 1 ELSE 0 END AS cls FROM d),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM d GROUP BY source),
sw AS (SELECT *, CASE rk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, CAST(3 * source_size AS HUGEINT) AS cap, (SELECT CAST(sum(source_size) AS HUGEINT) FROM src) AS total FROM src),
it AS (SELECT 0 AS i, max(total) AS rest, CAST(sum(w) AS HUGEINT) AS wsum FROM sw
  UNION ALL
  SELECT i + 1, n.rest, n.wsum FROM it, LATERAL (
    SELECT max(total) - coalesce(sum(CASE WHEN cap * it.wsum < w * it.rest THEN cap END), 0) AS rest, CAST(coalesce(sum(CASE WHEN NOT cap * it.wsum < w * it.rest THEN w END), 0) AS HUGEINT) AS wsum FROM sw) n
  WHERE n.wsum <> it.wsum AND n.wsum > 0),
fin AS (SELECT rest, wsum FROM it ORDER BY i DESC LIMIT 1),
goal AS (SELECT source, source_size, CASE WHEN cap * fin.wsum < w * fin.rest THEN CAST(cap AS DOUBLE) ELSE CAST(w * fin.rest AS DOUBLE) / CAST(fin.wsum AS DOUBLE) END AS target FROM sw, fin),
k AS (SELECT dc.source, cls, CAST(sum(size) AS BIGINT) AS words, cls + 8 AS wt FROM dc GROUP BY dc.source, cls),
k1 AS (SELECT k.*, g.source_size, g.target, CAST(sum(words) OVER (PARTITION BY k.source ORDER BY wt DESC) - words AS DOUBLE) AS held, CAST(sum(words * wt) OVER (PARTITION BY k.source ORDER BY wt) AS DOUBLE) AS open FROM k JOIN goal g ON k.source IS NOT DISTINCT FROM g.source),
k2 AS (SELECT *, CASE WHEN open > 0 THEN (target - 3.0::DOUBLE * held) / open END AS c FROM k1),
k3 AS (SELECT *, max(CASE WHEN c * wt <= 3 THEN wt END) OVER (PARTITION BY source) AS top FROM k2),
k4 AS (SELECT *, max(CASE WHEN wt = top THEN c END) OVER (PARTITION BY source) AS rate FROM k3),
k5 AS (SELECT *, CASE WHEN top IS NULL OR wt > top THEN 3.0::DOUBLE ELSE greatest(rate * wt, 0.0::DOUBLE) END AS m FROM k4),
k6 AS (SELECT *, floor(m) AS whole, m - floor(m) AS f, target - sum(floor(m) * words) OVER (PARTITION BY source) AS rest FROM k5),
e AS (SELECT dc.doc_id, dc.size, dc.source, k6.source_size, k6.target, k6.whole, k6.rest, CASE WHEN f > 0 AND size > 0 THEN (u / (1 - u)) / (f / (1 - f)) END AS q FROM dc JOIN k6 ON dc.source IS NOT DISTINCT FROM k6.source AND dc.cls = k6.cls),
o AS (SELECT *, q / (1 + q) AS p FROM e),
x AS (SELECT *, sum(CASE WHEN p IS NOT NULL THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY p NULLS LAST, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) - size AS before FROM o)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN p IS NOT NULL AND before + size / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM x
"""
