"""A corpus pipeline: five operators of quire.llm, each applied to all that the one before it kept.

Every stage takes and returns a table of documents; the last returns the documents of the mix with their numbers of copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontam, mixing, near_dedup, pii, toxicity
from quire.llm.cluster import discard, new_names, settle

ORACLE_SQL = None  # classifiers and random fields are not for SQL; tests/llm compares the stages with brute force


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifiers reject go.

    Null and empty texts have no features and stay; null ids are judged like others; repeated rows go or stay together; an empty
    table, or labels without a toxic row, leave all as it is; all columns stay, whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels, toxicity.fold() != 1))


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, nulls last.

    Null and empty texts are in no group and stay, as many as there are; of rows that agree in id and text one stays; an empty table
    stays empty; all columns stay, whatever their names.
    """
    return near_dedup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold any phrase of a benchmark item go.

    Null and empty texts and those of an empty benchmark stay; null ids are judged like others; repeated rows go or stay together;
    an empty table stays empty; all columns stay, whatever their names.
    """
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by the names of their kinds; n_chars, if there is one, follows.

    Null texts stay null; null ids and repeated rows are redacted like others; an empty table stays empty; all columns stay.
    """
    clean = pii.redact(docs, pii.fit(docs))
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(docs.columns) if "n_chars" in docs.columns else clean


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, all columns, with copies: how often each is taken, and taken: the words that makes.

    Null and empty texts have no words and are taken as often as each text of their length class is for certain; null sources are one source; repeated rows draw alike; an empty table stays
    empty. Where docs has columns of these names already, the new ones get an underscore.
    """
    named = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    slim = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in named.items()))
    rest = [n for c, n in named.items() if c != "doc_id"]
    mixed = mixing.mix(slim, tuple(rest), named["doc_id"], named["text"], named["source"]).where("copies > 0")
    copies, taken = new_names(docs, "copies", "taken")
    back = [(F.col("doc_id") if c == "doc_id" else F.col(n)).alias(c) for c, n in named.items()]
    return mixed.select(*back, F.col("copies").alias(copies), F.col("taken").alias(taken))


STAGES = [
    ("toxicity", toxicity_filter),
    ("near duplicates", near_duplicate_filter),
    ("decontamination", decontamination),
    ("pii", pii_redaction),
    ("mixing", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of sf_dir, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        done = settle(stage(spark, docs, sf_dir), f"pipeline-{k}")
        if k:
            discard(docs)
        docs = done
    return docs
