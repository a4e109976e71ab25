"""Incremental ingestion with Structured Streaming: new Markdown files are cleaned and split as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.chain import clean_table


def markdown_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """(path, md) of files as they arrive in folder."""
    s = spark.readStream.option("wholetext", "true").option("maxFilesPerTrigger", files_per_batch).schema("value string").text(folder)
    return s.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("md"))


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, then: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Clean what is there and not done yet (availableNow) into Parquet at out. The checkpoint makes it resumable and exactly-once; then is called with each batch."""

    def batch(df: DataFrame, n: int) -> None:
        done = clean_table(df.select("path", "md"))
        done.write.mode("overwrite").parquet(f"{out}/batch={n}")
        if then is not None:
            then(done, n)

    return markdown_stream(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
