"""Session-level helpers: the shared folder, settled tables, sizes."""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir; where that is unset, one of our own in local mode (tests), an error elsewhere."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        at = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files that no plan refers to any longer; it acts on what a second collection finds."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def own_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/quire/{name}-{uuid.uuid4().hex}"
    p, fs = _file(spark, path)
    fs.deleteOnExit(p)
    return path


def _file(spark: SparkSession, path: str) -> tuple:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discard(df: DataFrame) -> None:
    """Remove a table that `settle` wrote and that nothing will read again."""
    p, fs = _file(df.sparkSession, df._settled_at)
    fs.delete(p, True)


def settle(df: DataFrame, name: str, free: bool = True) -> DataFrame:
    """Cut the lineage: write df to a table in the shared folder and read that. Executors may be lost afterwards. With `free`, shuffle files nobody refers to any longer are released.

    The tables are removed by `discard`, or when the application ends.
    """
    spark = df.sparkSession
    path = own_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled_at = path
    if free:
        release(spark)
    return out


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the size of df, for choosing numbers of buckets; where it has none, the bytes of the strings are added up."""
    told = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if told < 1 << 55:
        return told
    texts = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    return int(df.select(F.sum(sum(texts, F.lit(16).cast("long")))).first()[0] or 0)


def buckets_for(df: DataFrame, each: int = 12 << 20, least: int = 4, most: int = 1 << 20) -> int:
    """A number of shuffle buckets in proportion to the input."""
    return max(least, min(most, -(-input_bytes(df) // each)))


def new_names(df: DataFrame, *stems: str) -> list[str]:
    """A column name for each stem that df does not have, whatever the case of letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for s in stems:
        while s.lower() in taken:
            s += "_"
        taken.add(s.lower())
        out.append(s)
    return out


def places(df: DataFrame) -> DataFrame:
    """df, which is sorted across its partitions, with `place`: the number of the row from 0. Read df from a settled table; only the sizes of its partitions are joined back."""
    spark = df.sparkSession
    at = df.withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    at = settle(at, "placed", free=False)
    sizes = sorted((r[0], r[1]) for r in at.groupBy("__p").count().collect())  # one row for each partition
    before, rows = 0, []
    for p, n in sizes:
        rows.append((p, before))
        before += n
    upto = spark.createDataFrame(rows, "__p int, __before long")
    return at.join(F.broadcast(upto), "__p").withColumn("place", F.col("__before") + F.col("__i")).drop("__p", "__i", "__before")


def by(df: DataFrame, n: int, key: str):
    """df grouped by a whole-number key over n tasks, whatever spark.sql.shuffle.partitions says: n grows with the input, so a task's share does not. Keys that follow each other go to different tasks, where hashing would put several into one."""
    return df.withColumn("__slot", F.pmod(F.col(key), F.lit(n)).cast("int")).repartitionById(n, F.col("__slot")).groupBy("__slot", key)


def keyed_docs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, key: rows that agree in id and text share a key."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    return d.withColumn("key", F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text"))


def part_of(parts: int) -> Column:
    """key as an unsigned number modulo parts."""
    return ((F.shiftrightunsigned("key", 1) % parts * 2 + F.col("key").bitwiseAND(1)) % parts).cast("int")
