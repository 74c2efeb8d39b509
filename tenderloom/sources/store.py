"""The reply cache and the artifacts of a run, as tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPLIES = "cache_key string, chunk_id string, source_file string, items array<string>"


def cache_key(chunks: DataFrame, version: str, model: str) -> DataFrame:
    """Chunks with ``cache_key``: a change of content, prompt version or model is another key, so stale replies are never hits."""
    return chunks.withColumn("cache_key", F.sha2(F.concat_ws("\x1f", F.lit(version), F.lit(model), "content"), 256))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cached replies; a cache that isn't there is empty. Replies that aren't an array of items are no hits."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], REPLIES)
    return spark.read.schema(REPLIES).parquet(path).filter("items is not null")


def write_cache(replies: DataFrame, path: str) -> None:
    """Append replies, by tender. Failed ones (null items) are left out, empty ones kept: they are hits."""
    replies.filter("items is not null").select("cache_key", "chunk_id", "source_file", "items").write.mode("append").partitionBy("source_file").parquet(path)


def split_by_cache(chunks: DataFrame, cached: DataFrame, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """(hits with their items, misses) of keyed chunks."""
    once = cached.groupBy("cache_key").agg(F.max("items").alias("items"))
    if force:
        once = once.limit(0)
    return chunks.join(once, "cache_key"), chunks.join(once, "cache_key", "left_anti")


def write_artifact(df: DataFrame, path: str, by: str | None = None) -> None:
    """A stage's rows as JSON lines, nulls written out; in folders by a column if named."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(by) if by else writer).json(path)


def pretty(df: DataFrame, limit: int) -> str:
    """At most ``limit`` rows as one indented JSON array, for people to read."""
    rows = [json.loads(x) for x in df.limit(limit).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).toPandas()["j"]]
    return json.dumps(rows, indent=2, ensure_ascii=False)
