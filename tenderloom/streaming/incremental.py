"""Incremental runs: new line files are profiled and cut into chunks as they come, chunks arrive once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tenderloom.plans.pipeline import from_lines

LINES = "doc_id string, page int, line_no long, text string, font_size double"


def new_chunks(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Every document file that is new in ``source`` (Parquet lines, whole documents) as chunks in ``target``; ends when all are done.

    A batch that is tried again replaces what it wrote, by batch number, so each
    document counts once whatever fails.
    """

    def write(batch: DataFrame, number: int) -> None:
        from_lines(batch)[1].write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(LINES).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def once_by_key(stream: DataFrame, key: str, time: str, late: str = "30 days") -> DataFrame:
    """A stream without redelivered rows of ``key`` that come within ``late`` of each other by ``time``."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
