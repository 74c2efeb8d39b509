"""Numeric grounding: does every value of a description stand in its sources?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom.functions import text as T


def ungrounded(description: Column, source: Column) -> Column:
    """The values of ``description``, repeats included, of which no written form is among the number tokens of ``source``."""
    forms = F.array_distinct(F.flatten(F.transform(T.number_tokens(source), T.number_forms)))
    return F.filter(T.value_tokens(description), lambda n: ~F.arrays_overlap(T.number_forms(n), forms))


def source_texts(requirements: DataFrame, chunks: DataFrame) -> DataFrame:
    """(id, source): heading, position and content of each requirement's chunks, in order, as one text.

    Unknown and null chunk ids add nothing; a requirement without known chunks
    has an empty text. ``chunks`` has one row per ``chunk_id``.
    """
    refs = requirements.select("id", F.posexplode_outer("source_chunk_ids").alias("pos", "chunk_id"))
    text = F.concat_ws("\n", "content", "section_heading", "lv_position")
    found = refs.join(chunks.select("chunk_id", text.alias("text")), "chunk_id", "left")
    return found.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("pos", "text")))), lambda r: r["text"]), "\n").alias("source"))


def grounded(requirements: DataFrame, chunks: DataFrame) -> DataFrame:
    """(id, n_values, n_ungrounded, confidence): values of ``description_en`` checked, those not found, and the confidence, low where one is missing.

    A value may stand in a source chunk, in the German description or in the
    requirement's own heading, codes and standards. A null description has no
    values; a null confidence stays null where nothing is missing.
    """
    own = F.concat_ws("\n", "description_de", "section_heading", "item_number", "category_code", F.array_join(F.coalesce("standards", F.array().cast("array<string>")), " "))
    rows = requirements.select("id", F.coalesce("description_en", F.lit("")).alias("d"), F.col("confidence").alias("was"), own.alias("own"))
    checked = rows.join(source_texts(requirements, chunks), "id").withColumn("missing", ungrounded(F.col("d"), F.concat_ws("\n", "own", "source")))
    return checked.select("id", F.size(T.value_tokens("d")).alias("n_values"), F.size("missing").alias("n_ungrounded"), F.when(F.size("missing") > 0, "low").otherwise(F.col("was")).alias("confidence"))


def grounding_stats(checked: DataFrame) -> DataFrame:
    """One row of totals over ``grounded``; requirements without values aren't counted as checked."""
    some = F.col("n_values") > 0
    return checked.agg(F.count_if(some).alias("leaves_checked"), F.count_if(F.col("n_ungrounded") > 0).alias("leaves_flagged"), F.coalesce(F.sum("n_values"), F.lit(0)).alias("values_checked"), F.coalesce(F.sum("n_ungrounded"), F.lit(0)).alias("values_ungrounded"))
