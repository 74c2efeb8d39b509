"""Extraction around a model: cache probes, validation, enrichment, the recall pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom.functions import text as T

TEXTS = ("category_code", "item_number", "source_language", "description_de")
LISTS = ("standards", "referenced_annexes", "cross_referenced_positions")
ENUMS = {"priority": ("must", "should", "optional"), "confidence": ("high", "medium", "low")}


def _at(item: Column, field: str, kind: str) -> Column:
    return F.try_variant_get(item, f"$.{field}", kind)


def _type(item: Column, field: str) -> Column:
    """The JSON type of a field: STRING, BOOLEAN, VOID for an explicit null; null if it is missing."""
    return F.schema_of_variant(_at(item, field, "variant"))


def is_valid(item: Column) -> Column:
    """Whether a JSON item meets the extraction contract.

    Titles of three characters and English descriptions of five are required,
    so are the enumerations and the key ``equivalence_allowed``, which may be
    null; lists hold strings and may be missing but not null; other texts may
    be missing or null. A value of another type fails.
    """
    text = lambda f: F.coalesce(_type(item, f) == "STRING", F.lit(False))
    ok = text("bullet_point") & (F.length(_at(item, "bullet_point", "string")) >= 3) & text("description_en") & (F.length(_at(item, "description_en", "string")) >= 5)
    for f, values in ENUMS.items():
        ok = ok & text(f) & _at(item, f, "string").isin(*values)
    ok = ok & F.coalesce(_type(item, "equivalence_allowed").isin("BOOLEAN", "VOID"), F.lit(False))
    for f in TEXTS:
        ok = ok & F.coalesce(_type(item, f).isin("STRING", "VOID"), F.lit(True))
    for f in LISTS:
        ok = ok & F.coalesce(_type(item, f).isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.exists(_at(item, f, "array<string>"), lambda x: x.isNull()), _type(item, f).isNull())
    return F.coalesce(ok, F.lit(False))


def validated(raw: DataFrame) -> DataFrame:
    """The valid items of (chunk_id, item_ord, item_json) as typed columns; text that is no JSON object is dropped like any invalid item."""
    parsed = raw.withColumn("item", F.try_parse_json("item_json")).filter(is_valid(F.col("item")))
    item = F.col("item")
    empty = F.array().cast("array<string>")
    return parsed.select(
        "chunk_id", "item_ord", *[_at(item, f, "string").alias(f) for f in ("bullet_point", "description_en", "description_de", "priority", "confidence")], _at(item, "equivalence_allowed", "boolean").alias("equivalence_allowed"),
        *[F.coalesce(_at(item, f, "array<string>"), empty).alias(f) for f in LISTS], *[_at(item, f, "string").alias(f) for f in ("category_code", "item_number", "source_language")],
    )


def enriched(items: DataFrame, chunks: DataFrame) -> DataFrame:
    """Valid items with their chunk's metadata, which goes before their own; items of unknown chunks are dropped."""
    c = chunks.select("chunk_id", "source_file", "page_number", "section_heading", F.col("category_code").alias("_category"), F.col("lv_position").alias("_position"))
    out = items.join(c, "chunk_id")
    return out.withColumn("category_code", F.coalesce("_category", "category_code")).withColumn("item_number", F.coalesce("_position", "item_number")).withColumn("source_language", T.language_code("source_language")).drop("_category", "_position")


def cache_misses(chunks: DataFrame, cached: DataFrame, force: bool = False) -> DataFrame:
    """The chunks without a cached reply (all of them if ``force``); an empty reply is a hit, so ``cached`` needs a row for it."""
    return chunks if force else chunks.join(cached.select("chunk_id").distinct(), "chunk_id", "left_anti")


def glean_candidates(chunks: DataFrame, items: DataFrame) -> DataFrame:
    """The chunks for the recall pass: other than positions, with something found in the first."""
    return chunks.filter("document_region <> 'lv-position'").join(items.select("chunk_id").distinct(), "chunk_id", "left_semi")


def gleaned_new(gleaned: DataFrame, first: DataFrame) -> DataFrame:
    """Gleaned items whose title, trimmed and lower-cased, the first pass of their chunk lacks; repeats among them stay. A null title is new."""
    key = lambda d: d.withColumn("_key", F.lower(T.trim("bullet_point")))
    return key(gleaned).join(key(first).select("chunk_id", "_key").distinct(), ["chunk_id", "_key"], "left_anti").drop("_key")


def both_passes(first: DataFrame, gleaned: DataFrame) -> DataFrame:
    return first.unionByName(gleaned_new(gleaned, first), allowMissingColumns=True)


def user_message(region: Column, position: Column, category: Column, heading: Column, content: Column) -> Column:
    """What a model is told of a chunk: a line for each known property, then the content."""
    line = lambda name, c: F.when(F.length(c) > 0, F.concat(F.lit(f"{name}: "), c))
    return F.concat_ws("\n", line("Document region", region), line("LV position", position), line("Category code", category), line("Section heading", heading), content)


def halves(content: Column) -> Column:
    """A text in two: by lines, else by words, else by characters, the left half the longer; a text of one character stays whole."""
    def cut(parts: Column, glue: str) -> Column:
        left = F.ceil(F.size(parts) / 2).cast("int")
        return F.array(F.array_join(F.slice(parts, F.lit(1), left), glue), F.array_join(F.slice(parts, left + 1, F.greatest(F.size(parts) - left, F.lit(0))), glue))

    lines, words = F.split(content, "\n"), F.split(content, rf"[{T.WS}]+")
    half = F.ceil(F.length(content) / 2).cast("int")
    chars = F.array(F.substring(content, F.lit(1), half), F.substring(content, half + 1, F.length(content)))
    return F.when(F.size(lines) > 1, cut(lines, "\n")).when(F.size(words) > 1, cut(words, " ")).when(F.length(content) > 1, chars).otherwise(F.array(content))
