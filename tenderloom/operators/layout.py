"""Text lines from positioned glyphs.

A line is a band of glyphs around its first one: from the top down, a glyph
opens a new band if it lies further than the tolerance from the glyph that
opened the last. That is a fold over the page, not a comparison of neighbours,
so it is one ``aggregate`` over the page's sorted glyph heights; everything
else is windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.config import Layout
from tenderloom.functions.text import WS

DEFAULT = Layout()


def glyphs(items: DataFrame) -> DataFrame:
    """(doc_id, page, ord, str, x, y, width, size) from text items with a ``transform`` of six numbers; the size falls back to the height, then 0."""
    size = F.coalesce(F.nullif(F.abs(F.get("transform", F.lit(3))), F.lit(0.0)), F.nullif("height", F.lit(0.0)), F.lit(0.0))
    at = lambda i: F.coalesce(F.get("transform", F.lit(i)), F.lit(0.0))
    return items.filter("str is not null and transform is not null").select("doc_id", "page", "ord", "str", at(4).alias("x"), at(5).alias("y"), "width", size.alias("size"))


def lines(glyph_rows: DataFrame, cfg: Layout = DEFAULT) -> DataFrame:
    """(doc_id, page, line_no, text, x, y, width, font_size) of each page's lines, from the top.

    Glyphs with an empty or null text are dropped; the tolerance is a share of
    the page's upper median of sizes above 0. Within a line glyphs go from left
    to right (ties by ``ord``), with a space where the gap is wider than a share
    of the glyph's size; runs of white space become one space. Pages are the
    unit of work, so no group is larger than a page.
    """
    g = glyph_rows.filter("str is not null and str <> ''").select("doc_id", "page", "ord", "str", "x", "y", "width", "size")
    row = F.struct((-F.col("y")).alias("down"), "x", "ord", "y", "str", "width", "size")
    pages = g.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(row)).alias("g"), F.array_sort(F.collect_list(F.when(F.col("size") > 0, F.col("size")))).alias("sizes"))
    median = F.coalesce(F.get("sizes", F.floor(F.size("sizes") / 2).cast("int")), F.lit(cfg.default_size))
    # Only the heights that open a band are carried along, so the fold copies a few values, not one for each glyph.
    start = F.array().cast("array<double>")
    step = lambda opened, y: F.when(F.coalesce(F.abs(y - F.element_at(opened, -1)) > F.col("tolerance"), F.lit(True)), F.concat(opened, F.array(y))).otherwise(opened)
    banded = pages.withColumn("tolerance", median * cfg.line_tolerance).withColumn("opened", F.aggregate("g.y", start, lambda o, y: F.when(F.size(o) == 0, F.array(y)).otherwise(step(o, y))))
    line_no = F.size(F.filter("opened", lambda o: o >= F.col("z.y"))) - 1
    flat = banded.select("doc_id", "page", "opened", F.explode("g").alias("z")).select("doc_id", "page", line_no.alias("line_no"), "z.*")
    w = Window.partitionBy("doc_id", "page", "line_no").orderBy("x", "ord")
    gap = F.col("x") - F.lag(F.col("x") + F.col("width")).over(w) > F.col("size") * cfg.word_gap
    part = F.concat(F.when(gap, F.lit(" ")).otherwise(F.lit("")), "str")
    spaced = flat.withColumn("part", part)
    joined = spaced.groupBy("doc_id", "page", "line_no").agg(
        F.array_sort(F.collect_list(F.struct("x", "ord", "part"))).alias("parts"), F.min_by("x", F.struct("x", "ord")).alias("x"), F.max("y").alias("y"),
        F.max_by(F.col("x") + F.col("width"), F.struct("x", "ord")).alias("right"), F.max("size").alias("font_size"),
    )
    text = F.trim(F.regexp_replace(F.array_join("parts.part", ""), rf"[{WS}]+", " "))
    return joined.select("doc_id", "page", "line_no", text.alias("text"), "x", "y", (F.col("right") - F.col("x")).alias("width"), "font_size")
