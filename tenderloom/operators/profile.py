"""Profiles of documents: page samples, text quality, running headers, layout strategy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom.config import Profiling
from tenderloom.functions import text as T

DEFAULT = Profiling()


def page_text(items: DataFrame) -> DataFrame:
    """(doc_id, page, text) from text items (doc_id, page, ord, str, has_eol): each followed by a line break or a space, the end trimmed.

    Items without text (null) are dropped; a page without items has no row.
    """
    part = F.struct("ord", F.concat("str", F.when(F.coalesce("has_eol", F.lit(False)), F.lit("\n")).otherwise(F.lit(" "))).alias("part"))
    rows = items.filter("str is not null").groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return rows.select("doc_id", "page", F.regexp_replace(F.array_join("parts.part", ""), rf"[{T.WS}]+\z", "").alias("text"))


def sampled(page: Column, pages: Column, cfg: Profiling = DEFAULT) -> Column:
    """Whether a page of a document with ``pages`` pages is in its sample: all of a short one, else both ends and evenly spaced ones between."""
    size = F.least(F.lit(cfg.sample_max), F.greatest(F.lit(cfg.sample_min), F.floor(pages * cfg.sample_share)))
    stride = F.greatest(F.lit(1), F.floor((pages - 10) / (size - 10)))
    middle = (page >= 6) & (F.pmod(page - 6, stride) == 0) & (page < 6 + (size - 10) * stride)
    return (pages <= size) | (page <= 5) | (page > pages - 5) | middle


def page_sample(pages: DataFrame, cfg: Profiling = DEFAULT) -> DataFrame:
    """The rows (doc_id, page, ...) of the sampled pages; a document has as many pages as its greatest page number."""
    total = pages.groupBy("doc_id").agg(F.max("page").alias("_pages"))
    return pages.join(total, "doc_id").filter(sampled(F.col("page"), F.col("_pages"), cfg)).drop("_pages")


def running_headers(pages: DataFrame, cfg: Profiling = DEFAULT) -> DataFrame:
    """(doc_id, line, n_pages): trimmed lines of over three characters on at least the given share of a document's pages."""
    total = pages.groupBy("doc_id").agg(F.count("*").alias("_pages"))
    lines = pages.select("doc_id", "page", F.explode(F.array_distinct(F.transform(F.split("text", "\n"), T.trim))).alias("line")).filter(F.length("line") > 3)
    seen = lines.distinct().groupBy("doc_id", "line").agg(F.count("*").alias("n_pages"))
    return seen.join(total, "doc_id").filter(F.col("n_pages") >= cfg.repeated_share * F.col("_pages")).drop("_pages")


def strategy(positions: Column, preambles: Column, cfg: Profiling = DEFAULT) -> Column:
    many, full = positions > cfg.positions_over, preambles > cfg.preambles_over
    return F.when(many & full, "mixed").when(full, "vorbemerkungen-heavy").when(many, "lv-position").otherwise("section-list")


def profile(pages: DataFrame, cfg: Profiling = DEFAULT) -> DataFrame:
    """One row per document over its pages (doc_id, page, text).

    Average characters a page, share of ligature characters, whether price
    column labels occur, counts of codes, pages with preamble codes, the
    strategy these suggest and the confidence in the text layer. A document
    without characters has a ligature rate of 0; null texts count as empty.
    """
    t = F.coalesce("text", F.lit(""))
    per_page = pages.select("doc_id", F.length(t).alias("chars"), (F.length(t) - F.length(F.translate(t, "ﬀﬁﬂﬃﬄﬅﬆ", ""))).alias("ligatures"), T.has_column_labels(t).alias("labels"), T.count_positions(t).alias("positions"), T.count_preambles(t).alias("preambles"))
    out = per_page.groupBy("doc_id").agg(
        F.count("*").alias("page_count"), F.sum("chars").alias("chars"), F.sum("ligatures").alias("ligatures"), F.max("labels").alias("column_noise"),
        F.sum("positions").cast("long").alias("positions"), F.sum("preambles").cast("long").alias("preambles"), F.count_if(F.col("preambles") > 0).alias("preamble_pages"),
    )
    rate = F.when(F.col("chars") > 0, F.col("ligatures") / F.col("chars")).otherwise(F.lit(0.0))
    return out.select(
        "doc_id", "page_count", F.round(F.col("chars") / F.col("page_count"), 6).alias("avg_chars"), F.round(rate, 9).alias("ligature_rate"), "column_noise", "positions", "preambles", "preamble_pages",
        strategy(F.col("positions"), F.col("preambles"), cfg).alias("strategy"),
        F.when(rate > cfg.ligature_limit, "low").when(F.col("column_noise"), "medium").otherwise("high").alias("parser_confidence"),
    )
