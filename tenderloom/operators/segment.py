"""Structure-aware segmentation of lines into chunks.

Headings open sections, a label that leads a line opens an item, all else is
body of what is open. With a boundary flag per line that is a running sum; the
lines of one number are one segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom.config import DEFAULT_HEADING, FIVE_PART, PREAMBLE, THREE_PART, Chunking, Profiling
from tenderloom.functions import text as T
from tenderloom.operators.order import numbered, running
from tenderloom.runtime import Cut

DEFAULT = Chunking()
LINE = ("doc_id", "page", "line_no", "text", "font_size", "strip_noise")
ITEM = rf"^(\d{{1,3}}(?:\.\d{{1,3}})+|\d{{1,3}}[.)]|[A-Za-z][.)]|[•·*])[{T.WS}]+[^{T.WS}]"
GROUP_HEADER = rf"^\d{{2}}(?:\.\d{{2}})?[{T.WS}]+\p{{Lu}}[\p{{L}} ./&-]{{2,}}\z"


def is_caps_heading(t: Column, longest: int = 60) -> Column:
    """4 to ``longest`` characters, not ending in punctuation, three letters or more and all of them capital."""
    letters = F.regexp_replace(t, r"[^\p{L}]", "")
    return F.length(t).between(4, longest) & ~t.rlike(r"[.,:;]\z") & (F.length(letters) >= 3) & (letters == F.upper(letters))


def is_group_header(t: Column) -> Column:
    return t.rlike(GROUP_HEADER)


def code_label(t: Column) -> Column:
    """The position code that leads a line, as a struct (code, region, lv_position, category_code); null without one."""
    lead = lambda p: F.regexp_extract(t, rf"^({p})(?:[{T.WS}]|\z)", 1)
    null = F.lit(None).cast("string")
    make = lambda code, region, position, category: F.struct(code.alias("code"), F.lit(region).alias("region"), position.alias("lv_position"), category.alias("category_code"))
    preamble, five, three = lead(PREAMBLE), lead(FIVE_PART), lead(THREE_PART)
    part = lambda c, i: F.get(F.split(c, r"\."), F.lit(i))
    return (
        F.when(preamble != "", make(preamble, "vorbemerkungen", null, F.nullif(part(preamble, 3), F.lit("00"))))
        .when(five != "", make(five, "lv-position", five, part(five, 2)))
        .when(three != "", make(three, "lv-position", three, null))
    )


def item_label(t: Column) -> Column:
    """The list label that leads a line with text behind it, without its closing mark; null without one."""
    found = F.regexp_extract(t, ITEM, 1)
    return F.when(found != "", F.regexp_replace(found, r"[.)]+\z", ""))


def body_size(lines: DataFrame) -> DataFrame:
    """(doc_id, body): the most frequent font size of a document, to a tenth; of equally frequent ones the first seen."""
    size = F.floor(F.col("font_size") * 10 + 0.5) / 10
    counted = lines.groupBy("doc_id", size.alias("body")).agg(F.count("*").alias("n"), F.min(F.struct("page", "line_no")).alias("first"))
    ranked = F.struct("n", (-F.col("first.page")).alias("p"), (-F.col("first.line_no")).alias("l"))
    return counted.groupBy("doc_id").agg(F.max_by("body", ranked).alias("body"))


def repeated_keys(lines: DataFrame, share: float = Profiling.repeated_share) -> DataFrame:
    """(doc_id, key, n_pages): digit-masked lines of four characters or more on at least two pages and the given share of them."""
    pages = lines.groupBy("doc_id").agg(F.countDistinct("page").alias("_pages"))
    t = T.trim(T.normalize_inline("text"))
    keyed = lines.select("doc_id", "page", t.alias("t")).filter(F.length("t") >= 4).select("doc_id", "page", T.page_key("t").alias("key")).distinct()
    seen = keyed.groupBy("doc_id", "key").agg(F.count("*").alias("n_pages"))
    return seen.join(pages, "doc_id").filter(F.col("n_pages") >= F.greatest(F.lit(2), F.ceil(F.col("_pages") * share))).drop("_pages")


def kept_lines(lines: DataFrame, share: float = Profiling.repeated_share) -> DataFrame:
    """The lines (with doc_id, page and line_no), normalized and trimmed, without empty ones, running headers and, where ``strip_noise`` says so, price column labels."""
    lines = lines.select(*[c for c in LINE if c in lines.columns]).filter("doc_id is not null and page is not null and line_no is not null")
    t = lines.withColumn("text", T.trim(T.normalize_inline("text"))).filter("text <> ''").withColumn("key", T.page_key("text"))
    kept = t.join(repeated_keys(lines, share).select("doc_id", "key"), ["doc_id", "key"], "left_anti").drop("key")
    return kept.filter(~(F.coalesce("strip_noise", F.lit(False)) & T.is_column_noise("text"))) if "strip_noise" in lines.columns else kept


def classified(lines: DataFrame, cfg: Chunking = DEFAULT) -> DataFrame:
    """The kept lines with ``kind`` (heading, item or body), ``label`` and ``code``. A heading goes before a code, a code before a list label."""
    t = F.col("text")
    heading = (F.col("font_size") >= F.col("body") * cfg.heading_ratio) | is_caps_heading(t, cfg.heading_length) | is_group_header(t)
    lines = lines.select(*[c for c in LINE if c in lines.columns])
    marked = lines.join(body_size(lines), "doc_id").withColumn("heading_", F.coalesce(heading, F.lit(False))).withColumn("code", F.when(~F.col("heading_"), code_label(t)))
    label = F.when(~F.col("heading_"), F.coalesce(F.col("code.code"), item_label(t)))
    return marked.withColumn("label", label).withColumn("kind", F.when(F.col("heading_"), "heading").when(F.col("label").isNotNull(), "item").otherwise("body")).drop("heading_", "body")


def split_to_budget(content: Column, limit: int = DEFAULT.token_limit, per_token: int = DEFAULT.chars_per_token) -> Column:
    """A text as an array of parts, lines packed greedily up to the token limit; one line over it stays whole."""
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(None).cast("string").alias("open"))

    def step(acc, line):
        longer = F.concat(acc["open"], F.lit("\n"), line)
        full = F.coalesce(T.token_estimate(longer, per_token) > limit, F.lit(False))
        return F.struct(F.when(full, F.concat(acc["parts"], F.array(acc["open"]))).otherwise(acc["parts"]).alias("parts"), F.when(full | acc["open"].isNull(), line).otherwise(longer).alias("open"))

    packed = F.aggregate(F.split(content, "\n"), start, step, lambda acc: F.concat(acc["parts"], F.array(acc["open"])))
    return F.when(T.token_estimate(content, per_token) > limit, packed).otherwise(F.array(content))


def segments(lines: DataFrame, cfg: Chunking = DEFAULT, share: float = Profiling.repeated_share) -> DataFrame:
    """One row per segment: (doc_id, segment, page, heading, label, region, lv_position, category_code, content).

    ``lines`` has doc_id, page, line_no, text, font_size and perhaps
    strip_noise. A section without body lines gives no row; its content begins
    with its heading and its page is that of its first body line; an item's is
    that of its label line. Lines before any heading belong to a section under
    the default heading. Pages bound the windows, so a document of any length
    is spread over its pages.
    """
    rows = Cut(classified(Cut(kept_lines(lines, share), "lines").df, cfg), "lines").df  # both are read more than once
    kind = F.col("kind")
    counted = running(rows, ["doc_id"], ["page"], ["line_no"], kind != "body", F.when(kind == "heading", F.col("text")), ("segment", "heading"))
    place = F.struct("page", "line_no")
    packed = counted.groupBy("doc_id", "segment").agg(
        F.array_sort(F.collect_list(F.struct("page", "line_no", "kind", "text"))).alias("rows"), F.min_by("heading", place).alias("heading"),
        F.max(F.when(kind == "item", F.struct("label", "code"))).alias("item"), F.min(F.when(kind == "body", F.col("page"))).alias("body_page"), F.min("page").alias("first_page"),
    )
    own = F.col("item").isNotNull()
    section = own | F.col("body_page").isNotNull()
    heading = F.coalesce("heading", F.lit(DEFAULT_HEADING))
    texts = F.transform(F.filter("rows", lambda r: r["kind"] != "heading"), lambda r: r["text"])
    content = F.array_join(F.when(own, texts).otherwise(F.concat(F.array(heading), texts)), "\n")
    return packed.filter(section).select(
        "doc_id", "segment", F.when(own, F.col("first_page")).otherwise(F.col("body_page")).alias("page"), heading.alias("heading"), F.when(own, F.col("item.label")).otherwise(F.lit("sec")).alias("label"),
        F.coalesce("item.code.region", F.lit("section")).alias("region"), F.col("item.code.lv_position").alias("lv_position"), F.col("item.code.category_code").alias("category_code"), T.trim(content).alias("content"),
    )


def chunks(segment_rows: DataFrame, cfg: Chunking = DEFAULT) -> DataFrame:
    """Chunk rows from segments: empty and cancelled blocks dropped, the rest split to the token budget and numbered within the document."""
    kept = segment_rows.filter((F.col("content") != "") & ~T.is_cancelled("content"))
    parts = kept.select("*", F.posexplode(split_to_budget(F.col("content"), cfg.token_limit, cfg.chars_per_token)).alias("part", "piece")).filter(T.trim("piece") != "")
    numbered_ = numbered(parts, ["doc_id"], ["page"], ["segment", "part"], "seq")
    name = F.concat(T.file_slug("doc_id"), F.lit("__"), F.col("region"), F.lit("_"), F.regexp_replace("label", "[^a-zA-Z0-9]+", "_"), F.lit("__i"), F.col("seq").cast("string"))
    return numbered_.select(
        name.alias("chunk_id"), F.col("doc_id").alias("source_file"), F.col("page").alias("page_number"), F.col("heading").alias("section_heading"), "lv_position", F.col("region").alias("document_region"), "category_code",
        F.col("piece").alias("content"), F.col("seq").cast("int").alias("seq"),
    )


def region_counts(chunk_rows: DataFrame) -> DataFrame:
    """(source_file, document_region, n_chunks)."""
    return chunk_rows.groupBy("source_file", "document_region").agg(F.count("*").alias("n_chunks"))
