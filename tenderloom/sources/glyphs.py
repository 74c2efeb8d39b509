"""Sources of positioned text: a data source for page files, and adapters from plain text and HTML.

The data source reads JSON page files, one JSON array of text items a page, as
any PDF library can write them; with a callable of ``doc_id`` and bytes it
reads PDF files directly. Documents are split over tasks by file.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom.runtime import ship

ITEMS = "doc_id string, page int, ord int, str string, transform array<double>, width double, height double, has_eol boolean, error string"
_NAMES = [c.split()[0] for c in ITEMS.split(", ")]
PDF = "*.[pP][dD][fF]"

#: Gives for the bytes of a document the text items of each page: dicts with str, transform, width, height, hasEOL.
Reader = Callable[[bytes], list[list[dict]]]


def json_pages(content: bytes) -> list[list[dict]]:
    return json.loads(content)


def files(spark: SparkSession, folder: str | None = None, paths: list[str] | None = None, pattern: str = PDF) -> DataFrame:
    """(turn, path, content) of the files given and of those in a folder (not below it), which match ``pattern``, none dropped as repeated. The order to show them in is ``turn`` (0 for given files), then ``path``; rows come as read."""
    parts = []
    if paths:
        parts.append(spark.read.format("binaryFile").load(paths).select(F.lit(0).alias("turn"), "path", "content"))
    if folder:
        parts.append(spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "false").load(folder).select(F.lit(1).alias("turn"), "path", "content"))
    if not parts:
        raise ValueError("no input: give files or a folder")
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select("turn", "path", "content")


def _reading(reader: Reader):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for doc, content in zip(b["doc_id"], b["content"], strict=True):
                rows = []
                try:
                    for page, items in enumerate(reader(bytes(content)), 1):
                        for i, x in enumerate(items):
                            rows.append((doc, page, i, x.get("str"), x.get("transform"), x.get("width"), x.get("height"), x.get("hasEOL"), None))
                except Exception as e:  # noqa: BLE001 - one bad file must not end the others
                    rows = [(doc, None, None, None, None, None, None, None, str(e)[:500])]
                yield pd.DataFrame(rows, columns=_NAMES)

    return run


def text_items(found: DataFrame, reader: Reader = json_pages) -> DataFrame:
    """Text items of each file. A file that can't be read gives one row with its ``error`` and no text; the others are unaffected."""
    ship(found.sparkSession)
    named = found.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("doc_id"), "content")
    return named.mapInPandas(_reading(reader), ITEMS)


def text_lines(documents: DataFrame, doc_id: str, text: str, page: str | None = None, size: float = 10.0) -> DataFrame:
    """Lines from plain texts: one page each, or as ``page`` says."""
    rows = documents.select(F.col(doc_id).cast("string").alias("doc_id"), (F.col(page).cast("int") if page else F.lit(1)).alias("page"), F.posexplode(F.split(text, "\r\n|\n|\r")).alias("line_no", "text"))
    return rows.withColumn("font_size", F.lit(size))


class _Lines(HTMLParser):
    BLOCKS = frozenset(("p", "div", "li", "tr", "br", "section", "article", "table", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "title"))
    # Sizes of headings.
    SIZES = {"title": 20.0, "h1": 20.0, "h2": 16.0, "h3": 14.0, "h4": 13.0, "h5": 12.0, "h6": 12.0}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.open, self.sizes, self.silent = [], "", [], 0

    def flush(self):
        t = " ".join(self.open.split())
        if t:
            self.lines.append((t, self.sizes[-1] if self.sizes else 10.0))
        self.open = ""

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCKS:
            self.flush()
        if tag in self.SIZES:
            self.sizes.append(self.SIZES[tag])
        if tag in ("script", "style"):
            self.silent += 1
        if tag == "li":
            self.open = "• "

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.flush()
        if tag in self.SIZES and self.sizes:
            self.sizes.pop()
        if tag in ("script", "style") and self.silent:
            self.silent -= 1

    def handle_data(self, data):
        if not self.silent:
            self.open += data


def html_lines(documents: DataFrame, doc_id: str, html: str) -> DataFrame:
    """Lines from HTML: block elements end lines, headings are larger, list items begin with a bullet; scripts and styles are left out."""
    ship(documents.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for d, h in zip(b["doc_id"], b["html"], strict=True):
                parser = _Lines()
                parser.feed(h or "")
                parser.close()
                parser.flush()
                rows.extend((d, 1, i, t, s) for i, (t, s) in enumerate(parser.lines))
            yield pd.DataFrame(rows, columns=["doc_id", "page", "line_no", "text", "font_size"])

    named = documents.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(html).alias("html"))
    return named.mapInPandas(run, "doc_id string, page int, line_no int, text string, font_size double")
