"""Text functions as columns. White space follows one class, ``WS``: every Unicode space, line breaks and the byte order mark."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenderloom.config import CANCELLED_MARKERS, COLUMN_WORDS, FIVE_PART, PREAMBLE, THREE_PART

#: The inside of a character class; Java's \s lacks the no-break spaces.
WS = r"\t\n\x0b\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
# Ligatures and their letters.
LIGATURES = (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st"))
#: A position code as a whole.
CODE = rf"^(?:{THREE_PART}|{FIVE_PART}|{PREAMBLE})\z"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim(c: Column | str) -> Column:
    return F.regexp_replace(as_column(c), rf"^[{WS}]+|[{WS}]+\z", "")


def folded(c: Column | str) -> Column:
    """Lower case, runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(as_column(c)), rf"[{WS}]+", " "))


def normalize_inline(c: Column | str) -> Column:
    """Ligatures spelled out, en and em dashes as hyphens, the low quotation mark as a straight one, zero-width characters dropped."""
    out = as_column(c)
    for a, b in LIGATURES:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.translate(out, "–—„​‌‍﻿", '--"')


def normalize_page(c: Column | str, headers: Column, strip_columns: bool = False) -> Column:
    """``normalize_inline``, every text of the array ``headers`` removed wherever it stands, price column labels too, trimmed."""
    out = F.aggregate(headers, normalize_inline(c), lambda t, h: F.replace(t, h, F.lit("")))
    if strip_columns:
        out = F.regexp_replace(out, rf"EUR[{WS}]+(?:PP|EP|SO|ST)[{WS}]+EUR", "")
        out = F.regexp_replace(out, rf"(?<![A-Za-z0-9_])\d+\.\d+[{WS}]+LO(?![A-Za-z0-9_])", "")
    return trim(out)


def page_key(c: Column | str) -> Column:
    """Runs of digits as one #, so lines that differ in a page number have one key."""
    return F.regexp_replace(as_column(c), r"\d+", "#")


def file_slug(c: Column | str) -> Column:
    """The base name without ``.pdf``, lower case, runs of other than a-z and 0-9 as a hyphen."""
    base = F.regexp_replace(F.regexp_extract(as_column(c), r"([^/]*)/*\z", 1), r"(?<=.)\.pdf\z", "")
    return F.regexp_replace(F.lower(base), "[^a-z0-9]+", "-")


def folder_name(c: Column | str) -> Column:
    """The name of a tender's output folder: as ``file_slug``, but only white space becomes hyphens."""
    base = F.regexp_replace(F.regexp_extract(as_column(c), r"([^/]*)/*\z", 1), r"(?<=.)\.pdf\z", "")
    return F.regexp_replace(F.lower(base), rf"[{WS}]+", "-")


def label_slug(c: Column | str, fallback: str = "") -> Column:
    """Lower case, runs of other than a-z and 0-9 as an underscore, none at either end, at most 48 characters."""
    out = F.substring(F.regexp_replace(F.regexp_replace(F.lower(as_column(c)), "[^a-z0-9]+", "_"), r"^_|_\z", ""), 1, 48)
    return F.when(out == "", F.lit(fallback)).otherwise(out) if fallback else out


def is_position(c: Column | str) -> Column:
    """Whether a text as a whole is a position code; false for null."""
    return F.coalesce(as_column(c).rlike(CODE), F.lit(False))


def count_positions(c: Column | str) -> Column:
    """Position codes anywhere in a text, three-part and five-part; parts of dates and addresses count, too."""
    return F.regexp_count(as_column(c), F.lit(THREE_PART)) + F.regexp_count(as_column(c), F.lit(FIVE_PART))


def count_preambles(c: Column | str) -> Column:
    return F.regexp_count(as_column(c), F.lit(PREAMBLE))


def has_column_labels(c: Column | str) -> Column:
    """Whether a text holds stranded labels of price columns."""
    return as_column(c).rlike(rf"EUR[{WS}]+(?:PP|EP|SO|ST)[{WS}]+EUR")


def is_column_noise(c: Column | str) -> Column:
    """Whether a line is nothing but labels of price columns."""
    words = "|".join(COLUMN_WORDS)
    return as_column(c).rlike(rf"^(?:{words})(?:[{WS}]+(?:{words}))*\z")


def is_cancelled(content: Column | str) -> Column:
    """Whether any line of a block is only a cancellation marker, perhaps behind a code."""
    quiet = rf"[{WS}\"'.!\-–—„“”]*"
    line = rf"(?iu)^(?:[A-Za-z]{{0,3}}[\d.]{{2,}}[{WS}]+)?[{WS}\"'.\-–—„“”]*(?:{'|'.join(CANCELLED_MARKERS)}){quiet}\z"
    return F.exists(F.split(as_column(content), "\n"), lambda x: trim(x).rlike(line))


def token_estimate(c: Column | str, per_token: int = 4) -> Column:
    return F.ceil(F.length(as_column(c)) / per_token)


def words(c: Column | str, longer_than: int) -> Column:
    """The lower-cased words of letters and digits that are longer than so many characters, in order, repeats included."""
    return F.filter(F.split(F.lower(as_column(c)), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > longer_than)


def plain_numbers(c: Column | str) -> Column:
    """The numbers of a text without their separators."""
    found = F.regexp_extract_all(as_column(c), F.lit(r"\d[\d.,]*"), 0)
    return F.transform(found, lambda n: F.regexp_replace(n, "[.,]", ""))


def number_tokens(c: Column | str) -> Column:
    """Runs of digits with separators and spaces within, spaces removed."""
    found = F.regexp_extract_all(as_column(c), F.lit(r"\d[\d., ]*\d|\d"), 0)
    return F.transform(found, lambda n: F.replace(n, F.lit(" "), F.lit("")))


def value_tokens(c: Column | str) -> Column:
    """Number tokens with at most one separator: measurements, not codes."""
    return F.filter(number_tokens(c), lambda n: F.length(F.translate(n, "0123456789", "")) <= 1)


def number_forms(n: Column) -> Column:
    """A number as written, with the other separator, and without any."""
    return F.array(n, F.replace(n, F.lit("."), F.lit(",")), F.replace(n, F.lit(","), F.lit(".")), F.regexp_replace(n, "[.,]", ""))


def clipped(c: Column | str, n: int = 700) -> Column:
    c = as_column(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("…"))).otherwise(c)


def language_code(c: Column | str) -> Column:
    """The first two letters, lower case; null for an empty text."""
    return F.nullif(F.substring(F.lower(as_column(c)), 1, 2), F.lit(""))


RANKS = {"confidence": ("low", "medium", "high"), "priority": ("optional", "should", "must")}


def rank(c: Column | str, of: str) -> Column:
    """1 to 3 by the order in RANKS; null for anything else."""
    c = as_column(c)
    out = F.when(c == RANKS[of][0], 1)
    for i, x in enumerate(RANKS[of][1:], 2):
        out = out.when(c == x, i)
    return out


def unrank(n: Column, of: str) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in RANKS[of]]), n)
