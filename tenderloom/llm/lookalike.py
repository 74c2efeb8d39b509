"""Visually identical text with different characters: one canonical form per class.

Each value is mapped look-alike by look-alike onto one spelling and grouped
under the accent- and case-sensitive Unicode collation, which sees through
composed and decomposed accents and ignores characters without ink or width.
The least member of a class by code point is its canonical form and is joined
back. The mapping is one ``translate`` and a few ``replace`` calls, so all of
it runs in the JVM.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom.operators.latest import latest
from tenderloom.runtime import Cut

# Letters of other scripts that look like a Latin letter, in the order of the second line.
CYRILLIC, CYRILLIC_AS = "АВЕЅІЈКМНОРСТХҮԌԚԜаеѕіјорсухһԁԛԝѵӏѐёїӓӧҐ", "ABESIJKMHOPCTXYGQWaesijopcyxhdqwvlèëïäöҐ"
GREEK, GREEK_AS = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳονϲ", "ABEZHIKMNOPTYXCjovc"
ARMENIAN, ARMENIAN_AS = "ՕօոսհցզՏՍԼ", "OonuhgqSUL"
CHEROKEE, CHEROKEE_AS = "ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᏀᏃᏏᏒᏔᏙᏚᏞᏟᏢᏦᏴ", "DRTiAJEWMHGZbRWVSLCPKB"
LISU, LISU_AS = "ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"
OTHER, OTHER_AS = "ıɑɡ‐‑·∙⋅", "iag--···"
# Extended Arabic-Indic digits that look like the Arabic-Indic ones; four, five and six don't.
DIGITS, DIGITS_AS = "۰۱۲۳۷۸۹", "٠١٢٣٧٨٩"
#: Invisible characters that the collation weighs, or that could stand inside a base and its accent.
UNSEEN = "­͏؜ᅟᅠ឴឵᠎​‌‍‎‏⁠⁡⁢⁣⁤ㅤ﻿ﾠ"


@cache
def tables() -> tuple[str, str, str, tuple[tuple[str, str], ...]]:
    """(from, to, dropped, replacements) of the mapping.

    Besides the fixed values above, by rule: every space separator and the tab
    is a space, every other line or paragraph separator a line feed;
    wide, narrow, font and no-break variants are their plain character, and so
    are compatibility ligatures of letters and Roman numerals, which are written
    like letters; format characters, variation
    selectors and C0/C1 controls other than tab and line breaks are dropped.
    Superscripts, subscripts, fractions and circled forms look different and
    stay.
    """
    one, many, gone = {}, {}, dict.fromkeys(UNSEEN)
    for code in range(sys.maxunicode + 1):
        if 0xD800 <= code < 0xE000:
            continue
        c = chr(code)
        kind = unicodedata.category(c)
        if kind == "Zs" and c != " ":
            one[c] = " "
        elif kind == "Cf" or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF or (kind == "Cc" and c not in "\t\n\r\x0b\x0c\x85"):
            gone[c] = None
        elif d := unicodedata.decomposition(c):
            tag, _, rest = d.partition(" ")
            to = unicodedata.normalize("NFKC", c) if tag in ("<wide>", "<narrow>", "<font>", "<noBreak>") else ""
            if tag == "<compat>" and (kind == "Nl" or kind in ("Ll", "Lu", "Lt") and len(rest.split()) > 1):
                to = unicodedata.normalize("NFKC", c)
            if len(to) == 1:
                one[c] = to
            elif to:
                many[c] = to
    one |= {"\t": " "} | dict.fromkeys("\x0b\x0c\x85\u2028\u2029", "\n")
    one |= dict(zip(CYRILLIC + GREEK + ARMENIAN + CHEROKEE + LISU + OTHER + DIGITS, CYRILLIC_AS + GREEK_AS + ARMENIAN_AS + CHEROKEE_AS + LISU_AS + OTHER_AS + DIGITS_AS, strict=True))
    one = {a: one.get(b, b) for a, b in one.items() if a not in gone and a != one.get(b, b)}
    return "".join(one), "".join(one.values()), "".join(gone), tuple(many.items())


def mapped(text: Column) -> Column:
    """Column: ``text`` with look-alikes in one spelling, invisible characters dropped and line breaks as LF."""
    source, target, gone, many = tables()
    out = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in many])
    joined = F.length(F.translate(text, "".join(a for a, _ in many), "")) < F.length(text)
    out = F.when(joined, F.aggregate(pairs, out, lambda t, x: F.replace(t, x["a"], x["b"]))).otherwise(out)
    return F.translate(out, source + gone, target)


def digits(text: Column) -> Column:
    """Column: a hash of the digits and other number signs of a mapped text, in order.

    The collation equates digits of one value in all scripts, which a reader
    tells apart, so they are compared by code point beside it.
    """
    return F.xxhash64(F.regexp_replace(text, r"\P{N}+", ""))


def outline(text: Column) -> Column:
    """Column: a hash that equal forms have in common: the ASCII digits and signs of a mapped text, without letters, all beyond ASCII and ``; < = >``, which collation may equate.

    ASCII digits may stay, since equal forms have the same ``digits`` and the
    collation keeps their order among the signs.
    """
    return F.xxhash64(F.regexp_replace(text, r"[^\x20-\x3a?@\n]+", ""))


def classes(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """(digest, canonical, n_forms): the canonical member of each class of two or more distinct values, for each of its members.

    ``rows`` has the ``digest`` of each value and the ``outline`` of its mapped
    form, ``texts`` the digest and the ``value`` itself, repeats allowed. Only
    values whose outline another one shares are looked up and collated, once
    each, so a text in a third of all rows is one row; all others are alone in
    their class. Values are of one class if their mapped forms are equal under
    the collation and have the same digits. Nulls are left out.
    """
    once = rows.filter("digest is not null").select("digest", "outline").distinct()
    shared = once.groupBy("outline").agg(F.count("*").alias("_n")).filter("_n > 1").select("outline")
    able = texts.join(once.join(shared, "outline").select("digest"), "digest", "left_semi").groupBy("digest").agg(F.min("value").alias("value"))
    able = able.withColumn("_mapped", mapped(F.col("value"))).select("digest", "value", F.collate("_mapped", "UNICODE").alias("_form"), digits(F.col("_mapped")).alias("_digits"))
    forms = able.groupBy("_form", "_digits").agg(F.min("value").alias("canonical"), F.count("*").alias("n_forms")).filter("n_forms > 1")
    return able.select("digest", "_form", "_digits").join(forms, ["_form", "_digits"]).select("canonical", "n_forms", "digest")


def _digested(chunks: DataFrame) -> DataFrame:
    """(chunk_id, digest, outline) of the valid row of each chunk; texts themselves are not moved."""
    rows = chunks.select("chunk_id", "loaded_at", F.md5("content").alias("digest"), outline(mapped(F.col("content"))).alias("outline"))
    return Cut(latest(rows, "chunk_id", ["loaded_at"], ["chunk_id", "digest", "outline"]), "digests").df


def _texts(chunks: DataFrame) -> DataFrame:
    return chunks.filter("content is not null").select(F.md5("content").alias("digest"), F.col("content").alias("value"))


def canonical_chunks(chunks: DataFrame) -> DataFrame:
    """(chunk_id, content, digest, canonical, n_forms): every chunk with the one form of its content.

    A redelivered ``chunk_id`` counts once (of rows tied on ``loaded_at`` that
    of the greatest digest). ``n_forms`` is the number of different spellings of
    the class. Null contents have a null form; the empty text has the form of
    texts without any visible character.
    """
    once = _digested(chunks)
    texts = _texts(chunks)
    whole = texts.groupBy("digest").agg(F.min("value").alias("content"))
    found = once.select("chunk_id", "digest").join(whole, "digest", "left").join(classes(once, texts), "digest", "left")
    return found.select("chunk_id", "content", "digest", F.coalesce("canonical", "content").alias("canonical"), F.when(F.col("content").isNotNull(), F.coalesce("n_forms", F.lit(1))).alias("n_forms"))


def same_to_a_reader(chunks: DataFrame) -> DataFrame:
    """(a_chunk_id, b_chunk_id), smaller first: chunks whose contents differ as stored but have one canonical form."""
    once = _digested(chunks)
    able = once.select("chunk_id", "digest").join(classes(once, _texts(chunks)).select("digest", F.md5("canonical").alias("form")), "digest")
    a = able.select(F.col("chunk_id").alias("a_chunk_id"), F.col("digest").alias("a_digest"), "form")
    b = able.select(F.col("chunk_id").alias("b_chunk_id"), F.col("digest").alias("b_digest"), "form")
    return a.join(b, "form").filter("a_chunk_id < b_chunk_id and a_digest <> b_digest").select("a_chunk_id", "b_chunk_id")
