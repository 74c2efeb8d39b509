import io
import json
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tenderloom.functions import text as T
from tenderloom.operators import consolidate as C
from tenderloom.operators import evaluate, extract, grounding, layout, link, nested, order, profile, provider, segment, tree
from tenderloom.operators.latest import latest
from tenderloom.plans import pipeline
from tenderloom.sources import glyphs, store

SF = "/root/testdata/sf0.001"


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()] if columns else [tuple(r) for r in df.collect()]


def one(spark, column, **given):
    return spark.createDataFrame([Row(**given)]).select(column.alias("x")).first()["x"]


# Nested records.
TREES = "tree_id string, tree_json string, produced_at timestamp, loaded_at timestamp, path string, link string"


def trees(spark, *texts):
    from datetime import datetime

    return spark.createDataFrame([(f"t{i}", t, datetime(2024, 1, 1), datetime(2024, 1, 1), "clash", "clash") for i, t in enumerate(texts)], TREES)


def test_links_of_nested_records(spark):
    text = json.dumps({"deliverableArray": [{"procurementDocumentChunkIdArray": ["a", None, "b"]}, None, {"deliverableArray": {"procurementDocumentChunkIdArray": "c"}}, "plain"], "procurementDocumentChunkIdArray": [7]})
    df = trees(spark, text, None, "", "{", "null", "NaN", "[1]", '{"deliverableArray": null}')
    got = {r[1:] for r in values(nested.tree_links(df))}
    assert got == {("r", "deliverable", 0, "r.0"), ("r", "deliverable", 2, "r.2"), ("r", "deliverable", 3, "r.3"), ("r", "chunk", 0, "7"), ("r.0", "chunk", 0, "a"), ("r.0", "chunk", 2, "b"), ("r.2", "deliverable", 0, "r.2.0"), ("r.2.0", "chunk", 0, "c")}
    nodes = nested.tree_nodes(df)
    assert nodes.filter("tree_id = 't0'").count() == 5
    assert nodes.filter(nested.parent_of(F.col("path")).isNotNull() & (nested.parent_of(F.col("path")) != F.col("parent_path"))).count() == 0
    assert dict(values(nested.subtree_sizes(nodes.filter("tree_id = 't0'")), "path", "n_leaves"))["r"] == 3


def test_redelivered_and_empty_trees(spark):
    df = trees(spark, '{"deliverableArray": [{}]}')
    assert nested.tree_links(df.unionByName(df)).count() == 1
    assert nested.tree_links(df.limit(0)).count() == 0


def test_deep_and_odd_json(spark):
    deep = '{"deliverableArray":[' * 3000 + "{}" + "]}" * 3000
    assert nested.tree_links(trees(spark, deep)).count() == 3000
    assert nested.tree_links(trees(spark, '{"procurementDocumentChunkIdArray": ["\\ud800"]}')).count() == 1


@pytest.mark.parametrize("text", ['{"a": [1, {"b": null}], "c": "x\\n"}', "[]", "{}", " 1 ", '"s"', "[[[]]]"])
def test_deep_parser_agrees(text):
    assert nested._parse_deep(text) == json.loads(text)


@pytest.mark.parametrize("text", ["[1,", "{1:2}", "[1 2]", '{"a" 1}', "[1]]", "", "[NaN]", '{"a":}', "[,]"])
def test_deep_parser_refuses(text):
    with pytest.raises(ValueError):
        nested._parse_deep(text)


# Keys and numbering.
def test_latest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", None, "z"), ("b", None, None), (None, 5, "n"), ("a", 2, "y")], "k string, t int, v string")
    assert sorted(values(latest(df, "k", ["t"], ["k", "v"]))) == [("a", "y"), ("b", None)]
    assert latest(df.limit(0), "k", ["t"], ["k", "v"]).count() == 0


def test_numbered_and_running(spark):
    rng = random.Random(1)
    rows = [(f"g{rng.randrange(3)}", rng.randrange(5), i, rng.random() < 0.3) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, page int, i int, flag boolean")
    got = {r["i"]: (r["n"], r["s"], r["last"]) for r in order.running(order.numbered(df, ["g"], ["page"], ["i"], "n"), ["g"], ["page"], ["i"], F.col("flag"), F.when(F.col("flag"), F.col("i")), ("s", "last")).collect()}
    for g in {r[0] for r in rows}:
        s, last = 0, None
        for n, (_, _, i, flag) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))):
            s, last = s + flag, i if flag else last
            assert got[i] == (n, s, last)


# Text functions.
@pytest.mark.parametrize(("text", "want"), [("oﬃce", "office"), ("ﬅ", "st"), ("a–b—c", "a-b-c"), ("„x“", '"x“'), ("’", "’"), ("a​b", "ab"), ("", "")])
def test_normalize_inline(spark, text, want):
    assert one(spark, T.normalize_inline("t"), t=text) == want


def test_names(spark):
    assert one(spark, T.file_slug("t"), t="in/LV_Fahrrad (1).pdf") == "lv-fahrrad-1-"
    assert one(spark, T.folder_name("t"), t="A b.PDF") == "a-b.pdf"
    assert one(spark, T.label_slug("t", "general"), t="Über") == "ber"
    assert one(spark, T.label_slug("t", "general"), t="§§") == "general"
    assert one(spark, T.normalize_page("t", F.array(F.lit("HEAD")), True), t="HEAD x EUR PP EUR 01.02 LO y ") == "x   y"


def test_positions(spark):
    df = spark.createDataFrame([("01.01.0010",), ("GU.07.09.01.01",), ("00.00.00.09.01",), ("x01.01.0010",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(T.is_position("t")).collect()] == [True, True, True, False, False, False]
    assert one(spark, T.count_positions("t"), t="a 01.01.0010 12.05.2026") == 2


# Profile.
@pytest.mark.parametrize(("n", "want"), [(30, [*range(1, 31)]), (31, [*range(1, 26), *range(27, 32)]), (400, [*range(1, 6), *(6 + 13 * k for k in range(30)), *range(396, 401)]), (700, [*range(1, 6), *(6 + 13 * k for k in range(50)), *range(696, 701)])])
def test_page_sample(spark, n, want):
    df = spark.range(1, n + 1).select(F.lit("d").alias("doc_id"), F.col("id").cast("int").alias("page"))
    assert sorted(r[1] for r in values(profile.page_sample(df))) == want


def test_strategy(spark):
    df = spark.createDataFrame([(5, 10), (6, 10), (5, 11), (6, 11)], "p int, v int")
    assert [r[0] for r in df.select(profile.strategy(F.col("p"), F.col("v"))).collect()] == ["section-list", "lv-position", "vorbemerkungen-heavy", "mixed"]


def test_profile_of_nothing(spark):
    pages = spark.createDataFrame([("d", 1, None)], "doc_id string, page int, text string")
    r = profile.profile(pages).first()
    assert (r["ligature_rate"], r["strategy"], r["parser_confidence"]) == (0.0, "section-list", "high")
    assert profile.profile(pages.limit(0)).count() == 0


def test_page_text(spark):
    items = spark.createDataFrame([("d", 1, 2, "b", True), ("d", 1, 1, "a", False), ("d", 1, 3, None, False), ("d", 1, 4, " ", True)], "doc_id string, page int, ord int, str string, has_eol boolean")
    assert values(profile.page_text(items), "text") == [("a b",)]


# Layout.
def test_banding_is_anchored(spark):
    rows = [("d", 1, 0, "a", 0.0, 100.0, 5.0, 10.0), ("d", 1, 1, "b", 10.0, 97.0, 5.0, 10.0), ("d", 1, 2, "c", 0.0, 94.0, 5.0, 10.0), ("d", 1, 3, "", 0.0, 94.0, 5.0, 10.0), ("d", 1, 4, "d", 5.5, 94.0, 5.0, 10.0)]
    df = spark.createDataFrame(rows, "doc_id string, page int, ord int, str string, x double, y double, width double, size double")
    assert sorted(values(layout.lines(df), "line_no", "text", "x", "y", "width")) == [(0, "a b", 0.0, 100.0, 15.0), (1, "cd", 0.0, 94.0, 10.5)]


def test_banding_against_brute_force(spark):
    rng = random.Random(5)
    rows = [("d", p, i, chr(97 + i % 26), float(rng.randrange(0, 200, 7)), float(rng.randrange(0, 60)), 6.0, rng.choice([8.0, 10.0, 12.0])) for p in range(30) for i in range(rng.randrange(1, 25))]
    df = spark.createDataFrame(rows, "doc_id string, page int, ord int, str string, x double, y double, width double, size double")
    want = []
    for p in range(30):
        g = sorted((r for r in rows if r[1] == p), key=lambda r: (-r[5], r[4], r[2]))
        sizes = sorted(r[7] for r in g)
        tolerance, bands = sizes[len(sizes) // 2] * 0.5, []
        for r in g:
            if not bands or abs(r[5] - bands[-1][0][5]) > tolerance:
                bands.append([])
            bands[-1].append(r)
        for n, band in enumerate(bands):
            text, right = "", None
            for r in sorted(band, key=lambda r: (r[4], r[2])):
                text += (" " if right is not None and r[4] - right > r[7] * 0.25 else "") + r[3]
                right = r[4] + r[6]
            want.append((p, n, text))
    assert sorted(values(layout.lines(df), "page", "line_no", "text")) == sorted(want)


# Segmentation.
LABELS = [
    ("01.01.0010 Fahrradgaragen im Baukastensystem", "item", "01.01.0010", "lv-position", "01.01.0010", None), ("GU.07.09.01.01 Tisch", "item", "GU.07.09.01.01", "lv-position", "GU.07.09.01.01", "09"),
    ("00.00.00.09.01 Allgemeines", "item", "00.00.00.09.01", "vorbemerkungen", None, "09"), ("00.00.00.00.01 Allgemeines", "item", "00.00.00.00.01", "vorbemerkungen", None, None), ("12.05.2026 Abgabefrist", "item", "12.05.2026", "lv-position", "12.05.2026", None),
    ("01.01.0060 ANTIGRAFFITI", "heading", None, None, None, None), ("02.02 Buchungsplattform", "heading", None, None, None, None), ("02.02 Buchungsplattform 4", "item", "02.02", None, None, None), ("PAYMENT", "heading", None, None, None, None),
    ("CONTRACTOR DETAILS:", "body", None, None, None, None), ("10) Check anchors", "item", "10", None, None, None), ("a) text", "item", "a", None, None, None), ("• text", "item", "•", None, None, None),
]


def line_rows(spark, *texts):
    return spark.createDataFrame([("d.pdf", 1 + i // 4, i, t, 10.0, "x", "y") for i, t in enumerate(texts)], "doc_id string, page int, line_no int, text string, font_size double, key string, label string")


def test_line_labels(spark):
    df = line_rows(spark, *[x[0] for x in LABELS])
    got = sorted(values(segment.classified(df), "line_no", "text", "kind", "label", "code.region", "code.lv_position", "code.category_code"))
    assert [g[1:] for g in got] == LABELS


def test_larger_font_is_heading(spark):
    df = line_rows(spark, "a", "b", "c").withColumn("font_size", F.when(F.col("line_no") == 1, 12.0).otherwise(10.0))
    assert dict(values(segment.classified(df), "text", "kind")) == {"a": "body", "b": "heading", "c": "body"}


def test_segments(spark):
    df = line_rows(spark, "body one", "HEAD ONE", "body two", "1) item", "body three", "HEAD TWO", "2) other", "HEAD THREE")
    got = sorted(values(segment.segments(df), "segment", "page", "heading", "label", "content"))
    assert [g[1:] for g in got] == [(1, "General Requirements", "sec", "General Requirements\nbody one"), (1, "HEAD ONE", "sec", "HEAD ONE\nbody two"), (1, "HEAD ONE", "1", "1) item\nbody three"), (2, "HEAD TWO", "2", "2) other")]
    assert [r[0] for r in sorted(values(segment.chunks(segment.segments(df)), "chunk_id"))] == ["d__section_1__i2", "d__section_2__i3", "d__section_sec__i0", "d__section_sec__i1"]
    assert segment.segments(df.limit(0)).count() == 0


def test_segments_against_state_machine(spark):
    rng = random.Random(3)
    pool = ["body text here", "more body", "HEAD ALPHA", "HEAD BETA", "1) item", "01.01.0010 Tisch", "b) point", "03.04 Gruppe"]
    docs = {f"d{k}.pdf": [(1 + i // 6, i, rng.choice(pool)) for i in range(rng.randrange(1, 40))] for k in range(40)}
    df = spark.createDataFrame([(d, p, i, t, 10.0) for d, rows in docs.items() for p, i, t in rows], "doc_id string, page int, line_no int, text string, font_size double")
    want = []
    for d, rows in docs.items():
        heading, lines, kind, page = "General Requirements", [], None, None

        def flush(d=d):
            if kind == "item":
                want.append((d, page, heading, "\n".join(lines)))
            elif lines:
                want.append((d, page, heading, "\n".join([heading, *lines])))

        for p, _, t in rows:
            k = "heading" if t.startswith("HEAD") or t.startswith("03.04") else "item" if t[0] in "10b" and t != "body text here" else "body"
            if k == "body":
                if kind != "item" and not lines:
                    page = p
                lines.append(t)
            else:
                flush()
                lines, kind = ([t], "item") if k == "item" else ([], None)
                page, heading = p, t if k == "heading" else heading
        flush()
    assert sorted(values(segment.segments(df, share=2.0), "doc_id", "page", "heading", "content")) == sorted(want)


def test_cancelled_and_budget(spark):
    for text, gone in [("01.01.0020 Entfällt.", True), ("- N/A -", True), ("Diese Position entfällt ersatzlos", False), ("supprimé", False), ("a\nomitted", True), ("", False)]:
        assert one(spark, T.is_cancelled("t"), t=text) is gone
    text = "\n".join("x" * n for n in (30, 30, 30, 90, 10))
    assert one(spark, segment.split_to_budget(F.col("t"), 16), t=text) == ["x" * 30 + "\n" + "x" * 30, "x" * 30, "x" * 90, "x" * 10]
    assert one(spark, segment.split_to_budget(F.col("t"), 16), t="") == [""]


# Extraction.
GOOD = {"bullet_point": "abc", "description_en": "defgh", "priority": "must", "confidence": "high", "equivalence_allowed": None}


def test_validation(spark):
    bad = [{k: v for k, v in GOOD.items() if k != "equivalence_allowed"}, GOOD | {"bullet_point": "ab"}, GOOD | {"priority": "high"}, GOOD | {"standards": None}, GOOD | {"standards": ["a", None]}, GOOD | {"standards": "EN"}, GOOD | {"bullet_point": 1234}, GOOD | {"description_de": 1}, GOOD | {"equivalence_allowed": "yes"}]
    good = [GOOD, GOOD | {"equivalence_allowed": True, "standards": ["EN 1"], "description_de": None, "source_language": "DE-at"}, GOOD | {"standards": []}]
    rows = [("c", i, json.dumps(x)) for i, x in enumerate(good + bad)] + [("c", 90, "{"), ("c", 91, None), ("c", 92, "[]")]
    df = spark.createDataFrame(rows, "chunk_id string, item_ord int, item_json string")
    got = extract.validated(df)
    assert sorted(r[0] for r in values(got, "item_ord")) == [0, 1, 2]
    chunks = spark.createDataFrame([("c", "f", 1, None, "09", None)], "chunk_id string, source_file string, page_number int, section_heading string, category_code string, lv_position string")
    assert sorted(values(extract.enriched(got, chunks), "item_ord", "category_code", "source_language")) == [(0, "09", None), (1, "09", "de"), (2, "09", None)]


def test_gleaning_and_halves(spark):
    first = spark.createDataFrame([("c", "A b")], "chunk_id string, bullet_point string")
    more = spark.createDataFrame([("c", " a B "), ("c", "new"), ("c", "new"), ("x", "a b"), ("c", None)], "chunk_id string, bullet_point string")
    assert sorted(values(extract.gleaned_new(more, first), "chunk_id", "bullet_point"), key=str) == sorted([("c", "new"), ("c", "new"), ("x", "a b"), ("c", None)], key=str)
    assert one(spark, extract.halves(F.col("t")), t="a\nb\nc") == ["a\nb", "c"]
    assert one(spark, extract.halves(F.col("t")), t="a b c") == ["a b", "c"]
    assert one(spark, extract.halves(F.col("t")), t="abc") == ["ab", "c"]


# Consolidation.
def unit(chunk, item, category, section, bullet, text, n):
    return ("f", chunk, section, bullet, text, None, "must", None, "high", [], [], [], category, item, "de", n)


UNIT = "source_file string, chunk_id string, section_heading string, bullet_point string, description_en string, description_de string, priority string, equivalence_allowed boolean, confidence string, standards array<string>, referenced_annexes array<string>, cross_referenced_positions array<string>, category_code string, item_number string, source_language string, ext_ord int"


def test_identity_rules(spark):
    rows = [
        unit("c1", "01.01.0010", None, "S", "Supply X", "long text", 0), unit("c2", "01.01.0010", None, "S", "X details", "text", 1), unit("c3", None, None, "S", "Same  Thing", "t1", 2), unit("c4", None, None, "S", "same thing", "t2", 3),
        unit("c5", None, None, "T", "same thing", "t3", 4), unit("c6", "01.01.0020", None, "S", "a", "t", 5), unit("c6", "01.01.0020", None, "S", "b", "t", 6), unit("c7", "GU.01.08.01.01", "08", "R", "cab", "identical spec", 7), unit("c8", "GU.02.08.01.01", "08", "R", "cab", "identical spec", 8),
    ]
    got = {r["id"]: (r["merge_record"]["rule"], r["source_chunk_ids"]) for r in C.consolidate(spark.createDataFrame(rows, UNIT).withColumn("id", F.lit("clash"))).collect()}
    assert got == {"c1#0": ("lv-position-match", ["c1", "c2"]), "c3#0": ("staging-dedup", ["c3", "c4"]), "c5#0": ("standalone", ["c5"]), "c6#0": ("lv-position-match", ["c6"]), "c7#0": ("staging-dedup", ["c7", "c8"])}


def test_category_stage(spark):
    rows = [unit("s", None, "09", "S", "spec", "spec text", 0), unit("p1", "GU.01.09.01.01", "09", "R", "place", "x", 1), unit("p2", "GU.02.09.01.01", "09", "R", "place", "y", 2), unit("p1", None, None, "R", "other", "z", 3)]
    got = C.consolidate(spark.createDataFrame(rows, UNIT)).collect()
    assert [(r["id"], r["source_chunk_ids"], r["merge_record"]["rule"]) for r in got] == [("s#0", ["s", "p1", "p2"], "vorbemerkungen-category")]
    assert C.consolidate(spark.createDataFrame([], UNIT)).count() == 0


def test_identity_groups_against_union_find(spark):
    rng = random.Random(9)
    rows = [unit(f"c{i:03}", rng.choice([None, None, f"01.01.{rng.randrange(20):04}"]), rng.choice([None, "", "08", "09"]), rng.choice(["S", "T"]), f"b{rng.randrange(25)}", f"t{rng.randrange(25)}", i) for i in range(150)]
    units = C.units(spark.createDataFrame(rows, UNIT))
    root = {r[1] + "#0": r[1] + "#0" for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    seen = {}
    for key, k in values(C.identity_keys(units), "unit_key", "key"):
        a, b = find(key), find(seen.setdefault(k, key))
        root[max(a, b)] = min(a, b)
    assert dict(values(C.identity_groups(units), "unit_key", "id")) == {x: find(x) for x in root}


def test_join_descriptions(spark):
    parts = ["supply steel garage 2,50", "steel garage supply", "steel garage supply 60", None, "  ", "Supply  steel garage 2,50", "other thing entirely"]
    assert one(spark, C.joined_descriptions(F.col("t")), t=parts) == "\n\n".join(parts[i] for i in (0, 2, 6))
    assert spark.createDataFrame([([None],)], "t array<string>").select(C.joined_descriptions(F.col("t"))).first()[0] is None


def test_join_descriptions_against_brute_force(spark):
    rng = random.Random(4)
    words = ["steel", "garage", "supply", "a", "of", "12", "3,5", "60", "mounting", "plate."]
    cases = [[None if rng.random() < 0.1 else " ".join(rng.choices(words, k=rng.randrange(0, 6))) for _ in range(rng.randrange(1, 8))] for _ in range(200)]

    def brute(parts):
        kept, seen, tokens, numbers = [], set(), set(), set()
        for v in parts:
            key = " ".join(v.lower().split()) if v else ""
            if not key or key in seen:
                continue
            t = [w for w in re.split(r"[^\w]+", v.lower()) if len(w) > 3]
            n = [re.sub("[.,]", "", x) for x in re.findall(r"\d[\d.,]*", v)]
            if kept and (not t or sum(w in tokens for w in t) / len(t) >= 0.85) and all(x in numbers for x in n):
                continue
            kept.append(v.strip())
            seen.add(key)
            tokens |= set(t)
            numbers |= set(n)
        return "\n\n".join(kept) or None

    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t array<string>")
    got = dict(values(df.select("i", C.joined_descriptions(F.col("t")).alias("x"))))
    assert got == {i: brute(c) for i, c in enumerate(cases)}


def test_cross_references(spark):
    rows = [unit("c1", "01.01.0010", None, "S", "one", "text one", 0), unit("c2", None, None, "S", "two", "text two", 1)]
    df = spark.createDataFrame(rows, UNIT).withColumn("cross_referenced_positions", F.array(F.lit("01.01.0010"), F.lit("99.99.999"), F.lit(None).cast("string")))
    got = {r["id"]: [(e["chunk_id"], e["evidence_role"]) for e in r["merge_record"]["evidence_links"]] for r in C.consolidate(df).collect()}
    assert got == {"c1#0": [("c1", "general_spec")], "c2#0": [("c2", "general_spec"), ("c1", "cross_reference")]}


# Linking.
REQ = "source_file string, id string, source_chunk_ids array<string>, merge_record struct<rule:string,merge_confidence:string,evidence_links:array<struct<chunk_id:string,evidence_role:string>>,why_merged:string>, bullet_point string, description_en string, description_de string, priority string, equivalence_allowed boolean, confidence string, standards array<string>, referenced_annexes array<string>, category_code string, section_heading string, item_number string, source_language string, req_order int"


def req(id_, order_, item=None, title="t", text="x", de=None, priority="must", confidence="high", category=None, section=None, lang="de"):
    return ("f", id_, [f"c_{id_}"], ("standalone", "high", [(f"c_{id_}", "general_spec")], "w"), title, text, de, priority, None, confidence, [], [], category, section, item, lang, order_)


class Short:
    """Lists the words of a message, but is cut off beyond two; fails at ``bad``."""

    def reply(self, system, message):
        words = message.split("\n\n", 1)[-1].split()
        if len(words) > 2:
            raise provider.Truncated
        return None if "bad" in words else json.dumps({"extractions": [{"bullet_point": w} for w in words]})


def test_truncated_replies_are_asked_for_in_halves(spark):
    chunks = spark.createDataFrame([("a/0", "r", "one two\nthree four\nfive six seven"), ("b", "r", "x"), ("c", "r", "bad y z")], "chunk_id string, document_region string, content string")
    chunks = chunks.selectExpr("*", *[f"cast(null as string) as {c}" for c in ("lv_position", "category_code", "section_heading")])
    items, failures = pipeline.ask_chunks(chunks, Short())
    got = sorted((c, n, json.loads(j)["bullet_point"]) for c, n, j in values(items, "chunk_id", "item_ord", "item_json"))
    assert got == [("a/0", n, w) for n, w in enumerate("one two three four five six seven".split())] + [("b", 0, "x"), ("c", 0, "z")]
    assert values(failures, "chunk_id", "parts", "failed") == [("c", 2, 1)]


def test_a_reply_cut_off_is_told_before_it_is_parsed(monkeypatch):
    monkeypatch.setenv("KEY_OF_TEST", "k")
    monkeypatch.setattr(provider.urllib.request, "urlopen", lambda *a, **k: io.BytesIO(json.dumps({"choices": [{"finish_reason": "length", "message": {"content": '{"extr'}}]}).encode()))
    with pytest.raises(provider.Truncated):
        provider.HttpProvider("http://localhost", "m", "KEY_OF_TEST").reply("", "m")


def test_guarded_union_of_positions_with_one_code(spark):
    sides = [("O1", "01.01.0010"), ("O2", "01.01.0010"), ("O3", "02.02.0020"), ("N1", None), ("N2", None), ("N3", None)]
    reqs = spark.createDataFrame([("f", i, code) for i, code in sides], "source_file string, id string, item_number string")
    pairs = [("N1", "O1"), ("N1", "O3"), ("N1", "O2"), ("N2", "O3"), ("O2", "N3")]
    ranked = spark.createDataFrame([("f", a, b, n) for n, (a, b) in enumerate(pairs)], "source_file string, a_id string, b_id string, rank int")
    verdicts = spark.createDataFrame([(b, a, " Same ") for a, b in pairs], "a_id string, b_id string, relation string")
    got = values(link.united(ranked, verdicts, reqs), "id", "position_id")
    assert sorted(got) == [("N1", "O1"), ("N2", "O3"), ("N3", "O1"), ("O1", "O1"), ("O2", "O1"), ("O3", "O3")]
    assert link.united(ranked, verdicts.limit(0), reqs).count() == 0


def test_guarded_link(spark):
    reqs = spark.createDataFrame([req("O1", 0, "01.01.0010"), req("O2", 1, "01.01.0020"), req("N1", 2, confidence="low"), req("N2", 3, priority="optional"), req("N3", 4)], REQ)
    ranked = spark.createDataFrame([("f", "O1", "N1", 1), ("f", "O2", "N1", 2), ("f", "O1", "N2", 3), ("f", "O2", "N2", 4)], "source_file string, a_id string, b_id string, rank int")
    verdicts = spark.createDataFrame([("N1", "O1", " Same"), ("N1", "O2", "same"), ("O1", "N2", "same"), ("N2", "O2", "distinct"), ("N2", "N2", None)], "a_id string, b_id string, relation string")
    links = link.linked(ranked, verdicts, reqs)
    assert sorted(values(links, "id", "position_id")) == [("N1", "O1"), ("N2", "O1")]
    got = {r["id"]: (r["n_members"], r["item_number"], r["confidence"], r["priority"], r["source_chunk_ids"]) for r in link.merge_linked(reqs, links).collect()}
    assert got["N1"] == (3, "01.01.0010", "low", "must", ["c_O1", "c_N1", "c_N2"]) and set(got) == {"N1", "O2", "N3"}


def test_candidates_against_brute_force(spark):
    rng = random.Random(2)
    words = [f"word{i}" for i in range(12)]
    rows = [req(f"r{i:02}", i, rng.choice([None, f"01.01.{i:04}"]), " ".join(rng.choices(words, k=rng.randrange(0, 4))), " ".join(rng.choices(words, k=rng.randrange(0, 6))), category=rng.choice([None, "08"])) for i in range(60)]
    df = spark.createDataFrame(rows, REQ)
    for cfg in (link.Linking(), link.Linking(full_pairwise=10)):
        tokens = {r[1]: {w for w in f"{r[4]} {r[5]}".split() if len(w) > 2} for r in rows}
        want = set()
        for i, a in enumerate(rows):
            for b in rows[i + 1 :]:
                if (a[14] is None) != (b[14] is None) and tokens[a[1]] and tokens[b[1]] and (cfg.full_pairwise == 300 or a[12] == b[12]):
                    s = len(tokens[a[1]] & tokens[b[1]]) / min(len(tokens[a[1]]), len(tokens[b[1]]))
                    if s >= 0.5:
                        want.add((a[1], b[1], round(s, 6)))
        got = link.candidates(df, cfg)
        assert {(a, b, round(s, 6)) for a, b, s in values(got, "a_id", "b_id", "score")} == want
        top = link.top_candidates(got, df, cfg).collect()
        assert max(r["in_block"] for r in top) <= 25 and sorted(r["rank"] for r in top) == list(range(1, len(top) + 1))


# Grounding.
@pytest.mark.parametrize(("source", "text", "missing"), [("Länge 2,50m", "length 2.50m", 0), ("250 mm", "2.50 m", 0), ("25 bis 65mm", "25 to 65 mm", 0), ("25 bis 65mm", "widths 25, 65", 1), ("", "1.234,56 EUR", 0), ("", "no digits", 0), ("2 Stück", "3 pieces", 1), ("", None, 0)])
def test_grounding(spark, source, text, missing):
    reqs = spark.createDataFrame([req("r", 0, text=text)], REQ).withColumn("source_chunk_ids", F.array(F.lit("c"), F.lit("gone"), F.lit(None).cast("string")))
    chunks = spark.createDataFrame([("c", source, None, None)], "chunk_id string, content string, section_heading string, lv_position string")
    r = grounding.grounded(reqs, chunks).first()
    assert (r["n_ungrounded"], r["confidence"]) == (missing, "low" if missing else "high")


# Trees.
def test_tree(spark):
    reqs = spark.createDataFrame([req("a", 0, section="S 1", de="Deutsch"), req("b", 1, section="s-1", lang="en"), req("c", 2, category="09"), req("d", 3, lang=None)], REQ).withColumn("l1_key", F.lit("clash"))
    groups = tree.fallback_groups(reqs)
    assert sorted(values(groups, "id", "l2_key", "l2_label")) == [("a", "s_1", "S 1"), ("b", "s_1", "S 1"), ("c", "category_09", "Category 09"), ("d", "general", "General")]
    nodes = tree.tree_nodes(reqs, groups)
    assert sorted(r[0] for r in values(nodes, "path")) == ["r", "r.0", "r.0.0", "r.0.0.0", "r.0.0.1", "r.0.1", "r.0.1.0", "r.0.2", "r.0.2.0"]
    assert nodes.filter("path = 'r.0.0.0'").first()["description"] == {"en": "x", "de": "Deutsch"}
    assert tree.broken_nodes(nodes).count() == 0
    root = json.loads(tree.tree_json(nodes).first()["tree_json"])
    assert [len(x["deliverableArray"]) for x in root["deliverableArray"][0]["deliverableArray"]] == [2, 1, 1] and root["confidence"] is None
    assert root["procurementDocumentChunkIdArray"] == ["c_a", "c_b", "c_c", "c_d"]


def test_dominant_language(spark):
    langs = lambda *xs: tree.dominant_language(spark.createDataFrame([req(str(i), i, lang=x) for i, x in enumerate(xs)], REQ)).first()["language"]
    assert (langs("de", "en", "de"), langs("en", "de"), langs(None, ""), langs("DE-at", "en", "de")) == ("de", "en", "en", "de")


def test_taxonomy_and_claims(spark):
    reqs = spark.createDataFrame([req("a", 0, category="08"), req("b", 1, section="Z"), req("c", 2)], REQ)
    tax = spark.createDataFrame([("08", "Lab & Co", "Cabinets", 0), ("08", "Later", "Later", 1)], "key string, l1 string, l2 string, ord int")
    assert sorted(values(tree.taxonomy_groups(reqs, tax), "id", "l1_key", "l2_key", "l2_label")) == [("a", "lab_co", "lab_co__08", "Cabinets"), ("b", "other", "other__general", "General"), ("c", "other", "other__general", "General")]
    reply = spark.createDataFrame([("f", 0, "One", 0, "X", [0, 9]), ("f", 1, "Two", 0, "Y", [0, 1])], "source_file string, l1_ord int, l1 string, l2_ord int, l2 string, indices array<int>")
    assert sorted(values(tree.claimed_groups(reqs, reply), "id", "l2_key")) == [("a", "one__x"), ("b", "two__y"), ("c", "other__general")]


def test_scoring(spark):
    leaves = spark.createDataFrame([("1", "Steel Garage 2,50 x 2,00", True), ("2", "bicycle holder", None)], "id string, text string, equivalence_allowed boolean")
    facts = spark.createDataFrame([(1, ["garage"], ["2,50"], None), (2, ["garage"], ["9"], None), (3, ["holder", "nothing"], [], True), (4, ["holder"], [], None), (5, [], [], None)], "fact_id int, context array<string>, values array<string>, equivalence boolean")
    assert dict(values(evaluate.score(leaves, facts), "fact_id", "found")) == {1: True, 2: False, 3: False, 4: True, 5: False}


# Sources, providers, the whole way.
def test_text_sources(spark, tmp_path):
    (tmp_path / "b.PDF").write_text(json.dumps([[{"str": "Hi", "transform": [1, 0, 0, 10, 5, 700], "width": 8, "height": 10, "hasEOL": True}]]))
    (tmp_path / "a.pdf").write_text("{broken")
    (tmp_path / "c.txt").write_text("no")
    found = glyphs.files(spark, str(tmp_path))
    items = glyphs.text_items(found).collect()
    assert {(r["doc_id"], r["str"], r["error"] is None) for r in items} == {("b.PDF", "Hi", True), ("a.pdf", None, False)}
    assert values(layout.lines(layout.glyphs(glyphs.text_items(found))), "doc_id", "text", "font_size") == [("b.PDF", "Hi", 10.0)]
    html = spark.createDataFrame([("h", "<h1>Big</h1><ul><li>one</li></ul><script>x</script><p>two <b>bold</b></p>"), ("n", None)], "id string, html string")
    assert [r[1:] for r in sorted(values(glyphs.html_lines(html, "id", "html"), "line_no", "text", "font_size"))] == [("Big", 20.0), ("• one", 10.0), ("two bold", 10.0)]
    assert [r[0] for r in sorted(values(glyphs.text_lines(html, "id", "html"), "line_no"))] == [0]


def test_cache(spark, tmp_path):
    path = str(tmp_path / "cache")
    chunks = store.cache_key(spark.createDataFrame([("a", "f", "x"), ("b", "f", "y"), ("c", "f", "z")], "chunk_id string, source_file string, content string"), "v1", "m")
    assert store.split_by_cache(chunks, store.read_cache(spark, path))[1].count() == 3
    store.write_cache(chunks.withColumn("items", F.when(F.col("chunk_id") == "a", F.array(F.lit("{}"))).when(F.col("chunk_id") == "b", F.array().cast("array<string>"))), path)
    hits, misses = store.split_by_cache(chunks, store.read_cache(spark, path))
    assert (sorted(r[0] for r in values(hits, "chunk_id")), values(misses, "chunk_id")) == (["a", "b"], [("c",)])
    assert store.split_by_cache(chunks, store.read_cache(spark, path), force=True)[1].count() == 3
    store.write_artifact(chunks, str(tmp_path / "out"), "source_file")
    assert spark.read.json(str(tmp_path / "out")).count() == 3 and json.loads(store.pretty(chunks, 2))[0]["chunk_id"]


def test_pipeline_end_to_end(spark):
    texts = ["GENERAL NOTES", "The contractor must supply 25 lamps to EN 1234 or equivalent.", "1) The lamps should last 9 years.", "It may rain.", "01.01.0010 Lamp posts", "Posts must be 3,5 m high."]
    result = pipeline.run(line_rows(spark, *texts), provider.RulesProvider())
    assert result.chunks.count() == 3
    assert result.extractions.count() == 4
    assert result.nodes.filter("depth = 3").count() == 4
    assert json.loads(tree.tree_json(result.nodes).first()["tree_json"])["bulletPoint"] == "d.pdf"


class Scripted:
    """A model by rules that judges pairs and groups as the test says, counts what it is asked in a file, and can't answer some texts."""

    def __init__(self, log, group):
        self.log, self.group, self.rules = str(log), group, provider.RulesProvider()

    def reply(self, system, message):
        kind = "judge" if message.startswith("Requirement A") else "group" if message.startswith(("Requirements (", "Categories (")) else "glean" if "Already listed" in message else "extract"
        with open(self.log, "a") as f:
            f.write(kind + "\n")
        if kind == "judge":
            return json.dumps({"relation": " SAME"}) if "lamp" in message else None
        if kind == "group":
            return self.group
        if "fails" in message:
            return None
        if kind == "glean":
            return json.dumps({"extractions": [{"bullet_point": "found later", "description_en": "found later on", "description_de": None, "priority": "must", "equivalence_allowed": None, "confidence": "low"}]})
        out = provider.Reply(self.rules.reply(system, message))
        out.prompt_tokens = 7
        return out


TENDER = ["GENERAL NOTES", "The contractor must supply 25 red lamp posts of steel.", "1) The lamp posts of red steel should last.", "01.01.0010 Lamp posts", "The contractor must supply red lamp posts of steel.", "2) The part that fails must not count."]


def test_every_branch_of_a_run(spark, tmp_path):
    kinds = lambda name: sorted((tmp_path / name).read_text().split())
    group = json.dumps({"level1": [{"name": "Lamps & Posts", "level2": [{"name": "All", "itemIndices": [0, 1, 99]}]}]})
    lines, cache = line_rows(spark, *TENDER), str(tmp_path / "cache")
    first = pipeline.run(lines, Scripted(tmp_path / "one", group), cache=cache)
    asked = kinds("one")
    assert asked.count("extract") == first.chunks.count() == 4 and asked.count("glean") == 2 and "judge" in asked and asked.count("group") == 1
    assert values(first.failures, "parts", "failed", "pass") == [(1, 1, 0)]
    use = {r["stage"]: r for r in first.usage.collect()}
    assert use["extract"]["calls"] == 4 and use["extract"]["failed"] == 1 and use["extract"]["prompt_tokens"] == 21 and set(use) == {"extract", "glean", "judge", "group"}
    linked = first.requirements.filter("merge_record.rule = 'semantic-link'").collect()
    assert len(linked) == 1 and linked[0]["item_number"] == "01.01.0010"
    assert {r[0] for r in values(first.nodes.filter("depth = 1"), "bullet_point")} == {"Lamps & Posts", "Other Requirements"} or first.requirements.count() <= 2
    # What is cached isn't asked for again; the part that failed is. Forced, all is.
    second = pipeline.run(lines, Scripted(tmp_path / "two", "no json"), cache=cache)
    assert kinds("two").count("extract") == 1 and "glean" not in kinds("two")
    columns = [c for c in first.extractions.columns if c not in ("ext_ord",)]
    assert sorted(map(str, values(first.extractions, *columns))) == sorted(map(str, values(second.extractions, *columns)))
    assert {r[0] for r in values(second.nodes.filter("depth = 1"), "bullet_point")} == {"Requirements"}  # the reply is of no use
    pipeline.run(lines, Scripted(tmp_path / "three", group), cache=cache, force=True, decide=False)
    assert kinds("three").count("extract") == 4 and "judge" not in kinds("three")


def test_grouping_by_categories(spark):
    from tenderloom.operators import judge

    reqs = spark.createDataFrame([req(f"r{i}", i, category="08" if i < 3 else None, section="Z") for i in range(5)], REQ)
    says = lambda x: provider.ReplayProvider({m: json.dumps(x) for m in ['Categories (2):\n- "08" (3 items): t | t | t\n- "Z" (2 items): t | t']})
    good = {"assignments": [{"key": "08", "l1": "One", "l2": "Cabinets"}, {"key": "08", "l1": "Two", "l2": "No"}]}
    groups, replies = judge.groups(reqs, says(good), inline_limit=4)
    assert sorted(values(groups, "id", "l1_key", "l2_label")) == [(f"r{i}", *(("one", "Cabinets") if i < 3 else ("other", "General"))) for i in range(5)] and replies.count() == 1
    for bad in ({"assignments": []}, {"assignments": [{"key": "08", "l1": "", "l2": "x"}]}, [], "x"):
        assert {r[0] for r in values(judge.groups(reqs, says(bad), inline_limit=4)[0], "l1_key")} == {"requirements"}
    for bad in ({"level1": []}, {"level1": [{"name": "A", "level2": []}]}, {"level1": [{"name": "A", "level2": [{"name": "B", "itemIndices": [-1]}]}]}):
        listed = "Requirements (5):\n" + "\n".join(f"{i}: t" for i in range(5))
        assert {r[0] for r in values(judge.groups(reqs, provider.ReplayProvider({listed: json.dumps(bad)}))[0], "l1_key")} == {"requirements"}


def test_judging_gives_up_after_three_failures(spark):
    from tenderloom.operators import judge

    reqs = spark.createDataFrame([req(f"r{i}", i, title="bad" if i in (2, 4, 5, 6) else "t") for i in range(9)], REQ)
    ranked = spark.createDataFrame([("f", "r0", f"r{i}", i) for i in range(1, 9)], "source_file string, a_id string, b_id string, rank int")
    model = type("M", (), {"reply": lambda self, system, message: None if "bad" in message else '{"relation": "Same"}'})()
    got, replies = judge.verdicts(ranked, reqs, model)
    assert sorted(values(got, "b_id", "relation")) == [("r1", "same"), ("r3", "same")] and replies.count() == 8


def test_contract():
    good = {"bulletPoint": "x", "description": {}, "priority": "must", "confidence": None, "equivalenceAllowed": None, "fullfillable": None, "status": "userDefined", "aiReasoning": None, "feedback": None, "feedbackText": None, "openQuestionId": None, "deliverableArray": [], "procurementDocumentChunkIdArray": [], "workspaceDocumentChunkIdArray": [], "citedProductIdArray": [], "citedPersonIdArray": []}
    assert tree.broken_fields(good) == [] and tree.broken_fields([]) == ["*"]
    for field, value in (("bulletPoint", ""), ("bulletPoint", None), ("description", {"en": None}), ("description", "x"), ("priority", None), ("priority", "high"), ("confidence", "none"), ("equivalenceAllowed", 1), ("status", None), ("aiReasoning", []), ("feedback", "fine"), ("feedbackText", 3), ("deliverableArray", None), ("citedPersonIdArray", [None])):
        assert tree.broken_fields(good | {field: value}) == [field]
    for field in good:
        assert tree.broken_fields({k: v for k, v in good.items() if k != field}) == ([field] if field not in ("confidence", "equivalenceAllowed", "fullfillable", "aiReasoning", "feedback", "feedbackText", "openQuestionId") else tree.broken_fields({k: v for k, v in good.items() if k != field}))


def test_guard_before_merging(spark):
    reqs = spark.createDataFrame([req("a", 0, "01.01.0010"), req("b", 1, "01.01.0020"), req("c", 2), req("d", 3, "01.01.0010"), req("e", 4)], REQ)
    links = spark.createDataFrame([("f", "a", "a"), ("f", "b", "a"), ("f", "c", "a"), ("f", "d", "d"), ("f", "e", "d")], "source_file string, id string, position_id string")
    assert sorted(values(link.guarded(links, reqs), "id")) == [("d",), ("e",)]


def test_command_line(spark, tmp_path):
    from tenderloom.__main__ import run_files

    page = [{"str": t, "transform": [1, 0, 0, 10, 5, 700 - 20 * i], "width": 8 * len(t), "height": 10} for i, t in enumerate(TENDER)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "Lot A.pdf").write_text(json.dumps([page]))
    (tmp_path / "in" / "b.pdf").write_text("{broken")
    run_files(spark, str(tmp_path / "out"), str(tmp_path / "in"), [], provider.RulesProvider())
    read = lambda name: spark.read.json(str(tmp_path / "out" / name))
    assert read("chunks").count() == 4 and read("tree").select("source_file").collect()[0][0] == "Lot A.pdf" and read("errors").count() == 1 and read("extractions").count() and read("consolidated").count()


def test_replay_provider(spark):
    df = spark.createDataFrame([("k", "m"), ("l", "unknown")], "key string, message string")
    assert dict(values(provider.ask(df, provider.ReplayProvider({"m": "{}"}), ""), "key", "reply")) == {"k": "{}", "l": None}


def test_incremental(spark, tmp_path):
    from tenderloom.streaming.incremental import new_chunks, once_by_key

    source, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    cols = ["doc_id", "page", F.col("line_no").cast("long").alias("line_no"), "text", "font_size"]
    line_rows(spark, "HEAD ONE", "body").select(*cols).write.parquet(source)
    new_chunks(spark, source, target, state).awaitTermination()
    line_rows(spark, "1) item", "body").select(F.lit("e.pdf").alias("doc_id"), *cols[1:]).write.mode("append").parquet(source)
    new_chunks(spark, source, target, state).awaitTermination()
    assert sorted(r[0] for r in values(spark.read.parquet(target), "chunk_id")) == ["d__section_sec__i0", "e__section_1__i0"]
    stream = spark.readStream.schema("k string, t timestamp").parquet(source)
    assert once_by_key(stream, "k", "t").isStreaming


# The registered queries.
def core_sql():
    from tenderloom import queries

    return sorted(queries.SQL)


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for p in Path(SF).glob("*.parquet"):
        c.sql(f"create view {p.stem} as select * from '{p}'")
    return c


def text_rows(columns, rows):
    show = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in at], sorted([show(r[i]) for i in at] for r in rows)


@pytest.mark.parametrize("name", core_sql())
def test_query_against_sql(spark, duck, name):
    from tenderloom import queries

    df, rel = queries.QUERIES[name](spark, SF), duck.sql(queries.SQL[name])
    assert text_rows(df.columns, [tuple(r) for r in df.collect()]) == text_rows(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", ["tree_json"])
def test_query_without_sql(spark, name):
    from tenderloom import queries

    queries.QUERIES[name](spark, SF).count()
