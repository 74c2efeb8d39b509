import os
import random
import re
import subprocess
import sys
from datetime import datetime
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tenderloom.llm import alignment, components, fusion, leaks, lookalike, mixing, near_sets, pieces, shared_spans

SF = "/root/testdata/sf0.001"


def values(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


# Groups.
def test_components_against_union_find(spark):
    rng = random.Random(1)
    for n, m in ((300, 200), (60, 300), (400, 399)):
        pairs = [(i, i + 1) for i in range(n - 1)] if m == n - 1 else [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        rng.shuffle(pairs)
        root = list(range(n))

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        want = {x: find(x) for a, b in pairs if a != b for x in (a, b)}
        df = spark.createDataFrame([*pairs, (None, 1), (2, None)], "u long, v long")
        assert dict(values(components.star_components(df))) == want


def test_components_with_hot_nodes(spark, monkeypatch):
    monkeypatch.setattr(components, "MIN_HOT_DEGREE", 10)
    edges = [(0, i) for i in range(1, 200)] + [(500 + i, 500 + i + 1) for i in range(30)] + [(199, 530)]
    got = dict(values(components.star_components(spark.createDataFrame(edges, "u long, v long"))))
    assert set(got.values()) == {0} and len(got) == 231


def test_consolidate(spark):
    records = spark.createDataFrame([("a", ["x", None], 1), ("b", ["x", "y"], 1), ("c", ["y"], 1), ("d", None, 1), ("e", [], 1), ("f", ["z", "z"], 1), (None, ["x"], 1), ("a", ["x"], 1), ("g", [None], 1), ("h", [None], 1)], "id string, src array<string>, n int")
    pairs = spark.createDataFrame([("e", "d"), ("d", "e"), ("e", "e"), ("f", "nobody"), (None, "f")], "a string, b string")
    assert dict(values(components.consolidate(records, pairs, "id", "src"))) == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d"}
    assert components.consolidate(records.limit(0), pairs, "id", "src").count() == 0
    assert components.consolidate(records, pairs.limit(0)).count() == 0
    for name in ("node", "n", "root", "k", "entry"):
        assert dict(values(components.consolidate(records.drop("n").withColumnsRenamed({"id": name}), pairs, name, "src"))) == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d"}


# Alignment.
WORDS = {"pump": "pumpe", "roof": "dach", "lamp": "leuchte", "wall": "wand", "door": "tür", "paint": "farbe", "clean": "reinigen", "deliver": "liefern", "mount": "montieren", "check": "prüfen", "report": "bericht", "oak": "eiche", "steel": "stahl", "glass": "glas", "monthly": "monatlich", "weekly": "wöchentlich", "attic": "dachboden", "cellar": "keller", "garden": "garten", "office": "büro"}


def bilingual(rng, n=4):
    """A record of ``n`` facts, one of them left out on either side, the German ones moved, two English ones joined."""
    facts = []
    for _ in range(n):
        ws = rng.sample(sorted(WORDS), 6)
        k = str(rng.randrange(100, 999))
        facts.append((f"{ws[0].capitalize()} the {ws[1]} and {ws[2]} {ws[3]} with {ws[4]} {ws[5]} {k}", f"Das {' '.join(WORDS[w] for w in rng.sample(ws, 6))} von {k}"))
    en, de = list(range(n - 1)), [0, *range(2, n)]
    rng.shuffle(de)
    en_sentences = [[0, 1], *[[i] for i in en[2:]]] if rng.random() < 0.3 else [[i] for i in en]
    text_en = " ".join("; ".join(facts[i][0] for i in s) + "." for s in en_sentences)
    text_de = " ".join(facts[i][1] + "." for i in de)
    truth = {(i, j) for i, s in enumerate(en_sentences) for j, k in enumerate(de) if k in s}
    return text_en, text_de, truth


def test_alignment_on_held_out_records():
    rng = random.Random(7)
    records = [bilingual(rng) for _ in range(700)]
    tables = alignment.learn([(a, b) for a, b, _ in records[:500]])
    hit = found = true = 0
    for a, b, truth in records[500:]:
        got = set(alignment.align_bags([alignment.bag(s) for s in alignment.sentences(a)], [alignment.bag(s) for s in alignment.sentences(b)], tables))
        hit, found, true = hit + len(got & truth), found + len(got), true + len(truth)
    assert hit / found > 0.95 and hit / true > 0.9


def test_short_sentences_match_as_a_whole():
    rng = random.Random(9)
    tables = alignment.learn([bilingual(rng)[:2] for _ in range(500)])
    en, de = ["din 4102", "steel", "pump roof steel glass"], ["stahl", "din 4102", "pumpe dach stahl glas"]
    got = alignment.align_bags([s.split() for s in en], [s.split() for s in de], tables)
    assert (0, 1) in got and (1, 0) in got and (2, 2) in got and len(got) == 3


def test_sentences():
    assert alignment.sentences(" A 3.5 m. B?  C!\nrest ") == ["A 3.5 m.", "B?", "C!", "rest"]
    assert alignment.sentences(None) == alignment.sentences("  ") == []


REQ = "id string, description_en string, description_de string, updated_at timestamp, en_no string"


def test_alignment_edges(spark):
    t, u = datetime(2024, 1, 1), datetime(2024, 2, 1)
    rng = random.Random(3)
    rows = [(f"r{i}", *bilingual(rng)[:2], t, "clash") for i in range(60)]
    rows += [("r0", None, None, u, None), ("null", "A.", None, t, None), ("blank", "  ", "B.", t, None), rows[5], (None, "A.", "B.", t, None)]
    df = spark.createDataFrame(rows, REQ)
    got = alignment.aligned_sentences(df)
    ids = {r[0] for r in values(got, "id")}
    assert got.count() == got.distinct().count() and "r5" in ids and not ids & {"r0", "null", "blank"}
    assert alignment.aligned_sentences(df.limit(0)).count() == 0


def test_alignment_learns_from_all_records(spark):
    t, letters = datetime(2024, 1, 1), "abcdefghij"
    name = lambda k: "".join(letters[int(c)] for c in f"{k:04}")
    say = lambda k, a: f"{a}one{name(k)} {a}two{name(k)} {a}three{name(k)}."
    texts = [(f"{say(k, 'x')} {say((k + 1 + n) % 700, 'x')}", f"{say((k + 1 + n) % 700, 'y')} {say(k, 'y')}") for k in range(700) for n in range(4)]
    df = spark.createDataFrame([(f"r{i}", a, b, t, None) for i, (a, b) in enumerate(texts)], REQ)
    got = values(alignment.aligned_sentences(df), "id", "en_no", "de_no")
    assert set(got) == {(f"r{i}", n, 1 - n) for i in range(len(texts)) for n in (0, 1)}
    few = spark.createDataFrame([bilingual(random.Random(n))[:2] for n in range(80)], "description_en string, description_de string")
    one, other = alignment.learned(few), alignment.learn([tuple(r) for r in few.collect()])
    for a, b in ((one.forward, other.forward), (one.backward, other.backward)):
        assert {w: pytest.approx(v, abs=1e-3) for w, v in b.items()} == a
    assert one.typical == pytest.approx(other.typical, rel=1e-3)


def test_names_take_no_room_in_the_tables(spark, monkeypatch):
    rng = random.Random(4)
    records = []
    for k in range(240):
        en, de, _ = bilingual(rng)
        name = f"name{chr(97 + k % 26)}"
        records.append((f"{en} Depot {name} opens.", f"{de} Lager {name} öffnet."))
    df = spark.createDataFrame(records, "description_en string, description_de string")
    one, other = alignment.learned(df), alignment.learn(records)
    for tables in (one, other):
        for words in (tables.forward, tables.backward, tables.weight_en, tables.weight_de):
            assert words and not any(w.startswith("name") for w in words)
    monkeypatch.setattr(alignment, "CELLS", 100)  # many blocks a round
    few = alignment.learned(df)
    for a, b, c in ((one.forward, other.forward, few.forward), (one.backward, other.backward, few.backward)):
        assert {w: pytest.approx(v, abs=1e-3) for w, v in b.items()} == a and {w: pytest.approx(v, abs=1e-3) for w, v in c.items()} == a


def test_records_align_together_as_one_by_one(monkeypatch):
    rng = random.Random(6)
    texts = [(*bilingual(rng, n)[:2],) for n in (3, 4, 5, 8) for _ in range(60)] + [("A.", "..."), ("", "B."), ("Din 4102. ?! Steel.", "Stahl. Din 4102.")]
    tables = alignment.learn(texts)
    batch = next(alignment._bags(iter([pd.DataFrame(texts, columns=["description_en", "description_de"])])))
    split = [([alignment.bag(s) for s in alignment.sentences(t)] for t in pair) for pair in texts]
    want = {k: pairs for k, (a, b) in enumerate(split) if (pairs := alignment.align_bags(a, b, tables))}
    for cells in (alignment.AT_ONCE, 500):
        monkeypatch.setattr(alignment, "AT_ONCE", cells)
        assert {k: pairs for k, pairs in alignment._align(batch, tables) if pairs} == want
    assert len(want) > 200


# Pieces.
def random_text(rng, n):
    kinds = ["\n\n", "\n", ". ", " ", " ", " ", "\nHEAD LINE\n", "\n• item ", "\n01.01.0010 Pos "]
    return "".join("".join(rng.choices("abcdefghij", k=rng.randrange(1, 12))) + rng.choice(kinds) for _ in range(n))


@pytest.mark.parametrize("seed", range(40))
def test_pieces_join_up(seed):
    rng = random.Random(seed)
    text = random_text(rng, rng.randrange(0, 400)) if seed % 4 else "x" * rng.randrange(0, 900)
    limit = rng.randrange(20, 300)
    overlap = rng.randrange(0, limit // 2)
    got = pieces.split(text, limit, overlap)
    assert "".join(text[o:e] for _, o, e in got) == text
    assert all(b <= o < e and e - b <= limit and o - b <= overlap for b, o, e in got)
    assert got[0][0] == 0 if got else text == ""


def test_pieces_prefer_natural_cuts():
    text = "\n\n".join("Word " * 15 for _ in range(6))
    assert all(text[:o].endswith("\n\n") for _, o, _ in pieces.split(text, 200, 20)[1:])
    with pytest.raises(ValueError):
        pieces.split("x", 5, 5)


def test_pieces_follow_the_tree():
    """Sections of a higher rank stay together before those within them, nested list items stay with their parent."""
    part = lambda n: f"## Part {n}\n\n" + "Some words here. " * 4 + "\n\n"
    text = "# One\n\n" + part(1) + part(2) + "# Two\n\n" + part(3) + part(4)
    assert [text[o:e][:5] for _, o, e in pieces.split(text, 210, 10)] == ["# One", "# Two"]
    items = "".join(f"- item {i} of the list\n" + "".join(f"  - nested {i}.{j} with text\n" for j in range(3)) for i in range(6))
    cut = [items[o:e] for _, o, e in pieces.split(items, 240, 10)]
    assert len(cut) > 2 and all(c.startswith("- item") for c in cut)
    codes = "".join(f"01.0{i} Group\n" + "".join(f"01.0{i}.00{j}0 Position with words\n" for j in range(1, 4)) for i in range(1, 5))
    assert all(re.match(r"01\.0\d Group", codes[o:e]) for _, o, e in pieces.split(codes, 150, 10))
    html = "<ul>\n" + "".join(f"<li>first {i}\n<ul>\n<li>second {i}</li>\n<li>third {i}</li>\n</ul>\n</li>\n" for i in range(6)) + "</ul>\n"
    assert all(html[o:e].startswith(("<ul>", "<li>first", "</ul>")) for _, o, e in pieces.split(html, 160, 10))


def test_no_piece_begins_within_a_token():
    text = "".join(f"01.02.00{i:03d} Menge 4.5 Stück, Maß 2.50!x Ende.\n" for i in range(200))
    starts = [b for b, o, e in pieces.split(text, 900, 130)][1:]
    assert starts and all(text[b - 1].isspace() for b in starts)
    mixed = "word " * 3 + "x" * 50 + " tail" * 10
    assert [(b, o) for b, o, _ in pieces.split(mixed, 60, 20)] == [(0, 0), (5, 15), (35, 55), (66, 66), (91, 106)]  # 35: the cut itself is within the run
    unbroken = "y" * 500
    assert [o - b for b, o, e in pieces.split(unbroken, 100, 20)] == [0, 20, 20, 20, 20, 20, 20]


def test_the_last_version_decides_whether_it_is_oversized(spark):
    rows = [("a", "x " * 9000, datetime(2024, 1, 1)), ("a", "short now", datetime(2024, 1, 2)), ("b", "short before", datetime(2024, 1, 1)), ("b", "y " * 9000, datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "chunk_id string, content string, loaded_at timestamp")
    assert values(pieces.oversized(df)) == [("b",)]
    assert values(pieces.reassembled(df), "chunk_id", "n_chars", "within_limit", "within_overlap") == [("b", 18000, True, True)]


def test_oversized(spark):
    t = datetime(2024, 1, 1)
    rows = [("a", "x " * 9000, t), ("a", "x " * 9000, t), ("b", "y" * 12000, t), ("c", None, t), ("d", "", t), (None, "z" * 13000, t), ("e", "ä😀" * 7000, t)]
    df = spark.createDataFrame(rows, "chunk_id string, content string, loaded_at timestamp").withColumn("piece_no", F.lit("clash"))
    assert sorted(values(pieces.oversized(df))) == [("a",), ("e",)]
    assert pieces.oversized_pieces(df).filter(F.length("content") > 12000).count() == 0
    assert pieces.oversized(df.limit(0)).count() == 0


# Near-duplicates.
def brute_pairs(rows):
    sets = [(k, key, {w.lower() for w in re.findall(r"[^\W_]+", t or "")}) for k, key, t in rows]
    sets = [x for x in sets if len(x[2]) >= 6]
    return {(k, min(a, b), max(a, b)) for i, (k, a, x) in enumerate(sets) for m, b, y in sets[i + 1 :] if k == m and len(x & y) * 5 >= 4 * max(len(x), len(y))}


def small_edits(rng, n, vocabulary, low, high):
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            ws = rng.choice(rows)[2].split()
            for _ in range(rng.randrange(0, max(1, len(ws) // 5) + 1)):
                at = rng.randrange(len(ws))
                ws = rng.choice([lambda: ws[:at] + ws[at + 1 :], lambda: ws[:at] + [f"n{rng.randrange(10**6)}"] + ws[at:], lambda: ws[:at] + [rng.choice(vocabulary)] + ws[at + 1 :]])()
            rng.shuffle(ws)
        else:
            ws = rng.sample(vocabulary, rng.randrange(low, high))
            ws += [f"n{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 5))]
        rows.append((rng.randrange(2), f"k{i}", " ".join(ws) if ws else "x"))
    return rows


@pytest.mark.parametrize(("seed", "size", "low", "high", "budget"), [(1, 40, 4, 14, 256), (2, 120, 20, 70, 256), (3, 25, 5, 20, 0), (4, 60, 10, 50, 0), (5, 200, 3, 150, 1), (6, 15, 6, 14, 0)])
def test_near_pairs_against_brute_force(spark, monkeypatch, seed, size, low, high, budget):
    monkeypatch.setattr(near_sets, "PAIRS_PER_RECORD", budget)  # 0: nearly every word is common, so the partition finds the pairs
    rng = random.Random(seed)
    rows = small_edits(rng, 500, [f"w{i}" for i in range(size)], low, min(high, size))
    df, want = spark.createDataFrame(rows, "kind int, key string, text string"), brute_pairs(rows)
    got = values(near_sets.near_pairs(df))
    assert len(got) == len(set(got)) and set(got) == want
    links, root = {(k, key): 0 for k, key, _ in rows}, {(k, key): key for k, key, _ in rows}
    for k, a, b in want:
        links[k, a] += 1
        links[k, b] += 1
    changed = True
    while changed:
        changed = False
        for k, a, b in want:
            low = min(root[k, a], root[k, b])
            changed |= root[k, a] != low or root[k, b] != low
            root[k, a] = root[k, b] = low
    assert {(k, key): (c, n) for k, key, c, n in values(near_sets.near_classes(df))} == {x: (root[x], links[x]) for x in links}


def test_near_pairs_of_loose_classes(spark, monkeypatch):
    monkeypatch.setattr(near_sets, "PAIRS_PER_RECORD", 0)
    monkeypatch.setattr(near_sets, "TIGHT", 0.03)  # most classes are loose
    rows = small_edits(random.Random(8), 400, [f"w{i}" for i in range(50)], 8, 45)
    assert set(values(near_sets.near_pairs(spark.createDataFrame(rows, "kind int, key string, text string")))) == brute_pairs(rows)


def test_near_pairs_of_split_runs(spark, monkeypatch):
    """A rare word of many records is compared in blocks, and no pair is lost between them."""
    monkeypatch.setattr(near_sets, "PAIRS_PER_RECORD", 10**6)  # every word is rare
    monkeypatch.setattr(near_sets, "RUN", 8)
    rows = small_edits(random.Random(12), 400, [f"w{i}" for i in range(30)], 6, 20)
    got = values(near_sets.near_pairs(spark.createDataFrame(rows, "kind int, key string, text string")))
    assert len(got) == len(set(got)) and set(got) == brute_pairs(rows)


def test_near_pairs_edges(spark):
    same = "one two three four five six"
    rows = [(0, "a", same), (0, "b", same.upper() + " !"), (1, "c", same), (0, "d", None), (0, "e", ""), (0, "f", "one two"), (0, "g", "one two"), (0, "h", "six five four three two one one")]
    df = spark.createDataFrame(rows, "kind int, key string, text string").withColumn("rid", F.lit("clash"))
    assert set(values(near_sets.near_pairs(df))) == {(0, "a", "b"), (0, "a", "h"), (0, "b", "h")}
    assert near_sets.near_pairs(df.limit(0)).count() == 0


def test_near_pairs_of_a_long_text(spark):
    ws = [f"w{i}" for i in range(5000)]
    rows = [(0, "a", " ".join(ws)), (0, "b", " ".join(ws[600:])), (0, "c", " ".join(ws[1200:]))]
    assert set(values(near_sets.near_pairs(spark.createDataFrame(rows, "kind int, key string, text string")))) == brute_pairs(rows)


# Look-alikes.
@pytest.mark.parametrize(("a", "b", "same"), [("Tür", "Tür", True), ("Tor 5", "Ｔor 5", True), ("oﬃce", "office", True), ("a​b", "ab", True), ("Аbc", "Abc", True), ("ab­", "ab", True), ("well‑known", "well-known", True), ("ab", "aB", False), ("a", "ä", False), ("m²", "m2", False), ("a\nb", "a b", False), ("1", "l", False), ("a.", "a,", False), ("Ο", "O", True), ("a  b", "a b", False), ("a\tb", "a b", True), ("a\u2028b", "a\nb", True), ("a\r\nb", "a\nb", True), ("3 x", "٣ x", False), ("٤", "۴", False), ("४", "٤", False), ("٣", "۳", True), ("3٣", "٣3", False), ("Ⅷ", "VIII", True), ("ꓮꓐ", "AB", True), ("½", "1/2", False), ("１2", "12", True), ("Օn", "On", True), ("①", "1", False)])
def test_same_to_a_reader(spark, a, b, same):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([("1", a, t, "x"), ("2", b, t, "x"), ("3", None, t, "x"), ("4", "", t, "x"), ("1", a, t, "x")], "chunk_id string, content string, loaded_at timestamp, digest string")
    assert values(lookalike.same_to_a_reader(df)) == ([("1", "2")] if same else [])
    forms = dict(values(lookalike.canonical_chunks(df), "chunk_id", "canonical"))
    assert (forms["1"] == forms["2"]) is same and forms["3"] is None and forms["4"] == ""
    assert lookalike.same_to_a_reader(df.limit(0)).count() == 0


# Fusion.
FUSED = "id string, source_file string, item_number string, description_en string, confidence string, priority string, updated_at timestamp, standards array<string>, referenced_annexes array<string>, merge_record struct<rule:string>, source_language string"


def claims():
    rng = random.Random(2)
    quality = {"good": (0.95, 0.98), "poor": (0.4, 0.7)}
    rows, truth = [], {}
    for g in range(150):
        for v in range(4):
            truth[f"g{g}", f"v{v}"] = rng.random() < 0.5
        for source, n in (("good", 3), ("poor", 2)):
            for _ in range(n):
                rows.append((f"g{g}", source, [f"v{v}" for v in range(4) if rng.random() < (quality[source][0] if truth[f"g{g}", f"v{v}"] else 1 - quality[source][1])]))
    return rows, truth


def test_fusion_of_values(spark):
    rows, truth = claims()
    df = spark.createDataFrame(rows, "g string, s string, vals array<string>")
    facts = fusion.evidence(df, ["g"], ("vals",), "s")
    judged, sources = fusion.infer_truth(facts)
    got = {(g, v): p >= 0.5 for g, v, p in values(facts.join(judged, ["field", "pattern"]), "g", "value", "p_true")}
    assert sum(got[k] == truth[k] for k in got) / len(got) > 0.95
    q = {s: (a, b) for s, a, b in values(sources, "source", "sensitivity", "specificity")}
    assert q["good"][0] > 0.88 and q["good"][1] > 0.93 and q["poor"][0] < 0.55


def test_fusion_beats_the_majority(spark):
    """Few reliable statements against many unreliable ones: the model keeps what the reliable source says."""
    rng = random.Random(21)
    quality, rows, truth = {"sure": (0.95, 0.97), "wild": (0.5, 0.55)}, [], {}
    for g in range(200):
        true = {f"v{v}" for v in range(5) if rng.random() < 0.5}
        truth |= {(f"g{g}", f"v{v}"): f"v{v}" in true for v in range(5)}
        for source, n in (("sure", 1), ("wild", 4)):
            rows += [(f"g{g}", source, [f"v{v}" for v in range(5) if rng.random() < (quality[source][0] if f"v{v}" in true else 1 - quality[source][1])]) for _ in range(n)]
    facts = fusion.evidence(spark.createDataFrame(rows, "g string, s string, vals array<string>"), ["g"], ("vals",), "s")
    judged, _ = fusion.infer_truth(facts)
    got = values(facts.join(judged, ["field", "pattern"]), "g", "value", "p_true", "pattern")
    right = sum((p >= 0.5) == truth[g, v] for g, v, p, _ in got) / len(got)
    majority = sum((2 * sum(c["pos"] for c in x) >= sum(c["pos"] + c["neg"] for c in x)) == truth[g, v] for g, v, _, x in got) / len(got)
    assert right > 0.9 and right > majority + 0.15


def test_truth_model_against_plain_python(spark):
    """The rounds over patterns give what expectation-maximisation over every single value gives."""
    rows, _ = claims()
    facts = fusion.evidence(spark.createDataFrame(rows, "g string, s string, vals array<string>"), ["g"], ("vals",), "s")
    judged, sources = fusion.infer_truth(facts, 5)
    each = [(g, v, [(c["source"], c["pos"], c["neg"]) for c in p]) for g, v, p in values(facts, "g", "value", "pattern")]
    p = [sum(a for _, a, _ in x) / sum(a + b for _, a, b in x) for *_, x in each]
    for _ in range(5):
        prior, rate = (sum(p) + 1) / (len(p) + 2), {}
        for s in ("good", "poor"):
            t = [(q, a, b) for q, (*_, x) in zip(p, each, strict=True) for n, a, b in x if n == s]
            rate[s] = ((sum(q * a for q, a, _ in t) + 4) / (sum(q * (a + b) for q, a, b in t) + 6), 1 - (sum((1 - q) * a for q, a, _ in t) + 1) / (sum((1 - q) * (a + b) for q, a, b in t) + 10))
        odds = [np.log(prior / (1 - prior)) + sum(a * np.log(rate[n][0] / (1 - rate[n][1])) + b * np.log((1 - rate[n][0]) / rate[n][1]) for n, a, b in x) for *_, x in each]
        p = [1 / (1 + np.exp(-o)) for o in odds]
    assert {s: (a, b) for s, a, b in values(sources, "source", "sensitivity", "specificity")} == {s: pytest.approx(v, abs=1e-9) for s, v in rate.items()}
    got = {(g, v): x for g, v, x in values(facts.join(judged, ["field", "pattern"]), "g", "value", "p_true")}
    assert got == {(g, v): pytest.approx(x, abs=1e-9) for (g, v, _), x in zip(each, p, strict=True)}


def test_best_members(spark):
    t = [datetime(2024, 1, d) for d in range(1, 9)]
    row = lambda i, item, text, conf, prio, d, std=None, file="f": (i, file, item, text, conf, prio, t[d], std, [], ("standalone",), "de")
    rows = [
        row("a", " 1 ", "long text here", None, "must", 3, ["EN 1"]), row("b", "1\t", "  short         ", "high", None, 1, ["EN 1", None, " "]), row("c", "1", None, "low", "should", 2), row("d", "1", "  ", "low", "optional", 2),
        row("e", "2", "alone", "high", "must", 1), row("f", None, "none", "high", "must", 1), row("g", None, "none", "high", "must", 1), row("h", "3", None, None, None, 1), row("i", "3", " ", None, None, 1), row("a", "1", "an older version of it", "high", "must", 0), row("j", "1", "x", "high", "must", 1, file="other"),
    ]
    df = spark.createDataFrame(rows, FUSED).withColumn("members", F.lit("clash"))
    got = {r["item_number"]: (r["description_id"], r["confidence_id"], r["priority_id"], r["standards"]) for r in fusion.fused(df, 3).collect()}
    assert got == {"1": ("a", "d", "d", ["EN 1"]), "3": (None, None, None, [])}
    assert fusion.fused(df.limit(0), 2).count() == 0


# Leaks.
def test_tiles():
    doc, item = "a b c d x e f g h y a b".split(), "e f g h a b c d".split()
    starts = [(i, j) for i in range(len(doc) - 2) for j in range(len(item) - 2) if doc[i : i + 3] == item[j : j + 3]]
    assert leaks.tiles(doc, item, starts, 3) == [(0, 4, 4), (5, 0, 4)]


def brute_tiles(doc, item, least):
    """Greedy string tiling by its definition: again and again the longest common run of unmarked words."""
    used_doc, used_item, found = [False] * len(doc), [False] * len(item), []
    while True:
        best = None
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] and not used_doc[a + n] and not used_item[b + n]:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (a, b, n)
        if best is None:
            return sorted(found)
        found.append(best)
        a, b, n = best
        used_doc[a : a + n] = used_item[b : b + n] = [True] * n


@pytest.mark.parametrize("seed", range(30))
def test_tiles_against_brute_force(seed):
    rng = random.Random(seed)
    doc, item = (rng.choices("abc"[: rng.randint(1, 3)], k=rng.randint(3, 40)) for _ in range(2))
    starts = [(i, j) for i in range(len(doc) - 2) for j in range(len(item) - 2) if doc[i : i + 3] == item[j : j + 3]]
    assert leaks.tiles(doc, item, starts, 3) == brute_tiles(doc, item, 3)


def test_leaks_of_all_versions_both_ways(spark):
    """A leak in any text of a repeated id counts, and the row is that of its best text."""
    w = [f"w{i}" for i in range(40)]
    docs = [(1, " ".join(w[:20])), (1, "zz harmless"), (2, " ".join(w[:13])), (2, " ".join(w[20:39])), (2, " ".join(w[:13])), (3, " ".join(["x"] * 300)), (4, None), (4, " ".join(w[5:30]))]
    items = [(1, " ".join(w)), (2, " ".join(["x"] * 50))]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one, two = (sorted(values(leaks.leaks(docs, items, broadcast=how))) for how in (True, False))
    assert one == two == [(1, 1, 20, 40, 20, 1), (2, 1, 19, 40, 19, 1), (3, 2, 50, 50, 50, 1), (4, 1, 25, 40, 25, 1)]


def test_leaks_both_ways(spark):
    rng = random.Random(5)
    ws = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(ws, k=rng.randrange(0, 30)))) for i in range(40)]
    docs = []
    for d in range(150):
        text = rng.choices(ws, k=rng.randrange(0, 60))
        if rng.random() < 0.5:
            cut = rng.choice(items)[1].split()
            a = rng.randrange(0, max(1, len(cut) - 10))
            text[5:5] = cut[a : a + rng.randrange(8, 20)]
        docs.append((d, ", ".join(text).upper()))
    grams = {}
    for i, t in items:
        w = t.split()
        for k in range(len(w) - 11):
            grams.setdefault(tuple(w[k : k + 12]), set()).add(i)
    want = {(d, i) for d, t in docs for w in [t.lower().split(", ")] for k in range(len(w) - 11) for i in grams.get(tuple(w[k : k + 12]), ())}
    docs += [(900, None), (901, ""), (None, docs[0][1]), docs[0]]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    it = spark.createDataFrame([*items, (700, None), (None, "x")], "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    one, two = leaks.leaks(df, it, broadcast=True), leaks.leaks(df, it, broadcast=False)
    assert {r[:2] for r in values(one)} == want and sorted(values(one)) == sorted(values(two))
    assert leaks.leaked_coverage(one).count() == len({d for d, _ in want})
    assert leaks.leaks(df.limit(0), it).count() == leaks.leaks(df, it.limit(0)).count() == 0


# Mixing.
def test_flight_and_landing():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 500, 1000).astype(float)
    p = np.full(1000, 0.37)
    got = mixing.fly(p, size, 3)
    assert ((got > 1e-9) & (got < 1 - 1e-9)).sum() <= 2
    assert abs(got.sum() - p.sum()) < 1e-6 and abs((got * size).sum() - (p * size).sum()) < 1e-3
    landed = mixing.land(got, size)
    assert set(landed.tolist()) <= {0.0, 1.0} and abs((landed * size).sum() - (p * size).sum()) <= 500
    drawn = np.mean([mixing.fly(np.full(20, 0.3), np.arange(1.0, 21), s) for s in range(400)], axis=0)
    assert np.abs(drawn - 0.3).max() < 0.1
    assert mixing.fly(np.full(5, 0.5), np.ones(5), 1).sum() == pytest.approx(2.5)


def test_mixture(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["word"] * rng.randrange(1, 60)), rng.choice(["Big"] * 8 + ["small-one", " small_one "])) for i in range(3000)]
    df = spark.createDataFrame([*rows, (9001, None, "big"), (9002, "", "big"), (9003, "x", None), (9004, "x", "unknown"), rows[0]], "doc_id long, text string, source string").withColumn("tokens", F.lit("clash"))
    targets = spark.createDataFrame([("big", 0.5, 1), ("small_one", 0.4, 3), ("missing", 0.1, 2)], "source string, target_share double, max_repeats int")
    mixed = mixing.mixture(df, targets, block=200).cache()
    got = {r["source"]: r for r in mixing.shares(mixed, targets).collect()}
    assert got["missing"]["reached_share"] == 0 and got["small_one"]["most_copies"] <= 3 and got["big"]["most_copies"] == 1
    assert abs(got["big"]["reached_share"] - 5 / 9) < 0.003 and abs(got["small_one"]["reached_share"] - 4 / 9) < 0.003
    assert mixed.select("doc_id").distinct().count() == mixed.count()
    assert sorted(values(mixed)) == sorted(values(mixing.mixture(df.repartition(7), targets, block=200)))
    assert mixing.mixture(df.limit(0), targets).count() == mixing.mixture(df, targets.limit(0)).count() == 0
    assert mixing.shares(mixed.limit(0), targets).filter("tokens = 0").count() == 3


def test_mixture_of_the_test_tables_meets_its_targets(spark):
    """On the documents and targets of the test data: shares within one document of the target, repeats within their limit."""
    d = "/root/testdata/sf0.01"
    targets = spark.read.parquet(f"{d}/mix_targets.parquet")
    documents = spark.read.parquet(f"{d}/documents.parquet")
    mixed = mixing.mixture(documents, targets).cache()
    limits = {r["source"]: r["max_repeats"] for r in targets.collect()}
    due = {r["source"]: r for r in mixing.plan(mixing.token_counts(documents, mixing.TOKENIZER), targets)}
    largest = dict(values(mixed.groupBy("source").agg(F.max("tokens"))))
    for r in mixing.shares(mixed, targets).collect():
        want = due[r["source"]]
        assert r["most_copies"] <= limits[r["source"]]
        assert abs(r["tokens"] - want["due"] * (want["tokens"] or 0)) <= largest.get(r["source"], 0)
        total = sum(x["share"] for x in due.values() if x["due"])
        if want["due"]:
            assert abs(r["reached_share"] - r["target_share"] / total) < 0.002


# Shared spans.
def brute_shared(rows, span):
    where = {}
    for d, t in rows:
        for p in range(len(t) - span + 1):
            where.setdefault(t[p : p + span], set()).add(d)
    out = {}
    for d, t in rows:
        marked = set()
        for p in range(len(t) - span + 1):
            if len(where[t[p : p + span]]) > 1:
                marked.update(range(p, p + span))
        if marked:
            out[d] = len(marked)
    return out


def prose(rng, n, end=(". ", ".\n", "? ", ".\n\n", " ")):
    return "".join(" ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 8))) for _ in range(rng.randrange(3, 18))) + rng.choice(end) for _ in range(n))


@pytest.mark.parametrize("kind", ["prose", "unbroken", "periodic", "spaces"])
def test_shared_chars_against_brute_force(spark, kind):
    rng = random.Random(len(kind))
    make = {"prose": lambda: prose(rng, 14), "unbroken": lambda: "".join(rng.choices("abc", k=1200)), "periodic": lambda: "ab" * 500 + prose(rng, 3), "spaces": lambda: prose(rng, 6, (". " + "\n" * 70, ".", "! "))}[kind]
    texts = [make() for _ in range(12)]
    for i in range(40):
        a, b = rng.choice(texts), rng.choice(texts)
        p, n = rng.randrange(max(1, len(a) - 440)), rng.randrange(430, 700)
        q = rng.randrange(len(b) + 1)
        texts.append(b[:q] + a[p : p + n] + b[q:])
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, (900, None), (901, ""), (None, texts[0]), rows[3]], "doc_id long, text string").withColumn("at", F.lit("clash"))
    assert dict(values(shared_spans.shared_chars(df))) == brute_shared(rows, 450)


def test_shared_chars_across_a_gap(spark):
    """A stretch of two parts of sentences with much white space between them holds no sentence as a whole."""
    a, b = "a b c d e f g h i " * 10, "k l m n o p q r s " * 10
    one, two = "one " + a + "x." + " " * 80 + b + "end.", "another " + a + "x." + " " * 80 + b + "finish."
    texts = [(1, "First here. " + one), (2, "Second there. " + two), (3, "\n" * 700), (4, "z" + "\n" * 600)]
    assert dict(values(shared_spans.shared_chars(spark.createDataFrame(texts, "doc_id long, text string")))) == brute_shared(texts, 450)


def test_shared_chars_edges(spark):
    df = spark.createDataFrame([(1, "ä😀" * 300), (2, "x" + "ä😀" * 300), (3, "y" * 449), (4, "y" * 449)], "doc_id long, text string")
    assert dict(values(shared_spans.shared_chars(df))) == {1: 600, 2: 600}
    assert shared_spans.shared_chars(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        shared_spans.shared_chars(df, 100)


def test_bands():
    for similarity, recall, most in ((1.0, 0.99, 128), (0.8, 0.95, shared_spans.HASHES), (0.9, 0.99, 128)):
        bands, rows = shared_spans.tune_bands(similarity, recall, most)
        assert 1 - (1 - similarity**rows) ** bands >= recall


def test_paragraph_clusters(spark):
    rng = random.Random(6)
    base = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) + "." for _ in range(20)]
    near = [b.replace(b.split()[4], "changed") for b in base[:8]]
    df = spark.createDataFrame([(1, " ".join(base[:10])), (2, " ".join(base[5:15])), (3, " ".join(near)), (4, None), (5, "")], "doc_id long, text string")
    got = values(shared_spans.paragraph_clusters(df, 0.6, 0.99), "doc_id", "cluster_doc", "cluster_begin", "removed", "members")
    # Five paragraphs of document 1 are in 2 as well, and all eight of 3 resemble one of 1.
    assert len([g for g in got if not g[3]]) == 10 == len({g[1:3] for g in got})
    assert len([g for g in got if g[0] == 3 and g[3]]) == 8 and len([g for g in got if g[0] == 2 and g[3]]) == 5
    assert shared_spans.paragraph_clusters(df.limit(0)).count() == 0


def jaccard(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split()))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("apart", [8, 0])
def test_recall_of_paragraph_clusters(spark, monkeypatch, apart):
    """With the registered parameters, of planted pairs at a similarity of 0.8 or more at least 0.95 come together, none below do."""
    monkeypatch.setattr(shared_spans, "APART", apart)  # 0: every centre is tried
    monkeypatch.setattr(shared_spans, "CENTRES", 3)
    rng = random.Random(31)
    pairs = []
    for _ in range(600):
        a = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 90))]
        b = list(a)
        for _ in range(rng.randrange(0, 3)):
            b[rng.choice((0, len(b) - 1, rng.randrange(len(b))))] = f"x{rng.randrange(10**6)}"
        pairs.append((" ".join(a), " ".join(b)))
    rows = [(2 * i + s, p[s]) for i, p in enumerate(pairs) for s in (0, 1)]
    got = {(r[0], r[1]) for r in values(shared_spans.paragraph_clusters(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "cluster_doc")}
    near = [i for i, p in enumerate(pairs) if jaccard(*p) >= 0.8]
    assert 100 < len(near) < 600
    assert sum((2 * i + 1, 2 * i) in got for i in near) / len(near) >= 0.95
    assert not any((2 * i + 1, 2 * i) in got for i in set(range(600)) - set(near))


@pytest.mark.parametrize("apart", [8, 0])
def test_clusters_of_a_hot_band(spark, monkeypatch, apart):
    """Boilerplate with small edits: what all pairs connect is connected by centres, too."""
    monkeypatch.setattr(shared_spans, "APART", apart)
    monkeypatch.setattr(shared_spans, "CENTRES", 2)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(150):
        t = list(base)
        for _ in range(rng.randrange(1, 4)):
            t[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(t))
    root = list(range(150))
    for i in range(150):
        for j in range(i):
            if jaccard(texts[i], texts[j]) >= 0.8:
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    got = dict(values(shared_spans.paragraph_clusters(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 0.8, 0.999), "doc_id", "cluster_doc"))
    assert got == {i: r for i, r in enumerate(root) if root.count(r) > 1}


def test_composed_signs_share_an_outline(spark):
    spelled = [("a \u2260 b", "a =\u0338 b"), ("c \u226e d", "c <\u0338 d"), ("e \u226f f", "e >\u0338 f"), ("g\u037e h", "g; h")]
    df = spark.createDataFrame([(f"{n}{s}", t) for n, pair in enumerate(spelled) for s, t in zip("xy", pair, strict=True)], "chunk_id string, content string").selectExpr("*", "timestamp'2024-01-01' as loaded_at")
    assert sorted(values(lookalike.same_to_a_reader(df))) == [(f"{n}x", f"{n}y") for n in range(4)]


def test_short_paragraphs_are_clustered(spark):
    texts = ["Ja wohl. Die Stelle prüft jedes Blatt. Das eine nur hier.", "Die Stelle prüft jedes Blatt.\n\nJa wohl.", "Nein doch. Die Stelle prüft kein Blatt."]
    df = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")
    got = values(shared_spans.paragraph_clusters(df), "doc_id", "begin", "cluster_doc", "cluster_begin", "removed")
    assert sorted(got) == [(1, 0, 1, 0, False), (1, 9, 1, 9, False), (2, 0, 1, 9, True), (2, 31, 1, 0, True)]


def test_workers_find_the_package_from_anywhere(tmp_path):
    """A driver started elsewhere, with frames of its own, hands the code to its workers."""
    script = tmp_path / "run.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[2])!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from tenderloom.llm import leaks, pieces
from tenderloom.operators import nested
text = " ".join(f"w{{i}}" for i in range(20))
one = leaks.leaks(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(2, text)], "item_id long, text string")).count()
two = pieces.oversized_pieces(spark.createDataFrame([("a", "x " * 9000)], "chunk_id string, content string").selectExpr("*", "current_timestamp() as loaded_at")).count()
three = nested.tree_nodes(spark.createDataFrame([("t", "{{}}")], "tree_id string, tree_json string").selectExpr("*", "current_timestamp() as produced_at", "current_timestamp() as loaded_at")).count()
print("rows", one, two, three)
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "rows 1 2 1" in out.stdout, out.stderr[-2000:]


# The registered queries.
def sql_names():
    from tenderloom.llm import queries

    return sorted(queries.SQL)


@pytest.mark.parametrize("name", sql_names())
def test_query_against_sql(spark, name):
    import duckdb

    from tenderloom.llm import queries

    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.sql(f"create view {p.stem} as select * from '{p}'")
    df, rel = queries.QUERIES[name](spark, SF), c.sql(queries.SQL[name])
    at = [rel.columns.index(x) for x in df.columns]
    assert sorted(map(str, values(df))) == sorted(str(tuple(r[i] for i in at)) for r in rel.fetchall())


@pytest.mark.parametrize("name", ["p2_found", "p3_pieces", "p5_classes", "p6_canonical", "p7_fused", "p8_leaks", "p8_coverage", "p9_mixture", "p9_shares", "p10_paragraph_clusters"])
def test_query_without_sql(spark, name):
    from tenderloom.llm import queries

    queries.QUERIES[name](spark, SF).count()
