"""Sentence alignment in bilingual records.

A word translation table is learned from all the records themselves by expectation-
maximisation (word-by-word translation model, then again on the sentences
that it aligns, equal ones counted together). Each round is a job over all rows: a translation's expectation
depends on its own word only, so blocks of words are counted one after another
and no task or driver holds more than a block. Words that both languages write
alike are not learned, so names, which grow with the records, take no room
there. Each sentence becomes a weighted bag of words of the other
language; inverted indexes over a record's sentences retrieve the best partner
in both directions; partners that agree are matched, and matches grow by
further sentences that one of the two covers as a part. Numbers and names, and
any word that both languages write alike, translate into themselves.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.operators.latest import latest_requirements
from tenderloom.runtime import Cut, parts

#: Rounds of each time that the tables are learned, and times that this is done again on aligned sentences; a second time moved 1 of 20,365 pairs.
ROUNDS, AGAIN = 6, 1
#: Cells (word, word) that a job of a round counts at once, rows that a task pairs at once, and cells of these.
CELLS, SLICE, AT_ONCE = 8_000_000, 64, 4_000_000
#: A word of the tables occurs in this many of the records that they are learned from.
LEAST_RECORDS = 4
#: A word is alike in both languages if this share of the records that hold it on the side where it is rarer hold it on both sides,
#: and that of those where it is not: it translates into itself and is not learned.
ALIKE, LEAST_ALIKE = 0.8, 0.1
#: A translation is kept if it is this many times likelier than by chance, and at most so many a word.
LIFT, TRANSLATIONS = 4.0, 24
#: Share of a sentence's weight that its partner must cover: of the better covered one in a match, and in a growing match.
MATCH, GROW = 0.52, 0.62
#: Share of the other one that must be covered even so. A sentence of fewer words than LEAST_WORDS says too little to be matched
#: by a part: there each of the two must cover WHOLE of the other.
LEAST_COVER, LEAST_WORDS, WHOLE = 0.2, 3, 0.75

#: A sentence of so many times the median weight may be several in one. Two that are, or one of them, match if this share of
#: the other's beginning or end (SIDE to 1 - SIDE / 2 of its weight), or of all of it where it is simple, is covered.
JOINED, ENDS, SIDE = 1.35, 0.68, 0.35

END = re.compile(r"(?<=[.!?])\s+")
WORD = re.compile(r"[^\W_]+")


def sentences(text: str | None) -> list[str]:
    """The sentences of a text: each ends at ``.``, ``!`` or ``?`` before white space or the end; a rest without an end mark is one, too."""
    text = (text or "").strip()
    return END.split(text) if text else []


def bag(sentence: str) -> list[str]:
    """The distinct words of a sentence, lower-cased, in order."""
    return list(dict.fromkeys(w.lower() for w in WORD.findall(sentence)))


def itself(word: str) -> bool:
    """Whether a word stands for itself in any language: it holds a digit."""
    return any(c.isdigit() for c in word)


class Tables:
    """For each direction: word to {translation: share of certainty}; and the weight of each known word."""

    def __init__(self, forward: dict, backward: dict, weight_en: dict, weight_de: dict, unknown: float):
        self.forward, self.backward, self.weight_en, self.weight_de, self.unknown = forward, backward, weight_en, weight_de, unknown
        self.typical = (np.inf, np.inf)  # the median weight of a sentence of either language, once known
        self.coded: tuple[_Coded, _Coded] | None = None  # both directions in arrays, once needed


def _em(rows: list[tuple[list[int], list[int]]], n_from: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes from * n_to + to, probability): P(to | from) by the word translation model with an empty word 0."""
    froms, tos, groups, at = [], [], [], 0
    for a, b in rows:
        a = np.array([0, *a], np.int32)
        froms.append(np.tile(a, len(b)))
        tos.append(np.repeat(np.array(b, np.int32), len(a)))
        groups.append(at + np.arange(len(b)) * len(a))
        at += len(a) * len(b)
    start = np.concatenate(groups)
    n_to = max(int(x.max()) for x in tos) + 1
    codes = np.concatenate([a.astype(np.int64) * n_to + b for a, b in zip(froms, tos, strict=True)])
    del froms, tos
    codes, pair = np.unique(codes, return_inverse=True)
    pair = pair.astype(np.int32)
    source = codes // n_to
    p = np.ones(len(codes))
    size = np.diff(np.r_[start, len(pair)])
    for _ in range(rounds):
        w = p[pair]
        w /= np.repeat(np.add.reduceat(w, start), size)
        p = np.bincount(pair, w, len(codes))
        p /= np.bincount(source, p, n_from)[source]
    return np.stack([source, codes % n_to]), p


def _kept(found: dict[str, list]) -> dict[str, dict[str, float]]:
    return {w: {t: c for _, t, c in sorted(v, reverse=True)[:TRANSLATIONS]} for w, v in found.items()}


def _direction(rows: list[tuple[list[str], list[str]]], rounds: int, known: tuple[set, set]) -> tuple[dict, dict]:
    """({word: {translation: certainty}}, {translation: probability by chance}), of the known words that occur in LEAST_RECORDS."""
    left, right = Counter(w for a, _ in rows for w in a), Counter(w for _, b in rows for w in b)
    ids = {w: i + 1 for i, w in enumerate(sorted(w for w, n in left.items() if n >= LEAST_RECORDS and w in known[0]))}
    to = {w: i for i, w in enumerate(sorted(w for w, n in right.items() if n >= LEAST_RECORDS and w in known[1]))}
    coded = [([ids[w] for w in a if w in ids], [to[w] for w in b if w in to]) for a, b in rows]
    coded = [(a, b) for a, b in coded if a and b]
    if not coded:
        return {}, {}
    total = sum(len(b) for _, b in coded)
    chance = Counter(w for _, b in coded for w in b)
    pairs, p = _em(coded, len(ids) + 1, rounds)
    words, targets = [None, *ids], list(to)
    found: dict[str, list] = defaultdict(list)
    for a, b, x in zip(pairs[0].tolist(), pairs[1].tolist(), p.tolist(), strict=True):
        by_chance = chance[b] / total
        if a and x > LIFT * by_chance and x > 1e-3:
            found[words[a]].append((x, targets[b], x / (x + LIFT * by_chance)))
    return _kept(found), {w: chance[i] / total for w, i in to.items()}


def _tables(rows: list[tuple[list[str], list[str]]], rounds: int, known: tuple[set, set]) -> Tables:
    return _weighed(*_direction(rows, rounds, known), *_direction([(b, a) for a, b in rows], rounds, known[::-1]))


def _weighed(forward: dict, chance_de: dict, backward: dict, chance_en: dict) -> Tables:
    known_de, known_en = Counter(), Counter()
    for source, known in ((forward, known_de), (backward, known_en)):
        for v in source.values():
            for t, c in v.items():
                known[t] = max(known[t], c)
    weigh = lambda chance, known: {w: known.get(w, 0.0) * -np.log(p) for w, p in chance.items()}
    return Tables(forward, backward, weigh(chance_en, known_en), weigh(chance_de, known_de), 6.0)


def learn(records: list[tuple[str, str]], rounds: int = ROUNDS) -> Tables:
    """Translation tables from records of two texts each: first from whole records, then from the sentences these align."""
    split = [(sentences(a), sentences(b)) for a, b in records]
    bags = [(bag(" ".join(a)), bag(" ".join(b))) for a, b in split]
    left, right, alike = Counter(w for a, _ in bags for w in a), Counter(w for _, b in bags for w in b), Counter(w for a, b in bags for w in {*a} & {*b})
    known = tuple({w for w, n in c.items() if n >= LEAST_RECORDS and not itself(w) and (alike[w] < ALIKE * min(left[w], right[w]) or alike[w] < LEAST_ALIKE * max(left[w], right[w]))} for c in (left, right))
    tables = _tables(bags, rounds, known)
    for _ in range(AGAIN):
        rows = []
        for a, b in split:
            en, de = [bag(s) for s in a], [bag(s) for s in b]
            rows.extend((en[i], de[j]) for i, j in align_bags(en, de, tables))
        if not rows:
            break
        tables = _tables(rows, rounds, known)
    heavy = lambda texts, weights: np.median([sum(weights.get(w, tables.unknown) for w in bag(s)) for t in texts for s in t] or [np.inf])
    tables.typical = (heavy([a for a, _ in split], tables.weight_en), heavy([b for _, b in split], tables.weight_de))
    return tables


class _Coded:
    """The table of one direction in arrays."""

    def __init__(self, table: dict[str, dict[str, float]]):
        self.words = {w: k for k, w in enumerate(table)}
        self.targets = {t: k for k, t in enumerate(dict.fromkeys(t for v in table.values() for t in v))}
        self.size = np.array([len(v) for v in table.values()], int)
        self.at = np.cumsum(self.size) - self.size
        self.to = np.array([self.targets[t] for v in table.values() for t in v], int)
        self.share = np.array([c for v in table.values() for c in v.values()], float)

    def places(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word, and of each word as a translation; -1: the table lacks it."""
        return tuple(np.fromiter((known.get(w, -1) for w in words), int, len(words)) for known in (self.words, self.targets))

    def among(self, row: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(certainties, row of each word in them, column of each word in them); row and column 0 are of words that the table lacks."""
        ours, theirs = np.flatnonzero(row >= 0), np.flatnonzero(column >= 0)
        grid, there = np.zeros((len(ours) + 1, len(theirs) + 1)), np.zeros(len(self.targets) + 1, int)
        there[column[theirs]] = np.arange(len(theirs)) + 1
        size = self.size[row[ours]]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - self.at[row[ours]], size)
        grid[np.repeat(np.arange(len(ours)) + 1, size), there[self.to[at]]] = self.share[at]
        grid[:, 0] = 0
        rows, columns = np.zeros(len(row), int), np.zeros(len(column), int)
        rows[ours], columns[theirs] = np.arange(len(ours)) + 1, np.arange(len(theirs)) + 1
        return grid, rows, columns


class _Texts:
    """The texts of some records, each with a line a sentence and a blank between words, as arrays."""

    def __init__(self, texts: list[str]):
        lines = "\n".join(texts).split("\n")
        self.words = " ".join(lines).split()
        self.size = np.array([s.count(" ") + 1 if s else 0 for s in lines])
        self.at = np.cumsum(self.size) - self.size
        self.n = np.array([t.count("\n") + 1 for t in texts])
        self.first = np.cumsum(self.n) - self.n
        self.record = np.repeat(np.arange(len(texts)), self.n)
        self.length = np.add.reduceat(self.size, self.first)
        self.within = self.at - (np.cumsum(self.length) - self.length)[self.record]

    def heavy(self, weight: np.ndarray) -> np.ndarray:
        """The weight of each sentence, of those of its words."""
        self.weight = weight
        return np.where(self.size > 0, np.add.reduceat(np.append(weight, 0.0), self.at), 0.0)


def _weigh(words, weights: dict[str, float], unknown: float) -> np.ndarray:
    return np.fromiter((weights.get(w, unknown) for w in words), float, len(words))


def _cover(left: _Texts, right: _Texts, table: tuple[np.ndarray, np.ndarray, np.ndarray], heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(share of each right sentence's weight that each left one of its record covers, certainty of each right word by left sentence)."""
    grid, row, column = table
    wide = max(int(right.length.max()), 1)
    there = np.arange(wide) < right.length[:, None]
    code, weight, to = np.full(there.shape, -1), np.zeros(there.shape), np.zeros(there.shape, int)
    code[there], weight[there], to[there] = right.code, right.weight, column[right.code]
    of = np.repeat(left.record, left.size)
    known = grid.ravel()[(row[left.code] * grid.shape[1])[:, None] + to[of]]
    known[code[of] == left.code[:, None]] = 1.0
    best, some = np.zeros((len(left.size), wide)), np.flatnonzero(left.size)
    if len(some):
        best[some] = np.maximum.reduceat(known, left.at[some], axis=0)
    n = right.n[left.record]
    i = np.repeat(np.arange(len(n)), n)
    j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - right.first[left.record], n)
    sums = np.add.reduceat(np.append((best * weight[left.record]).ravel(), 0.0), i * wide + right.within[j])
    return np.where(right.size[j] > 0, sums, 0.0) / np.maximum(heavy[j], 1e-9), best


def _one_side(cover: np.ndarray, weight: np.ndarray, joined: bool) -> float:
    """The covered share of a sentence's weight: of a simple one as a whole, of a joined one at its better end."""
    total, best = weight.sum(), 0.0
    if not joined:
        return float((cover * weight).sum() / max(total, 1e-9))
    for w, c in ((weight, cover * weight), (weight[::-1], (cover * weight)[::-1])):
        upto, covered = np.cumsum(w), np.cumsum(c)
        ok = (upto >= SIDE * total) & (upto <= (1 - SIDE / 2) * total)
        if ok.any():
            best = max(best, float((covered[ok] / upto[ok]).max()))
    return best


def _aligned(en_texts: list[str], de_texts: list[str], tables: Tables) -> list[list[tuple[int, int]]]:
    """The pairs of each record: partners that are each other's best, then further sentences covered as a part, then joined ones with a part in common."""
    en, de = _Texts(en_texts), _Texts(de_texts)
    if tables.coded is None:
        tables.coded = _Coded(tables.forward), _Coded(tables.backward)
    code, words = pd.factorize(np.array([*en.words, *de.words], object))
    en.code, de.code = code[: len(en.words)], code[len(en.words) :]
    words = words.tolist()
    places = [c.places(words) for c in tables.coded]
    known = [(a >= 0).sum() * (b >= 0).sum() for a, b in places]
    if len(en_texts) > 1 and max(len(en.words) * de.length.max(), len(de.words) * en.length.max(), *known) > AT_ONCE:
        half = len(en_texts) // 2
        return _aligned(en_texts[:half], de_texts[:half], tables) + _aligned(en_texts[half:], de_texts[half:], tables)
    heavy_en, heavy_de = en.heavy(_weigh(words, tables.weight_en, tables.unknown)[en.code]), de.heavy(_weigh(words, tables.weight_de, tables.unknown)[de.code])
    to_de_all, by_en = _cover(en, de, tables.coded[0].among(*places[0]), heavy_de)
    to_en_all, by_de = _cover(de, en, tables.coded[1].among(*places[1]), heavy_en)
    finite = np.isfinite(tables.typical).all()
    long_en, long_de = heavy_en > JOINED * tables.typical[0], heavy_de > JOINED * tables.typical[1]

    def in_common(i: int, j: int) -> bool:
        """Whether one of two sentences is several in one, and an end of it agrees with the other or an end of that."""
        ends = ENDS if min(en.size[i], de.size[j]) > LEAST_WORDS else WHOLE
        a, b = slice(en.within[i], en.within[i] + en.size[i]), slice(de.within[j], de.within[j] + de.size[j])
        x, y = slice(en.at[i], en.at[i] + en.size[i]), slice(de.at[j], de.at[j] + de.size[j])
        return _one_side(by_en[i, b], de.weight[y], long_de[j]) >= ends and _one_side(by_de[j, a], en.weight[x], long_en[i]) >= ends

    out, at = [], 0
    for n, m, e, d in zip(en.n.tolist(), de.n.tolist(), en.first.tolist(), de.first.tolist(), strict=True):
        to_de, to_en = to_de_all[at : at + n * m].reshape(n, m), to_en_all[at : at + n * m].reshape(m, n).T
        at += n * m
        both, part, least = to_de + to_en, np.maximum(to_de, to_en), np.minimum(to_de, to_en)
        short = (en.size[e : e + n] < LEAST_WORDS)[:, None] | (de.size[d : d + m] < LEAST_WORDS)
        part[(least < LEAST_COVER) | short & (least < WHOLE)] = 0
        best_en = both.argmax(axis=0).tolist()
        pairs = {(i, j) for i, j in enumerate(both.argmax(axis=1).tolist()) if best_en[j] == i and part[i, j] >= MATCH}
        used_en, used_de = {i for i, _ in pairs}, {j for _, j in pairs}
        grown = [(part[i, j], i, j) for i, j in np.argwhere(part >= GROW).tolist() if (i in used_en) != (j in used_de)]
        for _, i, j in sorted(grown, key=lambda x: (-x[0], x[1], x[2])):
            if j not in used_de and to_de[i, j] >= GROW and to_de[i, j] == to_de[:, j].max():
                pairs.add((i, j))
            elif i not in used_en and to_en[i, j] >= GROW and to_en[i, j] == to_en[i].max():
                pairs.add((i, j))
        if finite:
            maybe = (both >= 0.5) & (long_en[e : e + n, None] | long_de[d : d + m])
            pairs |= {(i, j) for i, j in np.argwhere(maybe).tolist() if (i, j) not in pairs and in_common(e + i, d + j)}
        out.append(sorted(pairs))
    return out


def align_bags(en: list[list[str]], de: list[list[str]], tables: Tables) -> list[tuple[int, int]]:
    """Pairs of sentence numbers of one record's bags."""
    return _aligned(*(["\n".join(" ".join(s) for s in side)] for side in (en, de)), tables)[0] if en and de else []


def _align(batch: pd.DataFrame, tables: Tables) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(row, pairs) of each row of (en, de) that has sentences on both sides; rows of like length are compared together."""
    en, de = batch["en"].tolist(), batch["de"].tolist()
    rows = sorted((len(a) + len(b), k) for k, (a, b) in enumerate(zip(en, de, strict=True)) if a is not None and b is not None)
    for s in range(0, len(rows), SLICE):
        at = [k for _, k in rows[s : s + SLICE]]
        yield from zip(at, _aligned([en[k] for k in at], [de[k] for k in at], tables), strict=True)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and values of a list column."""
    off = np.asarray(column.offsets)
    return off - off[0], np.asarray(column.flatten())


def _expected(a: np.ndarray, b: np.ndarray, row: np.ndarray, n: np.ndarray, p: np.ndarray, total: np.ndarray) -> None:
    """Adds expected counts to ``total``: word b[k] of row[k] comes from one of the words a[row[k]]."""
    cells = b[:, None] + a[row]
    w = p[cells]
    w *= (n[row] / np.maximum(w.sum(axis=1), 1e-300))[:, None]
    if len(total) > 4 * cells.size:
        np.add.at(total, cells.ravel(), w.ravel())
    else:
        total += np.bincount(cells.ravel(), w.ravel(), len(total))


def _counter(shared):
    """Expected counts of the blocks (direction, lo, hi, empty word, cells, probabilities); without cells all are 1. The last of a word's cells stands for no word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, known = shared.value, []
        for _, lo, hi, empty, cells, x in blocks:
            p = np.full((hi - lo) * (empty + 2), 1.0 if cells is None else 0.0)
            if cells is None:
                p[empty + 1 :: empty + 2] = 0
            else:
                p[cells] = x
            known.append(p)
        sums = [np.zeros(len(p)) for p in known]
        for batch in batches:
            sides, n = [_lists(batch.column(c)) for c in ("a", "b")], np.asarray(batch.column("n")).astype(float)
            sizes = [np.diff(off) for off, _ in sides]
            order = np.lexsort((sizes[1], sizes[0]))
            for rows in np.split(order, range(SLICE, len(order), SLICE)):
                parts_ = []
                for (off, value), size in zip(sides, sizes, strict=True):
                    k = size[rows]
                    parts_.append((value[np.arange(k.sum()) + np.repeat(off[rows] - (np.cumsum(k) - k), k)].astype(np.int64), k))
                for (way, lo, hi, empty, *_), p, total in zip(blocks, known, sums, strict=True):
                    (a, la), (b, lb) = parts_[way], parts_[1 - way]
                    row = np.repeat(np.arange(len(lb)), lb)
                    ours = (b >= lo) & (b < hi)
                    b, row = b[ours], row[ours]
                    wide = np.full((len(la), la.max(initial=0) + 1), empty + 1)
                    wide[:, 0] = empty
                    wide[:, 1:][np.arange(wide.shape[1] - 1) < la[:, None]] = a
                    step = max(1, AT_ONCE // 4 // wide.shape[1])
                    for s in range(0, len(b), step):
                        _expected(wide, (b[s : s + step] - lo) * (empty + 2), row[s : s + step], n[rows], p, total)
        for no, total in enumerate(sums):
            cells = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([no], pa.int32()), pa.array([cells.astype(np.int32).tobytes()]), pa.array([total[cells].astype(np.float32).tobytes()])], names=["n", "cells", "x"])

    return run


def _recoder(shared):
    """Rows (a, b, n) with new numbers for words, -1 for none; rows without words on a side go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for c, new in zip(("a", "b"), shared.value, strict=True):
                off, value = _lists(batch.column(c))
                value = new[value]
                off = np.concatenate([[0], np.cumsum(value >= 0)])[off]
                sides.append((off, value[value >= 0]))
            both = pa.RecordBatch.from_arrays([*[pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(v.astype(np.int32))) for off, v in sides], batch.column("n")], names=["a", "b", "n"])
            yield both.filter(pa.array((np.diff(sides[0][0]) > 0) & (np.diff(sides[1][0]) > 0)))

    return run


ROWS = "a array<int>, b array<int>, n long"


def _fitted(rows: DataFrame, names: list[list[str]], rounds: int) -> Tables:
    """As ``_tables``, of a table (a, b, n) of the numbers of words and how often such a row occurs; one job a round and group of blocks."""
    spark, folder = rows.sparkSession, tempfile.mkdtemp(prefix="tenderloom-em-")
    context = spark.sparkContext
    count = lambda df, c: df.select(F.explode(c).alias("t"), "n").groupBy("t").agg(F.sum("n").alias("n")).collect()
    vocabulary, new = [], []
    for c, all_ in zip(("a", "b"), names, strict=True):
        held = sorted(r["t"] for r in count(rows, c) if r["n"] >= LEAST_RECORDS)
        new.append(np.full(len(all_), -1))
        new[-1][held] = np.arange(len(held))
        vocabulary.append([all_[t] for t in held])
    if not all(vocabulary):
        return _weighed({}, {}, {}, {})
    shared = context.broadcast(new)
    written = Cut(rows.mapInArrow(_recoder(shared), ROWS), "coded")
    shared.destroy()
    tasks = max(1, min(parts(spark), context.defaultParallelism))
    coded = written.df.coalesce(tasks)
    try:
        # By direction: 0 from en to de, 1 from de to en. Expected counts, a row for each word that is translated to.
        n_from, n_to = [len(v) for v in vocabulary], [len(v) for v in reversed(vocabulary)]
        counts = [np.memmap(os.path.join(folder, str(w)), np.float32, "w+", shape=(n_to[w], n_from[w] + 2)) for w in (0, 1)]
        of_source: list = [None, None]
        groups: list[list[tuple[int, int, int]]] = [[]]
        room = CELLS
        for w in (0, 1):
            step = max(1, CELLS // (n_from[w] + 2))
            for lo in range(0, n_to[w], step):
                hi = min(lo + step, n_to[w])
                if (need := (hi - lo) * (n_from[w] + 2)) > room and groups[-1]:
                    groups.append([])
                    room = CELLS
                groups[-1].append((w, lo, hi))
                room -= need
        for no in range(rounds):
            totals = [np.zeros(n + 2) for n in n_from]
            for group in groups:
                blocks = []
                for w, lo, hi in group:
                    flat = (counts[w][lo:hi] / np.maximum(of_source[w], 1e-30)).ravel().astype(np.float32) if no else None
                    cells = np.flatnonzero(flat).astype(np.int32) if no else None
                    blocks.append((w, lo, hi, n_from[w], cells, flat[cells] if no else None))
                shared = context.broadcast(blocks)
                sums = [np.zeros((hi - lo) * (n_from[w] + 2)) for w, lo, hi in group]
                for r in coded.mapInArrow(_counter(shared), "n int, cells binary, x binary").collect():
                    sums[r["n"]][np.frombuffer(r["cells"], np.int32)] += np.frombuffer(r["x"], np.float32)
                for (w, lo, hi), x in zip(group, sums, strict=True):
                    counts[w][lo:hi] = x.reshape(hi - lo, -1)
                    totals[w] += counts[w][lo:hi].sum(axis=0, dtype=float)
                shared.destroy()
            of_source = totals
        sides = []
        for w, column in ((0, "b"), (1, "a")):
            chance = np.zeros(n_to[w])
            for r in count(written.df, column):
                chance[r["t"]] = r["n"]
            chance /= max(chance.sum(), 1)
            found: dict[str, list] = defaultdict(list)
            words, targets = vocabulary[w], vocabulary[1 - w]
            for lo in range(0, n_to[w], step := max(1, CELLS // (n_from[w] + 2))):
                p = counts[w][lo : lo + step, :-2] / np.maximum(of_source[w][:-2], 1e-30)
                for b, a in zip(*np.nonzero((p > LIFT * chance[lo : lo + step, None]) & (p > 1e-3)), strict=True):
                    x = float(p[b, a])
                    found[words[a]].append((x, targets[lo + b], x / (x + LIFT * chance[lo + b])))
            sides += [_kept(found), {t: c for t, c in zip(targets, chance.tolist(), strict=True) if c}]
        return _weighed(*sides)
    finally:
        written.drop()
        shutil.rmtree(folder, True)


def _bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The texts with a line a sentence and a blank between words, null where there is no sentence."""
    for b in batches:
        lines = {c: ["\n".join(" ".join(bag(s)) for s in x) if (x := sentences(t)) else None for t in b[f"description_{c}"]] for c in ("en", "de")}
        yield pd.DataFrame({**{c: b[c] for c in b.columns if c == "id"}, **{c: pd.Series(v, b.index, dtype=object) for c, v in lines.items()}})


def _held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records of a batch that hold a word on the English side, on the German one, on both."""
    for b in batches:
        left, right, both = Counter(), Counter(), Counter()
        for x, y in zip(b["en"], b["de"], strict=True):
            x, y = {*(x or "").split()}, {*(y or "").split()}
            left.update(x)
            right.update(y)
            both.update(x & y)
        words = [*left, *(w for w in right if w not in left)]
        yield pd.DataFrame({"w": words, **{name: [c[w] for w in words] for name, c in (("en", left), ("de", right), ("both", both))}})


def _vocabulary(bags: DataFrame) -> list[list[str]]:
    """The words of either side that occur in LEAST_RECORDS, neither alike in both nor standing for themselves."""
    counted = bags.mapInPandas(_held, "w string, en long, de long, both long").filter(~F.col("w").rlike("[0-9]")).groupBy("w").agg(*[F.sum(c).alias(c) for c in ("en", "de", "both")])
    rows = counted.filter((F.greatest("en", "de") >= LEAST_RECORDS) & ((F.col("both") < ALIKE * F.least("en", "de")) | (F.col("both") < LEAST_ALIKE * F.greatest("en", "de")))).toPandas()
    return [sorted(w for w in rows["w"][rows[c] >= LEAST_RECORDS] if not itself(w)) for c in ("en", "de")]


def _coder(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = shared.value
        for b in batches:
            yield pd.DataFrame({x: [[known[w] for w in dict.fromkeys((t or "").split()) if w in known] for t in b[c]] for x, c, known in zip("ab", ("en", "de"), ids, strict=True)} | {"n": 1})

    return run


def _paired(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables, *ids = shared.value
        for b in batches:
            rows = []
            for k, pairs in _align(b, tables):
                if pairs:
                    en, de = ([[known[w] for w in s.split() if w in known] for s in b[c].iloc[k].split("\n")] for c, known in zip(("en", "de"), ids, strict=True))
                    rows.extend((en[i], de[j]) for i, j in pairs)
            yield pd.DataFrame(rows, columns=["a", "b"])

    return run


def _heavy(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = shared.value
        for b in batches:
            for c, weights in (("en", tables.weight_en), ("de", tables.weight_de)):
                if texts := [t for t in b[c] if t is not None]:
                    side = _Texts(texts)
                    yield pd.DataFrame({"side": c, "weight": side.heavy(_weigh(side.words, weights, tables.unknown))})

    return run


def learned(held: DataFrame, rounds: int = ROUNDS) -> Tables:
    """What ``learn`` gives for all rows (description_en, description_de) together, counted by the executors."""
    written = Cut(held.select("description_en", "description_de").mapInPandas(_bags, "en string, de string"), "bags")
    tables = _learned(written.df, rounds)
    written.drop()
    return tables


def _learned(bags: DataFrame, rounds: int = ROUNDS) -> Tables:
    context = bags.sparkSession.sparkContext
    bags = bags.select("en", "de")
    names = _vocabulary(bags)
    ids = [{w: k for k, w in enumerate(v)} for v in names]
    shared = context.broadcast(ids)
    written = Cut(bags.mapInPandas(_coder(shared), ROWS), "numbers")
    tables = _fitted(written.df, names, rounds)
    written.drop()
    shared.destroy()
    for _ in range(AGAIN):
        shared = context.broadcast((tables, *ids))
        written = Cut(bags.mapInPandas(_paired(shared), "a array<int>, b array<int>").groupBy("a", "b").agg(F.count("*").alias("n")), "paired")
        shared.destroy()
        none = written.df.isEmpty()
        if not none:
            tables = _fitted(written.df, names, rounds)
        written.drop()
        if none:
            break
    shared = context.broadcast(tables)
    middle = {r["side"]: r["m"] for r in bags.mapInPandas(_heavy(shared), "side string, weight double").groupBy("side").agg(F.median("weight").alias("m")).collect()}
    shared.destroy()
    tables.typical = (middle.get("en", np.inf), middle.get("de", np.inf))
    return tables


def _aligner(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = shared.value
        for b in batches:
            rows = [(b["id"].iloc[k], i, j) for k, pairs in _align(b, tables) for i, j in pairs]
            yield pd.DataFrame(rows, columns=["id", "en_no", "de_no"])

    return run


def aligned_sentences(requirements: DataFrame) -> DataFrame:
    """(id, en_no, de_no): the pairs of sentences of a requirement's two descriptions that say the same, wholly or in part.

    The valid version of each ``id`` counts; requirements without either text
    give no rows. Sentences are numbered from 0 and may be left out, moved or
    joined on either side; equal sentences of one text may share a partner. The
    tables are learned from all requirements that hold both texts. With no
    such requirement the result is empty.
    """
    valid = latest_requirements(requirements, ["id", "description_en", "description_de"]).filter("trim(description_en) <> '' and trim(description_de) <> ''")
    held = Cut(valid.mapInPandas(_bags, "id string, en string, de string"), "bilingual").df
    tables = _learned(held)
    return held.mapInPandas(_aligner(held.sparkSession.sparkContext.broadcast(tables)), "id string, en_no int, de_no int")
