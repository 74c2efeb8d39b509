"""Evaluation texts leaking into training text, by greedy string tiling.

Passages of at least MIN_WORDS consecutive words that a document and an item
have in common are found by shared seeds (runs of that many words) and covered
with tiles: the longest common run is marked first, then the longest of what is
left, without overlap in either text, so passages in another order still count.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sized
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.runtime import Cut, fits, ship

MIN_WORDS = 12
#: Items up to this many are broadcast (their text is then measured, too); more are met through a join of seeds.
BROADCAST_ITEMS, BROADCAST_CHARS = 20_000, 20_000_000
WORD = re.compile(r"[^\W_]+")
BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    return [w.lower() for w in WORD.findall(text)] if text else []


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin values, modulo 2^64, of the runs of ``n`` ids."""
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(ids) - n + 1, np.uint64)
        for i in range(n):
            out = out * BASE + ids[i : len(ids) - n + 1 + i]
    return out


def runs(starts: Iterable[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """(place in doc, place in item, length): the longest common runs behind pairs of places, given in order of the first, from which ``least`` words agree.

    Pairs that follow each other on a diagonal are one run, so a text and an
    item of one repeated word give a run for each diagonal, not for each pair.
    """
    open_: dict[int, list[int]] = {}
    done = []
    for a, b in starts:
        held = open_.get(b - a)
        if held and held[0] + held[2] - least + 1 == a:
            held[2] += 1
        else:
            if held:
                done.append(tuple(held))
            open_[b - a] = [a, b, least]
    return done + [tuple(x) for x in open_.values()]


def tiles(doc: Sized, item: Sized, starts: Iterable[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """(place in doc, place in item, length): greedy non-overlapping common runs of at least ``least``, longest first.

    ``starts`` are as for ``runs``. Ties go to the earlier place in the
    document, then in the item. A run is cut to what is left of it only when it
    comes up, for what is left is never longer.
    """
    todo = [(-n, a, b) for a, b, n in runs(starts, least)]
    heapify(todo)
    used_doc, used_item, found = np.zeros(len(doc), bool), np.zeros(len(item), bool), []
    while todo:
        n, a, b = heappop(todo)
        n = -n
        free = ~(used_doc[a : a + n] | used_item[b : b + n])
        if free.all():
            found.append((a, b, n))
            used_doc[a : a + n] = used_item[b : b + n] = True
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], free.view(np.int8), [0]])))
        for i, j in edge.reshape(-1, 2).tolist():
            if j - i >= least:
                heappush(todo, (i - j, a + i, b + i))
    return sorted(found)


class Items:
    """The held-out items, with an index of their seeds."""

    def __init__(self, rows: list[tuple[int, str]], least: int):
        self.least = least
        self.vocabulary: dict[str, int] = {}
        self.words = {k: words(t) for k, t in rows}
        self.seeds: dict[int, list[tuple[int, int]]] = defaultdict(list)
        mixed = np.random.default_rng(1).integers(1, 2**63, size=1 << 16, dtype=np.int64).astype(np.uint64)
        for ws in self.words.values():
            for w in ws:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.ids = {k: np.array([self.vocabulary[w] for w in ws], np.uint64) for k, ws in self.words.items()}
        self.mixed = mixed
        for k, ids in self.ids.items():
            for i, h in enumerate(rolling(self.spread(ids), least).tolist()):
                self.seeds[h].append((k, i))
        self.sorted = np.array(sorted(self.seeds), np.uint64)

    def spread(self, ids: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (ids ^ self.mixed[(ids & np.uint64(0xFFFF)).astype(np.int64)]) * BASE

    def matches(self, text: str | None) -> Iterator[tuple[int, int, int, int]]:
        """(item, words of the item that are covered, longest tile, tiles) of each item that leaks into ``text``."""
        ws = words(text)
        ids = np.array([self.vocabulary.get(w, 0) for w in ws], np.uint64)
        if len(ids) < self.least or not len(self.sorted):
            return
        h = rolling(self.spread(ids), self.least)
        at = np.searchsorted(self.sorted, h)
        places = np.flatnonzero(self.sorted[np.minimum(at, len(self.sorted) - 1)] == h)
        starts: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for p in places.tolist():
            for k, i in self.seeds[int(h[p])]:
                if np.array_equal(ids[p : p + self.least], self.ids[k][i : i + self.least]):
                    starts[k].append((p, i))
        for k, s in starts.items():
            found = tiles(ids, self.ids[k], s, self.least)
            yield k, sum(n for *_, n in found), max(n for *_, n in found), len(found)


LEAKS = "doc_id long, item_id long, covered_words int, item_words int, longest int, tiles int"
_NAMES = [c.split()[0] for c in LEAKS.split(", ")]


def _against(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = shared.value
        for b in batches:
            rows = [(d, k, c, len(items.words[k]), m, n) for d, t in zip(b["doc_id"], b["text"], strict=True) for k, c, m, n in items.matches(t)]
            yield pd.DataFrame(rows, columns=_NAMES)

    return run


def _pairs(least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for d, t, k, u in zip(b["doc_id"], b["text"], b["item_id"], b["item_text"], strict=True):
                item = Items([(k, u)], least)
                rows.extend((d, k, c, len(item.words[k]), m, n) for _, c, m, n in item.matches(t))
            yield pd.DataFrame(rows, columns=_NAMES)

    return run


def _seeds(df: DataFrame, key: str, least: int) -> DataFrame:
    ws = F.transform(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+"), 0), F.lower)
    listed = df.select(key, ws.alias("w")).filter(F.size("w") >= least)
    return listed.select(key, F.explode(F.array_distinct(F.transform(F.sequence(F.lit(0), F.size("w") - least), lambda i: F.xxhash64(F.slice("w", i + 1, F.lit(least)))))).alias("seed"))


def leaks(documents: DataFrame, items: DataFrame, least: int = MIN_WORDS, broadcast: bool | None = None) -> DataFrame:
    """One row per document and item with at least ``least`` consecutive words in common.

    A word is a longest run of letters or digits, lower-cased.
    ``covered_words`` is the number of the item's words under the tiles,
    ``longest`` the longest tile. Null and short texts match nothing. Every
    text of a repeated ``doc_id`` counts: the row comes from the one of them
    that covers the item best (most covered words, then the longest tile, then
    the most tiles). Of a repeated ``item_id`` the greatest text counts. The
    items are broadcast if a look at their number and size allows it (or as
    ``broadcast`` says); the documents are then read in one narrow pass.
    Otherwise distinct seeds of both sides are joined, so a seed in a third of
    all documents is spread by adaptive skew handling, and all texts of the
    pairs that met are tiled. Both ways give the same rows.
    """
    spark = documents.sparkSession
    ship(spark)
    held = items.filter("item_id is not null and text is not null").groupBy("item_id").agg(F.max("text").alias("text"))
    docs = documents.filter("doc_id is not null and text is not null").select("doc_id", "text")
    if broadcast is None:
        broadcast = fits(held, BROADCAST_ITEMS) and (held.agg(F.sum(F.length("text"))).first()[0] or 0) <= BROADCAST_CHARS
    if broadcast:
        index = Items([(r["item_id"], r["text"]) for r in held.collect()], least)
        found = docs.mapInPandas(_against(spark.sparkContext.broadcast(index)), LEAKS)
    else:
        met = Cut(_seeds(docs, "doc_id", least).join(_seeds(held, "item_id", least), "seed").select("doc_id", "item_id").distinct(), "met").df
        both = met.join(docs.distinct(), "doc_id").join(held.withColumnRenamed("text", "item_text"), "item_id")
        found = both.select("doc_id", "text", "item_id", "item_text").mapInPandas(_pairs(least), LEAKS)
    best = F.max(F.struct("covered_words", "longest", "tiles", "item_words")).alias("r")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", *[F.col(f"r.{c}") for c in _NAMES[2:]])


def leaked_coverage(found: DataFrame, least_share: float = 0.5) -> DataFrame:
    """Of ``leaks``: per document the items it leaks, and those of which at least ``least_share`` is covered by tiles."""
    share = F.col("covered_words") / F.col("item_words")
    return found.groupBy("doc_id").agg(F.count("*").alias("n_items"), F.count_if(share >= least_share).alias("n_mostly_leaked"), F.max("longest").alias("longest"))
