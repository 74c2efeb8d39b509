"""Mixing sources to target weights by cube-method balanced sampling.

Every document of a source is due the same number of copies. The whole part is
given to all of them; the fractional part becomes an inclusion probability, and
the cube method rounds these probabilities so that the tokens and the number
of documents of the source stay what they were: in a flight, the probabilities
of three documents at a time are moved along the null space of the two
constraints until one of them is 0 or 1. A flight over a block ends with at
most two open documents; those of all blocks fly again, until one block per
source is left, whose last LANDING and two are landed by the rounding closest
to the target. Blocks are of bounded size, so a source with most of the documents is
many tasks.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom.runtime import Cut, ship

#: The vocabulary file of a public tokenizer, unless named in the environment; the driver hands it to the workers.
TOKENIZER = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: How that vocabulary splits a text before merging; the published pattern of its tokenizer.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
BLOCK = 20_000
EPSILON = 1e-9
#: Documents of a source that the flight leaves to the landing, which tries every rounding of them.
LANDING = 12
#: Longest piece that is handed to the tokenizer at once; texts are cut before white space.
PIECE = 100_000


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("mix", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PIECE:
        to = text.rfind(" ", at + 1, at + PIECE)
        to = to if to > at else at + PIECE
        yield text[at:to]
        at = to
    yield text[at:]


def _counter(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = _encoding(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))
        for b in batches:
            b["tokens"] = np.array([sum(len(encoding.encode_ordinary(p)) for p in _pieces(t)) if t else 0 for t in b["text"]], np.int64)
            yield b[["doc_id", "source", "tokens"]]

    return run


def tidy(source: str) -> Column:
    """Column: a source's tidy spelling: trimmed, lower case, words joined by underscores."""
    return F.regexp_replace(F.lower(F.regexp_replace(source, r"(?U)^\s+|\s+\z", "")), r"(?U)[\s-]+", "_")


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, tokens): the tidy source and the size of each document; a null or empty text has 0 tokens."""
    ship(documents.sparkSession)
    documents.sparkSession.sparkContext.addFile(tokenizer)
    return documents.select("doc_id", tidy("source").alias("source"), "text").mapInPandas(_counter(tokenizer), "doc_id long, source string, tokens long")


def fly(p: np.ndarray, size: np.ndarray, seed: int, keep: int = 0) -> np.ndarray:
    """The flight phase: ``p`` with all but at most ``keep`` and two entries moved to 0 or 1, keeping sum(p) and sum(p * size)."""
    p = p.astype(float).copy()
    draws = iter(np.random.default_rng(seed).random(len(p) + 3).tolist())
    open_ = np.flatnonzero((p > EPSILON) & (p < 1 - EPSILON)).tolist()
    waiting = iter(open_[: max(0, len(open_) - keep)])
    live: list[int] = []
    while True:
        while len(live) < 3 and (i := next(waiting, None)) is not None:
            live.append(i)
        if len(live) == 2 and size[live[0]] == size[live[1]]:
            i, j = live
            u = (1.0, -1.0)
        elif len(live) == 3:
            a, b, c = (float(size[i]) for i in live)
            u = (b - c, c - a, a - b) if not a == b == c else (1.0, -1.0, 0.0)
        else:
            break
        ahead = min(((1 - p[i]) / x if x > 0 else p[i] / -x) for i, x in zip(live, u, strict=True) if x)
        back = min((p[i] / x if x > 0 else (1 - p[i]) / -x) for i, x in zip(live, u, strict=True) if x)
        step = ahead if next(draws) * (ahead + back) < back else -back
        for i, x in zip(live, u, strict=True):
            p[i] += step * x
            if p[i] < EPSILON:
                p[i] = 0.0
            elif p[i] > 1 - EPSILON:
                p[i] = 1.0
        live = [i for i in live if 0 < p[i] < 1]
    return p


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The landing phase: the rounding of the last open entries that changes sum(p * size) least, then sum(p)."""
    open_ = np.flatnonzero((p > EPSILON) & (p < 1 - EPSILON))
    ways = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    off = ways - p[open_]
    best = np.lexsort((np.abs(off.sum(axis=1)), np.abs(off @ size[open_])))[0]
    out = p.copy()
    out[open_] = ways[best]
    return np.round(out)


def _flight(landing: bool, seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["turn", "doc_id"], ignore_index=True)
        p, size = rows["p"].to_numpy(), rows["tokens"].to_numpy(float)
        moved = fly(p, size, seed + int(rows["block"].iloc[0]), LANDING if landing else 0)
        rows["p"] = land(moved, size) if landing else moved
        return rows[["doc_id", "source", "tokens", "turn", "p"]]

    return run


def plan(counts: DataFrame, targets: DataFrame) -> list[dict]:
    """Per target source: documents, tokens and the copies each document is due.

    The mixture is as large as the scarcest source allows at ``max_repeats``.
    A source without tokens can't give its share; the others share it in
    proportion. ``targets`` is small by nature (a row per source) and is
    collected, with one row per source of the totals joined to it.
    """
    have = counts.groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"))
    wanted = targets.select(tidy("source").alias("source"), F.col("target_share").cast("double").alias("share"), F.col("max_repeats").cast("long").alias("most")).filter("share > 0 and source is not null")
    wanted = wanted.groupBy("source").agg(F.sum("share").alias("share"), F.max("most").alias("most"))
    rows = [r.asDict() for r in wanted.join(have, "source", "left").orderBy("source").collect()]
    able = [r for r in rows if (r["tokens"] or 0) > 0 and (r["most"] or 0) > 0]
    total = sum(r["share"] for r in able)
    size = min((r["most"] * r["tokens"] * total / r["share"] for r in able), default=0.0)
    for r in rows:
        r["due"] = min(float(r["most"]), r["share"] / total * size / r["tokens"]) if r in able else 0.0
    return rows


def mixture(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """(doc_id, source, tokens, copies): the documents of the mixture and how often each is used, at most ``max_repeats``.

    Documents with a null id or source, or of a source without a target, are
    left out; an empty text weighs nothing and follows its source. Of repeated
    rows of a ``doc_id`` the one with most tokens counts, of equal ones that of
    the greatest source; texts are never shuffled. The draw is fixed by ``seed`` and the ids,
    whatever the partitioning.
    """
    spark = documents.sparkSession
    counted = token_counts(documents.filter("doc_id is not null and source is not null"), tokenizer)
    counts = Cut(counted.groupBy("doc_id").agg(F.max(F.struct("tokens", "source")).alias("r")).select("doc_id", "r.source", "r.tokens"), "tokens").df
    rows = plan(counts, targets)
    due = spark.createDataFrame([(r["source"], float(r["due"])) for r in rows if r["due"] > 0], "source string, due double")
    whole = F.floor(F.col("due") + EPSILON)
    base = counts.join(F.broadcast(due), "source").withColumn("sure", whole).withColumn("p", F.greatest(F.lit(0.0), F.col("due") - whole)).withColumn("turn", F.xxhash64(F.lit(seed), "doc_id"))
    flying = base.filter(F.col("p") > EPSILON).select("doc_id", "source", "tokens", "turn", "p")
    most = max((r["docs"] for r in rows if r["due"] > 0), default=0)
    schema = "doc_id long, source string, tokens long, turn long, p double"
    settled: DataFrame | None = None
    open_ = flying
    while most:
        n = -(-most // block)
        flown = Cut(open_.withColumn("block", F.pmod("turn", F.lit(n))).groupBy("source", "block").applyInPandas(_flight(n == 1, seed), schema), "flight").df
        done = flown.filter("p = 0 or p = 1")
        settled = done if settled is None else settled.unionByName(done)
        if n == 1:
            break
        open_, most = flown.filter("p > 0 and p < 1"), 2 * n
    drawn = base.select("doc_id", "source", "tokens", "sure")
    if settled is not None:
        drawn = drawn.join(settled.select("doc_id", F.col("p").alias("extra")), "doc_id", "left")
        copies = F.col("sure") + F.coalesce("extra", F.lit(0.0))
    else:
        copies = F.col("sure")
    return drawn.select("doc_id", "source", "tokens", copies.cast("int").alias("copies")).filter("copies > 0")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, reached_share, tokens, documents, most_copies) for each source of ``targets`` or the mixture."""
    got = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("documents"), F.max("copies").alias("most_copies"))
    total = got.agg(F.sum("tokens").alias("total")).withColumn("all_of", F.lit(1))
    wanted = targets.select(tidy("source").alias("source"), "target_share").filter("source is not null").groupBy("source").agg(F.sum("target_share").alias("target_share"))
    out = wanted.join(got, "source", "full").withColumn("all_of", F.lit(1)).join(F.broadcast(total), "all_of", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return out.select("source", zero("target_share").cast("double").alias("target_share"), F.coalesce(F.try_divide("tokens", "total"), F.lit(0.0)).alias("reached_share"), zero("tokens").cast("long").alias("tokens"), zero("documents").cast("long").alias("documents"), zero("most_copies").cast("int").alias("most_copies"))
