"""Scoring of extracted leaves against verified facts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.functions import text as T
from tenderloom.runtime import ship

#: Facts that are held in memory at once; more are taken in blocks of about so many.
FACTS = 10_000


class Phrases:
    """Which of some facts a text names: all their phrases are looked for in one pass over it."""

    def __init__(self, facts: list[tuple]):
        self.facts = facts
        of: dict[str, list[int]] = {}
        for i, (_, context, *_) in enumerate(facts):
            for c in context or ():
                if c is not None:
                    of.setdefault(c.lower(), []).append(i)
        self.always, self.of = of.pop("", []), of
        try:
            import ahocorasick
        except ImportError:  # slower, same facts
            self.tree = None
        else:
            self.tree = ahocorasick.Automaton()
            for phrase in of:
                self.tree.add_word(phrase, phrase)
            self.tree.make_automaton()

    def named(self, text: str) -> set[int]:
        if self.tree is None:
            met = (p for p in self.of if p in text)
        else:
            met = {p for _, p in self.tree.iter(text)} if len(self.of) else ()
        return {i for p in met for i in self.of[p]} | set(self.always)


def _against(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        phrases = Phrases(shared.value)
        for b in batches:
            rows = []
            for text, known in zip(b["text"], b["equivalence_allowed"], strict=True):
                if text is None:
                    continue
                for i in phrases.named(text):
                    no, _, values, asked = phrases.facts[i]
                    rows.append((no, values is not None and all(v is not None and v.lower() in text for v in values) and (asked is None or (known is not None and bool(known) == asked))))
            yield pd.DataFrame(rows, columns=["no", "whole"])

    return run


def score(leaves: DataFrame, facts: DataFrame) -> DataFrame:
    """(fact_id, n_named, n_complete, found): how many leaves a fact's context names, and how many of these hold all its values.

    ``leaves`` has id, text (all languages) and equivalence_allowed; ``facts``
    has fact_id, context and values (arrays) and equivalence (boolean or null).
    A leaf is named if its folded text holds any context phrase; a value counts
    if the text holds it as written. A fact without values asks for a named
    leaf only; null phrases name nothing, a null value is never held. Facts are
    the stated query set that every leaf is held against: they are broadcast in
    blocks of about FACTS, one narrow pass over the leaves each.
    """
    spark = leaves.sparkSession
    ship(spark)
    texts = leaves.select(T.folded("text").alias("text"), "equivalence_allowed")
    numbered = facts.select(F.xxhash64(F.col("fact_id").cast("string")).alias("no"), "context", "values", "equivalence")
    blocks = -(-max(1, facts.count()) // FACTS)
    hits: DataFrame | None = None
    for block in range(blocks):
        held = [tuple(r) for r in numbered.filter(F.pmod("no", F.lit(blocks)) == block).collect()]
        found = texts.mapInPandas(_against(spark.sparkContext.broadcast(held)), "no long, whole boolean").groupBy("no").agg(F.count("*").alias("n_named"), F.count_if("whole").alias("n_complete"))
        hits = found if hits is None else hits.unionByName(found)
    out = facts.select("fact_id", F.xxhash64(F.col("fact_id").cast("string")).alias("no")).join(hits, "no", "left")
    return out.select("fact_id", F.coalesce("n_named", F.lit(0)).alias("n_named"), F.coalesce("n_complete", F.lit(0)).alias("n_complete"), (F.coalesce("n_complete", F.lit(0)) > 0).alias("found"))
