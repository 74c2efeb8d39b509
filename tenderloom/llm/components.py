"""Consolidating pairwise matches into groups: connected components by alternating
large-star and small-star edge rewrites.

An edge set over dense integer labels is rewritten until nothing changes:

* large-star: every node links its larger neighbours to the least of its
  neighbourhood (itself included);
* small-star: every node links its smaller neighbours and itself to the least
  of them.

Both keep the components and end in one star per component around its least
label. Each rewrite is one aggregation (the least neighbour per node, combined
map-side, so a node with a third of all edges is one row per task) and one join
of the edges with it. Nodes of very high degree are few by arithmetic (at most
``edges / bound`` can have degree ``bound``), so they are joined by broadcast
and the rest by shuffle: no join partition ever holds a hot node's edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tenderloom.runtime import Cut

#: At most this many nodes, times two, can be hot: a node is hot from 2 * edges / HOT_NODES edges on.
HOT_NODES = 2_000
MIN_HOT_DEGREE = 10_000


def _attach_least(directed: DataFrame, least: DataFrame, edges: int) -> DataFrame:
    """``directed`` (u, v) with the least label ``m`` of u's neighbourhood; hot u by broadcast."""
    hot = max(MIN_HOT_DEGREE, 2 * edges // HOT_NODES)
    if 2 * edges < MIN_HOT_DEGREE:
        return directed.join(least.select("u", "m"), "u")
    near = directed.join(F.broadcast(least.filter(F.col("deg") >= hot).select("u", F.col("m").alias("hot_m"))), "u", "left")
    done = near.filter(F.col("hot_m").isNotNull()).select("u", "v", F.col("hot_m").alias("m"))
    rest = near.filter(F.col("hot_m").isNull()).select("u", "v").join(least.filter(F.col("deg") < hot).select("u", "m"), "u")
    return done.unionByName(rest)


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("deg"))
    linked = _attach_least(both, least, 2 * n).filter("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("deg"))
    linked = _attach_least(down, least, n).select(F.col("v").alias("u"), F.col("m").alias("v"))
    selves = least.select("u", F.col("m").alias("v"))
    return linked.unionByName(selves).filter("u <> v").distinct()


def _written(edges: DataFrame) -> tuple[Cut, tuple]:
    """``edges`` written to the shared folder, with their number and a sum of hashes, taken on the way.

    Should a lost executor make the sums count a task twice, the only effect
    is one round more.
    """
    seen = Observation()
    out = Cut(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), "star")
    got = seen.get
    return out, (got.get("n") or 0, got.get("h"))


def star_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u bigint, v bigint), ``root`` the least node of its component.

    Self-loops and repeated edges are ignored (a node with only a self-loop has
    no row), rows with a null are dropped, an empty input gives an empty result.
    The number of rounds grows with the logarithm of the longest chain; the
    edges of each round are written to the shared folder and those of the round
    before are deleted, so the disk holds two rounds.
    """
    now, state = _written(edges.filter("u <> v").select(F.col("u").cast("long"), F.col("v").cast("long")).distinct())
    while state[0]:
        large = Cut(_large_star(now.df, state[0]), "star")
        small, after = _written(_small_star(large.df, state[0]))
        large.drop()
        now.drop()
        now, before, state = small, state, after
        if state == before:
            break
    roots = now.df.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.df.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def consolidate(records: DataFrame, pairs: DataFrame, key: str = "id", shared: str | None = None) -> DataFrame:
    """(``key``, ``group_id``) for every record in a group of two or more.

    ``records`` has one row per ``key`` (repeated and null keys are ignored);
    ``pairs`` has the columns ``a`` and ``b``, matched keys in either order.
    ``shared`` names an array column of ``records``: records with a common
    entry are matched too, each to the least record of the entry, so an entry
    in a third of all records costs one edge per record. Null entries and null
    arrays match nothing. Pairs that name an unknown or null key, or a key with
    itself, match nothing. ``group_id`` is the least key of the group by code
    point. Labels are ranks of the sorted keys, so least label and least key
    agree and rounds move 16 bytes an edge instead of two keys.
    """
    keyed = records.filter(F.col(key).isNotNull()).select(F.col(key).alias("k"), *([F.col(shared).alias("entries")] if shared else []))
    rank = Cut(keyed.select("k").distinct().orderBy("k").withColumn("n", F.monotonically_increasing_id()), "rank").df
    one, two = rank.select(F.col("k").alias("a"), F.col("n").alias("u")), rank.select(F.col("k").alias("b"), F.col("n").alias("v"))
    edges = pairs.filter("a <> b").select("a", "b").distinct().join(one, "a").join(two, "b").select("u", "v")
    if shared:
        entry = keyed.select("k", F.explode(F.array_distinct("entries")).alias("entry")).filter("entry is not null")
        member = entry.join(rank, "k").select("entry", "n")
        least = member.groupBy("entry").agg(F.min("n").alias("v"), F.count("*").alias("deg")).filter("deg > 1")
        edges = edges.unionByName(member.join(least, "entry").select(F.col("n").alias("u"), "v"))
    found = star_components(edges).select(F.col("node").alias("n"), "root")
    name = rank.select(F.col("n").alias("root"), F.col("k").alias("least"))
    return rank.join(found, "n").join(name, "root").select(F.col("k").alias(key), F.col("least").alias("group_id"))


def requirement_groups(requirements: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(id, group_id) of the requirements linked by a ``same`` verdict or a common source chunk.

    The valid version of a requirement is the one with the latest
    ``updated_at``. ``relation`` counts as ``same`` once trimmed of white space
    and lower-cased; null relations don't.
    """
    from tenderloom.operators.latest import latest_requirements

    valid = latest_requirements(requirements, ["id", "source_chunk_ids"])
    same = verdicts.filter(F.lower(F.regexp_replace("relation", r"(?U)^\s+|\s+\z", "")) == "same")
    return consolidate(valid, same.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")), "id", "source_chunk_ids")
