"""Linking statements that share no code or text: a blocked set-overlap self-join, top candidates, verdicts, guarded merge.

A candidate pair has exactly one priced position. Pairs meet through words: the
side with fewer words indexes only its rarest ones (an overlap of at least the
threshold must include one of them), the other side all of its words.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.config import Linking
from tenderloom.functions import text as T
from tenderloom.runtime import Cut, ship

DEFAULT = Linking()


REQUIREMENT = ("source_file", "id", "source_chunk_ids", "merge_record", "bullet_point", "description_en", "description_de", "priority", "equivalence_allowed", "confidence", "standards", "referenced_annexes", "category_code", "section_heading", "item_number", "source_language", "req_order")


def token_set() -> Column:
    """The distinct words of over two characters of title and English description."""
    return F.filter(F.array_distinct(T.words(F.concat_ws(" ", "bullet_point", "description_en"), 2)), lambda w: w != "")


def group_key() -> Column:
    return F.coalesce("category_code", "section_heading", F.lit("general"))


def blocked(requirements: DataFrame, cfg: Linking = DEFAULT) -> DataFrame:
    """(source_file, block, id, req_order, is_position, tokens): one block per small tender, else one per category or section."""
    requirements = requirements.select("source_file", "id", "req_order", "item_number", "category_code", "section_heading", "bullet_point", "description_en")
    n = requirements.groupBy("source_file").agg(F.count("*").alias("_n"))
    block = F.when(F.col("_n") <= cfg.full_pairwise, F.lit("*")).otherwise(F.concat(F.lit("="), group_key()))
    return requirements.join(n, "source_file").select("source_file", block.alias("block"), "id", "req_order", T.is_position("item_number").alias("is_position"), token_set().alias("tokens"))


def candidates(requirements: DataFrame, cfg: Linking = DEFAULT) -> DataFrame:
    """(source_file, block, a_id, b_id, a_order, b_order, score): pairs of a position and another requirement of its block with an overlap coefficient of at least the threshold.

    ``a`` is the one with the lower ``req_order`` (then id). The score is the
    number of common words over the smaller number of words. Requirements
    without words pair with none.
    """
    rows = Cut(blocked(requirements, cfg).filter(F.size("tokens") > 0), "blocked").df
    words = rows.select("source_file", "block", "id", "is_position", F.size("tokens").alias("n"), F.explode("tokens").alias("word"))
    counts = words.groupBy("source_file", "block", "word").agg(F.count("*").alias("df"))
    ranked = F.array_sort(F.collect_list(F.struct("df", "word")))
    asked = F.ceil(F.col("n") * cfg.threshold)
    rare = words.join(counts, ["source_file", "block", "word"]).groupBy("source_file", "block", "id", "is_position", "n").agg(ranked.alias("r")).select("source_file", "block", F.col("id").alias("s_id"), F.col("is_position").alias("s_pos"), F.col("n").alias("s_n"), F.explode(F.slice("r", F.lit(1), (F.col("n") - asked + 1).cast("int"))).alias("w")).withColumn("word", F.col("w.word")).drop("w")
    met = rare.join(words.withColumnRenamed("id", "l_id"), ["source_file", "block", "word"]).filter((F.col("s_pos") != F.col("is_position")) & ((F.col("n") > F.col("s_n")) | ((F.col("n") == F.col("s_n")) & (F.col("l_id") > F.col("s_id"))))).select("source_file", "block", "s_id", "l_id").distinct()
    side = lambda s: rows.select("source_file", F.col("id").alias(f"{s}_id"), F.col("req_order").alias(f"{s}_order"), F.col("tokens").alias(f"{s}_tokens"))
    both = met.join(side("s"), ["source_file", "s_id"]).join(side("l"), ["source_file", "l_id"])
    common = F.size(F.array_intersect("s_tokens", "l_tokens"))
    scored = both.withColumn("score", common / F.size("s_tokens")).filter(F.col("score") >= cfg.threshold)
    one, two = F.struct(F.col("s_order").alias("o"), F.col("s_id").alias("i")), F.struct(F.col("l_order").alias("o"), F.col("l_id").alias("i"))
    return scored.withColumn("a", F.least(one, two)).withColumn("b", F.greatest(one, two)).select("source_file", "block", F.col("a.i").alias("a_id"), F.col("b.i").alias("b_id"), F.col("a.o").alias("a_order"), F.col("b.o").alias("b_order"), "score")


def top_candidates(pairs: DataFrame, requirements: DataFrame, cfg: Linking = DEFAULT) -> DataFrame:
    """The best pairs of each block, then of all blocks of a tender in order of their first requirement, up to both budgets; ``rank`` from 1."""
    best = Window.partitionBy("source_file", "block").orderBy(F.desc("score"), "a_order", "b_order", "a_id", "b_id")
    few = pairs.withColumn("in_block", F.row_number().over(best)).filter(F.col("in_block") <= cfg.per_block)
    first = blocked(requirements, cfg).groupBy("source_file", "block").agg(F.min("req_order").alias("block_order"))
    budget = Window.partitionBy("source_file").orderBy("block_order", "block", "in_block")
    return few.join(first, ["source_file", "block"]).withColumn("rank", F.row_number().over(budget)).filter(F.col("rank") <= cfg.total).drop("block_order")


def same_sides(ranked: DataFrame, verdicts: DataFrame, requirements: DataFrame) -> DataFrame:
    """(source_file, rank, id, position_id, code): the pairs judged ``same`` (either order of the ids, the relation trimmed and lower-cased)."""
    same = verdicts.filter(F.lower(T.trim("relation")) == "same").select(F.least("a_id", "b_id").alias("x"), F.greatest("a_id", "b_id").alias("y")).distinct()
    ok = ranked.withColumn("x", F.least("a_id", "b_id")).withColumn("y", F.greatest("a_id", "b_id")).join(same, ["x", "y"], "left_semi")
    side = lambda s: requirements.select("source_file", F.col("id").alias(f"{s}_id"), T.is_position("item_number").alias(f"{s}_is"), F.col("item_number").alias(f"{s}_code"))
    pick = lambda a, b: F.when(F.col("a_is"), F.col(a)).otherwise(F.col(b))
    return ok.join(side("a"), ["source_file", "a_id"]).join(side("b"), ["source_file", "b_id"]).select("source_file", "rank", pick("b_id", "a_id").alias("id"), pick("a_id", "b_id").alias("position_id"), pick("a_code", "b_code").alias("code"))


def linked(ranked: DataFrame, verdicts: DataFrame, requirements: DataFrame) -> DataFrame:
    """(source_file, id, position_id): each requirement without a position, with the position of its best-ranked pair judged ``same``.

    This decides the code of every statement. It tells nothing of further
    positions that bear the same code; ``united`` brings these in, too.
    """
    return same_sides(ranked, verdicts, requirements).groupBy("source_file", "id").agg(F.min_by("position_id", "rank").alias("position_id"))


def _groups(edges: pd.DataFrame) -> pd.DataFrame:
    """The members of a tender's groups, each with the least position of its group."""
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(edges["id"], edges["position_id"], strict=True):
        parent[find(a)] = find(b)
    least: dict[str, str] = {}
    for p in edges["position_id"]:
        least[find(p)] = min(p, least.get(find(p), p))
    rows = [(edges["source_file"].iloc[0], x, least[find(x)]) for x in list(parent)]
    return pd.DataFrame(rows, columns=["source_file", "id", "position_id"])


def united(ranked: DataFrame, verdicts: DataFrame, requirements: DataFrame) -> DataFrame:
    """(source_file, id, position_id): all members of the groups of requirements judged ``same``, positions included, with the least position of the group.

    Equals uniting the pairs in order of rank unless two distinct codes would
    meet: the first pair of a statement always unites and gives it its code, and
    every later one unites if its position bears that code. A tender has no more
    pairs than the budget allows, so its groups are found in one task.
    """
    ship(ranked.sparkSession)
    sides = same_sides(ranked, verdicts, requirements)
    sides = sides.withColumn("first", F.first("code").over(Window.partitionBy("source_file", "id").orderBy("rank"))).filter("code = first")
    return sides.select("source_file", "id", "position_id").groupBy("source_file").applyInPandas(_groups, "source_file string, id string, position_id string")


def guarded(links: DataFrame, requirements: DataFrame) -> DataFrame:
    """The links of the groups that hold at most one position code: a last look before groups become one requirement each. Members of others stay apart."""
    codes = requirements.filter(T.is_position("item_number")).select("source_file", "id", "item_number")
    held = links.join(codes, ["source_file", "id"], "left").groupBy("source_file", "position_id").agg(F.min("item_number").alias("low"), F.max("item_number").alias("high"))
    return links.join(held.filter(F.col("low").isNull() | (F.col("low") == F.col("high"))).select("source_file", "position_id"), ["source_file", "position_id"], "left_semi").select("source_file", "id", "position_id")


def merge_linked(requirements: DataFrame, links: DataFrame) -> DataFrame:
    """The requirements with every linked group as one.

    Texts are joined in order without repeats, lists united, priority the
    strongest, confidence the weakest, equivalence the first that is known;
    title and codes come from the first position; the id is the least of the group.
    Requirements outside any group are unchanged.
    """
    root = requirements.select(*REQUIREMENT).join(links.select("source_file", "id", "position_id"), ["source_file", "id"], "left").withColumn("root", F.coalesce("position_id", "id")).drop("position_id")
    order = F.struct("req_order", "id")
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("req_order", "id", F.col(c).alias("v")))), lambda r: r["v"])
    first = F.min_by(F.struct("bullet_point", "category_code", "section_heading", "item_number", "source_language"), F.struct((~T.is_position("item_number")).alias("p"), F.when(~T.is_position("item_number"), -F.length("description_en")).otherwise(0).alias("l"), "req_order", "id"))

    def once(c: Column) -> Column:
        start = F.struct(F.array().cast("array<string>").alias("parts"), F.array().cast("array<string>").alias("seen"))
        step = lambda acc, v: F.when(v.isNull() | (T.folded(v) == "") | F.array_contains(acc["seen"], T.folded(v)), acc).otherwise(F.struct(F.concat(acc["parts"], F.array(T.trim(v))).alias("parts"), F.concat(acc["seen"], F.array(T.folded(v))).alias("seen")))
        return F.aggregate(c, start, step, lambda acc: acc["parts"])

    g = root.groupBy("source_file", "root").agg(
        F.count("*").alias("n"), F.min("id").alias("new_id"), first.alias("rep"), F.min("req_order").alias("req_order"), F.max(T.rank("priority", "priority")).alias("p"), F.min(F.coalesce(T.rank("confidence", "confidence"), F.lit(3))).alias("c"),
        F.min_by("equivalence_allowed", F.when(F.col("equivalence_allowed").isNotNull(), order)).alias("equivalence_allowed"), F.min_by("merge_record", order).alias("record"),
        *[ordered(c).alias(f"_{c}") for c in ("bullet_point", "description_en", "description_de", "source_chunk_ids", "standards", "referenced_annexes", "merge_record")],
        F.min_by(F.struct("description_en", "description_de", "priority", "confidence", "source_chunk_ids", "standards", "referenced_annexes"), order).alias("own"),
    )
    many = F.col("n") > 1
    flat = lambda c: F.array_distinct(F.flatten(c))
    de = once(F.col("_description_de"))
    record = F.struct(F.lit("semantic-link").alias("rule"), F.lit("medium").alias("merge_confidence"), F.flatten(F.transform("_merge_record", lambda m: m["evidence_links"])).alias("evidence_links"), F.concat(F.lit("Linked as one: "), F.array_join("_bullet_point", " + ")).alias("why_merged"))
    pick = lambda new, own: F.when(many, new).otherwise(own)
    return g.select(
        "source_file", F.col("new_id").alias("id"), F.col("n").alias("n_members"), pick(flat("_source_chunk_ids"), F.col("own.source_chunk_ids")).alias("source_chunk_ids"), pick(record, F.col("record")).alias("merge_record"), "rep.bullet_point",
        pick(F.array_join(once(F.col("_description_en")), "\n\n"), F.col("own.description_en")).alias("description_en"), pick(F.when(F.size(de) > 0, F.array_join(de, "\n\n")), F.col("own.description_de")).alias("description_de"),
        pick(T.unrank(F.coalesce("p", F.lit(1)), "priority"), F.col("own.priority")).alias("priority"), "equivalence_allowed", pick(T.unrank(F.col("c"), "confidence"), F.col("own.confidence")).alias("confidence"),
        pick(flat("_standards"), F.col("own.standards")).alias("standards"), pick(flat("_referenced_annexes"), F.col("own.referenced_annexes")).alias("referenced_annexes"), "rep.category_code", "rep.section_heading", "rep.item_number", "rep.source_language", "req_order",
    )


def pair_message(a_title: Column, a_text: Column, b_title: Column, b_text: Column) -> Column:
    """Two requirements as the text a judge is shown, descriptions clipped."""
    return F.concat_ws("\n", F.lit("Requirement A:"), F.concat(F.lit("Title: "), a_title), T.clipped(a_text), F.lit(""), F.lit("Requirement B:"), F.concat(F.lit("Title: "), b_title), T.clipped(b_text))
