"""What a model decides beyond extraction: whether two requirements are one, and how those of a tender are grouped.

Replies that can't be read are never an answer: a pair stays apart, a tender
keeps its mechanical groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.operators import link, tree
from tenderloom.operators.provider import Provider, ask
from tenderloom.plans import prompts
from tenderloom.runtime import Cut

#: Requirements of a tender that are grouped by their number in one message, and themes such a reply may have.
INLINE_LIMIT, THEMES = 150, 12
#: Failed calls in a row after which a tender's further pairs stay apart.
GIVE_UP = 3


def verdicts(ranked: DataFrame, requirements: DataFrame, model: Provider) -> tuple[DataFrame, DataFrame]:
    """(verdicts, replies): (a_id, b_id, relation, reason) of the ranked candidate pairs whose reply could be read.

    Calls of a tender go out together; the outcome is that of asking in order
    of rank and giving up after GIVE_UP failures in a row: pairs ranked behind
    these have no verdict.
    """
    side = lambda s: requirements.select("source_file", F.col("id").alias(f"{s}_id"), F.col("bullet_point").alias(f"{s}_title"), F.col("description_en").alias(f"{s}_text"))
    pairs = ranked.select("source_file", "rank", "a_id", "b_id").join(side("a"), ["source_file", "a_id"]).join(side("b"), ["source_file", "b_id"])
    message = link.pair_message(*[F.col(c) for c in ("a_title", "a_text", "b_title", "b_text")])
    asked = Cut(pairs.select("source_file", "rank", "a_id", "b_id", F.concat_ws("\x1f", "source_file", F.col("rank").cast("string")).alias("key"), message.alias("message")), "pairs").df
    replies = Cut(ask(asked.select("key", "message"), model, prompts.JUDGE), "verdicts").df
    told = F.try_parse_json("reply")
    read = asked.drop("message").join(replies.select("key", F.lower(F.trim(F.try_variant_get(told, "$.relation", "string"))).alias("relation"), F.try_variant_get(told, "$.reason", "string").alias("reason")), "key")
    order = Window.partitionBy("source_file").orderBy("rank")
    failed = F.col("relation").isNull()
    run = failed
    for back in range(1, GIVE_UP):
        run = run & F.coalesce(F.lag(failed.cast("int"), back).over(order) == 1, F.lit(False))
    upto = F.min(F.when(F.col("_run"), F.col("rank"))).over(Window.partitionBy("source_file"))
    kept = read.withColumn("_run", run).withColumn("_upto", upto).filter(F.col("relation").isNotNull() & (F.col("_upto").isNull() | (F.col("rank") < F.col("_upto"))))
    return kept.select("a_id", "b_id", "relation", "reason"), replies


_INLINE = "level1 array<struct<name:string,level2:array<struct<name:string,itemIndices:array<int>>>>>"
_INDUCED = "assignments array<struct<key:string,l1:string,l2:string>>"


def groups(requirements: DataFrame, model: Provider, inline_limit: int = INLINE_LIMIT) -> tuple[DataFrame, DataFrame]:
    """(groups, replies): the groups of each requirement as ``tree.fallback_groups`` has them.

    A tender of at most ``inline_limit`` requirements is one message of numbered
    titles, a larger one a message of its categories with three titles each. A
    reply without the shape asked for, or none, leaves the tender to the
    mechanical groups.
    """
    rows = Cut(requirements.select("source_file", "id", "req_order", "bullet_point", "category_code", "section_heading"), "grouping").df
    n = rows.groupBy("source_file").agg(F.count("*").alias("n"))
    small, large = n.filter(F.col("n") <= inline_limit), n.filter(F.col("n") > inline_limit)
    own = tree.placed(rows.join(small, "source_file"), ["source_file"], "idx")
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "bullet_point"))), lambda r: F.concat_ws(": ", r["idx"].cast("string"), r["bullet_point"])), "\n")
    inline = own.groupBy("source_file").agg(listed.alias("list"), F.count("*").alias("n")).select(F.col("source_file").alias("key"), F.concat(F.lit("Requirements ("), F.col("n").cast("string"), F.lit("):\n"), "list").alias("message"), F.lit(prompts.INLINE).alias("system"))
    line = F.format_string('- "%s" (%d items): %s', "key", "n_items", "examples")
    shelves = tree.catalogue(rows.join(large.select("source_file"), "source_file", "left_semi")).select("source_file", "key_order", "key", line.alias("line"))
    induced = shelves.groupBy("source_file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("key_order", "key", "line"))), lambda r: r["line"]), "\n").alias("list"), F.count("*").alias("n"))
    induced = induced.select(F.col("source_file").alias("key"), F.concat(F.lit("Categories ("), F.col("n").cast("string"), F.lit("):\n"), "list").alias("message"), F.lit(prompts.INDUCE).alias("system"))
    replies = Cut(ask(inline.unionByName(induced), model), "groups").df
    said = replies.select(F.col("key").alias("source_file"), F.from_json("reply", _INLINE)["level1"].alias("level1"), F.from_json("reply", _INDUCED)["assignments"].alias("assignments")).join(n, "source_file")
    named = lambda c: F.coalesce(F.length(c) > 0, F.lit(False))
    topics = lambda t: (F.coalesce(F.size(t["level2"]), F.lit(0)) > 0) & F.forall(t["level2"], lambda x: named(x["name"]) & F.coalesce(F.forall(x["itemIndices"], lambda i: F.coalesce(i >= 0, F.lit(False))), F.lit(False)))
    whole = F.coalesce(F.size("level1").between(1, THEMES) & F.forall("level1", lambda t: named(t["name"]) & F.coalesce(topics(t), F.lit(False))), F.lit(False))
    known = F.coalesce((F.size("assignments") > 0) & F.forall("assignments", lambda a: named(a["key"]) & named(a["l1"]) & named(a["l2"])), F.lit(False))
    read = Cut(said.withColumn("ok", F.when(F.col("n") <= inline_limit, whole).otherwise(known)), "read").df
    by_number = read.filter(F.col("ok") & (F.col("n") <= inline_limit)).select("source_file", F.posexplode("level1").alias("l1_ord", "t")).select("source_file", "l1_ord", F.col("t.name").alias("l1"), F.posexplode("t.level2").alias("l2_ord", "u")).select("source_file", "l1_ord", "l1", "l2_ord", F.col("u.name").alias("l2"), F.col("u.itemIndices").alias("indices"))
    by_key = read.filter(F.col("ok") & (F.col("n") > inline_limit)).select("source_file", F.posexplode("assignments").alias("ord", "a")).select("source_file", "ord", "a.key", "a.l1", "a.l2")
    of = lambda tenders: rows.join(tenders.select("source_file").distinct(), "source_file", "left_semi")
    mechanical = tree.fallback_groups(rows.join(read.filter("ok").select("source_file"), "source_file", "left_anti"))
    return mechanical.unionByName(tree.claimed_groups(of(by_number), by_number)).unionByName(tree.taxonomy_groups(of(by_key), by_key)), replies
