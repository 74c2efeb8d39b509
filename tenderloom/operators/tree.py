"""Grouping of requirements and the three-level tree."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.functions import text as T
from tenderloom.operators import nested
from tenderloom.operators.link import group_key
from tenderloom.operators.order import numbered
from tenderloom.runtime import Cut, ship

#: Requirements numbered in one window, by their place in the tender.
BLOCK = 10_000
GROUPS = ("l1_key", "l1_label", "l2_key", "l2_label")


def placed(rows: DataFrame, group: list[str], name: str) -> DataFrame:
    """The place of each requirement in its group from 0, in order; windows hold a block of the tender each."""
    return numbered(rows.withColumn("_block", F.floor(F.col("req_order") / BLOCK)), group, ["_block"], ["req_order", "id"], name).drop("_block")


def dominant_language(requirements: DataFrame) -> DataFrame:
    """(source_file, language): the most common two-letter language of a tender, of equally common ones the first seen, else en."""
    lang = T.language_code("source_language")
    counted = requirements.groupBy("source_file", lang.alias("l")).agg(F.count("*").alias("n"), F.min("req_order").alias("first"))
    best = F.max_by("l", F.when(F.col("l").isNotNull(), F.struct("n", (-F.col("first")).alias("f"))))
    return counted.groupBy("source_file").agg(F.coalesce(best, F.lit("en")).alias("language"))


def catalogue(requirements: DataFrame) -> DataFrame:
    """(source_file, key, n_items, key_order, examples): the grouping keys of a tender with their first three titles.

    The limit of three goes before the shuffle, so a key of any size is three rows per task.
    """
    rows = requirements.select("source_file", group_key().alias("key"), "req_order", "id", "bullet_point")
    place = Window.partitionBy("source_file", "key").orderBy("req_order", "id")
    three = rows.withColumn("_n", F.row_number().over(place)).filter("_n <= 3").groupBy("source_file", "key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "bullet_point"))), lambda r: r["bullet_point"]), " | ").alias("examples"))
    sizes = rows.groupBy("source_file", "key").agg(F.count("*").alias("n_items"), F.min("req_order").alias("key_order"))
    return sizes.join(three, ["source_file", "key"])


def fallback_groups(requirements: DataFrame) -> DataFrame:
    """(source_file, id, l1_key, l1_label, l2_key, l2_label) by section or category alone; labels with one slug share the first label."""
    label = F.coalesce("section_heading", F.concat(F.lit("Category "), F.nullif("category_code", F.lit(""))), F.lit("General"))
    rows = requirements.select("source_file", "id", "req_order", label.alias("label"), T.label_slug(label, "general").alias("l2_key"))
    first = rows.groupBy("source_file", "l2_key").agg(F.min_by("label", F.struct("req_order", "id")).alias("l2_label"))
    return rows.join(first, ["source_file", "l2_key"]).select("source_file", "id", F.lit("requirements").alias("l1_key"), F.lit("Requirements").alias("l1_label"), "l2_key", "l2_label")


def taxonomy_groups(requirements: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """The same columns by a taxonomy (key, l1, l2, ord): the first assignment of a key counts, requirements of unknown keys go to Other.

    The taxonomy may hold ``source_file``; then it is of that tender only.
    """
    by = ["source_file", "key"] if "source_file" in taxonomy.columns else ["key"]
    first = taxonomy.groupBy(*by).agg(F.min_by(F.struct("l1", "l2"), "ord").alias("t"))
    rows = requirements.select("source_file", "id", group_key().alias("key")).join(first, by, "left")
    known = F.col("t").isNotNull()
    l1 = T.label_slug("t.l1")
    pick = lambda c, other: F.when(known, c).otherwise(F.lit(other))
    return rows.select("source_file", "id", pick(l1, "other").alias("l1_key"), pick(F.col("t.l1"), "Other Requirements").alias("l1_label"), pick(F.concat(l1, F.lit("__"), T.label_slug("key")), "other__general").alias("l2_key"), pick(F.col("t.l2"), "General").alias("l2_label"))


def claimed_groups(requirements: DataFrame, reply: DataFrame) -> DataFrame:
    """The same columns by a reply (source_file, l1_ord, l1, l2_ord, l2, indices) of places in the tender's order; the first claim of a place counts, places out of range are ignored, the rest goes to Other."""
    rows = placed(requirements.select("source_file", "id", "req_order"), ["source_file"], "idx")
    claims = reply.select("source_file", "l1_ord", "l1", "l2_ord", "l2", F.posexplode("indices").alias("pos", "idx"))
    first = claims.groupBy("source_file", "idx").agg(F.min_by(F.struct("l1", "l2"), F.struct("l1_ord", "l2_ord", "pos")).alias("t"))
    out = rows.join(first, ["source_file", "idx"], "left")
    known = F.col("t").isNotNull()
    pick = lambda c, other: F.when(known, c).otherwise(F.lit(other))
    l1, l2 = T.label_slug("t.l1"), T.label_slug("t.l2")
    return out.select("source_file", "id", pick(l1, "other").alias("l1_key"), pick(F.col("t.l1"), "Other Requirements").alias("l1_label"), pick(F.concat(l1, F.lit("__"), l2), "other__general").alias("l2_key"), pick(F.col("t.l2"), "General").alias("l2_label"))


def level_counts(groups: DataFrame) -> DataFrame:
    """(source_file, l1_key, l2_key, n_leaves): leaves of each second-level group, each first-level group and each tender."""
    return groups.rollup("source_file", "l1_key", "l2_key").agg(F.count("*").alias("n_leaves")).filter("source_file is not null")


def group_counts(groups: DataFrame) -> DataFrame:
    """(source_file, n_l1, n_l2, n_requirements): the different first-level and second-level groups of each tender."""
    return groups.groupBy("source_file").agg(F.countDistinct("l1_key").alias("n_l1"), F.countDistinct("l1_key", "l2_key").alias("n_l2"), F.count("*").alias("n_requirements"))


def leaf_count(nodes: DataFrame) -> DataFrame:
    """(source_file, n_leaves): the nodes of each tree without children; a tree that is only its root has one."""
    inner = nodes.select("source_file", F.col("parent_path").alias("path")).filter("path is not null").distinct()
    return nodes.select("source_file", "path").join(inner, ["source_file", "path"], "left_anti").groupBy("source_file").agg(F.count("*").alias("n_leaves"))


def leaf_description(en: Column, original: Column, language: Column) -> Column:
    """The texts by language: English, and the original under the tender's language unless that is English or there is none."""
    other = F.coalesce((original != "") & (language != "en"), F.lit(False))
    return F.when(other, F.create_map(F.lit("en"), en, F.when(language == "en", F.lit("_")).otherwise(language), original)).otherwise(F.create_map(F.lit("en"), en))


def tree_nodes(requirements: DataFrame, groups: DataFrame) -> DataFrame:
    """The tree of each tender as an adjacency table, parents and children linked by Dewey labels.

    Columns: source_file, path, parent_path, depth (0 tender, 1, 2, 3 leaf),
    ord (place among its siblings, by first requirement), bullet_point,
    description (map), priority, confidence, equivalence_allowed, chunk_ids (in
    order, repeats kept).
    """
    own = Cut(requirements.select("source_file", "id", "req_order", "bullet_point", "description_en", "description_de", "priority", "confidence", "equivalence_allowed", "source_chunk_ids", "source_language"), "requirements").df
    rows = Cut(own.join(groups.select("source_file", "id", *GROUPS), ["source_file", "id"]).join(dominant_language(own), "source_file"), "grouped").df
    place = F.struct("req_order", "id")
    l1 = rows.groupBy("source_file", "l1_key").agg(F.min(place).alias("o"), F.min_by("l1_label", place).alias("label")).withColumn("ord", F.row_number().over(Window.partitionBy("source_file").orderBy("o")) - 1).withColumn("p1", F.concat(F.lit("r."), F.col("ord").cast("string")))
    l2 = rows.groupBy("source_file", "l1_key", "l2_key").agg(F.min(place).alias("o"), F.min_by("l2_label", place).alias("label")).join(l1.select("source_file", "l1_key", "p1"), ["source_file", "l1_key"]).withColumn("ord", F.row_number().over(Window.partitionBy("source_file", "l1_key").orderBy("o")) - 1).withColumn("p2", F.concat("p1", F.lit("."), F.col("ord").cast("string")))
    leaf = rows.join(l2.select("source_file", "l1_key", "l2_key", "p1", "p2"), ["source_file", "l1_key", "l2_key"])
    leaf = placed(leaf, ["source_file", "l1_key", "l2_key"], "ord")
    listed = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("req_order", "id", "source_chunk_ids"))), lambda r: r["source_chunk_ids"])).alias("chunk_ids")
    none = F.create_map().cast("map<string,string>")

    def inner(df: DataFrame, keys: list[str], path: str, parent: Column, depth: int, label: Column, ord_: Column) -> DataFrame:
        ids = leaf.groupBy(*keys).agg(listed)
        return df.join(ids, keys).select("source_file", F.col(path).alias("path"), parent.alias("parent_path"), F.lit(depth).alias("depth"), ord_.cast("int").alias("ord"), label.alias("bullet_point"), none.alias("description"), F.lit("must").alias("priority"), F.lit(None).cast("string").alias("confidence"), F.lit(None).cast("boolean").alias("equivalence_allowed"), "chunk_ids")

    tenders = rows.select("source_file").distinct().withColumn("p0", F.lit("r"))
    leaves = leaf.select("source_file", F.concat("p2", F.lit("."), F.col("ord").cast("string")).alias("path"), F.col("p2").alias("parent_path"), F.lit(3).alias("depth"), F.col("ord").cast("int").alias("ord"), "bullet_point", leaf_description(F.col("description_en"), F.col("description_de"), F.col("language")).alias("description"), "priority", "confidence", "equivalence_allowed", F.col("source_chunk_ids").alias("chunk_ids"))
    return (
        inner(tenders, ["source_file"], "p0", F.lit(None).cast("string"), 0, F.col("source_file"), F.lit(0))
        .unionByName(inner(l1, ["source_file", "l1_key"], "p1", F.lit("r"), 1, F.col("label"), F.col("ord")))
        .unionByName(inner(l2, ["source_file", "l1_key", "l2_key"], "p2", F.col("p1"), 2, F.col("label"), F.col("ord")))
        .unionByName(leaves)
    )


def _deliverable(children: Column) -> Column:
    null = lambda t: F.lit(None).cast(t)
    no = F.array().cast("array<string>")
    return F.struct(
        F.col("bullet_point").alias("bulletPoint"), "description", "priority", "confidence", F.col("equivalence_allowed").alias("equivalenceAllowed"), null("string").alias("fullfillable"), F.lit("waitingForAnalysis").alias("status"),
        *[null("string").alias(c) for c in ("aiReasoning", "feedback", "feedbackText", "openQuestionId")], *[no.alias(c) for c in ("workspaceDocumentChunkIdArray", "citedProductIdArray", "citedPersonIdArray")],
        children.alias("deliverableArray"), F.col("chunk_ids").alias("procurementDocumentChunkIdArray"),
    )


def tree_json(nodes: DataFrame) -> DataFrame:
    """(source_file, tree_json): the nested tree of each tender, levels folded from the leaves up; nulls are written."""
    nodes = Cut(nodes, "nodes").df
    level = nodes.filter("depth = 3").select("source_file", "parent_path", "ord", _deliverable(F.array().cast("array<string>")).alias("node"))
    for depth in (2, 1, 0):
        kids = level.groupBy("source_file", F.col("parent_path").alias("path")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.to_json("node", {"ignoreNullFields": "false"}).alias("node")))), lambda r: r["node"]).alias("kids"))
        above = nodes.filter(F.col("depth") == depth).join(kids, ["source_file", "path"])
        level = above.select("source_file", "parent_path", "ord", _deliverable(F.transform("kids", lambda k: F.parse_json(k))).alias("node"))
    return level.select("source_file", F.to_json("node", {"ignoreNullFields": "false"}).alias("tree_json"))


def broken_nodes(nodes: DataFrame) -> DataFrame:
    """The nodes that break the output contract: a null title, an unknown priority or confidence, or a leaf without its English text."""
    ok = F.col("bullet_point").isNotNull() & F.coalesce(F.col("priority").isin("must", "should", "optional"), F.lit(False)) & F.coalesce(F.col("confidence").isin("high", "medium", "low"), F.lit(True)) & ((F.col("depth") < 3) | F.col("description")["en"].isNotNull())
    return nodes.filter(~ok)


# The fields of an output node, and the values of those that have few.
TEXT_OR_NULL = ("feedbackText", "openQuestionId")
LISTS = ("procurementDocumentChunkIdArray", "workspaceDocumentChunkIdArray", "citedProductIdArray", "citedPersonIdArray")
VALUES = {
    "priority": ("must", "should", "optional"), "confidence": ("high", "medium", "low", None), "equivalenceAllowed": (True, False, None), "fullfillable": ("yes", "no", "maybe", None), "feedback": ("good", "bad", None),
    "status": ("waitingForAnalysis", "waitingForAnswer", "waitingForAnswerPropagation", "waitingForReview", "userDefined"),
}


def broken_fields(node: object) -> list[str]:
    """The fields of a node that break the output contract; ``*`` if it is no object at all."""
    if not isinstance(node, dict):
        return ["*"]
    missing = object()
    get = lambda f: node.get(f, missing)
    texts = lambda v: isinstance(v, dict) and all(isinstance(x, str) for x in v.values())
    listed = lambda v: isinstance(v, list) and all(isinstance(x, str) for x in v)
    ok = {"bulletPoint": isinstance(get("bulletPoint"), str) and bool(node["bulletPoint"]), "description": texts(get("description")), "aiReasoning": get("aiReasoning") is None or texts(get("aiReasoning")), "deliverableArray": isinstance(get("deliverableArray"), list)}
    ok |= {f: any(get(f) is v for v in values if not isinstance(v, str)) or isinstance(get(f), str) and node[f] in values for f, values in VALUES.items()}
    ok |= {f: get(f) is None or isinstance(get(f), str) for f in TEXT_OR_NULL}
    ok |= {f: listed(get(f)) for f in LISTS}
    return sorted(f for f, good in ok.items() if not good)


def contract_errors(trees: DataFrame) -> DataFrame:
    """(source_file, path, field) of every field of every node of (source_file, tree_json) that breaks the output contract; a text that isn't JSON is one error of its root."""
    ship(trees.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for name, text in zip(b["source_file"], b["tree_json"], strict=True):
                try:
                    root = nested.parse(text)
                except ValueError:
                    rows.append((name, "r", "*"))
                    continue
                todo = [("r", root)]
                while todo:
                    path, node = todo.pop()
                    rows.extend((name, path, f) for f in broken_fields(node))
                    kids = node.get(nested.CHILDREN) if isinstance(node, dict) else None
                    todo.extend((f"{path}.{i}", x) for i, x in enumerate(kids if isinstance(kids, list) else []))
            yield pd.DataFrame(rows, columns=["source_file", "path", "field"])

    return trees.select("source_file", "tree_json").mapInPandas(run, "source_file string, path string, field string")
