"""Consolidation of extracted units into requirements, all tenders at once.

Preamble specifications take the position chunks of their category as evidence;
what is left merges by identity: a common position code, an equal title in one
section, an equal description in one category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tenderloom.functions import text as T
from tenderloom.operators.order import numbered
from tenderloom.runtime import Cut


#: Units numbered in one window, by their place in the tender.
BLOCK = 10_000
COLUMNS = ("chunk_id", "source_file", "section_heading", "bullet_point", "description_en", "description_de", "priority", "equivalence_allowed", "confidence", "standards", "referenced_annexes", "cross_referenced_positions", "category_code", "item_number", "source_language", "ext_ord")


def units(extractions: DataFrame) -> DataFrame:
    """Extractions with ``unit_key`` (chunk id and place within the chunk by ``ext_ord``) and ``order`` (``ext_ord``)."""
    rows = extractions.withColumn("order", F.col("ext_ord")).withColumn("_block", F.floor(F.col("ext_ord") / BLOCK))
    placed = numbered(rows, ["source_file", "chunk_id"], ["_block"], ["ext_ord"], "_place").drop("_block")
    return placed.withColumn("unit_key", F.concat("chunk_id", F.lit("#"), F.col("_place").cast("string"))).drop("_place")


def has_category() -> Column:
    return F.coalesce(F.col("category_code") != "", F.lit(False))


def specs(unit_rows: DataFrame) -> DataFrame:
    return unit_rows.filter(has_category() & ~T.is_position("item_number"))


def placements(unit_rows: DataFrame) -> DataFrame:
    return unit_rows.filter(has_category() & T.is_position("item_number"))


def placement_chunks(unit_rows: DataFrame) -> DataFrame:
    """(source_file, category_code, placements): the chunks of a category's position units, in order of first appearance."""
    first = placements(unit_rows).groupBy("source_file", "category_code", "chunk_id").agg(F.min("order").alias("order"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("order", "chunk_id"))), lambda r: r["chunk_id"])
    return first.groupBy("source_file", "category_code").agg(listed.alias("placements"))


def category_sources(unit_rows: DataFrame) -> DataFrame:
    """(source_file, unit_key, category_code, source_chunk_ids) of each preamble specification."""
    joined = specs(unit_rows).join(placement_chunks(unit_rows), ["source_file", "category_code"], "left")
    empty = F.array().cast("array<string>")
    return joined.select("source_file", "unit_key", "category_code", F.array_distinct(F.concat(F.array("chunk_id"), F.coalesce("placements", empty))).alias("source_chunk_ids"))


def remaining(unit_rows: DataFrame) -> DataFrame:
    """Units that are neither specifications nor in a chunk consumed as a placement of one."""
    s = specs(unit_rows)
    used = placements(unit_rows).join(s.select("source_file", "category_code").distinct(), ["source_file", "category_code"], "left_semi").select("source_file", "chunk_id").distinct()
    return unit_rows.join(s.select("source_file", "unit_key"), ["source_file", "unit_key"], "left_anti").join(used, ["source_file", "chunk_id"], "left_anti")


def identity_keys(unit_rows: DataFrame) -> DataFrame:
    """(source_file, unit_key, key): what makes units one requirement; units with a common key of one tender belong together."""
    position = F.when(T.is_position("item_number"), F.concat(F.lit("a|"), "item_number"))
    title = F.when(~T.is_position("item_number"), F.concat(F.lit("b|"), T.folded("bullet_point"), F.lit("|"), F.coalesce("section_heading", "category_code", F.lit(""))))
    text = F.when(has_category(), F.concat(F.lit("c|"), "category_code", F.lit("|"), T.folded("description_en")))
    keys = F.filter(F.array(position, title, text), lambda k: k.isNotNull())
    return unit_rows.select("source_file", "unit_key", F.explode(keys).alias("key"))


def identity_groups(unit_rows: DataFrame) -> DataFrame:
    """(source_file, unit_key, id): ``id`` is the least unit key of each set of units that keys connect.

    A key is a star around its least unit, so one that most units share is one
    edge for each of them; units that share no key take no part in the rounds.
    Labels spread as minima, combined map-side, until none changes. Each round
    follows labels to their own label, too, which halves the distance that is
    left. Rounds are written to the shared folder.
    """
    keyed = identity_keys(unit_rows).select("source_file", "unit_key", F.xxhash64("source_file", "key").alias("h"), "key")
    least = keyed.groupBy("source_file", "h", "key").agg(F.min("unit_key").alias("low"), F.count("*").alias("n")).filter("n > 1")
    # A key makes a star around its least unit; keys of one unit connect nothing.
    edges = Cut(keyed.join(least, ["source_file", "h", "key"]).filter("unit_key <> low").select("source_file", F.col("unit_key").alias("a"), F.col("low").alias("b")).distinct(), "edges").df
    both = edges.unionByName(edges.select("source_file", F.col("b").alias("a"), F.col("a").alias("b")))
    labels = Cut(both.groupBy("source_file", F.col("a").alias("unit_key")).agg(F.least(F.col("a"), F.min("b")).alias("id")), "labels")
    while True:
        near = both.join(labels.df.select("source_file", F.col("unit_key").alias("b"), "id"), ["source_file", "b"]).groupBy("source_file", F.col("a").alias("unit_key")).agg(F.min("id").alias("low"))
        own = labels.df.join(near, ["source_file", "unit_key"]).select("source_file", "unit_key", F.col("id").alias("was"), F.least("id", "low").alias("low"))
        jump = labels.df.select("source_file", F.col("unit_key").alias("low"), F.col("id").alias("lower"))
        seen = Observation()
        step = Cut(own.join(jump, ["source_file", "low"], "left").select("source_file", "unit_key", "was", F.least("low", F.coalesce("lower", "low")).alias("id")).observe(seen, F.count_if(F.col("id") != F.col("was")).alias("moved")), "labels")
        labels.drop()
        labels = step
        if not seen.get.get("moved"):
            break
    found = labels.df.select("source_file", "unit_key", "id")
    return unit_rows.select("source_file", "unit_key").distinct().join(found, ["source_file", "unit_key"], "left").select("source_file", "unit_key", F.coalesce("id", "unit_key").alias("id"))


def joined_descriptions(parts: Column) -> Column:
    """The texts of an ordered array joined by blank lines, without restatements.

    A text is left out if it is null, blank or equal to one kept when folded,
    or, but for the first, if at least 0.85 of its words of over three
    characters were there before (a text without such words counts as known)
    and it brings no new number. Null if nothing is kept.
    """
    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("parts"), empty.alias("seen"), empty.alias("tokens"), empty.alias("numbers"))

    def step(acc, value):
        tokens, numbers, key = T.words(value, 3), T.plain_numbers(value), T.folded(value)
        known = F.size(F.filter(tokens, lambda t: F.array_contains(acc["tokens"], t)))
        restated = (F.size(acc["parts"]) > 0) & ((F.size(tokens) == 0) | (known >= 0.85 * F.size(tokens))) & (F.size(F.array_except(numbers, acc["numbers"])) == 0)
        skip = F.coalesce(value.isNull() | (key == "") | F.array_contains(acc["seen"], key) | restated, F.lit(True))
        add = lambda name, more: F.when(skip, acc[name]).otherwise(F.concat(acc[name], more)).alias(name)
        return F.struct(add("parts", F.array(T.trim(value))), add("seen", F.array(key)), add("tokens", tokens), add("numbers", numbers))

    kept = F.aggregate(parts, start, step, lambda acc: acc["parts"])
    return F.when(F.size(kept) > 0, F.array_join(kept, "\n\n"))


def evidence(chunk_ids: Column, first: str, others: str) -> Column:
    return F.transform(chunk_ids, lambda c, i: F.struct(c.alias("chunk_id"), F.when(i == 0, first).otherwise(others).alias("evidence_role")))


def listed_values(rows: DataFrame) -> DataFrame:
    """(source_file, id, _chunk_id, _description_en, ...): the different values of each group's lists and texts, in order of first appearance.

    Texts that are equal when folded are one value. Repeats are dropped
    map-side before anything is collected, so a group of copies stays small.
    """
    texts, lists = ("description_en", "description_de"), ("standards", "referenced_annexes", "cross_referenced_positions")
    entry = lambda kind, key, value, pos: F.struct(F.lit(kind).alias("kind"), key.alias("key"), F.struct("order", "unit_key", pos.alias("pos"), value.alias("value")).alias("v"))
    zero = F.lit(0)
    parts = [F.array(entry("chunk_id", F.col("chunk_id"), F.col("chunk_id"), zero), *[entry(c, T.folded(c), F.col(c), zero) for c in texts])]
    spread = lambda kind: F.transform(F.coalesce(kind, F.array().cast("array<string>")), lambda x, i: entry(kind, x, x, i))
    parts += [spread(c) for c in lists]
    flat = rows.select("source_file", "id", F.explode(F.concat(*parts)).alias("e")).select("source_file", "id", "e.*").filter("key is not null")
    first = flat.groupBy("source_file", "id", "kind", "key").agg(F.min("v").alias("v"))
    kinds = ("chunk_id", *texts, *lists)
    return first.groupBy("source_file", "id").agg(*[F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("v")))), lambda v: v["value"]).alias(f"_{k}") for k in kinds])


def merged(unit_rows: DataFrame, groups: DataFrame) -> DataFrame:
    """One requirement per (source_file, id): body fields of the fullest unit, title of the first, priority of the strongest, lists united in order."""
    rows = unit_rows.join(groups, ["source_file", "unit_key"])
    length = F.length("description_en")
    best = F.max_by(F.struct("equivalence_allowed", "confidence", "category_code", "section_heading", "item_number", "source_language", "description_en"), F.struct(length, F.coalesce(T.rank("confidence", "confidence"), F.lit(0)), -F.col("order")))
    out = rows.groupBy("source_file", "id").agg(
        F.count("*").alias("n_units"), best.alias("rep"), F.min_by("bullet_point", F.struct("order", "unit_key")).alias("bullet_point"), F.max(T.rank("priority", "priority")).alias("p"), F.min("order").alias("req_order"),
        F.count_if(T.is_position("item_number")).alias("n_positions"), F.min("item_number").alias("low"), F.max("item_number").alias("high"), F.count("item_number").alias("n_numbered"), F.min(F.when(T.is_position("item_number"), F.col("item_number"))).alias("position"),
    ).join(listed_values(rows), ["source_file", "id"])
    chunk_ids = F.col("_chunk_id")
    exact = (F.col("n_positions") > 0) & (F.col("low") == F.col("high")) & (F.col("n_numbered") == F.col("n_units"))
    single = F.col("n_units") == 1
    record = F.struct(
        F.when(single, "standalone").when(exact, "lv-position-match").otherwise("staging-dedup").alias("rule"),
        F.when(single | exact, "high").otherwise("medium").alias("merge_confidence"),
        evidence(chunk_ids, "general_spec", "duplication").alias("evidence_links"),
        F.when(single, F.lit("Standalone requirement")).when(exact, F.concat(F.lit("Same position "), "position")).otherwise(F.lit("Same text")).alias("why_merged"),
    )
    return out.select(
        "source_file", "id", chunk_ids.alias("source_chunk_ids"), record.alias("merge_record"), "bullet_point", F.coalesce(joined_descriptions(F.col("_description_en")), "rep.description_en").alias("description_en"),
        joined_descriptions(F.col("_description_de")).alias("description_de"), T.unrank(F.coalesce("p", F.lit(1)), "priority").alias("priority"), F.col("rep.equivalence_allowed"), F.col("rep.confidence"),
        F.col("_standards").alias("standards"), F.col("_referenced_annexes").alias("referenced_annexes"), F.col("rep.category_code"), F.col("rep.section_heading"), F.col("rep.item_number"), F.col("rep.source_language"), "req_order",
        F.col("_cross_referenced_positions").alias("cross_references"),
    )


def category_requirements(unit_rows: DataFrame) -> DataFrame:
    """The requirements of the preamble specifications, with the position chunks of their category as evidence."""
    own = specs(unit_rows)
    base = merged(own, own.select("source_file", "unit_key", F.col("unit_key").alias("id")))
    src = category_sources(unit_rows).select("source_file", F.col("unit_key").alias("id"), F.col("source_chunk_ids").alias("all_chunks"))
    out = base.join(src, ["source_file", "id"])
    record = F.struct(F.lit("vorbemerkungen-category").alias("rule"), F.lit("high").alias("merge_confidence"), evidence(F.col("all_chunks"), "general_spec", "room_placement").alias("evidence_links"), F.concat(F.lit("Category "), "category_code").alias("why_merged"))
    return out.withColumn("merge_record", record).withColumn("source_chunk_ids", F.col("all_chunks")).drop("all_chunks")


def cross_references(requirements: DataFrame) -> DataFrame:
    """(source_file, id, ref_no, position, target_id, chunk_id): each reference to another requirement's position; of equal positions the last requirement counts."""
    target = requirements.filter(T.is_position("item_number")).groupBy("source_file", F.col("item_number").alias("position")).agg(F.max_by(F.struct(F.col("id").alias("target_id"), F.get("source_chunk_ids", F.lit(0)).alias("chunk_id")), F.struct("req_order", "id")).alias("t"))
    refs = requirements.select("source_file", "id", F.posexplode(F.array_distinct("cross_references")).alias("ref_no", "position"))
    return refs.join(target, ["source_file", "position"]).select("source_file", "id", "ref_no", "position", "t.*").filter("target_id <> id")


def with_references(requirements: DataFrame) -> DataFrame:
    """The requirements with their cross-references appended to the evidence; none are merged."""
    listed = cross_references(requirements).groupBy("source_file", "id").agg(F.array_sort(F.collect_list(F.struct("ref_no", "chunk_id", "position"))).alias("refs"))
    out = requirements.join(listed, ["source_file", "id"], "left")
    rec = F.col("merge_record")
    refs = F.coalesce("refs", F.array().cast("array<struct<ref_no:int,chunk_id:string,position:string>>"))
    links = F.concat(rec["evidence_links"], F.transform(refs, lambda r: F.struct(r["chunk_id"].alias("chunk_id"), F.lit("cross_reference").alias("evidence_role"))))
    why = F.concat(rec["why_merged"], F.array_join(F.transform(refs, lambda r: F.concat(F.lit(" | references OZ "), r["position"])), ""))
    return out.withColumn("merge_record", F.struct(rec["rule"].alias("rule"), rec["merge_confidence"].alias("merge_confidence"), links.alias("evidence_links"), why.alias("why_merged"))).drop("refs")


def consolidate(extractions: DataFrame) -> DataFrame:
    """All requirements of all tenders: those of categories, then those merged by identity, with cross-references as evidence.

    ``extractions`` has one row per unit with ``ext_ord``, unique within a
    tender. ``id`` is unique within a tender. An empty input gives an empty
    result; null titles and descriptions form no key; units without a chunk or
    a tender are left out. Columns besides COLUMNS are ignored.
    """
    rows = Cut(units(extractions.select(*COLUMNS).filter("chunk_id is not null and source_file is not null")), "units").df
    rest = Cut(remaining(rows), "remaining").df
    # Read three times: for the positions, the references to them and the requirements themselves.
    both = Cut(category_requirements(rows).unionByName(merged(rest, identity_groups(rest))), "merged").df
    return with_references(both)
