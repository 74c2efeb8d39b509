"""The whole way from lines to trees, for all documents at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.config import Linking
from tenderloom.operators import consolidate, extract, grounding, judge, link, profile, provider, segment, tree
from tenderloom.operators.order import numbered
from tenderloom.plans import prompts
from tenderloom.runtime import Cut
from tenderloom.sources import store

#: Changes with the prompts, so that replies to older ones are no hits.
PROMPTS = "2"
ITEM = ("bullet_point", "description_en", "description_de", "priority", "confidence", "equivalence_allowed", *extract.LISTS, "category_code", "item_number", "source_language")


@dataclass
class Result:
    profiles: DataFrame
    chunks: DataFrame
    extractions: DataFrame
    failures: DataFrame
    requirements: DataFrame
    nodes: DataFrame
    usage: DataFrame


def from_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(profiles, chunks) of lines (doc_id, page, line_no, text, font_size)."""
    rows = F.array_sort(F.collect_list(F.struct("line_no", "text")))
    pages = lines.groupBy("doc_id", "page").agg(rows.alias("l")).select("doc_id", "page", F.array_join("l.text", "\n").alias("text"))
    profiles = profile.profile(pages)
    known = lines.join(profiles.select("doc_id", (F.col("strategy") != "section-list").alias("strip_noise")), "doc_id")
    return profiles, segment.chunks(segment.segments(known))


def ask_chunks(chunks: DataFrame, model: provider.Provider, base: str = prompts.EXTRACT, counted: list[DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(items, failures): (chunk_id, item_ord, item_json), and (chunk_id, parts, failed) of chunks with parts that gave no list.

    The instructions are ``base`` and what the region of the chunk is. A column
    ``listed`` of ``chunks``, if there is one, is shown as what is known
    already. Where a reply is cut off for length the halves of that text are
    asked for instead, until none is cut off or a single character is left;
    their items follow in the order of the text. Every round of replies is
    added to ``counted``.
    """
    listed = [F.concat(F.lit("Already listed:\n"), "listed")] if "listed" in chunks.columns else []
    message = extract.user_message(*[F.col(c) for c in ("document_region", "lv_position", "category_code", "section_heading")], F.concat_ws("\n", *listed, F.concat(F.lit("\n"), F.col("content"))))
    system = prompts.by_region(base, F.col("document_region"))
    columns = ["chunk_id", "document_region", "lv_position", "category_code", "section_heading", *(["listed"] if listed else []), "content"]
    asked = chunks.select(*columns, F.lit("").alias("path"))
    ended = []
    while True:
        asked = Cut(asked, "asked").df
        key = F.concat("chunk_id", F.lit("/"), "path")
        replies = Cut(provider.ask(asked.select(key.alias("key"), message.alias("message"), system.alias("system")), model), "replies").df
        if counted is not None:
            counted.append(replies)
        placed = replies.select(F.regexp_replace("key", "/[01]*$", "").alias("chunk_id"), F.substring_index("key", "/", -1).alias("path"), "reply", "truncated")
        cut_off = asked.join(placed.filter("truncated"), ["chunk_id", "path"], "left_semi").filter(F.length("content") > 1)
        ended.append(placed.join(cut_off.select("chunk_id", "path"), ["chunk_id", "path"], "left_anti"))
        if not replies.filter("truncated").isEmpty() and not cut_off.isEmpty():
            halved = cut_off.select(*columns[:-1], "path", F.posexplode(extract.halves(F.col("content"))).alias("half", "content"))
            asked = halved.select(*columns, F.concat("path", F.col("half").cast("string")).alias("path"))
            continue
        break
    replies = ended[0]
    for more in ended[1:]:
        replies = replies.unionByName(more)
    listed = replies.withColumn("items", F.try_variant_get(F.try_parse_json("reply"), "$.extractions", "array<variant>"))
    failures = listed.groupBy("chunk_id").agg(F.count("*").alias("parts"), F.count_if(F.col("items").isNull()).alias("failed")).filter("failed > 0")
    raw = listed.select("chunk_id", "path", F.posexplode("items").alias("pos", "item")).select("chunk_id", "path", "pos", F.to_json("item").alias("item_json"))
    order = F.row_number().over(Window.partitionBy("chunk_id").orderBy("path", "pos")) - 1
    return raw.select("chunk_id", order.alias("item_ord"), "item_json"), failures


def extract_chunks(chunks: DataFrame, model: provider.Provider, glean: bool = True, failures: list[DataFrame] | None = None, cache: str | None = None, force: bool = False, version: str = PROMPTS, counted: dict[str, list[DataFrame]] | None = None) -> DataFrame:
    """Validated, enriched units of chunks, both passes; every provider call's reply is written before use.

    With ``cache``, a folder, only chunks without a reply there are asked for
    (all of them with ``force``), and their units are added to it; chunks with a
    part that failed are not, so the next run asks again. ``version`` names
    model and prompts. What failed of each pass is added to ``failures`` as
    (chunk_id, parts, failed, pass), replies to ``counted`` by stage.
    """
    counted = {} if counted is None else counted
    failed_: list[DataFrame] = []

    def once(rows: DataFrame, no: int, base: str) -> DataFrame:
        raw, failed = ask_chunks(rows, model, base, counted.setdefault(("extract", "glean")[no], []))
        failed_.append(failed.withColumn("pass", F.lit(no)))
        return extract.validated(raw)

    keyed = store.cache_key(chunks, version, type(model).__name__)
    hits, misses = store.split_by_cache(keyed, store.read_cache(chunks.sparkSession, cache), force) if cache else (None, keyed)
    first = Cut(once(misses, 0, prompts.EXTRACT), "first").df
    if glean:
        again = extract.glean_candidates(misses, first)
        titles = first.groupBy("chunk_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_ord", "bullet_point"))), lambda r: F.concat(F.lit("- "), r["bullet_point"])), "\n").alias("listed"))
        more = once(again.join(titles, "chunk_id"), 1, prompts.GLEAN)
        new = Cut(extract.both_passes(first.withColumn("pass", F.lit(0)), more.withColumn("pass", F.lit(1))), "both").df
    else:
        new = first.withColumn("pass", F.lit(0))
    failed_rows = failed_[0]
    for more_failed in failed_[1:]:
        failed_rows = failed_rows.unionByName(more_failed)
    if failures is not None:
        failures.append(failed_rows)
    place = F.row_number().over(Window.partitionBy("chunk_id").orderBy("pass", "item_ord")) - 1
    units = new.select("chunk_id", place.alias("item_ord"), *ITEM)
    if cache:
        text = F.to_json(F.struct(*ITEM), {"ignoreNullFields": "false"})
        listed = units.groupBy("chunk_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("item_ord", text.alias("t")))), lambda r: r["t"]).alias("items"))
        replies = misses.join(failed_rows.select("chunk_id").distinct(), "chunk_id", "left_anti").join(listed, "chunk_id", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        known = Cut(extract.validated(hits.select("chunk_id", F.posexplode("items").alias("item_ord", "item_json"))), "hits").df  # before the cache grows
        store.write_cache(replies, cache)
        units = units.unionByName(known.select(*units.columns))
    rich = extract.enriched(units, chunks).join(chunks.select("chunk_id", "seq"), "chunk_id")
    return numbered(rich, ["source_file"], ["seq"], ["item_ord"], "ext_ord").drop("seq", "item_ord")


def to_tree(
    extractions: DataFrame, chunks: DataFrame, verdicts: DataFrame | None = None, taxonomy: DataFrame | None = None, cfg: Linking = Linking(), model: provider.Provider | None = None, counted: dict[str, list[DataFrame]] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(requirements, nodes): consolidated, linked, with grounded confidence, and grouped.

    Linked by ``verdicts`` or, without these, by those of ``model`` on the
    candidate pairs; grouped by ``taxonomy`` or, without one, as ``model`` says.
    Where neither is given, or the model's reply is of no use, nothing is linked
    and groups are mechanical.
    """
    counted = {} if counted is None else counted
    reqs = Cut(consolidate.consolidate(extractions), "requirements").df
    if verdicts is not None or model is not None:
        ranked = Cut(link.top_candidates(link.candidates(reqs, cfg), reqs, cfg), "ranked").df
        if verdicts is None:
            verdicts, replies = judge.verdicts(ranked, reqs, model)
            counted.setdefault("judge", []).append(replies)
        reqs = Cut(link.merge_linked(reqs, link.guarded(link.united(ranked, verdicts, reqs), reqs)), "linked").df
    checked = grounding.grounded(reqs, chunks).select("id", F.col("confidence").alias("_checked"))
    reqs = reqs.join(checked, "id").withColumn("confidence", F.col("_checked")).drop("_checked")
    if taxonomy is not None:
        groups = tree.taxonomy_groups(reqs, taxonomy)
    elif model is not None:
        reqs = Cut(reqs, "checked").df
        groups, replies = judge.groups(reqs, model)
        counted.setdefault("group", []).append(replies)
    else:
        groups = tree.fallback_groups(reqs)
    return reqs, tree.tree_nodes(reqs, groups)


def used(spark, counted: dict[str, list[DataFrame]]) -> DataFrame:
    """(stage, calls, failed, truncated, prompt_tokens, completion_tokens) of a run."""
    out = None
    for stage, rounds in counted.items():
        rows = rounds[0]
        for more in rounds[1:]:
            rows = rows.unionByName(more)
        out = provider.usage(rows, stage) if out is None else out.unionByName(provider.usage(rows, stage))
    return out if out is not None else spark.createDataFrame([], "stage string, calls long, failed long, truncated long, prompt_tokens long, completion_tokens long")


def run(lines: DataFrame, model: provider.Provider, verdicts: DataFrame | None = None, taxonomy: DataFrame | None = None, cache: str | None = None, force: bool = False, decide: bool = True) -> Result:
    """All stages. The trees must meet the output contract, else this fails.

    ``decide`` lets the model judge pairs and name groups, too; without it, and
    without ``verdicts`` and ``taxonomy``, nothing is linked and groups are
    mechanical.
    """
    profiles, rows = from_lines(lines)
    chunks = Cut(rows, "chunks").df
    failed: list[DataFrame] = []
    counted: dict[str, list[DataFrame]] = {}
    units = Cut(extract_chunks(chunks, model, failures=failed, cache=cache, force=force, counted=counted), "units").df
    reqs, nodes = to_tree(units, chunks, verdicts, taxonomy, model=model if decide else None, counted=counted)
    nodes = Cut(nodes, "nodes").df
    if not tree.broken_nodes(nodes).isEmpty() or not tree.contract_errors(tree.tree_json(nodes)).isEmpty():
        raise ValueError("the tree breaks the output contract")
    return Result(profiles, chunks, units, failed[0], reqs, nodes, used(lines.sparkSession, counted))
