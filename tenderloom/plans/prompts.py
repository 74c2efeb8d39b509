"""What a model is told at each stage. The wording is ours; the keys of the replies are those the stages read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ITEMS = """Reply with one JSON object: {"extractions": [...]}. Each entry has bullet_point (English title), description_en, description_de (the original words, or null),
priority (must, should or optional), equivalence_allowed (true, false or null), confidence (high, medium or low), standards, referenced_annexes and cross_referenced_positions (lists of texts),
category_code, item_number and source_language (texts or null). With nothing to report the list is empty."""
EXTRACT = "You read one block of a tender and list all that it asks of a bidder, each duty as an entry of its own. Headings, tables of contents and forms ask for nothing.\n" + ITEMS
GLEAN = "You read one block of a tender a second time. What the first reading found is listed under Already listed. Report only duties that the block states and the list lacks; often there are none.\n" + ITEMS
REGIONS = {
    "lv-position": "The block is one priced position: its main delivery and what is asked of it besides.",
    "vorbemerkungen": "The block is a general specification that holds for many positions: each technical demand is an entry.",
    "section": "The block is prose or a numbered item: each duty in it is an entry.",
}
JUDGE = """You are shown two requirements of one tender. Decide whether they are about the same deliverable, so that a bidder would answer them as one.
Reply with one JSON object: {"relation": "same" or "different", "reason": "..."}. If in doubt, they are different."""
INLINE = """You are given the numbered requirements of a tender. Sort them into themes (level1, three to twelve) and topics within these (level2), named as a reader of the tender would name them. Every number belongs to one topic.
Reply with one JSON object: {"level1": [{"name": "...", "level2": [{"name": "...", "itemIndices": [0, 1]}]}]}."""
INDUCE = """You are given the categories of a tender by key, with their sizes and some titles. Name each category (l2) and the theme it belongs to (l1); a few themes cover all of them.
Reply with one JSON object: {"assignments": [{"key": "...", "l1": "...", "l2": "..."}]}, an entry for every key."""


def by_region(base: str, region: Column) -> Column:
    """Column: the instructions of a stage, with what the region of a block is; an unknown region is a section."""
    kinds = F.create_map(*[F.lit(x) for pair in REGIONS.items() for x in pair])
    return F.concat(F.lit(base + "\n\nThe block: "), F.coalesce(F.try_element_at(kinds, region), F.lit(REGIONS["section"])))
