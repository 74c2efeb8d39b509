"""Deeply nested records into flat, related tables by Dewey labels.

Every node of a nested record gets the path of ordinals that leads to it from
the root (``r``, ``r.0``, ``r.0.3`` ...). The path identifies the node within
its record, its parent is the path without the last ordinal, and no surrogate
key has to be handed out, so records are labelled independently of each other
in one narrow pass: no shuffle, no per-level job, any depth.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.operators.latest import latest
from tenderloom.runtime import ship

CHILDREN, CHUNKS = "deliverableArray", "procurementDocumentChunkIdArray"
#: Nodes buffered before a batch of rows is handed to Spark.
BATCH_ROWS = 20_000


def _no_constant(word: str):
    raise ValueError(f"{word} is not JSON")


def parse(text: str | None):
    """The value of a JSON text, or ``ValueError``. NaN and Infinity, which JSON lacks, count as errors.

    Texts nested too deeply for the recursive scanner are read by an
    iterative one.
    """
    if text is None:
        raise ValueError("null")
    try:
        return json.loads(text, parse_constant=_no_constant)
    except RecursionError:
        return _parse_deep(text)


def _parse_deep(text: str):
    """JSON of any depth, with an explicit stack instead of recursion."""
    decoder = json.JSONDecoder(parse_constant=_no_constant)
    space = " \t\n\r"
    stack: list = []
    at, end = 0, len(text)

    def skip(i: int) -> int:
        while i < end and text[i] in space:
            i += 1
        return i

    def key(i: int) -> tuple[str, int]:
        i = skip(i)
        if i >= end or text[i] != '"':
            raise ValueError("a key is missing")
        name, i = json.decoder.scanstring(text, i + 1, True)
        i = skip(i)
        if i >= end or text[i] != ":":
            raise ValueError("a colon is missing")
        return name, i + 1

    while True:
        at = skip(at)
        if at >= end:
            raise ValueError("the text ends early")
        opened = text[at]
        if opened in "[{":
            box: list | dict = [] if opened == "[" else {}
            at = skip(at + 1)
            if at < end and text[at] == ("]" if opened == "[" else "}"):
                at, value = at + 1, box
            else:
                name = None
                if opened == "{":
                    name, at = key(at)
                stack.append([box, name])
                continue
        else:
            try:
                value, at = decoder.scan_once(text, at)
            except StopIteration:
                raise ValueError("a value is missing") from None
        while True:
            if not stack:
                if skip(at) != end:
                    raise ValueError("extra data")
                return value
            box, name = stack[-1]
            if isinstance(box, list):
                box.append(value)
            else:
                box[name] = value
            at = skip(at)
            if at >= end:
                raise ValueError("the text ends early")
            if text[at] == ",":
                at += 1
                if isinstance(box, dict):
                    stack[-1][1], at = key(at)
                break
            if text[at] != ("]" if isinstance(box, list) else "}"):
                raise ValueError("a comma is missing")
            stack.pop()
            at, value = at + 1, box


def elements(node: object, field: str) -> list:
    """The elements of an array field; a single value in its place is its only element; missing or null gives none."""
    value = node.get(field) if isinstance(node, dict) else None
    return value if isinstance(value, list) else [] if value is None else [value]


def plain(value: object) -> str:
    """A scalar as text: strings as they are, anything else as compact JSON."""
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    try:
        text.encode()
    except UnicodeEncodeError:  # half of a surrogate pair, which UTF-8 can't hold
        text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return text


def walk(root: object) -> Iterator[tuple[str, str | None, int, int, object]]:
    """(path, parent path, depth, ordinal, node) of every node, parents first, without recursion."""
    if root is None:
        return
    todo = [("r", None, 0, 0, root)]
    while todo:
        at = todo.pop()
        yield at
        path, _, depth, _, node = at
        todo.extend((f"{path}.{i}", path, depth + 1, i, x) for i, x in reversed(list(enumerate(elements(node, CHILDREN)))) if x is not None)


def _text(value: object) -> str | None:
    return None if value is None else plain(value)


def _node_rows(tree_id: str, root: object) -> Iterator[tuple]:
    for path, parent, depth, ord_, node in walk(root):
        get = node.get if isinstance(node, dict) else lambda _: None
        described = get("description")
        yield (tree_id, path, parent, depth, ord_, _text(get("bulletPoint")), _text(described), _text(get("priority")), _text(get("confidence")), _text(get("status")), isinstance(node, dict))


def _link_rows(tree_id: str, root: object) -> Iterator[tuple]:
    for path, _, _, _, node in walk(root):
        for i, x in enumerate(elements(node, CHILDREN)):
            if x is not None:
                yield (tree_id, path, "deliverable", i, f"{path}.{i}")
        for i, x in enumerate(elements(node, CHUNKS)):
            if x is not None:
                yield (tree_id, path, "chunk", i, plain(x))


NODES = "tree_id string, path string, parent_path string, depth int, ord int, bullet_point string, description string, priority string, confidence string, status string, is_object boolean"
LINKS = "tree_id string, parent_path string, link string, ord int, child string"


def _mapper(rows, names: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for batch in batches:
            for tree_id, text in zip(batch["tree_id"], batch["tree_json"], strict=True):
                try:
                    root = parse(text)
                except ValueError:
                    continue
                for row in rows(tree_id, root):
                    held.append(row)
                    if len(held) >= BATCH_ROWS:
                        yield pd.DataFrame(held, columns=names)
                        held = []
        yield pd.DataFrame(held, columns=names)

    return run


def _flatten(trees: DataFrame, rows, schema: str) -> DataFrame:
    ship(trees.sparkSession)
    names = [c.split()[0] for c in schema.split(", ")]
    once = latest(trees, "tree_id", ["produced_at", "loaded_at"], ["tree_id", "tree_json"])
    return once.mapInPandas(_mapper(rows, names), schema)


def tree_nodes(trees: DataFrame) -> DataFrame:
    """The node table: one row per node, keyed by (``tree_id``, ``path``), with its ``parent_path``.

    Redelivered trees count once (the last by ``produced_at``, ``loaded_at``).
    A null, blank or invalid ``tree_json`` and a root of ``null`` give no rows;
    null elements give none but count in ``ord``; fields that are missing are
    null; nested values come as JSON text. A node that is no object is kept
    with ``is_object`` false. Columns besides the named ones are ignored.
    """
    return _flatten(trees, _node_rows, NODES)


def tree_links(trees: DataFrame) -> DataFrame:
    """The link table: one row per non-null element of either array of any node.

    ``link`` is ``deliverable`` or ``chunk``; ``child`` is the path of the child
    or the chunk id; ``ord`` counts from 0, nulls included. A single value in
    place of an array is its only element. The same records give no rows as in
    ``tree_nodes``. Chunk ids that are no strings come as JSON text.
    """
    return _flatten(trees, _link_rows, LINKS)


def parent_of(path):
    """Column: the parent's label, by cutting off the last ordinal; null for a root."""
    return F.when(F.instr(path, ".") > 0, F.regexp_replace(path, r"\.[0-9]+$", ""))


def subtree_sizes(nodes: DataFrame) -> DataFrame:
    """(tree_id, path, n_nodes, n_leaves): descendants-or-self of each node, from the labels alone.

    Each node is counted towards every prefix of its own path, so the work is
    nodes times depth and the groups are combined map-side.
    """
    steps = F.split("path", r"\.")
    leaf = nodes.join(nodes.select("tree_id", F.col("parent_path").alias("path")).distinct().withColumn("inner", F.lit(True)), ["tree_id", "path"], "left").withColumn("leaf", F.col("inner").isNull().cast("long"))
    up = leaf.select("tree_id", "leaf", F.explode(F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "."))).alias("path"))
    return up.groupBy("tree_id", "path").agg(F.count("*").alias("n_nodes"), F.sum("leaf").alias("n_leaves"))
