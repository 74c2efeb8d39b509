"""Splitting oversized texts at natural boundaries by packing a structure tree.

A text is parsed into a tree of its lines: headings by rank (markup, position
codes by their depth, capitals), paragraphs between blank lines, list items by
indentation or markup nesting, lines. Subtrees that fit stay whole; in a node
that doesn't, the children are packed first, then sibling subtrees are merged,
smallest neighbours first, while they fit, then the remainders of opened ones.
Only lines that exceed the limit are opened further, into sentences, words and,
where nothing else is left, lengths. Each piece repeats the end of the one
before it, from a boundary where there is one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.operators.latest import latest
from tenderloom.runtime import ship

LIMIT, OVERLAP = 12_000, 400

#: What opens a node of the tree, and its rank; a node holds what follows it up to the next of its rank or a higher (lesser) one.
MARKUP = re.compile(r"(?:(#{1,6}) |<h([1-6])\b)", re.I)
CODE = re.compile(r"(?:[A-Z]{2}\.)?\d{2}(?:\.\d{2,5}){1,4}(?=\s)")
CAPITALS = re.compile(r"[^\Wa-z\d_](?:[^\Wa-z_]|[ /&-]){2,58}[^\Wa-z_]\s*$")
ITEM = re.compile(r"([^\S\n]*)(?:[•·*-]|\d{1,3}[.)]|[A-Za-z][.)])\s+\S")
TAG = re.compile(r"<(/?)(ul|ol|li|table|tr|div|section|article)\b[^>]*>", re.I)
CODES, CAPS, PARAGRAPH, ITEMS, LINE = 10, 20, 30, 40, 1_000

SENTENCE = re.compile(r"(?<=[.!?])\s+(?=\S)")
WORD = re.compile(r"(?<=\S)\s+(?=\S)")
#: Where a repeated end may begin, best first.
LEADS = (re.compile(r"(?<=[.!?])\s+(?=\S)|(?<=\n)(?=\S)"), WORD)

Span = tuple[int, int]


@dataclass
class Node:
    start: int
    rank: int
    end: int = 0
    children: list[Node] = field(default_factory=list)


def tree(text: str) -> Node:
    """The structure tree of a text. White space stays with the node before it; a node's own first line is its first child."""
    root = Node(0, 0, len(text))
    stack, blank, depth = [root], False, 0
    at = 0
    for line in text.splitlines(keepends=True):
        begin, at = at, at + len(line)
        if not line.strip():
            blank = True
            continue
        rank = LINE
        if m := MARKUP.match(line):
            rank = len(m[1]) if m[1] else int(m[2])
        elif m := CODE.match(line):
            rank = CODES + m[0].count(".")
        elif CAPITALS.match(line):
            rank = CAPS
        elif TAG.match(line.lstrip()):
            rank = ITEMS + depth  # one below its element's: an opening tag within the one around it, a closing one within its own
        elif m := ITEM.match(line):
            rank = ITEMS + min(len(m[1].expandtabs(4)), 99)
        elif blank:
            rank = PARAGRAPH
        depth = max(0, depth + sum(-1 if m[1] else 1 for m in TAG.finditer(line)))
        blank = False
        while stack[-1].rank >= rank:
            stack.pop().end = begin
        node = Node(begin, rank)
        stack[-1].children.append(node)
        stack.append(node)
    for node in stack[1:]:
        node.end = len(text)
    return root


def opened(text: str, node: Node) -> list[Node]:
    """The children of a node, which cover it: its own first line goes before them, white space at its beginning with the first."""
    parts = node.children
    first = text.find("\n", node.start, node.end) + 1 if node.rank else 0
    if parts and node.rank and first and parts[0].start > node.start:
        return [Node(node.start, LINE, parts[0].start), *parts]
    if parts and parts[0].start > node.start:
        head = parts[0]
        return [Node(node.start, head.rank, head.end, head.children), *parts[1:]]
    return parts


def leaves(text: str, start: int, end: int, limit: int) -> list[Span]:
    """A line in spans of at most ``limit``: by sentences, these by words, these by length; neighbours are joined from the left while they fit."""
    if end - start <= limit:
        return [(start, end)]
    for pattern in (SENTENCE, WORD):
        cuts = [m.end() for m in pattern.finditer(text, start, end) if start < m.end() < end]
        if cuts:
            at, out = [start, *cuts, end], []
            for a, b in zip(at, at[1:], strict=False):
                if out and b - out[-1][0] <= limit:
                    out[-1] = (out[-1][0], b)
                else:
                    out.append((a, b))
            return [x for a, b in out for x in leaves(text, a, b, limit)]
    return [(i, min(i + limit, end)) for i in range(start, end, limit)]


def merged(spans: list[Span], able: list[bool], limit: int) -> list[Span]:
    """``spans`` in order, neighbours joined while they fit, those that are smallest together first; ``able`` tells whether a span may be joined to the one before it."""
    n = len(spans)
    left, right, end, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [b for _, b in spans], [True] * n
    todo = [(end[i + 1] - spans[i][0], i, i + 1) for i in range(n - 1) if able[i + 1]]
    heapify(todo)
    while todo:
        size, i, j = heappop(todo)
        if size > limit:
            break
        if not (alive[i] and alive[j]) or right[i] != j or end[j] - spans[i][0] != size:
            continue
        alive[j], end[i], right[i] = False, end[j], right[j]
        if right[i] < n:
            left[right[i]] = i
            if able[right[i]]:
                heappush(todo, (end[right[i]] - spans[i][0], i, right[i]))
        if left[i] >= 0 and able[i]:
            heappush(todo, (end[i] - spans[left[i]][0], left[i], i))
    return [(spans[i][0], end[i]) for i in range(n) if alive[i]]


def packed(text: str, node: Node, limit: int) -> list[Span]:
    """Spans of at most ``limit`` characters that cover a node: whole subtrees merged with their siblings, oversized ones packed by themselves before."""
    if node.end - node.start <= limit:
        return [(node.start, node.end)] if node.end > node.start else []
    parts = opened(text, node)
    if not parts:
        return leaves(text, node.start, node.end, limit)
    spans: list[Span] = []
    whole: list[bool] = []
    for child in parts:
        got = packed(text, child, limit)
        spans += got
        whole += [len(got) == 1 and child.end - child.start <= limit] * len(got)
    siblings = merged(spans, [i > 0 and whole[i] and whole[i - 1] for i in range(len(spans))], limit)
    return merged(siblings, [True] * len(siblings), limit)


def lead(text: str, at: int, overlap: int) -> int:
    """Where the repeated end of the piece before begins: at a sentence or line, else a word.

    Where there is neither, nothing is repeated, unless the cut itself is
    within a run without boundaries: then the ``overlap`` characters before.
    """
    low = max(0, at - overlap)
    for pattern in LEADS:
        for m in pattern.finditer(text, low, at):
            if low <= m.end() < at:
                return m.end()
    return low if 0 < at < len(text) and not text[at - 1].isspace() and not text[at].isspace() else at


def split(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(begin, own, end) of each piece: ``text[begin:own]`` repeats the piece before, ``text[own:end]`` is new.

    The own parts join up to the text; each piece has at most ``limit``
    characters. A text within the limit is one piece; an empty text none.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be less than the limit")
    if len(text) <= limit:
        return [(0, 0, len(text))] if text else []
    return [(lead(text, a, overlap) if i else a, a, b) for i, (a, b) in enumerate(packed(text, tree(text), limit - overlap))]


PIECES = "chunk_id string, piece_no int, begin_at int, own_at int, end_at int, content string"


def _cut(limit: int, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, text in zip(batch["chunk_id"], batch["content"], strict=True):
                rows = [(key, i, b, o, e, text[b:e]) for i, (b, o, e) in enumerate(split(text, limit, overlap))]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])

    return run


def oversized_pieces(chunks: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """The ordered pieces of each chunk whose ``content`` has more than ``limit`` characters.

    Each piece has at most ``limit`` characters, of which up to ``overlap``
    repeat the end of the piece before it; offsets count characters from 0. Of
    a redelivered ``chunk_id`` the last row counts, whatever the size of those
    before it; null contents and those within the limit give no rows; other
    columns are ignored. Only oversized texts are shuffled and leave the JVM.
    """
    ship(chunks.sparkSession)
    held = chunks.select("chunk_id", "loaded_at", F.when(F.length("content") > limit, F.col("content")).alias("content"))
    big = latest(held, "chunk_id", ["loaded_at"], ["chunk_id", "content"]).filter("content is not null")
    return big.mapInPandas(_cut(limit, overlap), PIECES)


def reassembled(chunks: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(chunk_id, n_chars, digest, within_limit, within_overlap): the own parts of each chunk's pieces put together again, and whether all pieces keep the limits."""
    own = F.expr("substr(content, own_at - begin_at + 1)")
    rows = oversized_pieces(chunks, limit, overlap).select("*", own.alias("own"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", "own"))), lambda x: x["own"]), "")
    kept = rows.groupBy("chunk_id").agg(joined.alias("text"), F.bool_and(F.length("content") <= limit).alias("within_limit"), F.bool_and(F.col("own_at") - F.col("begin_at") <= overlap).alias("within_overlap"))
    return kept.select("chunk_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("digest"), "within_limit", "within_overlap")


def oversized(chunks: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(chunk_id) of the chunks that had to be cut: those with a second piece."""
    return oversized_pieces(chunks, limit, overlap).filter("piece_no = 1").select("chunk_id")
