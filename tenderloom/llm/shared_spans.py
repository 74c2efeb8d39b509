"""Long exact spans shared between records, by paragraph MinHash banding.

Texts are cut into short paragraphs whose boundaries depend on nearby
characters only. Each paragraph is MinHashed over its five-word shingles and
banded, with bands tuned for the similarity and recall that are asked for;
paragraphs of different records that share a band key collide. A verbatim
stretch of SPAN characters always contains a whole paragraph, and equal
paragraphs collide in every band, so the SPAN-long windows that hold a
colliding paragraph, and none that would have to collide but doesn't, are all
that an exact check has to compare. They are compared in groups: windows with
the same least gram at their beginning, a place that equal windows agree on,
are one row with a hash of the piece all of them hold and a hash of the whole
stretch they cover. Where every stretch with a piece is in two records, all its
windows are shared; only where one isn't, at the ends of what is shared, the
windows are compared one by one by 128-bit hashes. Groups are only ever reduced
to their least and greatest record, so a passage in a third of all records needs
no pairs.

For near-duplicate paragraphs, colliding ones are verified by their exact
Jaccard similarity and clustered by connected components: first with one centre
of each band, so most are connected before those that are still apart are
paired.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.llm.components import star_components
from tenderloom.runtime import Cut, ship

SPAN = 450
SHINGLE = 5
#: A paragraph ends after a sentence or at a blank line; one longer than LONG is cut at winnowed places. White space between them that is longer than GAP is one, too.
END = re.compile(r"(?<=[.!?])\s+|\n\s*\n")
LONG, GAP, GRAM, WINDOW = 200, 8, 12, 32
U64 = np.uint64


def tune_bands(similarity: float, recall: float, most: int = 128) -> tuple[int, int]:
    """(bands, rows) with the most rows a band that find a pair of ``similarity`` with probability ``recall``, in at most ``most`` hashes."""
    for rows in range(8, 0, -1):
        p = similarity**rows
        bands = 1 if p >= 1 else int(np.ceil(np.log1p(-recall) / np.log1p(-p)))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no banding within that many hashes")


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> U64(27))) * U64(0x94D049BB133111EB)
        return z ^ (z >> U64(31))


def _gram_hashes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
    n = len(codes) - GRAM + 1
    if n < 1:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, U64)
        for i in range(GRAM):
            h = h * U64(0x9E3779B97F4A7C15) + codes[i : i + n]
    return _mix(h)


def _least(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each place in ``at`` that of the least of WINDOW hashes from it on, the last of equals."""
    rows = np.lib.stride_tricks.sliding_window_view(h, WINDOW)[at, ::-1]
    return at + WINDOW - 1 - rows.argmin(axis=1)


def winnowed(text: str) -> list[int]:
    """Places of the least GRAM-character hash of every WINDOW in a row, the last of equals. At most WINDOW apart; each depends on its surroundings only."""
    h = _gram_hashes(text)
    if len(h) <= WINDOW:
        return [len(h) - 1 - int(np.argmin(h[::-1]))] if len(h) else []
    return np.unique(_least(h, np.arange(len(h) - WINDOW + 1))).tolist()


def paragraphs(text: str) -> list[tuple[int, int, int, int]]:
    """(begin, end, from, to) of the paragraphs of a text.

    Any SPAN characters that two texts share contain a whole paragraph, at the
    same place of both: parts of two paragraphs of at most LONG and a gap of at
    most GAP are fewer. A text that shares the characters ``from`` to ``to``
    has this paragraph, too; both are -1 for one that depends on more than
    those: the first, the last, parts of a long one and white space.
    """
    spans, at, seen = [], 0, -1

    def parts(begin: int, end: int) -> None:
        cuts = [begin, *(begin + p for p in winnowed(text[begin:end]) if p), end] if end - begin > LONG else [begin, end]
        spans.extend((a, b, -1, -1) for a, b in zip(cuts, cuts[1:], strict=False) if b > a)

    for m in [*END.finditer(text), None]:
        to = m.start() if m else len(text)
        if to > at:
            if to - at <= LONG and m and seen >= 0:
                spans.append((at, to, seen, m.end()))
            else:
                parts(at, to)
        if m:
            if m.end() - m.start() > GAP:
                parts(m.start(), m.end())
            at, seen = m.end(), m.start() - 1
    return spans


@lru_cache
def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20)
    return r.integers(1, 2**63, n, np.int64).astype(U64) * U64(2) + U64(1), r.integers(0, 2**63, n, np.int64).astype(U64)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and hashes of the SHINGLE-word runs of each text; a text with fewer words has one run of all, one without words its white space."""
    words, count = [], []
    for t in texts:
        w = t.lower().split() or [t]
        words.extend(w)
        count.append(len(w))
    count = np.array(count, np.int64)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], U64)
    start = np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])
    runs = np.maximum(count - SHINGLE + 1, 1)
    off = np.concatenate([np.zeros(1, np.int64), np.cumsum(runs)])
    row = np.repeat(np.arange(len(texts)), runs)
    first = start[:-1][row] + np.arange(off[-1]) - off[:-1][row]
    out = np.zeros(len(row), U64)
    with np.errstate(over="ignore"):
        for i in range(SHINGLE):
            inside = first + i < start[1:][row]
            out = out * U64(0x9E3779B97F4A7C15) + np.where(inside, h[np.minimum(first + i, len(h) - 1)], U64(1))
    return off, _mix(out)


def band_keys(off: np.ndarray, grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """MinHash band keys, texts by bands."""
    mul, add = _seeds(bands * rows)
    keys = np.zeros((len(off) - 1, bands), U64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            key = np.full(len(off) - 1, b + 1, U64)
            for i in range(b * rows, (b + 1) * rows):
                key = _mix(key * U64(31) + np.minimum.reduceat(_mix(grams * mul[i] + add[i]), off[:-1]))
            keys[:, b] = key
    return keys


def _key_rows(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, begin, end, texts = [], [], [], []
            for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for a, b, *_ in paragraphs(t):
                    ids.append(d)
                    begin.append(a)
                    end.append(b)
                    texts.append(t[a:b])
            if texts:
                keys = band_keys(*shingles(texts), bands, rows)
                rep = lambda x, kind: pa.array(np.repeat(np.array(x, kind), bands))
                yield pa.RecordBatch.from_arrays([rep(ids, np.int64), rep(begin, np.int32), rep(end, np.int32), pa.array(keys.ravel().view(np.int64))], names=["doc_id", "begin", "end", "band"])

    return run


_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    with np.errstate(over="ignore"):
        power = lambda b: np.concatenate([np.ones(1, U64), np.cumprod(np.full(n - 1, b, U64), dtype=U64)])
        return power(base), power(pow(base, -1, 1 << 64))


def prefix_hashes(text: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Two polynomial hashes, modulo 2^64, of every beginning of a text, each with the powers to shift them by."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
    out = []
    with np.errstate(over="ignore"):
        for i, base in enumerate(_BASES):
            up, down = _powers(base, 1 << max(12, int(len(codes)).bit_length()))
            out.append((np.concatenate([np.zeros(1, U64), np.cumsum(_mix(codes + U64(i * 7919 + 1)) * up[: len(codes)], dtype=U64)]), down))
    return out


def stretch_hash(prefix: list[tuple[np.ndarray, np.ndarray]], no: int, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Hash ``no`` of the characters from each ``start`` on, with their number."""
    run, down = prefix[no]
    with np.errstate(over="ignore"):
        return _mix((run[start + length] - run[start]) * down[start] + U64(0xD6E8FEB86659FD93) * np.asarray(length, U64))


def _candidates(text: str, near: set[int], span: int) -> np.ndarray:
    """Where the windows begin that hold a colliding paragraph and none that would have to collide but doesn't."""
    n = len(text) - span + 1
    hit, miss = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    for begin, end, first, last in paragraphs(text):
        edge = hit
        if begin not in near:
            if first < 0:
                continue
            edge, begin, end = miss, first, last
        a, b = max(0, end - span), min(n - 1, begin)  # where the windows that hold it begin
        if a <= b:
            edge[a] += 1
            edge[b + 1] -= 1
    return np.flatnonzero((np.cumsum(hit[:-1]) > 0) & (np.cumsum(miss[:-1]) == 0))


STRETCHES = "doc_id long, first int, last int, piece long, g1 long, g2 long"


def _stretches(span: int):
    """Rows of neighbouring windows with one least gram: the first and last of them, a hash of the piece they all hold and two of all they cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for d, t, begins in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "begins")), strict=True):
                at = _candidates(t, set(begins), span)
                if not len(at):
                    continue
                least = _least(_gram_hashes(t), at)
                fresh = np.r_[True, (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)]
                first, last, place = at[fresh], at[np.r_[fresh[1:], True]], least[fresh]
                # A hash of each length in turn, of the few that occur.
                prefix = prefix_hashes(t)
                columns = (np.full(len(first), d, np.int64), first.astype(np.int32), last.astype(np.int32), stretch_hash(prefix, 0, place, span - WINDOW + 1).view(np.int64), *(stretch_hash(prefix, i, first, last - first + span).view(np.int64) for i in (0, 1)))
                for x, y in zip(out, columns, strict=True):
                    x.append(y)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=[c.split()[0] for c in STRETCHES.split(", ")])

    return run


def _windows(span: int):
    """The windows of some stretches, each with two hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            for d, t, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans")), strict=True):
                at = np.concatenate([np.arange(x["first"], x["last"] + 1) for x in spans])
                prefix = prefix_hashes(t)
                for x, y in zip(out, (*(stretch_hash(prefix, i, at, span).view(np.int64) for i in (0, 1)), np.full(len(at), d, np.int64), at.astype(np.int32)), strict=True):
                    x.append(y)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["h1", "h2", "doc_id", "at"])

    return run


def _in_two(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that two different records have."""
    return rows.groupBy(*keys).agg(F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b")).filter("_a <> _b").select(*keys)


def shared_chars(documents: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, shared_chars): the characters of ``text`` within some stretch of at least ``span`` that another record has, too.

    Characters are code points; texts are compared as stored. Records without
    such a stretch, with a null id or with a null or shorter text have no row.
    Repeated rows of a ``doc_id`` count once (the greatest text). ``span`` must
    be at least SPAN, for which paragraphs are cut short enough.
    """
    if span < SPAN:
        raise ValueError(f"paragraphs are cut for spans from {SPAN} characters on")
    ship(documents.sparkSession)
    bands, rows = tune_bands(1.0, 0.99)
    docs = documents.filter(F.col("doc_id").isNotNull() & (F.length("text") >= span)).select("doc_id", "text")
    keyed = Cut(docs.mapInArrow(_key_rows(bands, rows), "doc_id long, begin int, end int, band long"), "paragraphs")
    near = keyed.df.join(_in_two(keyed.df, ["band"]), "band").groupBy("doc_id").agg(F.collect_set("begin").alias("begins"))
    texts = docs.join(near, "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.first("begins").alias("begins"))
    found = Cut(texts.mapInArrow(_stretches(span), STRETCHES), "stretches").df
    keyed.drop()
    least, greatest = F.min("doc_id"), F.max("doc_id")
    whole = found.groupBy("piece", "g1", "g2").agg(least.alias("a"), greatest.alias("b"))
    pieces = whole.groupBy("piece").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.bool_or(F.col("a") == F.col("b")).alias("torn")).filter("a <> b")
    met = Cut(found.join(pieces.select("piece", "torn"), "piece").select("doc_id", "first", "last", "torn"), "met").df
    torn = met.filter("torn").groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    cut = docs.join(torn, "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.first("spans").alias("spans"))
    windows = Cut(cut.mapInArrow(_windows(span), "h1 long, h2 long, doc_id long, at int"), "windows").df
    hit = windows.join(_in_two(windows, ["h1", "h2"]), ["h1", "h2"]).select("doc_id", F.col("at").alias("first"), F.col("at").alias("last"))
    ranges = met.filter("not torn").select("doc_id", "first", "last").unionByName(hit)
    # What each range adds beyond those that begin before it.
    step = F.aggregate(
        F.array_sort(F.collect_list(F.struct("first", "last"))), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")),
        lambda x, r: F.struct((x["n"] + F.greatest(F.lit(0), r["last"] + span - F.greatest(r["first"], x["upto"]))).alias("n"), F.greatest(x["upto"], r["last"] + span).alias("upto")), lambda x: x["n"],
    )
    return ranges.groupBy("doc_id").agg(step.alias("shared_chars"))


def _shingle_rows(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            off, grams = shingles(batch.column("text").to_pylist())
            row = np.repeat(np.arange(n), np.diff(off))
            order = np.lexsort((grams, row))
            fresh = np.r_[True, (grams[order][1:] != grams[order][:-1]) | (row[order][1:] != row[order][:-1])]
            kept, where = grams[order][fresh], row[order][fresh]
            new = np.searchsorted(where, np.arange(n + 1)).astype(np.int32)
            keys = band_keys(off, grams, bands, rows)
            bit = _mix(kept * U64(0x9E3779B97F4A7C15)) & U64(127)
            one = U64(1) << (bit & U64(63))
            sketch = [np.bitwise_xor.reduceat(np.where((bit < U64(64)) == low, one, U64(0)), new[:-1]).view(np.int64) for low in (True, False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("pid"), pa.array(np.diff(new)), *map(pa.array, sketch), pa.ListArray.from_arrays(pa.array(new), pa.array(kept.view(np.int64))), pa.ListArray.from_arrays(pa.array((np.arange(n + 1) * bands).astype(np.int32)), pa.array(keys.ravel().view(np.int64)))],
                names=["pid", "size", "s0", "s1", "grams", "bands"],
            )

    return run


def _paragraph_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            at = 0
            for m in [*END.finditer(t), None]:  # whole, however long
                piece = t[at : m.start() if m else None]
                if piece.strip():
                    rows.append((d, at, piece))
                at = m.end() if m else at
        if rows:
            d, a, t = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(a, pa.int32()), pa.array(t)], names=["doc_id", "begin", "text"])


#: Hashes of a paragraph at most: few bands of few rows each are less to move, and sizes and sketches rule out what they let through.
HASHES = 48
#: Pairs of a band that are still apart, for each of its rows on average, above which another centre is tried before they are paired.
APART, CENTRES = 8, 12


def _verified(met: DataFrame, made: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) of ``met`` whose shingles have that Jaccard similarity."""
    side = lambda s: made.select(F.col("pid").alias(s), F.col("grams").alias(f"{s}_grams"))
    both = F.size(F.array_intersect("u_grams", "v_grams"))
    return met.join(side("u"), "u").join(side("v"), "v").filter(both >= similarity * (F.size("u_grams") + F.size("v_grams") - both)).select("u", "v")


def _links(made: DataFrame, similarity: float) -> DataFrame | None:
    """Verified pairs that connect what all pairs with a common band key would connect.

    A band's rows are first compared with one of them, its centre, and those of
    one component with it need no pairs among themselves. Only pairs of
    different components are left; while they are many, another centre is
    tried. All that are left then are compared, so none is lost.
    """
    columns = ("pid", "size", "s0", "s1")
    rows = made.select("pid", F.explode("bands").alias("band"))
    common = rows.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    keys = Cut(rows.join(common, "band").join(made.select(*columns), "pid").withColumn("root", F.col("pid")), "keys").df
    links: DataFrame | None = None
    fits = (F.least("u_size", "v_size") >= similarity * F.greatest("u_size", "v_size")) & (
        F.bit_count(F.col("u_s0").bitwiseXOR(F.col("v_s0"))) + F.bit_count(F.col("u_s1").bitwiseXOR(F.col("v_s1"))) <= (1 - similarity) / (1 + similarity) * (F.col("u_size") + F.col("v_size")) + 1e-9
    )
    for turn in range(CENTRES + 1):
        # Only bands that still hold two components matter; the centre of each is another one in every turn.
        centre = keys.groupBy("band").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "pid"), "root", *columns)).alias("c"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
        apart = Cut(keys.join(centre.select("band", "c"), "band"), "apart").df
        held = apart.groupBy("band", "root").agg(F.count("*").alias("n")).groupBy("band").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("within"))
        got = held.agg(F.sum("n").alias("rows"), F.sum((F.col("n") * F.col("n") - F.col("within")) / 2).alias("pairs")).first()
        if not got["rows"]:
            break
        last = turn == CENTRES or got["pairs"] <= APART * got["rows"]
        if last:
            u, v = (apart.select("band", *[F.col(c).alias(f"{x}_{c}") for c in (*columns, "root")]) for x in "uv")
            met = u.join(v, "band").filter(F.col("u_pid") < F.col("v_pid"))
        else:
            met = apart.select(*[F.col(c).alias(f"u_{c}") for c in (*columns, "root")], *[F.col(f"c.{c}").alias(f"v_{c}") for c in (*columns, "root")])
        met = met.filter(F.col("u_root") != F.col("v_root")).filter(fits).select(F.least("u_pid", "v_pid").alias("u"), F.greatest("u_pid", "v_pid").alias("v")).distinct()
        more = Cut(_verified(met, made, similarity), "links").df
        links = more if links is None else links.unionByName(more)
        if last:
            break
        roots = star_components(links).select(F.col("node").alias("pid"), F.col("root").alias("_root"))
        keys = Cut(apart.drop("c").join(roots, "pid", "left").withColumn("root", F.coalesce("_root", "pid")).drop("_root"), "keys").df
    return links


def paragraph_clusters(documents: DataFrame, similarity: float = 0.8, recall: float = 0.95) -> DataFrame:
    """(doc_id, begin, cluster_doc, cluster_begin, members, removed): one row per paragraph that repeats another, exactly or nearly.

    Paragraphs with at least SHINGLE words are linked if their five-word
    shingles have a Jaccard similarity of ``similarity``, shorter ones only to
    equal ones. A cluster is what links connect, named by its first paragraph,
    which stays while the others are ``removed``; ``members`` is the number of
    its paragraphs. Equal paragraphs are one node, so copies are never paired.
    Candidates are pairs of different texts with a common band key, banded to
    find ``recall`` of the pairs just at the threshold; pairs that can't change
    a cluster any more are not compared. Null ids and texts give nothing; of
    paragraphs at one place of a repeated id one counts.
    """
    ship(documents.sparkSession)
    bands, rows = tune_bands(similarity, recall, HASHES)
    docs = documents.filter("doc_id is not null and text is not null").select("doc_id", "text")
    pieces = docs.mapInArrow(_paragraph_rows, "doc_id long, begin int, text string")
    placed = Cut(pieces.select("doc_id", "begin", "text", F.md5("text").alias("digest")).groupBy("doc_id", "begin").agg(F.max(F.struct("digest", "text")).alias("r")).select("doc_id", "begin", "r.*"), "pieces").df
    once = placed.groupBy("digest").agg(F.min("text").alias("text"), F.min(F.struct("doc_id", "begin")).alias("first"), F.count("*").alias("copies"))
    texts = Cut(once.select(F.monotonically_increasing_id().alias("pid"), "*"), "texts").df
    long = texts.select("pid", "text").filter(F.size(F.split(F.trim("text"), r"(?U)\s+")) >= SHINGLE)
    made = Cut(long.mapInArrow(_shingle_rows(bands, rows), "pid long, size int, s0 long, s1 long, grams array<long>, bands array<long>"), "grams").df
    links = _links(made, similarity)
    roots = star_components(links) if links is not None else texts.select(F.col("pid").alias("node"), F.col("pid").alias("root")).limit(0)
    named = texts.select("pid", "digest", "first", "copies").join(roots, texts["pid"] == roots["node"], "left").select("digest", "first", "copies", F.coalesce("root", "pid").alias("root"))
    heads = named.groupBy("root").agg(F.min("first").alias("head"), F.sum("copies").alias("members")).filter("members > 1")
    rows_ = placed.select("doc_id", "begin", "digest").join(named.select("digest", "root").join(heads, "root"), "digest")
    return rows_.select("doc_id", "begin", F.col("head.doc_id").alias("cluster_doc"), F.col("head.begin").alias("cluster_begin"), "members", (F.struct("doc_id", "begin") != F.col("head")).alias("removed"))
