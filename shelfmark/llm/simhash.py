"""SimHash near-dedup with a Gray-order hierarchical index (operator 2).

A fingerprint bit is the majority of that bit over the hashes of all word
shingles of a text. Equal fingerprints are one class; classes link at
``max_bits`` differing bits or fewer; documents get the smallest id reachable.

Search. Cut the 64 bits into ``max_bits + 2`` blocks: fingerprints at most
``max_bits`` apart agree in two of them, so each fingerprint is sent to one
group for every pair of blocks, with the value of both. A task sorts its groups
by Gray rank, where neighbours share long patterns, and builds on each group a
tree: a node knows which bits all its leaves share and their values. Pairs of
nodes are searched from the roots; the differences in shared bits add up on the
way down, and a pair with more than ``max_bits`` is pruned with all below it. A
pair whose leaves cannot differ in more bits is linked whole, and a pair that
is already one component is left out, so a group of near copies costs about its
size and not its square. Each task hands on links of every fingerprint to the
first of its component only; components are joined by ``common.components``.

A group above ``GROUP`` fingerprints is cut into parts, one task for every two
parts, so no group has to fit in one task. Exact at every size: there is no cap
on candidates, and what is left out changes no component.

Cases: null and empty texts and texts without words have fingerprint zero, and
are linked like others; fewer words than a shingle make one shingle; repeated
rows are in one class; a null ``doc_id`` counts as greater than every other id,
its component is null only if it reaches null ids alone; an empty table gives
no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import (
    beside,
    components,
    id_from_key,
    id_key,
    merge_labels,
    restored,
    table,
    tasks,
    written,
)

SHINGLE = 4
MAX_BITS = 4
SEED = 42
GROUP = 4096  # fingerprints of one group that one task compares among themselves
_FANOUT = 4
_ROWS = 1 << 15  # of whole groups, taken together by a task
_PAIRS = 1 << 17  # node pairs looked at in one step
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_TOP = np.uint64(1 << 63)


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle of lower-cased words, repeats included."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = [0, *ends[:-shingle].tolist()]
    pieces = map(joined.__getitem__, map(slice, starts, (ends[shingle - 1 :] - 1).tolist()))
    hashes = map(xxhash.xxh64_intdigest, pieces, repeat(SEED))
    return np.fromiter(hashes, dtype=np.uint64, count=len(starts))


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """One fingerprint per text: bits that are set in over half of its hashes."""
    sizes = np.array([len(h) for h in hashes], dtype=np.int64)
    counts = np.zeros((len(hashes), 64), dtype=np.int64)
    flat = np.concatenate([*hashes, np.empty(0, dtype=np.uint64)])
    starts = np.concatenate(([0], np.cumsum(sizes)))
    step = 1 << 16
    for low in range(0, len(flat), step):
        high = min(len(flat), low + step)
        first = int(np.searchsorted(starts, low, "right")) - 1
        last = int(np.searchsorted(starts, high, "left"))
        full = np.flatnonzero(sizes[first:last] > 0) + first
        bits = np.unpackbits(flat[low:high].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        at = np.maximum(starts[full] - low, 0)
        counts[full] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    packed = np.packbits(2 * counts > sizes[:, None], axis=1)
    return np.ascontiguousarray(packed).view(">u8").reshape(-1).astype(np.uint64)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per row: _key (id, never null), _text (hash of the text) and _rank.

    ``_rank`` is the Gray rank of the fingerprint, as a signed number in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            prints = []
            for low in range(0, len(texts), 512):
                part = texts.slice(low, 512).to_pylist()
                prints.append(majority([shingle_hashes(t or b"", shingle) for t in part]))
            codes = np.concatenate([*prints, np.empty(0, dtype=np.uint64)])
            rank = (gray_rank(codes) ^ _TOP).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rank)], names=["_key", "_text", "_rank"]
            )

    text = F.col("text").cast("string")
    rows = docs.select(
        id_key().alias("_key"), F.xxhash64(text).alias("_text"), text.cast("binary").alias("_bytes")
    )
    return rows.mapInArrow(run, "_key long, _text long, _rank long")


def codes_of(rank: np.ndarray) -> np.ndarray:
    """Fingerprints from the ordered Gray ranks."""
    rank = rank.view(np.uint64) ^ _TOP
    return rank ^ (rank >> np.uint64(1))


def _blocks(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of ``max_bits + 2`` blocks of the 64 bits."""
    cuts = np.linspace(0, 64, max_bits + 3).round().astype(int)
    return [(int(a), int(b - a)) for a, b in zip(cuts, cuts[1:], strict=False)]


class _Tree:
    """Trees over consecutive groups of Gray-sorted codes, level by level."""

    def __init__(self, codes: np.ndarray, group: np.ndarray):
        self.low = [np.arange(len(codes))]
        self.high = [np.arange(1, len(codes) + 1)]
        self.ands, self.ors = [codes], [codes]
        while True:
            starts = np.append(True, group[1:] != group[:-1])
            if starts.all():
                break
            first = np.maximum.accumulate(np.where(starts, np.arange(len(group)), 0))
            begin = np.flatnonzero((np.arange(len(group)) - first) % _FANOUT == 0)
            self.ands.append(np.bitwise_and.reduceat(self.ands[-1], begin))
            self.ors.append(np.bitwise_or.reduceat(self.ors[-1], begin))
            self.low.append(begin)
            self.high.append(np.append(begin[1:], len(group)))
            group = group[begin]


def _children(tree: _Tree, level: int, a: np.ndarray, b: np.ndarray):
    """Child pairs of node pairs of one level; of a node with itself, each pair once."""
    lows, highs = tree.low[level], tree.high[level]
    na, nb = highs[a] - lows[a], highs[b] - lows[b]
    count = na * nb
    owner = np.repeat(np.arange(len(a)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    x = lows[a][owner] + place // nb[owner]
    y = lows[b][owner] + place % nb[owner]
    keep = (a[owner] != b[owner]) | (x <= y)
    return x[keep], y[keep]


def linked(codes: np.ndarray, group: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """First leaf of the component of each code, from links inside its group alone."""
    tree = _Tree(codes, group)
    labels = np.arange(len(codes))
    top = len(tree.ands) - 1
    # Leaves below each node, to see whether a node is already one component.
    spans = [np.arange(len(codes))]
    for level in range(1, top + 1):
        spans.append(spans[-1][tree.low[level]])
    roots = np.arange(len(tree.ands[top]))
    stack = [(top, roots, roots)]
    lows = highs = None
    while stack:
        level, a, b = stack.pop()
        if len(a) > _PAIRS:
            half = len(a) // 2
            stack.append((level, a[half:], b[half:]))
            stack.append((level, a[:half], b[:half]))
            continue
        if lows is None:
            lows = [np.minimum.reduceat(labels, s) for s in spans]
            highs = [np.maximum.reduceat(labels, s) for s in spans]
        one = (lows[level][a] == highs[level][a]) & (lows[level][b] == highs[level][b])
        apart = ~(one & (lows[level][a] == lows[level][b]))
        a, b = a[apart], b[apart]
        aa, ao, ba, bo = (x[level][y] for y in (a, b) for x in (tree.ands, tree.ors))
        shared = ~(aa ^ ao) & ~(ba ^ bo)
        close = np.bitwise_count((aa ^ ba) & shared) <= max_bits
        whole = np.bitwise_count((aa & ba) ^ (ao | bo)) <= max_bits
        x, y = a[whole], b[whole]
        if len(x):
            # All leaves of both are within the distance of each other: link them to one.
            ends = [np.append(s[1:], len(codes)) for s in (spans[level],)][0]
            left, right = [spans[level][x]], [spans[level][y]]
            for node in (x, y):
                size = ends[node] - spans[level][node]
                start = np.repeat(spans[level][node], size)
                step = np.arange(len(start)) - np.repeat(np.cumsum(size) - size, size)
                left.append(start)
                right.append(start + step)
            labels = merge_labels(labels, np.concatenate(left), np.concatenate(right))
            lows = highs = None
        rest = close & ~whole
        if level and rest.any():
            x, y = _children(tree, level, a[rest], b[rest])
            # The deepest pairs first: their links prune the others.
            stack.append((level - 1, x, y))
    return labels


def _search(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (_group, _part, _rank, _key) sorted by group; yields links to the first of each component."""

    def links(columns: list[np.ndarray]) -> pa.RecordBatch:
        group, part, rank, key = columns
        new = (group[1:] != group[:-1]) | (part[1:] != part[:-1])
        number = np.concatenate(([0], np.cumsum(new)))
        size = np.bincount(number)[number]
        several = size > 1
        rank, key, number = rank[several], key[several], number[several]
        if len(rank):
            labels = linked(codes_of(rank), number, max_bits)
            moved = labels != np.arange(len(labels))
            a, b = key[moved], key[labels[moved]]
        else:
            a = b = np.empty(0, dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    held: list[np.ndarray] | None = None
    for batch in batches:
        got = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = got if held is None else [np.concatenate(x) for x in zip(held, got, strict=True)]
        if len(held[0]) < _ROWS:
            continue
        group, part = held[0], held[1]
        ends = np.flatnonzero((group[1:] != group[:-1]) | (part[1:] != part[:-1]))
        if len(ends):
            cut = int(ends[-1]) + 1
            yield links([x[:cut] for x in held])
            held = [x[cut:] for x in held]
    if held is not None and len(held[0]):
        yield links(held)


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect every component.

    ``prints`` has each ``_rank`` once, with a ``_key``.
    """
    code = "shiftrightunsigned(_rank ^ (-9223372036854775807L - 1), {0})"
    bare = f"({code.format(0)} ^ {code.format(1)})"
    blocks = _blocks(max_bits)
    groups = []
    for number, pair in enumerate(combinations(blocks, 2)):
        value = "0L"
        for shift, width in pair:
            block = f"(shiftrightunsigned(_code, {shift}) & {(1 << width) - 1}L)"
            value = f"(shiftleft({value}, {width}) | {block})"
        groups.append(f"(shiftleft({number}L, 48) | {value})")
    rows = prints.selectExpr("_rank", "_key", f"{bare} AS _code").selectExpr(
        "_rank", "_key", f"explode(array({', '.join(groups)})) AS _group"
    )
    crowded = rows.groupBy("_group").agg(F.count("*").alias("_size")).where(F.col("_size") > GROUP)
    rows = rows.join(crowded, "_group", "left")
    # A part of a crowded group meets every other part once, in a task of its own.
    parts = f"cast(ceil(_size / {GROUP // 2}) AS int)"
    rows = rows.withColumn("_parts", F.expr(parts)).withColumn(
        "_mine", F.expr("pmod(xxhash64(_rank), _parts)")
    )
    others = """CASE WHEN _size IS NULL THEN array(0L) ELSE
        transform(filter(sequence(0, _parts - 1), x -> x <> _mine),
                  x -> least(x, _mine) * 4294967296L + greatest(x, _mine)) END"""
    rows = rows.selectExpr("_group", f"explode({others}) AS _part", "_rank", "_key")
    rows = rows.repartition(tasks(prints.sparkSession), "_group", "_part")
    rows = rows.sortWithinPartitions("_group", "_part", "_rank")
    return rows.mapInArrow(lambda batches: _search(batches, max_bits), "a long, b long")


def grouped(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: _key, _text, _rank and _component, the smallest rank that is reached."""
    prints = written(fingerprints(docs, shingle), "prints")
    classes = prints.select("_rank", F.col("_rank").alias("_key")).distinct()
    reached = components(near_links(written(classes, "classes"), max_bits))
    reached = reached.selectExpr("node AS _rank", "component AS _component")
    # Most fingerprints are alone: only those with a link are in ``reached``.
    return prints.join(reached, "_rank", "left").withColumn(
        "_component", F.coalesce("_component", "_rank")
    )


def near_copies(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: doc_id, fingerprint, component_id."""
    rows = written(grouped(docs, shingle, max_bits), "grouped")
    # Written: Spark splits a hot component only where both sides come from a shuffle.
    lowest = written(rows.groupBy("_component").agg(F.min("_key").alias("_lowest")), "lowest")
    unsigned = "(_rank ^ (-9223372036854775807L - 1))"
    code = f"({unsigned} ^ shiftrightunsigned({unsigned}, 1))"
    return rows.join(lowest, "_component").select(
        id_from_key("_key").alias("doc_id"),
        F.expr(f"lower(lpad(hex({code}), 16, '0'))").alias("fingerprint"),
        id_from_key("_lowest").alias("component_id"),
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Of each group the row with the smallest id, and of rows with that id the first by text hash."""
    rows = grouped(docs, shingle, max_bits)
    first = rows.groupBy("_component").agg(F.min(F.struct("_key", "_text")).alias("_first"))
    first = first.select("_first.*").distinct()
    keyed = beside(docs, _key=id_key(), _text=F.xxhash64(F.col("text").cast("string")))
    kept = keyed.join(first, ["_key", "_text"], "left_semi")
    once = Window.partitionBy("_key", "_text").orderBy("_key")
    kept = kept.withColumn("_copy", F.row_number().over(once)).where("_copy = 1")
    return restored(kept, docs)


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))
