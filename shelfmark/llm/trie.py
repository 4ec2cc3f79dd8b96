"""Prefix trie of conversations as z-fast tries (operator 11).

A node stands for a sequence of turns with which conversations start. Each turn
is a digest of its role and text, taken in the scan; texts are never shuffled.
A chain of digests gives every prefix of a conversation a name of its own.

Conversations are sorted by their digests over all partitions, copies by id, so
each task holds a contiguous part of the trie in depth-first order. It puts its
conversations in batches into a z-fast trie: compacted nodes, hashed by the
prefix at the two-fattest depth of their edge. A conversation finds its exit
node by fat binary search, in probes of the logarithm of its length, and splits
the edge there. After a batch every node off the path of the last conversation
is complete: its values add up from below, its edge is expanded into one row
per depth, and it leaves the trie.

Only nodes on the path of a task's first or last conversation may go on in
another task. These are few (two paths per task): they are handed on per depth
with sums of what is complete below them, merged by name, and summed from below
along the paths, where each node is counted on the first path that holds it.
So a first turn or a conversation that a third of all rows share is split over
as many tasks as it fills, by range, and merged from one row per task.

The hash of the ids that end at such a node needs them in one order: tasks hand
on joined ids in chunks, and only these are read in a row.

Cases: null roles and texts are empty; turns of one conversation with equal
numbers (or null) are taken in order of their digests; repeated rows are turns
of their own; a null ``conv_id`` is no conversation; one without a turn left
ends at the root; an empty table gives no row; other columns are not read. A
conversation's digests (some 20 bytes a turn) lie in one task together, as a
document's text does; its texts do not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import sliced, table, tasks, written

#: Conversations of this many ids share a base; a hash below this number says how many turns of it.
BASE, TURNS = 5, 9
BATCH = 4096  # conversations put into a trie before complete nodes leave it
CHUNK = 1 << 12  # ids of one chunk, at least, where a node has as many
_SIZE = 16  # bytes of a digest
_ROOT = bytes(_SIZE)


def turn_digests(turns: DataFrame) -> DataFrame:
    """Per turn: conv_id, turn, digest of role and text, bytes of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    size = F.octet_length(role).cast("string")
    return turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat_ws(":", size, role, text).cast("binary"))).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )


def taken_turns(conv_id: int) -> int:
    """How many first turns a rebuilt conversation takes from its base."""
    return crc32(b"%d" % conv_id) % TURNS


def rebuilt(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, digests (all in a row) and bytes of its turns.

    The first h turns are those of conversation c - c % 5, the rest its own.
    """
    rows = turn_digests(turns).withColumn("_base", F.expr(f"conv_id - conv_id % {BASE}"))
    rows = rows.repartition(tasks(turns.sparkSession), "_base")
    rows = rows.sortWithinPartitions("_base", "conv_id", F.asc_nulls_first("turn"), "digest")
    rows = rows.select("_base", "conv_id", "digest", "bytes")

    def conversations(group: list[tuple]) -> Iterator[tuple]:
        base, members = group[0][0], {}
        for _, conv, digest, size in group:
            members.setdefault(conv, []).append((digest, size))
        for conv, own in members.items():
            h = taken_turns(conv)
            made = members.get(base, [])[:h] + own[h:]
            yield conv, b"".join(d for d, _ in made), [s for _, s in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in sliced(batches, 8192):
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][0] != row[0]:
                    out += conversations(held)
                    held = []
                held.append(row)
            yield record(out)
        if held:
            yield record(list(conversations(held)))

    def record(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 3
        kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64())]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "digests", "bytes"])

    return rows.mapInArrow(run, "conv_id long, digests binary, bytes array<long>")


def two_fattest(low: int, high: int) -> int:
    """The number above ``low``, up to ``high``, that the largest power of two divides."""
    return high & -1 << (low ^ high).bit_length() - 1


def prefix_names(digests: bytes) -> list[bytes]:
    """A name for every prefix, from the root's on."""
    names, name = [_ROOT], _ROOT
    for at in range(0, len(digests), _SIZE):
        name = hashlib.md5(name + digests[at : at + _SIZE]).digest()
        names.append(name)
    return names


class Node:
    """A compacted node: the edge from depth ``low`` (without it) to ``high``.

    ``names`` and ``sizes`` are those of one conversation that passes it.
    What is complete below it is kept as sums.
    """

    __slots__ = (
        "low", "high", "names", "sizes", "parent", "children",
        "ends", "handed", "left", "n", "least", "n_children", "n_leaves", "saved",
    )

    def __init__(self, low: int, high: int, names: list[bytes], sizes: list[int], parent):
        self.low, self.high, self.names, self.sizes = low, high, names, sizes
        self.parent, self.children, self.ends = parent, {}, []
        # Whether ids that end here were handed on, and whether children have left already.
        self.handed = self.left = False
        self.n = self.n_children = self.n_leaves = self.saved = 0
        self.least = None

    def handle(self) -> bytes:
        return self.names[two_fattest(self.low, self.high)]

    def gather(self, child: Node) -> None:
        """Take up the sums of a complete child."""
        self.n += child.n
        self.least = child.least if self.least is None else min(self.least, child.least)
        self.n_children += 1
        self.n_leaves += child.n_leaves
        self.saved += child.saved + (child.n - 1) * sum(child.sizes[child.low : child.high])


class ZFastTrie:
    """Conversations of one task; ``nodes`` maps handles to nodes."""

    def __init__(self):
        self.root = Node(-1, 0, [_ROOT], [], None)
        self.nodes: dict[bytes, Node] = {}

    def exit(self, names: list[bytes]) -> tuple[Node, int]:
        """The deepest node a path shares a turn of, and how many turns it shares at all."""
        low, high, node = 0, len(names) - 1, self.root
        while low < high:
            at = two_fattest(low, high)
            found = self.nodes.get(names[at])
            if found is None:
                high = at - 1
            elif found.high < len(names) and names[found.high] == found.names[found.high]:
                node, low = found, found.high
            else:
                return found, self._shared(found, names, at)
        if node.high + 1 < len(names):
            child = node.children.get(names[node.high + 1])
            if child is not None:
                # The path leaves the edge before the edge's handle.
                return child, self._shared(child, names, node.high + 1)
        return node, node.high

    @staticmethod
    def _shared(node: Node, names: list[bytes], known: int) -> int:
        """Turns a path shares with an edge, ``known`` of them for sure."""
        low, high = known, min(len(names) - 1, node.high)
        while low < high:
            middle = (low + high + 1) // 2
            if names[middle] == node.names[middle]:
                low = middle
            else:
                high = middle - 1
        return low

    def insert(self, conv: int, names: list[bytes], sizes: list[int]) -> Node:
        """The node at which the conversation ends."""
        node, shared = self.exit(names)
        if shared < node.high:
            node = self._split(node, shared)
        if len(names) - 1 > shared:
            leaf = Node(shared, len(names) - 1, names, sizes, node)
            node.children[names[shared + 1]] = leaf
            self.nodes[leaf.handle()] = leaf
            node = leaf
        node.ends.append(conv)
        return node

    def _split(self, node: Node, at: int) -> Node:
        """A new node above ``node``, which ends at depth ``at`` of its edge."""
        upper = Node(node.low, at, node.names, node.sizes, node.parent)
        del self.nodes[node.handle()]
        node.parent.children[node.names[node.low + 1]] = upper
        node.low, node.parent = at, upper
        upper.children[node.names[at + 1]] = node
        self.nodes[node.handle()] = node
        self.nodes[upper.handle()] = upper
        return upper

    @staticmethod
    def path(node: Node) -> list[Node]:
        """From the root to the node."""
        found = []
        while node is not None:
            found.append(node)
            node = node.parent
        return found[::-1]

    def take(self, kept: set[Node]) -> Iterator[list[Node]]:
        """Remove the complete trees below kept nodes; each as its nodes, a parent before its children."""
        for node in kept:
            for name, top in list(node.children.items()):
                if top in kept:
                    continue
                del node.children[name]
                order, at = [top], 0
                while at < len(order):
                    order.extend(order[at].children.values())
                    at += 1
                for done in reversed(order):
                    self.finish(done)
                node.gather(top)
                node.left = True
                for done in order:
                    del self.nodes[done.handle()]
                yield order

    @staticmethod
    def finish(node: Node) -> None:
        """The sums of a node whose children are finished."""
        for child in node.children.values():
            node.gather(child)
        node.n += len(node.ends)
        if node.ends:
            least = min(node.ends)
            node.least = least if node.least is None else min(node.least, least)
        if not node.n_children:
            node.n_leaves = 1


def _ids(conversations: list[int]) -> bytes:
    return ",".join(map(str, sorted(conversations))).encode()


_EMPTY = hashlib.sha256(b"").hexdigest()

#: Rows of a task. ``part`` 0: a complete node; 1: a node of a path, with sums of what is complete
#: below it; 2: a chunk of ids that end at a node. ``parent`` names a parent that is not complete,
#: else the parent's id is known. A complete node has a ``name`` if rows refer to it: if ids that
#: end there were handed on (then it has no hash), or children left when it was not complete.
_ROWS = (
    "part int, name binary, parent binary, path long, depth long, conv_id long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "bytes long, ends_sha256 string, ids binary"
)
_KINDS = {
    "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()
}
_FIELDS = [tuple(f.split()) for f in _ROWS.split(", ")]


class _Rows:
    """Rows of ``_ROWS`` by column name."""

    def __init__(self):
        self.rows: list[dict] = []

    def add(self, **values) -> None:
        self.rows.append(values)

    def drawn(self) -> pa.RecordBatch:
        arrays = [pa.array([r.get(n) for r in self.rows], _KINDS[k]) for n, k in _FIELDS]
        self.rows = []
        return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in _FIELDS])


def _expand(rows: _Rows, order: list[Node]) -> None:
    """One row for every depth of the edges of a complete tree."""
    top = order[0]
    for node in order:
        saved = node.saved
        ends = hashlib.sha256(_ids(node.ends)).hexdigest() if node.ends else _EMPTY
        named = node.handed or node.left
        if node.handed and node.ends:
            rows.add(
                part=2, name=node.names[node.high], conv_id=min(node.ends), ids=_ids(node.ends)
            )
        for depth in range(node.high, node.low, -1):
            saved += (node.n - 1) * node.sizes[depth - 1]
            first = depth == node.low + 1
            rows.add(
                part=0,
                name=node.names[depth] if named and depth == node.high else None,
                depth=depth,
                conv_id=node.least,
                parent=node.names[node.low] if first and node is top else None,
                parent_conv_id=(None if node is top else node.parent.least) if first else node.least,
                n_convs=node.n,
                n_children=node.n_children if depth == node.high else 1,
                n_leaves=node.n_leaves,
                saved_tokens=saved,
                ends_sha256=_EMPTY if depth < node.high else None if node.handed else ends,
            )


def _part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_ROWS`` for sorted conversations."""
    rows, trie = _Rows(), ZFastTrie()
    first = last = None
    for batch in sliced(batches, BATCH):
        for conv, digests, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            last = trie.insert(conv, prefix_names(digests), sizes)
            first = first or last
        if last is None:
            continue
        kept = {*trie.path(first), *trie.path(last)}
        for order in trie.take(kept):
            _expand(rows, order)
        # Ids that end on a path do not stay here, however many copies there are.
        for node in kept:
            if len(node.ends) >= CHUNK:
                _hand_on(rows, node)
        if rows.rows:
            yield rows.drawn()
    if last is None:
        return
    context = TaskContext.get()
    number = 2 * (context.partitionId() if context else 0)
    paths = [trie.path(first), trie.path(last)]
    kept = dict.fromkeys(n for path in paths for n in path)
    for node in kept:
        _hand_on(rows, node)
    # Members of a node are those below it, kept or not: the deepest nodes first.
    members, least = {}, {}
    for node in sorted(kept, key=lambda n: -n.high):
        below = [c for c in node.children.values() if c in kept]
        members[node] = node.n + sum(members[c] for c in below)
        known = [x for x in (node.least, *(least[c] for c in below)) if x is not None]
        least[node] = min(known)
    done: set[Node] = set()
    for side, path in enumerate(paths):
        for node in path:
            for depth in range(max(node.low + 1, 0), node.high + 1):
                # A node on both paths gives its sums once.
                once = node not in done
                at_end = once and depth == node.high
                rows.add(
                    part=1,
                    name=node.names[depth],
                    parent=node.names[depth - 1] if depth else None,
                    path=number + side,
                    depth=depth,
                    conv_id=least[node],
                    n_convs=members[node] if once else 0,
                    n_children=node.n_children if at_end else 0,
                    n_leaves=node.n_leaves if at_end else 0,
                    saved_tokens=node.saved if at_end else 0,
                    bytes=node.sizes[depth - 1] if depth else 0,
                )
        done.update(path)
    yield rows.drawn()


def _hand_on(rows: _Rows, node: Node) -> None:
    """Count the conversations that end at a node of a path, and hand on their ids."""
    if not node.ends:
        return
    least = min(node.ends)
    node.n += len(node.ends)
    node.least = least if node.least is None else min(node.least, least)
    rows.add(part=2, name=node.names[node.high], conv_id=least, ids=_ids(node.ends))
    node.ends, node.handed = [], True


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (name, conv_id, ids) in order; one hash for each name."""
    name = state = None
    for batch in sliced(batches, 64):
        out = []
        for got, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if got != name:
                if state is not None:
                    out.append((name, state.hexdigest()))
                name, state = got, hashlib.sha256(ids)
            else:
                state.update(b"," + ids)
        yield _hashes(out)
    if state is not None:
        yield _hashes([(name, state.hexdigest())])


def _hashes(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [(), ()]
    arrays = [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=["name", "ends_sha256"])


_NODE = [
    "conv_id", "depth", "parent_conv_id", "n_convs",
    "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def _end_hashes(parts: DataFrame) -> DataFrame:
    """(name, ends_sha256) of nodes whose ids were handed on."""
    ids = parts.where("part = 2").select("name", "conv_id", "ids")
    ids = ids.repartition(tasks(parts.sparkSession), "name").sortWithinPartitions("name", "conv_id")
    return ids.mapInArrow(_hashed, "name binary, ends_sha256 string")


def _merged(parts: DataFrame, hashes: DataFrame) -> DataFrame:
    """Nodes of all paths, each once, with their name; sums go up along the paths."""
    paths = parts.where("part = 1")
    nodes = paths.groupBy("name").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.first("bytes").alias("bytes"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
        F.min("path").alias("owner"),
    )
    nodes = written(nodes, "path-nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("name"))
    nodes = nodes.join(children.agg(F.count("*").alias("_more")), "name", "left")
    nodes = nodes.withColumn("n_children", F.expr("n_children + coalesce(_more, 0)"))
    # What a node adds by itself: complete leaves below it, or itself; its own saving.
    nodes = nodes.withColumn("_leaves", F.expr("if(n_children = 0, 1, n_leaves)"))
    nodes = nodes.withColumn("_saved", F.expr("saved_tokens + (n_convs - 1) * bytes"))
    nodes = written(nodes, "path-sums")
    # Each node counts on its first path, of which it is a suffix: sums from the end of each path.
    own = nodes.select("name", "owner", "_leaves", "_saved")
    steps = paths.select("name", "path", "depth").join(own, "name")
    mine = F.col("owner") == F.col("path")
    below = Window.partitionBy("path").orderBy(F.col("depth").desc())
    steps = steps.select(
        "name",
        F.sum(F.when(mine, F.col("_leaves")).otherwise(0)).over(below).alias("n_leaves"),
        F.sum(F.when(mine, F.col("_saved")).otherwise(0)).over(below).alias("saved_tokens"),
    )
    totals = steps.groupBy("name").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.drop("n_leaves", "saved_tokens")
        .join(totals, "name")
        .join(parents, "parent", "left")
        .join(hashes, "name", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))
        .select("name", *_NODE)
    )


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Per node of the trie: see ``_NODE``."""
    rows = written(rebuilt(turns), "conversations")
    rows = rows.repartitionByRange("digests", "conv_id").sortWithinPartitions("digests", "conv_id")
    rows = rows.select("conv_id", "digests", "bytes")
    parts = written(rows.mapInArrow(_part, _ROWS), "trie")
    hashes = written(_end_hashes(parts), "end-hashes")
    merged = written(_merged(parts, hashes), "paths")
    complete = parts.where("part = 0")
    late = complete.where("ends_sha256 IS NULL").drop("ends_sha256").join(hashes, "name")
    complete = complete.where("ends_sha256 IS NOT NULL").unionByName(late)
    # Children that left before their parent was complete: it is on a path, or has left later.
    named = parts.where("part = 0 AND name IS NOT NULL").select("name", "conv_id")
    above = named.union(merged.select("name", "conv_id"))
    above = written(above.selectExpr("name AS parent", "conv_id AS _above"), "parents")
    tops = complete.where("parent IS NOT NULL").drop("parent_conv_id").join(above, "parent")
    return (
        complete.where("parent IS NULL")
        .select(_NODE)
        .union(tops.withColumnRenamed("_above", "parent_conv_id").select(_NODE))
        .union(merged.select(_NODE))
    )


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
