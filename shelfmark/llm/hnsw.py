"""Embedding near-dedup with navigable small-world graphs per shard (operator 4).

Vectors of one label and length are dealt to shards of about ``SHARD``. Every
vector is looked up in every shard of its label (each pair of shards once), in
tasks that hold one shard's graph and up to ``TOGETHER`` shards of queries.

A graph has layers: each holds a share of the layer below, and links every node
to near ones in different directions. A search walks from the top layer down
and, on the lowest, keeps a beam of the nearest nodes seen. The beam of a query
is doubled while all of it is within the threshold, so groups larger than the
beam are found whole. Each task audits itself: some of its queries are compared
with all of the shard, and the beam is doubled for all queries until the audit
finds every link; a beam as wide as the shard is a scan of it. Found pairs are
verified by cosine in double precision. Tasks hand on, for each vector, how
many it links to, and one link to the first of its component, so a group of
near copies costs its size, not its square.

Equal vectors of a label are one class, searched once and counted by number.

Cases: vectors that are null, zero, or hold null or non-finite components, and
those with a null label, link with nothing and are their own component; vectors
of different lengths never link; repeated rows are vectors of their own; a null
``vec_id`` counts as greater than all others; an empty table gives no row;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import (
    components,
    id_from_key,
    id_key,
    merge_labels,
    table,
    tasks,
    written,
)

MIN_COSINE = 0.93
SHARD = 2048  # vectors of a graph
TOGETHER = 8  # shards of queries that meet a shard in one task
LINKS = 16  # of a node in the upper layers; twice as many in the lowest
SHRINK = 16  # nodes of a layer for one in the layer above
BEAM = 48
ENTRIES = 16  # places at which a search enters the next layer
AUDIT = 128  # queries of a task that are compared with all of the shard
_QUERIES = 256
_STEP = 4  # nodes of a beam expanded at once
_SLACK = 1e-5  # of single precision in the walk


class Layer:
    """A graph over some rows of ``vectors``; nodes are numbered within the layer."""

    def __init__(self, vectors: np.ndarray, links: int):
        self.vectors = vectors
        self.links = links
        # The last column chains each node behind its nearest earlier one, so that nodes
        # all of whose other links were given up for nearer ones are still reached.
        self.near = np.full((len(vectors), links + 1), -1, dtype=np.int32)
        self.size = 0

    def search(
        self, queries: np.ndarray, beam: int, entry: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and cosines of each query's beam, nearest first; -1 where the beam is not full."""
        many, n = len(queries), self.size
        beam = min(beam, n)
        rows = np.arange(many)[:, None]
        seen = np.zeros((many, n + 1), dtype=bool)
        seen[:, n] = True
        entry = np.where(entry < 0, n, entry)
        seen[rows, entry] = True
        node = np.full((many, beam), n, dtype=np.int32)
        near = np.full((many, beam), -2.0, dtype=np.float32)
        done = np.ones((many, beam), dtype=bool)
        width = min(entry.shape[1], beam)
        close = np.einsum("qed,qd->qe", self.vectors[np.minimum(entry, n - 1)], queries)
        close[entry == n] = -2
        order = np.argsort(-close, axis=1, kind="stable")[:, :width]
        node[:, :width] = np.take_along_axis(entry, order, 1)
        near[:, :width] = np.take_along_axis(close, order, 1)
        done[:, :width] = near[:, :width] == -2
        active = np.arange(many)
        while len(active):
            waiting = ~done[active]
            has = waiting.any(axis=1)
            active, waiting = active[has], waiting[has]
            if not len(active):
                break
            # The first few of each beam that were not expanded yet.
            rank = np.cumsum(waiting, axis=1)
            chosen = waiting & (rank <= _STEP)
            done[active] |= chosen
            q, at = np.nonzero(chosen)
            place = rank[q, at] - 1
            found = np.full((len(active), _STEP, self.links + 1), n, dtype=np.int32)
            linked = self.near[node[active[q], at]]
            found[q, place] = np.where(linked >= 0, linked, n)
            found = np.sort(found.reshape(len(active), -1), axis=1)
            fresh = ~seen[active[:, None], found]
            fresh[:, 1:] &= found[:, 1:] != found[:, :-1]
            seen[active[:, None], found] = True
            wide = int(fresh.sum(axis=1).max(initial=0))
            if not wide:
                continue
            front = np.argsort(~fresh, axis=1, kind="stable")[:, :wide]
            found = np.where(np.take_along_axis(fresh, front, 1), np.take_along_axis(found, front, 1), n)
            close = np.full(found.shape, -2.0, dtype=np.float32)
            q, at = np.nonzero(found < n)
            close[q, at] = np.einsum(
                "nd,nd->n", self.vectors[found[q, at]], queries[active[q]], optimize=False
            )
            all_near = np.concatenate((near[active], close), axis=1)
            all_node = np.concatenate((node[active], found), axis=1)
            all_done = np.concatenate((done[active], found == n), axis=1)
            order = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
            near[active] = np.take_along_axis(all_near, order, 1)
            node[active] = np.take_along_axis(all_node, order, 1)
            done[active] = np.take_along_axis(all_done, order, 1)
        return np.where(near > -2, node, -1), near

    def add(self, count: int, beam: int, entry) -> None:
        """Link the next ``count`` rows to the graph and to each other."""
        first, last = self.size, self.size + count
        new = self.vectors[first:last]
        # Rows that come together see each other directly.
        close = new @ new.T
        np.fill_diagonal(close, -2)
        width = min(self.links, count)
        own = np.argsort(-close, axis=1, kind="stable")[:, :width]
        node, near = own + first, np.take_along_axis(close, own, 1)
        if first:
            old, old_near = self.search(new, beam, entry(new))
            node, near = np.concatenate((old, node), axis=1), np.concatenate((old_near, near), axis=1)
        node = np.where(near > -2, node, -1)
        order = np.argsort(-near, axis=1, kind="stable")
        node, near = np.take_along_axis(node, order, 1), np.take_along_axis(near, order, 1)
        self.size = last
        kept = self._spread(node, near)
        self.near[first:last, :-1] = kept
        earlier = (node >= 0) & (node < np.arange(first, last)[:, None])
        nearest = np.take_along_axis(node, earlier.argmax(axis=1)[:, None], 1)[:, 0]
        for i, before in enumerate(nearest.tolist(), first):
            if earlier[i - first].any():
                self.near[i, -1], self.near[before, -1] = self.near[before, -1], i
        source = np.repeat(np.arange(first, last), (kept >= 0).sum(axis=1))
        self._link_back(kept[kept >= 0], source)

    def _spread(self, node: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Of candidates in order, those nearer to the row than to any chosen before; then the rest."""
        rows, width = node.shape
        vectors = self.vectors[np.maximum(node, 0)]
        between = np.matmul(vectors, vectors.transpose(0, 2, 1))
        chosen = np.zeros((rows, width), dtype=bool)
        for c in range(width):
            hidden = ((between[:, c, :] > near[:, c : c + 1]) & chosen).any(axis=1)
            chosen[:, c] = ~hidden & (node[:, c] >= 0)
        # Half of the links spread, the others go to the nearest.
        spread = chosen & (np.cumsum(chosen, axis=1) <= self.links // 2)
        order = np.argsort(np.where(spread, 0, np.where(node >= 0, 1, 2)), axis=1, kind="stable")
        out = np.take_along_axis(node, order[:, : self.links], 1)
        if out.shape[1] < self.links:
            pad = np.full((rows, self.links - out.shape[1]), -1, dtype=out.dtype)
            out = np.concatenate((out, pad), axis=1)
        return out

    def _link_back(self, target: np.ndarray, source: np.ndarray) -> None:
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        nodes, starts = np.unique(target, return_index=True)
        ends = np.append(starts[1:], len(target))
        for v, a, b in zip(nodes.tolist(), starts.tolist(), ends.tolist(), strict=True):
            have = self.near[v, :-1]
            have = have[have >= 0]
            both = np.unique(np.concatenate((have, source[a:b])))
            if len(both) > self.links:
                close = self.vectors[both] @ self.vectors[v]
                order = np.argsort(-close, kind="stable")
                both, close = both[order], close[order]
                both = self._spread(both[None, :], close[None, :])[0]
                both = both[both >= 0]
            self.near[v, : len(both)] = both
            self.near[v, len(both) : -1] = -1


class Graph:
    """Layers over unit vectors; rows are given in random order."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        single = vectors.astype(np.float32)
        self.layers: list[Layer] = []
        size = len(vectors)
        sizes = [size]
        while sizes[-1] > 4 * SHRINK:
            sizes.append(sizes[-1] // SHRINK)
        for i, size in enumerate(reversed(sizes)):
            lowest = i == len(sizes) - 1
            # The first rows are the upper layers: rows are in random order.
            layer = Layer(single[:size], 2 * LINKS if lowest else LINKS)
            self.layers.append(layer)
            above = self.layers[:-1]
            while layer.size < size:
                count = min(size - layer.size, max(32, min(_QUERIES, layer.size)))
                layer.add(count, BEAM, lambda q, a=above, n=layer: self._enter(q, a, n.size))

    @staticmethod
    def _enter(queries: np.ndarray, above: list[Layer], most: int) -> np.ndarray:
        entry = np.zeros((len(queries), 1), dtype=np.int32)
        for layer in above:
            node, _ = layer.search(queries, ENTRIES, entry)
            entry = np.where(node < 0, node[:, :1], node)
        entry = np.where(entry < most, entry, 0)
        # Each place once: a beam must not hold a node twice.
        entry = np.sort(entry, axis=1)
        entry[:, 1:][entry[:, 1:] == entry[:, :-1]] = -1
        return entry

    def within(self, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs of cosine ``least`` or more that beams find, verified."""
        lowest, n = self.layers[-1], len(self.vectors)
        found_q, found_n = [], []
        todo = [(np.arange(low, min(len(queries), low + _QUERIES)), beam) for low in range(0, len(queries), _QUERIES)]
        while todo:
            rows, wide = todo.pop()
            if wide * len(rows) > _QUERIES * 4096 and len(rows) > 1:
                half = len(rows) // 2
                todo += [(rows[:half], wide), (rows[half:], wide)]
                continue
            own = queries[rows]
            if wide >= n:
                # The whole shard: a beam this wide leaves nothing out.
                q, node = np.nonzero(own @ self.vectors.T >= least - _SLACK)
            else:
                single = own.astype(np.float32)
                node, near = lowest.search(single, wide, self._enter(single, self.layers[:-1], n))
                close = near >= least - _SLACK
                full = close.all(axis=1)
                if full.any():
                    todo.append((rows[full], 4 * wide))
                q, at = np.nonzero(close & ~full[:, None])
                node = node[q, at]
            exact = np.einsum("nd,nd->n", own[q], self.vectors[node]) >= least
            found_q.append(rows[q[exact]])
            found_n.append(node[exact])
        return (
            np.concatenate([*found_q, np.empty(0, dtype=np.int64)]),
            np.concatenate([*found_n, np.empty(0, dtype=np.int64)]),
        )

    def audited(self, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, int]:
        """``within``, with the beam widened until an audit of some queries finds every link."""
        n = len(self.vectors)
        step = max(1, len(queries) // AUDIT)
        probe = queries[::step][:AUDIT]
        truth = int((probe @ self.vectors.T >= least).sum())
        beam = BEAM
        while beam < n and len(self.within(probe, least, beam)[0]) < truth:
            beam *= 2
        return (*self.within(queries, least, beam), beam)


def _link(least: float):
    """Tasks: rows (_label.., _i, _j, _query, _class, _copies, _unit) by group to counts and links."""

    def links(rows: dict[str, np.ndarray], units: np.ndarray) -> pa.RecordBatch:
        member = rows["query"] == 0
        cls, copies = rows["class"], rows["copies"]
        graph = Graph(units[member])
        asked = np.flatnonzero(~member)
        q, node, _ = graph.audited(units[asked], least)
        a, b = asked[q], np.flatnonzero(member)[node]
        # In its own shard a pair is met from both sides: count it once.
        once = (rows["shard"][a] != rows["shard"][b]) | (cls[a] < cls[b])
        a, b = a[once], b[once]
        count = np.zeros(len(cls), dtype=np.int64)
        np.add.at(count, a, copies[b])
        np.add.at(count, b, copies[a])
        # A class may stand here as member and as query: join both rows.
        _, first, same = np.unique(cls, return_index=True, return_inverse=True)
        total = np.zeros(len(first), dtype=np.int64)
        np.add.at(total, same, count)
        labels = merge_labels(np.arange(len(first)), same[a], same[b])
        linked = total > 0
        own = cls[first]
        return pa.RecordBatch.from_arrays(
            [pa.array(own[linked]), pa.array(own[labels][linked]), pa.array(total[linked])],
            names=["a", "b", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        group = None

        def close() -> Iterator[pa.RecordBatch]:
            if held:
                whole = pa.Table.from_batches(held)
                names = ("query", "class", "copies", "shard")
                rows = {n: whole.column(f"_{n}").to_numpy() for n in names}
                flat = pa.concat_arrays([c.flatten() for c in whole.column("_unit").chunks])
                units = flat.to_numpy().reshape(whole.num_rows, -1)
                if (rows["query"] == 0).any():
                    yield links(rows, units)

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if high == low:
                    continue
                if ids[low] != group:
                    yield from close()
                    held, group = [], ids[low]
                held.append(batch.slice(low, high - low))
        yield from close()

    return run


def classes_of(vectors: DataFrame) -> DataFrame:
    """Distinct vectors that can link: _label, _embedding, _lowest, _copies, _class, _unit."""
    wide = "transform(_embedding, x -> cast(x AS double))"
    bad = f"exists({wide}, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))"
    rows = vectors.where(f"_label IS NOT NULL AND size(_embedding) > 0 AND NOT {bad}")
    rows = rows.groupBy("_label", "_embedding").agg(
        F.min("_key").alias("_lowest"), F.count("*").alias("_copies")
    )
    rows = rows.withColumn("_top", F.expr(f"array_max(transform({wide}, x -> abs(x)))"))
    rows = rows.where("_top > 0").withColumn("_scaled", F.expr(f"transform({wide}, x -> x / _top)"))
    length = "sqrt(aggregate(_scaled, 0D, (s, x) -> s + x * x))"
    rows = rows.withColumn("_length", F.expr(length))
    rows = rows.withColumn("_unit", F.expr("transform(_scaled, x -> x / _length)"))
    rows = rows.withColumn("_class", F.monotonically_increasing_id())
    kept = ["_label", "_embedding", "_lowest", "_copies", "_class", "_unit"]
    return written(rows.select(*kept), "classes")


def near_links(classes: DataFrame, least: float = MIN_COSINE, shard: int = SHARD) -> DataFrame:
    """(a, b, n): from every class that links, a link to its component's first, and copies linked."""
    kinds = ["_label", "_length"]
    rows = classes.withColumn("_length", F.size("_unit"))
    counts = rows.groupBy(*kinds).agg(F.ceil(F.count("*") / shard).cast("int").alias("_shards"))
    rows = rows.join(counts, kinds).withColumn("_shard", F.expr("cast(pmod(xxhash64(_class, 4), _shards) AS int)"))
    # A shard's vectors are members for every bundle of later shards, and queries to every earlier shard.
    groups = f"""concat(
        transform(sequence(_shard div {TOGETHER}, (_shards - 1) div {TOGETHER}),
                  j -> struct(_shard AS i, cast(j AS int) AS j, 0 AS query)),
        transform(sequence(0, _shard),
                  i -> struct(i AS i, cast(_shard div {TOGETHER} AS int) AS j, 1 AS query)))"""
    rows = rows.selectExpr(
        *kinds, f"explode({groups}) AS _g", "_class", "_copies", "_shard", "_unit"
    ).selectExpr(
        "xxhash64(_label, _length, _g.i, _g.j) AS _group",
        "_g.query AS _query",
        "_class",
        "_copies",
        "_shard",
        "_unit",
    )
    rows = rows.repartition(tasks(classes.sparkSession), "_group")
    # In random order, so that the first rows can be the upper layers.
    rows = rows.withColumn("_order", F.expr("xxhash64(_class, 5)"))
    rows = rows.sortWithinPartitions("_group", "_query", "_order", "_class").drop("_order")
    return rows.mapInArrow(_link(least), "a long, b long, n long")


def near_vectors(vectors: DataFrame, least: float = MIN_COSINE, shard: int = SHARD) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    rows = vectors.select(
        id_key("vec_id").alias("_key"),
        F.col("label").alias("_label"),
        F.col("embedding").alias("_embedding"),
    )
    classes = classes_of(rows)
    found = written(near_links(classes, least, shard), "near")
    reached = components(found.select("a", "b"))
    counts = found.groupBy(F.col("a").alias("_class")).agg(F.sum("n").alias("_n"))
    of_class = classes.drop("_unit").join(counts, "_class", "left").join(
        reached.withColumnRenamed("node", "_class"), "_class", "left"
    )
    of_class = of_class.withColumn("_component", F.coalesce("component", "_class"))
    lowest = of_class.groupBy("_component").agg(F.min("_lowest").alias("_first"))
    of_class = written(
        of_class.join(lowest, "_component").select(
            "_label",
            "_embedding",
            "_first",
            (F.coalesce("_n", F.lit(0)) + F.col("_copies") - 1).alias("_links"),
        ),
        "classes",
    )
    joined = rows.join(of_class, ["_label", "_embedding"], "left")
    joined = joined.withColumn("_component", F.coalesce("_first", "_key"))
    return joined.select(
        id_from_key("_key").alias("vec_id"),
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        id_from_key("_component").alias("component_id"),
        (F.col("_key") == F.col("_component")).alias("kept"),
    )


def op4_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
