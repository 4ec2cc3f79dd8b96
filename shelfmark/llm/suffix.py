"""Suffix-array dedup by two-stage sorting (operator 7).

A byte goes if a string of ``length`` bytes over it also starts in a document
with a smaller id. Suffixes that share that many bytes are neighbours in a
suffix array, so the array of all text would tell; it is built only for text
that can repeat, and in pieces that meet in one task.

1. Anchors. Each string of ``length`` bytes holds ``length - GRAM + 1`` runs of
   ``GRAM`` bytes; the one with the smallest hash is its anchor (runs that begin
   at a space come first, so that anchors are few). Equal strings have equal
   anchors, so a repeated string has an anchor hash seen in two documents.
   Tasks send sorted, packed hashes with ids to the task of their hash range.
2. Anchors seen in several documents go back to these documents' texts, which
   are cut into pieces: all strings around such anchors. Pieces are grouped by
   the smallest document of their anchors; an anchor of more than ``CROWD``
   documents is a group of its own, so that no one document gathers them all.
   All occurrences of an anchor are in one group.
3. A task sorts the suffixes of its pieces in two stages: those smaller than
   their successor directly, to ``length`` bytes; all others are induced by one
   scan over the buckets of first bytes. Neighbours with a common prefix of
   ``length`` bytes form a class; in it, starts in other than the smallest
   document are repeats. A group that is larger than one load is taken in order
   of ids, and only text that is not a repeat is carried on, so memory follows
   the distinct text of a group.
4. Repeats are merged per document and cut out.

Hash collisions only bring pieces together that do not match. Nothing is
capped, and no text crosses to another document.

Cases: a null text is empty; texts shorter than ``length`` keep all bytes; a
null ``doc_id`` counts as greater than every other id, and null ids as equal;
rows that repeat an id are not compared with each other, and each is treated as
its own text; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import (
    NO_ID,
    beside,
    id_from_key,
    id_key,
    restored,
    sliced,
    table,
    tasks,
    written,
)

LENGTH = 50
GRAM = 20
CROWD = 512  # documents of an anchor above which it is a group of its own
_LOAD = 1_000_000  # bytes of pieces sorted together
_SLICE = 1 << 19  # positions whose anchors are sought together
_HASH_BYTES = 6
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate(
        ([np.uint64(1)], np.full(n - 1, base & (2**64 - 1), dtype=np.uint64))
    ).cumprod(dtype=np.uint64)


def sliding(values: np.ndarray, span: int, pick) -> np.ndarray:
    """``pick`` (min or max) of every ``span`` neighbours."""
    width = 1
    while 2 * width <= span:
        values = pick(values[:-width], values[width:])
        width *= 2
    rest = span - width
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


class _Sieve:
    """Anchors of concatenated texts."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        self.span = length - gram + 1
        size = _SLICE + 4 * length
        self.up = _powers(_BASE, size)
        self.down = _powers(pow(_BASE, -1, 2**64), size)

    def hashes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat, ends = _flat(texts)
        places, hashes = self.anchors(flat, ends)
        return np.searchsorted(ends, places, "right"), hashes

    def anchors(self, flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes; ``ends`` are the ends of the texts in ``flat``."""
        places, hashes = [], []
        n, margin = len(flat), self.span - 1
        for low in range(0, n, _SLICE):
            high = min(n, low + _SLICE)
            first, last = max(0, low - margin), min(n, high + margin + self.gram)
            part = flat[first:last]
            if len(part) < self.length:
                continue
            total = np.concatenate(
                ([np.uint64(0)], np.cumsum(part * self.down[: len(part)], dtype=np.uint64))
            )
            count = len(part) - self.gram + 1
            code = (total[self.gram :] - total[:count]) * self.up[:count]
            code ^= code >> np.uint64(31)
            code *= np.uint64(0xD6E8FEB86659FD93)
            code ^= code >> np.uint64(32)
            # Runs that begin at a blank or line end come first.
            begins = (part[:count] == 32) | (part[:count] == 10)
            order = (code >> np.uint64(1)) | (np.where(begins, 0, 1).astype(np.uint64) << np.uint64(63))
            least = sliding(order, self.span, np.minimum)
            # A string counts only if it lies in one text.
            at = np.arange(first, first + len(least))
            least[ends[np.searchsorted(ends, at, "right")] < at + self.length] = 0
            edge = np.zeros(self.span - 1, dtype=np.uint64)
            most = sliding(np.concatenate((edge, least, edge)), self.span, np.maximum)
            chosen = np.flatnonzero((most[: len(order)] == order) & (order > 0)) + first
            chosen = chosen[(chosen >= low) & (chosen < high)]
            places.append(chosen)
            hashes.append(code[chosen - first] >> np.uint64(64 - 8 * _HASH_BYTES))
        if not places:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        return np.concatenate(places), np.concatenate(hashes)


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))
    return np.frombuffer(b"".join(texts), dtype=np.uint8), ends


def planes(values: np.ndarray, width: int) -> bytes:
    """Numbers byte by byte, the first bytes of all together: high bytes then compress away."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unplanes(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(-1).astype(np.uint64)


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values."""
    return np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))


def send(make, buckets: int):
    """Tasks: (_key, _bytes) to packed anchors by hash range.

    ``make()`` gives an object whose ``hashes(texts)`` are (number of the text, hash) pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = make()
        for batch in sliced(batches, 4096):
            keys = batch.column(0).to_numpy()
            found_h, found_k = [], []
            for low in range(0, len(keys), 1024):
                texts = [t or b"" for t in batch.column(1).slice(low, 1024).to_pylist()]
                number, hashes = sieve.hashes(texts)
                found_h.append(hashes)
                found_k.append(keys[low + number])
            h = np.concatenate([*found_h, np.empty(0, dtype=np.uint64)])
            k = np.concatenate([*found_k, np.empty(0, dtype=np.int64)])
            order = np.lexsort((k, h))
            h, k = h[order], k[order]
            new = np.append(True, (h[1:] != h[:-1]) | (k[1:] != k[:-1]))[: len(h)]
            h, k = h[new], k[new]
            limits = [(i << (8 * _HASH_BYTES)) // buckets for i in range(buckets + 1)]
            cuts = np.searchsorted(h, np.array(limits, dtype=np.uint64))
            rows = [i for i in range(buckets) if cuts[i + 1] > cuts[i]]
            packed = [
                planes(h[cuts[i] : cuts[i + 1]], _HASH_BYTES)
                + planes(k[cuts[i] : cuts[i + 1]].view(np.uint64), 8)
                for i in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()), pa.array(packed, pa.binary())], names=["_range", "_data"]
            )

    return run


def slots_for(parts: int) -> int:
    """The next prime: ids that are multiples of one number still spread."""
    n = max(parts, 2)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def share(slots: int, crowd: int = CROWD, large: int = NO_ID):
    """Tasks: packed anchors of a hash range to packed (key, hash, group) by slots of the key.

    Of anchors seen in two or more documents only. The lowest two bits of a group tell its
    kind: 1 is an anchor of more than ``crowd`` documents, by itself; the anchors of a
    smallest document are two groups, 2 of those in more than ``large`` documents, 0 of others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hs, ks = [], []
        for batch in batches:
            for data in batch.column(1).to_pylist():
                n = len(data) // (_HASH_BYTES + 8)
                hs.append(unplanes(data[: n * _HASH_BYTES], _HASH_BYTES))
                ks.append(unplanes(data[n * _HASH_BYTES :], 8).view(np.int64))
        if not hs:
            return
        h, k = np.concatenate(hs), np.concatenate(ks)
        hs = ks = None
        order = np.lexsort((k, h))
        h, k = h[order], k[order]
        starts = runs(h)
        sizes = np.diff(np.append(starts, len(h)))
        least, most = k[starts], k[starts + sizes - 1]
        group = np.where(
            sizes > crowd, h[starts].view(np.int64) * 4 + 1, least * 4 + 2 * (sizes > large)
        )
        shared = np.repeat(least != most, sizes)
        h, k, group = h[shared], k[shared], np.repeat(group, sizes)[shared]
        slot = k % slots
        order = np.lexsort((k, slot))
        h, k, group, slot = h[order], k[order], group[order], slot[order]
        if not len(slot):
            return
        starts = runs(slot)
        rows = [
            planes(k[a:b].view(np.uint64), 8)
            + planes(h[a:b], _HASH_BYTES)
            + planes(group[a:b].view(np.uint64), 8)
            for a, b in zip(starts, np.append(starts[1:], len(slot)), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot[starts].astype(np.int32)), pa.array(rows, pa.binary())],
            names=["_slot", "_data"],
        )

    return run


class Shared:
    """Shared anchors of a task's documents, from what ``share`` packed."""

    wide = 2 * 8 + _HASH_BYTES

    def __init__(self, packed: list[bytes]):
        sizes = [len(x) // self.wide for x in packed]
        fields = [(0, 8), (8, _HASH_BYTES), (8 + _HASH_BYTES, 8)]
        k, h, group = (
            np.concatenate(
                [unplanes(x[a * n : (a + w) * n], w) for x, n in zip(packed, sizes, strict=True)]
                or [np.empty(0, dtype=np.uint64)]
            )
            for a, w in fields
        )
        k, group = k.view(np.int64), group.view(np.int64)
        order = np.lexsort((h, k))
        self.k, self.h, self.group = k[order], h[order], group[order]

    def of(self, key: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Hashes, sorted, and groups of a document's shared anchors; None if it has none."""
        a, b = np.searchsorted(self.k, key, "left"), np.searchsorted(self.k, key, "right")
        return (self.h[a:b], self.group[a:b]) if a < b else None


def lookup(known: tuple[np.ndarray, np.ndarray], h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of these hashes are shared anchors, and the groups of those."""
    spot = np.minimum(np.searchsorted(known[0], h), len(known[0]) - 1)
    found = known[0][spot] == h
    return found, known[1][spot[found]]


def _cut(length: int, gram: int):
    """Tasks: rows sorted by _kind, shared anchors (0) before texts (1), to pieces.

    Also hands on the whole text of each document that has a piece (with a null group).
    """
    schema = pa.schema(
        [
            ("_group", pa.int64()),
            ("_key", pa.int64()),
            ("_text", pa.int64()),
            ("_start", pa.int64()),
            ("_data", pa.binary()),
        ]
    )
    def pieces(docs: list[tuple[int, int, bytes, tuple]], sieve: _Sieve):
        flat, ends = _flat([d[2] for d in docs])
        places, hashes = sieve.anchors(flat, ends)
        owner = np.searchsorted(ends, places, "right")
        begins = np.append(0, ends)[:-1]
        bounds = np.searchsorted(owner, np.arange(len(docs) + 1))
        rows: list[tuple] = []
        for i, (key, text_hash, text, shared) in enumerate(docs):
            at = places[bounds[i] : bounds[i + 1]] - begins[i]
            known, group = lookup(shared, hashes[bounds[i] : bounds[i + 1]])
            at = at[known]
            if not len(at):
                continue
            rows.append((None, key, text_hash, 0, text))
            low = np.maximum(at - (length - gram), 0)
            high = np.minimum(at + length, len(text))
            order = np.lexsort((low, group))
            low, high, group = low[order], high[order], group[order]
            # Pieces of one group that touch are one.
            new = np.append(True, (group[1:] != group[:-1]) | (low[1:] > high[:-1]))
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(low)) - 1
            for g, a, b in zip(
                group[first].tolist(), low[first].tolist(), high[last].tolist(), strict=True
            ):
                if b - a >= length:
                    rows.append((g, key, text_hash, a, text[a:b]))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = _Sieve(length, gram)
        packed: list[bytes] = []
        shared = None
        docs, size = [], 0
        for batch in sliced(batches):
            for kind, key, text_hash, data in zip(
                *(batch.column(i).to_pylist() for i in range(4)), strict=True
            ):
                if kind == 0:
                    packed.append(data)
                    continue
                if shared is None:
                    shared = Shared(packed)
                    packed = []
                known = shared.of(key)
                if known is None:
                    continue
                docs.append((key, text_hash, data, known))
                size += len(data)
                if size > _LOAD:
                    yield pieces(docs, sieve)
                    docs, size = [], 0
        if docs:
            yield pieces(docs, sieve)

    return run


def suffix_array(text: np.ndarray, length: int) -> np.ndarray:
    """Suffixes in the order of their first ``length`` bytes, by two-stage sorting.

    Equal on ``length`` bytes, suffixes stand next to each other in any order.
    """
    n = len(text)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    # A suffix is smaller than its successor if the next other byte is larger; the end is smallest.
    step = np.diff(text.astype(np.int16), append=-1)
    decided = np.where(step != 0, np.arange(n), n - 1)
    decided = np.minimum.accumulate(decided[::-1])[::-1]
    direct = np.flatnonzero(step[decided] > 0)
    width = -(-length // 8) * 8
    padded = np.concatenate((text, np.zeros(width, dtype=np.uint8)))
    # Stage one: sort the smaller ones directly.
    words = np.ndarray((n + width - 7,), dtype=">u8", buffer=padded, strides=(1,))
    direct = direct[np.argsort(words[direct].astype(np.uint64), kind="stable")]
    lead = words[direct].astype(np.uint64)
    tied = np.zeros(len(direct), dtype=bool)
    same = lead[1:] == lead[:-1]
    tied[1:] |= same
    tied[:-1] |= same
    if tied.any():
        # Those with equal first words are ordered by all of their bytes.
        rows = np.ndarray((n + 1,), dtype=f"S{width}", buffer=padded, strides=(1,))
        which = direct[tied]
        direct[tied] = which[np.argsort(rows[which], kind="stable")]
    # Stage two: induce the rest by one scan over the buckets of first bytes. In a bucket
    # the larger ones come first, in the order of the suffixes behind their first byte.
    cuts = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[n - 1]].append(np.array([n - 1]))
    order = []
    for byte in range(256):
        larger = list(waiting[byte])
        front = np.concatenate(larger) if larger else np.empty(0, dtype=np.int64)
        while len(front):
            front = front[front > 0] - 1
            front = front[text[front] == byte]
            larger.append(front)
        whole = np.concatenate([*larger, direct[cuts[byte] : cuts[byte + 1]]])
        if not len(whole):
            continue
        order.append(whole)
        ahead = whole[whole > 0] - 1
        first = text[ahead]
        ahead, first = ahead[first > byte], first[first > byte]
        by_first = np.argsort(first, kind="stable")
        ahead, first = ahead[by_first], first[by_first]
        starts = runs(first) if len(first) else []
        for part in np.split(ahead, starts[1:]) if len(first) else ():
            waiting[text[part[0]]].append(part)
    return np.concatenate(order)


def common_prefixes(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether neighbours in the suffix array have a common prefix of ``length`` bytes."""
    padded = np.concatenate((text, np.zeros(length + 8, dtype=np.uint8)))
    words = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    left, right = order[:-1], order[1:]
    alike = np.arange(len(left))
    offsets = [*range(0, max(length - 7, 1), 8), max(length - 8, 0)]
    for offset in dict.fromkeys(offsets):
        if length < 8:
            mask = np.uint64((1 << (8 * length)) - 1)
            same = (words[left[alike]] & mask) == (words[right[alike]] & mask)
        else:
            same = words[left[alike] + offset] == words[right[alike] + offset]
        alike = alike[same]
    out = np.zeros(len(left), dtype=bool)
    out[alike] = True
    return out


def repeats(pieces: list[bytes], keys: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start in the joined pieces, is repeat) of every whole string of the pieces."""
    text, ends = _flat(pieces)
    owner = np.repeat(np.arange(len(pieces)), np.diff(ends, prepend=0))
    order = suffix_array(text, length)
    linked = common_prefixes(text, order, length)
    whole = ends[owner] - np.arange(len(text)) >= length
    starts = np.flatnonzero(np.append(True, ~linked))
    key = np.where(whole, keys[owner], NO_ID)[order]
    least = np.repeat(np.minimum.reduceat(key, starts), np.diff(np.append(starts, len(order))))
    repeat = np.zeros(len(text), dtype=bool)
    repeat[order] = key > least
    repeat &= whole
    return whole, repeat


def _find(length: int):
    """Tasks: pieces sorted by (_group, _key) to intervals of repeated bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, int, bytes]] = []  # group, key, text, start (-1: carried), piece
        size, load = 0, _LOAD

        def search(more: bool):
            """Intervals in what is held; what has to be carried on for the last group."""
            keys = np.array([x[1] for x in held], dtype=np.int64)
            whole, repeat = repeats([x[4] for x in held], keys, length)
            ends = np.cumsum([len(x[4]) for x in held])
            begins = ends - np.array([len(x[4]) for x in held])
            at = np.flatnonzero(repeat)
            owner = np.searchsorted(ends, at, "right")
            fresh = np.array([x[3] >= 0 for x in held])[owner] if len(at) else np.empty(0, bool)
            at, owner = at[fresh], owner[fresh]
            new = np.append(True, (owner[1:] != owner[:-1]) | (at[1:] - at[:-1] > length))[: len(at)]
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(at)) - 1 if len(at) else first
            which = owner[first]
            offset = np.array([x[3] for x in held], dtype=np.int64) - begins
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[which]),
                    pa.array(np.array([x[2] for x in held], dtype=np.int64)[which]),
                    pa.array(at[first] + offset[which]),
                    pa.array(at[last] + length + offset[which]),
                ],
                names=["_key", "_text", "_low", "_high"],
            )
            carried = []
            if more:
                group = held[-1][0]
                left = whole & ~repeat
                for i in range(len(held) - 1, -1, -1):
                    if held[i][0] != group:
                        break
                    own = np.flatnonzero(left[begins[i] : ends[i]])
                    if not len(own):
                        continue
                    cuts = np.flatnonzero(np.diff(own) > 1)
                    lows = own[np.append(0, cuts + 1)]
                    highs = own[np.append(cuts, len(own) - 1)] + length
                    for a, b in zip(lows.tolist(), highs.tolist(), strict=True):
                        carried.append((group, held[i][1], held[i][2], -1, held[i][4][a:b]))
            return out, carried

        for batch in sliced(batches):
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if size >= load:
                    out, held = search(row[0] == held[-1][0])
                    yield out
                    size = sum(len(x[4]) for x in held)
                    load = max(_LOAD, 2 * size)
                held.append(row)
                size += len(row[4])
        if held:
            yield search(False)[0]

    return run


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks: rows sorted by (_key, _text, _kind), intervals (0) before texts (1), to results."""
    place, lows, highs = None, [], []
    names = ["_key", "_text", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    kinds += [pa.list_(pa.int64()), pa.binary()]
    for batch in sliced(batches):
        rows = []
        for key, text_hash, kind, low, high, data in zip(
            *(batch.column(i).to_pylist() for i in range(6)), strict=True
        ):
            if (key, text_hash) != place:
                place, lows, highs = (key, text_hash), [], []
            if kind == 0:
                lows.append(low)
                highs.append(high)
            elif lows:
                order = np.argsort(lows, kind="stable")
                a, b = np.array(lows)[order], np.maximum.accumulate(np.array(highs)[order])
                first = np.flatnonzero(np.append(True, a[1:] > b[:-1]))
                a, b = a[first], b[np.append(first[1:], len(b)) - 1]
                kept, at = [], 0
                for x, y in zip(a.tolist(), b.tolist(), strict=True):
                    kept.append(data[at:x])
                    at = y
                left = b"".join([*kept, data[at:]])
                spans = np.stack([a, b], axis=1).reshape(-1).tolist()
                rows.append(
                    (
                        key,
                        text_hash,
                        int((b - a).sum()),
                        len(a),
                        hashlib.sha256(left).hexdigest(),
                        spans,
                        left,
                    )
                )
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def cut_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per text that loses bytes, by (_key, _text): n_removed, n_spans, kept_sha256,
    spans (start and end of each, flat) and kept (the remaining bytes)."""
    spark = docs.sparkSession
    parts = tasks(spark)
    texts = docs.select(id_key().alias("_key"), F.col("text").cast("string").alias("_string"))
    texts = texts.where(F.octet_length("_string") >= length).select(
        "_key",
        F.xxhash64("_string").alias("_text"),
        F.col("_string").cast("binary").alias("_data"),
    )
    anchors = texts.select("_key", "_data").mapInArrow(
        send(lambda: _Sieve(length, gram), parts), "_range int, _data binary"
    )
    slots = slots_for(parts)
    shared = anchors.repartition(parts, "_range").mapInArrow(
        share(slots), "_slot int, _data binary"
    )
    both = shared.selectExpr("_slot", "0 AS _kind", "0L AS _key", "0L AS _text", "_data").union(
        texts.selectExpr(
            f"cast(pmod(_key, {slots}) AS int) AS _slot", "1 AS _kind", "_key", "_text", "_data"
        )
    )
    both = both.repartition(slots, "_slot").sortWithinPartitions("_kind").drop("_slot")
    cut = written(
        both.mapInArrow(
            _cut(length, gram), "_group long, _key long, _text long, _start long, _data binary"
        ),
        "pieces",
    )
    pieces = cut.where("_group IS NOT NULL").repartition(parts, "_group")
    pieces = pieces.sortWithinPartitions("_group", "_key", "_start")
    spans = pieces.mapInArrow(_find(length), "_key long, _text long, _low long, _high long")
    spans = spans.selectExpr("_key", "_text", "0 AS _kind", "_low", "_high", "binary('') AS _data")
    whole = cut.where("_group IS NULL").selectExpr(
        "_key", "_text", "1 AS _kind", "0L AS _low", "0L AS _high", "_data"
    )
    rows = spans.union(whole).repartition(parts, "_key", "_text")
    rows = rows.sortWithinPartitions("_key", "_text", "_kind")
    return rows.mapInArrow(
        _apply,
        "_key long, _text long, n_removed long, n_spans long, kept_sha256 string,"
        " spans array<long>, kept binary",
    )


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Rows of ``docs`` with the repeats cut from ``text``, and ``n_chars`` to match.

    Bytes of a character that is cut in part go too.
    """
    # Written, so that what was shuffled for it goes before the texts are joined.
    lost = written(cut_repeats(docs, length, gram).drop("spans"), "kept")
    lost = lost.dropDuplicates(["_key", "_text"]).select(
        "_key", "_text", F.expr("try_validate_utf8(cast(kept AS string))").alias("_valid"), "kept"
    )
    string = F.col("text").cast("string")
    keyed = beside(docs, _key=id_key(), _text=F.xxhash64(string), _whole=string)
    rows = keyed.join(lost, ["_key", "_text"], "left")
    cut = F.expr("coalesce(_valid, replace(make_valid_utf8(cast(kept AS string)), '\ufffd', ''))")
    untouched = F.col("kept").isNull()
    rows = rows.withColumn("_left", F.when(untouched, F.col("_whole")).otherwise(cut))
    changed = {"text": F.col("_left")}
    if "n_chars" in docs.columns:
        own = F.col(f"_{docs.columns.index('n_chars')}_")
        changed["n_chars"] = F.when(untouched, own).otherwise(F.length("_left"))
    return restored(rows, docs, **changed)


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lost = cut_repeats(docs).drop("spans", "kept").dropDuplicates(["_key", "_text"])
    lost = lost.withColumnRenamed("kept_sha256", "_sha")
    rows = docs.selectExpr(
        "cast(text AS string) AS _string", "doc_id"
    ).select(
        id_key().alias("_key"),
        F.xxhash64("_string").alias("_text"),
        F.expr("cast(coalesce(octet_length(_string), 0) AS long)").alias("n_bytes"),
        F.expr("sha2(coalesce(_string, ''), 256)").alias("_whole"),
    )
    return rows.join(lost, ["_key", "_text"], "left").select(
        id_from_key("_key").alias("doc_id"),
        "n_bytes",
        F.expr("coalesce(n_removed, 0L)").alias("n_removed"),
        F.expr("coalesce(n_spans, 0L)").alias("n_spans"),
        F.coalesce("_sha", "_whole").alias("kept_sha256"),
    )
