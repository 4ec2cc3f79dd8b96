"""Vector bin packing by the dot-product heuristic (operator 13).

A sequence has three limits at once: tokens, segments and loss-bearing tokens.
Each example is a demand on all three. A task keeps a pool of examples and fills
one sequence at a time: of all examples that still fit, it places the one whose
demand has the largest dot product with the room that is left, both in shares
of the limits. So an example that needs much of what is plentiful comes first,
and one that needs little of what is scarce fills the rest.

Examples (``pack_examples``) stay whole. Documents (``pack_documents``) may be
cut: what of a document fills sequences by itself goes there at once, its rest
joins the pool, and when nothing in the pool fits any more the head of the
best one is cut off to fill the sequence to the token. A sequence that cannot
be filled (no segment left, or the last of a task) is cut into sequences of a
power of two tokens, which need no padding.

Every task packs the rows of its own partition, with a pool of bounded size:
there is no shuffle, no row meets another partition, and a hot source or a very
long document is no more than its tokens. A task that is run again reads the
same rows in the same order and gives the same sequences.

Tokens are those of the tokenizers library: pre-tokens are cut by a pattern
equal to the vocabulary's for Latin text (any other text is encoded whole by the
library), and each distinct one is encoded once by its byte pairs, with the
tiktoken library where the file's merges are the ranks it needs; the answers
are kept for the task up to ``KEPT`` pieces, a cache only.

Cases: a null or empty text has the end id alone; a text is whole, however
long; repeated rows are packed once each; a null ``doc_id`` stays null; an empty
table gives no row; other columns are not read. An example over a limit by itself
has a sequence of its own, with ``fits`` false; null demands count as zero.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.bpe import _STAND_INS as STAND_INS
from shelfmark.llm.common import sliced, table

VOCABULARY = "byte_bpe_50k.json"
END = 0
KEPT = 500_000  # pieces remembered by a task
POOL = 2048  # examples a task chooses from
_LONG = 1000  # characters of a piece that only the vocabulary's own library encodes


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""

    tokens: int = 1024
    segments: int = 64
    loss: int = 1024


#: The vocabulary's split of a text, for the characters of ``_OTHER``'s complement.
_L = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_N = "0-9²³¹¼½¾"
_S = "\t-\r \x85\xa0"
_LATIN = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)
#: Beyond U+024F only punctuation and currency signs are sure to be neither letter,
#: number nor white space.
_OTHER = re.compile("[^\x00-ɏ‐-‧‰-⁞₠-₿]")


class Pieces(dict):
    """Ids of pre-tokens; one not seen before is encoded when it is asked for."""

    def __init__(self, whole, model: dict):
        super().__init__()
        self.whole, self.ranked = whole, self._ranked(model)

    @staticmethod
    def _ranked(model: dict):
        """The same byte pairs for tiktoken; none where an id is not the rank of its merge."""
        vocabulary = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [vocabulary[a + b] for a, b in merges]
        if made != list(range(len(STAND_INS), len(vocabulary))):
            return None
        import tiktoken

        byte = {chr(code): b for b, code in STAND_INS.items()}
        ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items()}
        # A piece is never split again.
        return tiktoken.Encoding(
            "pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}
        )

    def encoded(self, text: str) -> bytes:
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= KEPT:
            self.clear()
        if self.ranked is None or len(piece) > _LONG:
            found = self.encoded(piece)
        else:
            ids = self.ranked.encode_ordinary(piece)
            found = struct.pack(f"<{len(ids)}I", *ids)
        self[piece] = found
        return found


class Ids:
    """Token ids of texts, as little-endian unsigned 32-bit numbers."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(text)
        whole.no_truncation()
        whole.no_padding()
        special = {t.content: i for i, t in whole.get_added_tokens_decoder().items()}
        self.special = {t: np.uint32(i).tobytes() for t, i in special.items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self.known = Pieces(whole, json.loads(text)["model"])

    def part(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        if _OTHER.search(text):
            return self.known.encoded(text)
        return b"".join(map(self.known.__getitem__, _LATIN.findall(text)))

    def of(self, text: str) -> bytes:
        if "<|" not in text:
            return self.part(text)
        return b"".join(self.special.get(p) or self.part(p) for p in self.at_special.split(text))


_IDS: dict[int, Ids] = {}


def ids_of(text: str) -> Ids:
    """The encoder of a vocabulary's text; one for each Python worker."""
    key = hash(text)
    if key not in _IDS:
        _IDS.clear()
        _IDS[key] = Ids(text)
    return _IDS[key]


class Pool:
    """Examples to choose from, and the choice."""

    def __init__(self, limits: Limits):
        self.top = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.float64)
        self.demand = np.zeros((3, 2 * POOL))  # shares of the limits, one example in a column
        self.tokens = np.zeros(2 * POOL, dtype=np.int64)
        self.loss = np.zeros(2 * POOL, dtype=np.int64)
        self.held: list = []

    def __len__(self) -> int:
        return len(self.held)

    def add(self, tokens: int, loss: int, what) -> None:
        n = len(self.held)
        if n == self.demand.shape[1]:
            self.demand = np.concatenate((self.demand, np.zeros_like(self.demand)), axis=1)
            self.tokens = np.concatenate((self.tokens, np.zeros_like(self.tokens)))
            self.loss = np.concatenate((self.loss, np.zeros_like(self.loss)))
        self.demand[:, n] = (tokens, 1, loss) / self.top
        self.tokens[n], self.loss[n] = tokens, loss
        self.held.append(what)

    def take(self, at: int) -> tuple[int, int, object]:
        """Remove one example; the last one moves to its place."""
        found = int(self.tokens[at]), int(self.loss[at]), self.held[at]
        last = len(self.held) - 1
        self.demand[:, at] = self.demand[:, last]
        self.tokens[at], self.loss[at] = self.tokens[last], self.loss[last]
        self.held[at] = self.held[last]
        self.held.pop()
        return found

    def best(self, room: tuple[int, int, int], whole: bool = True) -> int:
        """Place of the example with the largest dot product, -1 if none fits ``whole``."""
        n = len(self.held)
        if not n or not room[1]:
            return -1
        score = (np.array(room) / self.top) @ self.demand[:, :n]
        if whole:
            fits = (self.tokens[:n] <= room[0]) & (self.loss[:n] <= room[2])
            score = np.where(fits, score, -1.0)
        at = int(score.argmax())
        return at if score[at] >= 0 else -1

    def fill(self, limits: Limits) -> tuple[list, tuple[int, int, int]]:
        """Whole examples for one sequence, and the room that is left."""
        room = (limits.tokens, limits.segments, limits.loss)
        placed = []
        while (at := self.best(room)) >= 0:
            tokens, loss, what = self.take(at)
            placed.append((tokens, loss, what))
            room = (room[0] - tokens, room[1] - 1, room[2] - loss)
        return placed, room


def _powers(total: int) -> list[int]:
    """Powers of two that add up to ``total``, the largest first."""
    return [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]


# A piece of a document: (number of the document, start, length).


def _cut_to(pieces: list[tuple], sizes: list[int]) -> Iterator[list[tuple]]:
    """The pieces in a row, dealt to sequences of the given sizes."""
    at, done = 0, 0
    for size in sizes:
        part = []
        while size:
            doc, start, length = pieces[at]
            take = min(size, length - done)
            part.append((doc, start + done, take))
            size -= take
            done += take
            if done == length:
                at, done = at + 1, 0
        yield part


class Documents:
    """Packs documents that come one after another; a piece of n tokens bears n - 1 of loss,
    as the first token of a segment is not predicted."""

    def __init__(self, limits: Limits):
        self.limits, self.pool = limits, Pool(limits)
        # A piece that fills a sequence alone must keep the limit of loss, too.
        self.alone = min(limits.tokens, limits.loss + 1)

    def add(self, doc, length: int) -> Iterator[list[tuple]]:
        """Sequences that are full now."""
        rest = length % self.alone
        for start in range(0, length - rest, self.alone):
            yield from self._closed([(doc, start, self.alone)])
        if rest:
            self.pool.add(rest, rest - 1, (doc, length - rest))
        while len(self.pool) >= 2 * POOL:
            yield from self._next()

    def end(self) -> Iterator[list[tuple]]:
        while len(self.pool):
            yield from self._next()

    def _next(self) -> Iterator[list[tuple]]:
        placed, room = self.pool.fill(self.limits)
        pieces = [(doc, start, tokens) for tokens, _, (doc, start) in placed]
        head = min(room[0], room[2] + 1)
        # What is left now is longer than the room: cut its head off.
        if head > 0 and room[1] and (at := self.pool.best(room, whole=False)) >= 0:
            tokens, _, (doc, start) = self.pool.take(at)
            pieces.append((doc, start, head))
            self.pool.add(tokens - head, tokens - head - 1, (doc, start + head))
        yield from self._closed(pieces)

    def _closed(self, pieces: list[tuple]) -> Iterator[list[tuple]]:
        total = sum(length for _, _, length in pieces)
        if total == self.limits.tokens:
            yield pieces
        else:
            yield from _cut_to(pieces, _powers(total))


def _base() -> int:
    """Sequences of a partition are numbered from here."""
    context = TaskContext.get()
    return (context.partitionId() if context else 0) << 40


def pack_documents(
    docs: DataFrame, limits: Limits = Limits(), path: str | None = None, ids: bool = False
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with ``ids``
    its ids as well.

    ``path`` names a vocabulary file; its text goes to the tasks by broadcast, a
    fixed size. Sequences are of ``limits.tokens`` or a power of two tokens.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    end = np.uint32(END).tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ids_of(shared.value)
        packer, sequence = Documents(limits), _base()
        rows: list[tuple] = []
        # Documents with a piece in the pool: id, tokens, ids from its rest on, place of the rest.
        # A piece leaves the pool from its head, so what is kept of a document ends with its end.
        kept: dict[int, list] = {}

        def note(pieces: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for number, start, length in pieces:
                doc_id, tokens, buffer, origin = kept[number]
                part = buffer[4 * (start - origin) : 4 * (start - origin + length)]
                row = (doc_id, start, length, zlib.crc32(part), tokens, sequence, offset)
                rows.append((*row, np.frombuffer(part, dtype="<u4")) if ids else row)
                offset += length
                if start + length == tokens:
                    del kept[number]
            sequence += 1

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * (len(names) + ids)
            arrays = [pa.array(c, pa.int64()) for c in columns[: len(names)]]
            if ids:
                arrays.append(pa.array(columns[-1], pa.list_(pa.int32())))
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names + ["ids"] * ids)

        number = 0
        for batch in sliced(batches, 512):
            doc_ids = batch.column(0).to_pylist()
            for doc_id, text in zip(doc_ids, batch.column(1).to_pylist(), strict=True):
                buffer = encoder.of(text or "") + end
                tokens = len(buffer) // 4
                kept[number] = [doc_id, tokens, buffer, 0]
                for pieces in packer.add(number, tokens):
                    note(pieces)
                if number in kept:
                    # Only the rest waits in the pool.
                    origin = tokens - tokens % packer.alone
                    kept[number][2:] = [buffer[4 * origin :], origin]
                number += 1
            if rows:
                yield flushed()
        for pieces in packer.end():
            note(pieces)
        yield flushed()
        # The worker may go on to tasks that need the memory for something else.
        encoder.known.clear()

    schema = ", ".join(f"{n} long" for n in names) + ", ids array<int>" * ids
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """Per sequence of ``pack_documents(..., ids=True)``: ids, and the offset of each segment.

    A sequence is bounded by its limits, however many there are.
    """
    rows = pieces.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_parts")
    )
    return rows.select(
        "sequence_id",
        F.flatten(F.col("_parts.ids")).alias("ids"),
        F.col("_parts.offset").alias("offsets"),
    )


def pack_examples(examples: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Whole examples (example_id, tokens, loss) to sequences.

    Per example: example_id, tokens, loss, sequence_id, segment (its place
    there), offset, fits.
    """
    names = ["example_id", "tokens", "loss", "sequence_id", "segment", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, sequence = Pool(limits), _base()

        def drawn(least: int) -> pa.RecordBatch:
            nonlocal sequence
            rows = []
            while len(pool) > least:
                placed, _ = pool.fill(limits)
                offset = 0
                for segment, (tokens, loss, example) in enumerate(placed):
                    rows.append((example, tokens, loss, sequence, segment, offset, True))
                    offset += tokens
                sequence += 1
            return record(rows)

        def record(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            arrays = [pa.array(c, pa.int64()) for c in columns[:6]]
            arrays.append(pa.array(columns[6], pa.bool_()))
            return pa.RecordBatch.from_arrays(arrays, names=[*names, "fits"])

        for batch in sliced(batches, POOL):
            over = []
            for example, tokens, loss in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens, loss = tokens or 0, loss or 0
                if tokens > limits.tokens or loss > limits.loss or limits.segments < 1:
                    over.append((example, tokens, loss, sequence, 0, 0, False))
                    sequence += 1
                else:
                    pool.add(tokens, loss, example)
            if over:
                yield record(over)
            if len(pool) > 2 * POOL:
                yield drawn(POOL)
        yield drawn(0)

    rows = examples.select(*[F.col(c).cast("long") for c in ("example_id", "tokens", "loss")])
    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names) + ", fits boolean")


def instruction_examples(turns: DataFrame, path: str | None = None) -> DataFrame:
    """Examples of ``conversations``: a conversation's tokens, and those of the assistant as loss.

    Each turn ends with the end id. Counting is a sum with partial aggregation,
    so a long conversation is no group in one task.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as file:
        shared = turns.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ids_of(shared.value)
        for batch in sliced(batches):
            sizes = [len(encoder.of(t or "")) // 4 + 1 for t in batch.column(2).to_pylist()]
            loss = [
                n if role == "assistant" else 0
                for n, role in zip(sizes, batch.column(1).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(loss, pa.int64())],
                names=["example_id", "tokens", "loss"],
            )

    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    ).mapInArrow(run, "example_id long, tokens long, loss long")
    return rows.groupBy("example_id").agg(
        F.sum("tokens").alias("tokens"), F.sum("loss").alias("loss")
    )


def op13_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
