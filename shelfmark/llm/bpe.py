"""BPE encoding and decoding by a pair occurrence index (operator 9).

The distinct pieces between white space of a batch of documents are cut into
pre-tokens by the vocabulary's own normalizer and pre-tokenizer. All distinct
pre-tokens lie in one array of symbols. An index maps each mergeable pair to
all its positions in that array; ranks that have positions are applied in
ascending order, each to all its positions at once, and the pairs that a merge
makes left and right of it are entered at their new positions. Pre-tokens never
touch, so this gives each the merges it would get alone: always its lowest rank
first, and from the left among equal pairs. What a piece encodes and decodes to
is kept for the task, up to ``KEPT`` pieces, then forgotten: a cache only.

Decoding joins the vocabulary's tokens as the file's decoder says: it has none,
so by one space.

Cases: null and empty texts have no token and decode to an empty text; texts
are whole, however long; special tokens that stand in a text become their ids.
Repeated rows get equal answers; an empty table gives no row; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import sliced, table

VOCABULARY = "word_bpe_49k.json"
KEPT = 500_000  # pieces remembered by a task
#: Characters of text whose pieces are encoded together.
TOGETHER = 4_000_000

#: White space of the vocabulary's patterns.
_SPACE = "\t\n\v\f\r \x85\xa0  -     　"
_PIECES = re.compile(f"[^{_SPACE}]+")
#: The vocabulary's split of a piece, for characters below U+0250.
_LETTERS = "a-zªµºß-öø-ÿ\u0100-\u024f"
_NUMBERS = "0-9²³¹¼½¾"
_LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}]+")
#: Stand-ins of bytes in byte-level vocabularies: printable ones for themselves, others from U+0100.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_STAND_INS = {b: b for b in _PRINTABLE} | {
    b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)
}
#: These end a piece for ``str.split`` but not for the patterns.
_ODD = re.compile("[\x1c-\x1f]")


class Encoder:
    """Encoder and decoder of one vocabulary file in the format of the tokenizers library."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(text)
        self.normalizer, self.splitter = whole.normalizer, whole.pre_tokenizer
        parts = json.loads(text)
        model = parts["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or parts["decoder"]:
            raise ValueError("expects a BPE vocabulary without prefix and decoder")
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in self.ids.items()}
        special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.tokens |= {i: t for t, i in special.items()}
        self.special = special
        self.at_special = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self.size = max(self.tokens) + 1
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = np.array([self.ids[a] for a, _ in merges], dtype=np.int64)
        self.right = np.array([self.ids[b] for _, b in merges], dtype=np.int64)
        self.made = np.array([self.ids[a + b] for a, b in merges], dtype=np.int64)
        keys = self.left * self.size + self.right
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_key]
        # Symbols of characters inside a pre-token and at its end.
        top = max(_STAND_INS.values()) + 1
        self.inner, self.last = np.full(top, -1), np.full(top, -1)
        for code in _STAND_INS.values():
            self.inner[code] = self.ids[chr(code)]
            self.last[code] = self.ids[chr(code) + self.suffix]
        self.id_text = {i: str(i) for i in self.tokens}
        self.forget()

    def forget(self) -> None:
        """Empty the cache, but for special tokens."""
        self.pieces = {}
        self.words = {t: (1, str(i).encode(), t.encode()) for t, i in self.special.items()}


    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it does not merge."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.by_key[at], -1)

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens in a row, and the number of each, by the pair occurrence index."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes)
        symbol = self.inner[codes]
        symbol[ends - 1] = self.last[codes[ends - 1]]
        n = len(symbol)
        # One place beyond the end stands for "no neighbour".
        symbol = np.append(symbol, -1)
        after = np.append(np.arange(1, n + 1), n)
        before = np.arange(-1, n)
        after[ends - 1] = n
        before[np.concatenate(([0], ends[:-1]))] = n
        before[n] = n
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Enter the pairs that begin at these positions."""
            at = at[after[at] != n]
            rank = self.ranks(symbol[at], symbol[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, part in zip(
                rank[np.concatenate(([0], cuts))].tolist() if len(rank) else (),
                np.split(at, cuts),
                strict=True if len(rank) else False,
            ):
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(part)

        enter(np.arange(n))
        while active:
            rank = heapq.heappop(active)
            at = np.unique(np.concatenate(index.pop(rank)))
            a, b, made = self.left[rank], self.right[rank], self.made[rank]
            at = at[(symbol[at] == a) & (after[at] != n)]
            at = at[symbol[after[at]] == b]
            if a == b and len(at) > 1:
                # In a run of equal symbols every second pair is taken, from the left.
                starts = np.append(True, after[at[:-1]] != at[1:])
                run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            symbol[at] = made
            symbol[gone] = -1
            after[at] = after[gone]
            before[after[at]] = at
            before[n] = n
            left = before[at]
            enter(np.unique(np.concatenate((at, left[left != n]))))
        alive = symbol[:n] >= 0
        owner = np.repeat(np.arange(len(words)), sizes)[alive]
        return symbol[:n][alive], np.bincount(owner, minlength=len(words))

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a piece without special tokens, in stand-in characters."""
        if text.isascii() and text.isprintable():
            plain = text.lower()
            return [plain] if plain.isalpha() else _LATIN.findall(plain)
        if max(text) < "\u0250":
            # Composed already; ByteLevel works on the bytes of each part.
            found = _LATIN.findall(text.lower())
            return [w.encode().decode("latin-1").translate(_STAND_INS) for w in found]
        return [
            w for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        ]

    def learn(self, pieces: set[str]) -> None:
        """Encode and decode pieces not seen before, and remember them."""
        known, special = self.words, self.special
        parts: dict[str, list[str]] = {}
        new: set[str] = set()
        for piece in pieces:
            if "<|" in piece:
                found: list[str] = []
                for text in self.at_special.split(piece):
                    found += (text,) if text in special else self.split(text) if text else ()
            else:
                found = self.split(piece)
            parts[piece] = found
            new.update(found)
        words = [w for w in new if w not in known]
        if words:
            ids, counts = self.merged(words)
            ends = np.cumsum(counts).tolist()
            as_text = [self.id_text[i] for i in ids.tolist()]
            as_token = [self.tokens[i] for i in ids.tolist()]
            low = 0
            for word, high in zip(words, ends, strict=True):
                known[word] = (
                    high - low,
                    " ".join(as_text[low:high]).encode(),
                    " ".join(as_token[low:high]).encode(),
                )
                low = high
        for piece, found in parts.items():
            if len(found) == 1:
                self.pieces[piece] = known[found[0]]
            else:
                got = [known[w] for w in found]
                self.pieces[piece] = (
                    sum([x[0] for x in got]),
                    b" ".join([x[1] for x in got]),
                    b" ".join([x[2] for x in got]),
                )

    def cut(self, text: str) -> list[str]:
        return _PIECES.findall(text) if _ODD.search(text) else text.split()

    def documents(self, texts: list[str]) -> list[tuple[int, bytes, bytes]]:
        """Number of ids, ids joined by a space, decoded text: for each text."""
        cut = [self.cut(t) for t in texts]
        new = set()
        for pieces in cut:
            new.update(pieces)
        new.difference_update(self.pieces)
        if len(self.pieces) + len(new) > KEPT:
            self.forget()
            new = set().union(*cut)
        if new:
            self.learn(new)
        known = self.pieces
        out = []
        for pieces in cut:
            found = [x for p in pieces if (x := known[p])[0]]
            out.append(
                (
                    sum([x[0] for x in found]),
                    b" ".join([x[1] for x in found]),
                    b" ".join([x[2] for x in found]),
                )
            )
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(text: str) -> Encoder:
    """The encoder of a vocabulary's text; one for each Python worker."""
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(text)
    return _ENCODERS[key]


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts of about ``TOGETHER`` characters."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(docs: DataFrame, path: str | None = None, ids: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256; with ``ids`` also ids and decoded.

    ``path`` names a vocabulary file; its text goes to the tasks by broadcast,
    a fixed size.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(shared.value)
        for batch in sliced(batches, 2048):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows: list[tuple] = []
            for group in _groups(texts):
                for n, id_text, decoded in known.documents(group):
                    row = (
                        n,
                        hashlib.sha256(id_text).hexdigest(),
                        hashlib.sha256(decoded).hexdigest(),
                    )
                    if ids:
                        row += ([int(x) for x in id_text.split()], decoded.decode())
                    rows.append(row)
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *names])
        # The worker may go on to tasks that need the memory for something else.
        known.forget()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, schema + ", ids array<int>, decoded string" * ids)


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
