"""Language ID: averaged hashed subword embeddings and a linear softmax (operator 10).

Subwords are runs of 3 and 4 UTF-8 bytes of the lower-cased text inside one
word and its borders; ASCII characters that are no letters are borders. Each
run is hashed to a row of an embedding table, a text is the mean of its rows,
and a linear layer gives the odds. Table and layer are learned by stochastic
gradient descent in numpy on the driver, from at most ``TRAIN_DOCS`` labelled
documents (a bounded sample, chosen by a hash of the id). A text is scored as a
whole in tasks that hold the product of table and layer: a fixed size, whatever
the input.

The odds are made into a score by a temperature fitted on a part of the sample
that was not trained on; a text is rejected below the score that
``REJECT_SHARE`` of those texts stay under, at most ``REJECT_MOST``.

Cases: a null text, or one without a letter, is ``und`` with score 0 and
rejected; a null ``doc_id`` is never learned from and not held out; a null
``lang`` is never learned from; without any label nothing can be predicted, so
every text is ``und`` with score 0, and only those without a letter are
rejected. Repeated rows get equal answers, an empty table none. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.llm.common import sliced, table

TRAIN_DOCS = 1500
BUCKETS = 1 << 16
DIM = 16
EPOCHS = 5
BATCH = 64
RATE = 0.5
#: Pieces of these many bytes are learned besides each whole text, so that short texts count.
PIECES = (12, 40, 120)
REJECT_SHARE = 0.001
REJECT_MOST = 0.3
UNKNOWN = "und"

_NOT_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())
_BORDERS = bytes.maketrans(_NOT_LETTERS, b" " * len(_NOT_LETTERS))
_SLICE = 1 << 19


def plain(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace").translate(_BORDERS)


def subwords(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 3- and 4-byte runs that start at each byte but the last three.

    A run across a border inside it goes to the bucket ``BUCKETS``, which counts nothing.
    """
    wide = flat.astype(np.uint32)
    a, b, c, d = wide[:-3], wide[1:-2], wide[2:-1], wide[3:]
    three = a | (b << np.uint32(8)) | (c << np.uint32(16))
    four = three | (d << np.uint32(24))
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    three = (three * np.uint32(2654435761)) >> shift
    four = ((four ^ (four >> np.uint32(15))) * np.uint32(2246822519)) >> shift
    inside = b != 32
    three[~inside] = BUCKETS
    four[~(inside & (c != 32))] = BUCKETS
    return three, four


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts between borders in one array, and where each starts."""
    flat = np.frombuffer(b" " + b" ".join(texts) + b"    ", dtype=np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    return flat, np.concatenate(([0], np.cumsum(lengths)))


def sums(texts: list[bytes], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sum of its subwords' rows, and their number. Slices bound the memory."""
    flat, starts = joined(texts)
    total = np.zeros((len(texts), rows.shape[1]))
    count = np.zeros(len(texts))
    end = int(starts[-1])
    for low in range(0, end, _SLICE):
        high = min(end, low + _SLICE)
        first = int(np.searchsorted(starts, low, "right")) - 1
        last = int(np.searchsorted(starts, high, "left"))
        at = np.maximum(starts[first:last] - low, 0)
        for buckets in subwords(flat[low : high + 3]):
            total[first:last] += np.add.reduceat(rows[buckets], at, axis=0)
            count[first:last] += np.add.reduceat((buckets != BUCKETS).astype(np.int32), at)
    return total, count


@dataclass
class Model:
    langs: list[str]
    rows: np.ndarray  # of each bucket, its part in the odds; a last row of zeros
    bias: np.ndarray
    temperature: float
    reject_below: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        total, count = sums(texts, self.rows)
        odds = (total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature
        odds = np.exp(odds - odds.max(axis=1, keepdims=True))
        return odds / odds.sum(axis=1, keepdims=True)


def _bags(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets of each text and their shares."""
    bags = []
    for text in texts:
        flat, _ = joined([text])
        both = np.concatenate(subwords(flat))
        buckets, counts = np.unique(both[both != BUCKETS], return_counts=True)
        bags.append((buckets.astype(np.int64), counts / max(1, counts.sum())))
    return bags


def _descend(bags, labels: np.ndarray, langs: int, rng) -> tuple[np.ndarray, ...]:
    table_ = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    layer, bias = np.zeros((DIM, langs)), np.zeros(langs)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(bags))
        for low in range(0, len(order), BATCH):
            chosen = order[low : low + BATCH]
            sizes = np.array([len(bags[i][0]) for i in chosen])
            buckets = np.concatenate([bags[i][0] for i in chosen])
            shares = np.concatenate([bags[i][1] for i in chosen])
            owner = np.repeat(np.arange(len(chosen)), sizes)
            mean = np.zeros((len(chosen), DIM))
            parts = table_[buckets] * shares[:, None]
            full = sizes > 0
            begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            if len(buckets):
                mean[full] = np.add.reduceat(parts, begin[full], axis=0)
            odds = mean @ layer + bias
            odds = np.exp(odds - odds.max(axis=1, keepdims=True))
            wrong = odds / odds.sum(axis=1, keepdims=True)
            wrong[np.arange(len(chosen)), labels[chosen]] -= 1
            back = wrong @ layer.T
            layer -= rate / len(chosen) * mean.T @ wrong * DIM
            bias -= rate / len(chosen) * wrong.sum(axis=0) * 0.1
            # Each text steps on its own for the table, as its subwords are its own.
            order_ = np.argsort(buckets, kind="stable")
            step = (back[owner] * (shares * rate * DIM)[:, None])[order_]
            distinct, at = np.unique(buckets[order_], return_index=True)
            if len(distinct):
                table_[distinct] -= np.add.reduceat(step, at, axis=0)
    return table_, layer, bias


def fit(texts: list[str], langs_of: list[str], seed: int = 10) -> Model | None:
    """Learn from labelled texts; a fifth of them fits temperature and rejection."""
    langs = sorted(set(langs_of))
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    held, bags, labels, held_texts, held_labels = len(texts) >= 10, [], [], [], []
    for i, (text, lang) in enumerate(zip(texts, langs_of, strict=True)):
        whole = plain(text)
        parts = [whole]
        for size in PIECES:
            if len(whole) > size:
                at = int(rng.integers(0, len(whole) - size))
                parts.append(whole[at : at + size])
        if held and i % 5 == 4:
            held_texts += parts
            held_labels += [langs.index(lang)] * len(parts)
        else:
            bags += _bags(parts)
            labels += [langs.index(lang)] * len(parts)
    table_, layer, bias = _descend(bags, np.array(labels), len(langs), rng)
    rows = np.vstack([table_ @ layer, np.zeros(len(langs))]).astype(np.float32)
    model = Model(langs, rows, bias, 1.0, 0.0)
    if held_texts:
        truth, best = np.array(held_labels), np.inf
        total, count = sums(held_texts, rows)
        odds = total / np.maximum(count, 1)[:, None] + bias
        for temperature in np.geomspace(0.25, 8, 41):
            scaled = odds / temperature
            scaled = scaled - scaled.max(axis=1, keepdims=True)
            loss = np.mean(
                np.log(np.exp(scaled).sum(axis=1)) - scaled[np.arange(len(truth)), truth]
            )
            if loss < best:
                best, model.temperature = loss, float(temperature)
        top = model.scores(held_texts).max(axis=1)
        model.reject_below = min(REJECT_MOST, float(np.quantile(top, REJECT_SHARE)))
    return model


def held_out(doc_id: str = "doc_id"):
    return F.expr(f"coalesce(crc32(cast(cast({doc_id} AS string) AS binary)) % 5 = 0, false)")


def learn(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model | None:
    """Fit on the labelled rows with the smallest id hashes, ``train_docs`` at most.

    Only ids are ranked; texts are read for the chosen rows alone.
    """
    rows = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL").where(~held_out())
    rows = rows.withColumn("_hash", F.xxhash64(F.col("doc_id").cast("long"), F.lit(10)))
    cut = rows.select("_hash").orderBy("_hash").limit(train_docs).agg(F.max("_hash")).first()[0]
    if cut is None:
        return None
    rows = rows.where(F.col("_hash") <= cut).where("text IS NOT NULL")
    rows = rows.select("_hash", "text", F.col("lang").cast("string").alias("lang"))
    got = rows.orderBy("_hash", "lang", "text").limit(train_docs).collect()
    return fit([r.text for r in got], [r.lang for r in got])


def predict(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """For every row columns ``keep`` as _0, _1, ..., lang_pred, score and accepted."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in sliced(batches):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            lettered = [
                i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))
            ]
            langs, scores, accepted = (
                [UNKNOWN] * len(texts),
                [0.0] * len(texts),
                [False] * len(texts),
            )
            if lettered and known is not None:
                odds = known.scores([plain(texts[i]) for i in lettered])
                for i, row in zip(lettered, odds, strict=True):
                    k = int(row.argmax())
                    langs[i], scores[i] = known.langs[k], round(float(row[k]), 6)
                    accepted[i] = bool(row[k] >= known.reject_below)
            elif known is None:
                for i in lettered:
                    accepted[i] = True
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            answers = [
                pa.array(langs, pa.string()),
                pa.array(scores, pa.float64()),
                pa.array(accepted, pa.bool_()),
            ]
            names = batch.schema.names[:-1] + ["lang_pred", "score", "accepted"]
            yield pa.RecordBatch.from_arrays([*kept, *answers], names=names)

    # Numbered on the way, so that no column of the table can clash with the answers.
    kept = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, F.col("text").cast("string").alias("_text"))
    schema = StructType(rows.schema.fields[:-1])
    schema = schema.add("lang_pred", "string").add("score", "double").add("accepted", "boolean")
    return rows.mapInArrow(answer, schema)


def identify(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, accepted."""
    rows = predict(docs, learn(docs, train_docs), ["doc_id"])
    return rows.select(
        F.col("_0").alias("doc_id"), held_out("_0").alias("held_out"), "lang_pred", "score", "accepted"
    )


def accepted_rows(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Rows of ``docs`` that are not rejected."""
    rows = predict(docs, learn(docs, train_docs), docs.columns).where("accepted")
    return rows.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)))


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
