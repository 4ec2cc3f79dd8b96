"""Spelling variants by permuterm rotations (operator 12).

A word ends with a terminator, and its rotations are all ways to turn it round.
Two words that differ in one code point agree in the whole rotation that starts
behind that place, but for its last character, the edited one. So each word is
entered under every rotation without its last character (edited there: ``skip``)
and under every whole rotation (``full``): words that meet under one prefix in
``skip`` entries differ by a replacement, a ``skip`` and a ``full`` entry by an
inserted character. Sorted by prefix, each group is a prefix range of the sorted
rotations. It is scanned once, and hands on for each member how many others it
is near to and the largest of them: no pair is written.

A group is bounded by the alphabet: a prefix says all of a word but one
character, so a group has one word per character and one without it. No word,
however frequent, makes it larger, and every pair of near words meets in exactly
one counted group: where equal letters stand side by side, only the first is
counted as the inserted one.

Rotations longer than ``LONG`` characters are not written out: four sums modulo a
prime stand for one, taken from running sums over the word, so a word costs its
length and not its square, and a number in the order of these words stands for
the word.

Counting adds up in the tasks before anything is shuffled. Roots are found by
pointer jumping: a form has at least twice the word's count, so chains are short
and have no circle; each round is written.

Cases: null and empty texts and texts without such a run have no word; a null
``doc_id`` is written as an empty text in the hash; repeated rows count as often
as they stand there; ties of forms go to the word smallest in code-point order;
texts are whole; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import sliced, table, tasks, written

LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2  # a form has at least this many times the word's count
#: Every run for which this divides the hash loses a code point.
DIVISOR = 97
#: Not a letter, so no run holds it.
END = "$"
#: Characters of a rotation that is written out.
LONG = 64
_KEPT = 200_000  # distinct words counted by a task before they are handed on


def _runs(least: int) -> re.Pattern:
    return re.compile(f"[a-zÀ-ÿ]{{{least},}}")


def count_words(
    total: Counter, doc_id: int | None, text: bytes, pattern: re.Pattern, least: int, divisor: int
) -> None:
    """Add the words of one document. A run is maximal; shorter ones give no word."""
    runs = pattern.findall(text.lower().decode())
    total.update(runs)
    seed = crc32(b"%d:" % doc_id if doc_id is not None else b":")
    for run in set(runs):
        h = crc32(run.encode(), seed)
        if h % divisor == 0:
            times = runs.count(run)
            total[run] -= times
            at = h % len(run)
            changed = run[:at] + run[at + 1 :]
            if len(changed) >= least:
                total[changed] += times


def word_counts(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    divisor: int = DIVISOR,
) -> DataFrame:
    """(word, n): words of ``least_length`` code points or more that occur ``least_count`` times."""
    pattern = _runs(least_length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def counted() -> pa.RecordBatch:
            found = {w: n for w, n in total.items() if n}
            total.clear()
            arrays = [pa.array(list(found), pa.string()), pa.array(found.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["word", "n"])

        for batch in sliced(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for low in range(0, len(ids), 64):
                part = texts.slice(low, 64).to_pylist()
                for doc_id, text in zip(ids[low : low + 64], part, strict=True):
                    if text:
                        count_words(total, doc_id, text, pattern, least_length, divisor)
                if len(total) > _KEPT:
                    yield counted()
        yield counted()

    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text")
    )
    rows = rows.mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


#: Entries of one word. ``key`` is a rotation without the character it skips; ``kind`` is 2 for a
#: whole rotation, 1 for a skipped character, 0 for one that equals the character before it.
_ENTRIES = f"""
    flatten(transform(sequence(0, length(word)), i -> filter(array(
        struct(concat(substr(word, i + 1), '{END}', substr(word, 1, i)) AS key, 2 AS kind),
        struct(
            concat(substr(word, i + 2), '{END}', substr(word, 1, i)) AS key,
            if(i > 0 AND substr(word, i, 1) = substr(word, i + 1, 1), 0, 1) AS kind
        )), (x, which) -> if(which = 0, length(word) < {{0}}, i < length(word)))))
"""


def rotations(words: DataFrame, long: int = LONG) -> DataFrame:
    """(key, kind, word, n) for keys of up to ``long`` characters, sorted by key, largest n first."""
    rows = words.where(F.length("word") <= long)
    rows = rows.select("word", "n", F.explode(F.expr(_ENTRIES.format(long))).alias("_entry"))
    return _by_key(rows.select("_entry.key", "_entry.kind", "word", "n"))


def _by_key(rows: DataFrame) -> DataFrame:
    rows = rows.repartition(tasks(rows.sparkSession), "key")
    return rows.sortWithinPartitions("key", F.col("n").desc(), "word")


#: Primes below 2 to the power 31, and a base for each.
_PRIMES = ((2147483647, 48271), (2147483629, 69621), (2147483587, 39373), (2147483579, 16807))


def _powers(base: int, prime: int, size: int) -> np.ndarray:
    found = np.ones(1, dtype=np.uint64)
    while len(found) < size:
        step = np.uint64(pow(base, len(found), prime))
        found = np.concatenate((found, found * step % np.uint64(prime)))
    return found[:size]


def hashed_rotations(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Four sums for every rotation without the character it starts with, and for every whole one.

    A string s has the sum of s[j] * base ** j. A rotation is the end of the
    word, moved to the front, the terminator, and the start of the word, moved
    behind it.
    """
    codes = np.frombuffer(word.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    size = len(codes)
    skip, full = [], []
    for prime, base in _PRIMES:
        p, end = np.uint64(prime), np.uint64(ord(END))
        up = _powers(base, prime, size + 2)
        down = _powers(pow(base, -1, prime), prime, size + 2)
        # Sums of the first i characters; each term is below 2 to the power 31.
        sums = np.concatenate(([np.uint64(0)], np.cumsum(codes * up[:size] % p))) % p
        i = np.arange(size + 1)

        def turned(start, i=i, sums=sums, up=up, down=down, p=p, end=end):
            """Rotations whose first part starts at ``start`` and whose last part ends before i."""
            head = (sums[size] + p - sums[start]) % p * down[start] % p
            return (head + end * up[size - start] + sums[i[: len(start)]] * up[size - start + 1]) % p

        skip.append(turned(i[1:]))
        full.append(turned(i))
    return tuple(np.stack(x, axis=1).astype("<u4") for x in (skip, full))


def long_rotations(words: DataFrame, long: int = LONG) -> DataFrame:
    """As ``rotations`` for longer keys, hashed; ``words`` has numbers that keep their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                skip, full = hashed_rotations(word)
                codes = np.frombuffer(word.encode("utf-32-le"), dtype="<u4")
                kind = np.ones(len(codes), dtype=np.int32)
                kind[1:] = codes[1:] != codes[:-1]
                if len(codes) <= long:
                    skip, kind = skip[:0], kind[:0]
                key = np.concatenate((skip, full))
                kind = np.concatenate((kind, np.full(len(full), 2, dtype=np.int32)))
                for low in range(0, len(key), 1 << 16):
                    part = key[low : low + (1 << 16)]
                    size = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.FixedSizeBinaryArray.from_buffers(
                                pa.binary(16), size, [None, pa.py_buffer(part.tobytes())]
                            ).cast(pa.binary()),
                            pa.array(kind[low : low + size]),
                            pa.array(np.full(size, number)),
                            pa.array(np.full(size, n)),
                        ],
                        names=["key", "kind", "word", "n"],
                    )

    rows = words.where(F.length("word") >= long).select("number", "word", "n")
    return _by_key(rows.mapInArrow(run, "key binary, kind int, word long, n long"))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per member of a group of several: word, how many it is near to here, the largest of them."""

    def members(rows: pa.Table) -> pa.RecordBatch:
        key = rows.column(0).combine_chunks()
        size = len(key)
        same = np.zeros(size, dtype=bool)
        same[1:] = pc.equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
        number = np.cumsum(~same) - 1
        first = np.flatnonzero(~same)
        kind = rows.column(1).to_numpy()
        skip = np.bincount(number, kind < 2, len(first)).astype(np.int64)
        counted = np.bincount(number, kind == 1, len(first)).astype(np.int64)
        full = np.bincount(number, kind == 2, len(first)).astype(np.int64)
        # A skip entry is near to the other skip entries, and to the full one if it counts there.
        near = np.where(
            kind == 2, counted[number], skip[number] - 1 + np.where(kind == 1, full[number], 0)
        )
        several = (skip + full)[number] > 1
        # Rows come largest first: the best other one is the first, or for the first the second.
        best = first[number]
        best = np.where(best == np.arange(size), np.minimum(best + 1, size - 1), best)
        at, best = np.flatnonzero(several), best[several]
        word, n = rows.column(2).combine_chunks(), rows.column(3).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [word.take(at), pa.array(near[several], pa.int64()), n.take(best), word.take(best)],
            names=["word", "near", "best_n", "best"],
        )

    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        key = rows.column(0).combine_chunks()
        # The last group may go on in the next batch; it is no larger than the alphabet.
        last = pc.index(pc.equal(key, key[-1]), True).as_py() if len(key) else 0
        if last:
            yield members(rows.slice(0, last))
        held = rows.slice(last)
    if held is not None and held.num_rows:
        yield members(held)


def near_words(words: DataFrame, long: int = LONG) -> DataFrame:
    """Per word with a near one: word, n_near, best (the near word of largest n), best_n."""
    schema = "word {0}, near long, best_n long, best {0}"
    found = rotations(words, long).mapInArrow(_scan, schema.format("string"))
    longer = words.where(F.length("word") >= long)
    if longer.limit(1).count():
        # Sorted and written: the numbers keep the order of the words and do not change.
        number = F.monotonically_increasing_id()
        longer = written(longer.orderBy("word").withColumn("number", number), "longer")
        rows = long_rotations(longer, long).mapInArrow(_scan, schema.format("long"))
        name = longer.selectExpr("number AS word", "word AS _word")
        best = longer.selectExpr("number AS best", "word AS _best")
        rows = rows.join(name, "word").join(best, "best")
        found = found.union(rows.select("_word", "near", "best_n", "_best"))
    order = F.min(F.struct((-F.col("best_n")).alias("_n"), F.col("best"))).alias("_best")
    return (
        found.groupBy("word")
        .agg(F.sum("near").alias("n_near"), order)
        .select("word", "n_near", "_best.best", (-F.col("_best._n")).alias("best_n"))
    )


def rooted(links: DataFrame) -> DataFrame:
    """(word, root) for links (word, form) without a circle: forms followed to the last.

    Each round a word takes the root of its root, so n rounds follow chains of
    2 to the power n links.
    """
    roots = written(links.selectExpr("word", "form AS root"), "roots")
    while True:
        after = roots.selectExpr("word AS root", "root AS _next")
        moved = roots.join(after, "root", "left")
        moved = moved.selectExpr("word", "coalesce(_next, root) AS root", "_next IS NOT NULL AS _on")
        roots = written(moved, "roots")
        if not roots.where("_on").limit(1).count():
            return roots.select("word", "root")
        roots = roots.select("word", "root")


def grouped(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    divisor: int = DIVISOR,
    ratio: int = RATIO,
) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    words = written(word_counts(docs, least_length, least_count, divisor), "words")
    near = words.join(near_words(words), "word", "left")
    large = F.col("best_n") >= ratio * F.col("n")
    near = near.select(
        "word",
        F.when(large, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(large, F.col("best_n")).alias("form_n"),
    )
    near = written(near, "near")
    roots = rooted(near.where("form IS NOT NULL").select("word", "form"))
    return near.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return grouped(table(spark, sf_dir, "documents"))
