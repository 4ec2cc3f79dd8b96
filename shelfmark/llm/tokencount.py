"""Token counts by a separator scan over flat token files (operator 1).

A flat token file is a row of fixed-width token ids, documents one after
another, each closed by an end-of-document id, without any index of where they
begin. It is read as blocks of a fixed number of tokens: (file, block, data).
Each block is searched alone, as one vector, for the separator. A prefix scan
then stitches blocks: it adds up tokens and separators of the blocks before,
and keeps the last separator's place, which is where an open document began.
The scan is associative, so it runs in two levels, over blocks in groups of
``GROUP`` and over groups: no task holds a whole file.

Cases: an empty document has 0 tokens; texts are whole, however long a run of
blanks or letters in them; tokens behind the last separator are a
document that was not closed; a null text is an empty document; repeated rows
are documents of their own; a null ``doc_id`` is kept; empty tables give no
row; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import table, written

RANKS = "byte_bpe_50k.tiktoken"
END = 50256  # of a document; free in the vocabulary
BLOCK = 1 << 16  # tokens
GROUP = 1024  # blocks
WIDTH = "<u2"
#: Documents whose ids go into one row of the list that keeps their order.
_LISTED = 10_000

_ENCODING: dict[bytes, object] = {}


def _encoding(data: bytes):
    import base64

    import public_tokenizers
    import tiktoken

    if data not in _ENCODING:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        _ENCODING.clear()
        _ENCODING[data] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _ENCODING[data]


#: What the library's pattern takes for white space.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Longer runs of white space exhaust the stack of the library's pattern.
_LONG_RUN = re.compile(f"[{_SPACE}]{{10000,}}")


def ids_of(encoding, text: str) -> list[int]:
    """The library's ids, also of texts with very long runs of white space.

    Such a run is one piece of the pattern, but for its last character, which
    goes with what follows.
    """
    ids, at = [], 0
    for run in _LONG_RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoding.encode_ordinary(text[at : run.start()])
        ids += encoding._encode_single_piece(text[run.start() : end].encode())
        at = end
    return ids + encoding.encode_ordinary(text[at:])


def flat_files(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode documents into flat token files, one per task, as a written table.

    Rows: (file, block, data) are the blocks of a file; (file, first, ids) name
    the documents in the order in which they were written, with no place.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(RANKS)
    with open(path, "rb") as ranks:
        shared = docs.sparkSession.sparkContext.broadcast(ranks.read())
    schema = pa.schema(
        [
            ("file", pa.int32()),
            ("block", pa.int64()),
            ("data", pa.binary()),
            ("first", pa.int64()),
            ("ids", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, file = _encoding(shared.value), TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        size = block = first = 0

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) if found else [[]] * 5
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            found, ids = [], batch.column(0).to_pylist()
            for low in range(0, len(ids), _LISTED):
                found.append((file, None, None, first + low, ids[low : low + _LISTED]))
            first += len(ids)
            for text in batch.column(1):
                tokens = ids_of(encoding, text.as_py() or "")
                tokens.append(END)
                held.append(np.array(tokens, dtype=WIDTH))
                size += len(tokens)
                if size >= 8 * BLOCK:
                    flat = np.concatenate(held)
                    whole = len(flat) // BLOCK * BLOCK
                    for at in range(0, whole, BLOCK):
                        found.append((file, block, flat[at : at + BLOCK].tobytes(), None, None))
                        block += 1
                    held, size = [flat[whole:]], len(flat) - whole
            yield rows(found)
        flat = np.concatenate([*held, np.empty(0, dtype=WIDTH)])
        found = []
        for at in range(0, len(flat), BLOCK):
            found.append((file, block, flat[at : at + BLOCK].tobytes(), None, None))
            block += 1
        yield rows(found)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return written(
        rows.mapInArrow(run, "file int, block long, data binary, first long, ids array<long>"),
        "flat-tokens",
    )


def blocks_of(spark: SparkSession, path: str, width: int = 2, block: int = BLOCK) -> DataFrame:
    """Blocks of the flat token files under a path: (file, block, data).

    A shard of a token store is a few hundred MB; Spark reads at most 2 GB of one.
    """
    size = width * block
    files = spark.read.format("binaryFile").load(path)
    at = f"sequence(0L, greatest(length - 1, 0L) div {size})"
    return files.selectExpr("path AS file", "content", f"explode({at}) AS block").selectExpr(
        "file", "block", f"substring(content, cast(block * {size} + 1 AS int), {size}) AS data"
    )


def separators(blocks: DataFrame, end: int = END, width: str = WIDTH) -> DataFrame:
    """Per block: file, block, size (tokens) and ends (places of separators in the block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends = [], []
            for data in batch.column(2):
                tokens = np.frombuffer(data.as_buffer(), dtype=width)
                sizes.append(len(tokens))
                ends.append(np.flatnonzero(tokens == end))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(ends, pa.list_(pa.int64())),
                ],
                names=["file", "block", "size", "ends"],
            )

    kind = blocks.schema["file"].dataType.simpleString()
    return blocks.select("file", "block", "data").mapInArrow(
        run, f"file {kind}, block long, size long, ends array<long>"
    )


def documents(found: DataFrame) -> DataFrame:
    """Prefix scan: per document file, number (from 0), start and n_tokens.

    ``found`` comes from ``separators``; it is read twice, so have it written.
    """
    spark = found.sparkSession
    found.createOrReplaceTempView("_scan_blocks")
    return spark.sql(f"""
        WITH inner_scan AS (
            SELECT *, block div {GROUP} AS g,
                   coalesce(sum(size) OVER before, 0L) AS tokens,
                   coalesce(sum(cast(size(ends) AS long)) OVER before, 0L) AS closed
            FROM _scan_blocks
            WINDOW before AS (PARTITION BY file, block div {GROUP} ORDER BY block
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        placed AS (
            SELECT *, max(tokens + try_element_at(ends, -1)) OVER (
                          PARTITION BY file, g ORDER BY block
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_end
            FROM inner_scan),
        sums AS (
            SELECT file, g, max(tokens + size) AS all_tokens,
                   sum(cast(size(ends) AS long)) AS all_closed,
                   max(tokens + try_element_at(ends, -1)) AS all_last, max(block) AS top
            FROM inner_scan GROUP BY file, g),
        outer_tokens AS (
            SELECT *, coalesce(sum(all_tokens) OVER before, 0L) AS tokens_before,
                   coalesce(sum(all_closed) OVER before, 0L) AS closed_before,
                   max(top) OVER (PARTITION BY file) AS file_top
            FROM sums
            WINDOW before AS (PARTITION BY file ORDER BY g
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        outer_scan AS (
            SELECT file, g, tokens_before, closed_before, file_top,
                   max(tokens_before + all_last) OVER (
                       PARTITION BY file ORDER BY g
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_before
            FROM outer_tokens),
        stitched AS (
            SELECT p.file, p.ends, o.tokens_before + p.tokens AS tokens, p.size,
                   o.closed_before + p.closed AS closed,
                   coalesce(o.tokens_before + p.last_end, o.last_before, -1L) + 1 AS open_at,
                   p.block = o.file_top AS is_last
            FROM placed p JOIN outer_scan o ON p.file = o.file AND p.g = o.g),
        cut AS (
            SELECT *, concat(transform(ends, e -> tokens + e),
                             CASE WHEN is_last AND size > 0
                                       AND coalesce(try_element_at(ends, -1), -1L) < size - 1
                                  THEN array(tokens + size) ELSE array() END) AS stops
            FROM stitched)
        SELECT file, closed + at AS number,
               CASE WHEN at = 0 THEN open_at ELSE stops[at - 1] + 1 END AS start,
               stop - CASE WHEN at = 0 THEN open_at ELSE stops[at - 1] + 1 END AS n_tokens
        FROM cut LATERAL VIEW posexplode(stops) AS at, stop
    """)


def counted(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, and file and start in the flat files."""
    flat = flat_files(docs, path)
    found = written(separators(flat.where("block IS NOT NULL")), "separators")
    order = flat.where("ids IS NOT NULL").selectExpr("file", "first", "posexplode(ids) AS (at, doc_id)")
    order = order.selectExpr("file", "first + at AS number", "doc_id")
    return order.join(documents(found), ["file", "number"]).select(
        "doc_id", "n_tokens", "file", "start"
    )


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    return counted(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens")
