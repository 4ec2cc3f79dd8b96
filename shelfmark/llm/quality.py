"""Quality rules by document and by host (operator 3).

Every document gets counts from its whole text and fails the base rules by
them. Failures are added up by host (``source``). A host's failure rate is
shrunk towards the other hosts by a beta prior, whose mean and weight are found
by moments from all hosts: few documents move a rate little. Documents of a
host whose shrunk rate is above ``MAX_RATE`` are not kept, whatever their own
counts.

Cases: null and empty texts have no words and fail; a null source is no host,
so its documents stand for themselves; repeated rows count each; a null
``doc_id`` is kept as such; an empty table gives no row; other columns are not
read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import table, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_RATE = 0.5
#: Bounds of the prior's weight, in documents: for hosts that all fail alike, or at random.
MOST_WEIGHT = 1e6

_SYMBOLS = b"#*$%&|<>"
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that are found twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    total, covered = 0, 0  # covered: end of the words counted so far
    for i, window in enumerate(windows):
        if found[window] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def counts(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()
    solid = b"".join(words)
    # A code point has one byte that does not continue another.
    word_chars = len(solid) if solid.isascii() else len(solid.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def measured(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, host, the counts and base_failed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for low in range(0, batch.num_rows, 1024):
                part = batch.column(2).slice(low, 1024).to_pylist()
                rows += [counts(t or b"") for t in part]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_COUNTS)
            arrays = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *arrays], names=["doc_id", "host", *_COUNTS]
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("host"),
        F.col("text").cast("string").cast("binary").alias("_bytes"),
    )
    schema = "doc_id long, host string, " + ", ".join(f"{c} long" for c in _COUNTS)
    failed = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
    return rows.mapInArrow(run, schema).withColumn("base_failed", F.expr(failed))


def host_verdicts(rows: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """Per host: host_docs, host_failed, host_rate (shrunk) and host_kept.

    Across hosts, the variance of the rates is the prior's variance plus the
    mean sampling variance; the prior's weight follows from what is left.
    """
    hosts = rows.where("host IS NOT NULL").groupBy("host").agg(
        F.count("*").alias("host_docs"),
        F.sum(F.col("base_failed").cast("long")).alias("host_failed"),
    )
    rate = "host_failed / host_docs"
    prior = hosts.selectExpr(
        f"avg({rate}) AS m", f"var_pop({rate}) AS v", "avg(1D / host_docs) AS inverse"
    ).selectExpr("m", "v - m * (1 - m) * inverse AS between").selectExpr(
        "m",
        f"""CASE WHEN between <= m * (1 - m) / {MOST_WEIGHT:.0f}D THEN {MOST_WEIGHT:.0f}D
            ELSE greatest(m * (1 - m) / between - 1, 1D) END AS weight""",
    ).select(F.struct("m", "weight").alias("prior"))
    shrunk = hosts.withColumn("_prior", prior.scalar()).withColumn(
        "host_rate",
        F.expr("(host_failed + _prior.m * _prior.weight) / (host_docs + _prior.weight)"),
    )
    return shrunk.withColumn("host_kept", F.col("host_rate") <= max_rate).drop("_prior")


def judged(docs: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """Per row: the counts, base_failed, kept and what is known of the host."""
    rows = written(measured(docs), "counts")
    # Written, so that Spark can split a hot host in the join if it is not broadcast.
    hosts = written(host_verdicts(rows, max_rate), "hosts")
    joined = rows.join(hosts, "host", "left")
    return joined.withColumn("kept", F.expr("NOT base_failed AND coalesce(host_kept, true)"))


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    rows = judged(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", *_COUNTS, "base_failed", "kept")


SQL = r"""
WITH rows AS (
    SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
lines AS (
    SELECT r, line FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM rows)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r),
windows AS (
    SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS win
    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM rows WHERE len(w) >= 3)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1),
covered AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words
    FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
counted AS (
    SELECT doc_id, host, CAST(len(w) AS BIGINT) AS n_words,
           CAST(coalesce(length(array_to_string(w, '')), 0) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
    FROM rows LEFT JOIN dups USING (r) LEFT JOIN covered USING (r)),
failed AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
hosts AS (
    SELECT host, count(*) AS n, CAST(sum(CAST(base_failed AS INT)) AS BIGINT) AS f
    FROM failed WHERE host IS NOT NULL GROUP BY host),
moments AS (
    SELECT avg(f / n) AS m, var_pop(f / n) - avg(f / n) * (1 - avg(f / n)) * avg(1 / n) AS between_ FROM hosts),
prior AS (
    SELECT m, CASE WHEN between_ <= m * (1 - m) / 1e6 THEN 1e6
                   ELSE greatest(m * (1 - m) / between_ - 1, 1) END AS weight FROM moments),
verdicts AS (
    SELECT host, (f + m * weight) / (n + weight) <= 0.5 AS host_kept FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(host_kept, true) AS kept
FROM failed LEFT JOIN verdicts USING (host)
"""
