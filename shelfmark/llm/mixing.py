"""Mixing sources to target weights by a time-varying curriculum (operator 8, native).

Every source has a weight schedule over training time 0 to 1, linear between
knots. Its integral is the source's weight, from which its share of all words
follows. The documents of a source stand in a fixed random order, pass after
pass; a document whose words begin after ``c`` demanded words of its source is
put where the integral of the schedule reaches ``c`` of the target, so early
and late shares follow the schedule. Sorting by position gives the mix.

Cases: null texts and texts without a word have size 0, take 0 words and have
no position; a null source is a source of its own, last in order; repeated
rows are separate documents. The order is by a hash of id and text, so null and
repeated ids spread like others, and only rows equal in both are ties: these
have equal sizes, and which of them is cut short makes no difference. An empty
table gives no row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import NO_ID, beside, id_key, restored, table, written

#: Weight at time 0, 1/2 and 1, for sources by rank, repeating. The integrals are 5, 2 and 1:
#: heavy sources come early, light ones late.
SCHEDULES = ((7.0, 5.0, 3.0), (2.0, 2.0, 2.0), (0.5, 1.0, 1.5))
MAX_PASSES = 3
#: Parts of a source, by the leading digits of a hash, so that no window holds a whole source.
_DIGITS = 3


def integral(knots: Sequence[float]) -> float:
    """Of a schedule whose knots are equally spaced over 0 to 1."""
    steps = len(knots) - 1
    return sum((a + b) / 2 for a, b in zip(knots, knots[1:], strict=False)) / steps


def _by_rank(values: Sequence[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE (_rank - 1) % {len(values)} {cases} END"


def _position(schedules: Sequence[Sequence[float]], share: str) -> str:
    """SQL: time at which the integral of a rank's schedule reaches ``share`` of its total.

    Between two knots the integral is a parabola ``r*u + (s - r)*u*u/(2*w)``;
    the root is written so that it also holds for a flat piece.
    """
    found = []
    for knots in schedules:
        width, total, done, pieces = 1 / (len(knots) - 1), integral(knots), 0.0, []
        for i, (r, s) in enumerate(zip(knots, knots[1:], strict=False)):
            area = (r + s) / 2 * width
            need = f"greatest({share} * {total!r} - {done!r}, 0D)"
            slope = (s - r) / width
            root = f"2 * {need} / ({r!r} + sqrt(greatest({r * r!r} + 2 * {slope!r} * {need}, 0D)))"
            where = f"WHEN {share} * {total!r} < {done + area!r} " if i < len(knots) - 2 else "ELSE "
            pieces.append(f"{where}{'THEN ' * (where != 'ELSE ')}{i * width!r} + {root}")
            done += area
        found.append(f"CASE {' '.join(pieces)} END" if len(pieces) > 1 else pieces[0][5:])
    return f"least(1D, {_by_rank([f'({x})' for x in found])})"


def targets(sizes: DataFrame, schedules=SCHEDULES, max_passes: int = MAX_PASSES) -> DataFrame:
    """One row per source: its rank, words and target.

    The capped sources are those with the fewest words for their weight, so one
    pass in that order finds the level at which no target is above its cap: the
    first place where the rest, shared by weight, fits under every cap left. Later
    levels are lower, so it is the largest that fits.
    """
    spark = sizes.sparkSession
    weights = [repr(integral(k)) + "D" for k in schedules]
    sizes.groupBy("source").agg(F.sum("size").alias("source_size")).createOrReplaceTempView(
        "_mix_sources"
    )
    return spark.sql(f"""
        WITH ranked AS (
            SELECT source, source_size,
                   row_number() OVER (ORDER BY source ASC NULLS LAST) AS _rank
            FROM _mix_sources),
        weighed AS (
            SELECT *, cast({max_passes} * source_size AS double) AS most,
                   {_by_rank(weights)} AS weight FROM ranked),
        levels AS (
            SELECT *, (sum(cast(source_size AS double)) OVER ()
                       - coalesce(sum(most) OVER before, 0D))
                      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0D)) AS level
            FROM weighed
            WINDOW before AS (ORDER BY most / weight, _rank
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        chosen AS (
            SELECT *, max(CASE WHEN level * weight <= most THEN level END) OVER () AS _level
            FROM levels)
        SELECT source, source_size, _rank, least(most, _level * weight) AS target FROM chosen
    """)


def mix(docs: DataFrame, schedules=SCHEDULES, max_passes: int = MAX_PASSES) -> DataFrame:
    """One row per document: what the mix takes of it, and when.

    Columns: doc_id, source, size, source_size, target, taken (words, passes
    added up), part (words of the last pass if that one is cut short, else 0),
    positions (a time for each pass). Full passes take whole documents; where
    the target ends inside a document, the mix takes its first ``part`` words.
    """
    spark = docs.sparkSession
    sized = docs.selectExpr(
        "cast(doc_id AS long) AS doc_id",
        "cast(source AS string) AS source",
        r"cast(coalesce(regexp_count(text, '[^\\x20\\x09-\\x0D]+'), 0) AS long) AS size",
        "md5(concat(coalesce(cast(doc_id AS string), ''), ':', coalesce(cast(text AS string), '')))"
        " AS _hash",
        "xxhash64(text) AS text_hash",
    ).withColumn("_part", F.substring("_hash", 1, _DIGITS))
    sized = written(sized, "sizes")
    goals = targets(sized, schedules, max_passes)
    goals.createOrReplaceTempView("_mix_goals")
    sized.createOrReplaceTempView("_mix_sizes")
    share = "cast(_begin + _pass * source_size AS double) / target"
    return spark.sql(f"""
        WITH parts AS (
            SELECT source, _part, sum(size) AS words FROM _mix_sizes GROUP BY source, _part),
        offsets AS (
            SELECT p.source, p._part, g.source_size, g.target, g._rank,
                   sum(p.words) OVER (PARTITION BY p.source ORDER BY p._part) - p.words AS _before
            FROM parts p JOIN _mix_goals g ON p.source <=> g.source),
        placed AS (
            SELECT s.doc_id, s.text_hash, s.source, s.size, o.source_size, o.target, o._rank,
                   o._before + sum(s.size) OVER (
                       PARTITION BY s.source, s._part ORDER BY s._hash, s.doc_id, s.text_hash
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS _begin
            FROM _mix_sizes s JOIN offsets o ON s.source <=> o.source AND s._part = o._part),
        counted AS (
            SELECT *, cast(round(target) AS long) AS _words FROM placed),
        taken AS (
            SELECT *, CASE WHEN size = 0 THEN 0 ELSE
                       (_words div source_size) * size
                       + least(size, greatest(0, _words % source_size - _begin)) END AS taken
            FROM counted)
        SELECT doc_id, text_hash, source, size, source_size, target, taken,
               CASE WHEN size = 0 THEN 0 ELSE taken % size END AS part,
               CASE WHEN taken = 0 THEN cast(array() AS array<double>) ELSE
                    transform(sequence(0, cast((taken - 1) div size AS int)),
                              _pass -> {_position(schedules, share)}) END AS positions
        FROM taken
    """)


def sequenced(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, once per pass, range-sorted by position.

    Rows with one id and text are told apart by number. A cut last pass holds
    the first ``part`` words of its text. Columns are those of ``docs``;
    ``n_chars`` follows a cut.
    """
    # Numbered before the passes are dealt out: all passes of a row have its number.
    passes = mixed.selectExpr(
        f"coalesce(doc_id, {NO_ID}) AS _id",
        "text_hash AS _text",
        f"row_number() OVER (PARTITION BY coalesce(doc_id, {NO_ID}), text_hash ORDER BY source)"
        " AS _copy",
        "taken AS _taken",
        "size AS _size",
        "part AS _part",
        "positions",
    ).where("_taken > 0")
    passes = passes.selectExpr(
        "_id", "_text", "_copy", "_taken", "_size", "_part", "posexplode(positions) AS (_pass, _at)"
    )
    string = F.col("text").cast("string")
    rows = beside(
        docs,
        _id=id_key(),
        _text=F.xxhash64(string),
        _whole=string,
        _source=F.col("source").cast("string"),
    )
    copy = "row_number() OVER (PARTITION BY _id, _text ORDER BY _source)"
    rows = rows.withColumn("_copy", F.expr(copy)).join(passes, ["_id", "_text", "_copy"])
    last = "_part > 0 AND (_pass + 1) * _size > _taken"
    ends = r"(?<=[^\\x20\\x09-\\x0D])(?=[\\x20\\x09-\\x0D])"
    cut = f"array_join(slice(split(_whole, '{ends}'), 1, cast(_part AS int)), '')"
    rows = rows.withColumn("_last", F.expr(last))
    rows = rows.withColumn("_taken_text", F.expr(f"CASE WHEN _last THEN {cut} ELSE _whole END"))
    at_text = f"_{docs.columns.index('text')}_"
    rows = rows.drop("_whole", "_text", "_source", "_copy", "_size", "_part", "_taken", at_text)
    # Written, so that finding the ranges does not join again, and the join's shuffles go.
    rows = written(rows, "mix").repartitionByRange("_at", "_id")
    rows = rows.sortWithinPartitions("_at", "_id")
    changed = {"text": F.col("_taken_text")}
    if "n_chars" in docs.columns:
        own = F.col(f"_{docs.columns.index('n_chars')}_")
        changed["n_chars"] = F.when(F.col("_last"), F.length("_taken_text")).otherwise(own)
    return restored(rows, docs, **changed)


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    rows = mixed.withColumn("first_at", F.expr("try_element_at(positions, 1)"))
    rows = rows.repartitionByRange("first_at", "doc_id").sortWithinPartitions("first_at", "doc_id")
    return rows.select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH sized AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS h,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents),
ranked AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source ASC NULLS LAST) AS k
    FROM sized GROUP BY source),
weighed AS (
    SELECT *, CAST(3 * source_size AS DOUBLE) AS most,
           CASE (k - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
    FROM ranked),
levels AS (
    SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER ()
               - coalesce(sum(most) OVER (ORDER BY most / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / (sum(weight) OVER ()
               - coalesce(sum(weight) OVER (ORDER BY most / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
    FROM weighed),
goals AS (
    SELECT source, source_size, least(most, weight * max(CASE WHEN level * weight <= most THEN level END) OVER ()) AS target
    FROM levels),
placed AS (
    SELECT doc_id, size, source_size, target, CAST(round(target) AS BIGINT) AS words,
           CAST(sum(size) OVER (PARTITION BY s.source ORDER BY h, doc_id, size
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS start
    FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0 ELSE (words // source_size) * size
            + least(size, greatest(0, words % source_size - start)) END AS BIGINT) AS taken
FROM placed
"""
