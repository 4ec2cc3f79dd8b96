"""Delivered documents as bitmaps."""

import pytest

from shelfmark.operators import delivered
from shelfmark.operators.delivered import BITS, DeliveredMarks
from shelfmark.plans import inputs, jobs


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "doc_id long")


EDGES = [-BITS - 1, -BITS, -5, -1, 0, 1, 2, 7, 8, 9, BITS - 1, BITS, BITS + 1, 3 * BITS, 10**15]


@pytest.mark.parametrize("most", [delivered.BROADCAST_BYTES, 0])
def test_every_bit_of_its_own(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(delivered, "BROADCAST_BYTES", most)
    marks = DeliveredMarks(str(tmp_path / "m"))
    documents = ids(spark, [*EDGES, *EDGES[:3], None])
    count = lambda: sorted(r[0] for r in marks.undelivered(documents).where("doc_id IS NOT NULL").collect())
    assert count() == sorted([*EDGES, *EDGES[:3]])
    for n, marked in enumerate(EDGES):
        marks.mark(ids(spark, [marked, marked, None]))
        if n % 4 == 3:
            marks.compact(spark)
        left = EDGES[n + 1 :]
        assert count() == sorted([*left, *[e for e in EDGES[:3] if e in left]])
    assert marks.undelivered(documents).where("doc_id IS NULL").count() == 1


def test_marks_stay_bounded(spark, tmp_path):
    marks = DeliveredMarks(str(tmp_path / "m"))
    for n in range(6):
        marks.mark(spark.range(n * 20_000 + 1, (n + 1) * 20_000 + 1).toDF("doc_id"))
        marks.compact(spark)
        assert marks.read(spark).count() == -(-(n + 1) * 20_000 // BITS)
    assert marks.undelivered(spark.range(1, 120_005).toDF("doc_id")).count() == 4
    # A compaction that stopped before the old files went: the same set.
    marks.mark(delivered_ids := spark.range(5, 10).toDF("doc_id"))
    delivered.merged(marks.read(spark)).write.mode("append").parquet(marks.folder)
    assert marks.undelivered(delivered_ids).count() == 0
    assert marks.undelivered(spark.range(1, 120_005).toDF("doc_id")).count() == 4


def test_documents_are_not_shuffled(spark, tmp_path):
    marks = DeliveredMarks(str(tmp_path / "m"))
    marks.mark(spark.range(100).toDF("doc_id"))
    documents = spark.range(200).selectExpr("id AS doc_id", "repeat('x', 100) AS text")
    plan = marks.undelivered(documents)._jdf.queryExecution().executedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join" in line)
    assert "BroadcastHashJoin" in join and "BuildRight" in join
    before = plan.split("BroadcastExchange")[0]
    assert "hashpartitioning" not in before and "Range (0, 200" in before


def test_relay_with_bitmaps_sends_what_the_anti_join_sends(spark, sf, tmp_path):
    documents = inputs.documents(spark, sf)
    sent = {"rows": [], "bits": []}
    marks, table = DeliveredMarks(str(tmp_path / "m")), str(tmp_path / "rows")

    def into(name):
        return lambda rows: sent[name].append(sorted(r.doc_id for r in rows.collect()))

    for run in range(3):
        old = spark.read.parquet(table) if run else None
        mark = lambda found: found.write.mode("append").parquet(table)
        jobs.relay(documents, old, into("rows"), mark, bounded=run < 2)
        jobs.relay_marked(documents, marks, into("bits"), bounded=run < 2)
    assert sent["bits"] == sent["rows"] and sent["rows"]

    def lost(rows):
        raise OSError("lost")

    more = documents.selectExpr("doc_id + 1000000 AS doc_id", *[c for c in documents.columns if c != "doc_id"])
    with pytest.raises(OSError):
        jobs.relay_marked(more, marks, lost, bounded=False)
    assert not marks.undelivered(more).isEmpty()
