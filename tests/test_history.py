"""The frontier by the filter of the history."""

import re

import pytest

from shelfmark.operators import delivered
from shelfmark.operators.history import VisitedHistory
from shelfmark.operators.links import frontier


def urls(spark, values):
    return spark.createDataFrame([(v,) for v in values], "url string")


FOUND = [
    *[f"http://big.net/{i}" for i in range(400)],
    *[f"http://h{i % 7}.net/p/{i}/" for i in range(200)],
    "http://h1.net/p/1#top",
    "http://h1.net/p/1",
    "/relative",
    "",
    None,
]


@pytest.mark.parametrize("most", [delivered.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("parts,slots,spread", [(1, 1, 1), (4, 8, 2), (16, 1 << 16, 4)])
def test_as_the_anti_join(spark, tmp_path, monkeypatch, most, parts, slots, spread):
    """With one slot every address is a chance hit: none is lost."""
    monkeypatch.setattr(delivered, "BROADCAST_BYTES", most)
    history = VisitedHistory(str(tmp_path / "h"), parts, slots, spread)
    found = urls(spark, FOUND)
    names = lambda df: sorted(r.url or "-" for r in df.collect())
    assert names(history.frontier(found)) == names(frontier(found))
    visited = [u for i, u in enumerate(FOUND) if i % 3 == 0]
    for part in (visited[:90], visited[60:], [None], []):
        history.add(urls(spark, part))
    history.filter.compact(spark)
    want = names(frontier(found, urls(spark, [u for u in visited if u is not None])))
    assert names(history.frontier(found)) == want


def test_only_hits_are_joined_and_only_in_their_parts(spark, tmp_path):
    history = VisitedHistory(str(tmp_path / "h"), parts=64, slots=1 << 20, spread=4)
    history.add(urls(spark, [f"http://big.net/{i}" for i in range(500)]))
    history.add(urls(spark, [f"http://h{i}.net/" for i in range(60)]))
    fresh = history.frontier(urls(spark, ["http://big.net/3", "http://big.net/x", "http://new.net"]))
    assert sorted(r.url for r in fresh.collect()) == ["http://big.net/x", "http://new.net"]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    part = history._placed(urls(spark, ["http://big.net/3"])).first().part
    assert re.search(rf"PartitionFilters: \[[^\]]*\(part#\d+L? = {part}\)", plan)
    # One large host lies in as many parts as it is spread over.
    used = {r.part for r in history._placed(urls(spark, FOUND[:400])).collect()}
    assert len(used) == 4
