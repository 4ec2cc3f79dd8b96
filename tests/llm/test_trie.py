"""The prefix trie against brute force over all prefixes."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm import common, trie

SCHEMA = "role string, conv_id long, text string, turn long, depth string, name int"


def brute(rows):
    """(conv_id, turn, role, text) to one tuple per node."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for turns in own.values():
        turns.sort()
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole = own.get(c - c % 5, [])[:h] + turns[h:]
        made[c] = tuple((r, t) for _, _, r, t in whole)
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in made.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        cost = (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += cost
            leaves[node[:d]] += not children[node]
    out = []
    for node, convs in members.items():
        joined = ",".join(map(str, sorted(ends.get(node, []))))
        out.append(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                children[node],
                leaves[node],
                saved[node],
                hashlib.sha256(joined.encode()).hexdigest(),
            )
        )
    return sorted(out, key=lambda r: (r[1], r))


def answers(df):
    assert df.columns == trie._NODE
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1], r))


def frame(spark, rows, parts=3):
    made = [(role, conv, text, turn, "clash", 1) for conv, turn, role, text in rows]
    return spark.createDataFrame(made, SCHEMA).repartition(parts)


def random_rows(seed, convs, length, words, shared=0):
    """Conversations over few words, so that they share turns; some copy a long start."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(10 * convs, convs, replace=False).tolist():
        size = int(rng.integers(0, length))
        start = shared if rng.random() < 0.4 else 0
        for t in range(start + size):
            word = f"é{t}" if t < start else str(rng.integers(0, words))
            rows.append((c, t, "user" if t % 2 else "assistant", word))
    return rows


HARD = [
    (0, 0, "user", "a"),
    (0, 1, None, "b"),
    (0, None, "", None),
    (0, 1, None, "b"),
    (1, 5, "user", "x"),
    (1, 9, "user", "y"),
    (2, 0, None, None),
    (5, 0, "user", ""),
    (6, 0, "user", "a"),
    (7, 3, "user", "zz"),
    (13, 0, "a", "b:c"),
    (14, 0, "a:b", "c"),
    (23, 0, "u", "w" * 200_000),
    (None, 1, "user", "lost"),
    (10_000_000_000, 1, "user", "a"),
    *[(100 + i, t, "user", f"s{t}") for i in range(40) for t in range(6)],
    *[(500, t, "user", f"long {t}") for t in range(700)],
    *[(502, t, "user", f"long {t}") for t in range(701)],
]


def test_cases(spark):
    table = frame(spark, HARD)
    assert answers(trie.prefix_trie(table)) == brute(HARD)
    assert trie.prefix_trie(table.limit(0)).count() == 0
    assert trie.prefix_trie(table.where("conv_id IS NULL")).count() == 0


@pytest.mark.parametrize("batch,chunk", [(1, 1), (3, 2), (4096, 4096)])
@pytest.mark.parametrize("partitions", [1, 8])
def test_random(spark, monkeypatch, batch, chunk, partitions):
    """Batches, chunks and tasks of any size give the same nodes."""
    monkeypatch.setattr(trie, "BATCH", batch)
    monkeypatch.setattr(trie, "CHUNK", chunk)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set(coalesce, "false")
    try:
        for seed in range(2):
            rows = random_rows(seed, 120, 9, 2 + seed, 12)
            # One conversation that many others equal, and one first turn of a third of them.
            rows += [(5000 + 5 * i, t, "user", f"copy {t}") for i in range(60) for t in range(4)]
            rows += [(7000 + 5 * i, 0, "user", "first") for i in range(60)]
            rows += [(7000 + 5 * i, 1, "user", str(i % 50)) for i in range(60)]
            assert answers(trie.prefix_trie(frame(spark, rows))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set(coalesce, "true")


def test_whole_table(spark, sf):
    table = common.table(spark, sf, "conversations")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert answers(trie.op11_prefix_trie(spark, sf)) == brute(rows)


def test_two_fattest():
    for low in range(40):
        for high in range(low + 1, 80):
            best = max(range(low + 1, high + 1), key=lambda x: (x & -x))
            assert trie.two_fattest(low, high) == best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=12), max_size=30))
def test_exit_nodes(texts):
    """The exit found by fat binary search shares as much as any path inserted before."""
    index, seen = trie.ZFastTrie(), []
    for number, text in enumerate(texts):
        digests = b"".join(c.encode() * 16 for c in text)
        names = trie.prefix_names(digests)
        _, shared = index.exit(names)
        want = 0
        for other in seen:
            same = 0
            while same < min(len(text), len(other)) and text[same] == other[same]:
                same += 1
            want = max(want, same)
        assert shared == want
        node = index.insert(number, names, [1] * len(text))
        assert node.high == len(text) and node.names[: node.high + 1] == names
        seen.append(text)
    assert sum(len(n.ends) for n in index.nodes.values()) + len(index.root.ends) == len(texts)
    for name, node in index.nodes.items():
        assert node.handle() == name and node.parent.high == node.low < node.high
