"""Spelling variants against brute force over all pairs of words."""

import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.llm import common, variants


def brute_counts(rows, least_length, least_count, divisor):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % divisor == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=2):
    """All pairs of words that share a form with one character left out, each tested."""
    buckets = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            buckets[w[:i] + w[i + 1 :]].add(w)
        buckets[w].add(w)
    met = defaultdict(set)
    for group in buckets.values():
        for a in group:
            met[a] |= {b for b in group if near(a, b)}
    forms = {}
    for w, n in counts.items():
        best = min(met[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        f = forms[w]
        out[w] = (f, root, n, len(met[w]), counts[f] if f else None)
    return out


def answers(df):
    rows = df.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


TYPOS = [
    "letter",
    "leter",
    "lettter",
    "lettre",
    "better",
    "bettter",
    "aaaaa",
    "aaaaaa",
    "aaaaaaa",
    "baaaaa",
    "aaaaab",
    "étésà",
    "étésàx",
    "×÷×÷×",
    "Étésà",
    "LETTER",
    "four",
]


def test_near_by_every_pair():
    """The buckets of the brute force meet every near pair."""
    words = [w.lower() for w in TYPOS]
    got = brute({w: 3 for w in words})
    for w in set(words):
        assert got[w][3] == sum(near(w, x) for x in set(words))


@pytest.mark.parametrize("divisor", [97, 2, 1])
def test_cases(spark, docs, cases, no_docs, divisor):
    extra = []
    for i, w in enumerate(TYPOS):
        extra.append((100 + i, " ".join([w] * (i % 5 * 3 + 1)), None, None, None, "clash", 3, 9))
        extra.append((200 + i, f"{w}, {w}!{w}Ā{w}1{w}" * (1 + i % 3), None, None, None, "c", 3, 9))
    extra.append((300, "x" * 1_000_000 + " " + "word " * 10, None, None, None, None, None, None))
    table = docs.union(spark.createDataFrame(extra, docs.schema))
    rows = [(r[0], r[1]) for r in [*cases, *extra]]
    want = brute(brute_counts(rows, 5, 3, divisor))
    assert answers(variants.grouped(table, divisor=divisor)) == want
    assert divisor > 2 or any(v[0] for v in want.values())
    assert variants.grouped(no_docs).count() == 0


def test_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in common.table(spark, sf, "documents").collect()]
    want = brute(brute_counts(rows, 5, 3, 97))
    got = answers(variants.op12_spelling_variants(spark, sf))
    assert got == want and any(v[0] for v in want.values())


def test_counts_in_parts(spark, sf, monkeypatch):
    monkeypatch.setattr(variants, "_KEPT", 10)
    docs = common.table(spark, sf, "documents").where("doc_id < 100")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.word: r.n for r in variants.word_counts(docs, 3, 1, 3).collect()}
    assert got == brute_counts(rows, 3, 1, 3)


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.text(alphabet="abé", min_size=1, max_size=5), st.integers(1, 40), max_size=25))
def test_scan_of_any_words(spark, counts):
    words = spark.createDataFrame([(w, n) for w, n in counts.items()], "word string, n long")
    got = {r.word: (r.n_near, r.best, r.best_n) for r in variants.near_words(words).collect()}
    want = {}
    for w in counts:
        met = [x for x in counts if near(w, x)]
        if met:
            best = min(met, key=lambda x: (-counts[x], x))
            want[w] = (len(met), best, counts[best])
    assert got == want


def test_hashed_rotations():
    for word in ("a", "étés", "abcab" * 30):
        skip, full = variants.hashed_rotations(word)
        whole = word + variants.END

        def sums(text):
            return [sum(ord(c) * pow(b, j, p) for j, c in enumerate(text)) % p for p, b in variants._PRIMES]

        for i in range(len(whole)):
            turned = whole[i:] + whole[:i]
            assert full[i].tolist() == sums(turned)
            if i < len(word):
                assert skip[i].tolist() == sums(turned[1:])


@pytest.mark.parametrize("long", [1, 2, 3, 4, 5, 64])
def test_long_words_as_short_ones(spark, long):
    counts = {w: 1 + 7 * i % 23 for i, w in enumerate(map(str.lower, TYPOS))}
    counts |= {"x" * 20: 5, "x" * 21: 5, "x" * 10 + "y" + "x" * 10: 5, "abc": 1, "abd": 1}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: (r.n_near, r.best, r.best_n) for r in variants.near_words(words, long).collect()}
    plain = {r.word: (r.n_near, r.best, r.best_n) for r in variants.near_words(words, 99).collect()}
    assert got == plain and len(got) > 10


def test_very_long_words(spark):
    """A word costs its length, not its square."""
    base = "abcdefghij" * 20_000
    texts = [base, base[:777] + "z" + base[778:], base[:5] + base[6:], base[::-1]]
    rows = [(i, " ".join([t] * (i + 3))) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = answers(variants.grouped(docs, divisor=1 << 40))
    assert got[base] == (None, base, 3, 2, None)
    assert got[texts[1]][3] == got[texts[2]][3] == 1 and got[texts[3]][3] == 0


def test_scan_over_batches():
    """A group that lies in several batches is one group."""
    rows = [("b", 1, "ab", 9), ("b", 1, "cb", 5), ("b", 2, "b", 2), ("d", 1, "de", 1)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("key", "kind", "word", "n"), r)) for r in rows])
    got = [r for b in variants._scan(batch.slice(i, 1) for i in range(4)) for r in b.to_pylist()]
    assert [tuple(r.values()) for r in got] == [
        ("ab", 2, 5, "cb"),
        ("cb", 2, 9, "ab"),
        ("b", 2, 9, "ab"),
    ]


def test_long_chain(spark):
    chain = [(f"w{i:04d}", f"w{i + 1:04d}") for i in range(300)]
    links = spark.createDataFrame(chain, "word string, form string").orderBy(F.rand(1))
    got = {r.word: r.root for r in variants.rooted(links).collect()}
    assert got == {w: "w0300" for w, _ in chain}
