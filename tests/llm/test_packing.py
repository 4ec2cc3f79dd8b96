"""Packing: every id once, the three limits, no padding, ids of the tokenizers library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmark.llm import common, packing

LIBRARY = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def wanted(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [packing.END]


def check(rows, texts, limits):
    """Pieces against the documents (id, text), which may repeat."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    want = defaultdict(list)
    for key, text in texts:
        want[key].append(wanted(text))
    assert set(by_doc) == set(want)
    for key, pieces in by_doc.items():
        ids = want[key][0]
        assert all(w == ids for w in want[key])
        starts = defaultdict(list)
        for p in pieces:
            assert p.doc_tokens == len(ids)
            part = np.array(ids[p.start : p.start + p.length], dtype="<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part) and len(part) == 4 * p.length > 0
            starts[p.start].append(p.length)
        covered = np.zeros(len(ids), dtype=int)
        for start, lengths in starts.items():
            for length in lengths:
                covered[start : start + length] += 1
        assert (covered == len(want[key])).all()
    for pieces in by_sequence.values():
        pieces.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in pieces])
        assert [p.offset for p in pieces] == [0, *ends[:-1]]
        assert ends[-1] == limits.tokens or ends[-1] & (ends[-1] - 1) == 0
        assert ends[-1] <= limits.tokens and len(pieces) <= limits.segments
        assert sum(p.length - 1 for p in pieces) <= limits.loss


@pytest.mark.parametrize(
    "limits",
    [packing.Limits(), packing.Limits(64, 2, 50), packing.Limits(100, 64, 100), packing.Limits(8, 1, 3)],
)
def test_cases(spark, docs, cases, no_docs, limits):
    # Two texts with a null id: told apart by hand, as a null has no text of its own here.
    known = docs.where("doc_id IS NOT NULL")
    texts = [(r[0], r[1]) for r in cases if r[0] is not None]
    check(packing.pack_documents(known, limits).collect(), texts, limits)
    lost = packing.pack_documents(docs.where("doc_id IS NULL"), limits).collect()
    total = sum(len(wanted(r[1])) for r in cases if r[0] is None)
    assert sum(r.length for r in lost) == total and {r.doc_id for r in lost} == {None}
    assert packing.pack_documents(no_docs, limits).count() == 0


def test_whole_table(spark, sf):
    docs = common.table(spark, sf, "documents")
    rows = packing.op13_packing(spark, sf).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], packing.Limits())
    # Only the last sequence of a task may be short.
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.sequence_id] += r.length
    short = sum(1 for n in sizes.values() if n < packing.Limits().tokens)
    assert short <= 10 * docs.rdd.getNumPartitions()


def test_sequences_hold_the_ids(spark, docs, cases):
    pieces = packing.pack_documents(docs.where("doc_id IN (3, 4, 10)"), ids=True)
    pieces = spark.createDataFrame(pieces.collect(), pieces.schema)
    got = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    texts = {r[0]: wanted(r[1]) for r in cases}
    for p in pieces.collect():
        ids = got[p.sequence_id].ids[p.offset : p.offset + p.length]
        assert ids == texts[p.doc_id][p.start : p.start + p.length]
        assert p.offset in got[p.sequence_id].offsets


@pytest.mark.parametrize(
    "text",
    [
        " " * 1_000_000,
        "a" + "\n" * 300_000 + "b",
        "z" * 300_000,
        "it's  we'll\t\tx 'S 12½ 3² é×÷ ªº ƻ “quoted” — €5 … \x1c \x85 \xa0\xa0 end ",
        "中文 и кириллица 12  　x",
        "<|endoftext|>a  <|endoftext|> <|endof <|endoftext|>",
    ],
)
def test_ids_of_hard_texts(text):
    with open(public_tokenizers.path(packing.VOCABULARY), encoding="utf-8") as file:
        encoder = packing.ids_of(file.read())
    assert np.frombuffer(encoder.of(text), dtype="<u4").tolist() == wanted(text)[:-1]


def test_pieces_of_two_tokens():
    """Where merges by rank and merges by list could part: tokens side by side."""
    with open(public_tokenizers.path(packing.VOCABULARY), encoding="utf-8") as file:
        encoder = packing.ids_of(file.read())
    assert encoder.known.ranked is not None
    words = [LIBRARY.decode([i]) for i in range(50256)]
    words = [w for w in words if w.strip().isascii() and w.strip().isalpha()]
    rng = np.random.default_rng(1)
    texts = [*words, *[words[a] + words[b].strip() for a, b in rng.integers(0, len(words), (20000, 2))]]
    encoder.known.clear()
    for text, found in zip(texts, LIBRARY.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(encoder.known[text], dtype="<u4").tolist() == found.ids, text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x2100, exclude_categories=["Cs"]), max_size=60))
def test_ids_of_any_text(text):
    with open(public_tokenizers.path(packing.VOCABULARY), encoding="utf-8") as file:
        encoder = packing.ids_of(file.read())
    assert np.frombuffer(encoder.of(text), dtype="<u4").tolist() == wanted(text)[:-1]


@pytest.mark.parametrize("limits", [packing.Limits(1000, 8, 600), packing.Limits(1000, 3, 1000)])
def test_examples(spark, limits):
    rng = np.random.default_rng(3)
    rows = [(i, int(t), int(t * s)) for i, (t, s) in enumerate(zip(rng.integers(0, 700, 9000), rng.random(9000)))]
    rows += [(9001, 1001, 0), (9002, 10, 2000), (9003, None, None), (None, 5, 5), (7, 20, 3)]
    table = spark.createDataFrame(rows, "example_id long, tokens long, loss long").repartition(2)
    got = packing.pack_examples(table, limits).collect()
    key = lambda r: (r[0] is None, r)
    given = sorted(((a, b or 0, c or 0) for a, b, c in rows), key=key)
    assert sorted(((r.example_id, r.tokens, r.loss) for r in got), key=key) == given
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append(r)
    for placed in bins.values():
        placed.sort(key=lambda r: r.segment)
        assert [r.segment for r in placed] == list(range(len(placed)))
        assert [r.offset for r in placed] == [0, *np.cumsum([r.tokens for r in placed])[:-1]]
        fits = [r.fits for r in placed]
        if not all(fits):
            assert len(placed) == 1 and (placed[0].tokens > 1000 or placed[0].loss > limits.loss)
            continue
        assert sum(r.tokens for r in placed) <= limits.tokens
        assert sum(r.loss for r in placed) <= limits.loss and len(placed) <= limits.segments
    least = max(
        sum(min(b or 0, 1000) for _, b, _ in rows) / limits.tokens,
        sum(min(c or 0, limits.loss) for _, _, c in rows) / limits.loss,
        len(rows) / limits.segments,
    )
    # The bound of the tightest limit alone; two limits that are both tight allow less.
    assert len(bins) <= 1.15 * least + 4
    assert packing.pack_examples(table.limit(0), limits).count() == 0


def test_instruction_examples(spark):
    turns = [(1, 0, "user", "hello there"), (1, 1, "assistant", "hi"), (2, 0, "assistant", None), (2, 1, None, "x")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.example_id: (r.tokens, r.loss) for r in packing.instruction_examples(table).collect()}
    assert got == {
        1: (len(wanted("hello there")) + len(wanted("hi")), len(wanted("hi"))),
        2: (1 + len(wanted("x")), 1),
    }
