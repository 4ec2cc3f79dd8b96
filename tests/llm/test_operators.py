"""Each operator against brute force, on hard cases, and on an empty table."""

import hashlib
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfmark.llm import (
    bpe,
    common,
    hnsw,
    language,
    mixing,
    pages,
    quality,
    registry,
    simhash,
    suffix,
    tokencount,
    windows,
)


def _texts(cases):
    return [(r[0], r[1]) for r in cases]


def _components(n, links):
    labels = np.arange(n)
    if links:
        labels = common.merge_labels(labels, *np.array(links).T)
    return labels


@pytest.fixture(scope="module")
def duck(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_equals_sql(spark, sf, duck, name):
    got = compare.from_spark(registry.QUERIES[name](spark, sf))
    assert compare.difference(got, compare.from_duckdb(duck, registry.SQL[name])) == ""


def test_components(spark):
    links = [(5, 3), (3, 9), (9, 1), (7, 8), (8, 7), (4, 4)]
    rows = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in common.components(rows).collect()}
    assert got == {5: 1, 3: 1, 9: 1, 1: 1, 7: 7, 8: 7}
    chain = spark.range(60).selectExpr("id AS a", "id + 1 AS b")
    assert {r.component for r in common.components(chain).collect()} == {0}


def test_token_counts(docs, cases, no_docs):
    import public_tokenizers

    with open(public_tokenizers.path(tokencount.RANKS), "rb") as f:
        encoding = tokencount._encoding(f.read())
    want = Counter((k, len(encoding.encode_ordinary(t or ""))) for k, t in _texts(cases))
    got = Counter((r.doc_id, r.n_tokens) for r in tokencount.counted(docs).collect())
    assert got == want
    assert tokencount.counted(no_docs).count() == 0


@pytest.mark.parametrize("block", [1, 8, 4096])
def test_separator_scan_of_raw_files(spark, tmp_path, block, monkeypatch):
    monkeypatch.setattr(tokencount, "GROUP", 4)
    rng, want = np.random.default_rng(block), []
    for name, size in (("a", 0), ("b", 700), ("c", 1500)):
        flat = rng.integers(0, 30, size).astype("<u2")
        flat.tofile(tmp_path / f"{name}.bin")
        stops = np.flatnonzero(flat == 7).tolist()
        if size and flat[-1] != 7:
            stops.append(size)
        start = 0
        for number, stop in enumerate(stops):
            want.append((name, number, start, stop - start))
            start = stop + 1
    blocks = tokencount.blocks_of(spark, str(tmp_path), 2, block)
    found = common.written(tokencount.separators(blocks, 7), "test")
    rows = tokencount.documents(found).collect()
    assert sorted((r.file[-5], r.number, r.start, r.n_tokens) for r in rows) == sorted(want)


def _fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, cases, no_docs):
    prints = [_fingerprint(t) for _, t in _texts(cases)]
    links = [
        (i, j) for i, a in enumerate(prints) for j, b in enumerate(prints) if (a ^ b).bit_count() <= 4
    ]
    labels = _components(len(prints), links)
    ids = [k if k is not None else common.NO_ID for k, _ in _texts(cases)]
    least = {c: min(i for i, own in zip(ids, labels) if own == c) for c in labels}
    want = Counter(
        (k, f"{p:016x}", None if least[c] == common.NO_ID else least[c])
        for (k, _), p, c in zip(_texts(cases), prints, labels)
    )
    assert Counter(map(tuple, simhash.near_copies(docs).collect())) == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(labels))
    assert simhash.near_copies(no_docs).count() == simhash.one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("size", [1, 40, 700])
def test_gray_index(size):
    rng = np.random.default_rng(size)
    codes = list(rng.integers(0, 1 << 63, size, dtype=np.uint64))
    for code in codes[:5]:
        for _ in range(200):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            codes.append(code ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64), initial=0))
    codes = np.unique(np.array(codes, dtype=np.uint64))
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    rank = (simhash.gray_rank(codes) ^ simhash._TOP).view(np.int64)
    assert (np.diff(rank) > 0).all() and (simhash.codes_of(rank) == codes).all()
    near = np.argwhere(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 4)
    want = common.merge_labels(np.arange(len(codes)), near[:, 0], near[:, 1])
    assert (simhash.linked(codes, np.zeros(len(codes), dtype=np.int64)) == want).all()


def test_crowded_groups_are_cut_in_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP", 16)
    codes = np.unique(np.uint64(1 << 40) ^ np.arange(300, dtype=np.uint64))
    rank = (simhash.gray_rank(codes) ^ simhash._TOP).view(np.int64)
    rows = spark.createDataFrame([(int(r), int(r)) for r in rank], "_rank long, _key long")
    reached = common.components(simhash.near_links(rows))
    assert reached.count() == 300 and reached.select("component").distinct().count() == 1


def test_quality_on_hard_cases(docs, cases, no_docs):
    got = {(r.doc_id, r.n_words): r for r in quality.judged(docs).collect()}
    assert got[(12, 9)].n_repeat_words == 9 and got[(12, 9)].base_failed
    assert got[(6, 0)].base_failed and got[(8, 3)].n_symbols == 2
    assert got[(10, 5)].word_chars == len("".join((cases[10][1]).split()))
    assert quality.judged(no_docs).count() == 0


def test_a_bad_host_loses_its_good_documents(spark):
    good, bad = "word%d " * 60 % tuple(range(60)), "x"
    rows = [(i, good if i % 10 == 0 else bad, "bad") for i in range(200)]
    rows += [(1000 + i, bad if i % 20 == 0 else good, f"h{i % 30}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in quality.judged(docs).where("kept").collect()}
    assert not any(k < 1000 for k in kept) and len(kept) == 2850


def _unit(v):
    v = np.array(v, dtype=float)
    return v / np.linalg.norm(v)


def test_embeddings(spark):
    rng, rows = np.random.default_rng(4), []
    centres = rng.normal(size=(12, 16))
    for i in range(900):
        spread = 0.05 if i % 3 else 1.0
        rows.append((i, (centres[i % 12] + spread * rng.normal(size=16)).tolist(), i % 2))
    rows += [(2000 + i, rows[1][1], 1) for i in range(40)]
    rows += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, rows[1][1], None)]
    rows += [(3003, [float("nan")] * 16, 1), (3004, [None] * 16, 0), (None, rows[1][1], 1)]
    rows += [(3005, [1.0, 0.0], 1), (3006, [2.0, 0.0], 1), (3007, [], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    bad = lambda v: not v or any(x is None or not np.isfinite(x) for x in v) or not any(v)
    units = [None if bad(v) or lab is None else _unit(np.float32(v)) for _, v, lab in rows]
    links = [
        (i, j)
        for i, a in enumerate(units)
        for j, b in enumerate(units)
        if i != j and a is not None and b is not None and rows[i][2] == rows[j][2]
        and len(a) == len(b) and a @ b >= 0.93
    ]
    labels, count = _components(len(rows), links), Counter(i for i, _ in links)
    ids = [k if k is not None else common.NO_ID for k, *_ in rows]
    least = defaultdict(lambda: common.NO_ID)
    for i, c in zip(ids, labels):
        least[c] = min(least[c], i)
    null = lambda x: None if x == common.NO_ID else x
    want = Counter((null(i), count[n], null(least[c]), i == least[c]) for n, (i, c) in enumerate(zip(ids, labels)))
    for shard in (128, 4096):
        got = Counter(map(tuple, hnsw.near_vectors(table, shard=shard).collect()))
        assert got == want
    assert hnsw.near_vectors(table.limit(0)).count() == 0


def test_main_text(spark):
    article = "<article><h1>A title</h1><p>First &amp; long  paragraph,\n of the text.<p>Short.</article>"
    rows = [
        (1, f"<html><nav><a href=x>Menu</a></nav>{article}<footer>Foot</footer>"),
        (2, None),
        (3, ""),
        (4, f"<div class='cookie-notice'>Cookies!</div>{article}<div id=comments><p>I say no.</div>"),
        (5, "<script>var t='</p>';</script><style>p{}</style>"),
        (6, "<div><p>" + "Very long words here. " * 20 + "</p><p>End.</p></div><ul><li><a>x</a></ul>"),
    ]
    table = spark.createDataFrame([(i, "u", h, "c") for i, h in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in pages.extracted(table).collect()}
    whole = "A title\nFirst & long paragraph, of the text.\nShort."
    assert [got[i].text for i in (1, 2, 3, 4, 5)] == [whole, "", "", whole, ""]
    assert got[6].text == ("Very long words here. " * 20).strip() + "\nEnd."
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert pages.extracted(table.limit(0)).count() == 0


@pytest.mark.parametrize("large, crowd", [(windows.LARGE, windows.CROWD), (0, windows.CROWD), (0, 1)])
def test_passages(docs, cases, no_docs, monkeypatch, large, crowd):
    monkeypatch.setattr(windows, "LARGE", large)
    monkeypatch.setattr(windows, "CROWD", crowd)
    spans, reached = windows.passages(docs)
    found = {(r["_key"]): r.spans for r in spans.collect()}
    assert {1, 2, 3, 4} <= set(found) and not {9, 10, 11, 12} & set(found)
    start = 80
    assert found[3][0] <= start and found[3][1] >= start + 70
    same = {r.node: r.component for r in reached.collect()}
    assert same[2] == 1 and same[4] == 3 and 11 not in same
    spans, reached = windows.passages(no_docs)
    assert spans.count() == reached.count() == 0


def test_near_passages_with_a_change(spark, cases):
    words = cases[0][1].split()
    edits = {
        20: words,
        21: words[:30] + ["changed"] + words[31:],
        22: words[:70] + words[71:],
        23: words[:55] + ["put", "in"] + words[55:],
        24: [w + "x" for w in words],
    }
    rows = [(k, " ".join(w)) for k, w in edits.items()]
    spans, reached = windows.passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.node for r in reached.where("component = 20").collect()} == {20, 21, 22, 23}
    assert {r["_key"] for r in spans.collect()} == {20, 21, 22, 23}


def test_compact_windows_are_the_subtrees_of_the_smallest():
    texts = [b" ".join(b"w%d" % ((i * i + 3 * k) % 97) for i in range(n)) for k, n in enumerate((160, 3, 0, 75))]
    words, ends = windows.words_of(texts)
    code = windows.in_a_row(words.astype(np.uint64), windows.SHINGLE)
    begins = np.append(0, ends)[:-1]
    for seed, (text, low, c, high, _) in zip(windows._SEEDS, windows.Windows().windows(words, ends)):
        value = windows.mixed(code ^ seed)
        for begin, end, t in zip(begins, ends, range(4)):
            covered = set()
            for a in range(begin, end - windows.WORDS + 1):
                covered.add(a + int(value[a : a + windows._SPAN].argmin()))
            assert covered <= set(c[text == t].tolist())
        for t, x, y, z in zip(text, low, c, high):
            assert value[x : z + 1].min() == value[y] and begins[t] <= x and z + windows.SHINGLE <= ends[t]


def _cut(rows, length=50):
    first, out = {}, []
    for k, text in rows:
        for i in range(len(text) - length + 1):
            s = text[i : i + length]
            first[s] = min(first.get(s, common.NO_ID), k)
    for k, text in rows:
        gone = np.zeros(len(text), dtype=bool)
        for i in range(len(text) - length + 1):
            if first[text[i : i + length]] < k:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int), [0]))) == 1).sum())
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        out.append((k, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_suffix_dedup(spark, docs, cases, tmp_path, monkeypatch):
    extra = [(30, "=" * 400), (31, "ab" * 100 + "=" * 130), (32, "é" * 60), (33, "xé" + "é" * 40), (34, "\x00" * 90 + "=" * 60)]
    rows = _texts(cases) + extra
    table = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, n_removed string")
    folder = str(tmp_path / "sf")
    table.write.parquet(f"{folder}/documents.parquet")
    want = _cut([(common.NO_ID if k is None else k, (t or "").encode()) for k, t in rows])
    for load, crowd in ((suffix._LOAD, suffix.CROWD), (300, 1)):
        monkeypatch.setattr(suffix, "_LOAD", load)
        monkeypatch.setattr(suffix, "CROWD", crowd)
        got = suffix.op7_suffix_dedup(spark, folder).collect()
        assert Counter((common.NO_ID if r[0] is None else r[0], *r[1:]) for r in got) == want
    kept = suffix.without_repeats(table)
    assert kept.columns == table.columns and kept.count() == len(rows)
    assert suffix.without_repeats(table.limit(0)).count() == 0


@pytest.mark.parametrize("letters", [1, 2, 200])
@pytest.mark.parametrize("size", [0, 1, 700])
def test_two_stage_sorting(size, letters):
    text = np.random.default_rng(size).integers(1, letters + 1, size).astype(np.uint8)
    for length in (5, 8, 50):
        order, whole = suffix.suffix_array(text, length), text.tobytes()
        starts = [whole[i : i + length] for i in order]
        assert sorted(order.tolist()) == list(range(size)) and starts == sorted(starts)
        if size:
            same = suffix.common_prefixes(text, order, length).tolist()
            assert same == [a == b and len(a) == length for a, b in zip(starts, starts[1:])]


def test_mixing(spark, docs, cases, no_docs):
    mixed = mixing.mix(docs)
    rows = mixed.collect()
    assert len(rows) == len(cases)
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
        assert 0 <= r.taken <= 3 * max(r.size, 0)
        assert len(r.positions) == (-(-r.taken // r.size) if r.size else 0)
        assert all(0 <= p <= 1 for p in r.positions) and list(r.positions) == sorted(r.positions)
    total = sum(r.size for r in rows)
    for own in by_source.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
        assert own[0].target <= 3 * own[0].source_size
    assert abs(sum(own[0].target for own in by_source.values()) - total) < 1e-6 * total
    made = mixing.sequenced(docs, mixed)
    assert made.columns == docs.columns
    words = sum(len((r.text or "").encode().split()) for r in made.collect())
    assert words == sum(r.taken for r in rows)
    assert made.count() == sum(len(r.positions) for r in rows)
    assert mixing.mix(no_docs).count() == 0


def test_mixing_does_not_depend_on_the_order_of_reading(spark):
    rows = [(None if i % 3 else 7, f"word{i} " + "same size " * 20, "web") for i in range(400)]
    rows += [(1000 + i, "other words " * 200, "book") for i in range(20)]
    schema = "doc_id long, text string, source string"
    got = []
    for order in (rows, rows[::-1]):
        mixed = mixing.mix(spark.createDataFrame(order, schema).repartition(3))
        got.append(sorted((r.text_hash, r.source, r.taken, tuple(r.positions)) for r in mixed.collect()))
    assert got[0] == got[1]


def test_schedules_integrate_to_the_weights(spark):
    assert [mixing.integral(s) for s in mixing.SCHEDULES] == [5.0, 2.0, 1.0]
    # The share of a source that is taken by a time follows the integral of its schedule.
    share = "cast(id AS double) / 1000"
    at = mixing._position(mixing.SCHEDULES, share)
    for rank, knots in enumerate(mixing.SCHEDULES, 1):
        got = [r[0] for r in spark.range(1001).selectExpr(f"id", f"{rank} AS _rank").selectExpr(at).collect()]
        grid = np.linspace(0, 1, 20001)
        flow = np.interp(grid, [0, 0.5, 1], knots)
        done = np.concatenate(([0], np.cumsum((flow[1:] + flow[:-1]) / 2))) / 20000 / mixing.integral(knots)
        assert np.abs(np.interp(got, grid, done) - np.arange(1001) / 1000).max() < 1e-6


def test_bpe_equals_the_library_and_decodes(docs, cases, no_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter()
    for k, text in _texts(cases):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[(k, len(ids), sha(" ".join(map(str, ids))), sha(decoded))] += 1
    assert Counter(map(tuple, bpe.encode(docs).collect())) == want
    assert bpe.encode(no_docs, ids=True).count() == 0


def test_bpe_on_odd_texts():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(bpe.VOCABULARY)
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        own = bpe.Encoder(f.read())
    rnd = random.Random(9)
    texts = ["aaaaaaa aaa", "x<|endoftext|>y<|STARTOFTEXT|> <|startoftext|>", "I'll ΣΑΣ İ ﬁ é\x1cz\x85q"]
    letters = "abAB''stTrevmdlé́ÉΣς  \n\t<|>endoftx.,!?123²½µ😀日\x1c\xa0‍"
    texts += ["".join(rnd.choices(letters, k=rnd.randint(0, 50))) for _ in range(800)]
    for text, (n, ids, decoded) in zip(texts, own.documents(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert " ".join(map(str, want)).encode() == ids and n == len(want), text
        assert library.decode(want, skip_special_tokens=False).encode() == decoded


def test_language_on_held_out_documents(spark, sf):
    table = common.table(spark, sf, "documents")
    rows = language.identify(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out")
    right, total = rows.selectExpr("sum(int(lang = lang_pred))", "count(*)").first()
    assert total > 20 and right >= 0.95 * total


def test_language_on_hard_cases(docs, no_docs, cases):
    rows = language.identify(docs).collect()
    assert len(rows) == len(cases)
    for r in rows:
        text = [t for k, t in _texts(cases) if k == r.doc_id]
        letters = any(c.isalpha() for t in text for c in t or "")
        assert 0 <= r.score <= 1 and r.held_out is (r.doc_id is not None and r.held_out)
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not letters) and (letters or not r.accepted)
    assert language.identify(no_docs).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}
    assert language.accepted_rows(docs).columns == docs.columns


def test_pipeline(spark, docs, no_docs, cases):
    import corpus_pipeline

    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = common.written(stage(spark, rows, ""), "stage")
        assert rows.columns == docs.columns, name
        assert set(r["_key"] for r in rows.select("_key").distinct().collect()) == {9}
        if name == "language ID":
            kept = {r.doc_id for r in rows.collect()}
            assert not kept & {5, 6, 7, 8} and {1, 2, 3, 4} <= kept
        if name == "SimHash near-dedup":
            kept = [r.doc_id for r in rows.collect()]
            assert 1 in kept and 2 not in kept and len(kept) == len(set(kept))
        if name == "suffix-array dedup":
            assert {r.doc_id for r in rows.collect()} == set(kept)
    empty = no_docs
    for _, stage in corpus_pipeline.STAGES:
        empty = common.written(stage(spark, empty, ""), "stage")
    assert empty.count() == 0
