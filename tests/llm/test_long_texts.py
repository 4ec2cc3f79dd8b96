"""Texts with very long runs, against the tokenizers library."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import tokencount

TEXTS = {
    "blanks": "a b" + " " * 1_000_000 + "c d",
    "line ends": "a" + "\n" * 1_000_000 + "b",
    "mixed": " \t\n\r" * 250_000 + "x",
    "at the end": "x" + " " * 1_000_000,
    "wide": "x" + "\u3000\xa0" * 20_000 + "y  z",
    "several": ("word" + " " * 20_000) * 30 + "!",
    "separators": "x" + "\x1c" * 12_000 + " y",
    "letters": "z" * 1_000_000,
    "only blanks": " " * 1_000_000,
}


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_ids(name):
    with open(public_tokenizers.path(tokencount.RANKS), "rb") as f:
        encoding = tokencount._encoding(f.read())
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = whole.encode(TEXTS[name], add_special_tokens=False).ids
    assert tokencount.ids_of(encoding, TEXTS[name]) == ids


def test_counts_of_very_long_texts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS.values())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(whole.encode(t, add_special_tokens=False).ids) for i, t in rows}
    assert {r.doc_id: r.n_tokens for r in tokencount.counted(docs).collect()} == want
