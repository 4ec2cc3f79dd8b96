import pytest
from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi om pi rho sig tau ups".split()


def sentence(seed: int, size: int) -> str:
    """Invented words; other seeds give other words."""
    state, out = seed * 7919 + 17, []
    for _ in range(size):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(f"{WORDS[state % 20]}{(state >> 8) % 997}")
    return " ".join(out)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, size int, _key int"


@pytest.fixture(scope="session")
def cases():
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing extra columns."""
    passage = sentence(5, 70)
    rows = [
        (1, sentence(1, 120), "en", "a", 1),
        (2, sentence(1, 120), "en", "a", 1),
        (2, sentence(1, 120), "en", "a", 1),
        (3, sentence(2, 80) + " " + passage + " " + sentence(3, 80), "fr", "b", None),
        (4, sentence(4, 90) + "\n" + passage, None, None, 5),
        (5, "", "en", "b", 0),
        (6, None, "en", "a", 0),
        (7, " \t\n", "de", "a", 3),
        (8, "1234 ## 56", "de", "c", 9),
        (9, "one", "fr", None, 3),
        (10, "Été à l'ombre — ÉTÉ", "fr", "c", 19),
        (11, sentence(6, 30000), "en", "c", 1),
        (12, "a b c a b c a b c", "en", "c", 1),
        (None, sentence(7, 60), None, None, None),
        (None, None, None, None, None),
    ]
    return [(*r, "clash", 3, 9) for r in rows]


@pytest.fixture(scope="session")
def docs(spark, cases):
    return spark.createDataFrame(cases, SCHEMA).repartition(3, F.col("doc_id"))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
