import random

import pytest

LONG = " ".join(random.Random(5).choices("alpha beta gamma delta epsilon zeta eta theta iota kappa".split(), k=60_000))
SAME = "the quick brown fox jumps over the lazy dog and runs away from all of them today"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns named like what operators make."""
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n", "en", "a", 3),
        (4, "one two", "en", None, 7),
        (5, SAME, "en", "a", len(SAME)),
        (6, SAME, "de", "b", len(SAME)),
        (6, SAME, "de", "b", len(SAME)),
        (7, LONG, "en", "b", len(LONG)),
        (8, LONG + " end", "fr", "b", len(LONG) + 4),
        (None, SAME.upper(), None, "c", 5),
        (9, "12 % &! 34", "en", "c", 10),
        (10, "\x00\x1ćé​ \U0001f600 ﬁ", "fr", "c", 8),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = "size score lang_pred copies target taken pii_spans licence _doc _draw _found key text_a spans component sha band h loss part".split()
    for name in names:
        df = df.selectExpr("*", f"'{name}' AS `{name}`")
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


def texts(seed, n, words=60, vocabulary=400):
    r = random.Random(seed)
    known = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(vocabulary)]
    return [" ".join(r.choice(known) for _ in range(r.randint(1, words))) for _ in range(n)]
