import random
import re

import pytest
from pyspark.sql import functions as F

from guichet.llm import licences

APACHE = licences.TEMPLATES[1][1]
MIT = licences.TEMPLATES[4][1]


def dice(a, b):
    x, y = ({*zip(w, w[1:], strict=False)} for w in map(licences.normalised_words, (a, b)))
    return 2 * len(x & y) / (len(x) + len(y))


@pytest.fixture(scope="module")
def scan(spark):
    def run(texts):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
        return {r["i"]: (r["licence"], r["licence_dice"], r["licence_matches"]) for r in licences.scan(df).collect()}

    return run


def test_lines_paragraphs_and_wholes(scan):
    half = len(MIT) // 2
    cut = MIT.index(" ", half)
    wrapped = APACHE.replace(", ", ",\n    ").replace(". ", ".\n")
    found = scan(["some prose\nReleased under the MIT License.\nmore", wrapped, "before\n\n" + wrapped + "\n\nafter", MIT[:cut] + "\n\n" + MIT[cut:], "LICENSED *** under the APACHE license -- version 2.0!!", "nothing of the kind"])
    assert found[0] == ("MIT", 1.0, 1) and found[1][:2] == ("Apache-2.0", 1.0) and found[2][:2] == ("Apache-2.0", 1.0)
    assert found[3][0] == "MIT" and found[3][1] == pytest.approx(1.0)
    assert found[4] == ("Apache-2.0", 1.0, 1) and found[5] == (None, None, 0)


def test_coefficient_is_that_of_the_bigram_sets(scan):
    words = MIT.split()
    texts = [" ".join(words[: len(words) * k // 10]) for k in range(5, 11)] + [" ".join(words[::-1]), MIT + " " + MIT]
    found = scan(texts)
    assert found.pop(7) == ("MIT", 1.0, 1)  # the run of its second half is the template itself
    for i, (licence, score, _) in found.items():
        want = dice(texts[i], MIT)
        assert (licence == "MIT") == (want >= 0.8)
        if licence:
            assert score == pytest.approx(want)


def test_sizes_rule_out_nothing_that_matches():
    """For any overlap, a coefficient at the threshold means sizes within the bounds."""
    for n in range(1, 60):
        for m in range(1, 120):
            if 2 * min(n, m) / (n + m) >= 0.8:
                assert 0.8 / 1.2 * n - 1e-9 <= m <= 1.2 / 0.8 * n + 1e-9


def test_odd_rows(odd_docs, no_docs):
    found = licences.scan(odd_docs)
    made = ["licence", "licence_dice", "licence_matches"]
    assert found.columns == [c for c in odd_docs.columns if c not in made] + made
    assert {(r["licence"], r["licence_matches"]) for r in found.collect()} == {(None, 0)}
    assert found.count() == odd_docs.count() and licences.scan(no_docs).count() == 0


def test_no_python_in_the_plan(odd_docs):
    plan = licences.scan(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert isinstance(licences.matches(F.col("text")), type(F.col("text")))


BSD = next(t for n, t in licences.TEMPLATES if n == "BSD-3-Clause")
CODE = "int main(void) {\n    return 0;\n}\n"


def paragraphs(text, n=3):
    words = text.split()
    return "\n\n".join(" ".join(words[len(words) * i // n : len(words) * (i + 1) // n]) for i in range(n))


def commented(text):
    return "/*\n" + "\n".join(" * " + line for line in text.split("\n")) + "\n */\n"


def test_headers_with_code_behind_and_notices_in_prose(scan):
    head = "MIT License\n\nCopyright (c) 2020 Some One\n\n"
    found = scan(
        [
            head + paragraphs(MIT) + "\n\n" + CODE * 50,
            "#!/usr/bin/env python\n" + paragraphs(APACHE).replace("\n", "\n# ") + "\n\nimport os\n" * 30,
            "We wrote this in a week. Released under the MIT License. It has no tests, and more will follow.",
            commented("Copyright 2001\n\n" + paragraphs(BSD, 6)) + CODE * 20,
            "\n\n".join([CODE, paragraphs(MIT), CODE, paragraphs(APACHE), CODE]),
        ]
    )
    assert [found[i][0] for i in range(4)] == ["MIT", "Apache-2.0", "MIT", "BSD-3-Clause"]
    assert min(found[i][1] for i in range(4)) > 0.95
    assert found[4][2] >= 2


def units(text):
    cut = re.sub("[.!?;:]+[ \t\r]", "\n", text)
    return [w for w in map(licences.normalised_words, cut.split("\n")) if w]


def best_runs(text):
    """Every template's best coefficient over all runs of units, with the first word and length."""
    rows, out = units(text), []
    for t, (_, body) in enumerate(licences.TEMPLATES):
        known, least, most = licences.bounds(body, 0.8)
        found = []
        for i in range(len(rows)):
            for j in range(i, len(rows)):
                w = sum(rows[i : j + 1], [])
                if least <= len(w) - 1 <= most:
                    grams = {*zip(w, w[1:], strict=False)}
                    first = sum(map(len, rows[:i]))
                    found.append((2 * len(grams & {*known}) / (len(grams) + len(known)), -first, len(w)))
        if found and max(found)[0] >= 0.8:
            dice, first, n = max(found)
            out.append((t, round(dice, 9), -first, n))
    return out


def test_same_as_every_run_spelled_out(spark):
    rng, texts = random.Random(3), []
    bodies = [t for _, t in licences.TEMPLATES]
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 4)):
            words = rng.choice(bodies).split()
            for _ in range(rng.randint(0, len(words) // 8)):
                words[rng.randrange(len(words))] = rng.choice(["the", "license", "x", "of\n", "is.", "\n\n"])
            parts.append(" ".join(words[rng.randint(0, 3) :]))
            parts.append(rng.choice(["", "prose before it", CODE, "a b a b a b"]))
        texts.append(rng.choice([" ", "\n", ". ", "\n\n"]).join(parts))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", licences.matches(F.col("text")).alias("m"))
    for r in df.collect():
        assert [(m["template"], round(m["dice"], 9), m["first"], m["words"]) for m in r["m"]] == best_runs(texts[r["i"]])
    assert sum(bool(best_runs(t)) for t in texts) > 20
