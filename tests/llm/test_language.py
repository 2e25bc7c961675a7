import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from guichet.llm import language
from guichet.llm.queries import public_vocabulary, op3_language_id

PATH = public_vocabulary("piece_bpe_32k.model")


def all_segmentations(word, pieces, column):
    """Sum over every segmentation, one by one."""
    if not word:
        return 1.0
    total = 0.0
    for k in range(1, len(word) + 1):
        row = pieces.number.get(word[:k], len(pieces) if k == 1 else None)
        if row is not None:
            total += column[row] * all_segmentations(word[k:], pieces, column)
    return total


@pytest.fixture(scope="module")
def small():
    pieces = language.Pieces(["▁", "a", "b", "ab", "ba", "▁a", "abc", "▁ab"])
    table = np.random.default_rng(0).random((10, 2))
    table[-1] = 0
    return language.Model(["x", "y"], pieces, table)


def test_forward_sums_all_segmentations(small):
    r = random.Random(0)
    words = list({"".join(r.choice("abcdé") for _ in range(r.randint(1, 11))) for _ in range(200)})
    found, scores = language.word_scores(words, small)
    assert sorted(found) == sorted(words)
    for word, score in zip(found, scores, strict=True):
        for column in (0, 1):
            assert math.isclose(score[column], math.log(all_segmentations("▁" + word, small.pieces, small.table[:, column])), rel_tol=1e-9)


def test_very_long_words_score_as_in_one_lattice(small):
    word = "abcab" * 50
    _, short = language.word_scores([word], small)
    assert np.allclose(language._long_score("▁" + word, small), short[0])


def test_expected_counts_are_those_of_all_segmentations(small):
    words, counts = ["▁abab", "▁abcb", "▁a"], np.array([2.0, 1.0, 3.0])
    total = language._expected(words, counts, small.pieces, small.table[:, 0])
    column, want = small.table[:, 0], np.zeros(10)
    for word, n in zip(words, counts, strict=True):

        def walk(rest, weight, used):
            if not rest:
                paths.append((weight, used))
            for k in range(1, len(rest) + 1):
                row = small.pieces.number.get(rest[:k], len(small.pieces) if k == 1 else None)
                if row is not None:
                    walk(rest[k:], weight * column[row], [*used, row])

        paths = []
        walk(word, 1.0, [])
        for weight, used in paths:
            for row in used:
                want[row] += n * weight / sum(w for w, _ in paths)
    assert np.allclose(total, want)


def test_lookup_finds_every_piece_and_nothing_else():
    pieces = language.vocabulary(PATH)
    words = list(pieces.number)[::37]
    for word in words:
        ids = language._lattice([word], pieces)[0]
        assert pieces.number[word] in ids
    assert len(pieces) == len(pieces.number) > 20_000


def test_held_out_accuracy(spark, data_dir):
    sf = data_dir.replace("sf0.001", "sf0.01")
    found = op3_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.99
    assert found.filter("score < 0 or score > 1 or score is null").count() == 0


def test_odd_rows(spark, odd_docs, no_docs):
    model = language.fit(odd_docs, PATH)
    found = language.identify(odd_docs, model)
    assert found.columns == [c for c in odd_docs.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0 <= r["score"] <= 1 and (letters or r["score"] == 0)
    nothing = language.fit(no_docs, PATH)
    assert nothing.langs == []
    assert {r["lang_pred"] for r in language.identify(odd_docs, nothing).collect()} == {"und"}
    assert language.identify(no_docs, model).count() == 0


def test_share_of_rows_to_learn_from():
    """No language is left out, however many rows there are; small inputs are learned from whole."""
    shares = language._shares({"en": 10**12, "xx": 3, "yy": 10**6}, 20_000, 500)
    assert 10_000 < shares["en"] * 10**12 < 20_001 and shares["xx"] == 1 and shares["yy"] * 10**6 == pytest.approx(500)
    assert language._shares({"en": 9_000, "de": 9_000}, 20_000, 500) == {"en": 1.0, "de": 1.0} and language._shares({}, 20_000, 500) == {}


def test_rare_languages_and_long_words_are_learned(spark):
    rows = [(i, "common words of the frequent language", "en") for i in range(400)] + [(1000, "zzyzx qxq " + "qz" * 300, "rare")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df, public_vocabulary("piece_bpe_32k.model"), sample_docs=20, least_docs=5)
    assert model.langs == ["en", "rare"] and np.isfinite(model.table).all()
    found = language.identify(spark.createDataFrame([(1, "qzqzqz zzyzx")], "doc_id long, text string"), model).collect()
    assert [r["lang_pred"] for r in found] == ["rare"]
