import random

import pytest
from pyspark.sql import functions as F

from guichet.llm import mixing
from tests.llm.conftest import texts


def fair_targets(sizes, weights=(5, 2, 1), repeat=3):
    """Give out the total by weight, cap, and give the excess to the rest until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), set(sizes), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level >= repeat * sizes[s]]
        if not over:
            out |= {s: weight[s] * level for s in free}
            break
        for s in over:
            out[s] = float(repeat * sizes[s])
            left -= out[s]
            free.remove(s)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_targets(spark, seed):
    r = random.Random(seed)
    sizes = {s: r.choice([0, r.randint(1, 50), r.randint(1000, 9000)]) for s in [None, "", "a", "B", "é", "z", "src10", "src9"][: 3 + seed]}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r[0]: r[2] for r in mixing.source_targets(df, (5, 2, 1), 3).collect()}
    want = fair_targets(sizes)
    assert found.keys() == want.keys()
    assert all(abs(found[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


def test_taken_words_come_near_the_targets(spark):
    r = random.Random(1)
    rows = [(i, t, r.choice(["a"] * 6 + ["b", "c", "d", None])) for i, t in enumerate(texts(2, 4000))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(df)
    found = mixed.collect()
    assert sorted(r["doc_id"] for r in found) == list(range(4000))
    by = {}
    for r in found:
        assert r["size"] == len(r["text"].split()) and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        by.setdefault(r["source"], []).append(r)
    want = fair_targets({s: sum(r["size"] for r in rows) for s, rows in by.items()})
    for s, rows in by.items():
        assert abs(rows[0]["target"] - want[s]) < 1e-6 * want[s]
        assert abs(sum(r["taken"] for r in rows) - want[s]) <= 5
        assert max(r["copies"] for r in rows) - min(r["copies"] for r in rows) <= 1
    again = {r["doc_id"]: r["copies"] for r in mixing.mix(df.repartition(5).orderBy(F.rand(3))).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in found}
    assert mixing.repeated(mixed).count() == sum(r["copies"] for r in found)
    assert mixing.repeated(mixed).columns == mixed.columns


def test_every_document_of_a_source_is_as_likely(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 5 AS int)) AS text", "if(id < 1500, 'a', 'b') AS source")
    counts = [mixing.mix(df, seed=s).groupBy((F.col("doc_id") % 5).alias("k"), "source").agg(F.avg("copies").alias("c")).collect() for s in range(2)]
    for rows in counts:
        for source in ("a", "b"):
            shares = [r["c"] for r in rows if r["source"] == source]
            assert max(shares) - min(shares) < 0.2


def test_odds(spark):
    rows = [(i, "w x y z", "a" if i % 2 else "b", [0.0, 1.0, 3.0, None, -1.0][i % 5]) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, quality double")
    found = mixing.mix(df, odds="quality")
    mean = {r[0]: r[1] for r in found.groupBy("quality").agg(F.avg("copies")).collect()}
    assert mean[0.0] == mean[None] == mean[-1.0] == 0
    assert mean[3.0] > 1.5 * mean[1.0] > 0
    assert found.filter("copies > 3").count() == 0


def test_odd_rows(odd_docs, no_docs):
    found = mixing.mix(odd_docs)
    made = ("size", "source_size", "target", "copies", "taken")
    assert found.columns == [c for c in odd_docs.columns if c not in made] + list(made)
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    assert all(r["size"] == 0 and r["taken"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    assert len({r["copies"] for r in rows if r["doc_id"] == 6}) == 1
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mix(odd_docs.filter("doc_id < 4")).filter("taken > 0").count() == 0
