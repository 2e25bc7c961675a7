import math
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from guichet.operators import pairs, similar, terms
from guichet.session import dropped, written


def texts(seed, n, copies=0):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 12)))) for i in range(n)]
    return rows + [(1000 + i, "same words in all of these copies") for i in range(copies)]


def weights(rows):
    counts = {k: Counter(t.lower().split()) for k, t in rows if t and t.split()}
    df = Counter(w for c in counts.values() for w in c)
    out = {}
    for k, c in counts.items():
        raw = {w: n * (math.log((1 + len(counts)) / (1 + df[w])) + 1) for w, n in c.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        out[k] = {w: x / norm for w, x in raw.items()}
    return out, df


def fitted(spark, rows, kind="long"):
    df = spark.createDataFrame(rows, f"id {kind}, text string, term string, n int" if len(rows[0]) == 4 else f"id {kind}, text string")
    counts = terms.term_counts(df.repartition(3), "id", "text")
    return terms.vectors(counts, terms.fit(counts))


def brute_force(rows, k, least, asks=lambda _: True, answers=lambda _: True):
    vectors, df = weights(rows)
    out = []
    for x in filter(asks, vectors):
        scored = []
        for y in vectors:
            if y != x and answers(y):
                parts = {w: vectors[x][w] * vectors[y][w] for w in vectors[x].keys() & vectors[y].keys()}
                score = round(math.fsum(parts.values()), 6)
                if score >= least:
                    scored.append((-score, y, [w for _, _, w in sorted((-round(p, 6), df[w], w) for w, p in parts.items())[:3]]))
        out += [(x, rank, y, -score, named) for rank, (score, y, named) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_weights_have_length_one_and_their_order(spark):
    rows = texts(1, 30)
    want, df = weights(rows)
    got = {r["key"]: r["vector"] for r in fitted(spark, rows).collect()}
    assert got.keys() == want.keys()
    for k, vector in got.items():
        assert [(t["df"], t["term"]) for t in vector] == sorted((df[w], w) for w in want[k])
        assert all(abs(t["weight"] - want[k][t["term"]]) < 1e-9 for t in vector)


@pytest.mark.parametrize("frequent", [0, 7, 1000])
def test_frequent_terms_are_broadcast_and_others_joined(spark, monkeypatch, frequent):
    monkeypatch.setattr(terms, "_FREQUENT", frequent)
    rows = texts(1, 30) + [(50, "rare"), (51, "rare rare w1"), (52, "1 2 2 10 01"), (None, "w1 rare"), (51, "rare w2")]
    counts = written(terms.term_counts(spark.createDataFrame(rows, "id long, text string").repartition(3), "id", "text"))
    merged = {}
    for k, t in rows:
        if k is not None:
            merged[k] = f"{merged.get(k, '')} {t}"
    want, df = weights(list(merged.items()))
    got = {r["key"]: r["vector"] for r in terms.vectors(counts, written(terms.fit(counts))).collect()}
    assert got.keys() == want.keys()
    for k, vector in got.items():
        assert [(t["df"], t["term"]) for t in vector] == sorted((df[w], w) for w in want[k])
        assert all(abs(t["weight"] - want[k][t["term"]]) < 1e-9 for t in vector)
    kept = terms.vectors(counts.filter("key < 20"), terms.fit(counts, 3))
    assert {t["term"] for r in kept.collect() for t in r["vector"]} <= {w for w, n in df.items() if n >= 3}


def test_nothing_shuffled_stays_behind_a_table_in_between(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in files.split("\n") if "/shuffle_" in f}

    before = shuffled()
    table = written(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count())
    assert not shuffled() - before
    assert table.count() == 100
    dropped(table)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST"):
        spark.read.parquet(*table.inputFiles()).count()


@pytest.mark.parametrize("k,least,block", [(3, 0.3, 256), (3, 0.3, 4), (1, 0.8, 3), (50, 0.05, 7)])
def test_nearest_equals_brute_force(spark, monkeypatch, k, least, block):
    monkeypatch.setattr(similar, "_BLOCK", block)
    rows = texts(2, 70, copies=9)
    assert rows_of(similar.nearest(fitted(spark, rows), k, least=least)) == brute_force(rows, k, least)


def test_some_ask_and_others_answer(spark):
    rows = texts(3, 60, copies=9)
    got = similar.nearest(fitted(spark, rows), 4, least=0.2, asks=F.col("key") % 3 == 0, answers=F.col("key") % 3 != 0)
    assert rows_of(got) == brute_force(rows, 4, 0.2, lambda x: x % 3 == 0, lambda x: x % 3 != 0)


def test_string_keys_are_compared_as_text(spark):
    rows = [(str(k), t) for k, t in texts(4, 30, copies=12)]
    assert rows_of(similar.nearest(fitted(spark, rows, "string"), 3, least=0.3)) == brute_force(rows, 3, 0.3)


def test_odd_rows(spark):
    rows = [(None, "lost row", "x", 1), (1, None, "x", 1), (2, "", "x", 1), (3, "a b", "x", 1), (4, "A  b!", None, None), (5, "word " * 100_000, "x", 1), (5, "word", "x", 1)]
    found = fitted(spark, rows)
    assert {r["key"] for r in found.select("key").collect()} == {3, 4, 5}
    assert rows_of(similar.nearest(found, 2).select("key", "other", "score")) == [(3, 4, 1.0), (4, 3, 1.0)]
    assert similar.nearest(found.limit(0), 2).count() == 0
    with pytest.raises(ValueError, match="least"):
        similar.nearest(found, 2, least=0)


def test_a_list_hands_on_the_best_only(spark):
    # 600 different texts share a rare word, so that their list is split and no row may hand on all 599 others.
    rows = [(i, f"rare shared pair x{i}") for i in range(600)] + [(10_000 + i, f"other text {i} y{i}") for i in range(600)]
    got = similar.nearest(fitted(spark, rows), 2, least=0.1).filter("key < 10000").collect()
    assert len(got) == 1200 and {r["other"] for r in got} <= set(range(3))


def test_vote_and_its_ties(spark):
    near = spark.createDataFrame([(1, 1, 10, 0.5), (1, 2, 11, 0.9), (2, 1, 10, 0.5), (2, 2, 11, 0.5), (3, 1, 12, 0.7), (4, 1, 10, 0.4), (4, 2, 13, 0.1), (4, 3, 11, 0.9)], "key long, rank int, other long, score double")
    labels = spark.createDataFrame([(10, 0), (11, 1), (12, None), (13, 0)], "key long, good int")
    assert rows_of(similar.vote(near, labels, "good")) == [(1, 1, 1), (2, 0, 1), (4, 0, 2)]


def some_tickets(seed, n):
    r = random.Random(seed)
    rows = [(i, r.choice(["a", "a", "a", "b", "c", None])) for i in range(n)] + [(None, "a")]
    known = [(r.randrange(n), r.randrange(n)) for _ in range(n // 4)]
    return rows, known + [(y, x) for x, y in known[:3]] + [(1, 1), (2, 99_999), (None, 3)]


def labelled(spark, rows, known, **options):
    tickets = spark.createDataFrame([(k, c, "a", 0) for k, c in rows], "id long, client string, block string, place int").repartition(4)
    return pairs.labelled_pairs(tickets, spark.createDataFrame(known, "a long, b long"), key="id", block="client", **options)


@pytest.mark.parametrize("ratio", [0, 1, 3])
def test_every_known_pair_and_an_exact_number_of_others(spark, monkeypatch, ratio):
    monkeypatch.setattr(pairs, "_PART", 8)
    rows, known = some_tickets(ratio, 120)
    client = {k: c for k, c in rows if k is not None and c}
    want = {(min(x), max(x)) for x in known if None not in x and x[0] != x[1] and set(x) <= client.keys()}
    got = [tuple(r) for r in labelled(spark, rows, known, ratio=ratio, salt="s").collect()]
    assert {r[:2] for r in got if r[3] == 1} == want and len({r[:2] for r in got}) == len(got)
    per_block = Counter(client[a] for a, _ in want)
    assert Counter(r[2] for r in got if r[3] == 0) == Counter({c: ratio * n for c, n in per_block.items() if ratio})
    assert all(a < b and client[a] == client[b] == c for a, b, c, label in got if label == 0)
    again = labelled(spark, rows[::-1], known[::-1], ratio=ratio, salt="s")
    assert sorted(tuple(r) for r in again.collect()) == sorted(got)


def test_a_small_block_gives_all_its_pairs(spark):
    got = labelled(spark, [(i, "a") for i in range(6)], [(0, 1), (2, 3)], ratio=50).collect()
    assert len(got) == 15 and sum(r["label"] for r in got) == 2
    assert labelled(spark, [(1, "a")], [(0, 1)]).count() == 0


def test_the_norm_of_a_long_text_is_worked_out_once(spark):
    # Once for each of 30,000 different words took minutes.
    n = 30_000
    counts = spark.range(n).selectExpr("1L as key", "concat('w', id) as term", "1L as n").localCheckpoint()
    begun = time.monotonic()
    vector = terms.vectors(counts, terms.fit(counts)).first()["vector"]
    assert len(vector) == n and vector[0]["weight"] == pytest.approx(n**-0.5)
    assert time.monotonic() - begun < 30


def test_blocks_meet_in_a_product_without_a_shuffle(spark):
    # 40 texts share 30 words; every one of these used to carry the vectors of all texts through a shuffle.
    rows = [(i, " ".join(f"w{j}" for j in range(30)) + f" x{i}") for i in range(40)]
    spelled = fitted(spark, rows).select(F.col("key").alias("id"), (F.col("key") < 15).alias("asks"), (F.col("key") >= 15).alias("answers"), F.transform("vector", lambda t: F.xxhash64(t.term)).alias("terms"), F.transform("vector", lambda t: t.weight).alias("weights"))
    blocks = similar._written(spelled.coalesce(1).sortWithinPartitions("asks", "answers", "id").mapInArrow(similar._packing(10, 10_000), similar._PACKED))
    met = similar._pairs_of_blocks(blocks, 2)
    assert met.count() == 2 * 3
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
