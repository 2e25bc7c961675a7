"""Redundant tickets against all pairs, and the rest of the labelled-ticket operators."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from guichet.operators import evaluation as E
from guichet.operators import lifecycle, redundancy

DAY = datetime(2025, 1, 1)


def all_pairs(rows, days, percent):
    sets = {r[0]: (r[1], r[3].date() if r[3] else None, frozenset("".join(c if c.isascii() and c.isalnum() else " " for c in (r[2] or "").lower()).split())) for r in rows}
    out = {}
    for b, (client, day, words) in sets.items():
        before = [
            (other_day, a)
            for a, (other, other_day, others) in sets.items()
            if client is not None and other == client and day and other_day and words and others and a != b
            and 0 <= (day - other_day).days <= days and (other_day, a) < (day, b)
            and 100 * len(words & others) >= percent * len(words | others)
        ]
        if before:
            out[b] = min(before)[1]
    return out


@pytest.mark.parametrize(("seed", "days", "percent"), [(1, 7, 80), (2, 3, 60), (3, 30, 90)])
def test_redundant_tickets_equal_all_pairs(spark, seed, days, percent):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    bases = [rng.sample(vocabulary, rng.randint(1, 12)) for _ in range(12)]
    rows = []
    for i in range(220):
        words = [w if rng.random() > 0.06 else rng.choice(vocabulary) for w in rng.choice(bases)]
        text = rng.choice([None, "", "!?"]) if rng.random() < 0.04 else rng.choice([" ", ", "]).join(words)
        client = rng.choice(["hot"] * 6 + ["a", "b", None])
        rows.append((f"t{i:03d}", client, text, None if rng.random() < 0.03 else DAY + timedelta(days=rng.randint(0, 40), hours=rng.randint(0, 23))))
    df = spark.createDataFrame(rows, "external_ticket_id string, client string, details string, ticket_created_at timestamp").repartition(3)
    found = redundancy.redundant_tickets(df, "client", days=days, percent=percent)
    assert {r[0]: r[1] for r in found.collect()} == all_pairs(rows, days, percent)
    assert redundancy.redundant_tickets(df.limit(0), "client").count() == 0


def test_duplicate_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("", 1), (None, 1), (None, 1)], "t string, n int")
    assert tuple(redundancy.duplicate_counts(df, "t", "n").first()) == (6, 4, 2, 2)
    assert tuple(redundancy.duplicate_counts(df, "t").first()) == (6, 3, 2, 3)
    assert tuple(redundancy.duplicate_counts(df.limit(0), "t").first()) == (0, 0, 0, 0)


def test_split_depends_on_the_key_alone(spark):
    df = spark.range(5000).selectExpr("id", "cast(null as string) as none")
    first = {r.id: r.split for r in E.with_split(df, "id").collect()}
    assert first == {r.id: r.split for r in E.with_split(df.repartition(7).orderBy("id"), "id").collect()}
    assert 0.67 < sum(s == "train" for s in first.values()) / 5000 < 0.73
    assert E.with_split(df, "none").filter("split is not null").count() == 0
    with pytest.raises(ValueError):
        E.with_split(df, "id", 100)


def test_labels(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1), (1, 1), (None, 1), (0, None)], "y int, p int")
    m = E.binary_metrics(df, "y", "p").first()
    assert tuple(m)[:4] == (2, 1, 1, 1) and m.accuracy == 0.6 and m.f1 == pytest.approx(2 / 3)
    assert tuple(E.binary_metrics(df.limit(0), "y", "p").first()) == (0, 0, 0, 0, 0, 0, 0, 0)
    assert {r.label: (r.row_count, r.to_largest) for r in E.class_balance(df, "y").collect()} == {1: (3, 1.0), 0: (3, 1.0), None: (1, 1 / 3)}
    assert [tuple(r) for r in E.missing_values(df, "y").collect()] == [("y", 1, 0, 1 / 7)]


def test_purge_rewrites_the_table(spark, tmp_path):
    rows = [("a", "i1", DAY.date()), ("b", "i1", None), ("c", "i2", DAY.date() + timedelta(days=9))]
    path, log = str(tmp_path / "rows"), str(tmp_path / "log")
    spark.createDataFrame(rows, "external_ticket_id string, import_batch_id string, data_retention_until date").write.parquet(path)
    due = DAY.date() + timedelta(days=1)
    assert lifecycle.purge_expired(spark, path, due, log) == 1
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == ["b", "c"]
    assert [r.records_deleted_count for r in spark.read.parquet(log).collect()] == [1]
    assert lifecycle.purge_expired(spark, path, due, log) == 0
    assert spark.read.parquet(log).count() == 1


def test_sets_that_share_a_few_rare_words_are_not_compared(spark):
    # A rare word in each of 200 texts, which share it and the next two but no more: every pair was compared before.
    rows = [(f"t{i:03d}", "a", " ".join(["rare", "pair", "here", *(f"x{i}w{j}" for j in range(30))]), DAY) for i in range(200)]
    rows += [(f"u{i}", "a", " ".join(["rare", *(f"y{j}" for j in range(20)), f"z{i}"]), DAY + timedelta(days=i)) for i in range(3)]
    df = spark.createDataFrame(rows, "external_ticket_id string, client string, details string, ticket_created_at timestamp")
    assert {r[0]: r[1] for r in redundancy.redundant_tickets(df, "client").collect()} == all_pairs(rows, 7, 80) == {"u1": "u0", "u2": "u0"}
    words = df.select(F.monotonically_increasing_id().alias("id"), "client", F.lit(0).alias("at"), redundancy.words(F.col("details")).alias("words"))
    assert redundancy._candidates(words.withColumn("size", F.size("words")), 7, 80).count() == 6


@pytest.mark.parametrize(("block", "cells", "frequent", "days", "percent"), [(4, 30, 2, 30, 60), (9, 1, 1, 3, 80), (5, 1 << 22, 1 << 16, 400, 100)])
def test_a_large_group_meets_in_pairs_of_blocks(spark, monkeypatch, block, cells, frequent, days, percent):
    for name, value in (("_BLOCK", block), ("_CELLS", cells), ("_FREQUENT", frequent)):
        monkeypatch.setattr(redundancy, name, value)
    rng = random.Random(block)
    bases = [[f"w{rng.randint(0, 60)}" for _ in range(rng.randint(1, 25))] for _ in range(6)]
    rows = []
    for i in range(90):
        words = [w if rng.random() > 0.04 else f"w{rng.randint(0, 60)}" for w in rng.choice(bases)]
        rows.append((f"t{i:03d}", rng.choice(["hot"] * 5 + ["a"]), " ".join(words), DAY + timedelta(days=rng.randint(0, 40))))
    df = spark.createDataFrame(rows, "external_ticket_id string, client string, details string, ticket_created_at timestamp").repartition(3)
    found = redundancy.redundant_tickets(df, "client", days=days, percent=percent)
    assert {r[0]: r[1] for r in found.collect()} == all_pairs(rows, days, percent)


def test_pairs_that_share_too_little_do_not_leave_a_task(spark):
    """200 texts share three rare words: each of their 19,900 pairs was shuffled with a count, twice."""
    rows = [(f"t{i:03d}", "a", " ".join(["rare", "pair", "here", *(f"x{i}w{j}" for j in range(30))]), DAY) for i in range(200)]
    df = spark.createDataFrame(rows, "external_ticket_id string, client string, details string, ticket_created_at timestamp")
    words = df.select(F.monotonically_increasing_id().alias("id"), "client", F.lit(0).alias("at"), redundancy.words(F.col("details")).alias("words"))
    found = redundancy._candidates(words.withColumn("size", F.size("words")), 7, 80)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 0 and "Join" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("tried", [1, 4])
def test_later_pairs_are_checked_only_for_want_of_earlier_ones(spark, monkeypatch, tried):
    monkeypatch.setattr(redundancy, "_TRIED", tried)
    checked, real = [], redundancy._checked
    monkeypatch.setattr(redundancy, "_checked", lambda pairs, sets, percent: checked.append(pairs.count()) or real(pairs, sets, percent))
    copies = [(f"c{i:02d}", "a", " ".join([*(f"w{j}" for j in range(30)), f"own{i}"]), DAY + timedelta(hours=i)) for i in range(20)]
    # Each shares its rare words with several earlier ones and is similar to the last of them only.
    chain = [(f"d{i:02d}", "b", " ".join(f"v{j}" for j in range(2 * i, 2 * i + 24)), DAY + timedelta(days=i)) for i in range(8)]
    df = spark.createDataFrame(copies + chain, "external_ticket_id string, client string, details string, ticket_created_at timestamp")
    found = redundancy.redundant_tickets(df, "client", days=30)
    assert {r[0]: r[1] for r in found.collect()} == all_pairs(copies + chain, 30, 80)
    assert checked[1] <= 28 < 190  # 190 pairs of copies are similar, and were all compared
