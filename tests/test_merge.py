"""The keyed merge against a row-by-row fold."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from guichet.operators import merge as M
from guichet.schema import CLEAN, STORED

DAY = datetime(2025, 1, 1)
BATCH = T.StructType([T.StructField("seq", T.LongType())] + CLEAN.fields)


def ticket(key, seq, rng):
    maybe = lambda v: None if rng.random() < 0.4 else v
    dates = [maybe(DAY + timedelta(days=rng.randint(0, 99))) for _ in range(3)]
    return (seq, key, f"s{seq}", f"d{seq}", f"t{seq}", maybe(f"p{seq}"), maybe(f"c{seq}"), maybe(f"hmac_sha256:{seq}"), *dates)


def one_by_one(existing, batch, stamp):
    table = {r[0]: list(r) for r in existing}
    inserted = set()
    for row in sorted(batch):
        key, values = row[1], list(row[1:])
        if key not in table:
            table[key] = values + [stamp]
            inserted.add(key)
            continue
        old = table[key]
        old[4:7] = values[4:7]
        old[7:10] = [n if n is not None else o for n, o in zip(values[7:10], old[7:10], strict=True)]
    return sorted(tuple(r) + (k in inserted,) for k, r in table.items())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_equals_row_by_row(spark, seed):
    rng = random.Random(seed)
    existing = [tuple(ticket(f"k{i}", 1000 + i, rng)[1:]) + (DAY - timedelta(days=i),) for i in range(30)]
    keys = ["hot"] * 70 + [f"k{rng.randint(0, 60)}" for _ in range(130)]
    batch = [ticket(k, s, rng) for s, k in enumerate(keys)]
    rng.shuffle(batch)
    table, rows = spark.createDataFrame(existing, STORED), spark.createDataFrame(batch, BATCH).repartition(5)
    got = sorted(tuple(r) for r in M.merge(table, rows, DAY).collect())
    want = one_by_one(existing, batch, DAY)
    assert got == want
    counts = M.classify(table, rows).first()
    assert tuple(counts) == (200, sum(r[-1] for r in want), 200 - sum(r[-1] for r in want))


def test_literal_rules(spark):
    rows = [
        (1, "a", "first", "x", "open", "high", None, None, DAY, None, None),
        (2, "a", "second", "y", "closed", None, "net", None, None, DAY, None),
    ]
    empty = spark.createDataFrame([], STORED)
    out = M.merge(empty, spark.createDataFrame(rows, BATCH), DAY).collect()
    assert [tuple(r) for r in out] == [("a", "first", "x", "open", None, "net", None, DAY, DAY, None, DAY, True)]
    assert tuple(M.classify(empty, spark.createDataFrame(rows, BATCH)).first()) == (2, 1, 1)
    assert tuple(M.classify(empty, spark.createDataFrame([], BATCH)).first()) == (0, 0, 0)


def test_only_clean_tickets(spark):
    bad = spark.createDataFrame([(1, "k", "{}")], "seq long, external_ticket_id string, payload string")
    with pytest.raises(TypeError, match="must have exactly"):
        M.merge(spark.createDataFrame([], STORED), bad, DAY)


def test_table_of_batches_equals_row_by_row(spark, tmp_path):
    from guichet.sources import table

    rng, root = random.Random(5), str(tmp_path)
    history, stamps = [], {}
    for n in range(6):
        batch = [ticket(f"k{rng.randint(0, 25 + 5 * n)}", n * 100 + s, rng) for s in range(40 if n % 2 else 4)]
        stamp = DAY + timedelta(hours=n)
        before = set(stamps)
        stamps |= {r[1]: stamps.get(r[1], stamp) for r in batch}
        inserted = table.save_batch(spark.createDataFrame(batch, BATCH).repartition(3), root, stamp, buckets=5)
        assert inserted == len(set(stamps) - before)
        history += batch
        want = [r[:-2] + (stamps[r[0]],) for r in one_by_one([], history, DAY)]
        assert sorted(tuple(r) for r in table.current(spark, root).collect()) == want
        assert sorted(r[0] for r in table.current_changes(spark, root).collect()) == sorted(stamps)
    table.compact(spark, root)
    assert not table.compact(spark, root)
    assert sorted(tuple(r) for r in table.current(spark, root).collect()) == want
    assert len(list((tmp_path / "buckets=00005" / "changes").iterdir())) == 1
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_stored_texts_never_move(spark, tmp_path, monkeypatch):
    """No exchange in a read, and none above the stored side when a batch looks up its keys; only touched buckets are read."""
    from pyspark.sql import functions as F

    from guichet.sources import table

    rng, root = random.Random(9), str(tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in range(2):
            table.save_batch(spark.createDataFrame([ticket(f"k{i}", n * 1000 + i, rng) for i in range(400)], BATCH), root, DAY, buckets=4, compact_at=99)
        read = table.current(spark, root)
        read.collect()
        assert "Exchange" not in read._jdf.queryExecution().executedPlan().toString()
        layout = table._Layout(spark, root, 4)
        texts = sum(1 for _ in (tmp_path / "buckets=00004" / "texts").rglob("*.parquet"))
        assert texts == 4
        one = spark.createDataFrame([("k1",)], "external_ticket_id string")
        part = one.select(layout.part()).first()[0]
        known = layout.read(layout.texts, table._TEXTS).filter(F.col("part").isin([part])).select(table.KEY)
        plan = one.repartition(4, table.KEY).join(known, table.KEY, "left_anti")
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in text and "PartitionFilters" in text and "summary" not in text
        assert len(known.inputFiles()) == 4 and known.select(F.input_file_name()).distinct().count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_unfinished_batch_is_out_of_sight(spark, tmp_path, monkeypatch):
    from guichet.sources import storage, table

    rng, root = random.Random(7), str(tmp_path)
    first, second = ([ticket(f"k{i}", s + i, rng) for i in range(n)] for s, n in ((0, 5), (100, 9)))
    table.save_batch(spark.createDataFrame(first, BATCH), root, DAY)
    before = sorted(tuple(r) for r in table.current(spark, root).collect())
    move = storage.move

    def fails(spark, source, target):
        if "/changes/" in target:
            raise OSError("lost")
        move(spark, source, target)

    monkeypatch.setattr(storage, "move", fails)
    with pytest.raises(OSError):
        table.save_batch(spark.createDataFrame(second, BATCH), root, DAY)
    monkeypatch.setattr(storage, "move", move)
    assert sorted(tuple(r) for r in table.current(spark, root).collect()) == before
    assert table.save_batch(spark.createDataFrame(second, BATCH), root, DAY) == 4
    assert table.current(spark, root).count() == 9


def test_folding_is_one_exchange_without_texts(spark):
    rng = random.Random(1)
    batch = spark.createDataFrame([ticket(f"k{i % 9}", i, rng) for i in range(40)], BATCH)
    plan = M.fold_changes(batch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert "details" not in plan.split("Exchange hashpartitioning")[0]
