import random
import zlib
from collections import Counter, defaultdict

import pytest

from guichet.llm import sharding
from tests.llm.conftest import texts


def plain_best_fit(sizes, capacity):
    bins, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        open_bins = [(free, b) for b, free in enumerate(bins) if free >= sizes[i]]
        if open_bins:
            b = min(open_bins)[1]
        else:
            bins.append(max(capacity, sizes[i]))
            b = len(bins) - 1
        bins[b] -= sizes[i]
        out[i] = b
    return out, len(bins)


@pytest.mark.parametrize("seed", range(6))
def test_tree_finds_the_tightest_bin(seed, monkeypatch):
    monkeypatch.setattr(sharding, "_LEAF", 4)
    r = random.Random(seed)
    sizes = [r.choice([r.randint(1, 100), r.randint(60, 130), 7]) for _ in range(300)]
    assert sharding.best_fit_decreasing(sizes, 100) == plain_best_fit(sizes, 100)


def test_spread_is_even_and_isolates_giants():
    r = random.Random(1)
    sizes = [r.randint(1, 1000) for _ in range(5000)]
    fill = Counter()
    for b, s in zip(sharding.spread(sizes, 24), sizes, strict=True):
        fill[b] += s
    assert max(fill.values()) <= 1.001 * sum(sizes) / 24 and min(fill.values()) >= 0.99 * sum(sizes) / 24
    bins = sharding.spread([10**7, *sizes], 24)
    fill = Counter()
    for b, s in zip(bins, [10**7, *sizes], strict=True):
        fill[b] += s
    assert bins.count(bins[0]) == 1 and max(v for b, v in fill.items() if b != bins[0]) <= 1.01 * sum(sizes) / 23
    assert sharding.spread([], 3) == [] and sharding.spread([5], 3) == [0]


def check(rows, docs):
    size = lambda t: len((t or "").encode()) + 8
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((d, size(t), zlib.crc32((t or "").encode())) for d, t in docs)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    shard_of = defaultdict(set)
    by_doc = defaultdict(list)
    for d, t in docs:
        by_doc[d].append(t)
    for r in rows:
        if len(set(by_doc[r["doc_id"]])) == 1:
            shard_of[by_doc[r["doc_id"]][0]].add(r["shard"])
    assert all(len(s) == 1 for s in shard_of.values())
    fill = Counter()
    for r in rows:
        fill[r["shard"]] += r["size"]
    return fill


def test_balance(spark):
    found = texts(4, 3000, words=80)
    docs = list(enumerate(found + found[:200] + [found[0]] * 50 + [None, "", None]))
    fill = check(sharding.balance(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), 24).collect(), docs)
    assert sorted(fill) == list(range(24)) and max(fill.values()) <= 1.01 * min(fill.values())


def test_balance_with_one_huge_group(spark):
    docs = list(enumerate(["hot " * 50] * 1000 + texts(5, 1000, words=40)))
    fill = check(sharding.balance(spark.createDataFrame(docs, "doc_id long, text string"), 24).collect(), docs)
    rest = sorted(fill.values())[:-1]
    assert max(rest) <= 1.03 * min(rest)


def test_slots_over_several_buckets(spark):
    rows = spark.range(1000).selectExpr("id AS doc_id", "id % 7 AS text_crc32", "10L AS size", "cast(id % 3 AS int) AS shard")
    found = sharding._slotted(rows, 1000, 3, per_bucket=40).collect()
    for shard in range(3):
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(334 if shard == 0 else 333))


@pytest.mark.parametrize("per_cell", [2, 64])
def test_pack_to_capacity(spark, per_cell):
    docs = list(enumerate(texts(6, 2000, words=60) + ["big " * 3000]))
    capacity = 10_000
    rows = sharding.pack(spark.createDataFrame(docs, "doc_id long, text string"), capacity, shards_per_cell=per_cell, units_per_shard=20).collect()
    fill = check(rows, docs)
    assert sorted(fill) == list(range(len(fill)))
    giant = max(fill.values())
    assert giant == 12_008 and sum(v > capacity for v in fill.values()) == 1
    assert len(fill) <= 1.35 * sum(fill.values()) / capacity + 2


def test_odd_rows(odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    for found in (sharding.balance(odd_docs, 24), sharding.pack(odd_docs, 1000)):
        check(found.collect(), docs)
    assert sharding.balance(no_docs, 24).count() == 0 and sharding.pack(no_docs, 1000).count() == 0
