import random

import numpy as np
import pytest

from guichet.llm import minhash
from guichet.llm.components import components
from tests.llm.conftest import texts


def shingles(text, k=5):
    words = text.encode().lower().split() if text else []
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def brute_force(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def near(seed, n, edits):
    """Copies of a few texts with some words replaced, around the threshold."""
    r, out = random.Random(seed), []
    bases = texts(seed, 6, words=200, vocabulary=2000)
    for _ in range(n):
        words = r.choice(bases).split()
        for _ in range(r.randint(0, edits)):
            words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("seed", "n", "edits", "percent"), [(1, 120, 6, 85), (2, 120, 3, 80), (3, 60, 1, 90)])
def test_same_as_brute_force(spark, seed, n, edits, percent):
    rows = list(enumerate(near(seed, n, edits) + texts(seed + 50, 40)))
    random.Random(seed).shuffle(rows)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), percent=percent)
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == brute_force(rows, percent)


def test_buckets_without_a_common_neighbour(spark, monkeypatch):
    """Members that are not linked to the smallest one of their bucket, but to each other, in several blocks."""
    monkeypatch.setattr(minhash, "_BLOCK", 4)
    monkeypatch.setattr(minhash, "_BLOCK_SHINGLES", 600)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 25):
        changed = list(base)
        for k in range(0, 120, 12):
            changed[k] = f"x{i // 2}_{k}"
        rows.append((i, " ".join(changed)))
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=85, missed=1e-12)
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == brute_force(rows, 85)


def test_signature_estimates_with_little_variance():
    r, share = np.random.default_rng(0), []
    for _ in range(200):
        values = r.integers(0, 2**63, 300).astype(np.uint64)
        one, two = (minhash.signatures([np.unique(v)], 96)[0] for v in (values[:250], values[50:]))
        share.append((one == two).mean())
    assert abs(np.mean(share) - 2 / 3) < 0.01
    assert np.std(share) < (2 / 9 / 96) ** 0.5


@pytest.mark.parametrize("n", [1, 2, 7, 95, 5000])
def test_signature_fills_every_slot_and_ignores_order(n):
    values = np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64)
    signature = minhash.signatures([values, values[::-1]], 96)
    assert (signature[0] == signature[1]).all()
    assert (signature < np.iinfo(np.int64).max).all()


def test_odd_rows(odd_docs, no_docs):
    found = sorted(map(tuple, minhash.near_duplicates(odd_docs).collect()), key=repr)
    by_id = {}
    for r in found:
        by_id.setdefault(r[0], []).append(r[1:])
    assert by_id[1] == [(0, 1, True)] and by_id[2] == [(0, 2, True)] and by_id[3] == [(0, 3, True)]
    assert by_id[6] == [(13, 5, False)] * 2 and by_id[5] == [(13, 5, True)]
    assert by_id[8][0][1:] == (7, False)
    assert by_id[None] == [(13, None, True)]
    assert len(found) == odd_docs.count()
    assert minhash.near_duplicates(no_docs).count() == 0


def test_components(spark):
    r = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, 500 + i) for i in range(1, 80)]
    r.shuffle(chain)
    links = spark.createDataFrame([*chain, *star, (7, 7), (None, 3), (160, 90), (90, 300)], "a long, b long")
    found = dict(map(tuple, components(links).collect()))
    assert {found[i] for i in range(100, 161)} == {90} and found[300] == 90
    assert {found[i] for i in range(500, 580)} == {500}
    assert set(found) == {90, 300, *range(100, 161), *range(500, 580)}
    assert components(links.limit(0)).count() == 0
