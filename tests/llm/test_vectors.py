import numpy as np
import pytest
from pyspark.sql import functions as F

from guichet.llm import cover_tree, embedding_dedup

SCHEMA = "vec_id long, embedding array<float>"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], SCHEMA)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


def best_by_brute_force(rows, every, k):
    points = {i: np.floor(256 * np.array(v, np.float32).astype(float)) for i, v in rows if usable(v)}
    out = []
    for q in sorted(points):
        if q % every == 0:
            scores = sorted((-float(points[q] @ p), i) for i, p in points.items() if i != q and len(p) == len(points[q]))
            out += [(q, r + 1, i, int(-s)) for r, (s, i) in enumerate(scores[:k])]
    return out


def clustered(seed, n, dims=16):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(8, dims))
    x = centres[r.integers(0, 8, n)] + r.normal(size=(n, dims)) * r.choice([0.05, 0.3, 1.0], n)[:, None]
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[n // 2 : n // 2 + n // 10] = x[0]
    return list(zip(r.permutation(n).tolist(), x.astype(np.float32).tolist(), strict=True))


@pytest.mark.parametrize(("seed", "n", "blocks"), [(1, 400, (64, 4)), (2, 900, (4096, 1024)), (3, 6, (4096, 1024))])
def test_top_k_is_exact(spark, seed, n, blocks):
    rows = clustered(seed, n)
    found = cover_tree.top_k(frame(spark, rows).repartition(3), F.col("vec_id") % 5 == 0, data_block=blocks[0], query_block=blocks[1], first_look=50)
    assert sorted(map(tuple, found.collect())) == best_by_brute_force(rows, 5, 5)


def test_the_bound_prunes_and_covers():
    r = np.random.default_rng(5)
    points = np.floor(256 * np.concatenate([c + r.normal(size=(300, 8)) * 0.02 for c in np.eye(8)]))
    tree = cover_tree.CoverTree(points)
    assert sorted(tree.order) == list(range(2400))
    for (begin, end, first, last), centre, radius in zip(tree.ranges, tree.centres, tree.radii, strict=True):
        assert (np.linalg.norm(tree.points[begin:end] - centre, axis=1) <= radius).all()
        if last > first:
            assert sorted(tree.ranges[first:last, 0])[0] == begin and max(tree.ranges[first:last, 1]) == end
    looked = []
    offer = cover_tree.Best.offer

    class Counting(cover_tree.Best):
        def offer(self, begin, end, scores, ids):
            looked.append(scores.size)
            offer(self, begin, end, scores, ids)

    cover_tree.Best, kept = Counting, cover_tree.Best
    try:
        queries = cover_tree.CoverTree(points[::50], 4)
        best = cover_tree.search(queries, np.arange(48)[queries.order] + 10**6, tree, tree.order, 5, np.full(48, -np.inf))
    finally:
        cover_tree.Best = kept
    scores = -np.sort(-(queries.points @ points.T), axis=1)[:, :5]
    assert (best.scores == scores).all()
    assert sum(looked) < 0.2 * 48 * 2400


def odd_vectors(spark):
    rows = [(0, [1, 0, 0.5]), (5, None), (10, []), (15, [0, 0, 0]), (20, [1, None, 0]), (25, [float("nan"), 1, 1]), (30, [float("inf"), 1, 1])]
    rows += [(35, [1, 0, 0.5]), (36, [2, 0, 1]), (37, [-1, 0, -0.5]), (40, [0.3, 0.1]), (41, [0.3, 0.1]), (42, [1e30, 1, 1])]
    return rows, frame(spark, [*rows, (None, [1, 0, 0.5])]).withColumn("v", F.lit(1)).withColumn("score", F.lit("x")).withColumn("h", F.lit("x"))


def test_top_k_of_odd_rows(spark):
    rows, df = odd_vectors(spark)
    rows = [(i, v) for i, v in rows if i != 42]
    found = cover_tree.top_k(df.filter("vec_id is null or vec_id != 42"), F.col("vec_id") % 5 == 0)
    assert sorted(map(tuple, found.collect())) == best_by_brute_force(rows, 5, 5)
    assert cover_tree.top_k(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    assert cover_tree.top_k(df, F.lit(False)).count() == 0


def links_by_brute_force(rows, cosine):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if usable(v) and any(v)]
    links = {i: set() for i, _ in rows}
    for a, (i, x) in enumerate(good):
        for j, y in good[a + 1 :]:
            if len(x) == len(y) and x @ y >= cosine * (np.linalg.norm(x) * np.linalg.norm(y)):
                links[i].add(j)
                links[j].add(i)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = (len(links[i]), min(seen), min(seen) == i)
    return out


def near_vectors(seed, n, dims, cosines):
    """Random directions, each with partners at given cosines, and one large group."""
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for i in range(0, n // 2, 2):
        other = r.normal(size=dims)
        other -= (other @ x[i]) * x[i]
        c = r.choice(cosines)
        x[i + 1] = c * x[i] + (1 - c * c) ** 0.5 * other / np.linalg.norm(other)
    group = x[-1] + r.normal(size=(n // 4, dims)) * 0.02
    x[-len(group) - 1 : -1] = group
    return list(enumerate((x * r.uniform(0.5, 2, n)[:, None]).astype(np.float32).tolist()))


def test_links_found_are_links_and_few_are_missed(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "_BLOCK", 100)
    rows = near_vectors(3, 3000, 64, [0.88, 0.91, 0.93, 0.97, 0.999])
    want = links_by_brute_force(rows, 0.9)
    found = {r[0]: tuple(r)[1:] for r in embedding_dedup.near_duplicates(frame(spark, rows).repartition(4)).collect()}
    assert found.keys() == want.keys()
    assert all(found[i][0] <= want[i][0] for i in want)
    assert sum(f[0] for f in found.values()) >= 0.98 * sum(w[0] for w in want.values())
    pairs = [i for i in range(1500) if want[i][0]]
    assert sum(found[i] == want[i] for i in pairs) >= 0.97 * len(pairs)
    group = [i for i in want if want[i][0] > 100]
    assert len(group) > 700 and all(found[i] == want[i] for i in group)


def test_copies_count_as_links(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(50, 150)] + [(i, [1.0, 2.0, 3.0 + i / 1000]) for i in range(10)] + [(200, [-1.0, 0.0, 0.0])]
    found = {r[0]: tuple(r)[1:] for r in embedding_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert found == links_by_brute_force(rows, 0.9)


def test_links_of_odd_rows(spark):
    rows, df = odd_vectors(spark)
    found = sorted((tuple(r) for r in embedding_dedup.near_duplicates(df).collect()), key=repr)
    want = sorted([(i, *w) for i, w in links_by_brute_force(rows, 0.9).items()] + [(None, 0, None, True)], key=repr)
    assert found == want
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    assert embedding_dedup.near_duplicates(df.filter("vec_id in (5, 15)")).count() == 2


def test_vectors_that_share_an_identifier(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [0.0, 1.0, 0.01]), (0, [0.0, 0.0, 1.0]), (0, [0.0, 1.0, 0.02])]
    found = sorted(tuple(r) for r in embedding_dedup.near_duplicates(frame(spark, rows).repartition(3)).collect())
    assert found == [(0, 0, 0, True), (0, 2, 0, True), (1, 1, 1, True), (1, 2, 0, False), (2, 1, 1, False), (3, 2, 0, False)]
