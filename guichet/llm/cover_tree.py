"""Exact top-k search by inner product with cover trees over queries and data at a time.

A node covers its points within a radius of its centre. For a query node and a data node
no inner product exceeds ``c_q.c_d + r_q|c_d| + r_d|c_q| + r_q r_d``. A pair of nodes whose
bound is below the worst k-th score of the query node's queries is pruned with all beneath.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from guichet.llm.store import written
from guichet.llm.vectors import matrix, usable

_DATA_LEAF, _QUERY_LEAF = 48, 4


class CoverTree:
    """Points in tree order; nodes with centre, radius, point range and child range.

    Below a node of scale s, children are points more than s/2 apart that cover the node's
    points within s/2, each point going to the nearest one. A node of at most ``leaf`` points
    has no children.
    """

    def __init__(self, points: np.ndarray, leaf: int = _DATA_LEAF) -> None:
        order, nodes, todo = np.arange(len(points)), [], []
        centre = points.mean(0).round() if len(points) else np.zeros(points.shape[1])
        nodes.append([centre, 0, len(points), 0, 0])
        scale = float(np.sqrt(((points - centre) ** 2).sum(1).max())) if len(points) else 0.0
        todo.append((0, scale))
        radii = [scale]
        for node, scale in todo:  # grows while it is read
            _, begin, end, _, _ = nodes[node]
            if end - begin <= leaf or radii[node] == 0:
                continue
            own = order[begin:end]
            local = points[own]
            half = min(scale, radii[node]) / 2
            centres, nearest = self._covering(local, half)
            while len(centres) == 1 and half > 0:
                half /= 2
                centres, nearest = self._covering(local, half)
            by_child = np.argsort(nearest, kind="stable")
            order[begin:end] = own[by_child]
            sizes = np.bincount(nearest, minlength=len(centres))
            nodes[node][3], nodes[node][4] = len(nodes), len(nodes) + len(centres)
            at = begin
            for c, size in zip(centres, sizes, strict=True):
                inside = points[order[at : at + size]]
                nodes.append([local[c], at, at + int(size), 0, 0])
                radii.append(float(np.sqrt(((inside - local[c]) ** 2).sum(1).max())))
                todo.append((len(nodes) - 1, half))
                at += int(size)
        self.order, self.points = order, points[order]
        self.centres = np.array([n[0] for n in nodes], float)
        self.ranges = np.array([n[1:] for n in nodes], int).reshape(-1, 4)
        # Rounded up, so that a bound is never below what it bounds.
        self.radii = np.array(radii) * (1 + 1e-9) + 1e-6
        self.norms = np.linalg.norm(self.centres, axis=1) * (1 + 1e-9)

    @staticmethod
    def _covering(points: np.ndarray, reach: float) -> tuple[list[int], np.ndarray]:
        best, nearest, centres = np.full(len(points), np.inf), np.zeros(len(points), int), []
        squares = (points**2).sum(1)
        next_one = 0
        while True:
            distance = squares + squares[next_one] - 2 * (points @ points[next_one])
            closer = distance < best
            closer[next_one] = True
            best[closer], nearest[closer] = distance[closer], len(centres)
            best[next_one] = 0
            centres.append(next_one)
            far = int(best.argmax())
            if best[far] <= reach * reach:
                return centres, nearest
            next_one = far

    def leaf(self, node: int) -> bool:
        return self.ranges[node, 2] == self.ranges[node, 3]


class Best:
    """The k best (score, smaller identifier first) of each query, and the score below which nothing enters."""

    def __init__(self, queries: int, k: int, least: np.ndarray) -> None:
        self.scores = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)
        self.least = least.copy()

    def worst(self, begin: int, end: int) -> float:
        return float(self.least[begin:end].min())

    def offer(self, begin: int, end: int, scores: np.ndarray, ids: np.ndarray) -> None:
        rows = np.flatnonzero((scores >= self.least[begin:end, None]).any(1))
        k = self.scores.shape[1]
        for r in rows:
            q = begin + r
            fits = np.flatnonzero(scores[r] >= self.least[q])
            s, v = np.concatenate([self.scores[q], scores[r, fits]]), np.concatenate([self.ids[q], ids[fits]])
            top = np.lexsort((v, -s))[:k]
            self.scores[q], self.ids[q] = s[top], v[top]
            self.least[q] = max(self.least[q], self.scores[q, -1])


def search(queries: CoverTree, query_ids: np.ndarray, data: CoverTree, data_ids: np.ndarray, k: int, least: np.ndarray) -> Best:
    """Dual-tree search; identifiers and ``least`` (a score each query's k best are known to reach) in tree order."""
    best = Best(len(query_ids), k, least)

    def bounds(q: int, nodes: np.ndarray) -> np.ndarray:
        product = data.centres[nodes] @ queries.centres[q]
        rq, rd = queries.radii[q], data.radii[nodes]
        return product + rq * data.norms[nodes] + rd * queries.norms[q] + rq * rd + 1e-3

    stack = [(0, np.array([0]))] if len(query_ids) and len(data_ids) else []
    while stack:
        q, nodes = stack.pop()
        begin, end, first, last = queries.ranges[q]
        bound = bounds(q, nodes)
        order = np.argsort(-bound)
        nodes = nodes[order][bound[order] >= best.worst(begin, end)]
        if not len(nodes):
            continue
        inner = nodes[data.ranges[nodes, 2] != data.ranges[nodes, 3]]
        leaves = nodes[data.ranges[nodes, 2] == data.ranges[nodes, 3]]
        if len(inner):
            children = np.concatenate([np.arange(*data.ranges[n, 2:]) for n in inner])
            below = np.concatenate([leaves, children])
            if queries.leaf(q):
                stack.append((q, below))
            else:
                stack += [(c, below) for c in range(first, last)]
        elif not queries.leaf(q):
            stack += [(c, leaves) for c in range(first, last)]
        else:
            own = queries.points[begin:end]
            for at in range(0, len(leaves), 16):
                part = leaves[at : at + 16]
                part = part[bounds(q, part) >= best.worst(begin, end)]
                if not len(part):
                    continue
                rows = np.concatenate([np.arange(*data.ranges[n, :2]) for n in part])
                scores = own @ data.points[rows].T
                scores[query_ids[begin:end, None] == data_ids[rows][None, :]] = -np.inf
                best.offer(begin, end, scores, data_ids[rows])
    return best


def _stored(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _tree(ids: np.ndarray, points: np.ndarray, leaf: int, **more: np.ndarray) -> bytes:
    order = np.argsort(ids, kind="stable")
    ids, points = ids[order], points[order]
    tree = CoverTree(points, leaf)
    low = {n: v[order][tree.order] for n, v in more.items()}
    return _stored(ids=ids[tree.order], points=tree.points, centres=tree.centres, ranges=tree.ranges, radii=tree.radii, norms=tree.norms, **low)


def _loaded(stored: bytes) -> tuple[CoverTree, dict[str, np.ndarray]]:
    arrays = dict(np.load(io.BytesIO(stored)))
    tree = CoverTree.__new__(CoverTree)
    for name in ("points", "centres", "ranges", "radii", "norms"):
        setattr(tree, name, arrays[name])
    return tree, arrays


def top_k(
    vectors: DataFrame,
    is_query,
    *,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    data_block: int = 4096,
    query_block: int = 1024,
    first_look: int = 2048,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row that ``is_query`` selects.

    Components count as floor(scale * x); the score is the integer inner product, ties go to
    the smaller identifier, and a query with fewer than k others gets them all. A tree is
    built per block of data and per block of queries, and each pair of blocks is searched by
    itself. A sample of ``first_look`` rows gives every query a score its k best reach at
    least, before any block is read.

    Null, empty or non-finite vectors and rows without an identifier take no part. Vectors of
    different lengths are not compared. Repeated rows are candidates as often as they occur,
    except a query's own identifier.
    """
    spark = vectors.sparkSession
    column = F.col(f"`{vector}`")
    rows = vectors.filter(usable(column) & F.col(f"`{key}`").isNotNull())
    rows = rows.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"),
        F.transform(column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"),
        is_query.alias("asks"),
    ).withColumn("n", F.size("v"))
    rows = written(rows)
    counts = rows.groupBy("n").agg(F.count(F.lit(1)).alias("data"), F.sum(F.col("asks").cast("long")).alias("queries"))
    counts = counts.select("n", F.ceil(F.col("data") / data_block).alias("data_blocks"), F.ceil(F.col("queries") / query_block).alias("query_blocks"))
    dealt = rows.join(counts, "n")

    hashed = F.xxhash64("vec_id", F.lit(1))
    seen = rows.withColumn("h", hashed).orderBy("h", "vec_id").limit(first_look).select("vec_id", "n", "v").toArrow()
    held = spark.sparkContext.broadcast((seen["vec_id"].to_numpy(), seen["n"].to_numpy(), [np.array(x, float) for x in seen["v"].to_pylist()]))

    def grow(block: pa.Table) -> pa.Table:
        tree = _tree(block["vec_id"].to_numpy(), matrix(block["v"]), _DATA_LEAF)
        return pa.table([block["n"][:1], block["block"][:1], pa.array([tree], pa.binary())], ["n", "block", "tree"])

    def grow_queries(block: pa.Table) -> pa.Table:
        ids, points, n = block["vec_id"].to_numpy(), matrix(block["v"]), block["n"][0].as_py()
        known, lengths, sample = held.value
        pick = np.flatnonzero(lengths == n)
        least = np.full(len(ids), -np.inf)
        if len(pick) > k:
            scores = points @ np.array([sample[i] for i in pick]).T
            scores[ids[:, None] == known[pick][None, :]] = -np.inf
            least = np.sort(scores, axis=1)[:, -k]
        tree = _tree(ids, points, _QUERY_LEAF, least=least)
        return pa.table([block["n"][:1], block["block"][:1], pa.array([tree], pa.binary())], ["n", "block", "tree"])

    def block_of(blocks: str):
        return F.pmod(F.xxhash64("vec_id"), F.greatest(F.col(blocks), F.lit(1))).cast("int").alias("block")

    stored = "n int, block int, tree binary"
    data = dealt.select("n", "vec_id", "v", block_of("data_blocks"), "data_blocks", "query_blocks")
    data = written(data.select("n", "block", "vec_id", "v").groupBy("n", "block").applyInArrow(grow, stored))
    asked = dealt.filter("asks").dropDuplicates(["vec_id", "v"])
    asked = written(asked.select("n", block_of("query_blocks"), "vec_id", "v").groupBy("n", "block").applyInArrow(grow_queries, stored))
    data = data.join(counts, "n").filter("query_blocks > 0")
    data = data.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks").cast("int") - 1)))
    data = data.select("n", F.col("block").alias("data_block"), "query_block", F.col("tree").alias("data"))
    asked = asked.join(counts, "n").withColumn("data_block", F.explode(F.sequence(F.lit(0), F.col("data_blocks").cast("int") - 1)))
    asked = asked.select("n", "data_block", F.col("block").alias("query_block"), F.col("tree").alias("queries"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, q in zip(batch["data"], batch["queries"], strict=True):
                data_tree, of_data = _loaded(d.as_py())
                query_tree, of_queries = _loaded(q.as_py())
                best = search(query_tree, of_queries["ids"], data_tree, of_data["ids"], k, of_queries["least"])
                found = np.isfinite(best.scores)
                ids = np.repeat(of_queries["ids"], found.sum(1))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(best.ids[found], pa.int64()), pa.array(best.scores[found].astype(np.int64))], ["query_id", "vec_id", "score"])

    pairs = data.join(asked, ["n", "data_block", "query_block"]).select("data", "queries")
    found = pairs.mapInArrow(run, "query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
