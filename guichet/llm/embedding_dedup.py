"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its nearest reference points in order. An inverted list per
reference point holds the vectors that have it in their description; vectors that meet in a
list and share enough points are candidates and are verified by their cosine. A pair belongs
to the list of the first point it shares, so that it counts once. Long lists are worked off
in blocks, and what leaves a block is a number of links and one label per vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guichet.llm.components import components
from guichet.llm.store import written
from guichet.llm.vectors import matrix, usable

_BLOCK = 1024


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1)[:, None]


def reference_points(vectors: DataFrame, points: int, apart: float, seed: int) -> np.ndarray:
    """At most ``points`` unit vectors, no two of them closer than ``apart``.

    Taken in turn from ``4 * points`` rows with the smallest hashes: a large group of near
    copies gives one point and not as many as its share.
    """
    hashed = F.xxhash64("vec_id", F.lit(seed))
    sample = vectors.select("vec_id", "embedding", hashed.alias("h")).orderBy("h", "vec_id", "embedding").limit(4 * points).toArrow()
    if not sample.num_rows:
        return np.zeros((0, 0))
    found = _unit(matrix(sample["embedding"]))
    kept: list[int] = []
    for i in range(len(found)):
        if len(kept) < points and (not kept or (found[kept] @ found[i]).max() < apart):
            kept.append(i)
    return found[kept]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of each vector's doubles, so that equal ones meet."""
    for batch in batches:
        if batch.num_rows:
            rows = matrix(batch["embedding"]) + 0.0
            digests = [xxhash.xxh3_128_digest(r.tobytes()) for r in rows]
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["embedding"], pa.array(digests, pa.binary())], ["vec_id", "embedding", "digest"])


def _lists(held, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            near = -(_unit(matrix(batch["embedding"])) @ points.T)
            order = np.argsort(near, axis=1, kind="stable")[:, :depth].astype(np.int32)
            described = pa.FixedSizeListArray.from_arrays(pa.array(order.ravel()), depth).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch["node"], batch["copies"], batch["embedding"], described], ["node", "copies", "embedding", "points"])

    return run


def _linked(a: np.ndarray, b: np.ndarray, rows: np.ndarray, norms: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    keep = np.zeros(len(a), bool)
    for at in range(0, len(a), 100_000):
        x, y = a[at : at + 100_000], b[at : at + 100_000]
        keep[at : at + 100_000] = np.einsum("ij,ij->i", rows[x], rows[y]) >= cosine * (norms[x] * norms[y])
    return a[keep], b[keep]


def _compare(share: int, cosine: float):
    def run(block: pa.Table) -> pa.Table:
        """Links among the vectors of one block pair of one list: links and label by vector."""
        point, i, j = (block[c][0].as_py() for c in ("point", "i", "j"))
        ids, copies, own = (block[c].to_numpy() for c in ("node", "copies", "own"))
        rows, described = matrix(block["embedding"]), matrix(block["points"]).astype(int)
        norms = np.linalg.norm(rows, axis=1)
        seen, column = np.unique(described, return_inverse=True)
        has = np.zeros((len(ids), len(seen)), np.float32)
        has[np.arange(len(ids))[:, None], column.reshape(described.shape)] = 1
        first = np.flatnonzero(own == i)
        second = first if i == j else np.flatnonzero(own == j)
        shared = has[first] @ has[second].T
        earlier = has[:, seen < point]
        candidate = (shared >= share) & (earlier[first] @ earlier[second].T == 0)
        if i == j:
            candidate = np.triu(candidate, 1)
        a, b = np.nonzero(candidate)
        a, b = _linked(first[a], second[b], rows, norms, cosine)
        links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
        label = ids.copy()
        while len(a):
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            if (before == label).all():
                break
        any_link = np.flatnonzero(links)
        return pa.table([pa.array(ids[any_link], pa.int64()), pa.array(links[any_link].astype(int), pa.int64()), pa.array(label[any_link], pa.int64())], ["node", "links", "label"])

    return run


def near_duplicates(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    cosine: float = 0.9,
    rows_per_point: int = 50,
    most_points: int = 1024,
    depth: int = 8,
    share: int = 2,
    apart: float = 0.7,
    seed: int = 0,
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors with a cosine of at least ``cosine`` are linked if their ``depth`` nearest
    reference points have ``share`` in common; at 0.9 that finds over 98 in 100 such pairs of
    random directions, and more of the closer ones. There is a reference point per
    ``rows_per_point`` different vectors, ``most_points`` at most, from a sample four times as
    large; all vectors are indexed. n_links counts other vectors linked directly, equal ones
    among them; component_id is the smallest identifier that links reach.

    Null and empty vectors, zero vectors, and vectors with null or non-finite components link
    with nothing, nor do vectors of different lengths. Results belong to rows: those that share
    an identifier are vectors of their own, copies of each other if they are equal. A null
    identifier has no component and is kept. An empty table gives no rows; other columns are
    not looked at.
    """
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("embedding"))
    nonzero = F.exists("embedding", lambda x: x != 0)
    good_row = F.coalesce(usable(F.col("embedding")) & nonzero & F.col("vec_id").isNotNull(), F.lit(False))
    good = rows.filter(good_row)
    lengths = [r[0] for r in good.select(F.size("embedding").alias("n")).distinct().limit(1001).collect()]
    if len(lengths) > 1000:
        raise ValueError("vectors of more than a thousand different lengths")
    found = [_of_length(good.filter(F.size("embedding") == n), cosine, rows_per_point, most_points, depth, share, apart, seed) for n in lengths]
    joined = rows.filter(~good_row).select("vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("component"))
    for more in found:
        joined = joined.union(more)
    kept = F.coalesce(F.col("component") == F.col("vec_id"), F.lit(True))
    return joined.select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"), kept.alias("kept"))


def _of_length(good: DataFrame, cosine: float, rows_per_point: int, most_points: int, depth: int, share: int, apart: float, seed: int) -> DataFrame:
    """(vec_id, links, component) of usable vectors of one length."""
    spark = good.sparkSession
    kind = good.schema["embedding"].dataType.simpleString()
    digested = good.mapInArrow(_hashed, f"vec_id long, embedding {kind}, digest binary")
    digests = written(digested.select("vec_id", "digest"))
    classes = digests.groupBy("digest").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()))
    different = written(digested.dropDuplicates(["vec_id", "digest"]).join(classes, ["vec_id", "digest"]).drop("digest"))
    n = different.count()
    points = reference_points(different, max(16, min(most_points, n // rows_per_point)), apart, seed)
    depth, share = min(depth, len(points)), min(share, len(points))
    held = spark.sparkContext.broadcast(points)
    described = written(different.mapInArrow(_lists(held, depth), f"node long, copies long, embedding {kind}, points array<int>"))
    listed = described.select("node", F.explode("points").alias("point"))
    sizes = listed.groupBy("point").agg((F.count(F.lit(1)) / _BLOCK).cast("int").alias("more"))
    entries = described.withColumn("point", F.explode("points")).join(F.broadcast(sizes), "point")
    blocks = F.col("more") + 1
    entries = entries.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("more"))))
    entries = entries.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    entries = entries.select("point", "i", "j", "own", "node", "copies", "embedding", "points")
    links = written(entries.groupBy("point", "i", "j").applyInArrow(_compare(share, cosine), "node long, links long, label long"))
    labels = components(links.select(F.col("node").alias("a"), F.col("label").alias("b")))
    direct = links.groupBy("node").agg(F.sum("links").alias("links"))
    of_class = written(classes.join(direct, "node", "left").join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")))
    smallest = of_class.groupBy("label").agg(F.min("vec_id").alias("component"))
    of_class = of_class.drop("component").join(smallest, "label")
    of_class = of_class.select("digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component")
    return digests.join(of_class, "digest").select("vec_id", "links", "component")
