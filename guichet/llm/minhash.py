"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union.

An element of a document's set takes part in a random permutation of the signature's slots:
in round j it offers j plus a random fraction to the slot that the permutation names j-th.
The rounds end when every slot holds less than the next round could offer, so long documents
need one or two rounds. The slots of an element are all different, which gives the
signature less variance than independent hashes have.

Documents with equal sets are one class. Classes that share a band are compared by their
sketches, and what is alike is joined to clusters; all pairs of a cluster are then verified
on full sets. Buckets and clusters are worked off in pairs of blocks, and what leaves a block
is one label per document, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guichet.llm.components import components
from guichet.llm.runs import by_run, in_block_pairs, lowest_labels
from guichet.llm.store import bounded_batches, written

_GOLDEN = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_REMEMBERED = 200_000
_ELEMENTS = 150_000  # set elements that are signed at a time
_BLOCK = 256  # classes of a bucket in a block
_BLOCK_SHINGLES = 100_000  # shingles of a cluster in a block, on average


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct shingles of a text as sorted 64-bit hashes; words are lower-cased in A-Z and end at ASCII white space."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > _REMEMBERED:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.words, len(hashes))
        joined = np.full(len(hashes) - n + 1, n, np.uint64)
        for i in range(n):
            joined = joined * _STEP + hashes[i : len(hashes) - n + 1 + i]
        return np.unique(_mixed(joined))


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """SuperMinHash of non-empty sets, a row each: round in the upper half of a value, random fraction in the lower."""
    out = np.full((len(sets), slots), np.iinfo(np.int64).max)
    lengths = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)
    order: np.ndarray | None = None
    for j in range(slots):
        bits = _mixed(flat + np.uint64(_GOLDEN * (j + 1) % 2**64))
        value = (np.int64(j) << np.int64(32)) | (bits >> np.uint64(32)).astype(np.int64)
        other = j + (((bits & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            slot = other
        else:
            slot = order[rows, other]
            order[rows, other] = order[:, j]
            order[:, j] = slot
        np.minimum.at(out.reshape(-1), owner * slots + slot, value)
        active = (out.max(1) >> 32 > j)[owner]
        if not active.any():
            break
        if j == 0:
            order = np.tile(np.arange(slots, dtype=np.int16), (int(active.sum()), 1))
            rows = np.arange(len(order))
            first = other[active]
            order[rows, first] = 0
            order[:, 0] = first
        elif not active.all():
            order = order[active]
            rows = np.arange(len(order))
        flat, owner = flat[active], owner[active]
    return out


def _bands(signature: np.ndarray, rows: int) -> np.ndarray:
    parts = signature.view(np.uint64).reshape(len(signature), signature.shape[1] // rows, rows)
    joined = np.tile(np.arange(parts.shape[1], dtype=np.uint64), (len(signature), 1))
    for i in range(rows):
        joined = _mixed(joined * _STEP + parts[:, :, i])
    return joined.view(np.int64)


_FEATURES = "doc_id long, n_shingles long, set_hash binary, bands array<long>, sketch binary"


def _features(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            ids, sets, at = batch["doc_id"].to_pylist(), [], 0
            for i, text in enumerate(batch["text"]):
                sets.append(shingler(text.as_py()))
                if i + 1 == len(ids) or sum(map(len, sets)) > _ELEMENTS:
                    yield _signed(ids[at : i + 1], sets, bands, rows)
                    at, sets = i + 1, []

    return run


def _signed(ids: list, sets: list[np.ndarray], bands: int, rows: int) -> pa.RecordBatch:
    full = [s for s in sets if len(s)]
    signature = signatures(full, bands * rows) if full else np.zeros((0, bands * rows), np.int64)
    keys, sketch = iter(_bands(signature, rows)), iter((signature & 0xFF).astype(np.uint8))
    columns: tuple[list, ...] = ([], [], [])
    for s in sets:
        columns[0].append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
        columns[1].append(next(keys) if len(s) else None)
        columns[2].append(next(sketch).tobytes() if len(s) else None)
    arrays = [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.list_(pa.int64())), pa.array(columns[2], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "set_hash", "bands", "sketch"])


def _sketch_links(slots: int, percent: int):
    """Links between the members of a bucket whose sketches and sizes are near enough.

    The sketch has a byte of each slot; five standard deviations below the wanted similarity
    are near enough.
    """
    share = percent / 100
    least = slots * share - 5 * (slots * share * (1 - share)) ** 0.5

    def work(table: pa.Table, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, n, own, i, j = (table[c].to_numpy() for c in ("doc_id", "n_shingles", "own", "i", "j"))
        sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(len(ids), slots)
        out: tuple[list, list] = ([], [])
        for begin, end in zip(begins, begins[1:], strict=False):
            first, second = [], []
            same = i[begin] == j[begin]
            for at in range(begin, end - 1):
                if not same and own[at] != i[begin]:
                    continue
                near = np.arange(at + 1 if same else begin, end)
                fits = 100 * np.minimum(n[near], n[at]) >= percent * np.maximum(n[near], n[at])
                if not same:
                    fits &= own[near] == j[begin]
                near = near[fits]
                near = near[(sketch[near] == sketch[at]).sum(1) >= least]
                first += [at - begin] * len(near)
                second += (near - begin).tolist()
            if first:
                label = lowest_labels(ids[begin:end], np.array(first), np.array(second))
                moved = label != ids[begin:end]
                out[0].append(ids[begin:end][moved])
                out[1].append(label[moved])
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["a", "b"])

    return work


def _set_links(words: int, percent: int):
    """Links between the members of a cluster whose sets are similar enough.

    One member's elements are marked among all elements of the block pair; sums over the
    marks give its intersections with all others at a time.
    """

    def work(table: pa.Table, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        ids, own, i, j = (table[c].to_numpy() for c in ("doc_id", "own", "i", "j"))
        out: tuple[list, list] = ([], [])
        for begin, end in zip(begins, begins[1:], strict=False):
            if end - begin < 2:
                continue
            sets = [shingler(text.as_py()) for text in table["text"].slice(begin, end - begin)]
            n = np.array([len(s) for s in sets])
            starts = np.cumsum([0, *n[:-1]])
            seen, flat = np.unique(np.concatenate(sets), return_inverse=True)
            marked = np.zeros(len(seen), np.int32)
            same = i[begin] == j[begin]
            first, second = [], []
            for at in range(end - begin):
                if not n[at] or not same and own[begin + at] != i[begin]:
                    continue
                mine = flat[starts[at] : starts[at] + n[at]]
                marked[mine] = 1
                common = np.add.reduceat(marked[flat], np.minimum(starts, len(flat) - 1))
                marked[mine] = 0
                fits = (n > 0) & (100 * common >= percent * (n + n[at] - common))
                fits &= np.arange(len(n)) > at if same else own[begin:end] == j[begin]
                near = np.flatnonzero(fits)
                first += [at] * len(near)
                second += near.tolist()
            if first:
                label = lowest_labels(ids[begin:end], np.array(first), np.array(second))
                moved = label != ids[begin:end]
                out[0].append(ids[begin:end][moved])
                out[1].append(label[moved])
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["a", "b"])

    return work


def near_duplicates(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    rows: int = 4,
    missed: float = 2e-8,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 times the size of the intersection of their shingle sets
    is at least ``percent`` times that of the union. Links are confirmed on full sets. There
    are as many bands of ``rows`` slots as it takes for a linked pair to share none with a
    probability of at most ``missed``. component_id is the smallest identifier that links
    reach, kept says that it is the row's own.

    Null or empty text and text without words has an empty set and is linked with nothing.
    Identifiers are whole numbers; rows with the same one are one node. Rows without one get
    no component and are kept. Texts of any length are read whole.
    """
    bands = math.ceil(math.log(missed) / math.log(1 - (percent / 100) ** rows)) if percent < 100 else 1
    bounded_batches(docs)
    source = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    features = written(source.mapInArrow(_features(words, bands, rows), _FEATURES))
    classes = written(features.filter("set_hash is not null and doc_id is not null").groupBy("set_hash").agg(F.min("doc_id").alias("doc_id")))
    members = features.join(classes, ["doc_id", "set_hash"]).dropDuplicates(["doc_id", "set_hash"])
    members = written(members.select("doc_id", "n_shingles", "sketch", "bands"))
    buckets = members.select(F.explode("bands").alias("band"), "doc_id")
    # Counts are written before they are joined back, so that a join can split a large bucket.
    sizes = written(buckets.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))
    entries = written(buckets.join(sizes, "band"))
    entries = entries.join(members.select("doc_id", "n_shingles", "sketch"), "doc_id")
    entries = in_block_pairs(entries, "band", "doc_id", F.ceil(F.col("size") / _BLOCK))
    entries = entries.select("band", "i", "j", "own", "doc_id", "n_shingles", "sketch")
    clusters = components(by_run(entries, ["band", "i", "j"], _sketch_links(bands * rows, percent), "a long, b long"))

    clusters = written(clusters.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster")).join(members.select("doc_id", "n_shingles"), "doc_id"))
    sizes = written(clusters.groupBy("cluster").agg(F.sum("n_shingles").alias("size")))
    # Never broadcast: the plan is the same at every size, and texts are hashed to it, not sorted.
    clusters = written(clusters.join(sizes, "cluster").select("doc_id", "cluster", "size"))
    texts = source.join(clusters.hint("shuffle_hash"), "doc_id")
    texts = in_block_pairs(texts, "cluster", "doc_id", F.floor(F.col("size") / _BLOCK_SHINGLES) + 1)
    texts = texts.select("cluster", "i", "j", "own", "doc_id", "text")
    labels = components(by_run(texts, ["cluster", "i", "j"], _set_links(words, percent), "a long, b long"))

    copies = features.join(classes.withColumnRenamed("doc_id", "_class"), "set_hash").filter("doc_id != _class").select("doc_id", "_class")
    labels = written(labels)
    named = copies.join(labels.withColumnRenamed("node", "_class"), "_class", "left").select("doc_id", F.coalesce("component", "_class").alias("component"))
    found = named.union(labels.select(F.col("node"), "component")).groupBy("doc_id").agg(F.min("component").alias("component"))
    out = features.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
