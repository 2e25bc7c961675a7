"""Repeated byte windows by a depth-limited radix sort of suffixes.

Suffixes count through ``window`` bytes only, so that equal ones are exactly the repeated
windows. Each window belongs to the anchor with the smallest hash of ``GRAM`` bytes in it
(the leftmost of several), which depends on the window alone; equal windows have equal
anchors at equal offsets. An anchor's windows are sorted together, as a range of offsets:

* the bytes that all windows of a range have in common are its digit, and a range whose
  digit nobody shares is dropped;
* a range whose bytes occur more often as a whole is settled as a whole;
* what shares its digit but not its whole is split into smaller ranges, with longer digits,
  down to single windows in the last pass.

Every pass counts equal hashes. No group is ever gathered: a passage that every document has
is one row per task before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guichet.llm.store import bounded_batches, written

GRAM = 32
_SEGMENT = 1 << 21  # bytes that are hashed at a time; positions in it fit into 22 bits
_TABLE = np.random.default_rng(20).integers(0, 2**64, 256, np.uint64, endpoint=False)
_ODD = [np.uint64(x | 1) for x in np.random.default_rng(21).integers(0, 2**64, 6, np.uint64, endpoint=False).tolist()]


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position, joined from halves."""
    h, width, i = _TABLE[data], 1, 0
    while width < GRAM:
        h = h[:-width] * _ODD[i] + h[width:]
        width, i = 2 * width, i + 1
    h ^= h >> np.uint64(29)
    h *= _ODD[5]
    return h ^ (h >> np.uint64(32))


def anchors(data: bytes, window: int) -> list[tuple[int, int, int]]:
    """(anchor, first, last): the windows starting at first to last have this anchor."""
    offsets, out = window - GRAM + 1, []
    for base in range(0, len(data) - window + 1, _SEGMENT):
        part = np.frombuffer(data, np.uint8, min(len(data) - base, _SEGMENT + window - 1), base)
        h = _gram_hashes(part)
        low = ((h >> np.uint64(22)) << np.uint64(22)) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= offsets:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < offsets:
            low = np.minimum(low[: -(offsets - width)], low[offsets - width :])
        at = (low & np.uint64((1 << 22) - 1)).astype(np.int64)
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        ends = np.append(starts[1:], len(at)) - 1
        out += zip((at[starts] + base).tolist(), (starts + base).tolist(), (ends + base).tolist(), strict=True)
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _ranges(data: bytes, anchor: int, low: int, high: int, size: int, window: int, origin: int, limit: int) -> Iterator[tuple[int, int, int, int]]:
    """(digit, whole, low, high) of the ranges of ``size`` offsets, from ``origin`` on, that meet offsets low to high."""
    for least in range(origin + (low - origin) // size * size, high + 1, size):
        most = min(least + size - 1, limit)
        a, b = max(low, least), min(high, most)
        digit = xxhash.xxh3_64_intdigest(data[anchor - least : anchor - most + window], least << 10 | most)
        whole = xxhash.xxh3_64_intdigest(data[anchor - b : anchor - a + window], a << 20 | b << 10 | 1)
        yield _signed(digit), _signed(whole), a, b


def _packed(anchor: int, low: int, high: int) -> int:
    return anchor << 20 | low << 10 | high


def _place(at: Column, window: int) -> tuple[Column, Column]:
    """First and last byte (exclusive) of the windows of a packed range."""
    anchor, low, high = F.shiftright(at, 20), F.shiftright(at, 10).bitwiseAND(F.lit(1023)), at.bitwiseAND(F.lit(1023))
    return anchor - high, anchor - low + window


def _first_pass(window: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("digit", pa.int64()), ("whole", pa.int64()), ("at", pa.int64())]))
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                found, sizes, digests = [], [], []
                for text in batch["text"].slice(start, 500):
                    data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                    sizes.append(len(data))
                    digests.append(hashlib.sha256(data).digest())
                    found.append(
                        [
                            {"digit": d, "whole": w, "at": _packed(anchor, low, high)}
                            for anchor, first, last in anchors(data, window)
                            for d, w, low, high in _ranges(data, anchor, anchor - last, anchor - first, size, window, 0, window - GRAM)
                        ]
                    )
                ids = batch["doc_id"].slice(start, 500)
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(found, kind)], ["doc_id", "n_bytes", "sha", "ranges"])

    return run


def _next_pass(window: int, above: int, size: int):
    """Splits items (doc, text, at with heavy) of ranges of ``above`` offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data, out = row["text"].encode("utf-8", "surrogatepass"), []
                for item in row["items"]:
                    at = item["at"]
                    anchor, low, high = at >> 20, at >> 10 & 1023, at & 1023
                    origin = low // above * above
                    limit = min(origin + above - 1, window - GRAM)
                    out += [(row["doc"], item["heavy"], _packed(anchor, a, b), d, w) for d, w, a, b in _ranges(data, anchor, low, high, size, window, origin, limit)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc", "heavy", "at", "digit", "whole"])

    return run


_ITEMS = "doc long, heavy boolean, at long, digit long, whole long"


def _settle(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (doc, heavy, at, digit, whole): those whose whole repeats, and what has to be split.

    A heavy row stands for more than one place. To be split are, for each digit with several
    wholes of which one is found once, one row per whole.
    """
    # Counts are written before they are joined back, so that a join can split a frequent digit.
    shared = written(rows.groupBy("digit").agg(F.sum(F.when(F.col("heavy"), 2).otherwise(1)).alias("n")).filter("n > 1").select("digit"))
    rows = written(rows.join(shared, "digit"))
    uid = F.xxhash64("doc", "at")
    wholes = written(rows.groupBy("digit", "whole").agg(F.sum(F.when(F.col("heavy"), 2).otherwise(1)).alias("n"), F.min(uid).alias("uid")))
    repeated = rows.join(wholes.filter("n > 1").select("digit", "whole"), ["digit", "whole"]).filter(~F.col("heavy")).select("doc", "at")
    mixed = written(wholes.groupBy("digit").agg(F.count(F.lit(1)).alias("wholes"), F.min("n").alias("least")).filter("wholes > 1 and least = 1").select("digit"))
    split = wholes.join(mixed, "digit").select("digit", "whole", "uid", (F.col("n") > 1).alias("_heavy"))
    split = rows.join(split, ["digit", "whole"]).filter(uid == F.col("uid")).select("doc", "at", F.col("_heavy").alias("heavy")).distinct()
    return repeated, split


def _of_doc(split: DataFrame) -> DataFrame:
    return split.groupBy("doc").agg(F.collect_list(F.struct("at", "heavy")).alias("items"))


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: tuple[list, ...] = ([], [], [], [])
        for text, spans in zip(batch["text"], batch["spans"], strict=True):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass")
            kept, at, removed, runs = hashlib.sha256(), 0, 0, 0
            for s in sorted((s["first"], s["last"]) for s in spans.as_py() or ()):
                first, last = s
                if first > at or not runs:
                    kept.update(data[at:first])
                    runs += 1
                    at = first
                if last > at:
                    removed += last - at
                    at = last
            kept.update(data[at:])
            for c, v in zip(columns, (len(data), removed, runs, kept.hexdigest()), strict=True):
                c.append(v)
        longs = [pa.array(c, pa.int64()) for c in columns[:3]]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *longs, pa.array(columns[3], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(docs: DataFrame, *, text: str = "text", window: int = 400, sizes: tuple[int, ...] = (196, 14, 1)) -> tuple[DataFrame, DataFrame]:
    """(sha, spans): the byte ranges, first to last (exclusive), that repeated windows cover, by SHA-256 of the text.

    Ranges may overlap. Also returns one row per row of ``docs`` with doc_id, n_bytes, sha.
    ``sizes`` are the range sizes of the passes, each a divisor of the one before, the
    last one 1. Null text is empty; texts shorter than a window have no spans.
    """
    if sizes[-1] != 1 or any(a % b for a, b in zip(sizes, sizes[1:], strict=False)):
        raise ValueError("each size must divide the one before, and the last one be 1")
    if not GRAM < window <= GRAM + 1000:
        raise ValueError(f"a window must have more than {GRAM} and at most {GRAM + 1000} bytes")
    bounded_batches(docs)
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.col(f"`{text}`").alias("text"))
    schema = f"doc_id {id_kind}, n_bytes long, sha binary, ranges array<struct<digit:long,whole:long,at:long>>"
    features = source.mapInArrow(_first_pass(window, sizes[0]), schema)
    features = written(features.withColumn("doc", F.monotonically_increasing_id()))
    rows = features.select("doc", F.lit(False).alias("heavy"), F.explode("ranges").alias("r")).select("doc", "heavy", "r.at", "r.digit", "r.whole")
    repeated, split = _settle(rows)
    found = [repeated]
    texts = None
    for above, size in zip(sizes, sizes[1:], strict=False):
        if texts is None:
            # Equal texts have equal windows: one of them stands for all, and its text is kept once.
            # Only what is split is brought together by text, a row per whole however many copies there are.
            split = written(split.join(features.select("doc", "sha"), "doc"))
            wanted = split.groupBy("sha").agg(F.min("doc").alias("doc"))
            split = written(split.drop("doc").join(wanted, "sha").select("doc", "at", "heavy").distinct())
            hashed = source.select(F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("sha"), "text")
            different = hashed.groupBy("sha").agg(F.first("text").alias("text"))
            texts = written(different.join(wanted, "sha").select("doc", "text"))
        work = texts.join(_of_doc(split), "doc")
        rows = written(work.mapInArrow(_next_pass(window, above, size), _ITEMS).dropDuplicates(["doc", "at"]))
        repeated, split = _settle(rows)
        found.append(repeated)
    spans = found[0]
    for more in found[1:]:
        spans = spans.union(more)
    first, last = _place(F.col("at"), window)
    spans = spans.select("doc", first.alias("first"), last.alias("last")).join(features.select("doc", "sha"), "doc")
    spans = spans.select("sha", "first", "last").distinct().groupBy("sha").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    return spans, features.select("doc_id", "n_bytes", "sha")


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = 400) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte covered by a window of ``window`` bytes that also starts elsewhere, in the same
    text or another, is removed; n_spans counts the maximal removed runs, kept_sha256 is of
    the remaining bytes. Windows are judged on the input. Null text is empty; identifiers may
    be null or repeated: results belong to rows, and equal texts have equal results.
    """
    source = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    spans, _ = repeated_spans(source, window=window)
    kind = source.schema["doc_id"].dataType.simpleString()
    hashed = source.withColumn("sha", F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)))
    # Spans are written before they are joined back, so that the join can split a text with very many copies.
    joined = hashed.join(written(spans), "sha", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_clean, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
