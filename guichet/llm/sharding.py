"""Shards by best-fit-decreasing bin packing of indivisible groups.

Rows with equal text form a group that stays in one shard. Groups of at least a grain are
packed one by one; smaller ones travel in parcels of about a grain, dealt by a hash of
their text, so that what is packed in one place has a size set by the number of shards and
not by the number of rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from guichet.llm.store import written

_LEAF = 256


class FreeSpace:
    """Open bins by free space: a balanced tree of sorted leaves."""

    def __init__(self) -> None:
        self.leaves: list[list[tuple[int, int]]] = []

    def add(self, free: int, bin_id: int) -> None:
        if not self.leaves:
            self.leaves.append([])
        at = min(bisect_left(self.leaves, (free, bin_id), key=lambda leaf: leaf[-1] if leaf else (0, 0)), len(self.leaves) - 1)
        insort(self.leaves[at], (free, bin_id))
        if len(self.leaves[at]) > _LEAF:
            half = self.leaves[at][_LEAF // 2 :]
            del self.leaves[at][_LEAF // 2 :]
            self.leaves.insert(at + 1, half)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least free space that suffices."""
        at = bisect_left(self.leaves, (need, -1), key=lambda leaf: leaf[-1] if leaf else (0, 0))
        if at == len(self.leaves):
            return None
        i = bisect_left(self.leaves[at], (need, -1))
        if i == len(self.leaves[at]):
            return None
        found = self.leaves[at].pop(i)
        if not self.leaves[at]:
            del self.leaves[at]
        return found


def best_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """Bin of each size, and how many bins; larger than a bin: a bin of its own. Ties: the earlier first."""
    space, bins, out = FreeSpace(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = space.take(sizes[i])
        if found is None:
            found, bins = (max(capacity, sizes[i]), bins), bins + 1
        out[i] = found[1]
        space.add(found[0] - sizes[i], found[1])
    return out, bins


def spread(sizes: list[int], shards: int) -> list[int]:
    """Bins of nearly equal fill: the least capacity under which best fit needs no more than ``shards``.

    What exceeds an equal share of what is left gets a shard of its own first.
    """
    out, order, left = [0] * len(sizes), sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)), sum(sizes)
    alone = 0
    while alone < min(shards - 1, len(order)) and sizes[order[alone]] * (shards - alone) > left:
        out[order[alone]] = alone
        left -= sizes[order[alone]]
        alone += 1
    rest, bins = order[alone:], shards - alone
    own = [sizes[i] for i in rest]
    low, high = max(own[:1] + [-(-left // bins)]), max(own[:1] + [0]) + -(-left // bins)
    while low < high:
        middle = (low + high) // 2
        if best_fit_decreasing(own, middle)[1] <= bins:
            high = middle
        else:
            low = middle + 1
    for i, b in zip(rest, best_fit_decreasing(own, high)[0], strict=True):
        out[i] = alone + b
    return out


def _narrow(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Identifier, size, checksum and group of every row; null text has no bytes and is a group apart."""
    data = F.col(text).cast("binary")
    return docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(data), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(data), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.unhex(F.md5(data)), F.lit(b"")).alias("group"),
    )


def _units(rows: DataFrame, grain: int, parcels: int) -> DataFrame:
    """Sizes of what is packed as one: unit (the group, or null), parcel (or null), size."""
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"))
    large = F.col("size") >= grain
    return (
        groups.select(F.when(large, F.col("group")).alias("unit"), F.when(~large, F.pmod(F.xxhash64("group"), F.lit(parcels))).alias("parcel"), "size")
        .groupBy("unit", "parcel")
        .agg(F.sum("size").alias("size"))
    )


def _placed(rows: DataFrame, placed: DataFrame, parcels: int) -> DataFrame:
    """``rows`` with their shard. placed: unit, parcel, shard; at most twice as many as there may be parcels."""
    units = placed.filter("unit is not null").select(F.col("unit").alias("group"), F.col("shard").alias("_own"))
    dealt = placed.filter("parcel is not null").select("parcel", F.col("shard").alias("_dealt"))
    joined = rows.withColumn("parcel", F.pmod(F.xxhash64("group"), F.lit(parcels))).join(F.broadcast(units), "group", "left").join(F.broadcast(dealt), "parcel", "left")
    return joined.select("doc_id", "size", "text_crc32", F.coalesce("_own", "_dealt").alias("shard"))


def _slotted(rows: DataFrame, n: int, shards: int, per_bucket: int = 5000) -> DataFrame:
    """Number the rows of each shard from 0, by bucket so that no shard has to fit into one task."""
    buckets = max(1, n // (max(shards, 1) * per_bucket))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "_bucket").count().select("shard", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("shard", "_bucket").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("_at", F.row_number().over(within) - 1)
    return numbered.join(starts, ["shard", "_bucket"]).withColumn("slot", F.col("_start") + F.col("_at")).drop("_bucket", "_start", "_at")


def balance(docs: DataFrame, shards: int, *, key: str = "doc_id", text: str = "text", units_per_shard: int = 1000) -> DataFrame:
    """Every row's shard of ``shards`` shards of nearly equal bytes, and its slot there.

    Returns doc_id, size (bytes of text plus 8), text_crc32, shard, slot. A group larger than
    an equal share makes its shard larger than the others. The driver gets at most twice
    ``shards * units_per_shard`` sizes. Null and repeated identifiers are rows like others;
    an empty table gives no rows; empty text is a group, null text another.
    """
    spark, parcels = docs.sparkSession, shards * units_per_shard
    rows = written(_narrow(docs, key, text))
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    units = _units(rows, max(1, -(-total // parcels)), parcels).collect()
    units.sort(key=lambda u: (-u["size"], bytes(u["unit"] or b""), u["parcel"] or 0))
    bins = spread([u["size"] for u in units], shards)
    pairs = [(u["unit"], u["parcel"], b) for u, b in zip(units, bins, strict=True)]
    placed = spark.createDataFrame(pairs, "unit binary, parcel long, shard int")
    return _slotted(_placed(rows, placed, parcels), n, shards)


def pack(docs: DataFrame, capacity: int, *, key: str = "doc_id", text: str = "text", shards_per_cell: int = 64, units_per_shard: int = 256) -> DataFrame:
    """Every row's shard when shards hold ``capacity`` bytes and are to be few.

    Groups are dealt by a hash into cells of about ``shards_per_cell`` shards; a task packs one
    cell, which holds at most twice ``shards_per_cell * units_per_shard`` units on average. A
    group larger than the capacity has a shard of its own. Columns and odd rows as in ``balance``.
    """
    rows = written(_narrow(docs, key, text))
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    cells = max(1, total // (capacity * shards_per_cell))
    parcels = cells * shards_per_cell * units_per_shard

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "parcel", "unit"], ascending=[False, True, True], ignore_index=True)
        return frame.assign(bin=best_fit_decreasing([int(s) for s in frame["size"]], capacity)[0])[["unit", "parcel", "cell", "bin"]]

    units = _units(rows, max(1, capacity // units_per_shard), parcels)
    cell = F.pmod(F.coalesce(F.col("parcel"), F.xxhash64("unit")), F.lit(cells))
    placed = written(units.withColumn("cell", cell).groupBy("cell").applyInPandas(fill, "unit binary, parcel long, cell long, bin int"))
    used = placed.groupBy("cell").agg((F.max("bin") + 1).alias("bins"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = used.select("cell", F.coalesce(F.sum("bins").over(before), F.lit(0)).alias("start"))
    placed = placed.join(starts, "cell").select("unit", "parcel", (F.col("start") + F.col("bin")).cast("int").alias("shard"))
    own = placed.filter("unit is not null").select(F.col("unit").alias("group"), F.col("shard").alias("_own"))
    dealt = placed.filter("parcel is not null").select("parcel", F.col("shard").alias("_dealt"))
    joined = rows.withColumn("parcel", F.pmod(F.xxhash64("group"), F.lit(parcels))).join(own, "group", "left").join(dealt, "parcel", "left")
    shards = int(total // max(1, capacity)) + 1
    return _slotted(joined.select("doc_id", "size", "text_crc32", F.coalesce("_own", "_dealt").alias("shard")), n, shards)

