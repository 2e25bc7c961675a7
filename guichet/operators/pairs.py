"""Pairs of tickets with a label: all known redundant ones, and a fixed number of others for each.

Other pairs are not drawn from all pairs. The rows of a block stand in the order of a hash;
pair number s of n rows is row s mod n and the one s div n + 1 places on, round the end. So
every pair has one number, the first ones are spread evenly over the rows, and as many are
made as are wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guichet.session import written as _written

_PART = 4096


def _placed(rows: DataFrame, group: str, part: Column, *order: str) -> DataFrame:
    """Adds ``place``, from 0: the row's position in its group, by part and then ``order``.

    Rows are numbered within a part and parts are counted, so that a group with a third of all rows is many windows.
    """
    rows = rows.withColumn("_part", part)
    sizes = _written(rows.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n")))
    parts = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(parts), F.lit(0))).drop("_n")
    within = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order)) - 1
    return rows.withColumn("_within", within).join(starts, [group, "_part"]).withColumn("place", F.col("_start") + F.col("_within")).drop("_part", "_start", "_within")


def labelled_pairs(tickets: DataFrame, positives: DataFrame, *, key: str, block: str, ratio: int = 3, salt: str = "") -> DataFrame:
    """(a, b, block, label): every known pair with label 1, and in each block ``ratio`` others for each of its known ones, label 0.

    ``positives`` (a, b) are pairs of keys; they count once, whatever their order and number,
    and belong to the block of their smaller key, the other one may be in another block. a is
    the smaller key. Others are pairs of different rows of one block that are not known, in
    the order of their numbers; a block has fewer only if it has no more. Which ones depends on
    keys and ``salt`` alone. Keys are unique in ``tickets``; rows without a key or a block, and known pairs
    with an unknown key or of a row with itself, take no part.
    """
    if ratio < 0:
        raise ValueError("ratio is not negative")
    rows = tickets.select(F.col(key).alias("key"), F.col(block).alias("block")).filter("key is not null and block is not null")
    known = positives.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    known = known.join(rows.select(F.col("key").alias("b")), "b").join(rows.select(F.col("key").alias("a"), "block"), "a")
    known = _written(known.select("a", "b", "block"))
    wanted = known.groupBy("block").agg(F.count(F.lit(1)).alias("known"))

    h = F.md5(F.concat(F.lit(salt), F.lit("|"), F.col("key").cast("string")))
    bucket = F.conv(F.substring(h, 1, 3), 16, 10).cast("int")
    placed = _written(_placed(rows.withColumn("h", h), "block", bucket, "h", "key").select("key", "block", "place"))
    sizes = placed.groupBy("block").agg(F.count(F.lit(1)).alias("n")).join(wanted, "block")
    # Known pairs of the block may be among the numbers, so as many more are made.
    sizes = _written(sizes.select("block", "n", "known", F.least((ratio + 1) * F.col("known"), F.expr("n * (n - 1) div 2")).alias("made")))
    turns = F.expr("(made - place + n - 1) div n")  # rounds in which this row has a number below ``made``
    first = placed.join(sizes, "block").filter("place < made").withColumn("round", F.explode(F.sequence(F.lit(1).cast("long"), turns)))
    first = first.select("block", F.col("key").alias("x"), ((F.col("round") - 1) * F.col("n") + F.col("place")).alias("number"), ((F.col("place") + F.col("round")) % F.col("n")).alias("place"))
    made = first.join(placed.select("block", "place", F.col("key").alias("y")), ["block", "place"])
    made = made.select("block", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "number")
    others = _written(made.join(known.select("a", "b"), ["a", "b"], "left_anti"))
    ranked = _placed(others, "block", F.expr(f"number div {_PART}"), "number")
    chosen = ranked.join(wanted, "block").filter(F.col("place") < ratio * F.col("known"))
    label = F.lit(1).alias("label")
    return known.select("a", "b", "block", label).unionByName(chosen.select("a", "b", "block", F.lit(0).alias("label")))
