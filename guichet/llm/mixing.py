"""Mixing sources to target weights by Pareto order sampling.

A source's target says how often each of its documents is expected in the mix. The whole
part of that number is taken for certain; the fraction is the document's inclusion
probability. Documents are ranked by random odds over inclusion odds, and as many of the
first ones as fit into what is left of the target get one copy more. The one document that
fills the remaining gap best completes the sample, so that its size in words is fixed but
for a few words.

Everything is DataFrame functions. The cut in a source's ranking is found from sums over
buckets of the rank, narrowed twice, so that no source is ever sorted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from guichet.llm.store import carried, restored, written

WORD = r"[^ \t-\r]+"
_BUCKETS = 2000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...], max_repeat: int) -> DataFrame:
    """Targets by source, from (source, source_size): one row per source, in one small window.

    Weights go round the sources in code point order, null last. All sources share the sum
    of all sizes by weight; none gets more than ``max_repeat`` times its size, and what is
    above goes to the others by weight. In order of size over weight the sources that reach
    their limit come first, so one running sum finds them; the first that does not has the level of all the rest.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sources.withColumn("_at", F.row_number().over(order) - 1)
    rows = rows.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (F.col("_at") % len(weights) + 1).cast("int")).cast("double"))
    rows = rows.withColumn("_limit", (F.col("source_size") * max_repeat).cast("double"))
    before = Window.orderBy(F.col("_limit") / F.col("_w"), "_at").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    of = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    rows = rows.withColumn("_level", left / of)
    full = F.col("_limit") <= F.col("_w") * F.col("_level")
    level = F.max(F.when(~full, F.col("_level"))).over(everything)
    return rows.select("source", "source_size", F.when(full, F.col("_limit")).otherwise(F.col("_w") * level).alias("target"))


def _odds_rank(draw: Column, chance: Column) -> Column:
    """Random odds over inclusion odds, as q / (1 + q) to lie between 0 and 1; null without a chance."""
    q = draw / (1 - draw) * ((1 - chance) / chance)
    return F.when(chance > 0, q / (1 + q))


def _draw(key: Column, text: Column, seed: int) -> Column:
    """Between 0 and 1, from 13 hexadecimal digits of a digest of seed, identifier and text."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(16**13)


def _cutoffs(rows: DataFrame) -> DataFrame:
    """The rank in each source up to which documents fit: source, _cut, _gap.

    rows: source, size, _rank, _left (words still wanted from the source). _gap: the words
    that are still wanted then.
    """
    ranked = rows.filter("_rank is not null")
    edge = F.lit(0.0)
    width = 1.0
    kept = ranked.withColumn("_edge", edge).withColumn("_done", F.lit(0.0))
    for _ in range(2):
        width /= _BUCKETS
        bucket = F.least(F.floor((F.col("_rank") - F.col("_edge")) / width), F.lit(_BUCKETS - 1))
        kept = kept.withColumn("_bucket", bucket)
        sums = kept.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"), F.max("_left").alias("_left"), F.max("_done").alias("_done"), F.max("_edge").alias("_edge"))
        running = F.sum("_sum").over(Window.partitionBy("source").orderBy("_bucket")) + F.col("_done")
        sums = sums.withColumn("_to", running)
        first = Window.partitionBy("source").orderBy(F.col("_to") < F.col("_left"), "_bucket")
        last = Window.partitionBy("source").orderBy(F.col("_bucket").desc())
        chosen = sums.withColumn("_i", F.row_number().over(first)).withColumn("_j", F.row_number().over(last))
        reaches = F.col("_to") >= F.col("_left")
        chosen = chosen.filter((reaches & (F.col("_i") == 1)) | (~reaches & (F.col("_j") == 1)))
        chosen = chosen.select(
            F.col("source").alias("_s"),
            F.col("_bucket").alias("_b"),
            (F.col("_to") - F.col("_sum")).alias("_done2"),
            (F.col("_edge") + F.col("_bucket") * F.lit(width)).alias("_edge2"),
        )
        here = F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b"))
        kept = kept.join(chosen, here).select("source", "size", "_rank", "_left", F.col("_edge2").alias("_edge"), F.col("_done2").alias("_done"))
    running = F.sum("size").over(Window.partitionBy("source").orderBy("_rank").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    near = kept.withColumn("_to", F.col("_done") + running)
    fits = F.col("_to") <= F.col("_left")
    return near.groupBy("source").agg(
        F.coalesce(F.max(F.when(fits, F.col("_rank"))), F.max("_edge")).alias("_cut"),
        (F.max("_left") - F.coalesce(F.max(F.when(fits, F.col("_to"))), F.max("_done"))).alias("_gap"),
    )


def _fillers(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """cuts with _fill, the rank of the document behind the cut that leaves the smallest gap, if any makes it smaller."""
    ranks = rows.filter("_rank is not null").groupBy("source", "_rank").agg(F.sum("size").alias("_size"))
    of = cuts.select(F.col("source").alias("_s"), "_cut", "_gap")
    behind = ranks.join(of, F.col("source").eqNullSafe(F.col("_s"))).filter(F.col("_rank") > F.col("_cut"))
    miss = F.abs(F.col("_size") - F.col("_gap"))
    best = behind.filter(miss < F.col("_gap")).groupBy("source").agg(F.min(F.struct(miss.alias("miss"), F.col("_rank").alias("rank"))).alias("_best"))
    best = best.select(F.col("source").alias("_s"), F.col("_best.rank").alias("_fill"))
    return cuts.join(best, F.col("source").eqNullSafe(F.col("_s")), "left").select("source", "_cut", "_fill")


def mix(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = (5, 2, 1),
    max_repeat: int = 3,
    seed: int = 0,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    odds: str | None = None,
) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (copies times size, in words).

    ``odds`` names a column of relative inclusion odds within a source (null and negative: 0);
    without it all documents of a source are equally likely. Copies never exceed
    ``max_repeat``; where odds drive documents to that limit, a source may fall short of its
    target. Rows that agree in identifier and text share one draw and are taken alike; so the
    mix depends on the rows and not on their order, and reruns agree. Null text has size 0,
    null source is a source. Words missing from the text cannot be taken: a source without
    words has target 0. Columns of ``docs`` with the names above are replaced, others stay.
    """
    made = ("size", "source_size", "target", "copies", "taken")
    weight = F.greatest(F.coalesce(F.col(odds).cast("double"), F.lit(0.0)), F.lit(0.0)) if odds else F.lit(1.0)
    drawn = docs.select(
        carried(docs, *made),
        F.col(f"`{source}`").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"),
        _draw(F.col(f"`{key}`"), F.col(f"`{text}`"), seed).alias("_draw"),
        weight.alias("_odds"),
    )
    rows = written(drawn.select("source", "size", "_draw", "_odds"))
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("_odds")).alias("_weighted"))
    targets = source_targets(sums.select("source", "source_size"), weights, max_repeat)
    targets = written(targets.join(sums.select(F.col("source").alias("_s"), "_weighted"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))

    def expected(frame: DataFrame) -> DataFrame:
        """Adds what the source gives: expected copies, whole copies and the rank of the fraction."""
        of = targets.select(F.col("source").alias("_s"), "source_size", "target", "_weighted")
        frame = frame.join(of, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        times = F.when(F.col("_weighted") > 0, F.col("target") * F.col("_odds") / F.col("_weighted")).otherwise(0.0)
        frame = frame.withColumn("_times", F.least(times, F.lit(float(max_repeat))))
        return frame.withColumn("_whole", F.floor("_times")).withColumn("_rank", _odds_rank(F.col("_draw"), F.col("_times") - F.col("_whole")))

    ranked = expected(rows)
    whole = ranked.groupBy("source").agg(F.sum(F.col("_whole") * F.col("size")).alias("_whole_words"), F.max("target").alias("_t"))
    left = whole.select(F.col("source").alias("_s"), (F.col("_t") - F.col("_whole_words")).alias("_left"))
    ranked = ranked.join(left, F.col("source").eqNullSafe(F.col("_s"))).select("source", "size", "_rank", "_left")
    cuts = written(_fillers(ranked, written(_cutoffs(ranked))))
    cuts = cuts.select(F.col("source").alias("_s"), "_cut", "_fill")
    mixed = expected(drawn).join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left")
    more = F.coalesce(((F.col("_rank") <= F.col("_cut")) | F.col("_rank").eqNullSafe(F.col("_fill"))).cast("int"), F.lit(0))
    more = F.when(F.col("_rank").isNull(), 0).otherwise(more)
    mixed = mixed.withColumn("copies", (F.col("_whole") + more).cast("int"))
    return mixed.select(*restored(docs, *made), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeated(mixed: DataFrame) -> DataFrame:
    """One row per copy; documents with no copy are gone."""
    copies = mixed.filter("copies > 0").select(carried(mixed), F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return copies.select(*restored(mixed))
