"""Tickets that say the same: exact duplicates, and redundant tickets of one client near in time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guichet.runs import by_run, in_block_pairs
from guichet.session import bounded_batches, dropped
from guichet.session import written as _written

KEY = "external_ticket_id"
_SHARED = 6  # rare words that similar sets are known to share before they are compared
_FREQUENT = 1 << 16  # words that are put in the order of their frequency, behind all others
_BLOCK = 1 << 14  # sets of a block
_CELLS = 1 << 22  # pairs that are counted at a time
_TRIED = 4  # earlier sets that a set is compared with before its others


def words(text: Column) -> Column:
    """The different words of a text, lower-cased: runs of ASCII letters and digits."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " ")
    return F.array_distinct(F.filter(F.split(plain, " "), lambda w: w != ""))


def duplicate_counts(tickets: DataFrame, *columns: str) -> DataFrame:
    """One row: rows, different contents, contents that occur more than once, and rows beyond the first of theirs.

    Contents are compared by a digest of ``columns``, NULL apart from empty text; a content
    that makes up much of the table is counted per task first.
    """
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    digest = F.sha2(F.concat_ws("\x1f", *parts).cast("binary"), 256)
    counts = tickets.groupBy(digest.alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_count"),
        F.count_if(F.col("n") > 1).alias("duplicated_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_row_count"),
    )


def _frequent(sets: DataFrame) -> np.ndarray:
    """Hashes of the words that most sets have, a fixed number at most, rarest first."""
    counts = sets.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    most = counts.orderBy(F.desc("n"), "word").limit(_FREQUENT).select(F.xxhash64("word").alias("word")).collect()
    return np.array([r.word for r in reversed(most)], np.int64)


def _levels(percent: int) -> np.ndarray:
    """Where classes of sizes begin: sets of like sizes are in one class or in neighbouring ones."""
    begins = [1]
    while begins[-1] < 1 << 31 and percent < 100:
        begins.append(max(begins[-1] + 1, 100 * begins[-1] // max(percent, 1)))
    return np.array(begins)


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(id, client, at, size, level, last, rare): so many of the first words of each set that similar sets share six of them, or as many as the smaller needs; last is the order of the last one.

    Words are hashes, in one order for all sets: those that are not frequent, then the
    frequent ones, rarest first. Similar sets share at least ``percent`` of the words of each.
    The first six of the shared ones have all others of them behind them, so they stand that
    far from the end.
    """
    bounded_batches(sets)
    frequent, levels = _frequent(sets), _levels(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(frequent)
        known = frequent[order]
        for batch in batches:
            words, size = batch["words"].flatten().to_numpy(), batch["words"].value_lengths().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(size)), size)
            at = np.minimum(np.searchsorted(known, words), len(known) - 1)
            rank = np.where(known[at] == words, order[at] + 1, 0)
            common = np.ceil(size * percent / 100).astype(np.int64)
            needed = np.minimum(common, _SHARED)
            length = size - common + needed
            within = np.arange(len(words)) - np.repeat(np.cumsum(size) - size, size)
            first = np.lexsort((words, rank, row))[within < np.repeat(length, size)]
            rare, last = words[first], rank[first[np.cumsum(length) - 1]]
            ends = pa.py_buffer(np.append(0, 8 * np.cumsum(length)).astype(np.int32).tobytes())
            level = size if percent >= 100 else np.searchsorted(levels, size, "right")
            columns = [pa.array(x.astype(np.int32)) for x in (size, level, last)]
            columns.append(pa.Array.from_buffers(pa.binary(), len(size), [None, ends, pa.py_buffer(rare.tobytes())]))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["client"], batch["at"], *columns], ["id", "client", "at", "size", "level", "last", "rare"])

    hashed = sets.select("id", F.xxhash64("client").alias("client"), "at", F.transform("words", lambda w: F.xxhash64(w)).alias("words"))
    return hashed.mapInArrow(run, "id long, client long, at int, size int, level int, last int, rare binary")


def _meeting(days: int, percent: int):
    """Whole groups of sets: those of like sizes, up to ``days`` days apart, that share as many rare words as similar sets do.

    The set whose rare words end first has as many words behind them; what two sets share is
    at most that and what they share before.
    """

    def work(table: pa.Table, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = table.num_rows
        ids, when, size, last_rank, own, i, j = (table[c].to_numpy() for c in ("id", "at", "size", "last", "own", "i", "j"))
        size = size.astype(np.int64)
        period, level = (table[c].to_numpy(zero_copy_only=False) for c in ("own_period", "own_level"))
        group = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
        lengths = np.concatenate([pc.binary_length(x).to_numpy() for x in table["rare"].chunks]).astype(np.int64) // 8
        words, row = np.frombuffer(b"".join(table["rare"].to_pylist()), np.int64), np.repeat(np.arange(n), lengths)
        last_word, behind = words[np.cumsum(lengths) - 1], size - lengths
        order = np.lexsort((row, words, group[row]))
        words, row = words[order], row[order]
        starts = np.flatnonzero(np.append(True, (words[1:] != words[:-1]) | (group[row[1:]] != group[row[:-1]])))
        counts = np.diff(np.append(starts, len(words)))
        later = np.repeat(starts + counts, counts) - np.arange(len(words)) - 1  # rows behind this one that have the word
        by_row, from_row = np.argsort(row, kind="stable"), np.append(0, np.cumsum(lengths))
        step = max(1, _CELLS // n)
        for first in range(0, n, step):
            last = min(n, first + step)
            at = by_row[from_row[first] : from_row[last]]
            at = at[later[at] > 0]
            if not len(at):
                continue
            width = int(begins[group[last - 1] + 1]) - first
            shared = np.zeros((last - first) * width, np.int64)
            for part in np.split(at, np.flatnonzero(np.diff(np.cumsum(later[at]) // (1 << 21), prepend=0))):
                k = later[part]
                each = np.repeat(np.arange(len(part)), k)
                other = np.arange(len(each)) + (part + 1 - np.cumsum(k) + k)[each]
                shared += np.bincount((row[part] - first)[each] * width + row[other] - first, minlength=len(shared))
            found = np.flatnonzero(shared)
            x, y = found // width + first, found % width + first
            ends_first = (last_rank[x] < last_rank[y]) | ((last_rank[x] == last_rank[y]) & (last_word[x] <= last_word[y]))
            most = shared[found] + np.where(ends_first, behind[x], behind[y])
            kept = ((100 + percent) * most >= percent * (size[x] + size[y])) & (100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y]))
            # Every pair counts in one group, and there in one pair of blocks.
            kept &= (period[x] | period[y]) & (level[x] | level[y]) & ((i[x] == j[x]) | (own[x] != own[y])) & (x != y)
            x, y = x[kept], y[kept]
            apart = when[y] - when[x]
            on, back = (apart >= 0) & (apart <= days), (apart <= 0) & (apart >= -days)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(ids[x[on]], ids[y[back]])), pa.array(np.append(ids[y[on]], ids[x[back]]))], ["a", "b"])

    return work


def _candidates(sets: DataFrame, days: int, percent: int) -> DataFrame:
    """(a, b): different sets of one client, b up to ``days`` days after a, of like sizes, that share the rare words that similar sets share.

    A set is in the group of its client, period and class of sizes, and in those of the next
    period and class, where it only meets sets of their own. Blocks of a large group meet two
    at a time; only pairs that pass leave a task.
    """
    prefixes = _written(_prefixes(sets, percent))
    period = F.floor(F.col("at") / max(days, 1))

    def places(own: Column, name: str) -> Column:
        return F.explode(F.array(F.struct(own.alias("at"), F.lit(True).alias("own")), F.struct((own + 1).alias("at"), F.lit(False).alias("own")))).alias(name)

    rows = prefixes.select("*", places(period, "p")).select("*", places(F.col("level"), "l"))
    rows = rows.select(F.xxhash64("client", "p.at", "l.at").alias("group"), "id", "at", "size", "last", F.col("p.own").alias("own_period"), F.col("l.own").alias("own_level"), "rare")
    large = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > _BLOCK).select("group", F.ceil(F.col("n") / _BLOCK).cast("int").alias("blocks"))
    dealt = in_block_pairs(rows.join(F.broadcast(large), "group", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))), "group", "id", F.col("blocks"))
    found = _written(by_run(dealt.drop("blocks"), ["group", "i", "j"], _meeting(days, percent), "a long, b long"))
    dropped(prefixes)
    return found


def _checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b, ...) whose whole sets are similar and of one client; both come to the pair from one join, so that the sets move once."""
    sides = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("id")).join(sets.select("id", F.col("client").alias("of"), "words"), "id")
    both = sides.groupBy("a", "b").agg(F.collect_list(F.struct("of", "words")).alias("two"))
    (x, y), (client_x, client_y) = ([F.get("two", F.lit(i))[c] for i in (0, 1)] for c in ("words", "of"))
    common = F.size(F.array_intersect(x, y))
    alike = 100 * common >= percent * (F.size(x) + F.size(y) - common)
    return pairs.join(both.filter((client_x == client_y) & alike).select("a", "b"), ["a", "b"])


def redundant_tickets(tickets: DataFrame, client: str, *, text: str = "details", created: str = "ticket_created_at", key: str = KEY, days: int = 7, percent: int = 80) -> DataFrame:
    """(key, earlier): tickets with a similar one of the same client up to ``days`` days before, and the first of these.

    Two texts are similar when their sets of words share at least ``percent`` of all their
    words. The order is by date and key. Equal texts of a client and day are one; the rest
    meets in groups of a client, a period and a class of sizes by its rare words, and what
    shares enough of these is checked on the whole sets, so that few sets travel to others.
    Tickets without a client, a date or a word are in no pair.
    """
    day = F.to_date(created)
    rows = tickets.select(F.col(key).alias("key"), F.col(client).alias("client"), day.alias("day"), words(F.col(text)).alias("words"))
    rows = rows.filter((F.size("words") > 0) & F.col("client").isNotNull() & F.col("day").isNotNull())
    rows = rows.withColumn("sorted", F.concat_ws(" ", F.array_sort("words"))).withColumn("content", F.sha2("sorted", 256))
    same = ["client", "day", "content"]
    first = rows.groupBy(*same).agg(F.min("key").alias("id_key"), F.first("sorted").alias("sorted")).filter("id_key is not null")
    split = F.split("sorted", " ").alias("words")
    sets = _written(first.select(F.xxhash64(*same).alias("id"), *same, F.unix_date("day").alias("at"), "id_key", split))
    copies = rows.select("key", *same).join(sets.select("id", "id_key", *same), same).filter("key != id_key").select("key", "day", "id_key", "id")
    pairs = _candidates(sets, days, percent)
    days_of = sets.select(F.col("id").alias("a"), F.col("day").alias("day_a"), F.col("id_key").alias("key_a"))
    nth = F.row_number().over(Window.partitionBy("b").orderBy("day_a", "key_a", "a"))
    pairs = _written(pairs.join(days_of, "a").select("a", "b", "day_a", "key_a", (nth <= _TRIED).alias("soon")))
    # Only the first similar one is wanted: the later ones of a set are checked if none of the first few is similar.
    soon = _written(_checked(pairs.filter("soon"), sets, percent))
    later = pairs.filter("not soon").join(soon.select("b").distinct(), "b", "left_anti")
    earlier = soon.unionByName(_written(_checked(later, sets, percent)))
    # Similar sets of one day meet both ways round, so each has those of the others' keys that come before it.
    before = earlier.groupBy("b").agg(F.min(F.struct(F.col("day_a").alias("day"), F.col("key_a").alias("key"))).alias("first"))
    firsts = sets.join(before, sets["id"] == before["b"], "left").select("client", "day", "id_key", sets["id"], "first")
    own = F.struct(F.col("day").alias("day"), F.col("id_key").alias("key"))
    originals = firsts.filter(F.col("first") < own).select(F.col("id_key").alias("key"), F.col("first.key").alias("earlier"))
    of_copies = copies.join(firsts.select("id", "first"), "id")
    earliest = F.least(F.coalesce(F.col("first"), F.struct(F.col("day").alias("day"), F.col("id_key").alias("key"))), F.struct(F.col("day").alias("day"), F.col("id_key").alias("key")))
    return originals.unionByName(of_copies.select("key", earliest["key"].alias("earlier"))).withColumnsRenamed({"key": key})
