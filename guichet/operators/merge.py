"""Keyed merge of a batch into the ticket table, with a rule per column.

Rows with the same key apply in the order of ``seq``. The first one sets summary,
details, status and ingestion time for good. Priority, category and pseudonym
follow the last one, NULL included. The business dates follow the last one that
has a date.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guichet.schema import CLEAN, STORED, require_columns

KEY = "external_ticket_id"
FIRST_WINS = ("summary", "details", "status")
LAST_WINS = ("priority", "category", "agent_id_pseudonym")
LAST_DATE_WINS = ("ticket_created_at", "ticket_updated_at", "ticket_closed_at")


def require_clean(batch: DataFrame, seq: str) -> None:
    """Only clean tickets, with an order column, may be merged."""
    require_columns(batch.drop(seq), CLEAN, "A batch to store")


def fold_changes(batch: DataFrame, seq: str = "seq") -> DataFrame:
    """One row per key of a batch: the columns that later rows change, the first row's place and ``batch_rows``. No texts.

    One aggregate, reduced in each task first, so neither texts nor a key that makes up much
    of a batch travel.
    """
    require_clean(batch, seq)
    folded = batch.groupBy(KEY).agg(
        F.min(seq).alias("_first"),
        F.max_by(F.struct(*LAST_WINS), seq).alias("_last"),
        *(F.max_by(d, F.when(F.col(d).isNotNull(), F.col(seq))).alias(d) for d in LAST_DATE_WINS),
        F.count(F.lit(1)).alias("batch_rows"),
    )
    return folded.select(KEY, "_first", "batch_rows", "_last.*", *LAST_DATE_WINS)


def pick_first(batch: DataFrame, firsts: DataFrame, seq: str = "seq") -> DataFrame:
    """(key, texts) of the rows at the places ``_first`` of ``firsts``. Joined by key and place, which no row shares with another."""
    at = firsts.select(KEY, F.col("_first").alias(seq))
    return batch.select(KEY, seq, *FIRST_WINS).join(at, [KEY, seq]).select(KEY, *FIRST_WINS)


def fold_batch(batch: DataFrame, seq: str = "seq") -> DataFrame:
    """One row per key of a batch, as if its rows were applied in order of ``seq``, which no two rows share."""
    folded = fold_changes(batch, seq)
    return folded.join(pick_first(batch, folded, seq), KEY).select(KEY, *FIRST_WINS, *LAST_WINS, *LAST_DATE_WINS, "batch_rows")


def merge(existing: DataFrame, batch: DataFrame, ingested_at: datetime | Column, seq: str = "seq") -> DataFrame:
    """Any table after the merge of a batch, with ``inserted`` marking rows whose key is new.

    One full outer join of sides with unique keys. The stored table of
    :mod:`guichet.sources.table` is laid out so that its own merge moves no text.
    """
    require_columns(existing, STORED, "The ticket table")
    stamp = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at).cast("timestamp")
    old = existing.withColumn("_known", F.lit(True)).alias("e")
    new = fold_batch(batch, seq).withColumns({"ingested_at": stamp, "_hit": F.lit(True)}).alias("b")
    joined = old.join(new, KEY, "full_outer")

    known, hit = F.col("e._known").isNotNull(), F.col("b._hit").isNotNull()
    columns = {KEY: F.col(KEY)}
    columns |= {n: F.when(known, F.col(f"e.{n}")).otherwise(F.col(f"b.{n}")) for n in (*FIRST_WINS, "ingested_at")}
    columns |= {n: F.when(hit, F.col(f"b.{n}")).otherwise(F.col(f"e.{n}")) for n in LAST_WINS}
    columns |= {n: F.coalesce(F.col(f"b.{n}"), F.col(f"e.{n}")) for n in LAST_DATE_WINS}
    return joined.select(*(columns[n].alias(n) for n in STORED.fieldNames()), (~known).alias("inserted"))


def classify(existing: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    """One row: batch rows, rows inserted (one per new key) and rows that updated or repeated a key."""
    folded = batch.groupBy(KEY).agg(F.count(F.lit(1)).alias("batch_rows"))
    known = existing.select(KEY).join(folded.select(KEY), KEY, "left_semi").withColumn("_known", F.lit(1))
    return (
        folded.join(known, KEY, "left")
        .agg(
            F.coalesce(F.sum("batch_rows"), F.lit(0)).alias("extracted_count"),
            F.count_if(F.col("_known").isNull()).alias("stored_count"),
        )
        .withColumn("ignored_count", F.col("extracted_count") - F.col("stored_count"))
    )
