"""The ticket table: readers, paging, an append sink and two demo rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guichet import fixed_values as fv
from guichet.operators.scope import in_scope
from guichet.schema import CLEAN, INCOMING, STORED, require_columns


def read_tickets(spark: SparkSession, path: str) -> DataFrame:
    """Stored tickets. Columns added to the schema since a file was written read as NULL."""
    return spark.read.schema(STORED).parquet(path)


def read_tickets_jdbc(
    spark: SparkSession,
    url: str,
    table: str = "clean_tickets",
    *,
    partitions: int = 64,
    lower_id: int,
    upper_id: int,
    **options: str,
) -> DataFrame:
    """Stored tickets from a database, read in parallel ranges of its numeric id."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    ranges = {"partitionColumn": "id", "lowerBound": lower_id, "upperBound": upper_id, "numPartitions": partitions}
    return reader.options(**ranges).load().select(*STORED.fieldNames())


def append_tickets(tickets: DataFrame, path: str) -> None:
    """Add clean tickets to a folder as they are, without looking at keys."""
    require_columns(tickets, CLEAN, "Stored tickets")
    tickets.write.mode("append").parquet(path)


def page_slice(df: DataFrame, order: list[Column | str], page_size: int, page_no: int = 1) -> DataFrame:
    """Rows of one page under a total order; pages count from 1."""
    if page_size < 1 or page_no < 1:
        raise ValueError("page_size and page_no must be at least 1")
    return df.orderBy(*order).offset((page_no - 1) * page_size).limit(page_size)


def text_pairs(tickets: DataFrame, min_created: date = fv.MIN_TICKET_CREATED_AT) -> DataFrame:
    """Summary and details of tickets in scope, never NULL, for scans that return counts only."""
    return in_scope(tickets, min_created).select(
        *(F.coalesce(F.col(name), F.lit("")).alias(name) for name in fv.TEXT_FIELDS)
    )


def page_after_key(df: DataFrame, key: str, page_size: int, after: object = None) -> DataFrame:
    """The next rows by a unique key after the last one seen; the first page without one.

    The key is filtered in the scan and each task keeps one page, however deep the page is.
    """
    if page_size < 1:
        raise ValueError("page_size must be at least 1")
    rest = df if after is None else df.filter(F.col(key) > F.lit(after))
    return rest.orderBy(key).limit(page_size)


def synthetic_tickets(spark: SparkSession) -> DataFrame:
    """Two made-up tickets for trying out an ingest."""
    rows = [
        ("demo-1", "Scanner in the mail room jams", "Every third envelope stays in the tray.", "open", "low", "hardware", "demo-agent-7"),
        ("demo-2", "Shared calendar shows no rooms", "The list is empty since the update.", "waiting", "high", "office", "demo-agent-8"),
    ]
    return spark.createDataFrame([(*r, None, None, None) for r in rows], INCOMING)
