"""Intermediate tables in the folder that the cluster shares, and rows carried along whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guichet.session import bounded_batches, shared_folder

__all__ = ["bounded_batches", "carried", "restored", "written"]


def written(df: DataFrame) -> DataFrame:
    """The same rows, read back from a Parquet table in the shared folder.

    Cuts the lineage: what comes after survives lost executors without repeating what came before.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def carried(docs: DataFrame, *without: str) -> Column:
    """All columns of ``docs`` but some as one struct, so that no working column clashes with them."""
    return F.struct(*(F.col(f"`{c}`").alias(c) for c in docs.columns if c not in without)).alias("_doc")


def restored(docs: DataFrame, *without: str) -> list[Column]:
    """The columns that ``carried`` packed."""
    return [F.col("_doc").getField(c).alias(c) for c in docs.columns if c not in without]
