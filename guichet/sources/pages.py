"""Landed provider responses: JSON objects that hold a list of ticket payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guichet import fixed_values as fv


def read_pages(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Response bodies as (page, body), a whole file or, with ``one_per_line``, a line each.

    ``page`` orders responses, and with them later updates of a ticket: by file name,
    then by place in the file. Files must be named so that they sort in the order they
    were fetched. Large files should have a response per line, as they stay splittable.
    """
    return with_line(place_in_files(spark.read.text(path, wholetext=not one_per_line)))


def place_in_files(lines: DataFrame) -> DataFrame:
    """(file, block, body) of text files: what is known of a line's place when it is read."""
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("body"))


def with_line(placed: DataFrame) -> DataFrame:
    """(page, body) of :func:`place_in_files`, which must come right from the files.

    A block of a file is read by one task from its beginning to its end, so numbers that
    grow with the rows of a task order the lines of a block. They are compared within a
    block only, and do not depend on how files and blocks are dealt to tasks.
    """
    page = F.struct("file", "block", F.monotonically_increasing_id().alias("line"))
    return placed.select(page.alias("page"), "body")


def _items_of(body: Column) -> Column:
    """The list under the first container name that is present, even if it is empty."""
    chosen = None
    for name in fv.PAGE_CONTAINERS:
        present = F.variant_get(body, f"$.{name}", "variant").isNotNull()
        items = F.try_variant_get(body, f"$.{name}", "array<variant>")
        chosen = F.when(present, items) if chosen is None else chosen.when(present, items)
    return F.coalesce(chosen, F.raise_error(F.lit("Provider response did not include a ticket list")))


def unwrap_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """One row per ticket payload: the other columns, ``position`` and ``payload`` (VARIANT).

    Bodies that are not JSON, or hold no list, fail the job. List items that are
    not JSON objects are dropped.
    """
    others = [c for c in pages.columns if c != body]
    parsed = pages.select(*others, F.parse_json(body).alias("_body"))
    items = parsed.select(*others, F.posexplode(_items_of(F.col("_body"))).alias("position", "payload"))
    return items.filter(F.schema_of_variant("payload").startswith("OBJECT"))
