"""Landed pages to stored tickets: map, clean, mask, gate, merge."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guichet.functions.pseudonym import DEFAULT_SECRET_VARIABLE
from guichet.operators import guardrails as G
from guichet.operators.mapping import to_incoming
from guichet.session import require_utc
from guichet.sources import storage, table
from guichet.sources.pages import unwrap_pages


@dataclass(frozen=True)
class IngestResult:
    """Counts of one ingest; nothing of its content."""

    extracted_count: int
    stored_count: int
    ignored_count: int
    status: str = "completed"
    #: rows whose identifier looked like personal data and was masked, so that keys may collide
    masked_key_count: int = 0


class MaskedKeyError(ValueError):
    """Identifiers look like personal data; masked, different tickets would share a key."""


def guard(incoming: DataFrame, *keep: str, with_pseudonym: bool = False, secret_variable: str = DEFAULT_SECRET_VARIABLE) -> DataFrame:
    """Incoming tickets as clean tickets, before the residual gate."""
    cleaned = G.clean_scan_fields(incoming)
    return G.to_storage(G.preprocess(cleaned, with_pseudonym, secret_variable), *keep)


def map_pages(pages: DataFrame, guarded: bool = False) -> DataFrame:
    """Incoming tickets of landed pages, with ``seq`` as their order."""
    incoming = to_incoming(unwrap_pages(pages), "page", "position", guarded=guarded)
    return incoming.withColumn("seq", F.struct("page", "position")).drop("page", "position")


def ingest_incoming(
    incoming: DataFrame,
    root: str,
    *,
    with_pseudonym: bool = False,
    secret_variable: str = DEFAULT_SECRET_VARIABLE,
    ingested_at: datetime | None = None,
    allow_masked_keys: bool = False,
) -> IngestResult:
    """Guard a batch and merge it into the table at ``root``, all of it or nothing.

    The guarded batch is written to a staging folder once, and the residual gate's
    counters are collected on the way. Only a batch with no finding is merged. The
    staging folder goes in any case.

    A batch with an identifier that had to be masked is refused, since ``[PHONE]`` may
    stand for many tickets; ``allow_masked_keys`` merges it all the same, by masked key.
    """
    guarded = guard(incoming, "seq", with_pseudonym=with_pseudonym, secret_variable=secret_variable)
    return _store(guarded, root, ingested_at, allow_masked_keys)


def _store(guarded: DataFrame, root: str, ingested_at: datetime | None, allow_masked_keys: bool) -> IngestResult:
    spark = guarded.sparkSession
    require_utc(spark)
    stamp = ingested_at or datetime.now(UTC).replace(tzinfo=None)
    scanned, seen = G.observe_residual(guarded)
    staging = f"{root.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    try:
        scanned.write.option("fs.permissions.umask-mode", storage.UMASK).parquet(staging)
        extracted = G.raise_on_residual(seen)
        if seen.get["masked_keys"] and not allow_masked_keys:
            raise MaskedKeyError(f"{seen.get['masked_keys']} rows have an identifier that looks like personal data")
        stored = table.save_batch(spark.read.parquet(staging), root, stamp)
    finally:
        storage.purge(spark, staging)
    return IngestResult(extracted, stored, extracted - stored, masked_key_count=seen.get["masked_keys"])


def ingest_pages(
    pages: DataFrame,
    root: str,
    *,
    with_pseudonym: bool = False,
    secret_variable: str = DEFAULT_SECRET_VARIABLE,
    ingested_at: datetime | None = None,
    allow_masked_keys: bool = False,
) -> IngestResult:
    """Ingest landed pages; see :func:`ingest_incoming` for the options.

    Texts are mapped, cleaned and masked in one pass; the residual gate looks at what is
    staged, as for any other batch.
    """
    tickets = G.without_agent(map_pages(pages, guarded=True), with_pseudonym, secret_variable)
    return _store(G.to_storage(tickets, "seq"), root, ingested_at, allow_masked_keys)
