"""Life of stored rows around the table: promotion, rejects, import counters, retention.

Rows carry ``import_batch_id``, ``validation_status``, ``rejection_reason_code`` and
``data_retention_until``. Logs and counters hold numbers and codes, never content.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from guichet import fixed_values as fv
from guichet.functions.pseudonym import pseudonym
from guichet.operators.mapping import as_text, as_timestamp
from guichet.sources import storage

_PROVIDER_FIELDS = sorted(
    {
        *fv.ID_FIELDS,
        *fv.SUMMARY_FIELDS,
        *fv.DETAIL_FIELDS,
        *fv.STATUS_FIELDS,
        *fv.PRIORITY_FIELDS,
        *fv.CATEGORY_FIELDS,
        *fv.AGENT_FIELDS,
        *fv.CREATED_FIELDS,
        *fv.UPDATED_FIELDS,
        *fv.CLOSED_FIELDS,
    }
)


def promote(staging: DataFrame, curated: DataFrame, key: str = "external_ticket_id") -> DataFrame:
    """Validated rows with a retention date whose key is not in the curated table yet."""
    ready = staging.filter((F.col("validation_status") == "valid") & F.col("data_retention_until").isNotNull())
    return ready.join(curated.select(key), key, "left_anti").drop("validation_status", "rejection_reason_code")


def rejects_by_reason(staging: DataFrame) -> DataFrame:
    """(rejection_reason_code, records_rejected_count)"""
    rejected = staging.filter(F.col("validation_status") == "rejected")
    return rejected.groupBy("rejection_reason_code").agg(F.count(F.lit(1)).alias("records_rejected_count"))


def import_counters(staging: DataFrame) -> DataFrame:
    """(import_batch_id, records seen, accepted and rejected)"""
    return staging.groupBy("import_batch_id").agg(*_counters())


def _counters() -> list[Column]:
    status = F.col("validation_status")
    return [
        F.count(F.lit(1)).alias("records_seen_count"),
        F.count_if(status == "valid").alias("records_accepted_count"),
        F.count_if(status == "rejected").alias("records_rejected_count"),
    ]


def import_observed(staging: DataFrame, path: str) -> dict[str, int]:
    """Append a batch to its table and return its counters, which the writing job itself collects.

    The rows are read once. Counters come from the stage that writes, so a repeated task counts
    once. All zero for a batch without rows.
    """
    seen = Observation(f"import-{uuid.uuid4().hex}")
    staging.observe(seen, *_counters()).write.mode("append").parquet(path)
    return {name: int(n) for name, n in seen.get.items()}


def import_stream(staging: DataFrame, path: str, checkpoint: str, name: str = "import") -> list[dict[str, int]]:
    """Append all that a stream of staged rows has now, and return the counters of each of its batches with their batch_id."""
    observed = staging.observe(name, *_counters())
    query = observed.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    found = [(p.batchId, p.observedMetrics.get(name)) for p in query.recentProgress]
    return [{"batch_id": batch, **{k: int(v) for k, v in row.asDict().items()}} for batch, row in found if row is not None and row["records_seen_count"]]


def retained(stored: DataFrame, as_of: date) -> DataFrame:
    """Rows whose retention date has not passed, or is not set. The test is pushed into the scan."""
    until = F.col("data_retention_until")
    return stored.filter(until.isNull() | (until >= F.lit(as_of)))


def purge_log(stored: DataFrame, as_of: date, reason: str = "retention_deadline") -> DataFrame:
    """(import_batch_id, retention_deadline, purge_reason, scheduled_for, records_deleted_count) of rows past it."""
    due = stored.filter(F.col("data_retention_until") < F.lit(as_of))
    counts = due.groupBy("import_batch_id", F.col("data_retention_until").alias("retention_deadline"))
    return counts.agg(
        F.lit(reason).alias("purge_reason"),
        F.lit(as_of).alias("scheduled_for"),
        F.count(F.lit(1)).alias("records_deleted_count"),
    )


def payload_profile(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """(column, is_mapped, payloads): which members landed payloads have, and whether the mapping reads them."""
    members = F.map_keys(F.variant_get(F.col(column), "$", "map<string,variant>"))
    counts = payloads.select(F.explode(members).alias("column")).groupBy("column").agg(F.count(F.lit(1)).alias("payloads"))
    return counts.select("column", F.col("column").isin(*_PROVIDER_FIELDS).alias("is_mapped"), "payloads")


def rejected_fields(payloads: DataFrame, batch: str, column: str = "payload") -> DataFrame:
    """(batch, fields_seen_count, fields_rejected_count): members of the payloads of a batch, and those the mapping drops."""
    members = F.map_keys(F.variant_get(F.col(column), "$", "map<string,variant>"))
    dropped = F.size(F.filter(members, lambda m: ~m.isin(*_PROVIDER_FIELDS)))
    return payloads.groupBy(batch).agg(F.sum(F.size(members)).alias("fields_seen_count"), F.sum(dropped).alias("fields_rejected_count"))


def mapping_errors(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """One row: payloads, those without an identifier, and those with a date member that cannot be read, by date."""

    def members(names: tuple[str, ...]):
        return F.array(*(F.variant_get(F.col(column), f"$.{n}", "variant") for n in names))

    ids = F.transform(members(fv.ID_FIELDS), as_text)
    counts = [F.count(F.lit(1)).alias("payload_count"), F.count_if(~F.exists(ids, lambda t: F.coalesce(F.trim(t), F.lit("")) != "")).alias("missing_id_count")]
    for name, fields in (("created", fv.CREATED_FIELDS), ("updated", fv.UPDATED_FIELDS), ("closed", fv.CLOSED_FIELDS)):
        unread = F.exists(members(fields), lambda v: v.isNotNull() & ~F.is_variant_null(v) & as_timestamp(v).isNull())
        counts.append(F.count_if(F.coalesce(unread, F.lit(False))).alias(f"unreadable_{name}_count"))
    return payloads.agg(*counts)


def purge_expired(spark: SparkSession, path: str, as_of: date, log_path: str, reason: str = "retention_deadline") -> int:
    """Rewrite a table without the rows past their retention date; returns how many went.

    The log of what goes is appended first, then the rows that stay are written hidden and
    moved into place; a purge that broke off in between is repeated and logged again.
    """
    storage.settle(spark, path)
    stored = spark.read.parquet(path)
    gone = stored.filter(F.col("data_retention_until") < F.lit(as_of)).count()
    if gone:
        purge_log(stored, as_of, reason).write.mode("append").parquet(log_path)
        draft = f"{path.rstrip('/')}-draft-{uuid.uuid4().hex}"
        try:
            retained(stored, as_of).write.parquet(draft)
            storage.move(spark, draft, path)
        except Exception:
            storage.purge(spark, draft)
            raise
    return gone


_DEADLINE = "data_retention_until"


def store_by_deadline(rows: DataFrame, path: str) -> None:
    """Append rows to a table with a folder per retention date; rows without one have a folder of their own.

    Rows are gathered by date before they are written, in files of the session's partition
    size: a date that most rows have is several files, and a rare one is one.
    """
    rows.hint("rebalance", F.col(_DEADLINE)).write.mode("append").partitionBy(_DEADLINE).parquet(path)


def expired_folders(spark: SparkSession, path: str, as_of: date) -> list[str]:
    """The folders of a table by deadline whose date has passed, oldest first."""
    prefix, out = f"{_DEADLINE}=", []
    for name in storage.list_folder(spark, path):
        try:
            passed = name.startswith(prefix) and date.fromisoformat(name[len(prefix) :]) < as_of
        except ValueError:  # rows without a date
            continue
        if passed:
            out.append(f"{path.rstrip('/')}/{name}")
    return out


def drop_expired(spark: SparkSession, path: str, as_of: date, log_path: str, reason: str = "retention_deadline") -> int:
    """Remove the expired folders of a table by deadline; returns how many rows went.

    Only these folders are read, for the log, which is appended first; rows that stay are neither
    read nor moved. A purge that broke off is repeated for the folders still there.
    """
    folders = expired_folders(spark, path, as_of)
    if not folders:
        return 0
    log = purge_log(spark.read.option("basePath", path).parquet(*folders), as_of, reason)
    gone = Observation(f"purge-{uuid.uuid4().hex}")
    log.observe(gone, F.coalesce(F.sum("records_deleted_count"), F.lit(0)).alias("n")).write.mode("append").parquet(log_path)
    for folder in folders:
        storage.purge(spark, folder)
    return int(gone.get["n"])


def pseudonymised(rows: DataFrame, secret: bytes, *columns: str, domains: tuple[str, ...] = ()) -> DataFrame:
    """Columns replaced by their pseudonyms; of the addresses in ``domains`` the part behind the sign alone, lower-cased."""
    made = {c: pseudonym(F.col(c).cast("string"), secret) for c in columns}
    made |= {c: pseudonym(F.lower(F.nullif(F.substring_index(F.col(c), "@", -1), F.col(c))), secret) for c in domains}
    return rows.withColumns(made)


def log_predictions(predictions: DataFrame, path: str, secret: bytes, model_version: str, key: str = "external_ticket_id") -> None:
    """Append (ticket_pseudonym, score, model_version, logged_at): no content and no identifier."""
    predictions.select(
        pseudonym(F.col(key).cast("string"), secret).alias("ticket_pseudonym"),
        F.col("score").cast("double").alias("score"),
        F.lit(model_version).alias("model_version"),
        F.current_timestamp().alias("logged_at"),
    ).write.mode("append").parquet(path)
