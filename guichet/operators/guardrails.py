"""What a ticket must go through before it may be stored."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from guichet import fixed_values as fv
from guichet.functions import text as X
from guichet.functions.patterns import JAVA_PII
from guichet.functions.pseudonym import DEFAULT_SECRET_VARIABLE, pseudonym, secret_from_environment
from guichet.schema import CLEAN


class ResidualPiiError(ValueError):
    """Personal data is left after masking; names fields and categories, never values."""


class ForbiddenFieldError(ValueError):
    """A column that may not reach storage, or a date that is not a timestamp."""


def guardrail_view(incoming: DataFrame) -> DataFrame:
    """An incoming ticket without its carrying columns; ``agent_id`` stays, NULL if unset."""
    columns = [n for n in CLEAN.fieldNames() if n != "agent_id_pseudonym"]
    return incoming.select(*columns, *(["agent_id"] if "agent_id" in incoming.columns else []))


def mask_text_fields(df: DataFrame, fields: Iterable[str] = fv.TEXT_FIELDS) -> DataFrame:
    """Free text masked; NULL or absent text becomes empty, other columns pass."""
    fields = tuple(fields)
    absent = {f: F.lit("") for f in fields if f not in df.columns}
    if absent:
        df = df.withColumns(absent)
    masked = {f: F.coalesce(X.mask(F.col(f)), F.lit("")) for f in fields}
    return df.withColumns(masked)


def clean_scan_fields(df: DataFrame) -> DataFrame:
    """Provider clean-up of every field the residual scan covers; NULL becomes empty text."""
    present = [f for f in fv.RESIDUAL_SCAN_FIELDS if f in df.columns]
    return df.withColumns({f: X.clean(F.col(f)) for f in present})


def preprocess(df: DataFrame, with_pseudonym: bool = False, secret_variable: str = DEFAULT_SECRET_VARIABLE) -> DataFrame:
    """Text masked and ``agent_id`` dropped, or replaced by its pseudonym on request.

    Follow it by a residual gate: :func:`assert_no_residual_pii` on a table, or
    :func:`observe_residual` while writing one.
    """
    return without_agent(mask_text_fields(df), with_pseudonym, secret_variable)


def without_agent(df: DataFrame, with_pseudonym: bool = False, secret_variable: str = DEFAULT_SECRET_VARIABLE) -> DataFrame:
    """``agent_id`` dropped, or replaced by its pseudonym on request."""
    secret = secret_from_environment(secret_variable) if with_pseudonym else b""
    if "agent_id" not in df.columns:
        return df
    if with_pseudonym:
        df = df.withColumn("agent_id_pseudonym", pseudonym(F.col("agent_id"), secret))
    return df.drop("agent_id")


def to_storage(df: DataFrame, *keep: str) -> DataFrame:
    """The storage projection. Refuses raw payloads and identifiers, and dates that are not timestamps."""
    types = dict(df.dtypes)
    if any(name in types for name in fv.FORBIDDEN_STORAGE_FIELDS):
        raise ForbiddenFieldError("Forbidden storage fields detected")
    columns = []
    for field in CLEAN:
        if field.name not in types:
            if not field.nullable:
                raise ForbiddenFieldError(f"Required storage field is missing: {field.name}")
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif field.dataType.typeName() == "timestamp" and types[field.name] not in ("timestamp", "void"):
            raise ForbiddenFieldError("Business date fields must be timestamps")
        else:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return df.select(*keep, *columns)


# ---------------------------------------------------------------- residual scan


def _with_residual(df: DataFrame, fields: list[str]) -> DataFrame:
    """Adds ``_residual``: per field, the sorted categories still found in it."""
    texts = F.array(*(F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields))
    df = df.withColumn("_texts", texts).withColumn("_texts", X.normalise_each(F.col("_texts")))
    return df.withColumn("_residual", F.transform("_texts", X.pii_categories)).drop("_texts")


def residual_rows(df: DataFrame, key: str, fields: Iterable[str] = fv.TEXT_FIELDS) -> DataFrame:
    """(key, field, categories) of every field with personal data left."""
    fields = [f for f in fields if f in df.columns]
    found = _with_residual(df.select(key, *(f for f in fields if f != key)), fields)
    entries = F.arrays_zip(F.array(*(F.lit(f) for f in fields)).alias("field"), F.col("_residual").alias("categories"))
    return found.select(key, F.inline(entries)).filter(F.size("categories") > 0)


def _residual_metrics(fields: Iterable[str]) -> list[Column]:
    return [
        F.count_if(F.array_contains(F.get("_residual", i), category)).alias(f"{f}:{category}")
        for i, f in enumerate(fields)
        for category in sorted(JAVA_PII)
    ]


def _raise_on(counts: dict[str, int]) -> None:
    left = {name: n for name, n in counts.items() if ":" in name and n}
    if left:
        parts = ("field={}, categories={}, rows={}".format(*name.split(":"), n) for name, n in left.items())
        raise ResidualPiiError("Personal data left after masking: " + "; ".join(parts))


def assert_no_residual_pii(df: DataFrame, fields: Iterable[str] = fv.TEXT_FIELDS) -> None:
    """Run the scan as one aggregation and raise if anything is left."""
    fields = [f for f in fields if f in df.columns]
    counts = _with_residual(df.select(*fields), fields).agg(*_residual_metrics(fields)).first()
    _raise_on(counts.asDict())


def observe_residual(df: DataFrame, fields: Iterable[str] = fv.RESIDUAL_SCAN_FIELDS) -> tuple[DataFrame, Observation]:
    """The same rows, with the scan's counters collected while they are written.

    ``rows`` counts them, and ``masked_keys`` those whose identifier was itself
    masked: different tickets may then share one key.
    """
    fields = [f for f in fields if f in df.columns]
    seen = Observation()
    scanned = _with_residual(df, fields)
    masked = reduce(or_, (F.contains(F.col("external_ticket_id"), F.lit(p)) for p in fv.KNOWN_PLACEHOLDERS))
    counters = [F.count(F.lit(1)).alias("rows"), F.count_if(masked).alias("masked_keys")]
    scanned = scanned.observe(seen, *counters, *_residual_metrics(fields))
    return scanned.drop("_residual"), seen


def raise_on_residual(seen: Observation) -> int:
    """Check the counters after the write; returns the number of rows."""
    _raise_on(seen.get)
    return seen.get["rows"]


# ---------------------------------------------------------------- table constraints


def constraint_violations(stored: DataFrame) -> DataFrame:
    """One row: rows that break NOT NULL, the pseudonym format, or key uniqueness.

    Keys are counted per key before they are compared, so a key that holds a large
    share of the rows is reduced on the map side.
    """
    required = [f.name for f in CLEAN if not f.nullable]
    any_null = F.lit(False)
    for name in required:
        any_null = any_null | F.col(name).isNull()
    pseudo = F.col("agent_id_pseudonym")
    per_key = stored.groupBy("external_ticket_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(any_null).alias("nulls"),
        F.count_if(pseudo.isNotNull() & ~pseudo.startswith(fv.PSEUDONYM_PREFIX)).alias("bad"),
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("rows_with_null_required_field"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("rows_with_bad_pseudonym"),
        F.count_if((F.col("n") > 1) & F.col("external_ticket_id").isNotNull()).alias("duplicated_key_count"),
    )
