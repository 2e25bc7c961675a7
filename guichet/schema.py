"""Column sets and types of tickets at each stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TEXT, _TIME = T.StringType(), T.TimestampType()


def _fields(required: tuple[str, ...], optional: tuple[str, ...], times: tuple[str, ...]) -> T.StructType:
    parts = [T.StructField(n, _TEXT, False) for n in required]
    parts += [T.StructField(n, _TEXT, True) for n in optional]
    parts += [T.StructField(n, _TIME, True) for n in times]
    return T.StructType(parts)


_REQUIRED = ("external_ticket_id", "summary", "details", "status")
_TIMES = ("ticket_created_at", "ticket_updated_at", "ticket_closed_at")

#: a ticket as mapped from a provider payload
INCOMING = _fields(_REQUIRED, ("priority", "category", "agent_id"), _TIMES)
#: a ticket that passed the guardrails
CLEAN = _fields(_REQUIRED, ("priority", "category", "agent_id_pseudonym"), _TIMES)
#: a row of the ticket table
STORED = _fields(_REQUIRED, ("priority", "category", "agent_id_pseudonym"), _TIMES + ("ingested_at",))

#: a row of the feature dataset
FEATURES = (
    T.StructType()
    .add("cleaned_text_truncated", "string")
    .add("created_month", "integer")
    .add("created_week", "integer")
    .add("created_day_of_week", "integer")
    .add("cleaned_text_length", "integer")
    .add("text_length_bucket", "string")
    .add("has_email_placeholder", "boolean")
    .add("has_phone_placeholder", "boolean")
    .add("has_url_placeholder", "boolean")
)


def same_columns(df: DataFrame, schema: T.StructType) -> bool:
    """Same names, order and types; nullability is not compared."""
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def require_columns(df: DataFrame, schema: T.StructType, what: str) -> None:
    if not same_columns(df, schema):
        raise TypeError(f"{what} must have exactly the columns {', '.join(schema.fieldNames())}")
