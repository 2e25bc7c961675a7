"""Provider payloads to canonical tickets: an allowlist projection over VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guichet import fixed_values as fv
from guichet.functions import text as X
from guichet.functions.dates import parse_epoch, parse_iso
from guichet.schema import INCOMING

_NUMBERS = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)"


def _field(parent: Column, name: str) -> Column:
    """A member as VARIANT: NULL if absent, the variant null if JSON null."""
    return F.variant_get(parent, f"$.{name}", "variant")


def as_text(value: Column) -> Column:
    """Text of a JSON value. True, False and whole-valued fractions keep their usual spelling.

    Lists and objects come out as JSON.
    """
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(value.isNull() | F.is_variant_null(value), F.lit(None).cast("string"))
        .when(kind == "BOOLEAN", F.initcap(text))
        .when(kind.startswith("DECIMAL") & ~F.contains(text, F.lit(".")), F.concat(text, F.lit(".0")))
        .otherwise(text)
    )


def as_timestamp(value: Column) -> Column:
    """UTC timestamp of a provider date: ISO text, epoch seconds or milliseconds."""
    kind = F.schema_of_variant(value)
    return F.when(kind == "STRING", parse_iso(F.try_variant_get(value, "$", "string"))).when(
        kind.rlike(_NUMBERS), parse_epoch(F.try_variant_get(value, "$", "double"))
    )


#: canonical field -> provider names in order of preference
_TEXTS = {
    "external_ticket_id": fv.ID_FIELDS,
    "summary": fv.SUMMARY_FIELDS,
    "details": fv.DETAIL_FIELDS,
    "priority": fv.PRIORITY_FIELDS,
    "category": fv.CATEGORY_FIELDS,
}
_DATES = {
    "ticket_created_at": fv.CREATED_FIELDS,
    "ticket_updated_at": fv.UPDATED_FIELDS,
    "ticket_closed_at": fv.CLOSED_FIELDS,
}


def _first_present(parent: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(*(_field(parent, name) for name in names))


def _grouped(payload: Column, sources: dict[str, tuple[str, ...]], read) -> Column:
    """Array of arrays: per canonical field, its provider members read one by one."""
    fields = [F.array(*(_field(payload, name) for name in names)) for names in sources.values()]
    return F.transform(F.array(*fields), lambda members: F.transform(members, read))


def to_incoming(payloads: DataFrame, *keep: str, fail_without_id: bool = True, guarded: bool = False) -> DataFrame:
    """Canonical tickets of a ``payload`` column; fields outside the allowlist are dropped.

    With ``guarded`` the texts are what :func:`guichet.operators.guardrails.clean_scan_fields`
    and ``mask_text_fields`` would make of them, found in the same trip.

    A payload without an id fails the batch, or gives a NULL id for the caller to
    set aside. ``keep`` names further columns to carry along. All text fields of a
    ticket share one trip through the cleaning UDF.
    """
    payload = F.col("payload")
    agents = F.transform(F.array(*(_field(payload, n) for n in fv.AGENT_FIELDS)), as_text)
    df = payloads.select(
        *keep,
        _first_present(payload, fv.STATUS_FIELDS).alias("_status"),
        _grouped(payload, _TEXTS, as_text).alias("_texts"),
        _grouped(payload, _DATES, as_timestamp).alias("_dates"),
        X.first_text(agents).alias("agent_id"),
    )

    # The first status field present decides, even when it is null or blank.
    status = F.col("_status")
    is_object = F.schema_of_variant(status).startswith("OBJECT")
    df = df.withColumn("_status", F.when(is_object, _first_present(status, fv.STATUS_OBJECT_FIELDS)).otherwise(status))
    df = df.withColumn("_texts", F.concat("_texts", F.array(F.array(as_text(F.col("_status"))))))

    if guarded:
        masked = tuple(i for i, name in enumerate(_TEXTS) if name in fv.TEXT_FIELDS)
        df = X.with_first_stored(df, "_texts", "_clean", masked)
    else:
        df = X.with_first_clean(df, "_texts", "_clean")
    text = {name: F.get("_clean", i) for i, name in enumerate((*_TEXTS, "status"))}
    missing_id = F.raise_error(F.lit(f"Missing required ticket field: {fv.ID_FIELDS[0]}"))
    out = text | {
        "external_ticket_id": F.coalesce(text["external_ticket_id"], missing_id) if fail_without_id else text["external_ticket_id"],
        "summary": F.coalesce(text["summary"], F.lit(fv.UNTITLED_SUMMARY)),
        "details": F.coalesce(text["details"], F.lit("")),
        "status": F.coalesce(text["status"], F.lit(fv.UNKNOWN_STATUS)),
        "agent_id": F.col("agent_id"),
    }
    if guarded:
        out |= {name: F.coalesce(text[name], F.lit("")) for name in ("priority", "category")}
    for i, name in enumerate(_DATES):
        out[name] = F.get(F.filter(F.get("_dates", i), lambda d: d.isNotNull()), 0)
    return df.select(*keep, *(out[name].alias(name) for name in INCOMING.fieldNames()))
