"""The feature dataset: masked, normalised, cut text and calendar features."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from guichet import fixed_values as fv
from guichet.functions import text as X
from guichet.operators.scope import created_day, records_in_scope
from guichet.schema import FEATURES


def planned_columns() -> tuple[str, ...]:
    return fv.FEATURE_COLUMNS


def with_cleaned_text(records: DataFrame, out: str = "cleaned_text") -> DataFrame:
    """Adds summary and details as one masked, lower-case text with single spaces."""
    parts = [
        F.coalesce(F.col(f).cast("string"), F.lit("")) if f in records.columns else F.lit("") for f in fv.TEXT_FIELDS
    ]
    df = records.withColumn("_joined", F.concat_ws("\n", *parts))
    df = df.withColumn("_masked", X.mask(F.col("_joined")))
    return df.withColumn(out, X.squeeze(F.lower("_masked"))).drop("_joined", "_masked")


def build_features(records: DataFrame, min_created: date = fv.MIN_TICKET_CREATED_AT) -> DataFrame:
    """One feature row per record in scope.

    The text is masked whole and cut afterwards, so that no identifier is cut in
    two and missed.
    """
    day = created_day(records)
    scoped = records_in_scope(records, min_created).withColumn("_day", day)
    text = F.substring("cleaned_text", 1, fv.MAX_CLEANED_TEXT_CHARS)
    df = with_cleaned_text(scoped).select("_day", text.alias("cleaned_text_truncated"))

    text, length = F.col("cleaned_text_truncated"), F.char_length("cleaned_text_truncated")
    columns = {
        "cleaned_text_truncated": text,
        "created_month": F.month("_day"),
        "created_week": F.weekofyear("_day"),
        "created_day_of_week": F.weekday("_day"),
        "cleaned_text_length": length,
        "text_length_bucket": X.length_bucket(length),
        "has_email_placeholder": F.contains(text, F.lit(fv.PII_REPLACEMENTS["email"].lower())),
        "has_phone_placeholder": F.contains(text, F.lit(fv.PII_REPLACEMENTS["fr_phone"].lower())),
        "has_url_placeholder": F.contains(text, F.lit(fv.PII_REPLACEMENTS["url"].lower())),
    }
    return df.select(*(columns[name].alias(name) for name in FEATURES.fieldNames()))


def _with_findings(features: DataFrame) -> DataFrame:
    """Adds the number of detector and secret matches left in each feature text."""
    df = features.withColumn("_plain", X.normalise(F.coalesce("cleaned_text_truncated", F.lit(""))))
    secrets = X.count_secrets(F.coalesce("cleaned_text_truncated", F.lit("")))
    return df.withColumns({"_pii": X.count_pii(F.col("_plain")), "_secrets": secrets}).drop("_plain")


def _metrics():
    return [
        F.count(F.lit(1)).alias("transformed_count"),
        F.coalesce(F.sum("_pii"), F.lit(0)).alias("pii_official_residual_count"),
        F.coalesce(F.sum("_secrets"), F.lit(0)).alias("secret_scan_count"),
    ]


def feature_metrics(features: DataFrame) -> DataFrame:
    """One row: feature rows, detector matches and secret matches left in their text."""
    return _with_findings(features.select("cleaned_text_truncated")).agg(*_metrics())


def observe_features(features: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, with :func:`feature_metrics` collected while they are written."""
    seen = Observation()
    return _with_findings(features).observe(seen, *_metrics()).drop("_pii", "_secrets"), seen
