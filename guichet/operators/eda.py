"""Aggregate-only quality metrics over stored tickets. No result shows a ticket's content.

Each function takes the ticket table and an inclusive lower bound for the creation
date, and aggregates before anything else: values are counted per value, lengths
per length, and ranks and percentiles are derived from those counts.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guichet import fixed_values as fv
from guichet.functions import text as X
from guichet.functions.patterns import JAVA_PII
from guichet.operators.scope import CREATED, historical_outliers, in_scope, missing_created

_DEFAULT = fv.MIN_TICKET_CREATED_AT
_RANKS_PER_ROW = 65_536


def safe_rate(count: Column, total: Column) -> Column:
    """count / total, 0 when there is nothing to count."""
    return F.when(total > 0, count / total).otherwise(F.lit(0.0))


def _require(column: str, allowed: Iterable[str], what: str) -> None:
    if column not in allowed:
        raise ValueError(f"{column} is not open to {what}; these are: {', '.join(allowed)}")


# ---------------------------------------------------------------- counts


def count_included(tickets: DataFrame, min_created: date = _DEFAULT) -> DataFrame:
    return in_scope(tickets, min_created).agg(F.count(F.lit(1)).alias("included_count"))


def count_source(tickets: DataFrame) -> DataFrame:
    return tickets.agg(F.count(F.lit(1)).alias("total_source_count"))


def count_historical(tickets: DataFrame, min_created: date = _DEFAULT) -> DataFrame:
    counted = historical_outliers(tickets, min_created)
    return counted.agg(F.count(F.lit(1)).alias("excluded_historical_outlier_count"))


def count_missing_created(tickets: DataFrame) -> DataFrame:
    return missing_created(tickets).agg(F.count(F.lit(1)).alias("excluded_missing_ticket_created_at_count"))


# ---------------------------------------------------------------- distributions


def rank_counts(counts: DataFrame, *by: str) -> DataFrame:
    """(by..., bucket_rank, ticket_count) from per-value counts ``n``, largest first.

    Labels are not shown, so values with equal counts are interchangeable and only
    the number of values per count matters. The window therefore sorts distinct
    *counts* (at most the square root of twice the table's rows), never values, and
    each run of equal counts is spelled out afterwards.
    """
    runs = counts.groupBy(*by, "n").agg(F.count(F.lit(1)).alias("values"))
    upto = Window.partitionBy(*by).orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = runs.withColumn("last", F.sum("values").over(upto))
    first = F.col("last") - F.col("values") + 1
    blocks = runs.select(*by, "n", "last", F.explode(F.sequence(first, "last", F.lit(_RANKS_PER_ROW))).alias("start"))
    stop = F.least(F.col("start") + (_RANKS_PER_ROW - 1), F.col("last"))
    ranks = blocks.select(*by, F.explode(F.sequence("start", stop)).alias("bucket_rank"), F.col("n").alias("ticket_count"))
    return ranks.orderBy(*by, "bucket_rank")


def distribution(tickets: DataFrame, column: str, min_created: date = _DEFAULT) -> DataFrame:
    """(bucket_rank, ticket_count) of the trimmed, non-blank values of one controlled column."""
    _require(column, fv.DISTRIBUTION_COLUMNS, "distributions")
    values = in_scope(tickets, min_created).select(X.blank_to_null(F.col(column)).alias("value"))
    return rank_counts(values.filter(F.col("value").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("n")))


def _dimension_counts(tickets: DataFrame, min_created: date) -> DataFrame:
    """(dimension, value, blank, n): all controlled columns counted in one pass."""
    entry = [
        F.struct(
            F.lit(c).alias("dimension"),
            X.blank_to_null(F.col(c)).alias("value"),
            F.col(c).isNotNull().alias("present"),
        )
        for c in fv.DISTRIBUTION_COLUMNS
    ]
    entries = in_scope(tickets, min_created).select(F.inline(F.array(*entry)))
    return entries.groupBy("dimension", "value", "present").agg(F.count(F.lit(1)).alias("n"))


def distributions(tickets: DataFrame, min_created: date = _DEFAULT) -> DataFrame:
    """(dimension, bucket_rank, ticket_count) of all controlled columns in one pass."""
    counts = _dimension_counts(tickets, min_created).filter(F.col("value").isNotNull())
    return rank_counts(counts, "dimension")


def distribution_counts(tickets: DataFrame, min_created: date = _DEFAULT) -> DataFrame:
    """(dimension, distinct_count, non_null_distinct_count, null_count, missing_count)."""
    n, value, present = F.col("n"), F.col("value"), F.col("present")
    return (
        _dimension_counts(tickets, min_created)
        .groupBy("dimension")
        .agg(
            F.count_if(value.isNotNull()).alias("distinct_count"),
            F.count_if(value.isNotNull()).alias("non_null_distinct_count"),
            F.sum(F.when(~present, n).otherwise(0)).alias("null_count"),
            F.sum(F.when(present & value.isNull(), n).otherwise(0)).alias("missing_count"),
        )
    )


# ---------------------------------------------------------------- text quality


def length_summary(length: Column, n: Column, blank: Column) -> list[Column]:
    """Aggregates of a histogram of text lengths; 0 on an empty one."""

    def zero(c: Column, name: str) -> Column:
        return F.coalesce(c, F.lit(0)).alias(name)

    weighted = F.sum(F.when(length.isNotNull(), n))
    p = F.percentile(length, list(fv.TEXT_PERCENTILES), n)
    return [
        zero(F.min(length), "min_length"),
        zero(F.sum(length * n) / weighted, "mean_length"),
        zero(F.max(length), "max_length"),
        *(zero(F.get(p, i), f"p{int(q * 100)}") for i, q in enumerate(fv.TEXT_PERCENTILES)),
        zero(F.sum(blank) / F.sum(n), "empty_rate"),
    ]


def text_quality(tickets: DataFrame, *columns: str, min_created: date = _DEFAULT) -> DataFrame:
    """(field, lengths, empty_rate) per text column: minimum, mean, maximum and exact percentiles.

    All columns are read in one pass. The percentiles interpolate between lengths, and are
    taken from the number of texts per length, which is small however many texts there are.
    """
    for column in columns:
        _require(column, fv.TEXT_FIELDS, "text scans")
    entry = [F.struct(F.lit(c).alias("field"), F.char_length(c).alias("length"), (F.trim(c) == "").alias("blank")) for c in columns]
    lengths = in_scope(tickets, min_created).select(F.inline(F.array(*entry)))
    per_length = lengths.groupBy("field", "length").agg(F.count(F.lit(1)).alias("n"), F.count_if("blank").alias("blank"))
    listed = tickets.sparkSession.createDataFrame([(c,) for c in columns], "field string")
    found = per_length.groupBy("field").agg(*length_summary(F.col("length"), F.col("n"), F.col("blank")))
    return listed.join(F.broadcast(found), "field", "left").na.fill(0)


def untitled_rate(tickets: DataFrame, min_created: date = _DEFAULT) -> DataFrame:
    flag = X.is_untitled(F.col("summary"))
    counted = in_scope(tickets, min_created).agg(F.count_if(flag).alias("n"), F.count(F.lit(1)).alias("total"))
    return counted.select(safe_rate(F.col("n"), F.col("total")).alias("fallback_untitled_ticket_rate"))


def _has_placeholder(placeholder: str) -> Column:
    return reduce(or_, (F.coalesce(F.contains(F.col(f), F.lit(placeholder)), F.lit(False)) for f in fv.TEXT_FIELDS))


def placeholder_metrics(tickets: DataFrame, min_created: date = _DEFAULT) -> DataFrame:
    """(placeholder, rows_with_placeholder, rate), all placeholders in one pass."""
    counts = in_scope(tickets, min_created).agg(
        F.count(F.lit(1)).alias("total"),
        F.array(*(F.count_if(_has_placeholder(p)) for p in fv.KNOWN_PLACEHOLDERS)).alias("rows"),
    )
    labels = F.array(*(F.lit(p) for p in fv.KNOWN_PLACEHOLDERS))
    listed = counts.select("total", F.inline(F.arrays_zip(labels.alias("placeholder"), F.col("rows"))))
    return listed.select(
        F.col("placeholder"),
        F.col("rows").alias("rows_with_placeholder"),
        safe_rate(F.col("rows"), F.col("total")).alias("rate"),
    )


# ---------------------------------------------------------------- time


def iso_second(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _field_aggregates(column: str) -> Column:
    c = F.col(column)
    return F.struct(
        F.lit(column).alias("field"),
        iso_second(F.min(c)).alias("min_at"),
        iso_second(F.max(c)).alias("max_at"),
        F.count_if(c.isNotNull()).alias("populated_count"),
        F.count_if(c.isNull()).alias("null_count"),
        F.count_if(c.isNull()).alias("missing_count"),
    )


def temporal_fields(tickets: DataFrame, min_created: date = _DEFAULT, columns: Iterable[str] = fv.TEMPORAL_COLUMNS) -> DataFrame:
    """(field, min_at, max_at, populated_count, null_count, missing_count) per date column, in one pass."""
    columns = tuple(columns)
    for column in columns:
        _require(column, fv.TEMPORAL_COLUMNS, "date counts")
    one_row = in_scope(tickets, min_created).agg(F.array(*(_field_aggregates(c) for c in columns)).alias("fields"))
    return one_row.select(F.inline("fields"))


def created_buckets(tickets: DataFrame, granularity: str, min_created: date = _DEFAULT) -> DataFrame:
    """(period, ticket_count) per month or year of creation; periods without tickets are left out."""
    if granularity not in fv.BUCKET_FORMATS:
        raise ValueError(f"No buckets by {granularity}; there are: {', '.join(fv.BUCKET_FORMATS)}")
    starts = in_scope(tickets, min_created).select(F.trunc(CREATED, granularity).alias("bucket_start"))
    counts = starts.groupBy("bucket_start").agg(F.count(F.lit(1)).alias("ticket_count"))
    period = F.date_format("bucket_start", fv.BUCKET_FORMATS[granularity])
    return counts.orderBy("bucket_start").select(period.alias("period"), "ticket_count")


# ---------------------------------------------------------------- completeness


def _completeness_aggregates(column: str) -> Column:
    c = F.col(column)
    if column in fv.DISTRIBUTION_COLUMNS:
        populated, missing = F.count_if(F.trim(c) != ""), F.count_if(F.trim(c) == "")
    else:
        populated = F.count_if(c.isNotNull())
        missing = F.lit(0).cast("bigint") if column == "ingested_at" else F.count_if(c.isNull())
    return F.struct(
        F.lit(column).alias("field"),
        populated.alias("populated_count"),
        F.count_if(c.isNull()).alias("null_count"),
        missing.alias("missing_count"),
    )


def completeness(tickets: DataFrame, min_created: date = _DEFAULT) -> DataFrame:
    """(field, populated_count, null_count, missing_count, completeness_rate) per field that may be shown."""
    columns = fv.DISTRIBUTION_COLUMNS + fv.TEMPORAL_COLUMNS
    one_row = in_scope(tickets, min_created).agg(
        F.count(F.lit(1)).alias("total"), F.array(*(_completeness_aggregates(c) for c in columns)).alias("fields")
    )
    listed = one_row.select("total", F.inline("fields"))
    rate = safe_rate(F.col("populated_count"), F.col("total"))
    return listed.withColumn("completeness_rate", rate).drop("total")


# ---------------------------------------------------------------- personal data left


def heuristic_count(tickets: DataFrame, min_created: date = _DEFAULT) -> DataFrame:
    """Rows whose text loosely looks like an address or number; a diagnostic only."""
    hit = reduce(or_, (F.coalesce(X.looks_like_contact(F.col(f)), F.lit(False)) for f in fv.TEXT_FIELDS))
    return in_scope(tickets, min_created).agg(F.count_if(hit).alias("rows_with_heuristic_like_pattern"))


def with_residual_flags(tickets: DataFrame) -> DataFrame:
    """Adds a flag ``pii_<category>`` per detector category, over summary and details, and ``pii_any``."""
    texts = {f"_n_{f}": X.normalise(F.coalesce(F.col(f), F.lit(""))) for f in fv.TEXT_FIELDS}
    df = tickets.withColumns(texts)
    flags = {
        f"pii_{name}": reduce(or_, (X.has_category(F.col(f"_n_{f}"), name) for f in fv.TEXT_FIELDS)) for name in JAVA_PII
    }
    df = df.withColumns(flags).drop(*texts)
    return df.withColumn("pii_any", reduce(or_, (F.col(name) for name in flags)))


def residual_scan(tickets: DataFrame, min_created: date = _DEFAULT) -> DataFrame:
    """One row: rows scanned, rows with personal data left, their rate, and rows per category found."""
    scanned = with_residual_flags(in_scope(tickets, min_created).select(*fv.TEXT_FIELDS))
    counts = scanned.agg(
        F.count(F.lit(1)).alias("rows_scanned"),
        F.count_if("pii_any").alias("pii_residual_official_count"),
        F.array(
            *(
                F.struct(F.lit(n).alias("category"), F.count_if(f"pii_{n}").alias("rows_with_residual"))
                for n in sorted(JAVA_PII)
            )
        ).alias("residual_categories"),
    )
    rate = safe_rate(F.col("pii_residual_official_count"), F.col("rows_scanned"))
    found = F.filter("residual_categories", lambda c: c["rows_with_residual"] > 0)
    return counts.select(
        "rows_scanned",
        "pii_residual_official_count",
        rate.alias("residual_detection_rate"),
        found.alias("residual_categories"),
    )


def residual_categories(tickets: DataFrame, min_created: date = _DEFAULT) -> DataFrame:
    """(category, rows_with_residual) of the categories found, by name."""
    return residual_scan(tickets, min_created).select(F.inline("residual_categories")).orderBy("category")
