"""The quality report: every metric of :mod:`guichet.operators.eda` from one scan of the texts.

The counters of the whole table come from a second scan, of the creation date alone.

Rows are flagged once, then counted under several grouping sets at a time (the
whole, each controlled column, each period, each text length). What comes back is
a few rows per distinct value, from which one small aggregation builds the report.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from guichet import fixed_values as fv
from guichet.functions import text as X
from guichet.functions.patterns import JAVA_PII
from guichet.operators import eda
from guichet.operators.scope import CREATED, in_scope

_LENGTHS = {f: f"{f}_length" for f in fv.TEXT_FIELDS}
_KEYS = (*fv.DISTRIBUTION_COLUMNS, *fv.BUCKET_FORMATS, *_LENGTHS.values())
_ENDS = {"min": F.min, "max": F.max}
_PERIOD = T.ArrayType(T.StructType().add("period", "string").add("count", "long"))


class LeakError(ValueError):
    """A report would show a key or a marker that must stay inside."""


def _flagged(tickets: DataFrame, min_created: date) -> DataFrame:
    """Narrow rows: grouping keys, dates and one flag per counter. Text ends here."""
    df = in_scope(tickets, min_created).select(*fv.DISTRIBUTION_COLUMNS, *fv.TEMPORAL_COLUMNS, *fv.TEXT_FIELDS)
    df = eda.with_residual_flags(df)
    false = F.lit(False)
    flags = {f"{c}_null": F.col(c).isNull() for c in fv.DISTRIBUTION_COLUMNS + fv.TEMPORAL_COLUMNS}
    flags |= {f"{c}_blank": F.coalesce(F.trim(c) == "", false) for c in fv.DISTRIBUTION_COLUMNS + fv.TEXT_FIELDS}
    flags |= {f"has_{i}": eda._has_placeholder(p) for i, p in enumerate(fv.KNOWN_PLACEHOLDERS)}
    flags["untitled"] = F.coalesce(X.is_untitled(F.col("summary")), false)
    loose = (F.coalesce(X.looks_like_contact(F.col(f)), false) for f in fv.TEXT_FIELDS)
    flags["loose"] = reduce(or_, loose)
    kept = ["pii_any", *(f"pii_{n}" for n in JAVA_PII)]
    keys = [X.blank_to_null(F.col(c)).alias(c) for c in fv.DISTRIBUTION_COLUMNS]
    keys += [F.trunc(CREATED, g).alias(g) for g in fv.BUCKET_FORMATS]
    keys += [F.char_length(f).alias(name) for f, name in _LENGTHS.items()]
    return df.select(*keys, *fv.TEMPORAL_COLUMNS, *kept, *(c.alias(n) for n, c in flags.items()))


def _counted(flagged: DataFrame) -> DataFrame:
    """(section, slot, values, n, ...counters): counts per grouping set.

    Controlled values are folded to the number of values per count, so that a
    column with very many values stays small, and are not carried on by name.
    """
    flags = [f.name for f in flagged.schema if f.dataType == T.BooleanType()]
    counters = [F.count_if(f).alias(f) for f in flags]
    for c in fv.TEMPORAL_COLUMNS:
        counters += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    sets = [[]] + [[F.col(k)] for k in _KEYS]
    marks = [F.grouping(k).alias(f"_off_{k}") for k in _KEYS]
    rows = flagged.groupingSets(sets, *(F.col(k) for k in _KEYS)).agg(F.count(F.lit(1)).alias("n"), *counters, *marks)

    section, slot, seen = F.lit("all"), F.lit(None).cast("bigint"), F.lit(True)
    for k in _KEYS:
        on = F.col(f"_off_{k}") == 0
        section = F.when(on, k).otherwise(section)
        if k in fv.DISTRIBUTION_COLUMNS:
            slot = F.when(on, F.col("n")).otherwise(slot)
            seen = F.when(on, F.col(k).isNotNull()).otherwise(seen)
        elif k in fv.BUCKET_FORMATS:
            slot = F.when(on, F.unix_date(k)).otherwise(slot)
        else:
            slot = F.when(on, F.col(k)).otherwise(slot)
    rows = rows.withColumns({"section": section, "slot": slot, "_seen": seen}).filter("_seen")
    # A counter of the whole is at least that of any part, so the largest one is kept.
    kept = [F.max(f).alias(f) for f in flags]
    kept += [end(f"{c}_{name}").alias(f"{c}_{name}") for c in fv.TEMPORAL_COLUMNS for name, end in _ENDS.items()]
    return rows.groupBy("section", "slot").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("n"), *kept)


def _scope_row(tickets: DataFrame, min_created: date) -> DataFrame:
    """Counters over the whole table; reads the creation date only."""
    bound = F.lit(min_created.isoformat()).cast("timestamp")
    created = F.col(CREATED)
    return tickets.agg(
        F.lit("scope").alias("section"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(created < bound).alias("historical"),
        F.count_if(created.isNull()).alias("undated"),
    )


def _with_ranks(counted: DataFrame) -> DataFrame:
    """Adds ``rank``: how many values of a controlled column have at least this count.

    There are as many rows as different counts, which add up to the number of tickets:
    at most the square root of twice that number.
    """
    at_least = F.sum("values").over(Window.partitionBy("section").orderBy(F.col("slot").desc()))
    return counted.withColumn("rank", F.when(F.col("section").isin(*fv.DISTRIBUTION_COLUMNS), at_least))


def _runs(c: str) -> tuple[Column, Column]:
    """Number of distinct values of a controlled column, and the ranks that share a count, first ones first."""
    mine = F.col("section") == c
    run = F.struct((F.col("rank") - F.col("values") + 1).alias("first_rank"), F.col("rank").alias("last_rank"), F.col("slot").alias("count"))
    return F.coalesce(F.sum(F.when(mine, F.col("values"))), F.lit(0)), F.sort_array(F.collect_list(F.when(mine, run)))


def _distribution(c: str) -> Column:
    return F.struct(
        F.col(f"{c}_distinct").alias("distinct_count"),
        F.col(f"{c}_distinct").alias("non_null_distinct_count"),
        F.col(f"{c}_null").alias("null_count"),
        F.col(f"{c}_blank").alias("missing_count"),
        F.col(f"{c}_runs").alias("buckets"),
    )


def _length(field: str) -> Column:
    mine = F.col("section") == _LENGTHS[field]
    low, mean, high, p50, p90, p95, p99, _ = eda.length_summary(F.when(mine, F.col("slot")), F.when(mine, F.col("n")), F.lit(0))
    names = {"min": low, "mean": mean, "max": high, "p50": p50, "p90": p90, "p95": p95, "p99": p99}
    return F.struct(*(value.alias(name) for name, value in names.items()))


def _text_quality(field: str) -> Column:
    rate = eda.safe_rate(F.col(f"{field}_blank"), F.col("total"))
    return F.struct(F.col(f"{field}_lengths").alias("length"), rate.alias("empty_rate"))


def _buckets(granularity: str) -> Column:
    period = F.date_format(F.date_from_unix_date(F.col("slot").cast("int")), fv.BUCKET_FORMATS[granularity])
    entry = F.when(F.col("section") == granularity, F.struct(period.alias("period"), F.col("n").alias("count")))
    return F.sort_array(F.collect_list(entry)).cast(_PERIOD)


def _moment(c: str) -> Column:
    empty = F.col(f"{c}_null")
    return F.struct(
        eda.iso_second(F.col(f"{c}_min")).alias("min_at"),
        eda.iso_second(F.col(f"{c}_max")).alias("max_at"),
        (F.col("total") - empty).alias("populated_count"),
        empty.alias("null_count"),
        empty.alias("missing_count"),
    )


def _complete(c: str) -> Column:
    empty, none = F.col(f"{c}_null"), F.lit(0).cast("bigint")
    if c in fv.DISTRIBUTION_COLUMNS:
        missing, populated = F.col(f"{c}_blank"), F.col("total") - empty - F.col(f"{c}_blank")
    else:
        missing, populated = none if c == "ingested_at" else empty, F.col("total") - empty
    return F.struct(
        F.lit(c).alias("field"),
        populated.alias("populated_count"),
        empty.alias("null_count"),
        missing.alias("missing_count"),
        eda.safe_rate(populated, F.col("total")).alias("completeness_rate"),
    )


def _placeholder(i: int, label: str) -> Column:
    n = F.col(f"has_{i}")
    rate = eda.safe_rate(n, F.col("total"))
    return F.struct(F.lit(label).alias("placeholder"), n.alias("rows_with_placeholder"), rate.alias("rate"))


def build_report(tickets: DataFrame, min_created: date = fv.MIN_TICKET_CREATED_AT) -> DataFrame:
    """The whole report as one nested row, checked for leaks.

    The buckets of a controlled column are runs of ranks with the same count, so that a
    column with very many values fits; :func:`guichet.operators.eda.distributions` spells
    them out.
    """
    counted = _with_ranks(_counted(_flagged(tickets, min_created)))
    rows = counted.unionByName(_scope_row(tickets, min_created), allowMissingColumns=True)

    numbers = [f.name for f in counted.schema if f.dataType == T.LongType() and f.name not in ("slot", "values", "n", "rank")]
    zero = F.lit(0).cast("bigint")
    flat = [F.coalesce(F.max(name), zero).alias(name) for name in [*numbers, "historical", "undated"]]
    flat += [end(f"{c}_{name}").alias(f"{c}_{name}") for c in fv.TEMPORAL_COLUMNS for name, end in _ENDS.items()]
    for name, section in (("total", "all"), ("source", "scope")):
        flat.append(F.coalesce(F.max(F.when(F.col("section") == section, F.col("n"))), zero).alias(name))
    for c in fv.DISTRIBUTION_COLUMNS:
        distinct, runs = _runs(c)
        flat += [distinct.alias(f"{c}_distinct"), runs.alias(f"{c}_runs")]
    flat += [_length(f).alias(f"{f}_lengths") for f in fv.TEXT_FIELDS]
    flat += [_buckets(g).alias(f"by_{g}") for g in fv.BUCKET_FORMATS]

    total = F.col("total")
    categories = F.array(
        *(F.struct(F.lit(n).alias("category"), F.col(f"pii_{n}").alias("rows_with_residual")) for n in sorted(JAVA_PII))
    )
    report = rows.agg(*flat).select(
        total.alias("total_tickets"),
        F.col("source").alias("total_source_count"),
        total.alias("included_count"),
        F.col("historical").alias("excluded_historical_outlier_count"),
        F.col("undated").alias("excluded_missing_ticket_created_at_count"),
        F.lit(min_created.isoformat()).alias("applied_min_ticket_created_at"),
        *(_distribution(c).alias(f"{c}_distribution") for c in fv.DISTRIBUTION_COLUMNS),
        _text_quality("summary").alias("short_text"),
        _text_quality("details").alias("long_text"),
        eda.safe_rate(F.col("untitled"), total).alias("fallback_untitled_ticket_rate"),
        F.array(*(_placeholder(i, p) for i, p in enumerate(fv.KNOWN_PLACEHOLDERS))).alias("placeholder_counts"),
        F.struct(
            *(_moment(c).alias(c) for c in fv.TEMPORAL_COLUMNS),
            F.struct(*(F.col(f"by_{g}") for g in fv.BUCKET_FORMATS)).alias("ticket_created_buckets"),
        ).alias("temporal_distribution"),
        F.struct(
            total.alias("rows_scanned"),
            F.col("pii_any").alias("pii_residual_official_count"),
            eda.safe_rate(F.col("pii_any"), total).alias("residual_detection_rate"),
            F.filter(categories, lambda c: c["rows_with_residual"] > 0).alias("residual_categories"),
            F.col("loose").alias("heuristic_like_pattern_count"),
        ).alias("pii_scan"),
        F.array(*(_complete(c) for c in fv.DISTRIBUTION_COLUMNS + fv.TEMPORAL_COLUMNS)).alias("completeness"),
    )
    return _without_leaks(report)


# ---------------------------------------------------------------- leak check and output


def _names(kind: T.DataType) -> Iterator[str]:
    if isinstance(kind, T.ArrayType):
        yield from _names(kind.elementType)
    elif isinstance(kind, T.MapType):
        yield from _names(kind.valueType)
    elif isinstance(kind, T.StructType):
        for f in kind:
            yield f.name
            yield from _names(f.dataType)


def _without_leaks(report: DataFrame) -> DataFrame:
    """Refuses forbidden names in the schema now, and rows with a forbidden marker in any text when they are computed."""
    named = sorted({n for n in _names(report.schema) if n.lower() in fv.FORBIDDEN_OUTPUT_KEYS})
    if named:
        raise LeakError(f"These names may not be in a report: {', '.join(named)}")
    first, *rest = report.columns
    text = F.lower(F.to_json(F.struct(*report.columns)))
    marked = reduce(or_, (F.contains(text, F.lit(m)) for m in fv.FORBIDDEN_OUTPUT_TOKENS))
    checked = F.when(marked, F.raise_error(F.lit("A report text holds a marker that must stay inside"))).otherwise(F.col(first))
    return report.select(checked.cast(report.schema[first].dataType).alias(first), *rest)


def collect_report(report: DataFrame) -> dict:
    """The one row of a report as a dictionary."""
    return report.first().asDict(recursive=True)


def report_json(value: dict) -> str:
    """The same text for the same report."""
    return json.dumps(value, ensure_ascii=True, sort_keys=True)
