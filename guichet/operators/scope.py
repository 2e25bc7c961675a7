"""Which tickets count: an inclusive lower bound on the creation date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from guichet import fixed_values as fv
from guichet.functions.dates import utc_date

CREATED = "ticket_created_at"


def _boundary(min_created: date) -> Column:
    return F.lit(min_created.isoformat()).cast("timestamp")


def in_scope(tickets: DataFrame, min_created: date = fv.MIN_TICKET_CREATED_AT) -> DataFrame:
    """Stored tickets created on or after the boundary; the test is pushed into the scan."""
    return tickets.filter(F.col(CREATED) >= _boundary(min_created))


def historical_outliers(tickets: DataFrame, min_created: date = fv.MIN_TICKET_CREATED_AT) -> DataFrame:
    return tickets.filter(F.col(CREATED) < _boundary(min_created))


def missing_created(tickets: DataFrame) -> DataFrame:
    return tickets.filter(F.col(CREATED).isNull())


def created_day(records: DataFrame) -> Column:
    """Creation day of loose records, whose column may be text, a date, a timestamp or absent."""
    types = dict(records.dtypes)
    if CREATED not in types:
        return F.lit(None).cast("date")
    return utc_date(F.col(CREATED), types[CREATED])


def records_in_scope(records: DataFrame, min_created: date = fv.MIN_TICKET_CREATED_AT) -> DataFrame:
    """Loose records whose creation date parses and is not before the boundary."""
    return records.filter(created_day(records) >= F.lit(min_created))


def scope_counts(records: DataFrame, min_created: date = fv.MIN_TICKET_CREATED_AT) -> DataFrame:
    """One row: total, included, historical and undated records, and the boundary."""
    counters = _scope_counters(min_created)
    return records.select(created_day(records).alias("_day")).agg(*counters, F.lit(min_created.isoformat()).alias("applied_min_ticket_created_at"))


def _scope_counters(min_created: date) -> list[Column]:
    day, bound = F.col("_day"), F.lit(min_created)
    return [
        F.count(F.lit(1)).alias("total_source_count"),
        F.count_if(day >= bound).alias("included_count"),
        F.count_if(day < bound).alias("excluded_historical_outlier_count"),
        F.count_if(day.isNull()).alias("excluded_missing_ticket_created_at_count"),
    ]


def observe_scope(records: DataFrame, min_created: date = fv.MIN_TICKET_CREATED_AT) -> tuple[DataFrame, Observation]:
    """The same records, with :func:`scope_counts` collected while they are worked on."""
    seen = Observation()
    return records.withColumn("_day", created_day(records)).observe(seen, *_scope_counters(min_created)).drop("_day"), seen
