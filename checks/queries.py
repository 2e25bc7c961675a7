"""One query per operator over the generated tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle as O
from checks.tables import (
    BOUNDARY,
    SCOPE,
    STAMP,
    feature_records,
    load,
    payloads,
    raw_tickets,
    stored_tickets,
)
from guichet import fixed_values as fv
from guichet.functions import dates as D
from guichet.functions import text as X
from guichet.functions.pseudonym import pseudonym
from guichet.operators import classify, contract, eda, evaluation, features, guardrails, lifecycle, mapping, merge, pairs, redundancy, scope, similar, terms
from guichet.plans import dry_run, eda_report, export, ingest
from guichet.schema import CLEAN, STORED
from guichet.session import dropped, shared_folder, written
from guichet.sources import pages, storage, table, tickets
from guichet.streaming.ingest import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_SECRET = b"synthetic-hmac-input-material"


def check(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function name, with its SQL if it has one."""

    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return register


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), 6) for n in names})


def _stamp(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%d %H:%M:%S') AS {name}"


def _texts_of_dates(df: DataFrame) -> DataFrame:
    moments = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in moments})


# ---------------------------------------------------------------- sources

_STORED_SQL = "external_ticket_id, summary, details, status, priority, category, " + ", ".join(
    _stamp(c) for c in fv.TEMPORAL_COLUMNS
)


@check(O.with_tickets(f"SELECT {_STORED_SQL} FROM tickets"))
def stored_tickets_scan(spark, sf_dir):
    return _texts_of_dates(stored_tickets(spark, sf_dir))


@check(
    "SELECT external_ticket_id, summary, CAST(NULL AS VARCHAR) AS agent_id_pseudonym, "
    + f"CAST(count(*) AS BIGINT) AS n FROM ({O.with_tickets('SELECT * FROM tickets UNION ALL SELECT * FROM tickets')}) GROUP BY 1, 2"
)
def append_sink(spark, sf_dir):
    """Appended twice without looking at keys, read back under the table's schema."""
    folder = shared_folder(spark)
    batch = guardrails.to_storage(stored_tickets(spark, sf_dir).drop("ingested_at"))
    for _ in range(2):
        tickets.append_tickets(batch, folder)
    stored = tickets.read_tickets(spark, folder)
    return stored.groupBy("external_ticket_id", "summary", "agent_id_pseudonym").agg(F.count(F.lit(1)).alias("n"))


@check("SELECT doc_id, CAST(1 AS INT) AS position, doc_id AS id FROM documents d JOIN orders o ON o.o_orderkey = d.doc_id")
def landed_pages_unwrap(spark, sf_dir):
    items = pages.unwrap_pages(payloads(spark, sf_dir))
    return items.select("doc_id", "position", F.variant_get("payload", "$.id", "bigint").alias("id"))


@check(
    O.with_tickets(
        "SELECT external_ticket_id, status FROM tickets ORDER BY ticket_created_at DESC NULLS LAST, external_ticket_id LIMIT 25 OFFSET 50"
    )
)
def page_slice(spark, sf_dir):
    stored = stored_tickets(spark, sf_dir)
    order = [F.col("ticket_created_at").desc_nulls_last(), F.col("external_ticket_id")]
    return tickets.page_slice(stored, order, 25, 3).select("external_ticket_id", "status")


@check(
    O.with_tickets(
        "SELECT external_ticket_id, status FROM tickets WHERE external_ticket_id > '5' ORDER BY external_ticket_id LIMIT 40"
    )
)
def page_after_key(spark, sf_dir):
    return tickets.page_after_key(stored_tickets(spark, sf_dir), "external_ticket_id", 40, "5").select("external_ticket_id", "status")


@check(O.with_tickets("SELECT coalesce(summary, '') AS summary, coalesce(details, '') AS details FROM scoped"))
def text_pairs(spark, sf_dir):
    return tickets.text_pairs(stored_tickets(spark, sf_dir), BOUNDARY)


# ---------------------------------------------------------------- mapping

_MAPPED = f"""
mapped AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS external_ticket_id, {O.clean("text")} AS summary, {O.clean("text")} AS details,
    CASE doc_id % 4 WHEN 0 THEN o_orderstatus WHEN 1 THEN o_orderstatus WHEN 2 THEN 'unknown' ELSE CAST(doc_id AS VARCHAR) END AS status,
    CAST(NULL AS VARCHAR) AS priority, source AS category, CASE WHEN doc_id % 7 <> 0 THEN CAST(doc_id * 10 AS VARCHAR) END AS agent_id,
    o_orderdate AS ticket_created_at FROM documents d JOIN orders o ON o.o_orderkey = d.doc_id)
"""


@check(
    f"WITH {_MAPPED} SELECT external_ticket_id, summary, details, status, priority, category, agent_id, "
    f"{_stamp('ticket_created_at')}, CAST(NULL AS VARCHAR) AS ticket_updated_at, CAST(NULL AS VARCHAR) AS ticket_closed_at FROM mapped"
)
def payload_to_ticket(spark, sf_dir):
    return _texts_of_dates(mapping.to_incoming(pages.unwrap_pages(payloads(spark, sf_dir))))


@check(
    O.with_tickets(
        "SELECT external_ticket_id, "
        + ", ".join(f"{O.clean(f'coalesce({c}, {chr(39) * 2})')} AS {c}" for c in fv.RESIDUAL_SCAN_FIELDS[1:])
        + f", {_stamp('ticket_created_at')} FROM tickets"
    )
)
def guarded_tickets(spark, sf_dir):
    """Clean-up of all scanned fields, masking, and the storage projection."""
    guarded = ingest.guard(raw_tickets(spark, sf_dir).drop("ingested_at"))
    columns = [*fv.RESIDUAL_SCAN_FIELDS, "ticket_created_at"]
    return _texts_of_dates(guarded.select(*columns))


@check(O.with_tickets("SELECT external_ticket_id, status, priority, category, agent_id FROM tickets"))
def guardrail_view(spark, sf_dir):
    view = guardrails.guardrail_view(raw_tickets(spark, sf_dir))
    return view.select("external_ticket_id", "status", "priority", "category", "agent_id")


# ---------------------------------------------------------------- dates and pseudonyms

_DATE_KIND = "o_orderkey % 7"


@check(
    f"""SELECT o_orderkey, strftime(CASE {_DATE_KIND} WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate + INTERVAL 5 HOUR
        WHEN 2 THEN o_orderdate WHEN 3 THEN date_trunc('week', o_orderdate) WHEN 4 THEN o_orderdate + INTERVAL '10:30' HOUR_MINUTE
        END, '%Y-%m-%d %H:%M:%S') AS parsed FROM orders""".replace(
        "INTERVAL '10:30' HOUR_MINUTE", "INTERVAL 630 MINUTE"
    )
)
def parse_date_text(spark, sf_dir):
    """Extended, offset, basic, week and odd spellings of the order dates; two kinds do not parse."""
    day, kind = F.col("o_orderdate"), F.expr(_DATE_KIND)
    week = F.concat(F.expr("extract(YEAROFWEEK FROM o_orderdate)").cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))
    text = (
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 1, F.concat(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")))
        .when(kind == 2, F.date_format(day, " yyyyMMdd"))
        .when(kind == 3, week)
        .when(kind == 4, F.concat(F.date_format(day, "yyyyMMdd"), F.lit("x1030Z")))
        .when(kind == 5, F.date_format(day, "yyyy-MM"))
        .otherwise(F.lit("not-a-date"))
    )
    texts = load(spark, sf_dir, "orders").select("o_orderkey", text.alias("t"))
    return _texts_of_dates(texts.select("o_orderkey", D.parse_iso(F.col("t")).alias("parsed")))


@check(
    """SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE strftime(make_timestamp(CASE WHEN event_id % 3 = 0 THEN epoch_us(ts) // 1000 * 1000
       ELSE epoch_us(ts) // 1000000 * 1000000 END), '%Y-%m-%d %H:%M:%S.%f') END AS parsed FROM events"""
)
def parse_epoch(spark, sf_dir):
    """Event times as milliseconds, as seconds, and as negative numbers, which are no dates."""
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_id") % 3
    number = F.when(kind == 0, F.unix_millis(ts)).when(kind == 1, F.unix_seconds(ts)).otherwise(-F.unix_seconds(ts))
    numbers = load(spark, sf_dir, "events").select("event_id", number.alias("n"))
    return numbers.select("event_id", F.date_format(D.parse_epoch(F.col("n")), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"))


@check(
    "SELECT o_orderkey, 'hmac_sha256:' || sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode(CAST(o_custkey AS VARCHAR))))) "
    "AS agent_id_pseudonym FROM orders".format(
        outer=bytes(b ^ 0x5C for b in _SECRET.ljust(64, b"\0")).hex(), inner=bytes(b ^ 0x36 for b in _SECRET.ljust(64, b"\0")).hex()
    )
)
def pseudonyms(spark, sf_dir):
    agents = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("agent"))
    return agents.select("o_orderkey", pseudonym(F.col("agent"), _SECRET).alias("agent_id_pseudonym"))


# ---------------------------------------------------------------- text

_ALL_TEXT = "(SELECT 'd' || doc_id AS k, text AS x FROM documents UNION ALL SELECT 'p' || page_id, html FROM pages UNION ALL SELECT 'c' || conv_id || '.' || turn, text FROM conversations)"


def _all_text(spark, sf_dir) -> DataFrame:
    d, p, c = (load(spark, sf_dir, n) for n in ("documents", "pages", "conversations"))
    parts = d.select(F.concat(F.lit("d"), "doc_id").alias("k"), F.col("text").alias("x"))
    parts = parts.unionAll(p.select(F.concat(F.lit("p"), "page_id"), "html"))
    return parts.unionAll(c.select(F.concat(F.lit("c"), "conv_id", F.lit("."), "turn"), "text"))


@check(f"SELECT k, {O.unescape('x')} AS normalised FROM {_ALL_TEXT}")
def normalise_text(spark, sf_dir):
    return _all_text(spark, sf_dir).select("k", X.normalise(F.col("x")).alias("normalised"))


@check(f"SELECT k, {', '.join(f'{O.has(c, O.unescape(chr(120)))} AS {c}' for c in fv.PII_PATTERNS)} FROM {_ALL_TEXT}")
def detect_pii(spark, sf_dir):
    """A flag per category and text; all texts of the three text tables."""
    df = _all_text(spark, sf_dir).withColumn("n", X.normalise(F.col("x")))
    return df.select("k", *(X.has_category(F.col("n"), c).alias(c) for c in fv.PII_PATTERNS))


# Texts built from columns, so that every category, overlaps, wrappers, entities and full-width letters occur often.
_BUILT = """(SELECT o_orderkey AS k, CASE CAST(o_orderkey % 8 AS INT)
    WHEN 0 THEN 'login: user' || CAST(o_custkey AS STRING) || ', call 06 ' || substr(CAST(10000000 + o_orderkey AS STRING), 1, 2) || ' 34 56 78 now'
    WHEN 1 THEN 'mailto:c' || CAST(o_custkey AS STRING) || '@example.test or 10.0.' || CAST(o_orderkey % 256 AS STRING) || '.1'
    WHEN 2 THEN 'see https://shop.example.test/o/' || CAST(o_orderkey AS STRING) || ' <a' || CAST(o_custkey AS STRING) || '@mail.test>'
    WHEN 3 THEN 'user_id=x' || CAST(o_orderkey AS STRING) || '@corp.test and ' || o_orderpriority
    WHEN 4 THEN '<p>' || o_orderpriority || '</p> client_id #' || CAST(1000 + o_custkey AS STRING) || ' from 192.168.1.' || CAST(o_custkey % 256 AS STRING)
    WHEN 5 THEN 'b' || CAST(o_custkey AS STRING) || '&#64;host.example &amp;copy; ' || o_orderstatus
    WHEN 6 THEN 'ｑａ' || CAST(o_custkey AS STRING) || '＠ｅｘａｍｐｌｅ．ｔｅｓｔ und +33612345' || substr(CAST(100 + o_orderkey % 100 AS STRING), 2, 2)
    ELSE 'nothing but ' || o_orderpriority || ' in version 1.' || CAST(o_orderkey % 10 AS STRING) END AS x FROM orders)"""


def _built(spark, sf_dir) -> DataFrame:
    return spark.sql(_BUILT.strip("()").replace("FROM orders", "FROM {orders}"), orders=load(spark, sf_dir, "orders"))


def _narrow(text: str) -> str:
    """Entities and full-width signs of the built texts as normalisation gives them."""
    wide, plain = "ｑａｅｘｍｐｌｔｓ＠．", "qaexmplts@."
    return f"translate(replace(replace({text}, '&#64;', '@'), '&amp;', '&'), '{wide}', '{plain}')"


def _again(text: str) -> str:
    return f"replace({_narrow(text)}, '&copy;', '©')"


def _hits_sql(text: str) -> str:
    """Offsets of all matches of a category: lengths of the pieces between them and of the matches, added up."""
    parts = []
    for category in fv.PII_PATTERNS:
        pattern, flags = O.quote(O.BARE[category]), "gi" if category in O.IGNORE_CASE else "g"
        parts.append(
            f"""SELECT k, '{category}' AS category, unnest(range(1, len(found) + 1)) AS i, found, pieces FROM (SELECT k,
            regexp_extract_all(t, {pattern}, 0, '{flags[1:] or 'c'}') AS found,
            string_split(regexp_replace(t, {pattern}, chr(1), '{flags}'), chr(1)) AS pieces FROM (SELECT k, {text} AS t FROM texts))"""
        )
    return f"""SELECT k, category, CAST(list_sum(list_transform(pieces[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(found[1:i - 1],
        lambda m: length(m))), 0) AS INTEGER) AS start, CAST(list_sum(list_transform(pieces[1:i], lambda p: length(p)))
        + list_sum(list_transform(found[1:i], lambda m: length(m))) AS INTEGER) AS "end" FROM ({" UNION ALL ".join(parts)})"""


@check(
    f"WITH texts AS (SELECT 'o' || k AS k, {_narrow('x')} AS x FROM {_BUILT} UNION ALL SELECT k, {O.unescape('x')} FROM {_ALL_TEXT}) "
    f"SELECT * FROM ({_hits_sql('x')})"
)
def pii_hits(spark, sf_dir):
    """(k, category, start, end) of every hit in all texts of the three text tables and in texts built from columns."""
    built = _built(spark, sf_dir).select(F.concat(F.lit("o"), "k").alias("k"), "x")
    return _all_text(spark, sf_dir).unionAll(built).select("k", F.inline(X.pii_hits(F.col("x"))))


@check(
    f"""WITH texts AS {_BUILT}, h AS ({_hits_sql(_again('x'))}), o AS (SELECT *, coalesce(max("end") OVER (PARTITION BY k ORDER BY start, "end", category
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM h),
    p AS (SELECT k, category, start, max("end") OVER (PARTITION BY k, head) AS "end", head, new FROM (SELECT *, start >= before AS new,
      sum(CASE WHEN start >= before THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY start, "end", category) AS head FROM o)),
    c AS (SELECT *, coalesce(lag("end") OVER (PARTITION BY k ORDER BY start), 0) AS done FROM p WHERE new),
    m AS (SELECT c.k, string_agg(substr(t, done + 1, start - done) || CASE category {" ".join(f"WHEN {O.quote(c)} THEN {O.quote(v)}" for c, v in fv.PII_REPLACEMENTS.items())} END,
      '' ORDER BY start) AS head, max("end") AS last FROM c JOIN (SELECT k, {_again('x')} AS t FROM texts) t ON t.k = c.k GROUP BY c.k)
    SELECT texts.k, CASE WHEN m.k IS NULL THEN {_narrow('x')} ELSE m.head || substr({_again('x')}, last + 1) END AS masked FROM texts LEFT JOIN m ON m.k = texts.k"""
)
def mask_overlaps(spark, sf_dir):
    """Texts with hits that overlap, doubly escaped entities and full-width letters, masked."""
    return _built(spark, sf_dir).select("k", X.mask(F.col("x")).alias("masked"))


@check(
    f"""WITH texts AS {_BUILT}, h AS ({_hits_sql(_again('x'))}), f AS (SELECT k, category, min((start, "end", category)) AS place FROM h GROUP BY 1, 2)
    SELECT texts.k, coalesce(string_agg(category, ',' ORDER BY place), '') AS removed FROM texts LEFT JOIN f ON f.k = texts.k GROUP BY 1"""
)
def removed_in_order(spark, sf_dir):
    """The categories masking removes, in order of appearance."""
    return _built(spark, sf_dir).select("k", F.array_join(X.removed_categories(F.col("x")), ",").alias("removed"))


@check(f"SELECT k, {O.mask(O.unescape('x'))} AS masked FROM {_ALL_TEXT}")
def mask_text(spark, sf_dir):
    return _all_text(spark, sf_dir).select("k", X.mask(F.col("x")).alias("masked"))


@check(
    f"SELECT k, array_to_string(list_sort(list_filter([{', '.join(f'CASE WHEN {O.has(c, O.unescape(chr(120)))} THEN {O.quote(c)} END' for c in fv.PII_PATTERNS)}], "
    f"lambda v: v IS NOT NULL)), ',') AS removed FROM {_ALL_TEXT}"
)
def removed_categories(spark, sf_dir):
    removed = F.array_join(F.array_sort(X.removed_categories(F.col("x"))), ",")
    return _all_text(spark, sf_dir).select("k", removed.alias("removed"))


@check(f"SELECT k, {O.clean('x')} AS cleaned FROM {_ALL_TEXT}")
def clean_provider_text(spark, sf_dir):
    return _all_text(spark, sf_dir).select("k", X.clean(F.col("x")).alias("cleaned"))


@check(f"SELECT k, CAST({O.secrets('x')} AS BIGINT) AS secrets FROM {_ALL_TEXT}")
def count_secrets(spark, sf_dir):
    return _all_text(spark, sf_dir).select("k", X.count_secrets(F.col("x")).cast("bigint").alias("secrets"))


# ---------------------------------------------------------------- scope and counts


@check(O.with_tickets(f"SELECT external_ticket_id FROM tickets WHERE {SCOPE}"))
def tickets_in_scope(spark, sf_dir):
    return scope.in_scope(stored_tickets(spark, sf_dir), BOUNDARY).select("external_ticket_id")


@check(O.with_tickets("SELECT count(*) AS included_count FROM scoped"))
def count_included(spark, sf_dir):
    return eda.count_included(stored_tickets(spark, sf_dir), BOUNDARY)


@check(O.with_tickets("SELECT count(*) AS total_source_count FROM tickets"))
def count_source(spark, sf_dir):
    return eda.count_source(stored_tickets(spark, sf_dir))


@check(O.with_tickets(f"SELECT count(*) AS excluded_historical_outlier_count FROM tickets WHERE ticket_created_at < TIMESTAMP '{BOUNDARY} 00:00:00'"))
def count_historical(spark, sf_dir):
    return eda.count_historical(stored_tickets(spark, sf_dir), BOUNDARY)


@check(O.with_tickets("SELECT count(*) AS excluded_missing_ticket_created_at_count FROM tickets WHERE ticket_created_at IS NULL"))
def count_missing_created(spark, sf_dir):
    return eda.count_missing_created(stored_tickets(spark, sf_dir))


_SCOPE_COUNTS = f"""count(*) AS total_source_count, count(*) FILTER ({SCOPE}) AS included_count,
    count(*) FILTER (ticket_created_at < TIMESTAMP '{BOUNDARY} 00:00:00') AS excluded_historical_outlier_count,
    count(*) FILTER (ticket_created_at IS NULL) AS excluded_missing_ticket_created_at_count"""


@check(O.with_tickets(f"SELECT {_SCOPE_COUNTS}, '{BOUNDARY}' AS applied_min_ticket_created_at FROM tickets"))
def scope_counts(spark, sf_dir):
    return scope.scope_counts(feature_records(spark, sf_dir), BOUNDARY)


@check(O.with_tickets(f"SELECT summary, details, strftime(ticket_created_at, '%Y-%m-%dT%H:%M:%SZ') AS ticket_created_at FROM tickets WHERE {SCOPE}"))
def records_in_scope(spark, sf_dir):
    return scope.records_in_scope(feature_records(spark, sf_dir), BOUNDARY)


# ---------------------------------------------------------------- quality metrics


def _ranked(column: str) -> str:
    return f"""SELECT row_number() OVER (ORDER BY count(*) DESC, trim({column})) AS bucket_rank, count(*) AS ticket_count
        FROM scoped WHERE nullif(trim({column}), '') IS NOT NULL GROUP BY trim({column})"""


@check(O.with_tickets(_ranked("priority")))
def distribution_priority(spark, sf_dir):
    return eda.distribution(stored_tickets(spark, sf_dir), "priority", BOUNDARY)


@check(
    O.with_tickets(
        " UNION ALL ".join(f"SELECT '{c}' AS dimension, * FROM ({_ranked(c)})" for c in fv.DISTRIBUTION_COLUMNS)
    )
)
def distributions(spark, sf_dir):
    return eda.distributions(stored_tickets(spark, sf_dir), BOUNDARY)


@check(
    O.with_tickets(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS dimension, count(DISTINCT nullif(trim({c}), '')) AS distinct_count,
            count(DISTINCT nullif(trim({c}), '')) AS non_null_distinct_count, count(*) FILTER ({c} IS NULL) AS null_count,
            count(*) FILTER (trim({c}) = '') AS missing_count FROM scoped"""
            for c in fv.DISTRIBUTION_COLUMNS
        )
    )
)
def distribution_counts(spark, sf_dir):
    return eda.distribution_counts(stored_tickets(spark, sf_dir), BOUNDARY)


_QUANTILES = ", ".join(f"round(quantile_cont(length({{c}}), {q}), 6) AS p{int(q * 100)}" for q in fv.TEXT_PERCENTILES)


def _quality(c: str) -> str:
    return f"""SELECT '{c}' AS field, CAST(min(length({c})) AS BIGINT) AS min_length, round(avg(length({c})), 6) AS mean_length,
        CAST(max(length({c})) AS BIGINT) AS max_length, {_QUANTILES.format(c=c)},
        round(avg(CASE WHEN trim({c}) = '' THEN 1.0 ELSE 0.0 END), 6) AS empty_rate FROM scoped"""


@check(O.with_tickets(" UNION ALL ".join(_quality(c) for c in fv.TEXT_FIELDS)))
def text_quality(spark, sf_dir):
    df = eda.text_quality(stored_tickets(spark, sf_dir), *fv.TEXT_FIELDS, min_created=BOUNDARY)
    df = df.withColumns({n: F.col(n).cast("bigint") for n in ("min_length", "max_length")})
    return _rounded(df, "mean_length", "p50", "p90", "p95", "p99", "empty_rate")


@check(
    O.with_tickets(
        "SELECT round(avg(CASE WHEN lower(trim(summary)) = 'untitled ticket' THEN 1.0 ELSE 0.0 END), 6) AS fallback_untitled_ticket_rate "
        "FROM (SELECT CASE WHEN CAST(external_ticket_id AS BIGINT) % 5 = 0 THEN ' Untitled TICKET' ELSE summary END AS summary FROM scoped)"
    )
)
def untitled_rate(spark, sf_dir):
    """Every fifth ticket is given the fallback title, since the generated texts have none."""
    fifth = F.col("external_ticket_id").cast("bigint") % 5 == 0
    stored = stored_tickets(spark, sf_dir).withColumn("summary", F.when(fifth, " Untitled TICKET").otherwise(F.col("summary")))
    return _rounded(eda.untitled_rate(stored, BOUNDARY), "fallback_untitled_ticket_rate")


_PLACEHOLDER_ROWS = " UNION ALL ".join(
    f"SELECT {O.quote(p)} AS placeholder, count(*) FILTER (contains(summary, {O.quote(p)}) OR contains(details, {O.quote(p)})) "
    "AS rows_with_placeholder, count(*) AS total FROM masked"
    for p in fv.KNOWN_PLACEHOLDERS
)


@check(
    O.with_tickets(
        f"SELECT placeholder, rows_with_placeholder, round(rows_with_placeholder / total, 6) AS rate FROM ({_PLACEHOLDER_ROWS})",
        f"masked AS (SELECT {O.mask('summary')} AS summary, {O.mask('details')} AS details FROM scoped)",
    )
)
def placeholder_metrics(spark, sf_dir):
    masked = guardrails.mask_text_fields(scope.in_scope(stored_tickets(spark, sf_dir), BOUNDARY))
    return _rounded(eda.placeholder_metrics(masked, BOUNDARY), "rate")


@check(
    O.with_tickets(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS field, strftime(min({c}), '%Y-%m-%dT%H:%M:%SZ') AS min_at, strftime(max({c}), '%Y-%m-%dT%H:%M:%SZ') AS max_at,
            count({c}) AS populated_count, count(*) - count({c}) AS null_count, count(*) - count({c}) AS missing_count FROM scoped"""
            for c in fv.TEMPORAL_COLUMNS
        )
    )
)
def temporal_fields(spark, sf_dir):
    return eda.temporal_fields(stored_tickets(spark, sf_dir), BOUNDARY)


def _periods(granularity: str, mask: str) -> str:
    return f"SELECT strftime(date_trunc('{granularity}', ticket_created_at), '{mask}') AS period, count(*) AS ticket_count FROM scoped GROUP BY 1"


@check(O.with_tickets(_periods("month", "%Y-%m")))
def created_by_month(spark, sf_dir):
    return eda.created_buckets(stored_tickets(spark, sf_dir), "month", BOUNDARY)


@check(O.with_tickets(_periods("year", "%Y")))
def created_by_year(spark, sf_dir):
    return eda.created_buckets(stored_tickets(spark, sf_dir), "year", BOUNDARY)


def _complete(c: str) -> str:
    if c in fv.DISTRIBUTION_COLUMNS:
        populated, missing = f"count(*) FILTER (trim({c}) <> '')", f"count(*) FILTER (trim({c}) = '')"
    else:
        populated = f"count({c})"
        missing = "CAST(0 AS BIGINT)" if c == "ingested_at" else f"count(*) FILTER ({c} IS NULL)"
    return f"""SELECT '{c}' AS field, {populated} AS populated_count, count(*) FILTER ({c} IS NULL) AS null_count,
        {missing} AS missing_count, round({populated} / count(*), 6) AS completeness_rate FROM scoped"""


@check(O.with_tickets(" UNION ALL ".join(_complete(c) for c in fv.DISTRIBUTION_COLUMNS + fv.TEMPORAL_COLUMNS)))
def completeness(spark, sf_dir):
    return _rounded(eda.completeness(stored_tickets(spark, sf_dir), BOUNDARY), "completeness_rate")


_LOOSE = " OR ".join(
    f"regexp_matches({f}, {O.quote(p)}, 'i')" for p in fv.HEURISTIC_PATTERNS for f in fv.TEXT_FIELDS
)


@check(O.with_tickets(f"SELECT count(*) FILTER ({_LOOSE}) AS rows_with_heuristic_like_pattern FROM scoped"))
def heuristic_count(spark, sf_dir):
    return eda.heuristic_count(stored_tickets(spark, sf_dir), BOUNDARY)


def _either(category: str) -> str:
    return f"({O.has(category, 'summary')} OR {O.has(category, 'details')})"


_ANY = "(" + " OR ".join(_either(c) for c in fv.PII_PATTERNS) + ")"


@check(
    O.with_tickets(
        f"""SELECT count(*) AS rows_scanned, count(*) FILTER {_ANY} AS pii_residual_official_count,
        round(count(*) FILTER {_ANY} / count(*), 6) AS residual_detection_rate FROM scoped"""
    )
)
def residual_scan(spark, sf_dir):
    scan = eda.residual_scan(stored_tickets(spark, sf_dir), BOUNDARY).drop("residual_categories")
    return _rounded(scan, "residual_detection_rate")


_PER_CATEGORY = " UNION ALL ".join(
    f"SELECT '{c}' AS category, count(*) FILTER {_either(c)} AS rows_with_residual FROM scoped" for c in fv.PII_PATTERNS
)


@check(O.with_tickets(f"SELECT * FROM ({_PER_CATEGORY}) WHERE rows_with_residual > 0"))
def residual_categories(spark, sf_dir):
    return eda.residual_categories(stored_tickets(spark, sf_dir), BOUNDARY)


def _found(field: str) -> str:
    flags = ", ".join(f"CASE WHEN {O.has(c, field)} THEN '{c}' END" for c in sorted(fv.PII_PATTERNS))
    return f"SELECT external_ticket_id, '{field}' AS field, array_to_string(list_filter([{flags}], lambda v: v IS NOT NULL), ',') AS categories FROM tickets"


@check(O.with_tickets(f"SELECT * FROM ({_found('summary')} UNION ALL {_found('details')}) WHERE categories <> ''"))
def residual_rows(spark, sf_dir):
    """Where the gate would stop unmasked tickets."""
    found = guardrails.residual_rows(stored_tickets(spark, sf_dir), "external_ticket_id")
    return found.withColumn("categories", F.array_join("categories", ","))


@check(O.with_tickets("SELECT count(*) AS rows_scanned, sum(length(details)) > 0 AS has_text, CAST(0 AS BIGINT) AS rows_left FROM tickets"))
def residual_rows_after_masking(spark, sf_dir):
    """The gate's scan of all six fields finds nothing in guarded tickets, and all of them were scanned."""
    guarded = ingest.guard(raw_tickets(spark, sf_dir).drop("ingested_at"))
    left = guardrails.residual_rows(guarded, "external_ticket_id", fv.RESIDUAL_SCAN_FIELDS)
    scanned = guarded.agg(F.count(F.lit(1)).alias("rows_scanned"), (F.sum(F.char_length("details")) > 0).alias("has_text"))
    return scanned.join(left.agg(F.count(F.lit(1)).alias("rows_left")), F.lit(True))


def _listed(path: str, query: str, keys: tuple[str, ...], values: dict[str, str]) -> str:
    """Rows (path, value) of a query: a path per key and value."""
    key = " || '.' || ".join([O.quote(path), *(f"CAST({k} AS VARCHAR)" for k in keys)])
    return " UNION ALL ".join(f"SELECT {key} || '.{name}' AS path, {value} AS value FROM ({query})" for name, value in values.items())


def _whole(name: str) -> str:
    return f"CAST({name} AS VARCHAR)"


def _part(name: str) -> str:
    return f"printf('%.6f', CAST({name} AS DOUBLE))"


def _report_sql() -> str:
    """Every leaf of the report, section by section, from the SQL of the single metrics."""
    either = {c: _either(c) for c in sorted(fv.PII_PATTERNS)}
    runs = "SELECT CAST(min(bucket_rank) AS BIGINT) AS first_rank, CAST(max(bucket_rank) AS BIGINT) AS last_rank, ticket_count FROM ({}) GROUP BY ticket_count"
    counts = """SELECT count(DISTINCT nullif(trim({c}), '')) AS d, count(*) FILTER ({c} IS NULL) AS n, count(*) FILTER (trim({c}) = '') AS m FROM scoped"""
    parts = [
        _listed("scope", f"SELECT {_SCOPE_COUNTS}, '{BOUNDARY}' AS b FROM tickets", (), {
            "total": _whole("included_count"), "source": _whole("total_source_count"), "included": _whole("included_count"),
            "historical": _whole("excluded_historical_outlier_count"), "undated": _whole("excluded_missing_ticket_created_at_count"), "bound": "b"}),
        *(_listed(f"distribution.{c}", counts.format(c=c), (), {"distinct": _whole("d"), "non_null": _whole("d"), "null": _whole("n"), "missing": _whole("m")}) for c in fv.DISTRIBUTION_COLUMNS),
        *(_listed(f"distribution.{c}", runs.format(_ranked(c)), ("first_rank",), {"last": _whole("last_rank"), "count": _whole("ticket_count")}) for c in fv.DISTRIBUTION_COLUMNS),
        *(_listed("text", _quality(c), ("field",), {n: _part(v) for n, v in (("min", "min_length"), ("mean", "mean_length"), ("max", "max_length"), *((p, p) for p in ("p50", "p90", "p95", "p99")), ("empty", "empty_rate"))}) for c in fv.TEXT_FIELDS),
        _listed("untitled", "SELECT avg(CASE WHEN lower(trim(summary)) = 'untitled ticket' THEN 1.0 ELSE 0.0 END) AS r FROM scoped", (), {"rate": _part("r")}),
        _listed("placeholder", _PLACEHOLDER_ROWS.replace("FROM masked", "FROM scoped"), ("placeholder",), {"rows": _whole("rows_with_placeholder"), "rate": _part("rows_with_placeholder / total")}),
        *(_listed("moment", f"""SELECT '{c}' AS field, strftime(min({c}), '%Y-%m-%dT%H:%M:%SZ') AS a, strftime(max({c}), '%Y-%m-%dT%H:%M:%SZ') AS z,
            count({c}) AS p, count(*) - count({c}) AS n FROM scoped""", ("field",), {"min": "a", "max": "z", "populated": _whole("p"), "null": _whole("n"), "missing": _whole("n")}) for c in fv.TEMPORAL_COLUMNS),
        *(_listed(f"by_{g}", _periods(g, m), ("period",), {"count": _whole("ticket_count")}) for g, m in (("month", "%Y-%m"), ("year", "%Y"))),
        _listed("scan", f"SELECT count(*) AS n, count(*) FILTER {_ANY} AS hits, count(*) FILTER ({_LOOSE}) AS loose FROM scoped", (), {
            "rows": _whole("n"), "hits": _whole("hits"), "rate": _part("hits / n"), "loose": _whole("loose")}),
        *(_listed(f"scan.{c}", f"SELECT count(*) FILTER {test} AS n FROM scoped HAVING n > 0", (), {"rows": _whole("n")}) for c, test in either.items()),
        *(_listed("complete", _complete(c), ("field",), {"populated": _whole("populated_count"), "null": _whole("null_count"), "missing": _whole("missing_count"), "rate": _part("completeness_rate")}) for c in fv.DISTRIBUTION_COLUMNS + fv.TEMPORAL_COLUMNS),
    ]
    return O.with_tickets(" UNION ALL ".join(parts))


def _leaves(report: DataFrame) -> DataFrame:
    """Every leaf of the report as (path, value)."""

    def leaf(path: Column, value: Column) -> Column:
        return F.struct(path.alias("path"), value.cast("string").alias("value"))

    def rate(value: Column) -> Column:
        return F.format_string("%.6f", F.round(value.cast("double"), 6))

    def at(*parts) -> Column:
        return F.concat_ws(".", *(F.lit(p) if isinstance(p, str) else p for p in parts))

    def many(path: str, key: str, column: Column, values: dict) -> list[Column]:
        def of(name: str, read) -> Column:
            return F.transform(column, lambda e: leaf(at(path, e[key].cast("string"), name), read(e)))

        return [of(name, read) for name, read in values.items()]

    c = F.col
    single = {"scope.total": c("total_tickets"), "scope.source": c("total_source_count"), "scope.included": c("included_count"), "scope.historical": c("excluded_historical_outlier_count"), "scope.undated": c("excluded_missing_ticket_created_at_count"), "scope.bound": c("applied_min_ticket_created_at")}
    arrays: list[Column] = []
    for d in fv.DISTRIBUTION_COLUMNS:
        of = f"{d}_distribution"
        for n, name in (("distinct", "distinct_count"), ("non_null", "non_null_distinct_count"), ("null", "null_count"), ("missing", "missing_count")):
            single[f"distribution.{d}.{n}"] = c(f"{of}.{name}")
        arrays += many(f"distribution.{d}", "first_rank", c(f"{of}.buckets"), {"last": lambda e: e["last_rank"], "count": lambda e: e["count"]})
    for f, name in zip(fv.TEXT_FIELDS, ("short_text", "long_text"), strict=True):
        for n in ("min", "mean", "max", "p50", "p90", "p95", "p99"):
            single[f"text.{f}.{n}"] = rate(c(f"{name}.length.{n}"))
        single[f"text.{f}.empty"] = rate(c(f"{name}.empty_rate"))
    single["untitled.rate"] = rate(c("fallback_untitled_ticket_rate"))
    arrays += many("placeholder", "placeholder", c("placeholder_counts"), {"rows": lambda e: e["rows_with_placeholder"], "rate": lambda e: rate(e["rate"])})
    for t in fv.TEMPORAL_COLUMNS:
        for n, name in (("min", "min_at"), ("max", "max_at"), ("populated", "populated_count"), ("null", "null_count"), ("missing", "missing_count")):
            single[f"moment.{t}.{n}"] = c(f"temporal_distribution.{t}.{name}")
    for g in fv.BUCKET_FORMATS:
        arrays += many(f"by_{g}", "period", c(f"temporal_distribution.ticket_created_buckets.by_{g}"), {"count": lambda e: e["count"]})
    scan = "pii_scan"
    single |= {"scan.rows": c(f"{scan}.rows_scanned"), "scan.hits": c(f"{scan}.pii_residual_official_count"), "scan.rate": rate(c(f"{scan}.residual_detection_rate")), "scan.loose": c(f"{scan}.heuristic_like_pattern_count")}
    arrays += many("scan", "category", c(f"{scan}.residual_categories"), {"rows": lambda e: e["rows_with_residual"]})
    arrays += many("complete", "field", c("completeness"), {"populated": lambda e: e["populated_count"], "null": lambda e: e["null_count"], "missing": lambda e: e["missing_count"], "rate": lambda e: rate(e["completeness_rate"])})
    ones = F.array(*(leaf(F.lit(path), value) for path, value in single.items()))
    return report.select(F.inline(F.concat(ones, *arrays)))


@check(_report_sql())
def quality_report(spark, sf_dir):
    """The fused report, every value of every section."""
    return _leaves(eda_report.build_report(stored_tickets(spark, sf_dir), BOUNDARY))


# ---------------------------------------------------------------- merge and ingest

_EXISTING_SQL = """SELECT CAST(c_custkey AS STRING) AS external_ticket_id, c_name AS summary, c_mktsegment AS details, 'open' AS status,
    'old' AS priority, CAST(NULL AS STRING) AS category, CAST(NULL AS STRING) AS agent_id_pseudonym,
    CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '1990-01-01 00:00:00' END AS ticket_created_at, CAST(NULL AS TIMESTAMP) AS ticket_updated_at,
    CAST(NULL AS TIMESTAMP) AS ticket_closed_at, TIMESTAMP '2020-01-01 00:00:00' AS ingested_at FROM customer"""
_BATCH_SQL = """SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 5 = 0 THEN 'new-' || CAST(o_custkey AS STRING) ELSE CAST(o_custkey AS STRING) END AS external_ticket_id,
    'order ' || CAST(o_orderkey AS STRING) AS summary, o_orderstatus AS details, 'open' AS status,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS priority, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS category,
    CAST(NULL AS STRING) AS agent_id_pseudonym, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) END AS ticket_created_at,
    CAST(o_orderdate AS TIMESTAMP) AS ticket_updated_at, CAST(NULL AS TIMESTAMP) AS ticket_closed_at FROM orders"""
_FOLD = f"""b AS ({_BATCH_SQL}), e AS ({_EXISTING_SQL}),
    f AS (SELECT external_ticket_id AS k, arg_min(summary, seq) AS summary, arg_min(details, seq) AS details, arg_min(status, seq) AS status,
    arg_max_null(priority, seq) AS priority, arg_max_null(category, seq) AS category, arg_max(ticket_created_at, seq) AS created,
    arg_max(ticket_updated_at, seq) AS updated, count(*) AS batch_rows FROM b GROUP BY 1)"""


def _merge_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Customers as the table and every order as a batch: many rows per key, a fifth of them new keys."""
    existing = spark.sql(_EXISTING_SQL.replace("FROM customer", "FROM {customer}"), customer=load(spark, sf_dir, "customer"))
    batch = spark.sql(_BATCH_SQL.replace("FROM orders", "FROM {orders}"), orders=load(spark, sf_dir, "orders"))
    return existing.select(*STORED.fieldNames()), batch.select("seq", *CLEAN.fieldNames())


@check(
    f"""WITH {_FOLD} SELECT coalesce(e.external_ticket_id, f.k) AS external_ticket_id, coalesce(e.summary, f.summary) AS summary,
    coalesce(e.details, f.details) AS details, coalesce(e.status, f.status) AS status,
    CASE WHEN f.k IS NULL THEN e.priority ELSE f.priority END AS priority, CASE WHEN f.k IS NULL THEN e.category ELSE f.category END AS category,
    CAST(NULL AS VARCHAR) AS agent_id_pseudonym, strftime(coalesce(f.created, e.ticket_created_at), '%Y-%m-%d %H:%M:%S') AS ticket_created_at,
    strftime(f.updated, '%Y-%m-%d %H:%M:%S') AS ticket_updated_at, CAST(NULL AS VARCHAR) AS ticket_closed_at,
    strftime(coalesce(e.ingested_at, TIMESTAMP '{STAMP}'), '%Y-%m-%d %H:%M:%S') AS ingested_at, e.external_ticket_id IS NULL AS inserted
    FROM e FULL JOIN f ON e.external_ticket_id = f.k"""
)
def keyed_merge(spark, sf_dir):
    existing, batch = _merge_inputs(spark, sf_dir)
    return _texts_of_dates(merge.merge(existing, batch, datetime.fromisoformat(STAMP)))


@check(
    f"""WITH {_FOLD}, n AS (SELECT k NOT IN (SELECT external_ticket_id FROM e) AS fresh FROM f)
    SELECT coalesce(e.external_ticket_id, f.k) AS external_ticket_id, coalesce(e.summary, f.summary) AS summary,
    coalesce(e.details, f.details) AS details, CASE WHEN f.k IS NULL THEN e.priority ELSE f.priority END AS priority,
    CASE WHEN f.k IS NULL THEN e.category ELSE f.category END AS category,
    strftime(coalesce(f.created, e.ticket_created_at), '%Y-%m-%d %H:%M:%S') AS ticket_created_at,
    strftime(f.updated, '%Y-%m-%d %H:%M:%S') AS ticket_updated_at, e.external_ticket_id IS NULL AS fresh,
    (SELECT count(*) FROM e) AS first_inserted, (SELECT count(*) FILTER (fresh) FROM n) AS then_inserted
    FROM e FULL JOIN f ON e.external_ticket_id = f.k"""
)
def keyed_table(spark, sf_dir):
    """The same merge in the stored table, with the counts that saving returns."""
    existing, batch = _merge_inputs(spark, sf_dir)
    root, stamp = shared_folder(spark), datetime.fromisoformat(STAMP)
    old = existing.drop("ingested_at").withColumn("seq", F.lit(0).cast("bigint")).select("seq", *CLEAN.fieldNames())
    first = table.save_batch(old, root, datetime(2020, 1, 1))
    then = table.save_batch(batch, root, stamp)
    stored = _texts_of_dates(table.current(spark, root).withColumn("fresh", F.col("ingested_at") == F.lit(stamp)))
    names = ("external_ticket_id", "summary", "details", "priority", "category", "ticket_created_at", "ticket_updated_at", "fresh")
    return stored.select(*names, F.lit(first).cast("bigint").alias("first_inserted"), F.lit(then).cast("bigint").alias("then_inserted"))


@check(
    f"""WITH {_FOLD} SELECT CAST(sum(batch_rows) AS BIGINT) AS extracted_count,
    count(*) FILTER (k NOT IN (SELECT external_ticket_id FROM e)) AS stored_count,
    CAST(sum(batch_rows) - count(*) FILTER (k NOT IN (SELECT external_ticket_id FROM e)) AS BIGINT) AS ignored_count FROM f"""
)
def merge_counts(spark, sf_dir):
    return merge.classify(*_merge_inputs(spark, sf_dir))


@check(
    f"WITH {_FOLD} SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS rows_with_null_required_field, CAST(0 AS BIGINT) AS rows_with_bad_pseudonym, "
    "(SELECT count(*) FROM (SELECT external_ticket_id FROM b GROUP BY 1 HAVING count(*) > 1)) AS duplicated_key_count FROM b"
)
def table_constraints(spark, sf_dir):
    """The batch before its merge repeats keys; everything else holds."""
    _, batch = _merge_inputs(spark, sf_dir)
    return guardrails.constraint_violations(batch)


_INGESTED = f"""WITH {_MAPPED} SELECT external_ticket_id, summary, details, status, '' AS priority, category, CAST(NULL AS VARCHAR) AS agent_id_pseudonym,
    {_stamp("ticket_created_at")}, CAST(NULL AS VARCHAR) AS ticket_updated_at, CAST(NULL AS VARCHAR) AS ticket_closed_at, '{STAMP}' AS ingested_at FROM mapped"""


@check(_INGESTED)
def ingest_pages(spark, sf_dir):
    """Every page ingested twice: the second run adds nothing."""
    root = shared_folder(spark)
    # Searching texts takes long for their size: a few tasks of usual size would leave cores idle.
    parts = 4 * spark.sparkContext.defaultParallelism
    landed = payloads(spark, sf_dir, parts).select(F.format_string("%012d", "doc_id").alias("page"), "body")
    for _ in range(2):
        ingest.ingest_pages(landed, root, ingested_at=datetime.fromisoformat(STAMP))
    return _texts_of_dates(table.current(spark, root))


@check(_INGESTED)
def ingest_page_stream(spark, sf_dir):
    """The same pages landed as files and picked up by a stream in several batches."""
    base = shared_folder(spark)
    payloads(spark, sf_dir).select("body").write.text(f"{base}/landed")
    run = ingest_stream(
        spark, f"{base}/landed", f"{base}/table", f"{base}/progress", files_per_batch=4, one_per_line=True, ingested_at=datetime.fromisoformat(STAMP)
    )
    run.awaitTermination()
    return _texts_of_dates(table.current(spark, f"{base}/table"))


@check(
    """SELECT CAST(doc_id % 50 AS VARCHAR) AS external_ticket_id, 's' || arg_min(doc_id, doc_id) AS summary, 'p' || arg_max(doc_id, doc_id) AS priority,
    count(*) AS extracted_count, (SELECT count(DISTINCT doc_id % 50) FROM documents) AS stored_count FROM documents GROUP BY 1"""
)
def ingest_repeated_ids(spark, sf_dir):
    """Ids that come again and again, in the lines of one file and in the next, with other values each time."""
    base = shared_folder(spark)
    ticket = F.to_json(F.struct((F.col("doc_id") % 50).alias("id"), F.concat(F.lit("s"), "doc_id").alias("summary"), F.concat(F.lit("p"), "doc_id").alias("priority")))
    lines = load(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit('{"tickets":['), ticket, F.lit("]}")).alias("line"))
    lines.repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id").select("line").write.text(f"{base}/landed")
    result = ingest.ingest_pages(pages.read_pages(spark, f"{base}/landed", one_per_line=True), f"{base}/table", ingested_at=datetime.fromisoformat(STAMP))
    stored = table.current(spark, f"{base}/table").select("external_ticket_id", "summary", "priority")
    per_id = load(spark, sf_dir, "documents").groupBy((F.col("doc_id") % 50).cast("string").alias("external_ticket_id")).agg(F.count(F.lit(1)).alias("extracted_count"))
    if result.extracted_count != result.stored_count + result.ignored_count:
        raise AssertionError("counts do not add up")
    return stored.join(per_id, "external_ticket_id").withColumn("stored_count", F.lit(result.stored_count).cast("bigint"))


# ---------------------------------------------------------------- feature dataset

_FEATURE_ROWS = O.with_tickets("SELECT * FROM features", O.FEATURES_CTE.strip())


@check(_FEATURE_ROWS)
def feature_rows(spark, sf_dir):
    return features.build_features(feature_records(spark, sf_dir), BOUNDARY)


_FINDINGS = f"""count(*) AS transformed_count, CAST(0 AS BIGINT) AS pii_official_residual_count,
    CAST(sum({O.secrets("cleaned_text_truncated")}) AS BIGINT) AS secret_scan_count"""


@check(O.with_tickets(f"SELECT {_FINDINGS} FROM features", O.FEATURES_CTE.strip()))
def feature_metrics(spark, sf_dir):
    return features.feature_metrics(features.build_features(feature_records(spark, sf_dir), BOUNDARY))


@check(
    O.with_tickets(
        f"""SELECT 'ticket_dataset_v1' AS dataset_version, 'dry_run_no_export' AS mode, CASE WHEN secret_scan_count > 0 THEN 'fail' ELSE 'pass' END AS status,
        '{BOUNDARY}' AS scope_min_ticket_created_at, total_source_count, included_count, excluded_historical_outlier_count,
        excluded_missing_ticket_created_at_count, '{",".join(fv.FEATURE_COLUMNS)}' AS planned_dataset_columns, pii_official_residual_count, secret_scan_count,
        CAST(0 AS BIGINT) AS forbidden_column_count, CAST(0 AS BIGINT) AS exact_timestamp_column_count, CAST(0 AS BIGINT) AS raw_text_column_count,
        'no_forbidden_columns:true,no_residual_pii:true,no_detected_secrets:' || CASE WHEN secret_scan_count > 0 THEN 'false' ELSE 'true' END
        || ',no_exact_timestamps:true,no_raw_text_columns:true,feature_rows_match_allowlist:true,no_dataset_output_path:true' AS gates
        FROM (SELECT {_SCOPE_COUNTS} FROM tickets), (SELECT {_FINDINGS} FROM features)""",
        O.FEATURES_CTE.strip(),
    )
)
def dry_run_report(spark, sf_dir):
    report = dry_run.dry_run_report(feature_records(spark, sf_dir), BOUNDARY)
    gates = F.transform("gates", lambda g: F.concat(g["name"], F.lit(":"), g["passed"].cast("string")))
    return report.withColumns({"planned_dataset_columns": F.array_join("planned_dataset_columns", ","), "gates": F.array_join(gates, ",")})


_WHOLE_TEXT = "(summary || chr(10) || details)"
_WITHOUT_SECRETS = O.FEATURES_CTE.replace("FROM tickets WHERE", f"FROM tickets WHERE {O.secrets('lower(' + _WHOLE_TEXT + ')')} = 0 AND").strip()


@check(O.with_tickets("SELECT * FROM features", _WITHOUT_SECRETS))
def guarded_export(spark, sf_dir):
    """Features written through every gate and read back.

    The generated texts hold secrets, which rightly block an export: records whose whole
    text holds one are left out, all others go through with their full text.
    """
    records = feature_records(spark, sf_dir)
    whole = F.lower(F.concat_ws("\n", "summary", "details"))
    path = shared_folder(spark) + ".parquet"
    export.export_features(records.filter(X.count_secrets(whole) == 0), requested=True, path=path, min_created=BOUNDARY)
    return spark.read.parquet(path)


@check(
    O.with_tickets(
        f"""SELECT 'real_export_blocked' AS mode, 'fail' AS status, 'findings_when_written:false' AS gates, total_source_count, included_count,
        excluded_historical_outlier_count, excluded_missing_ticket_created_at_count, pii_official_residual_count, secret_scan_count
        FROM (SELECT {_SCOPE_COUNTS} FROM tickets), (SELECT {_FINDINGS} FROM features)""",
        O.FEATURES_CTE.replace(
            "FROM tickets WHERE",
            "FROM (SELECT * REPLACE (CASE WHEN CAST(external_ticket_id AS BIGINT) % 10 = 0 THEN 'token: x ' || summary ELSE summary END AS summary) FROM tickets) WHERE",
        ).strip(),
    )
)
def guarded_export_refused(spark, sf_dir):
    """Every tenth record starts with a secret: nothing is published, and the refusal says what was found."""
    path = shared_folder(spark) + ".parquet"
    leaky = F.when(F.col("external_ticket_id").cast("bigint") % 10 == 0, F.concat(F.lit("token: x "), "summary")).otherwise(F.col("summary"))
    try:
        export.export_features(feature_records(spark, sf_dir, leaky), requested=True, path=path, min_created=BOUNDARY)
    except export.ExportRefused as refused:
        report = refused.report(spark)
    if storage.exists(spark, path):
        raise AssertionError("a refused export was published")
    gates = F.array_join(F.transform("gates", lambda g: F.concat(g["name"], F.lit(":"), g["passed"].cast("string"))), ",")
    return report.select("mode", "status", gates.alias("gates"), *(c for c in export.REPORT.fieldNames() if c.endswith("_count") and "column" not in c))


@check(
    """SELECT * FROM (VALUES ('id', true, false, false), ('summary', false, false, false), ('title', true, false, false), ('subject', true, false, false),
    ('details', false, false, false), ('body', true, false, false), ('ticket_type', true, false, false), ('agentId', true, false, false),
    ('secret_note', true, false, false), ('status', true, false, false), ('status_id', true, false, false), ('statusid', true, false, false),
    ('created', true, false, false), ('dateopened', true, false, false), ('opened_at', true, true, false), ('datecreated', true, false, false))
    AS t("column", forbidden, exact_timestamp, raw_text)"""
)
def ragged_input_contract(spark, sf_dir):
    """Every member name in the landed payloads, judged by the input contract."""
    names = contract.ragged_columns(pages.unwrap_pages(payloads(spark, sf_dir)))
    return names.select("column", contract.flags(F.col("column")).alias("flags")).select("column", "flags.*")


# ---------------------------------------------------------------- life of stored rows

_STAGING_SQL = """SELECT CAST(d.doc_id AS STRING) AS external_ticket_id, d.source AS import_batch_id,
    CASE WHEN l.toxic = 1 OR l.quality = 0 THEN 'rejected' ELSE 'valid' END AS validation_status,
    CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 0 THEN 'low_quality' END AS rejection_reason_code,
    CASE WHEN d.doc_id % 9 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS data_retention_until
    FROM documents d JOIN orders o ON o.o_orderkey = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id"""
_CURATED_SQL = "SELECT CAST(doc_id AS STRING) AS external_ticket_id FROM labels WHERE doc_id % 2 = 0"
_DUE = date(1999, 1, 1)


def _staging(spark, sf_dir) -> DataFrame:
    sql = _STAGING_SQL.replace("FROM documents", "FROM {documents}").replace("JOIN orders", "JOIN {orders}").replace("JOIN labels", "JOIN {labels}")
    return spark.sql(sql, **{n: load(spark, sf_dir, n) for n in ("documents", "orders", "labels")})


@check(
    f"""WITH s AS ({_STAGING_SQL}), c AS ({_CURATED_SQL}) SELECT external_ticket_id, import_batch_id, CAST(data_retention_until AS VARCHAR) AS data_retention_until
    FROM s WHERE validation_status = 'valid' AND data_retention_until IS NOT NULL AND external_ticket_id NOT IN (SELECT external_ticket_id FROM c)"""
)
def promoted_rows(spark, sf_dir):
    rows = lifecycle.promote(_staging(spark, sf_dir), spark.sql(_CURATED_SQL.replace("FROM labels", "FROM {labels}"), labels=load(spark, sf_dir, "labels")))
    return rows.withColumn("data_retention_until", F.col("data_retention_until").cast("string"))


@check(f"SELECT rejection_reason_code, count(*) AS records_rejected_count FROM ({_STAGING_SQL}) WHERE validation_status = 'rejected' GROUP BY 1")
def rejects_by_reason(spark, sf_dir):
    return lifecycle.rejects_by_reason(_staging(spark, sf_dir))


@check(
    f"""SELECT import_batch_id, count(*) AS records_seen_count, count(*) FILTER (validation_status = 'valid') AS records_accepted_count,
    count(*) FILTER (validation_status = 'rejected') AS records_rejected_count FROM ({_STAGING_SQL}) GROUP BY 1"""
)
def import_counters(spark, sf_dir):
    return lifecycle.import_counters(_staging(spark, sf_dir))


@check(f"SELECT external_ticket_id FROM ({_STAGING_SQL}) WHERE data_retention_until IS NULL OR data_retention_until >= DATE '{_DUE}'")
def retained_rows(spark, sf_dir):
    return lifecycle.retained(_staging(spark, sf_dir), _DUE).select("external_ticket_id")


@check(
    f"""SELECT import_batch_id, CAST(data_retention_until AS VARCHAR) AS retention_deadline, 'retention_deadline' AS purge_reason,
    '{_DUE}' AS scheduled_for, count(*) AS records_deleted_count FROM ({_STAGING_SQL}) WHERE data_retention_until < DATE '{_DUE}' GROUP BY 1, 2"""
)
def purge_log(spark, sf_dir):
    log = lifecycle.purge_log(_staging(spark, sf_dir), _DUE)
    return log.withColumns({c: F.col(c).cast("string") for c in ("retention_deadline", "scheduled_for")})


@check(
    """WITH j AS (SELECT doc_id % 4 AS kind FROM documents d JOIN orders o ON o.o_orderkey = d.doc_id),
    f AS (SELECT kind, unnest(['id', 'summary', 'title', 'subject', 'details', 'body', 'ticket_type', 'agentId', 'secret_note']
        || CASE kind WHEN 0 THEN ['status', 'created'] WHEN 1 THEN ['status', 'created', 'dateopened']
        WHEN 2 THEN ['status', 'status_id', 'created', 'opened_at'] ELSE ['statusid', 'datecreated'] END) AS c FROM j)
    SELECT c AS "column", c <> 'secret_note' AS is_mapped, count(*) AS payloads FROM f GROUP BY 1, 2"""
)
def payload_profile(spark, sf_dir):
    return lifecycle.payload_profile(pages.unwrap_pages(payloads(spark, sf_dir)))


@check(
    """WITH j AS (SELECT d.doc_id, d.source, d.doc_id % 4 AS kind FROM documents d JOIN orders o ON o.o_orderkey = d.doc_id)
    SELECT source, CAST(sum(9 + CASE kind WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 4 ELSE 2 END) AS BIGINT) AS fields_seen_count,
    count(*) AS fields_rejected_count FROM j GROUP BY source"""
)
def rejected_fields(spark, sf_dir):
    """Members per source and those outside the mapping; every payload has one."""
    landed = pages.unwrap_pages(payloads(spark, sf_dir)).join(load(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return lifecycle.rejected_fields(landed, "source")


@check(
    """SELECT count(*) AS payload_count, CAST(0 AS BIGINT) AS missing_id_count, count(*) FILTER (doc_id % 4 IN (1, 2)) AS unreadable_created_count,
    CAST(0 AS BIGINT) AS unreadable_updated_count, CAST(0 AS BIGINT) AS unreadable_closed_count FROM documents d JOIN orders o ON o.o_orderkey = d.doc_id"""
)
def mapping_errors(spark, sf_dir):
    return lifecycle.mapping_errors(pages.unwrap_pages(payloads(spark, sf_dir)))


@check(f"SELECT external_ticket_id, (SELECT count(*) FROM ({_STAGING_SQL}) WHERE data_retention_until < DATE '{_DUE}') AS purged FROM ({_STAGING_SQL}) WHERE data_retention_until IS NULL OR data_retention_until >= DATE '{_DUE}'")
def purged_table(spark, sf_dir):
    """The table as it is after its expired rows were removed."""
    base = shared_folder(spark)
    _staging(spark, sf_dir).write.parquet(f"{base}/rows")
    gone = lifecycle.purge_expired(spark, f"{base}/rows", _DUE, f"{base}/log")
    return spark.read.parquet(f"{base}/rows").select("external_ticket_id", F.lit(gone).cast("bigint").alias("purged"))


@check(
    f"""SELECT count(*) AS records_seen_count, count(*) FILTER (validation_status = 'valid') AS records_accepted_count,
    count(*) FILTER (validation_status = 'rejected') AS records_rejected_count, count(*) AS stored FROM ({_STAGING_SQL})"""
)
def observed_import(spark, sf_dir):
    """The counters that the import's own job collects, beside the rows it stored."""
    path = shared_folder(spark)
    counters = lifecycle.import_observed(_staging(spark, sf_dir), path)
    stored = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("stored"))
    return stored.select(*(F.lit(n).cast("long").alias(name) for name, n in counters.items()), "stored")


@check(
    f"""SELECT external_ticket_id, (SELECT count(*) FROM ({_STAGING_SQL}) WHERE data_retention_until < DATE '{_DUE}') AS purged
    FROM ({_STAGING_SQL}) WHERE data_retention_until IS NULL OR data_retention_until >= DATE '{_DUE}'"""
)
def dropped_deadlines(spark, sf_dir):
    """The table by deadline as it is after its expired folders were removed."""
    base = shared_folder(spark)
    lifecycle.store_by_deadline(_staging(spark, sf_dir), f"{base}/rows")
    gone = lifecycle.drop_expired(spark, f"{base}/rows", _DUE, f"{base}/log")
    return spark.read.parquet(f"{base}/rows").select("external_ticket_id", F.lit(gone).cast("bigint").alias("purged"))


# ---------------------------------------------------------------- duplicates and labels


@check(
    """SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_count, count(*) FILTER (n > 1) AS duplicated_count,
    CAST(sum(n - 1) AS BIGINT) AS duplicate_row_count FROM (SELECT count(*) AS n FROM documents GROUP BY text)"""
)
def duplicate_counts(spark, sf_dir):
    return redundancy.duplicate_counts(load(spark, sf_dir, "documents"), "text")


_REDUNDANT_SQL = """SELECT b.k AS external_ticket_id, arg_min(a.k, (a.day, a.k)) AS earlier FROM w a JOIN w b ON a.client = b.client AND a.k <> b.k
    AND date_diff('day', a.day, b.day) BETWEEN 0 AND 400 AND (a.day, a.k) < (b.day, b.k)
    WHERE 100 * len(list_intersect(a.words, b.words)) >= 80 * (len(a.words) + len(b.words) - len(list_intersect(a.words, b.words))) GROUP BY b.k"""
_WORDS_CTE = """w AS (SELECT external_ticket_id AS k, agent_id[1:1] AS client, CAST(ticket_created_at AS DATE) AS day, list_distinct(list_filter(string_split(
    regexp_replace(lower(summary || ' ' || details), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')) AS words FROM tickets
    WHERE ticket_created_at IS NOT NULL)"""


@check(O.with_tickets(_REDUNDANT_SQL, _WORDS_CTE))
def redundant_tickets(spark, sf_dir):
    """Similar tickets of one client within some time; clients are coarse here, so that they have several."""
    return redundancy.redundant_tickets(_whole_tickets(spark, sf_dir), "client", text="whole", days=400)


def _whole_tickets(spark, sf_dir) -> DataFrame:
    return raw_tickets(spark, sf_dir).withColumns({"client": F.substring("agent_id", 1, 1), "whole": F.concat_ws(" ", "summary", "details")})


#: weighted terms of every ticket, rarest first by df and term
_VECTORS_CTE = """u AS (SELECT external_ticket_id AS k, unnest(list_filter(string_split(regexp_replace(lower(concat_ws(' ', summary, details)), '[^a-z0-9]+', ' ', 'g'), ' '),
        lambda x: x <> '')) AS term FROM tickets),
    c AS (SELECT k, term, count(*) AS n FROM u GROUP BY 1, 2),
    m AS (SELECT term, count(*) AS df, ln((1.0 + (SELECT count(DISTINCT k) FROM c))::DOUBLE / (1.0 + count(*))) + 1 AS idf FROM c GROUP BY term),
    v AS (SELECT k, term, df, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY k)) AS weight FROM c JOIN m USING (term))"""


def _stored(df: DataFrame) -> DataFrame:
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _vectors(spark, sf_dir, labels: DataFrame | None = None) -> DataFrame:
    """The vectors of all tickets, or with ``labels`` those of labelled ones; terms are fitted on all."""
    counts = written(terms.term_counts(_whole_tickets(spark, sf_dir), "external_ticket_id", "whole"))
    model = written(terms.fit(counts))
    found = terms.vectors(counts, model)  # these lie by key, so that only labels move to them
    vectors = written(found if labels is None else found.join(labels, "key"))
    dropped(counts, model)
    return vectors


@check(O.with_tickets("SELECT term, df, round(idf, 6) AS idf FROM m", _VECTORS_CTE))
def term_model(spark, sf_dir):
    return _rounded(terms.fit(_stored(terms.term_counts(_whole_tickets(spark, sf_dir), "external_ticket_id", "whole"))), "idf")


@check(O.with_tickets("SELECT k AS external_ticket_id, row_number() OVER (PARTITION BY k ORDER BY df, term) AS place, term, round(weight, 6) AS weight FROM v", _VECTORS_CTE))
def term_vectors(spark, sf_dir):
    spelled = _vectors(spark, sf_dir).select(F.col("key").alias("external_ticket_id"), F.posexplode("vector").alias("pos", "t"))
    return spelled.select("external_ticket_id", (F.col("pos") + 1).cast("long").alias("place"), "t.term", F.round("t.weight", 6).alias("weight"))


@check(
    O.with_tickets(
        """SELECT k AS external_ticket_id, rank, other, score, string_agg(term, ' ' ORDER BY part DESC, df, term) AS terms
        FROM (SELECT t.*, x.term, x.df, round(x.weight * y.weight, 6) AS part FROM top t JOIN v x ON x.k = t.k JOIN v y ON y.k = t.other AND y.term = x.term
        QUALIFY row_number() OVER (PARTITION BY t.k, other ORDER BY part DESC, x.df, x.term) <= 3) GROUP BY 1, 2, 3, 4""",
        _VECTORS_CTE,
        """s AS (SELECT a.k, b.k AS other, round(sum(a.weight * b.weight), 6) AS score FROM v a JOIN v b ON a.term = b.term AND a.k <> b.k GROUP BY 1, 2 HAVING score >= 0.5)""",
        "top AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, other) AS rank FROM s QUALIFY rank <= 5)",
    )
)
def similar_tickets(spark, sf_dir):
    """The five most similar tickets of each, with the terms that explain it."""
    found = similar.nearest(_vectors(spark, sf_dir), 5)
    return found.select(F.col("key").alias("external_ticket_id"), F.col("rank").cast("long").alias("rank"), "other", "score", F.concat_ws(" ", "terms").alias("terms"))


@check(
    O.with_tickets(
        """SELECT k AS doc_id, arg_min(quality, (-votes, -weight, quality)) AS predicted, max(votes) AS votes FROM (SELECT t.k, quality, count(*) AS votes, round(sum(score), 6) AS weight
        FROM top t JOIN l ON l.k = t.other GROUP BY 1, 2) GROUP BY k""",
        _VECTORS_CTE,
        "l AS (SELECT doc_id::VARCHAR AS k, quality, ('0x' || substr(md5('s' || doc_id::VARCHAR), 1, 8))::BIGINT % 100 < 70 AS train FROM labels)",
        """s AS (SELECT a.k, b.k AS other, round(sum(a.weight * b.weight), 6) AS score FROM v a JOIN l x ON x.k = a.k AND NOT x.train JOIN v b ON a.term = b.term
        JOIN l y ON y.k = b.k AND y.train GROUP BY 1, 2 HAVING score >= 0.2)""",
        "top AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, other) AS rank FROM s QUALIFY rank <= 5)",
    )
)
def nearest_vote(spark, sf_dir):
    """The quality of the test tickets by a vote of the five nearest training tickets."""
    labels = evaluation.with_split(load(spark, sf_dir, "labels"), "doc_id", 70, "s").select(F.col("doc_id").cast("string").alias("key"), "quality", "split")
    rows = _vectors(spark, sf_dir, labels)
    found = similar.nearest(rows, 5, least=0.2, asks=F.col("split") == "test", answers=F.col("split") == "train")
    return similar.vote(found, labels, "quality").withColumnsRenamed({"key": "doc_id"})


@check(
    O.with_tickets(
        """SELECT a, b, client AS block, 1 AS label FROM known UNION ALL SELECT a, b, client, 0 FROM (SELECT *, row_number() OVER (PARTITION BY client ORDER BY number) AS r FROM made
        WHERE (a, b) NOT IN (SELECT a, b FROM known)) JOIN sizes USING (client) WHERE r <= 3 * k""",
        _WORDS_CTE,
        f"p AS ({_REDUNDANT_SQL})",
        "rows_ AS (SELECT external_ticket_id AS key, agent_id[1:1] AS client FROM tickets WHERE agent_id IS NOT NULL)",
        """known AS (SELECT DISTINCT least(external_ticket_id, earlier) AS a, greatest(external_ticket_id, earlier) AS b, client
        FROM p JOIN rows_ ON key = least(external_ticket_id, earlier))""",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY client ORDER BY md5('pairs|' || key), key) - 1 AS place FROM rows_)",
        "sizes AS (SELECT client, n, k FROM (SELECT client, count(*) AS n FROM placed GROUP BY 1) JOIN (SELECT client, count(*) AS k FROM known GROUP BY 1) USING (client))",
        "numbers AS (SELECT client, n, unnest(range(0, least(4 * k, n * (n - 1) // 2))) AS number FROM sizes)",
        """made AS (SELECT i.client, number, least(x.key, y.key) AS a, greatest(x.key, y.key) AS b FROM numbers i JOIN placed x ON x.client = i.client AND x.place = number % n
        JOIN placed y ON y.client = i.client AND y.place = (number % n + number // n + 1) % n)""",
    )
)
def labelled_pairs(spark, sf_dir):
    """Redundant tickets of a client, and three other pairs of it for each."""
    rows = _whole_tickets(spark, sf_dir)
    known = redundancy.redundant_tickets(rows, "client", text="whole", days=400)
    known = known.select(F.col("external_ticket_id").alias("a"), F.col("earlier").alias("b"))
    return pairs.labelled_pairs(rows, known, key="external_ticket_id", block="client", ratio=3, salt="pairs")


@check("SELECT CASE WHEN ('0x' || substr(md5('s' || doc_id::VARCHAR), 1, 8))::BIGINT % 100 < 70 THEN 'train' ELSE 'test' END AS split, doc_id FROM labels")
def stable_split(spark, sf_dir):
    return evaluation.with_split(load(spark, sf_dir, "labels"), "doc_id", 70, "s").select("doc_id", "split")


@check("SELECT quality AS label, count(*) AS row_count, round(count(*) / sum(count(*)) OVER (), 6) AS share, round(count(*) / max(count(*)) OVER (), 6) AS to_largest FROM labels GROUP BY 1")
def class_balance(spark, sf_dir):
    return _rounded(evaluation.class_balance(load(spark, sf_dir, "labels"), "quality"), "share", "to_largest")


@check(
    O.with_tickets(
        " UNION ALL ".join(
            f"SELECT '{c}' AS field, count(*) FILTER ({c} IS NULL) AS null_count, count(*) FILTER (trim({c}) = '') AS blank_count, "
            f"round((count(*) FILTER ({c} IS NULL) + count(*) FILTER (trim({c}) = '')) / count(*), 6) AS missing_rate FROM tickets"
            for c in fv.DISTRIBUTION_COLUMNS
        )
    )
)
def missing_values(spark, sf_dir):
    return _rounded(evaluation.missing_values(stored_tickets(spark, sf_dir), *fv.DISTRIBUTION_COLUMNS), "missing_rate")


@check(
    """SELECT tp AS true_positive, fp AS false_positive, tn AS true_negative, fn AS false_negative, round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy,
    round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
    round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM (SELECT count(*) FILTER (quality = 1 AND p = 1) AS tp,
    count(*) FILTER (quality = 0 AND p = 1) AS fp, count(*) FILTER (quality = 0 AND p = 0) AS tn, count(*) FILTER (quality = 1 AND p = 0) AS fn
    FROM (SELECT quality, CASE WHEN length(text) > 1000 THEN 1 ELSE 0 END AS p FROM labels JOIN documents USING (doc_id)))"""
)
def binary_metrics(spark, sf_dir):
    """A long text predicts quality."""
    joined = load(spark, sf_dir, "labels").join(load(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    rows = joined.select("quality", (F.char_length("text") > 1000).cast("int").alias("predicted"))
    return _rounded(evaluation.binary_metrics(rows, "quality", "predicted"), "accuracy", "precision", "recall", "f1")


@check(
    "SELECT 'hmac_sha256:' || sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode(CAST(doc_id AS VARCHAR))))) AS ticket_pseudonym, "
    "CAST(quality AS DOUBLE) AS score, 'v1' AS model_version FROM labels".format(
        outer=bytes(b ^ 0x5C for b in _SECRET.ljust(64, b"\0")).hex(), inner=bytes(b ^ 0x36 for b in _SECRET.ljust(64, b"\0")).hex()
    )
)
def prediction_log(spark, sf_dir):
    path = shared_folder(spark)
    lifecycle.log_predictions(load(spark, sf_dir, "labels").withColumn("score", F.col("quality")), path, _SECRET, "v1", "doc_id")
    return spark.read.parquet(path).drop("logged_at")


_MORE = """SELECT o_orderkey AS k, CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN 'call +49 (30) ' || CAST(1000 + o_custkey AS STRING) || ' today'
    WHEN 1 THEN 'Mme Dupont-Martin wrote, ' || o_orderpriority WHEN 2 THEN 'at ' || CAST(1 + o_orderkey % 99 AS STRING) || ' rue de la Gare, 75011 Paris'
    WHEN 3 THEN '69002 Lyon; Dr Jean Valjean and M. Hugo' ELSE 'order ' || CAST(o_orderkey AS STRING) || ' of mme x' END AS x FROM orders"""


def _more_sql(text: str) -> str:
    edges = [r"(\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5})", r"\b((?:M\.|Mme|Mlle|Mr|Mrs|Ms|Dr)\s+\p{Lu}[\p{L}'-]+(?:\s+\p{Lu}[\p{L}'-]+)?)",
             r"\b([0-9]{1,4}(?:\s?(?:bis|ter))?,?\s+(?:rue|avenue|boulevard|place|chemin|impasse|route|quai)\s+[^,;\n]{2,40})", r"\b([0-9]{5}\s+\p{Lu}[\p{L}' -]+)"]
    for e in edges:
        text = f"regexp_replace({text}, {O.quote(e)}, '[PII_REDACTED]', 'g')"
    return text


@check(f"WITH t AS ({_MORE}) SELECT k, {_more_sql('substr(x, 1, 30)')} AS masked FROM t")
def mask_more(spark, sf_dir):
    """The additional masks, on texts cut before masking."""
    built = spark.sql(_MORE.replace("FROM orders", "FROM {orders}"), orders=load(spark, sf_dir, "orders"))
    return built.select("k", X.mask_more(F.col("x"), 30).alias("masked"))


@check(f"WITH t AS (SELECT 'o' || k AS k, x FROM ({_MORE}) UNION ALL SELECT k, x FROM {_ALL_TEXT}) SELECT k, {_more_sql('x')} AS masked FROM t")
def mask_more_whole(spark, sf_dir):
    """The additional masks, on whole texts: those of the three text tables and the built ones."""
    built = spark.sql(_MORE.replace("FROM orders", "FROM {orders}"), orders=load(spark, sf_dir, "orders"))
    texts = _all_text(spark, sf_dir).unionAll(built.select(F.concat(F.lit("o"), "k").alias("k"), "x"))
    return texts.select("k", X.mask_more(F.col("x")).alias("masked"))


@check(
    "SELECT o_orderkey, 'hmac_sha256:' || sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode(CAST(o_custkey AS VARCHAR))))) AS user_id, "
    "CASE WHEN o_orderkey % 3 > 0 THEN 'hmac_sha256:' || sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode('site' || (o_orderkey % 7) || '.example')))) END "
    "AS requester FROM orders".format(
        outer=bytes(b ^ 0x5C for b in _SECRET.ljust(64, b"\0")).hex(), inner=bytes(b ^ 0x36 for b in _SECRET.ljust(64, b"\0")).hex()
    )
)
def pseudonymised_columns(spark, sf_dir):
    """Users by pseudonym, requesters by that of their domain; what is no address has none."""
    site = F.concat(F.lit("Site"), (F.col("o_orderkey") % 7).cast("string"), F.lit(".example"))
    requester = F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit("someone@"), site)).otherwise("nobody")
    rows = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), requester.alias("requester"))
    return lifecycle.pseudonymised(rows, _SECRET, "user_id", domains=("requester",))


def _labelled_words(spark, sf_dir) -> DataFrame:
    rows = load(spark, sf_dir, "labels").join(load(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return _stored(classify.labelled_words(rows, "doc_id", "text", "quality", folds=3, salt="s"))


@check("SELECT ('0x' || substr(md5('sfold' || doc_id::VARCHAR), 1, 8))::BIGINT % 100 % 3 AS fold, CAST(quality AS DOUBLE) AS label, count(*) AS rows FROM labels JOIN documents USING (doc_id) WHERE quality IN (0, 1) GROUP BY 1, 2")
def label_folds(spark, sf_dir):
    return _labelled_words(spark, sf_dir).groupBy(F.col("fold").cast("long").alias("fold"), "label").agg(F.count(F.lit(1)).alias("rows"))


@check()
def model_scores(spark, sf_dir):
    """Every kind of classifier, fitted on the training split, stored, loaded, and scored on all labelled tickets."""
    rows = evaluation.with_split(_labelled_words(spark, sf_dir), "key", 70, "s")
    found = None
    for kind in classify.KINDS:
        path = shared_folder(spark)
        classify.save(classify.train(rows.filter("split = 'train'"), kind, parts=8), path)
        scored = classify.scores(classify.load(path), rows).withColumn("kind", F.lit(kind))
        found = scored if found is None else found.unionByName(scored)
    return found.select("kind", F.col("key").alias("doc_id"), F.round("score", 6).alias("score"), "predicted")
