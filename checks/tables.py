"""The generated tables seen as support-ticket data, in Spark and in SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guichet.session import configure

#: the generated orders end in 2001
BOUNDARY = date(1998, 1, 1)
STAMP = "2026-01-01 00:00:00"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_TICKET_COLUMNS = """
    CAST(d.doc_id AS STRING) AS external_ticket_id,
    split_part(d.text, chr(10), 1) AS summary,
    substr(d.text, length(split_part(d.text, chr(10), 1)) + 2) AS details,
    CASE WHEN o.o_orderstatus = 'F' THEN 'closed' WHEN o.o_orderstatus = 'O' THEN 'open' ELSE 'pending' END AS status,
    CASE WHEN d.doc_id % 17 = 0 THEN NULL WHEN d.doc_id % 19 = 0 THEN '  ' ELSE o.o_orderpriority END AS priority,
    CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE d.source END AS category,
    CAST(o.o_custkey AS STRING) AS agent_id,
    CASE WHEN d.doc_id % 23 = 0 THEN NULL ELSE CAST(o.o_orderdate AS TIMESTAMP) END AS ticket_created_at,
    CAST(o.o_orderdate AS TIMESTAMP) + INTERVAL '3' DAY AS ticket_updated_at,
    CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_orderdate AS TIMESTAMP) + INTERVAL '10' DAY END AS ticket_closed_at,
    CAST(o.o_orderdate AS TIMESTAMP) + INTERVAL '30' DAY AS ingested_at
"""

#: the same view as a SQL common table expression
TICKETS_CTE = f"tickets AS (SELECT {_TICKET_COLUMNS} FROM documents d LEFT JOIN orders o ON o.o_orderkey = d.doc_id)"
SCOPE = f"ticket_created_at >= TIMESTAMP '{BOUNDARY} 00:00:00'"


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as tickets, with the dates, status and agent of the order of the same number."""
    documents = load(spark, sf_dir, "documents").alias("d")
    joined = documents.join(load(spark, sf_dir, "orders").alias("o"), F.expr("o.o_orderkey = d.doc_id"), "left")
    exprs = [c.strip() for c in _TICKET_COLUMNS.strip().split(",\n")]
    return joined.selectExpr(*exprs)


def stored_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticket table as stored, without the agent."""
    return raw_tickets(spark, sf_dir).drop("agent_id")


def feature_records(spark: SparkSession, sf_dir: str, summary: Column | str = "summary") -> DataFrame:
    """Records for the feature dataset: two texts and a creation date as ISO text."""
    day = F.date_format("ticket_created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = F.col(summary) if isinstance(summary, str) else summary
    return raw_tickets(spark, sf_dir).select(text.alias("summary"), "details", day.alias("ticket_created_at"))


# ---------------------------------------------------------------- payloads

#: which spelling a document's payload uses, by number; the same rule in Spark and SQL
PAYLOAD_SQL = """
    named_struct('id', doc_id, 'summary', CASE WHEN doc_id % 3 = 0 THEN text END, 'title', CASE WHEN doc_id % 3 = 1 THEN text ELSE ' ' END,
        'subject', text, 'details', CASE WHEN doc_id % 2 = 0 THEN '<p>' || text || '</p>' ELSE '  ' END, 'body', text,
        'ticket_type', source, 'agentId', CASE WHEN doc_id % 7 = 0 THEN NULL ELSE doc_id * 10 END, 'secret_note', lang)
"""


def payloads(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """(doc_id, body): one landed response per document, as JSON text.

    The container, the status and the date field change with the number, and each
    list also holds two items that are not objects. Given ``parts``, the responses lie
    in that many partitions at least, and not in as few as their size suggests.
    """
    d = load(spark, sf_dir, "documents").alias("d")
    if parts is not None:
        d = d.repartition(parts, "doc_id")
    o = load(spark, sf_dir, "orders").alias("o")
    df = d.join(o, F.expr("o.o_orderkey = d.doc_id"))
    ticket = F.to_json(F.expr(PAYLOAD_SQL), {"ignoreNullFields": "false"})
    quoted = F.concat(F.lit('"'), "o_orderstatus", F.lit('"'))
    kind = F.col("doc_id") % 4
    status = (
        F.when(kind == 0, F.concat(F.lit('"status":'), quoted))
        .when(kind == 1, F.concat(F.lit('"status":{"name":'), quoted, F.lit(',"id":9}')))
        .when(kind == 2, F.concat(F.lit('"status":null,"status_id":'), quoted))
        .otherwise(F.concat(F.lit('"statusid":'), F.col("doc_id").cast("string")))
    )
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    created = (
        F.when(kind == 0, F.concat(F.lit('"created":"'), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('Z"')))
        .when(kind == 1, F.concat(F.lit('"created":"bad","dateopened":'), seconds.cast("string")))
        .when(kind == 2, F.concat(F.lit('"created":false,"opened_at":"'), F.date_format("o_orderdate", "yyyyMMdd"), F.lit('"')))
        .otherwise(F.concat(F.lit('"datecreated":'), (seconds * 1000).cast("string")))
    )
    payload = F.concat(F.regexp_replace(ticket, r"\}$", ","), status, F.lit(","), created, F.lit("}"))
    container = F.element_at(F.array(F.lit("tickets"), F.lit("results"), F.lit("data"), F.lit("items")), (kind + 1).cast("int"))
    page = F.concat(F.lit('{"page":1,"'), container, F.lit('":[17,'), payload, F.lit(",null]}"))
    return df.select("doc_id", page.alias("body"))
