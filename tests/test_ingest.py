"""The whole ingest on landed pages, and its gates."""

import hashlib
import hmac
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from guichet import fixed_values as fv
from guichet.functions import pseudonym as P
from guichet.functions import text as X
from guichet.operators import guardrails as G
from guichet.plans import ingest as I
from guichet.schema import CLEAN, INCOMING, STORED
from guichet.sources import table, tickets
from guichet.sources.pages import read_pages
from guichet.streaming.ingest import ingest_stream

STAMP = datetime(2026, 1, 1)


def incoming(spark, *overrides):
    base = ["syn-001", "Synthetic portal", "Controlled error.", "open", "medium", "identity", "agent-1", None, None, None]
    names = INCOMING.fieldNames()
    rows = [tuple(o.get(n, v) for n, v in zip(names, base, strict=True)) for o in overrides]
    return spark.createDataFrame(rows, INCOMING).withColumn("seq", F.monotonically_increasing_id())


def land(folder, *pages):
    folder.mkdir(exist_ok=True)
    start = len(os.listdir(folder))
    for i, tickets_ in enumerate(pages):
        (folder / f"page-{start + i:04d}.json").write_text(json.dumps({"tickets": tickets_}))


PAGE_1 = [{"id": 1, "summary": "First", "details": "d", "status": "open", "priority": "high", "created": "2025-02-01"}, {"id": 2, "title": "Two"}]
PAGE_2 = [{"id": 1, "summary": "Second", "status": "closed"}, {"id": 3, "details": "Call 06 12 34 56 78", "agent_id": "a"}]
WANT = [
    ("1", "First", "d", "open", "", "", None, datetime(2025, 2, 1), None, None, STAMP),
    ("2", "Two", "", "unknown", "", "", None, None, None, None, STAMP),
    ("3", "Untitled ticket", "Call [PHONE]", "unknown", "", "", None, None, None, None, STAMP),
]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ingest_pages(spark, tmp_path):
    land(tmp_path / "in", PAGE_1, PAGE_2)
    root, pages = str(tmp_path / "table"), read_pages(spark, str(tmp_path / "in"))
    assert table.current(spark, root).count() == 0
    assert I.ingest_pages(pages, root, ingested_at=STAMP) == I.IngestResult(4, 3, 1)
    assert rows(table.current(spark, root)) == WANT
    assert I.ingest_pages(pages, root, ingested_at=datetime(2026, 2, 2)) == I.IngestResult(4, 0, 4)
    assert rows(table.current(spark, root)) == WANT
    assert not [n for n in os.listdir(root) if n.startswith("_")]
    table.compact(spark, root)
    assert rows(table.current(spark, root)) == WANT


def test_ingest_stream(spark, tmp_path):
    root, folder, checkpoint = (str(tmp_path / n) for n in ("table", "in", "checkpoint"))
    land(tmp_path / "in", PAGE_1)
    ingest_stream(spark, folder, root, checkpoint, ingested_at=STAMP).awaitTermination()
    land(tmp_path / "in", PAGE_2)
    ingest_stream(spark, folder, root, checkpoint, ingested_at=STAMP, files_per_batch=1).awaitTermination()
    assert rows(table.current(spark, root)) == WANT


def test_counts_and_masking(spark, tmp_path):
    result = I.ingest_incoming(incoming(spark, {}, {}, {"external_ticket_id": "syn-2", "category": "callback 0612345678"}), str(tmp_path))
    assert result == I.IngestResult(3, 2, 1)
    stored = {r.external_ticket_id: r for r in table.current(spark, str(tmp_path)).collect()}
    assert stored["syn-2"].category == "callback [PHONE]" and "agent_id" not in stored["syn-2"]
    assert I.ingest_incoming(incoming(spark, {}).limit(0), str(tmp_path)) == I.IngestResult(0, 0, 0)


def test_masked_keys_refuse_the_batch(spark, tmp_path):
    batch = incoming(spark, {"external_ticket_id": "0612345678"}, {"external_ticket_id": "0712345678"}, {})
    I.ingest_incoming(incoming(spark, {}), str(tmp_path), ingested_at=STAMP)
    before = rows(table.current(spark, str(tmp_path)))
    with pytest.raises(I.MaskedKeyError, match="^2 rows"):
        I.ingest_incoming(batch, str(tmp_path))
    assert rows(table.current(spark, str(tmp_path))) == before
    assert not [n for n in os.listdir(tmp_path) if n.startswith("_")]
    assert I.ingest_incoming(batch, str(tmp_path), allow_masked_keys=True) == I.IngestResult(3, 1, 2, masked_key_count=2)


@pytest.mark.parametrize(("split", "parts"), [("128m", 1), ("3000b", 1), ("3000b", 7), ("128m", 3)])
def test_lines_of_a_file_keep_their_order(spark, tmp_path, split, parts):
    """Same ids again and again, in one file and in the next, whatever the splits and shuffles."""
    lines = [json.dumps({"tickets": [{"id": i % 7, "summary": f"s{i}", "priority": f"p{i}"}]}) for i in range(1500)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.txt").write_text("\n".join(lines[900:]))
    (tmp_path / "in" / "a.txt").write_text("\n".join(lines[:900]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        pages = read_pages(spark, str(tmp_path / "in"), one_per_line=True)
        I.ingest_pages(pages.repartition(parts) if parts > 1 else pages, str(tmp_path / "t"), ingested_at=STAMP)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {r.external_ticket_id: (r.summary, r.priority) for r in table.current(spark, str(tmp_path / "t")).collect()}
    assert got == {str(k): (f"s{k}", f"p{max(i for i in range(1500) if i % 7 == k)}") for k in range(7)}


def test_stream_applies_files_as_they_landed(spark, tmp_path):
    for n, name in enumerate(("a", "b", "c")):
        (tmp_path / f"{name}.txt").write_text("\n".join(json.dumps({"tickets": [{"id": 1, "summary": f"{name}{i}", "priority": f"{name}{i}"}]}) for i in range(3)))
        os.utime(tmp_path / f"{name}.txt", (1_700_000_000 + n, 1_700_000_000 + n))
    for size in (1, 2, 1000):
        root, progress = str(tmp_path / f"t{size}"), str(tmp_path / f"p{size}")
        ingest_stream(spark, f"{tmp_path}/*.txt", root, progress, files_per_batch=size, one_per_line=True, ingested_at=STAMP).awaitTermination()
        assert [(r.summary, r.priority) for r in table.current(spark, root).collect()] == [("a0", "c2")]


def test_pseudonym(spark, tmp_path, monkeypatch):
    batch = incoming(spark, {"agent_id": "agent-synthetic-456"}, {"external_ticket_id": "x", "agent_id": None})
    monkeypatch.delenv(P.DEFAULT_SECRET_VARIABLE, raising=False)
    for value in (None, ""):
        if value is not None:
            monkeypatch.setenv(P.DEFAULT_SECRET_VARIABLE, value)
        with pytest.raises(P.MissingSecretError):
            I.ingest_incoming(batch, str(tmp_path), with_pseudonym=True)
    assert not os.listdir(tmp_path)
    monkeypatch.setenv(P.DEFAULT_SECRET_VARIABLE, "synthetic-hmac-input-material")
    I.ingest_incoming(batch, str(tmp_path), with_pseudonym=True)
    digest = hmac.new(b"synthetic-hmac-input-material", b"agent-synthetic-456", hashlib.sha256).hexdigest()
    got = {r.external_ticket_id: r.agent_id_pseudonym for r in table.current(spark, str(tmp_path)).collect()}
    assert got == {"syn-001": "hmac_sha256:" + digest, "x": None}
    guarded = I.guard(batch, with_pseudonym=True)
    assert "synthetic-hmac" not in guarded._jdf.queryExecution().toString()


def test_gate_blocks_the_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(G, "clean_scan_fields", lambda df: df)
    with pytest.raises(G.ResidualPiiError, match="field=category, categories=email") as failure:
        I.ingest_incoming(incoming(spark, {"category": "owner qa.person@example.test"}), str(tmp_path))
    assert "qa.person" not in str(failure.value)
    assert not os.listdir(tmp_path)


def test_residual_gate(spark):
    df = spark.createDataFrame([("k", "Diagnostic", "Contact support@example.com 10.0.0.1"), ("l", None, "ok [EMAIL]")], "k string, summary string, details string")
    with pytest.raises(G.ResidualPiiError, match="field=details, categories=email, rows=1"):
        G.assert_no_residual_pii(df)
    assert [tuple(r) for r in G.residual_rows(df, "k").collect()] == [("k", "details", ["email", "ipv4"])]
    masked = G.mask_text_fields(df)
    G.assert_no_residual_pii(masked)
    assert [r.summary for r in masked.orderBy("k").collect()] == ["Diagnostic", ""]
    assert G.residual_rows(masked, "k").count() == 0


def test_pseudonym_is_not_scanned(spark):
    df = incoming(spark, {}).drop("agent_id").withColumn("agent_id_pseudonym", F.lit("hmac_sha256:0612345678abcdef"))
    G.assert_no_residual_pii(df, fv.RESIDUAL_SCAN_FIELDS)


@pytest.mark.parametrize("field", fv.FORBIDDEN_STORAGE_FIELDS)
def test_storage_refuses_raw_fields(spark, field):
    df = incoming(spark, {}).drop("agent_id", "seq").withColumn(field, F.lit("x"))
    with pytest.raises(G.ForbiddenFieldError, match="Forbidden storage fields"):
        G.to_storage(df)


def test_storage_projection(spark):
    df = incoming(spark, {}).drop("agent_id", "seq")
    assert G.to_storage(df).columns == CLEAN.fieldNames()
    with pytest.raises(G.ForbiddenFieldError, match="Business date fields"):
        G.to_storage(df.withColumn("ticket_created_at", F.lit("2026-05-06T07:08:09Z")))
    with pytest.raises(G.ForbiddenFieldError, match="missing"):
        G.to_storage(df.drop("status"))
    view = G.guardrail_view(incoming(spark, {}))
    assert view.columns == [c for c in CLEAN.fieldNames() if c != "agent_id_pseudonym"] + ["agent_id"]
    pre = G.preprocess(spark.createDataFrame([("Imprimante bloquée", "Bourrage", "a-1")], "summary string, details string, agent_id string"))
    assert [tuple(r) for r in pre.collect()] == [("Imprimante bloquée", "Bourrage")] and pre.columns == ["summary", "details"]


def test_constraints(spark):
    good = ("a", "s", "d", "open", None, None, "hmac_sha256:1", None, None, None, STAMP)
    bad = ("a", "s", "d", "open", None, None, "plain", None, None, None, STAMP)
    df = spark.createDataFrame([good, bad], STORED)
    assert tuple(G.constraint_violations(df).first()) == (2, 0, 1, 1)
    assert tuple(G.constraint_violations(df.limit(0)).first()) == (0, 0, 0, 0)
    nulls = df.withColumn("summary", F.lit(None).cast("string"))
    assert tuple(G.constraint_violations(nulls).first()) == (2, 2, 1, 1)


def test_sources(spark, tmp_path):
    demo = tickets.synthetic_tickets(spark)
    assert [r.external_ticket_id for r in demo.orderBy("external_ticket_id").collect()] == ["demo-1", "demo-2"]
    clean = I.guard(demo)
    for _ in range(2):
        tickets.append_tickets(clean, str(tmp_path / "a"))
    assert tickets.read_tickets(spark, str(tmp_path / "a")).count() == 4
    assert tickets.read_tickets(spark, str(tmp_path / "a")).columns == STORED.fieldNames()
    with pytest.raises(TypeError):
        tickets.append_tickets(demo, str(tmp_path / "a"))
    page = tickets.page_slice(spark.range(10).toDF("n"), ["n"], 4, 3)
    assert [r.n for r in page.collect()] == [8, 9]
    with pytest.raises(ValueError):
        tickets.page_slice(demo, ["external_ticket_id"], 0)
    numbers, seen, last = spark.range(10).toDF("n"), [], None
    while page := [r.n for r in tickets.page_after_key(numbers, "n", 4, last).collect()]:
        seen, last = seen + page, page[-1]
    assert seen == list(range(10))
    with pytest.raises(ValueError):
        tickets.page_after_key(numbers, "n", 0)


def test_masking_settles(evaluate):
    from tests.test_text import CLEAN_CASES, MASK_CASES

    masked = [want for _, want in MASK_CASES if want and "&" not in want]
    assert evaluate(masked, X.mask) == masked
    cleaned = [want for _, want in CLEAN_CASES]
    assert evaluate(cleaned, X.clean) == cleaned


def test_one_pass_equals_cleaning_and_masking_after_mapping(spark):
    """Odd texts in every field, through both routes."""
    from tests.test_text import CLEAN_CASES, MASK_CASES, texts

    odd = [t for t, _ in MASK_CASES + CLEAN_CASES if t] + texts(400, 31)
    odd += ["06<i></i> 12 34 56 78", "a@b.<b></b>test x", "<<b>p>q", "x &amp;lt;b&amp;gt; y", "login:<br> abc'def@example.test", "ok <i>fine</i>", "&amp;amp;#64;"]
    pages = [
        (i, json.dumps({"tickets": [{"id": f"k{i}", "summary": t, "details": odd[-1 - i], "priority": odd[(i * 7) % len(odd)], "category": odd[(i * 3) % len(odd)], "status": odd[(i * 5) % len(odd)]}]}))
        for i, t in enumerate(odd)
    ]
    df = spark.createDataFrame(pages, "page long, body string").repartition(3)
    two = I.guard(I.map_pages(df), "seq")
    one = G.to_storage(G.without_agent(I.map_pages(df, guarded=True)), "seq")
    assert rows(one) == rows(two)
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") + plan.count("ArrowUDF") <= 2 and plan.count("@(") <= 4


def test_pages_are_spread_over_tasks(spark, tmp_path):
    """However small they are, and the same pages, with repeated and null numbers among them."""
    from checks.tables import payloads

    texts = [(i % 40 if i else None, f"text {i}", "en", "web", 6) for i in range(60)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    orders = [(i, i, "O", 1.0, datetime(1997, 1, 1), "1-URGENT") for i in range(50)]
    names = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(orders, names).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spread = payloads(spark, str(tmp_path), 12)
    assert spread.rdd.getNumPartitions() >= 12
    assert rows(spread) == rows(payloads(spark, str(tmp_path))) and spread.count() == 59
