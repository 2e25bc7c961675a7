"""Provider payloads: literal cases per field."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from guichet.operators.mapping import to_incoming
from guichet.sources.pages import read_pages, unwrap_pages

BASE = {"id": "syn-001", "summary": "Synthetic summary", "details": "Synthetic details", "status": "open"}


def map_all(spark, payloads, **options):
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(payloads)], "i int, body string")
    df = df.select("i", F.parse_json("body").alias("payload"))
    return to_incoming(df, "i", **options).orderBy("i").collect()


def without(*names, **more):
    return {k: v for k, v in BASE.items() if k not in names} | more


def test_status(spark):
    cases = [
        ({"status": "closed"}, "closed"),
        ({"status_id": 7}, "7"),
        ({"statusid": "8"}, "8"),
        ({"ticketstatus": "in_progress"}, "in_progress"),
        ({"status": {"name": "waiting_customer", "id": 9}}, "waiting_customer"),
        ({"status": {"id": 10}}, "10"),
        ({"status": {"name": None, "id": 10}}, "unknown"),
        ({"status": {}}, "unknown"),
        ({}, "unknown"),
        ({"status": None, "status_id": 7}, "unknown"),
        ({"status": "  "}, "unknown"),
        ({"status": True}, "True"),
        ({"status": 1.0}, "1.0"),
        ({"status": 1.5}, "1.5"),
        ({"status": "wait for a@b.test"}, "wait for [EMAIL]"),
    ]
    rows = map_all(spark, [without("status", **c) for c, _ in cases])
    assert [r.status for r in rows] == [want for _, want in cases]


def test_summary_and_details(spark):
    cases = [
        (without("summary", title="T"), "T", "Synthetic details"),
        (without(summary=" ", title="T"), "T", "Synthetic details"),
        (without("summary", subject="S"), "S", "Synthetic details"),
        (without(summary="", title=" ", subject="S"), "S", "Synthetic details"),
        (without("summary"), "Untitled ticket", "Synthetic details"),
        (without(summary="", title=" ", subject=None), "Untitled ticket", "Synthetic details"),
        (without("summary", "details", description="D"), "Untitled ticket", "D"),
        (without("summary", title="Contact u@example.invalid"), "Contact [EMAIL]", "Synthetic details"),
        (without(details=" ", description="", detail=None, body="B", note="N"), "Synthetic summary", "B"),
        (without(details="<br/>&nbsp;", problem="P"), "Synthetic summary", "P"),
        (without("details"), "Synthetic summary", ""),
    ]
    cases += [(without("details", **{a: a}), "Synthetic summary", a) for a in ("detail", "note", "symptom", "problem")]
    rows = map_all(spark, [c[0] for c in cases])
    assert [(r.summary, r.details) for r in rows] == [(c[1], c[2]) for c in cases]


def test_optional_fields_and_allowlist(spark):
    full = without(priority="high", ticket_type="Incident", agentId=" 42 ", raw_json={"x": 1}, secret_note="n")
    rows = map_all(spark, [full, without(category="", ticket_type=3, agent_id="a@b.test"), BASE])
    assert [(r.priority, r.category, r.agent_id) for r in rows] == [
        ("high", "Incident", "42"),
        (None, "3", "a@b.test"),
        (None, None, None),
    ]
    assert "raw_json" not in rows[0] and "secret_note" not in rows[0]


def test_required_id(spark):
    rows = map_all(spark, [without("id", ticket_id=5), without(id="  ", external_ticket_id="x")])
    assert [r.external_ticket_id for r in rows] == ["5", "x"]
    with pytest.raises(Exception, match="Missing required ticket field: id") as failure:
        map_all(spark, [without("id", summary="MUST-NOT-LEAK")])
    assert "MUST-NOT-LEAK" not in str(failure.value)
    assert map_all(spark, [without("id")], fail_without_id=False)[0].external_ticket_id is None


def test_dates(spark):
    aliases = {
        "ticket_created_at": "created datecreated date_created dateoccurred date_opened opened_at dateopened",
        "ticket_updated_at": "updated last_update lastupdated dateupdated",
        "ticket_closed_at": "closed closed_at dateclosed resolved_at",
    }
    want = datetime(2026, 1, 2, 3, 4, 5)
    pairs = [(column, a) for column, names in aliases.items() for a in names.split()]
    rows = map_all(spark, [without(**{a: "2026-01-02T03:04:05Z"}) for _, a in pairs])
    for row, (column, _) in zip(rows, pairs, strict=True):
        assert {c: row[c] for c in aliases} == {c: want if c == column else None for c in aliases}
    odd = ["invalid-date", -1, None, False, [], {}, 1735689600, 1735689600000, 1735689600.5]
    rows = map_all(spark, [without(created=v) for v in odd] + [without(created="bad", opened_at="2025-01-01")])
    day = datetime(2025, 1, 1)
    assert [r.ticket_created_at for r in rows] == [None] * 6 + [day, day, day.replace(microsecond=500000), day]


def unwrap(spark, bodies):
    df = spark.createDataFrame(list(enumerate(bodies)), "page int, body string")
    out = unwrap_pages(df).select("page", "position", F.try_variant_get("payload", "$.id", "int").alias("id"))
    return [tuple(r) for r in out.orderBy("page", "position").collect()]


def test_unwrap_pages(spark):
    bodies = [
        '{"results": [{"id": 1}, 5, null, "x", [], {"id": 2}]}',
        '{"items": [{"id": 9}], "tickets": []}',
        '{"data": [{"id": 3}], "other": 1}',
    ]
    assert unwrap(spark, bodies) == [(0, 0, 1), (0, 5, 2), (2, 0, 3)]
    for bad in ('{"tickets": {"id": 1}}', '{"rows": []}', "[]", '{"tickets": null, "items": []}'):
        with pytest.raises(Exception, match="did not include a ticket list"):
            unwrap(spark, [bad])
    with pytest.raises(Exception, match="MALFORMED"):
        unwrap(spark, ["{oops"])


def test_read_pages(spark, tmp_path):
    (tmp_path / "p1.json").write_text('{"tickets":\n [{"id": 1}]}')
    (tmp_path / "p2.json").write_text('{"tickets": [{"id": 2}, {"id": 3}]}')
    out = unwrap_pages(read_pages(spark, str(tmp_path)))
    assert out.columns == ["page", "position", "payload"]
    assert out.count() == 3
