"""Quality metrics and the fused report on literal rows."""

import json
import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from guichet import fixed_values as fv
from guichet.operators import eda
from guichet.plans import eda_report as R
from guichet.schema import STORED

DAY = datetime(2025, 1, 1)


def stored(spark, rows):
    names = STORED.fieldNames()
    base = {"external_ticket_id": "x", "summary": "s", "details": "d", "status": "open", "ticket_created_at": DAY, "ingested_at": DAY}
    return spark.createDataFrame([tuple((base | r).get(n) for n in names) for r in rows], STORED)


ROWS = [
    {"priority": "high", "category": " net ", "ticket_closed_at": DAY},
    {"priority": "high", "category": "net", "summary": " Untitled TICKET ", "details": "mail [EMAIL] [IP]"},
    {"priority": "low", "category": None, "details": "  ", "ticket_created_at": DAY + timedelta(days=40)},
    {"priority": None, "category": "", "details": "see a@b.test 10.0.0.1", "ticket_created_at": DAY + timedelta(days=400)},
    {"priority": "  ", "category": "app", "summary": "call 06 12 34 56 78", "details": "and 10.0.0.1"},
    {"priority": "old", "ticket_created_at": datetime(2024, 12, 31, 23, 59, 59)},
    {"priority": "none", "ticket_created_at": None},
]


@pytest.fixture(scope="module")
def report(spark):
    return R.collect_report(R.build_report(stored(spark, ROWS)))


def spelled_out(runs):
    return [(rank, r["count"]) for r in runs for rank in range(r["first_rank"], r["last_rank"] + 1)]


def test_counters(report):
    assert [report[k] for k in list(report)[:6]] == [5, 7, 5, 1, 1, "2025-01-01"]


def test_distributions(report):
    assert report["priority_distribution"] == {
        "distinct_count": 2,
        "non_null_distinct_count": 2,
        "null_count": 1,
        "missing_count": 1,
        "buckets": [{"first_rank": 1, "last_rank": 1, "count": 2}, {"first_rank": 2, "last_rank": 2, "count": 1}],
    }
    assert spelled_out(report["category_distribution"]["buckets"]) == [(1, 2), (2, 1)]
    assert (report["category_distribution"]["null_count"], report["category_distribution"]["missing_count"]) == (1, 1)
    assert spelled_out(report["status_distribution"]["buckets"]) == [(1, 5)]


def test_text(report):
    length = report["long_text"]["length"]
    sizes = sorted(len(r.get("details", "d")) for r in ROWS[:5])
    assert (length["min"], length["max"], length["mean"]) == (sizes[0], sizes[-1], sum(sizes) / 5)
    assert length["p50"] == sizes[2] and length["p90"] == pytest.approx(sizes[3] + 0.6 * (sizes[4] - sizes[3]))
    assert report["long_text"]["empty_rate"] == 0.2
    assert report["fallback_untitled_ticket_rate"] == 0.2
    found = {p["placeholder"]: p["rows_with_placeholder"] for p in report["placeholder_counts"]}
    assert found == {"[EMAIL]": 1, "[PHONE]": 0, "[URL]": 0, "[IP]": 1, "[IDENTIFIER]": 0}


def test_time(report):
    t = report["temporal_distribution"]
    assert t["ticket_created_at"]["min_at"] == "2025-01-01T00:00:00Z"
    assert t["ticket_updated_at"] == {"min_at": None, "max_at": None, "populated_count": 0, "null_count": 5, "missing_count": 5}
    assert t["ticket_created_buckets"]["by_month"] == [{"period": "2025-01", "count": 3}, {"period": "2025-02", "count": 1}, {"period": "2026-02", "count": 1}]
    assert t["ticket_created_buckets"]["by_year"] == [{"period": "2025", "count": 4}, {"period": "2026", "count": 1}]
    closed = next(c for c in report["completeness"] if c["field"] == "ticket_closed_at")
    assert closed == {"field": "ticket_closed_at", "populated_count": 1, "null_count": 4, "missing_count": 4, "completeness_rate": 0.2}


def test_scan(report):
    scan = report["pii_scan"]
    assert (scan["rows_scanned"], scan["pii_residual_official_count"], scan["residual_detection_rate"]) == (5, 2, 0.4)
    assert [(c["category"], c["rows_with_residual"]) for c in scan["residual_categories"]] == [("email", 1), ("fr_phone", 1), ("ipv4", 2)]
    assert scan["heuristic_like_pattern_count"] == 2


def test_report_equals_single_metrics(spark):
    rng = random.Random(4)
    rows = [
        {
            "status": rng.choice(["a", "b", "b ", " c", "  "]),
            "priority": rng.choice([None, "", "p1", "p2"]),
            "category": rng.choice([None, *(f"c{i}" for i in range(30))]),
            "summary": "word " * rng.randint(0, 20),
            "details": rng.choice(["", "x@y.test", "[URL] here", "plain é"]) * rng.randint(0, 5),
            "ticket_created_at": rng.choice([None, DAY + timedelta(days=rng.randint(-90, 900))]),
            "ticket_updated_at": rng.choice([None, DAY]),
        }
        for _ in range(300)
    ]
    df = stored(spark, rows).repartition(3)
    report = R.collect_report(R.build_report(df))
    rows_of = lambda d: [r.asDict(recursive=True) for r in d.collect()]

    for c in fv.DISTRIBUTION_COLUMNS:
        buckets = [(r["bucket_rank"], r["ticket_count"]) for r in rows_of(eda.distribution(df, c))]
        assert spelled_out(report[f"{c}_distribution"]["buckets"]) == buckets
    for r in rows_of(eda.distribution_counts(df)):
        mine = report[f"{r['dimension']}_distribution"]
        assert {k: v for k, v in mine.items() if k != "buckets"} == {k: v for k, v in r.items() if k != "dimension"}
    for field, key in zip(fv.TEXT_FIELDS, ("short_text", "long_text"), strict=True):
        (r,) = rows_of(eda.text_quality(df, field))
        length = report[key]["length"]
        assert [length[k] for k in ("min", "mean", "max", "p50", "p90", "p95", "p99")] == pytest.approx(list(r.values())[1:8])
        assert report[key]["empty_rate"] == pytest.approx(r["empty_rate"])
    assert report["completeness"] == rows_of(eda.completeness(df))
    assert report["placeholder_counts"] == rows_of(eda.placeholder_metrics(df))
    for r in rows_of(eda.temporal_fields(df)):
        assert report["temporal_distribution"][r.pop("field")] == r
    for g in ("month", "year"):
        buckets = [{"period": r["period"], "count": r["ticket_count"]} for r in rows_of(eda.created_buckets(df, g))]
        assert report["temporal_distribution"]["ticket_created_buckets"][f"by_{g}"] == buckets
    (scan,) = rows_of(eda.residual_scan(df))
    (loose,) = rows_of(eda.heuristic_count(df))
    assert report["pii_scan"] == scan | {"heuristic_like_pattern_count": loose["rows_with_heuristic_like_pattern"]}
    assert rows_of(eda.residual_categories(df)) == scan["residual_categories"]
    kept = [r for r in rows if r["ticket_created_at"] and r["ticket_created_at"] >= DAY]
    assert report["included_count"] == len(kept) == eda.count_included(df).first()[0]
    assert eda.count_source(df).first()[0] == 300
    counts = Counter(r["status"].strip() for r in kept if r["status"].strip())
    assert [n for _, n in spelled_out(report["status_distribution"]["buckets"])] == sorted(counts.values(), reverse=True)


def test_empty_table(spark):
    report = R.collect_report(R.build_report(stored(spark, [{}]).limit(0)))
    assert report["total_source_count"] == report["included_count"] == 0
    assert report["short_text"] == {"length": {k: 0 for k in ("min", "mean", "max", "p50", "p90", "p95", "p99")}, "empty_rate": 0}
    assert report["fallback_untitled_ticket_rate"] == 0 and report["status_distribution"]["buckets"] == []
    assert eda.text_quality(stored(spark, [{}]).limit(0), "summary").first().p99 == 0


def test_ranks_of_many_equal_counts(spark, monkeypatch):
    monkeypatch.setattr(eda, "_RANKS_PER_ROW", 7)
    df = spark.range(100).select(F.lit(1).cast("bigint").alias("n")).unionAll(spark.range(2).select(F.lit(5).cast("bigint")))
    ranks = [tuple(r) for r in eda.rank_counts(df).collect()]
    assert ranks == [(1, 5), (2, 5), *((i, 1) for i in range(3, 103))]


def test_a_column_with_more_than_a_million_values(spark):
    row = {n: "'x'" for n in STORED.fieldNames()} | {"category": "concat('c', greatest(id, 20))"}
    row |= {n: "timestamp'2025-02-01'" for n in fv.TEMPORAL_COLUMNS}
    df = spark.range(0, 1_200_000, 1, 4).selectExpr(*(f"{v} AS {n}" for n, v in row.items()))
    report = R.collect_report(R.build_report(df))["category_distribution"]
    assert report["distinct_count"] == 1_199_980
    assert report["buckets"] == [{"first_rank": 1, "last_rank": 1, "count": 21}, {"first_rank": 2, "last_rank": 1_199_980, "count": 1}]


def test_allowlists(spark):
    df = stored(spark, [{}])
    for call in (
        lambda: eda.distribution(df, "external_ticket_id"),
        lambda: eda.text_quality(df, "status"),
        lambda: eda.temporal_fields(df, columns=["summary"]),
    ):
        with pytest.raises(ValueError, match="is not open to"):
            call()
    with pytest.raises(ValueError, match="No buckets by day"):
        eda.created_buckets(df, "day")


def test_leak_check(spark, report):
    assert json.loads(R.report_json(report)) == report
    one = spark.range(1)
    for bad in ("array(named_struct('summary', 1)) AS a", "named_struct('TOKEN', 1) AS a", "1 AS id", "map('x', named_struct('secrets', 2)) AS m"):
        with pytest.raises(R.LeakError):
            R._without_leaks(one.selectExpr("2 AS n", bad))
    for bad in ("array('my external_ticket_id')", "named_struct('x', 'API_KEY')", "'a Secret'"):
        with pytest.raises(Exception, match="marker that must stay inside"):
            R._without_leaks(one.selectExpr("2 AS n", f"{bad} AS a")).collect()
    assert R._without_leaks(one.selectExpr("2 AS n", "'plain' AS a")).collect() == [(2, "plain")]


def test_scope_filter_reaches_the_scan(spark, tmp_path):
    stored(spark, ROWS).write.parquet(str(tmp_path / "t"))
    table = spark.read.schema(STORED).parquet(str(tmp_path / "t"))
    plan = eda.distributions(table, date(2025, 1, 1))._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ticket_created_at), GreaterThanOrEqual(ticket_created_at" in plan
    assert "ReadSchema: struct<status:string,priority:string,category:string,ticket_created_at:timestamp>" in plan
