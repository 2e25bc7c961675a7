"""Feature rows, contract, dry run and export against literal cases."""

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from guichet import fixed_values as fv
from guichet.operators import contract as C
from guichet.operators.features import build_features, feature_metrics
from guichet.operators.scope import records_in_scope, scope_counts
from guichet.plans import export as E
from guichet.plans.dry_run import dry_run_report
from guichet.schema import FEATURES
from guichet.sources import storage

SCHEMA = "summary string, details string, ticket_created_at string"


def records(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def one(df):
    return df.first().asDict(recursive=True)


def scope(spark, days, bound=fv.MIN_TICKET_CREATED_AT):
    df = spark.createDataFrame([(d,) for d in days], "ticket_created_at string")
    assert records_in_scope(df, bound).count() == scope_counts(df, bound).first().included_count
    return tuple(scope_counts(df, bound).first())[:4]


def test_scope(spark):
    assert scope(spark, ["2024-12-31", "2025-01-01", "2026-06-01T12:00:00Z", None]) == (4, 2, 1, 1)
    assert scope(spark, ["not-a-date", None, "2024-01-01"]) == (3, 0, 1, 2)
    assert scope(spark, ["2025-01-01", "2025-06-30", "2025-07-01"], date(2025, 7, 1)) == (3, 1, 2, 0)
    assert scope(spark, ["2024-12-31T23:30:00-05:00"]) == (1, 1, 0, 0)
    assert tuple(scope_counts(spark.createDataFrame([(1,)], "x int")).first())[:4] == (1, 0, 0, 1)
    assert scope_counts(spark.createDataFrame([(1,)], "x int")).first()[4] == "2025-01-01"


def test_feature_row(spark):
    rows = records(
        spark,
        (
            "Synthetic contact qa.person@example.test",
            "Call 06 12 34 56 78 then visit https://example.test/help " + "A" * 700,
            "2025-04-05",
        ),
        ("Old", "x", "2024-12-31"),
        ("Undated", "x", None),
    )
    features = build_features(rows)
    assert [f.name for f in features.schema] == FEATURES.fieldNames()
    (row,) = features.collect()
    assert len(row.cleaned_text_truncated) == row.cleaned_text_length == 512
    assert row.cleaned_text_truncated.startswith("synthetic contact [email] call [phone] then visit [url] aaa")
    assert (row.created_month, row.created_week, row.created_day_of_week) == (4, 14, 5)
    assert row.text_length_bucket == "long"
    assert (row.has_email_placeholder, row.has_phone_placeholder, row.has_url_placeholder) == (True, True, True)


def test_feature_text_follows_python(spark):
    from tests.test_text import naive_matches, naive_norm, texts

    values = texts(500, 21)
    rows = records(spark, *((v, values[-1 - i], "2025-01-01") for i, v in enumerate(values)))

    def expected(summary, details):
        once = naive_norm(f"{summary}\n{details}")
        base, hits = naive_norm(once), naive_matches(once)
        out, cursor = "", 0
        for a, b, name in hits:
            if a >= cursor:
                out += base[cursor:a] + fv.PII_REPLACEMENTS[name]
            cursor = max(cursor, b)
        text = out + base[cursor:] if hits else once
        return " ".join(text.lower().split())[:512]

    got = sorted(r.cleaned_text_truncated for r in build_features(rows).collect())
    want = sorted(expected(v, values[-1 - i]) for i, v in enumerate(values))
    assert got == want
    found = feature_metrics(build_features(rows)).first()
    assert found.transformed_count == 500
    assert found.pii_official_residual_count == sum(len(naive_matches(w)) for w in want)


@pytest.mark.parametrize(
    ("day", "features"),
    [("2025-06-02T13:14:15+00:00", (6, 23, 0)), ("2027-01-01", (1, 53, 4)), ("2025-12-29", (12, 1, 0))],
)
def test_calendar(spark, day, features):
    row = build_features(records(spark, ("a", "b", day))).first()
    assert (row.created_month, row.created_week, row.created_day_of_week) == features


@pytest.mark.parametrize("column", "external_ticket_id agent_id_pseudonym payload foo_id session_uuid created_at priority category raw_text cleaned_text".split())
def test_extra_input_column_is_forbidden(column):
    assert C.breaches([*fv.RAW_INPUT_COLUMNS, column], C.INPUT)["forbidden"] == 1
    assert C.breaches([*fv.FEATURE_COLUMNS, column], C.OUTPUT)["forbidden"] == 1


def test_column_contracts(spark):
    assert not C.breaches([c.upper() for c in fv.RAW_INPUT_COLUMNS], C.INPUT)
    assert not C.breaches(fv.FEATURE_COLUMNS, C.OUTPUT)
    assert C.breaches([*fv.FEATURE_COLUMNS, "ticket_created_at"], C.OUTPUT) == {"forbidden": 1, "exact_timestamp": 1}
    with pytest.raises(C.ContractError):
        C.assert_report_keys({"status": "pass", "summary": "text"})
    names = ["summary", "Created_At", "raw_text", "x", "CLEANED_TEXT", "date", "created_month"]
    for rules in (C.INPUT, C.OUTPUT):
        flags = spark.createDataFrame([(n,) for n in names], "n string").select("n", C.flags(F.col("n"), rules).alias("f")).collect()
        assert {r.n: r.f.asDict() for r in flags} == {n: {k: rule.broken_by(n) for k, rule in rules.items()} for n in names}


def gates(report):
    return {g["name"]: g["passed"] for g in report["gates"]}


def test_dry_run(spark):
    rows = [("Portal issue", "Narrative", "2025-03-10T08:15:00+00:00"), ("Archive", "Old", "2024-12-31"), ("No day", "x", None)]
    report = one(dry_run_report(records(spark, *rows)))
    assert tuple(report) == fv.DRY_RUN_REPORT_KEYS
    assert report["status"] == "pass" and all(gates(report).values())
    assert [report[k] for k in list(report)[4:8]] == [3, 1, 1, 1]
    assert "Narrative" not in json.dumps(report)

    leaky = one(dry_run_report(records(spark, ("Synthetic", "token: synthetic-placeholder", "2025-01-01"))))
    assert (leaky["status"], leaky["secret_scan_count"]) == ("fail", 1) and not gates(leaky)["no_detected_secrets"]

    extra = spark.createDataFrame([("a", "b", "2025-01-01", "x")], SCHEMA + ", foo_id string")
    extra = one(dry_run_report(extra, output_path_attempted=True))
    assert extra["forbidden_column_count"] == 1 and not gates(extra)["no_forbidden_columns"]
    assert not gates(extra)["no_dataset_output_path"]


ROW = ("Synthetic row marker alpha", "Synthetic row marker beta", "2025-01-15T09:30:00+00:00")


def test_export_writes_checked_folder(spark, tmp_path):
    target = tmp_path / "deep" / "ok.parquet"
    report = one(E.export_features(records(spark, ROW, ("old", "x", "2020-01-01"), ("none", "x", None)), requested=True, path=str(target)))
    assert tuple(report) == fv.EXPORT_REPORT_KEYS
    assert (report["status"], report["output_extension"], len(report["gates"])) == ("pass", ".parquet", 4)
    assert [report[k] for k in list(report)[4:8]] == [3, 1, 1, 1]
    assert "marker" not in json.dumps(report)
    assert spark.read.parquet(str(target)).count() == 1
    assert os.stat(target).st_mode & 0o777 == 0o700
    assert os.listdir(tmp_path / "deep") == ["ok.parquet"] or not any(f.endswith(".tmp") for f in os.listdir(tmp_path / "deep"))


def test_export_refusals(spark, tmp_path):
    rows, path = records(spark, ROW), str(tmp_path / "no.parquet")
    ask = {"requested": True, "path": path}
    cases = [
        ("not_requested", rows, {"path": path}),
        ("no_destination", rows, {"requested": True}),
        ("no_lifetime", rows, ask | {"ttl_hours": 0}),
        ("columns", rows.withColumnRenamed("details", "raw_text"), ask),
        ("findings_when_written", records(spark, ("x", "token: y", "2025-01-01")), ask),
        ("findings_when_written", records(spark, ("x", "-----BEGIN RSA PRIVATE KEY-----", "2025-01-01")), ask),
        ("findings_when_read_back", rows, ask | {"read_back": lambda s, p: {"pii_official_residual_count": 1, "secret_scan_count": 0}}),
    ]
    for code, df, options in cases:
        with pytest.raises(E.ExportRefused) as refused:
            E.export_features(df, **options)
        assert refused.value.code == code
        report = one(refused.value.report(spark))
        assert tuple(report) == fv.EXPORT_REPORT_KEYS and gates(report) == {code: False}
        assert (report["status"], report["mode"], report["expires_at_utc"]) == ("fail", "real_export_blocked", None)
        assert (report["pii_official_residual_count"] + report["secret_scan_count"] > 0) == code.startswith("findings")
    assert not [f for f in os.listdir(tmp_path) if "no.parquet" in f]
    assert storage.purge(spark, path) is False


def test_export_paths(tmp_path):
    (tmp_path / "work" / ".git").mkdir(parents=True)
    (tmp_path / "work" / "sub").mkdir()
    (tmp_path / "link").symlink_to(tmp_path / "work" / "sub")
    inside = os.path.join(os.path.dirname(E.__file__), "no.parquet")
    for bad in (str(tmp_path / "no.csv"), inside, f"file://{inside}", f"{tmp_path}/work/sub/a/no.parquet", f"{tmp_path}/link/no.parquet"):
        if not os.path.isdir(os.path.join(os.path.dirname(E.__file__), "..", "..", ".git")) and "guichet" in bad:
            continue
        with pytest.raises(storage.StorageError):
            storage.check_export_path(bad)
    assert storage.check_export_path("hdfs://name/x/y.PARQUET").path == "hdfs://name/x/y.PARQUET"
    assert storage.check_export_path(f"{tmp_path}/a/b.parquet").staging == f"{tmp_path}/a/.b.parquet.tmp"
