"""Dry run of the feature dataset: counters and gates as one row, nothing written."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guichet import fixed_values as fv
from guichet.operators import contract, features as feats
from guichet.operators.features import build_features, planned_columns
from guichet.operators.scope import scope_counts

# FIXED VALUES: gate names, in report order
_GATES = (
    "no_forbidden_columns",
    "no_residual_pii",
    "no_detected_secrets",
    "no_exact_timestamps",
    "no_raw_text_columns",
    "feature_rows_match_allowlist",
    "no_dataset_output_path",
)


def dry_run_report(
    records: DataFrame, min_created: date = fv.MIN_TICKET_CREATED_AT, output_path_attempted: bool = False
) -> DataFrame:
    """One row in the report's column order.

    The scope counters read the creation date only; the feature scan runs beside
    them, and both meet as two one-row results in a final aggregation.
    """
    features = build_features(records, min_created)
    broken = contract.breaches(records.columns, contract.INPUT) + contract.breaches(planned_columns(), contract.OUTPUT)
    both = scope_counts(records, min_created).unionByName(feats.feature_metrics(features), allowMissingColumns=True)
    names = [c for c in both.columns if c != "applied_min_ticket_created_at"]
    row = both.agg(*(F.max(c).alias(c) for c in names))

    passed = {
        "no_forbidden_columns": F.lit(not broken["forbidden"]),
        "no_residual_pii": F.col("pii_official_residual_count") == 0,
        "no_detected_secrets": F.col("secret_scan_count") == 0,
        "no_exact_timestamps": F.lit(not broken["exact_timestamp"]),
        "no_raw_text_columns": F.lit(not broken["raw_text"]),
        "feature_rows_match_allowlist": F.lit(contract.matches_feature_schema(features)),
        "no_dataset_output_path": F.lit(not output_path_attempted),
    }
    gates = F.array(*(F.struct(F.lit(g).alias("name"), passed[g].alias("passed")) for g in _GATES))
    row = row.withColumn("gates", gates)
    status = F.when(F.forall("gates", lambda g: g["passed"]), "pass").otherwise("fail")
    fixed = {
        "dataset_version": F.lit(fv.DATASET_VERSION),
        "mode": F.lit("dry_run_no_export"),
        "status": status,
        "scope_min_ticket_created_at": F.lit(min_created.isoformat()),
        "planned_dataset_columns": F.array(*(F.lit(c) for c in planned_columns())),
        "forbidden_column_count": F.lit(broken["forbidden"]).cast("bigint"),
        "exact_timestamp_column_count": F.lit(broken["exact_timestamp"]).cast("bigint"),
        "raw_text_column_count": F.lit(broken["raw_text"]).cast("bigint"),
    }
    report = row.select(*(fixed.get(k, F.col(k)).alias(k) for k in fv.DRY_RUN_REPORT_KEYS))
    contract.assert_report_keys(report.columns)
    return report
