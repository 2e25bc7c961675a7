from datetime import date

import pytest

from guichet.operators import lifecycle
from guichet.sources import storage

DUE = date(2026, 3, 1)
SCHEMA = "id int, import_batch_id string, validation_status string, data_retention_until date"
ROWS = [
    (1, "a", "valid", date(2026, 1, 1)),
    (2, "a", "rejected", date(2026, 1, 1)),
    (3, "b", "valid", date(2026, 2, 28)),
    (4, "b", "valid", DUE),
    (5, "b", None, None),
    (6, "b", "valid", date(2030, 1, 1)),
]


@pytest.fixture
def stored(spark, tmp_path):
    path = f"{tmp_path}/rows"
    lifecycle.store_by_deadline(spark.createDataFrame(ROWS, SCHEMA).repartition(3), path)
    return path


def test_only_expired_folders_go(spark, stored, tmp_path):
    before = {f: (tmp_path / "rows" / f).stat().st_mtime_ns for f in storage.list_folder(spark, stored)}
    assert lifecycle.drop_expired(spark, stored, DUE, f"{tmp_path}/log") == 3
    left = {f: (tmp_path / "rows" / f).stat().st_mtime_ns for f in storage.list_folder(spark, stored)}
    assert left == {f: t for f, t in before.items() if "2026-01-01" not in f and "2026-02-28" not in f}
    assert sorted(r["id"] for r in spark.read.parquet(stored).collect()) == [4, 5, 6]
    log = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/log").select("import_batch_id", "retention_deadline", "records_deleted_count").collect())
    assert log == [("a", date(2026, 1, 1), 2), ("b", date(2026, 2, 28), 1)]
    assert lifecycle.drop_expired(spark, stored, DUE, f"{tmp_path}/log") == 0


def test_a_purge_reads_no_live_folder(spark, stored, tmp_path):
    for f in storage.list_folder(spark, stored):
        if "2030" in f or "HIVE" in f:
            for file in (tmp_path / "rows" / f).glob("*"):
                file.write_bytes(b"not a table file")  # reading it would fail
            for file in (tmp_path / "rows" / f).glob(".*.crc"):
                file.unlink()
    assert lifecycle.drop_expired(spark, stored, DUE, f"{tmp_path}/log") == 3


def test_one_date_of_most_rows_is_split_and_a_rare_one_is_not(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("cast(id as int) id", "'a' import_batch_id", "'valid' validation_status", "date'2026-01-01' + cast(id % 4000 = 0 as int) data_retention_until")
    lifecycle.store_by_deadline(rows.repartition(8), f"{tmp_path}/t")
    assert len(list((tmp_path / "t").glob("data_retention_until=2026-01-02/*.parquet"))) == 1


def test_counters_come_from_the_writing_job(spark, tmp_path):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("observed", "")
    got = lifecycle.import_observed(spark.createDataFrame(ROWS, SCHEMA).repartition(4), f"{tmp_path}/t")
    assert got == {"records_seen_count": 6, "records_accepted_count": 4, "records_rejected_count": 1}
    assert len(jobs.getJobIdsForGroup("observed")) <= 2  # the shuffle above and the write: no second scan
    assert spark.read.parquet(f"{tmp_path}/t").count() == 6
    none = lifecycle.import_observed(spark.createDataFrame([], SCHEMA), f"{tmp_path}/t")
    assert set(none.values()) == {0}


def test_counters_of_a_stream(spark, tmp_path):
    landed = f"{tmp_path}/landed"
    spark.createDataFrame(ROWS, SCHEMA).coalesce(1).write.parquet(landed)
    for more, seen in (([], [6]), (ROWS[:2], [2]), ([], [])):
        if more:
            spark.createDataFrame(more, SCHEMA).coalesce(1).write.mode("append").parquet(landed)
        got = lifecycle.import_stream(spark.readStream.schema(SCHEMA).parquet(landed), f"{tmp_path}/t", f"{tmp_path}/checkpoint")
        assert [r["records_seen_count"] for r in got] == seen
    assert spark.read.parquet(f"{tmp_path}/t").count() == 8


def test_a_move_that_breaks_off_loses_nothing(spark, tmp_path):
    target, draft = f"{tmp_path}/t", f"{tmp_path}/draft"
    spark.range(3).write.parquet(target)
    with pytest.raises(storage.StorageError, match="into place"):
        storage.move(spark, draft, target)  # there is no draft
    assert spark.read.parquet(target).count() == 3
    # A driver lost between the two renames leaves the old folder aside.
    (tmp_path / "t").rename(tmp_path / ".t.old")
    storage.settle(spark, target)
    assert spark.read.parquet(target).count() == 3
    spark.range(5).write.parquet(draft)
    storage.move(spark, draft, target)
    assert spark.read.parquet(target).count() == 5 and not (tmp_path / ".t.old").exists()
    # One lost after both leaves the old one too; the new one counts.
    spark.range(1).write.parquet(f"{tmp_path}/.t.old")
    storage.settle(spark, target)
    assert spark.read.parquet(target).count() == 5 and not (tmp_path / ".t.old").exists()
