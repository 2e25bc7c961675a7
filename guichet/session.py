"""Session settings the jobs rely on."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on, and let adaptive execution size the shuffles."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "+00:00", "Z"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder for intermediate tables, under the one the cluster names.

    ``spark.checkpoint.dir`` has to be reachable by every executor. A session that runs
    in one process, as in tests, may do without: it gets a folder that goes with it.
    Anywhere else the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="guichet-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/guichet-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The same rows from a table in the shared folder: recovery does not go back further, and joins can split frequent keys.

    What was shuffled for the table goes as soon as it is written, and does not wait on the
    disks for the driver to collect its garbage.
    """
    spark = df.sparkSession
    path, before = shared_folder(spark), spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_GO)
        else:
            spark.conf.set(_SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Removes tables that ``written`` made and nothing reads any more."""
    for table in tables:
        for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(docs: DataFrame, rows: int = 1000) -> None:
    """Whole texts go to Python at most ``rows`` at a time; a session's smaller number stays."""
    conf = docs.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
