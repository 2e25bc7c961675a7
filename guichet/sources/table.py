"""The keyed ticket table, laid out so that texts are written once and never move again.

::

    root/buckets=00016/texts/batch=00000003/part=5/...          what the first row of a key sets for good
    root/buckets=00016/changes/from=00000002/batch=00000003/... what later rows change, a row per key and batch

Both parts are bucketed by key in the same number of buckets, and a bucket has a folder of
its own. So readers join the parts, and savers look up known keys, without a shuffle of what
is stored; savers read the keys of the buckets they touch. Metrics that need no text can read
the changes alone.

Folders are written hidden and moved into place when complete. A batch counts once its changes
are there; texts of a batch that never got that far are out of sight and are replaced when it
is tried again. :func:`compact` folds the changes, never the texts, when what is pending has
grown to a share of the rest, and removes what it replaces. One writer at a time.

The parts are named in the session's catalog, as external tables whose partitions are listed
from the folders.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guichet.operators.merge import FIRST_WINS, KEY, LAST_DATE_WINS, LAST_WINS, fold_changes, pick_first
from guichet.schema import STORED
from guichet.sources import storage

BUCKETS = 16
#: false: a table's partitions are listed from its folder, not kept in the catalog
_LISTED = "spark.sql.hive.manageFilesourcePartitions"
_TEXTS = (KEY, *FIRST_WINS, "ingested_at")
_CHANGES = (KEY, *LAST_WINS, *LAST_DATE_WINS)


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    names = storage.list_folder(spark, folder)
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def _name(folder: str) -> str:
    """The catalog's name of a part; the same for the same folder."""
    return f"guichet_{hashlib.md5(folder.encode()).hexdigest()}"


class _Layout:
    """Where the parts of a table are, and which batches they hold."""

    def __init__(self, spark: SparkSession, root: str, buckets: int) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets = (_numbers(spark, self.root, "buckets=") or [buckets])[0]
        self.home = f"{self.root}/buckets={self.buckets:05d}"
        self.texts = f"{self.home}/texts"
        self.since = (_numbers(spark, f"{self.home}/changes", "from=") or [0])[-1]
        self.changes = f"{self.home}/changes/from={self.since:08d}"
        self.batches = _numbers(spark, self.changes, "batch=")

    @property
    def last(self) -> int:
        return self.batches[-1] if self.batches else 0

    def read(self, folder: str, names: tuple[str, ...]) -> DataFrame:
        """A part as a bucketed table with the columns batch and part."""
        name = _name(folder)
        types = {f.name: f.dataType.simpleString() for f in STORED}
        columns = ", ".join([*(f"`{n}` {types[n]}" for n in names), "batch INT", "part INT"])
        before = self.spark.conf.get(_LISTED)
        self.spark.conf.set(_LISTED, "false")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS (path '{folder}') "
            f"PARTITIONED BY (batch, part) CLUSTERED BY ({KEY}) INTO {self.buckets} BUCKETS"
        )
        self.spark.conf.set(_LISTED, before)
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name).filter(F.col("batch") <= self.last)

    def part(self) -> F.Column:
        """The bucket of a key, as the bucketed writer numbers it."""
        return F.pmod(F.hash(KEY), F.lit(self.buckets))

    @contextmanager
    def published(self, df: DataFrame, target: str) -> Iterator[None]:
        """Write a part hidden; move it into place when the block is left without an error."""
        draft, name = f"{self.root}/_draft-{uuid.uuid4().hex}", f"guichet_{uuid.uuid4().hex}"
        try:
            rows = df.withColumn("part", self.part()).repartition(self.buckets, KEY)
            rows.write.partitionBy("part").bucketBy(self.buckets, KEY).option("path", draft).format("parquet").saveAsTable(name)
            self.spark.sql(f"DROP TABLE {name}")
            yield
            storage.move(self.spark, draft, target)
        except Exception:
            storage.purge(self.spark, draft)
            raise


def _empty(spark: SparkSession, names: tuple[str, ...]) -> DataFrame:
    return spark.createDataFrame([], T.StructType([STORED[n] for n in names]))


def _folded(changes: DataFrame) -> DataFrame:
    """One row per key over all batches, in their order; buckets stay where they are."""
    folded = changes.groupBy(KEY).agg(
        F.max_by(F.struct(*LAST_WINS), "batch").alias("_last"),
        *(F.max_by(d, F.when(F.col(d).isNotNull(), F.col("batch"))).alias(d) for d in LAST_DATE_WINS),
    )
    return folded.select(KEY, "_last.*", *LAST_DATE_WINS)


def current_changes(spark: SparkSession, root: str) -> DataFrame:
    """The stored tickets without their texts."""
    layout = _Layout(spark, root, BUCKETS)
    if not layout.batches:
        return _empty(spark, _CHANGES)
    return _folded(layout.read(layout.changes, _CHANGES))


def current(spark: SparkSession, root: str) -> DataFrame:
    """The stored tickets; an empty frame before the first batch."""
    layout = _Layout(spark, root, BUCKETS)
    if not layout.batches:
        return _empty(spark, tuple(STORED.fieldNames()))
    texts = layout.read(layout.texts, _TEXTS).drop("batch", "part")
    folded = _folded(layout.read(layout.changes, _CHANGES))
    # The changes of a bucket are hashed and its texts streamed past them; texts are not sorted.
    return texts.join(folded.hint("shuffle_hash"), KEY).select(*STORED.fieldNames())


def save_batch(batch: DataFrame, root: str, ingested_at: datetime, seq: str = "seq", *, buckets: int = BUCKETS, compact_at: float = 0.5) -> int:
    """Merge a batch of clean tickets into the table; returns how many keys were new.

    The texts of new keys and the folded changes of all keys of the batch are appended. When
    the batches since the last compaction hold more than ``compact_at`` times the rows of the
    folded part, the changes are folded. ``buckets`` is taken when the table is new; a bucket
    should fit into a task.
    """
    spark = batch.sparkSession
    layout = _Layout(spark, root, buckets)
    number = layout.last + 1
    target = f"{layout.changes}/batch={number:08d}"
    stamp = F.lit(ingested_at).cast("timestamp")
    with layout.published(fold_changes(batch, seq).select(*_CHANGES), target):
        firsts = fold_changes(batch, seq).select(KEY, "_first")
        if layout.batches:
            touched = [r[0] for r in firsts.select(layout.part().alias("part")).distinct().collect()]
            known = layout.read(layout.texts, _TEXTS).filter(F.col("part").isin(touched)).select(KEY)
            firsts = firsts.join(known, KEY, "left_anti")
        texts = pick_first(batch, firsts, seq).withColumn("ingested_at", stamp)
        with layout.published(texts.select(*_TEXTS), f"{layout.texts}/batch={number:08d}"):
            pass
    fresh = _Layout(spark, root, buckets)
    inserted = fresh.read(fresh.texts, _TEXTS).filter(F.col("batch") == number).count()
    if _is_due(fresh, compact_at):
        compact(spark, root)
    return inserted


def _is_due(layout: _Layout, share: float) -> bool:
    """Whether the changes since the last compaction outgrow their share; counted from file footers."""
    if len(layout.batches) < 2:
        return False
    rows = dict(layout.read(layout.changes, _CHANGES).groupBy("batch").count().collect())
    base = rows.pop(layout.since, 0) if layout.since else rows.pop(layout.batches[0], 0)
    return sum(rows.values()) > share * base


def compact(spark: SparkSession, root: str) -> bool:
    """Fold the changes of all batches into one and remove the others; False if there is nothing to fold."""
    layout = _Layout(spark, root, BUCKETS)
    if len(layout.batches) < 2:
        return False
    folded = _folded(layout.read(layout.changes, _CHANGES))
    home = f"{layout.home}/changes/from={layout.last:08d}"
    # Moved as a whole folder, so that readers see all of it or the part it replaces.
    draft = f"{layout.root}/_folded-{uuid.uuid4().hex}"
    try:
        with layout.published(folded.select(*_CHANGES), f"{draft}/batch={layout.last:08d}"):
            pass
        storage.move(spark, draft, home)
    except Exception:
        storage.purge(spark, draft)
        raise
    for number in _numbers(spark, f"{layout.home}/changes", "from=")[:-1]:
        old = f"{layout.home}/changes/from={number:08d}"
        spark.sql(f"DROP TABLE IF EXISTS {_name(old)}")
        storage.purge(spark, old)
    return True
