"""The ingest over a folder that pages keep landing in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from guichet.plans.ingest import ingest_pages
from guichet.sources.pages import place_in_files, with_line


def page_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000, one_per_line: bool = False) -> DataFrame:
    """New page files, as :func:`guichet.sources.pages.place_in_files` gives them; the files that landed first come first."""
    reader = spark.readStream.option("wholetext", not one_per_line).option("maxFilesPerTrigger", files_per_batch)
    return place_in_files(reader.text(folder))


def ingest_stream(
    spark: SparkSession,
    folder: str,
    root: str,
    checkpoint: str,
    *,
    files_per_batch: int = 1000,
    one_per_line: bool = False,
    **options,
) -> StreamingQuery:
    """Ingest what has landed since the last run, then stop.

    Files apply in the order they landed from one batch to the next, and by name within
    a batch; names that sort in landing order give the same table for any batch size.
    Merging a batch again leaves the table as it is, so a batch that is replayed
    after a failure does no harm.
    """

    def save(batch: DataFrame, _batch_id: int) -> None:
        ingest_pages(with_line(batch), root, **options)

    pages = page_stream(spark, folder, files_per_batch, one_per_line)
    writer = pages.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
