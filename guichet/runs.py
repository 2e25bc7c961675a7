"""Work on groups of rows that are next to each other, many small groups at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_block_pairs(rows: DataFrame, group: str, member: str, blocks: Column) -> DataFrame:
    """``rows`` with own, i and j: each row once for every pair of blocks i <= j that its own block is part of.

    ``blocks`` is the same for all rows of a group. A pair of rows of a group meets in the
    pair of their blocks, and there only.
    """
    own = F.pmod(F.xxhash64(member), blocks).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
    rows = rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    return rows.drop("other")


def by_run(rows: DataFrame, keys: list[str], work: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on whole groups of equal ``keys`` (whole numbers).

    It gets a table of several groups, sorted, and where each begins (with the table's end as
    the last one). Only the last, unfinished group of a batch is kept in a task, so that
    groups have to be bounded and their number has not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            begins = _begins(held, keys)
            if len(begins) > 2:
                last = int(begins[-2])
                yield from work(held.slice(0, last).combine_chunks(), begins[:-1])
                held = held.slice(last)
        if held is not None:
            yield from work(held.combine_chunks(), _begins(held, keys))

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _begins(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        values = table[k].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)
