"""Positions of rows inside ordered groups, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import stored

TASK_ROWS = 1 << 20


def task_count(spark, rows: int, task_rows: int = TASK_ROWS) -> int:
    """Tasks for ``rows`` rows: the session's shuffle partitions, more when tasks would grow large."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // task_rows))


def spread_in_order(df: DataFrame, order: list[str], rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """Rows range-partitioned and sorted by ``order`` (nulls first). A last key, the row's place in its input file,
    splits rows that are equal in ``order``, so one hot value spans several tasks. ``df`` should be stored."""
    keyed = df.withColumn("_tie", F.monotonically_increasing_id())
    return (keyed.repartitionByRange(task_count(df.sparkSession, rows, task_rows), *order, "_tie")
            .sortWithinPartitions(*order, "_tie").drop("_tie"))


def ranked(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` (stored by the caller) with ``pos``, the 0-based place of the row in its group, and ``n``, the size of the
    group. ``group`` is a string without nulls. Tasks number their own rows; one row per (group, task) carries the
    offsets; rows equal in ``order`` come in any order."""
    sorted_rows = spread_in_order(df, [group, *order], df.count())
    names = df.columns
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column(names.index(group)).dictionary_encode()
            index = codes.indices.to_numpy(zero_copy_only=False)
            start = np.flatnonzero(np.concatenate(([True], index[1:] != index[:-1])))
            length = np.diff(np.concatenate((start, [len(index)])))
            at = np.arange(len(index)) - np.repeat(start, length)
            first = codes.dictionary[int(index[0])].as_py()
            if first == last:
                at[: length[0]] += seen
            seen = int(at[-1]) + 1
            last = codes.dictionary[int(index[-1])].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(index), pid), pa.int32()), pa.array(at, pa.int64())],
                                             names=[*names, "_pid", "_at"])

    numbered = stored(sorted_rows.mapInArrow(number, f"{types}, _pid int, _at long"), name)
    counts = numbered.groupBy(group, "_pid").agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_pid", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"), F.sum("_c").over(whole).alias("n"))
    return numbered.join(offsets, [group, "_pid"]).withColumn("pos", F.col("_before") + F.col("_at")).select(*names, "pos", "n")
