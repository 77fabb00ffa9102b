"""Running totals inside groups of any size: range partitions first, their offsets second."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.llm.staging import shuffle_width, staged


def running_totals(rows: DataFrame, group: str, order: list[str], value: str, name: str) -> DataFrame:
    """`rows` with a long column `before`: the sum of `value` over the rows of the same `group` (a long, not null)
    that come earlier in `order`. Rows that tie in `order` keep one order, as the result is written once.

    Rows are dealt out by ranges of (group, order), so a group may fill many partitions and none is gathered. Each
    partition sums its own rows; a table with one row for each group and partition carries the sums across."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, carried = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups, values = batch.column(group).to_numpy(), batch.column(value).to_numpy()
            first = np.concatenate(([True], groups[1:] != groups[:-1]))
            sums = np.cumsum(values) - values
            base = np.maximum.accumulate(np.where(first, np.arange(len(groups)), 0))
            before = sums - sums[base]
            before[groups == last] += carried if last is not None else 0
            last, carried = groups[-1], int(before[-1] + values[-1])
            yield pa.record_batch({
                **{c: batch.column(c) for c in batch.schema.names},
                "part": pa.array(np.full(len(groups), part, np.int32)), "before": pa.array(before, pa.int64()),
            })

    added = [T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType())]
    schema = T.StructType([*rows.schema.fields, *added])
    sorted_rows = rows.repartitionByRange(shuffle_width(rows.sparkSession), group, *order).sortWithinPartitions(group, *order)
    local = staged(sorted_rows.mapInArrow(work, schema), name)
    sums = local.groupBy(group, "part").agg(F.sum(value).alias("sum"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(group, "part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("offset"))
    return local.join(offsets, [group, "part"]).withColumn("before", F.col("before") + F.col("offset")).drop("part", "offset")
