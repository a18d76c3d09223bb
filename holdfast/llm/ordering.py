"""Places of rows in one order over all tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import stage


def numbered(df: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """The rows of a written table with their place (from 0) in ``order``.

    Rows are dealt out by ranges and sorted in their tasks; the sizes of the tasks, a row each, give the
    place at which a task starts. Rows equal in ``order`` follow each other as the table holds them, and
    are dealt out too: no group of equal rows has to meet in one task.
    """
    tied = df.withColumn("_seq", F.monotonically_increasing_id())
    keys = [*order, F.col("_seq").asc()]
    ordered = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_seq")
    # the upper bits of this number are the task's, the lower 33 the row's
    ordered = stage(ordered.withColumn("_at", F.monotonically_increasing_id()), label)
    task, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = ordered.withColumn("_task", task).withColumn("_row", row).join(F.broadcast(starts), "_task")
    return placed.withColumn(name, F.col("_start") + F.col("_row")).drop("_at", "_task", "_row", "_start")
