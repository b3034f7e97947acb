"""How many tasks a shuffle of the transactions is cut into, from the size of the stored inputs.

The adaptive planner merges shuffle partitions up to 64 MB of compressed rows, or to one per core; sorts and hash tables
over such a partition take several times that. Cut by the size of the inputs, a task's memory stays as it is when they grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

TASK_BYTES = 16 << 20
"""Stored bytes (Parquet) whose rows one task gets."""

_UNKNOWN = 2**63 - 1  # what Spark takes for the size of an RDD


def stored_bytes(df: DataFrame) -> int | None:
    """Size of the inputs of ``df`` as Spark knows it without running anything; None where it does not."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return None if any(size >= _UNKNOWN for size in sizes) else sum(sizes)


def tasks_for(size: int | None, cores: int) -> int | None:
    """Tasks for ``size`` stored bytes; None where Spark's own choice, about one per core, is as fine."""
    tasks = -(-(size or 0) // TASK_BYTES)
    return tasks if tasks > cores else None


def by_key(df: DataFrame, size: int | None, *keys: str) -> DataFrame:
    """The rows of a key in one partition, with as many partitions as ``size`` stored bytes call for."""
    tasks = tasks_for(size, df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(*keys) if tasks is None else df.repartition(tasks, *keys)
