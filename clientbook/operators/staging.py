"""Cutting lineage where two branches of one plan must not recompute the big scan."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in only in local mode, where driver and executors are one
    process; on a cluster a missing setting is an error, not a machine-local default.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="clientbook-")
    return _local_folder


_local_folder: str | None = None


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the stored rows.

    Stored rows outlive executors, and a second branch reads just its columns of them
    instead of repeating the work. Callers pass the narrowest frame they can: one short row
    per customer. Parquet rather than an RDD checkpoint, because it is a fraction of the size
    and keeps column pruning and statistics for the branches that follow.
    """
    path = "/".join((shared_folder(df.sparkSession), "clientbook-stage", uuid.uuid4().hex))
    _stages.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_stages: dict[str, list[str]] = {}


def close_stages(spark: SparkSession) -> int:
    """Remove what this application has staged and tell how many folders went; nothing may still read them."""
    context, paths = spark.sparkContext, _stages.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
    return len(paths)
