"""A keyed table that a stream writes batch by batch, each batch in a folder of its own.

Writing a batch again replaces its folder, so a batch that is replayed after a failure changes nothing.
A key's row is that of the last batch which wrote it. Batch ids belong to one checkpoint: a stream that starts
from an empty checkpoint needs a new folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"


class BatchTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: tuple[str, ...]):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, keys

    def write(self, rows: DataFrame, batch_id: int) -> None:
        names = [field.name for field in self.schema]
        rows.select(*names).write.mode("overwrite").parquet(os.path.join(self.path, f"{BATCH}={batch_id}"))

    def stored(self) -> DataFrame:
        """All rows of all batches, with their batch ids."""
        self._ensure()
        schema = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())])
        return self.spark.read.schema(schema).parquet(self.path)

    def of_batch(self, batch_id: int) -> DataFrame:
        return self.stored().filter(F.col(BATCH) == batch_id).drop(BATCH)

    def current(self) -> DataFrame:
        """The last row of each key. Map tasks keep one row per key before anything is shuffled."""
        values = [field.name for field in self.schema if field.name not in self.keys]
        return (
            self.stored()
            .groupBy(*self.keys)
            .agg(F.max_by(F.struct(*values), BATCH).alias("last"))
            .select(*self.keys, *[F.col(f"last.{name}").alias(name) for name in values])
        )

    def _ensure(self) -> None:
        """Reading before the first batch gives no rows rather than a missing path."""
        from clientbook.sources.csv_files import path_exists

        if not path_exists(self.spark, self.path):
            self.write(self.spark.createDataFrame([], self.schema), -1)
