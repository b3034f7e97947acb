"""Small helpers that several operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientbook.operators.staging import staged

#: What counts as a word: a run of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_in(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(seed: str, *columns: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the column values alone."""
    parts = [F.coalesce(column.cast("string"), F.lit("")) for column in columns]
    digest = F.md5(F.concat_ws(":", F.lit(seed), *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2**52)


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def slices(batch: pa.RecordBatch, text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``most`` bytes of text, or one row."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // most
    start = 0
    for end in [*(np.flatnonzero(np.diff(part)) + 1), len(sizes)]:
        if end > start:
            yield batch.slice(start, end - start)
        start = end


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Connected components of an edge list: (``node``, ``component``), the smallest node reached.

    Alternates two star contractions until the edges stop changing, in a number of rounds that
    grows with the logarithm of the path lengths. Each round's edges are written to the shared
    folder, so lineage stays short and a lost executor costs one round. Minima are aggregated
    before they are joined, and the join can be split where one node has most of the edges.
    """
    now = staged(
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .filter("u > v")
        .distinct()
    )

    def stars(both: DataFrame, towards: str) -> DataFrame:
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        joined = both.join(least, "u").withColumn("m", F.least("u", "m"))
        if towards == "large":
            found = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            found = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                joined.select("u", F.col("m").alias("v"))
            )
        return found.filter("u > v").distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())

    seen = mark(now)
    while True:
        large = stars(now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), "large")
        now = staged(stars(large, "small"))
        if (found := mark(now)) == seen:
            break
        seen = found
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def parts_for(total_bytes: int | None, each: int) -> int:
    return max(1, math.ceil((total_bytes or 0) / each))
