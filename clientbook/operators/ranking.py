"""Total order, rank and running total over a frame of any size.

A window without a partition would pull every row into one task. Instead the rows are
range-partitioned by the ranking order, ranked inside each slice, and each slice is shifted
by what the slices before it hold. Ties on the ranked value never pile up in one slice,
because the tie-breaking key is part of the range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientbook.operators.staging import staged


def rank_and_accumulate(
    df: DataFrame,
    value: str,
    tie_break: str,
    slices: int | None = None,
    is_stored: bool = False,
    following: str | None = None,
) -> DataFrame:
    """Add ``revenue_rank``, ``cumulative`` and ``grand_total`` by ``value`` descending.

    With ``following`` a column of that name holds the value one rank below, null for the last row.

    Range partitioning samples its input before it reads it, so an input that is not stored
    yet is staged first. The slice number is stored with the rows as well: a second use of
    the frame must not draw the slices again.
    """
    order = [F.col(value).desc(), F.col(tie_break).asc()]
    source = df if is_stored else staged(df)
    ranged = source.repartitionByRange(*([slices] if slices else []), *order)
    in_slice = Window.partitionBy("slice").orderBy(*order)
    local = staged(
        ranged.withColumn("slice", F.spark_partition_id())
        .withColumn("rank_in_slice", F.row_number().over(in_slice))
        .withColumn(
            "cumulative_in_slice",
            F.sum(value).over(in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
        .withColumns({} if following is None else {following: F.lead(value).over(in_slice)})
    )
    # One row per slice, i.e. at most spark.sql.shuffle.partitions rows whatever the data
    # size: the un-partitioned window and the broadcast below are bounded by that number.
    totals = local.groupBy("slice").agg(
        F.count(F.lit(1)).alias("slice_rows"), F.sum(value).alias("slice_total"), F.max(value).alias("slice_first")
    )
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("slice").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = totals.select(
        "slice",
        F.coalesce(F.sum("slice_rows").over(before), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("slice_total").over(before), F.lit(0)).alias("total_before"),
        F.sum("slice_total").over(everything).alias("grand_total"),
        F.lead("slice_first").over(Window.orderBy("slice")).alias("next_slice_first"),
    )
    ranked = (
        local.join(F.broadcast(offsets), "slice")
        .withColumn("revenue_rank", F.col("rows_before") + F.col("rank_in_slice"))
        .withColumn("cumulative", F.col("total_before") + F.col("cumulative_in_slice"))
        .drop(
            "slice",
            "rank_in_slice",
            "cumulative_in_slice",
            "rows_before",
            "total_before",
        )
    )
    if following is not None:
        # The last row of a slice is followed by the first of the next one.
        ranked = ranked.withColumn(following, F.coalesce(F.col(following), F.col("next_slice_first")))
    return ranked.drop("next_slice_first")


def at_the_top(df: DataFrame, value: str, tie_break: str, n: int, counted: Column) -> DataFrame:
    """The rows that do not come after the ``n``-th of the ``counted`` ones: all that its rank depends on.

    ``df`` is stored and read twice: each task keeps ``n`` candidates, and one row holds the bound.
    """
    order = F.struct((-F.col(value)).alias("value"), F.col(tie_break).alias("tie"))
    bound = (
        df.filter(counted).select(order.alias("place")).orderBy("place").limit(n).agg(F.max("place").alias("bound"))
    )
    return df.crossJoin(F.broadcast(bound)).filter(order <= F.col("bound")).drop("bound")


def top_ranked(df: DataFrame, value: str, tie_break: str, n: int) -> DataFrame:
    """The first ``n`` rows with their rank; each task keeps ``n`` rows, then they are merged.

    The un-partitioned window only sees the ``n`` rows that survive the limit.
    """
    order = [F.col(value).desc(), F.col(tie_break).asc()]
    return (
        df.orderBy(*order)
        .limit(n)
        .withColumn("revenue_rank", F.row_number().over(Window.orderBy(*order)))
    )
