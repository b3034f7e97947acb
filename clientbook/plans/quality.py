"""Checks on inputs and facts."""

from __future__ import annotations

from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientbook.plans.portfolio import Portfolio

if TYPE_CHECKING:
    from clientbook.plans.releases import Release


def primary_keys(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table how many key values repeat, how many rows are surplus, and how many keys are null.

    The keys of all tables, as text and marked with their table, go through one shuffle. Counting is partly
    done before it, so even a value shared by a large part of the rows reaches one task as a few partial
    counts. A table without rows is reported as well.
    """
    keys = [
        df.select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("key"), F.lit(1).alias("n"))
        for name, (df, key) in tables.items()
    ]
    spark = keys[0].sparkSession
    names = spark.createDataFrame([(name, None, 0) for name in tables], "table_name string, key string, n int")
    per_key = reduce(DataFrame.unionByName, keys, names).groupBy("table_name", "key").agg(F.sum("n").alias("copies"))
    present = F.col("key").isNotNull()
    repeated = present & (F.col("copies") > 1)
    return per_key.groupBy("table_name").agg(
        F.count_if(repeated).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("copies") - 1)), F.lit(0)).alias("surplus_rows"),
        F.coalesce(F.sum(F.when(~present, F.col("copies"))), F.lit(0)).alias("null_keys"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _verdicts(counts: DataFrame) -> DataFrame:
    return counts.withColumn("is_ok", (F.col("row_count") > 0).cast("int"))


def non_empty(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and verdict per table."""
    return _verdicts(row_counts(tables))


def non_empty_release(spark: SparkSession, release: Release) -> DataFrame:
    """The same for the facts of a release, from the counts taken while they were written."""
    return _verdicts(spark.createDataFrame([(name, release.rows[name]) for name in release.rows if name.startswith("fct_")], "table_name string, row_count bigint"))


def require_non_empty(df: DataFrame, name: str) -> DataFrame:
    """Stop a run whose result would be empty; looks at one row only."""
    if df.isEmpty():
        raise ValueError(f"{name} returned no rows")
    return df


def pipeline_summary(book: Portfolio, facts: dict[str, DataFrame] | None = None) -> DataFrame:
    """Row counts of the inputs and of the facts: those built already, or the book's own."""
    lines = {
        "Transactions loaded": book.transactions.select("customer_id"),
        "Customers loaded": book.customers.select("customer_id"),
    }
    for table, (label, build) in _FACT_LINES.items():
        lines[label] = build(book) if facts is None else facts[table]
    return row_counts(lines).withColumnRenamed("table_name", "item")


def release_summary(book: Portfolio, release: Release) -> DataFrame:
    """:func:`pipeline_summary` of a release: inputs are counted, facts were counted while being written."""
    lines = [(label, release.rows[table]) for table, (label, _) in _FACT_LINES.items()]
    facts = book.spark.createDataFrame(lines, "item string, row_count bigint")
    inputs = {
        "Transactions loaded": book.transactions.select("customer_id"),
        "Customers loaded": book.customers.select("customer_id"),
    }
    return row_counts(inputs).withColumnRenamed("table_name", "item").unionByName(facts)


_FACT_LINES = {
    "fct_customer_360": ("Customer 360 records", Portfolio.customer_360),
    "fct_customer_health": ("Health-scored customers", Portfolio.customer_health),
    "fct_rm_actions": ("RM actions generated", Portfolio.rm_actions),
    "fct_exceptions": ("Exceptions detected", Portfolio.exceptions),
    "fct_executive_kpis": ("Executive KPI snapshots", Portfolio.executive_kpis),
}
