"""Customers and transactions stored for per-customer work: bucketed and sorted by customer.

Both tables are cut into the same number of buckets by the customer's hash. What is grouped by customer
or joined on it then needs no shuffle, however often it is asked for: the shuffle was paid once, on writing.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from clientbook.config import PortfolioConfig
from clientbook.plans.portfolio import Portfolio

KEY = "customer_id"


def store(df: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Write ``df`` as a bucketed, sorted table of the session's catalogue and read it.

    Rows are brought together by bucket first, so that a bucket is one file, not one per task. Buckets
    should hold some 100 to 200 MB each. A customer with a large part of all rows makes one bucket
    large; the aggregates over it still shrink those rows before anything else happens to them.
    """
    (
        df.repartition(buckets, KEY)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, KEY)
        .sortBy(KEY)
        .option("path", path)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def store_inputs(book: Portfolio, name: str, folder: str, buckets: int = 64) -> Portfolio:
    """The portfolio over bucketed copies of its inputs, as tables ``name``_customers and ``name``_transactions."""
    customers = store(book.customers, f"{name}_customers", os.path.join(folder, "customers"), buckets)
    transactions = store(book.transactions, f"{name}_transactions", os.path.join(folder, "transactions"), buckets)
    return Portfolio(customers, transactions, book.cfg, colocated=True)


def open_inputs(spark: SparkSession, name: str, cfg: PortfolioConfig) -> Portfolio:
    """The portfolio over inputs that :func:`store_inputs` has stored."""
    return Portfolio(spark.table(f"{name}_customers"), spark.table(f"{name}_transactions"), cfg, colocated=True)
