"""Binding of an order / line-item star schema to the customer and transaction frames.

Each line item is a transaction of the customer who placed its order. Customer keys stay
numeric: they join and shuffle faster than text.
"""

from __future__ import annotations

import os
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientbook import schemas as s
from clientbook.functions.money import whole
from clientbook.operators.partitioning import stored_bytes, tasks_for

FEE_RATE = Decimal("0.20")
"""Part of a line's discount that counts as fee income."""


# Columns in use, with their stored types. Declared, so that opening a table starts no job.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double,"
        " l_discount double, l_returnflag string"
    ),
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(os.path.join(folder, f"{name}.parquet"))


def _manager_id(nation_key: str):
    return F.concat(F.lit("RM"), F.lpad(F.col(nation_key).cast("string"), 3, "0"))


def customers(
    spark: SparkSession,
    folder: str,
    with_onboarding: bool = False,
    with_region: bool = True,
) -> DataFrame:
    """The customer list.

    The onboarding date costs a pass over the orders and the region two small lookups; both
    are optional, because an outer join stays in the plan even if its columns are not used.
    Without the region there is no such column, so a view that shows it fails.
    """
    listed = read_table(spark, folder, "customer")
    region, first_order = [], F.lit(None)
    if with_region:
        nations, regions = read_table(spark, folder, "nation"), read_table(spark, folder, "region")
        places = nations.join(regions, nations.n_regionkey == regions.r_regionkey, "left")
        listed = listed.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        region = [F.col("r_name").alias("region")]
    if with_onboarding:
        firsts = (
            read_table(spark, folder, "orders")
            .groupBy("o_custkey")
            .agg(F.min("o_orderdate").alias("first_order"))
        )
        listed = listed.join(firsts, F.col("c_custkey") == F.col("o_custkey"), "left")
        first_order = F.col("first_order")
    return listed.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_type"),
        first_order.cast("date").alias("onboarding_date"),
        _manager_id("c_nationkey").alias("relationship_manager"),
        *region,
        F.lit(1).alias("is_active"),
    )


def relationship_managers(spark: SparkSession, folder: str) -> DataFrame:
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return joined.select(
        _manager_id("n_nationkey").alias("rm_id"),
        F.col("n_name").alias("rm_name"),
        F.lit(None).cast("string").alias("rm_grade"),
        F.col("r_name").alias("team"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    kinds = read_table(spark, folder, "part").select(F.col("p_type").alias("product_id")).distinct()
    return kinds.select(
        "product_id",
        F.col("product_id").alias("product_name"),
        F.lit(None).cast("string").alias("product_category"),
        F.lit(1).alias("is_core_product"),
    )


def _by_order(lines: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides cut by the order into tasks of a set size, unless they are few or the orders fit a broadcast."""
    spark, held = lines.sparkSession, stored_bytes(orders)
    tasks = tasks_for(stored_bytes(lines) + held, spark.sparkContext.defaultParallelism)
    threshold = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if tasks is None or held <= threshold:
        return lines, orders
    return lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")


def transactions(spark: SparkSession, folder: str, with_product: bool = True) -> DataFrame:
    """Line items as transactions.

    The date is a plain cast of the order date, which the scan of the orders can still turn
    into a pushed-down range. Leave the product out when a query does not need it: an outer
    join is not removed by the optimiser. There is then no such column, so product depth fails. No join side is forced to be broadcast; whether the
    parts are small enough is decided from their measured size.
    """
    lines, orders = _by_order(read_table(spark, folder, "lineitem"), read_table(spark, folder, "orders"))
    facts = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    product = []
    if with_product:
        parts = read_table(spark, folder, "part").select("p_partkey", "p_type")
        facts = facts.join(parts, facts.l_partkey == parts.p_partkey, "left")
        product = [F.col("p_type").alias("product_id")]
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    fee = F.round(price * discount * F.lit(FEE_RATE), 2)
    # The same two amounts in whole pennies: prices and discounts have two decimals, so the
    # products are whole numbers and one division is left to round.
    price_pennies = whole(F.col("l_extendedprice") * 100)
    discount_percent = whole(F.col("l_discount") * 100)
    rate_percent = int(FEE_RATE * 100)
    return facts.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        *product,
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.col("l_returnflag").alias("transaction_type"),
        F.col("o_orderpriority").alias("channel"),
        F.col("l_extendedprice").cast(s.MONEY).alias("transaction_value"),
        fee.cast(s.FEE).alias("fee_revenue"),
        price_pennies.alias("value_pennies"),
        whole(price_pennies * discount_percent * rate_percent / 10000).alias("fee_pennies"),
    )
