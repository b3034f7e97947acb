"""Publishing a snapshot: facts as Parquet, partitioned by snapshot date.

The transactions are read once. The scored book is written first; every fact is derived from
the stored book, so a lost executor or a failed fact never repeats the big scan. Writing the
same date again replaces that date's partition of every table and leaves the others alone.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientbook.config import PortfolioConfig
from clientbook.operators.staging import staged
from clientbook.plans.portfolio import Portfolio
from clientbook.plans.quality import require_non_empty
from clientbook.sources.csv_files import path_exists

BOOK = "customer_book"
FACTS = {
    "fct_customer_360": Portfolio.customer_360,
    "fct_customer_segments": Portfolio.customer_segments,
    "fct_customer_health": Portfolio.customer_health,
    "fct_concentration": Portfolio.concentration,
    "fct_rm_actions": Portfolio.rm_actions,
    "fct_exceptions": Portfolio.exceptions,
    "fct_executive_kpis": Portfolio.executive_kpis,
}
_DATE = "snapshot_date"


def publish(df: DataFrame, path: str, day: str, partition: str = _DATE) -> None:
    """Replace the partition of ``day``, also if ``df`` has no rows."""
    df.drop(partition).write.mode("overwrite").parquet(os.path.join(path, f"{partition}={day}"))


def is_published(spark: SparkSession, root: str, cfg: PortfolioConfig) -> bool:
    """True if a run of this date has finished: its KPI row is withdrawn first and written last."""
    day = cfg.snapshot_date.isoformat()
    kpis = os.path.join(root, "fct_executive_kpis", f"{_DATE}={day}")
    return path_exists(spark, kpis) and not spark.read.parquet(kpis).isEmpty()


def run_snapshot(book: Portfolio, root: str, overwrite: bool = True) -> Portfolio:
    """Build and publish all facts; with ``overwrite=False`` a finished date is left alone.

    The new book is staged and checked before anything of the date is replaced, so a run over
    empty inputs leaves what is stored. A run that fails later leaves the date unpublished.
    """
    spark, cfg = book.spark, book.cfg
    day = cfg.snapshot_date.isoformat()
    if not overwrite and is_published(spark, root, cfg):
        return open_snapshot(spark, root, cfg)
    fresh = staged(book.book)
    require_non_empty(Portfolio.from_book(fresh, cfg).customer_360(), "fct_customer_360")
    kpis = os.path.join(root, "fct_executive_kpis")
    if is_published(spark, root, cfg):
        shown = spark.read.parquet(os.path.join(kpis, f"{_DATE}={day}")).schema
        publish(spark.createDataFrame([], shown), kpis, day)
    publish(fresh, os.path.join(root, BOOK), day)
    stored = open_snapshot(spark, root, cfg, book.book.schema)
    for table, build in FACTS.items():
        publish(build(stored), os.path.join(root, table), day)
    if not is_published(spark, root, cfg):
        raise RuntimeError(f"snapshot {cfg.snapshot_date} is incomplete under {root}")
    return stored


def open_snapshot(
    spark: SparkSession, root: str, cfg: PortfolioConfig, schema: T.StructType | None = None
) -> Portfolio:
    """All facts, views and queries over a published date: only its partition is read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    stored = reader.parquet(os.path.join(root, BOOK))
    return Portfolio.from_book(stored.filter(F.col(_DATE) == F.lit(cfg.snapshot_date)), cfg)


def read_fact(spark: SparkSession, root: str, table: str, cfg: PortfolioConfig) -> DataFrame:
    stored = spark.read.parquet(os.path.join(root, table))
    return stored.filter(F.col(_DATE) == F.lit(cfg.snapshot_date))
