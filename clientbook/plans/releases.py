"""Publishing whole: all tables of a run lie under its id, and a manifest written last makes them the release.

A reader looks up the latest manifest of a date and from then on reads that run's folders only, so a later run
never changes what is being read. A run that dies has no manifest and is never seen: the date stays served as
it was. Rows are counted while they are written; the counts are part of the manifest, so summaries and
checks of a release look at no table again.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clientbook.config import PortfolioConfig
from clientbook.operators import activity
from clientbook.operators.staging import staged
from clientbook.plans.portfolio import Portfolio, scored_book
from clientbook.plans.snapshot import BOOK, FACTS
from clientbook.schemas import KEYS
from clientbook.sources.csv_files import path_exists

_MANIFEST = "sequence bigint, run_id string, tables map<string,bigint>, null_keys map<string,bigint>"


@dataclass(frozen=True)
class Release:
    """A finished run. ``rows`` and ``null_keys`` were counted while its tables were written."""

    root: str
    run_id: str
    sequence: int
    rows: dict[str, int] = field(compare=False)
    null_keys: dict[str, int] = field(compare=False)

    def path(self, table: str) -> str:
        return os.path.join(self.root, "runs", self.run_id, table)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self.path(table))


def _manifests(root: str, cfg: PortfolioConfig) -> str:
    return os.path.join(root, "manifests", f"snapshot_date={cfg.snapshot_date.isoformat()}")


def latest(spark: SparkSession, root: str, cfg: PortfolioConfig) -> Release | None:
    """The release of the date, or None. One small file per finished run is read."""
    folder = _manifests(root, cfg)
    if not path_exists(spark, folder):
        return None
    rows = spark.read.schema(_MANIFEST).json(os.path.join(folder, "*"))
    last = rows.orderBy(F.desc("sequence"), F.desc("run_id")).limit(1).collect()
    return Release(root, last[0].run_id, last[0].sequence, last[0].tables, last[0].null_keys or {}) if last else None


class Run:
    """Tables of a release to be. Nothing of it is seen before :meth:`commit`."""

    def __init__(self, spark: SparkSession, root: str, cfg: PortfolioConfig):
        self.spark, self.root, self.cfg = spark, root, cfg
        before = latest(spark, root, cfg)
        self.sequence = before.sequence + 1 if before else 1
        self.run_id = f"{self.sequence:08d}-{uuid.uuid4().hex}"
        self.rows: dict[str, int] = {}
        self.null_keys: dict[str, int] = {}

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Write and count a table; returns the stored rows.

        The counts are taken where the rows leave for the file, in the job's last stage. Below a shuffle a
        task that runs again after an executor is lost would count twice.
        """
        seen = Observation()
        key = KEYS.get(table, "customer_id")
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("null_keys"))
        path = os.path.join(self.root, "runs", self.run_id, table)
        counted.write.parquet(path)
        self.rows[table], self.null_keys[table] = seen.get["rows"], seen.get["null_keys"]
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self) -> Release:
        """The manifest is one file that its writer moves into place once it is complete."""
        missing = [table for table in (BOOK, *FACTS) if table not in self.rows]
        if missing:
            raise RuntimeError(f"run {self.run_id} lacks {', '.join(missing)}")
        row = [(self.sequence, self.run_id, self.rows, self.null_keys)]
        path = os.path.join(_manifests(self.root, self.cfg), f"run={self.run_id}")
        self.spark.createDataFrame(row, _MANIFEST).coalesce(1).write.json(path)
        return Release(self.root, self.run_id, self.sequence, self.rows, self.null_keys)


def _publish_book(spark: SparkSession, root: str, cfg: PortfolioConfig, book: DataFrame) -> Release:
    run = Run(spark, root, cfg)
    stored = Portfolio.from_book(run.write(BOOK, book), cfg)
    for table, build in FACTS.items():
        run.write(table, build(stored))
        if table == "fct_customer_360" and not run.rows[table]:
            raise ValueError("fct_customer_360 returned no rows")
    return run.commit()


def publish(book: Portfolio, root: str) -> Release:
    """Work out the book once, derive every fact from its stored rows, and release them together."""
    return _publish_book(book.spark, root, book.cfg, book.book)


def open_release(spark: SparkSession, release: Release, cfg: PortfolioConfig) -> Portfolio:
    """Every fact, view and query over one release, whatever is published after it."""
    return Portfolio.from_book(release.read(spark, BOOK), cfg)


def _same(left: str, right: str) -> Column:
    return F.col(f"{left}.customer_id").eqNullSafe(F.col(f"{right}.customer_id"))


def changed_customers(
    new_transactions: DataFrame, customers_before: DataFrame | None = None, customers_now: DataFrame | None = None
) -> DataFrame:
    """Ids whose book rows may differ: those with new transactions, and those whose own row is new, changed or gone."""
    ids = new_transactions.select("customer_id")
    if customers_before is not None and customers_now is not None:
        # Rows that stand on one side only, repeated rows included.
        ids = ids.union(customers_now.exceptAll(customers_before).select("customer_id"))
        ids = ids.union(customers_before.exceptAll(customers_now).select("customer_id"))
    return ids.distinct()


def refresh(previous: Release, book: Portfolio, changed: DataFrame) -> Release:
    """A release like that of a full run of ``book``, working out only the ``changed`` customers.

    The other customers' rows come from the previous release of the same date. ``book`` holds the whole
    inputs; semi joins bring them down to the changed customers before anything is aggregated.
    """
    spark, cfg = book.spark, book.cfg
    ids = staged(changed.select("customer_id").distinct()).alias("changed")
    kept = previous.read(spark, BOOK).alias("kept").join(ids, _same("kept", "changed"), "left_anti")
    listed = book.customers.alias("c").join(ids, _same("c", "changed"), "left_semi")
    facts = book.transactions.alias("t").join(ids, _same("t", "changed"), "left_semi")
    fresh = scored_book(listed, activity.customer_measures(facts, cfg), cfg)
    merged = kept.unionByName(fresh.select(*kept.columns))
    return _publish_book(spark, previous.root, cfg, merged)
