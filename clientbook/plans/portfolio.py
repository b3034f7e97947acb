"""From customers and transactions to every fact, as lazy frames."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientbook import config as c
from clientbook import schemas as s
from clientbook.config import PortfolioConfig
from clientbook.functions.money import from_pennies
from clientbook.operators import actions, activity, concentration, exceptions, kpis, profile
from clientbook.operators.staging import staged


def scored_book(customers: DataFrame, measures: DataFrame, cfg: PortfolioConfig) -> DataFrame:
    """Customers and their measures, joined once and scored column by column."""
    df = profile.open_book(customers, measures)
    df = profile.with_changes(profile.with_money(df))
    df = profile.with_engagement(df, cfg)
    df = profile.with_recency(df, cfg)
    df = profile.with_activity_trend(df, cfg)
    df = profile.with_rfm(df, cfg)
    df = profile.with_segments(df, cfg)
    df = profile.with_health(df, cfg)
    df = actions.with_actions(df, cfg)
    return df.withColumn("snapshot_date", F.lit(cfg.snapshot_date))


class Portfolio:
    """One snapshot of one customer portfolio.

    ``profile`` is the wide customer row. Facts that look at each customer on its own
    (segments, health, actions, alerts, watchlist …) are projections or filters of it and
    stay lazy: one pass over the transactions each. Facts that need the whole portfolio
    twice (concentration, KPIs, ladder) first stage a narrow frame, ``standing``.
    """

    def __init__(self, customers: DataFrame, transactions: DataFrame, cfg: PortfolioConfig, colocated: bool = False):
        self.customers = s.typed(customers, s.CUSTOMERS, "customer_id")
        self.transactions = s.typed(transactions, s.TRANSACTIONS, "customer_id")
        self.cfg = cfg
        self.colocated = colocated
        self.spark = customers.sparkSession

    @classmethod
    def from_book(cls, book: DataFrame, cfg: PortfolioConfig) -> Portfolio:
        """Serve from a stored book (see :mod:`clientbook.plans.snapshot`), not from raw data."""
        served = cls.__new__(cls)
        served.customers = served.transactions = None
        served.cfg, served.spark, served.colocated = cfg, book.sparkSession, False
        served.__dict__["book"] = book
        return served

    @property
    def is_stored(self) -> bool:
        """A stored book needs no staging and no second way to the segments."""
        return self.transactions is None

    # -- customer rows ---------------------------------------------------------------

    @cached_property
    def book(self) -> DataFrame:
        """Every customer id seen anywhere, scored; ``is_listed`` marks the customer list."""
        measures = activity.customer_measures(self.transactions, self.cfg, self.colocated)
        return scored_book(self.customers, measures, self.cfg)

    @cached_property
    def profile(self) -> DataFrame:
        """The wide row of each listed customer."""
        return self.book.filter("is_listed")

    @cached_property
    def movement(self) -> DataFrame:
        """Money, counts, trend and segments only.

        Needs neither products, channels nor dates outside the periods, so it reads fewer
        columns and rows and shuffles once. Enough for segment-level questions.
        """
        if self.is_stored:
            return self.profile
        totals = activity.period_totals(self.transactions, self.cfg, periods_only=True)
        df = profile.open_book(self.customers, totals)
        df = profile.with_changes(profile.with_money(df))
        df = profile.with_activity_trend(df, self.cfg)
        df = profile.with_segments(df, self.cfg)
        return df.filter("is_listed").withColumn("snapshot_date", F.lit(self.cfg.snapshot_date))

    @cached_property
    def standing(self) -> DataFrame:
        """Staged narrow row per customer for portfolio-level totals and top lists."""
        narrow = self.book.select(
            "customer_id",
            F.coalesce("is_listed", F.lit(False)).alias("is_listed"),
            "ltm_txns",
            "revenue_ltm",
            "revenue_90d",
            "revenue_prior_90d",
            "segment",
            "health_category",
            "action_type",
            exceptions.alert_count(self.cfg).alias("alerts"),
            exceptions.alert_count(self.cfg, c.P1).alias("urgent_alerts"),
        )
        return narrow if self.is_stored else staged(narrow)

    # -- operators of the profile, each on its own ------------------------------------
    # A stored book answers from its rows; customers without the activity asked for are absent.

    def _totals(self) -> DataFrame:
        if self.is_stored:
            return self.book.filter(F.col("last_txn_date").isNotNull())
        return profile.with_money(activity.period_totals(self.transactions, self.cfg))

    def _active(self) -> DataFrame:
        return self.book.filter(F.col("txn_count_90d") > 0)

    def revenue_by_period(self) -> DataFrame:
        return self._totals().select("customer_id", "revenue_ltm", "revenue_90d", "revenue_prior_90d")

    def activity_by_period(self) -> DataFrame:
        return self._totals().select(
            "customer_id",
            "txn_count_90d",
            "txn_count_prior_90d",
            "txn_volume_90d",
            "last_txn_date",
        )

    def product_usage(self) -> DataFrame:
        used = self._active() if self.is_stored else activity.product_count(self.transactions, self.cfg)
        return used.select("customer_id", "products_active")

    def channel_usage(self) -> DataFrame:
        used = self._active() if self.is_stored else activity.channel_mix(self.transactions, self.cfg)
        return used.select(
            "customer_id",
            F.col("txn_count_90d").alias("total_txns_90d"),
            F.col("digital_txns").alias("digital_txns_90d"),
            # The book shows a word where nothing is known.
            F.nullif("primary_channel", F.lit(c.NO_CHANNEL)).alias("primary_channel"),
        )

    def rfm(self) -> DataFrame:
        """Recency and its three scores of the listed customers: one aggregate, no product or channel."""
        if self.is_stored:
            return self.profile
        df = profile.open_book(self.customers, activity.period_totals(self.transactions, self.cfg))
        df = profile.with_recency(profile.with_money(df), self.cfg)
        return profile.with_rfm(df, self.cfg).filter("is_listed")

    def ltm_revenue(self) -> DataFrame:
        if self.is_stored:
            return concentration.earners(self.book).select("customer_id", "revenue_ltm")
        totals = activity.period_totals(self.transactions, self.cfg, periods_only=True)
        return concentration.earners(totals).select(
            "customer_id", from_pennies(F.col("ltm_pennies")).alias("revenue_ltm")
        )

    # -- facts -----------------------------------------------------------------------

    def customer_360(self) -> DataFrame:
        return s.conform(self.profile, s.CUSTOMER_360, keep_key_type="customer_id")

    def customer_segments(self) -> DataFrame:
        return s.conform(self.movement, s.CUSTOMER_SEGMENTS, keep_key_type="customer_id")

    def customer_health(self) -> DataFrame:
        return s.conform(self.profile, s.CUSTOMER_HEALTH, keep_key_type="customer_id")

    def rm_actions(self) -> DataFrame:
        return s.conform(self.profile, s.RM_ACTIONS, keep_key_type="customer_id")

    @cached_property
    def alerts(self) -> DataFrame:
        """Profile rows repeated per alert; the source of the exception fact and feed."""
        return exceptions.detect(self.profile, self.cfg)

    def exceptions(self) -> DataFrame:
        return s.conform(self.alerts, s.EXCEPTIONS, keep_key_type="customer_id")

    def exceptions_of(self, name: str) -> DataFrame:
        found = exceptions.detect_one(self.profile, self.cfg, name)
        return s.conform(found, s.EXCEPTIONS, keep_key_type="customer_id")

    def concentration(self) -> DataFrame:
        return s.conform(concentration.summarise(self.standing, self.cfg), s.CONCENTRATION)

    def exit_scenarios(self) -> DataFrame:
        return self.concentration().select(
            "snapshot_date", "scenario_top10_exit_risk", "scenario_critical_exit_risk"
        )

    def _executive_row(self) -> DataFrame:
        return kpis.executive_row(
            self.standing, concentration.summarise(self.standing, self.cfg)
        )

    def executive_kpis(self) -> DataFrame:
        return s.conform(self._executive_row(), s.EXECUTIVE_KPIS)

    def executive_summary(self) -> DataFrame:
        return kpis.executive_summary(self._executive_row(), self.cfg)
