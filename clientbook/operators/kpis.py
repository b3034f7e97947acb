"""Portfolio KPIs: every count and sum of the KPI row in one aggregate over the customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientbook import config as c
from clientbook.config import PortfolioConfig
from clientbook.functions.money import from_pennies, share_pct, to_pennies
from clientbook.functions.rules import on_scale


def portfolio_totals(standing: DataFrame) -> DataFrame:
    """One row of counts over listed customers.

    ``open_actions`` and ``open_alerts`` style columns were reduced to numbers per customer
    beforehand, so actions and alerts need no pass of their own. As in the declared facts,
    sums over no rows are ``NULL`` while counts are 0.
    """
    segment, category, action = F.col("segment"), F.col("health_category"), F.col("action_type")

    def tally(condition):
        return F.sum(F.when(condition, 1).otherwise(0))

    everyone = F.count(F.lit(1))
    return standing.filter("is_listed").agg(
        everyone.alias("total_customers"),
        tally(segment != c.DORMANT).alias("active_customers"),
        tally(segment == c.DORMANT).alias("dormant_customers"),
        share_pct(F.count_if(category == c.HEALTHY), everyone).alias("healthy_pct"),
        share_pct(F.count_if(category == c.CRITICAL), everyone).alias("critical_pct"),
        tally(category.isin(c.AT_RISK, c.CRITICAL)).alias("customers_at_risk"),
        tally(action == c.RETAIN).alias("open_retain_actions"),
        tally(action == c.CROSS_SELL).alias("open_crosssell_actions"),
        tally(action == c.REACTIVATE).alias("open_reactivation_actions"),
        F.coalesce(F.sum("alerts"), F.lit(0)).alias("open_exceptions"),
        # NULL when there is no alert at all, 0 when there are alerts but none is urgent.
        F.when(F.sum("alerts") > 0, F.sum("urgent_alerts")).alias("open_p1_exceptions"),
        from_pennies(F.sum(to_pennies(F.col("revenue_90d")))).alias("revenue_current"),
        from_pennies(F.sum(to_pennies(F.col("revenue_prior_90d")))).alias("revenue_prior"),
    )


def executive_row(standing: DataFrame, concentration: DataFrame) -> DataFrame:
    """KPIs next to the concentration fact: two one-row frames side by side."""
    return (
        portfolio_totals(standing)
        .crossJoin(concentration)
        .withColumns(
            {
                "revenue_concentration_pct": F.col("top_10_pct"),
                "revenue_at_risk": F.col("scenario_top10_exit_risk"),
            }
        )
    )


def executive_summary(row: DataFrame, cfg: PortfolioConfig) -> DataFrame:
    """The headline row with rates, ratings and whole-pound revenue."""

    def pounds(name: str):
        return F.round(name, 0).cast("decimal(15,0)")

    now, before = F.col("revenue_current"), F.col("revenue_prior")
    actions = [
        F.col(name)
        for name in (
            "open_retain_actions",
            "open_crosssell_actions",
            "open_reactivation_actions",
        )
    ]
    return row.filter(F.col("total_customers") > 0).select(
        "snapshot_date",
        "total_customers",
        "active_customers",
        "dormant_customers",
        share_pct(F.col("dormant_customers"), F.col("total_customers"))
        .cast("decimal(5,1)")
        .alias("dormant_rate_pct"),
        F.col("healthy_pct").cast("decimal(5,2)").alias("healthy_pct"),
        F.col("critical_pct").cast("decimal(5,2)").alias("critical_pct"),
        on_scale(F.col("healthy_pct"), c.HEALTH_RATING).alias("portfolio_health_rating"),
        F.col("revenue_concentration_pct").cast("decimal(5,2)").alias("revenue_concentration_pct"),
        "revenue_dependency_score",
        pounds("total_portfolio_revenue").alias("portfolio_revenue_ltm"),
        pounds("revenue_at_risk").alias("revenue_at_risk"),
        pounds("revenue_current").alias("revenue_current_90d"),
        pounds("revenue_prior").alias("revenue_prior_90d"),
        share_pct(now - before, before).cast("decimal(18,1)").alias("revenue_qoq_pct"),
        F.abs(now - before).alias("revenue_change"),
        *actions,
        sum(actions[1:], actions[0]).alias("total_active_actions"),
        "open_exceptions",
        "open_p1_exceptions",
        "customers_at_risk",
    )
