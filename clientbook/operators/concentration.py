"""Revenue concentration: who earns the portfolio's income, and what if they leave."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientbook import config as c
from clientbook.config import PortfolioConfig
from clientbook.functions.money import from_pennies, ratio, share_pct, to_pennies
from clientbook.functions.rules import on_scale
from clientbook.operators.ranking import at_the_top, rank_and_accumulate, top_ranked
from clientbook.operators.staging import staged


def earners(book: DataFrame) -> DataFrame:
    """Only customers with a transaction in the long window take part."""
    return book.filter(F.col("ltm_txns") > 0)


def top_tiers(earning: DataFrame) -> DataFrame:
    """One row: revenue of the top 10, 20 and 50 customers."""
    top = top_ranked(
        earning.select("customer_id", "revenue_ltm"),
        "revenue_ltm",
        "customer_id",
        max(c.CONCENTRATION_TIERS),
    )
    pennies = to_pennies(F.col("revenue_ltm"))
    return top.agg(
        *[
            from_pennies(F.sum(F.when(F.col("revenue_rank") <= n, pennies).otherwise(0))).alias(
                f"top_{n}_revenue"
            )
            for n in c.CONCENTRATION_TIERS
        ]
    )


def revenue_totals(earning: DataFrame) -> DataFrame:
    """One row: total revenue and the part of it owned by listed customers in critical health."""
    critical = F.col("is_listed") & (F.col("health_category") == c.CRITICAL)
    pennies = to_pennies(F.col("revenue_ltm"))
    return earning.agg(
        from_pennies(F.sum(pennies)).alias("total_portfolio_revenue"),
        from_pennies(F.coalesce(F.sum(F.when(critical, pennies)), F.lit(0))).alias(
            "critical_revenue"
        ),
    )


def summarise(standing: DataFrame, cfg: PortfolioConfig) -> DataFrame:
    """The one-row concentration fact from a staged frame of customer standings."""
    earning = earners(standing)
    both = revenue_totals(earning).crossJoin(top_tiers(earning))
    total = F.col("total_portfolio_revenue")
    shares = {
        f"top_{n}_pct": share_pct(F.col(f"top_{n}_revenue"), total)
        for n in c.CONCENTRATION_TIERS
    }
    return both.withColumns(
        {
            "snapshot_date": F.lit(cfg.snapshot_date),
            **shares,
            "revenue_dependency_score": on_scale(
                ratio(F.col("top_10_revenue"), total), c.DEPENDENCY_SCORE
            ),
            "scenario_top10_exit_risk": F.col("top_10_revenue"),
            "scenario_critical_exit_risk": F.col("critical_revenue"),
        }
    )


def rungs(book: DataFrame) -> DataFrame:
    """Earners with whole-pound revenue: rounding comes before ranking and summing."""
    return earners(book).withColumn(
        "revenue_ltm", F.round("revenue_ltm", 0).cast("decimal(15,0)")
    )


def _with_shares(ranked: DataFrame) -> DataFrame:
    total = F.col("grand_total")
    return ranked.withColumns(
        {
            "pct_of_portfolio": share_pct(F.col("revenue_ltm"), total, 2),
            "cumulative_pct": share_pct(F.col("cumulative"), total, 1),
        }
    )


def top_of_ladder(book: DataFrame, n: int, is_stored: bool = False) -> DataFrame:
    """The first ``n`` listed customers of :func:`ladder`, ranking only what is not below them."""
    source = rungs(book)
    source = source if is_stored else staged(source)
    top = at_the_top(source, "revenue_ltm", "customer_id", n, F.coalesce("is_listed", F.lit(False)))
    ranked = rank_and_accumulate(top, "revenue_ltm", "customer_id", is_stored=True).drop("grand_total")
    total = source.agg(F.sum("revenue_ltm").alias("grand_total"))
    return _with_shares(ranked.crossJoin(F.broadcast(total)))


def ladder(book: DataFrame, slices: int | None = None, is_stored: bool = False) -> DataFrame:
    """Every earner by revenue with its own and the cumulative share."""
    return _with_shares(
        rank_and_accumulate(rungs(book), "revenue_ltm", "customer_id", slices, is_stored)
    )
