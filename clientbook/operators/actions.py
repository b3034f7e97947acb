"""One recommended action per customer, read from a decision table.

The customer's condition is first reduced to one of four states; segment and state then
give the action, and a few escalations lift its default priority by one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientbook import config as c
from clientbook.config import PortfolioConfig
from clientbook.functions.rules import evaluate_once, first_match, lookup

# state:           critical      fading        thriving        steady
DECISIONS = {
    c.DORMANT: (c.REACTIVATE, c.REACTIVATE, c.REACTIVATE, c.REACTIVATE),
    c.VIP: (c.RETAIN, c.RETAIN, c.CROSS_SELL, c.CROSS_SELL),
    c.GROWTH: (c.RETAIN, c.RETAIN, c.CROSS_SELL, c.CROSS_SELL),
    c.AT_RISK: (c.RETAIN, c.RETAIN, c.REVIEW, c.REVIEW),
    c.REGULAR: (c.RETAIN, c.REVIEW, c.CROSS_SELL, c.MONITOR),
}
DEFAULT_PRIORITY = {
    c.RETAIN: c.P2,
    c.REVIEW: c.P3,
    c.CROSS_SELL: c.P3,
    c.REACTIVATE: c.P3,
    c.MONITOR: c.P4,
}


def with_actions(profile: DataFrame, cfg: PortfolioConfig) -> DataFrame:
    """Add action type, instruction, priority, deadline, assignee and status."""
    segment, category, trend = F.col("segment"), F.col("health_category"), F.col("health_trend")
    vip, growth = segment == c.VIP, segment == c.GROWTH
    critical, deteriorating = category == c.CRITICAL, trend == c.DETERIORATING

    states = (
        critical,
        (category == c.AT_RISK) | deteriorating,
        (category == c.HEALTHY) & (trend == c.IMPROVING),
        F.lit(True),
    )
    action = first_match(
        (
            (segment == tier, first_match(zip(states[:-1], outcomes), F.lit(outcomes[-1])))
            for tier, outcomes in DECISIONS.items()
        ),
        F.lit(None),
    )

    act = F.col("action_type")
    retain, review, sell = act == c.RETAIN, act == c.REVIEW, act == c.CROSS_SELL
    priority = first_match(
        [
            (retain & (vip | (deteriorating & (critical | growth))), c.P1),
            ((sell & vip) | (review & (vip | growth)), c.P2),
        ],
        lookup(act, DEFAULT_PRIORITY),
    )

    texts = cfg.action_texts
    description = first_match(
        [
            (retain & vip, texts.retain_vip),
            (retain & growth, texts.retain_growth),
            (retain & critical, texts.retain_critical),
            (retain, texts.retain),
            (sell & vip, texts.cross_sell_vip),
            (sell, texts.cross_sell),
            (act == c.REACTIVATE, texts.reactivate),
            (review, texts.review),
        ],
        texts.monitor,
    )
    return (
        evaluate_once(profile, {"action_type": action})
        .withColumn("priority", priority)
        .withColumns(
            {
                "action_id": F.concat_ws(
                    "_", F.col("customer_id"), F.lit(cfg.snapshot_date.isoformat())
                ),
                "action_description": description,
                "sla_days": lookup(F.col("priority"), c.SLA_DAYS),
                "assigned_rm": F.col("relationship_manager"),
                "status": F.lit(c.OPEN),
            }
        )
    )
