"""Alert rules: independent triggers, any of which may fire for the same customer.

A union of five filters would read the profile five times. Here each customer row carries
the list of rules it fires; exploding that list yields the alerts in the same pass, and
the texts are built only for rows that fired.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientbook import config as c
from clientbook.config import PortfolioConfig
from clientbook.functions.rules import any_of, fill, first_match, lookup


class AlertRule(NamedTuple):
    name: str
    trigger: Column
    severity: Column
    description: Column
    recommended_action: str


def alert_rules(cfg: PortfolioConfig) -> list[AlertRule]:
    """The rules as columns over a profile row with segments and health."""
    segment, before = F.col("segment"), F.col("prior_segment")
    vip, growth = segment == c.VIP, segment == c.GROWTH
    key_client = vip | growth
    alive = F.col("health_category") != c.CRITICAL
    deteriorating = F.col("health_trend") == c.DETERIORATING
    revenue_change, txn_change = F.col("revenue_delta_pct"), F.col("txn_delta_pct")
    dormant = segment == c.DORMANT
    slipping = (segment == c.AT_RISK) & deteriorating
    texts = cfg.exception_texts

    def whole(value: Column) -> Column:
        return F.round(value, 0).cast("decimal(18,0)")

    rules = [
        AlertRule(
            "CRITICAL CUSTOMER",
            ~alive,
            first_match([(key_client, c.P1)], c.P2),
            fill(texts.critical),
            texts.critical_todo,
        ),
        AlertRule(
            "VIP DETERIORATING",
            key_client & deteriorating & alive,
            first_match([(vip, c.P1)], c.P2),
            fill(texts.vip_deteriorating, segment=segment),
            texts.vip_deteriorating_todo,
        ),
        AlertRule(
            "REVENUE DECLINE",
            (revenue_change <= cfg.revenue_decline_pct)
            & (F.col("revenue_prior_90d") > 0)
            & alive,
            first_match(
                [
                    (vip, c.P1),
                    (growth | (revenue_change <= cfg.revenue_decline_severe_pct), c.P2),
                ],
                c.P3,
            ),
            fill(
                texts.revenue_decline,
                drop=F.abs(whole(revenue_change)),
                revenue=whole(F.col("revenue_90d")),
            ),
            texts.revenue_decline_todo,
        ),
        AlertRule(
            "ACTIVITY CLIFF",
            (txn_change <= cfg.activity_cliff_pct)
            & (F.col("txn_count_prior_90d") >= cfg.activity_cliff_min_prior)
            & alive,
            first_match([(vip, c.P1), (growth, c.P2)], c.P3),
            fill(
                texts.activity_cliff,
                drop=F.abs(whole(txn_change)),
                before=F.col("txn_count_prior_90d"),
                after=F.col("txn_count_90d"),
            ),
            texts.activity_cliff_todo,
        ),
        AlertRule(
            "SEGMENT DOWNGRADE",
            (F.col("segment_change") == c.DOWNGRADED) & (dormant | slipping),
            first_match(
                [(dormant & before.isin(c.VIP, c.GROWTH), c.P1), (dormant | slipping, c.P2)], c.P3
            ),
            fill(texts.segment_downgrade, before=before, after=segment),
            texts.segment_downgrade_todo,
        ),
    ]
    if cfg.early_warning:
        worth_it = key_client | (F.col("revenue_ltm") >= cfg.early_warning_revenue)
        rules.append(
            AlertRule(
                c.EARLY_WARNING,
                (F.col("health_category") == c.HEALTHY) & deteriorating,
                first_match([(worth_it, c.P2)], c.P3),
                fill(texts.healthy_deteriorating, score=F.col("health_score").cast("decimal(5,1)")),
                texts.healthy_deteriorating_todo,
            )
        )
    return rules


_PREFIXES = c.EXCEPTION_PREFIX | {c.EARLY_WARNING: c.EARLY_WARNING_PREFIX}


def alert_count(cfg: PortfolioConfig, severity: str | None = None) -> Column:
    """Number of alerts a profile row raises, without materialising them."""
    return sum(
        (
            F.when(r.trigger if severity is None else r.trigger & (r.severity == severity), 1).otherwise(0)
            for r in alert_rules(cfg)
        ),
        F.lit(0),
    )


def raises(cfg: PortfolioConfig, name: str | None = None, severity: str | None = None) -> Column:
    """Whether a profile row raises an alert of this kind and severity."""
    return any_of(
        r.trigger if severity is None else r.trigger & (r.severity == severity)
        for r in alert_rules(cfg)
        if name is None or r.name == name
    )


def detect(profile: DataFrame, cfg: PortfolioConfig) -> DataFrame:
    """Profile rows with alert columns, one row per customer and fired rule."""
    rules = alert_rules(cfg)
    fired = F.explode(F.array(*[F.when(r.trigger, F.lit(r.name)) for r in rules]))
    name = F.col("exception_type")

    def by_rule(attribute: str) -> Column:
        return first_match(((name == r.name, getattr(r, attribute)) for r in rules), F.lit(None))

    return (
        profile.withColumn("exception_type", fired)
        .filter(name.isNotNull())
        .withColumns(
            {
                "exception_id": F.concat(
                    lookup(name, _PREFIXES), F.col("customer_id").cast("string")
                ),
                "detected_date": F.lit(cfg.snapshot_date),
                "description": by_rule("description"),
                "severity": by_rule("severity"),
                "recommended_action": by_rule("recommended_action"),
                "assigned_rm": F.col("relationship_manager"),
                "status": F.lit(c.OPEN),
            }
        )
    )


def detect_one(profile: DataFrame, cfg: PortfolioConfig, name: str) -> DataFrame:
    """Alerts of a single rule, as a plain filter."""
    rule = next(r for r in alert_rules(cfg) if r.name == name)
    return profile.filter(rule.trigger).withColumns(
        {
            "exception_type": F.lit(name),
            "exception_id": F.concat(
                F.lit(_PREFIXES[name]), F.col("customer_id").cast("string")
            ),
            "detected_date": F.lit(cfg.snapshot_date),
            "description": rule.description,
            "severity": rule.severity,
            "recommended_action": F.lit(rule.recommended_action),
            "assigned_rm": F.col("relationship_manager"),
            "status": F.lit(c.OPEN),
        }
    )
