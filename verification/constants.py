"""The model's constants, stated once more for the SQL counterpart.

Nothing here is taken from the library, so that a wrong constant there shows as a difference.
"""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace


def _steps(op: str, pairs, otherwise) -> SimpleNamespace:
    return SimpleNamespace(
        steps=[SimpleNamespace(op=op, bound=bound, result=result) for bound, result in pairs], otherwise=otherwise
    )


HEALTH_CATEGORIES = ("Healthy", "Watchlist", "At-Risk", "Critical")
PRIORITIES = ("P1", "P2", "P3", "P4")
EXCEPTION_PREFIX = {
    "CRITICAL CUSTOMER": "EXC_CRIT_",
    "VIP DETERIORATING": "EXC_VIPDET_",
    "REVENUE DECLINE": "EXC_REVDEC_",
    "ACTIVITY CLIFF": "EXC_CLIFF_",
    "SEGMENT DOWNGRADE": "EXC_DOWN_",
}
FREQUENCY_SCORE = _steps(">=", [(50, 5), (25, 4), (10, 3), (3, 2)], 1)
MONETARY_SCORE = _steps(">=", [(20000, 5), (3000, 4), (800, 3), (150, 2)], 1)
ACTIVITY_HEALTH = _steps("<=", [(0, 0), (2, 20), (9, 45), (24, 70), (49, 85)], 100)
# Revenue is never below 0, so "at most 0" is "equal to 0".
REVENUE_HEALTH = _steps("<=", [(0, 0), (100, 25), (400, 50), (2000, 75)], 100)
PRIOR_RECENCY_HEALTH = _steps(">", [(10, 90), (0, 60)], 10)
HEALTH_CATEGORY = _steps(">=", [(70, "Healthy"), (45, "Watchlist"), (25, "At-Risk")], "Critical")


def _settings(
    snapshot: dt.date, window: int, ltm: int, products: int, digital: tuple[str, ...], recency: tuple[int, ...]
) -> SimpleNamespace:
    def before(days: int) -> dt.date:
        return snapshot - dt.timedelta(days=days)

    return SimpleNamespace(
        snapshot_date=snapshot,
        window_days=window,
        ltm_days=ltm,
        current_start=before(window - 1),
        prior_end=before(window),
        prior_start=before(2 * window - 1),
        ltm_start=before(ltm - 1),
        products_total=products,
        digital_channels=digital,
        recency_score=_steps("<=", list(zip(recency, (5, 4, 3, 2))), 1),
        recency_health=_steps("<=", list(zip(recency, (100, 85, 60, 35))), 0),
        growing_ratio=1.10,
        declining_ratio=0.75,
        declining_min_prior=3,
        vip_revenue=20000,
        vip_txns=10,
        growth_revenue=800,
        at_risk_min_prior=3,
        prior_annualiser=4,
        revenue_decline_pct=-20,
        revenue_decline_severe_pct=-40,
        activity_cliff_pct=-40,
        activity_cliff_min_prior=5,
    )


STAR = _settings(dt.date(2001, 8, 1), 360, 1440, 6, ("1-URGENT", "2-HIGH"), (56, 120, 240, 360))
EVENTS = _settings(dt.date(2024, 1, 30), 7, 28, 1, ("click", "view"), (1, 2, 4, 7))

ACTION_TEXTS = SimpleNamespace(
    retain_vip="Retention case: VIP with a health score under 45, or 5 points down.",
    retain_growth="Retention case: Growth client with a health score under 45, or 5 points down.",
    retain_critical="Retention case: health score under 25.",
    retain="Retention case: At-Risk segment and a score of 25 to 45, or 5 points down.",
    cross_sell_vip="Sales case: VIP scoring 45 or more, not 5 points down.",
    cross_sell="Sales case: Growth client not losing ground, or score of 70 and 5 points up.",
    reactivate="Win-back case: 0 transactions in the current period.",
    review="Check: score of 25 to 45 or 5 points down, or At-Risk segment.",
    monitor="No rule applies: next look in 30 days.",
)
EXCEPTION_TEXTS = SimpleNamespace(
    critical="Health score below 25 of 100.",
    critical_todo="Score the four health dimensions apart and start with the one at 0.",
    vip_deteriorating="{segment}: health score 5 or more points under the prior period's.",
    vip_deteriorating_todo="Set both periods' dimension scores side by side; act on the largest loss.",
    revenue_decline="Fee revenue {drop}% under the prior period (limit 20%): £{revenue} left.",
    revenue_decline_todo="Split the loss by product and channel and set a figure for the next period.",
    activity_cliff="{after} transactions after {before}: {drop}% fewer (limit 40%).",
    activity_cliff_todo="List the channels used in the prior period and not since.",
    segment_downgrade="Segment {before} became {after}.",
    segment_downgrade_todo="The workbook line of segment and health applies, within its SLA days.",
)
