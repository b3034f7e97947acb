"""Every business constant of the portfolio model, in one frozen object.

Nothing in ``operators/`` or ``plans/`` holds a threshold, weight, label list or
text of its own: re-configuring the model never means editing a plan.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass, field, replace
from decimal import Decimal
from typing import NamedTuple


class Step(NamedTuple):
    """``value <op> bound`` yields ``result``; steps are tried in order."""

    op: str
    bound: int | Decimal
    result: int | str


class Scale(NamedTuple):
    """An ordered list of steps and the result when none applies."""

    steps: tuple[Step, ...]
    otherwise: int | str


def _scale(op: str, pairs, otherwise) -> Scale:
    return Scale(tuple(Step(op, bound, result) for bound, result in pairs), otherwise)


# ---------------------------------------------------------------------------
# Labels, thresholds and weights that define the model's results.
# ---------------------------------------------------------------------------

VIP, GROWTH, REGULAR, AT_RISK, DORMANT = "VIP", "Growth", "Regular", "At-Risk", "Dormant"
SEGMENTS = (VIP, GROWTH, REGULAR, AT_RISK, DORMANT)

HEALTHY, WATCHLIST, CRITICAL = "Healthy", "Watchlist", "Critical"
HEALTH_CATEGORIES = (HEALTHY, WATCHLIST, AT_RISK, CRITICAL)

IMPROVING, STABLE, DETERIORATING = "Improving", "Stable", "Deteriorating"
HEALTH_TRENDS = (IMPROVING, STABLE, DETERIORATING)

GROWING, DECLINING, NEW, INACTIVE = "Growing", "Declining", "New", "Inactive"
ACTIVITY_TRENDS = (GROWING, STABLE, DECLINING, NEW, INACTIVE)

UPGRADED, DOWNGRADED = "Upgraded", "Downgraded"

RETAIN, REVIEW, CROSS_SELL, REACTIVATE, MONITOR = (
    "Retain",
    "Review",
    "Cross-Sell",
    "Reactivate",
    "Monitor",
)
ACTION_TYPES = (RETAIN, REVIEW, CROSS_SELL, REACTIVATE, MONITOR)

P1, P2, P3, P4 = "P1", "P2", "P3", "P4"
PRIORITIES = (P1, P2, P3, P4)
SEVERITIES = (P1, P2, P3)
SLA_DAYS = {P1: 1, P2: 3, P3: 7, P4: 30}

OPEN = "OPEN"
NO_CHANNEL = "None"
NEVER_TRANSACTED_DAYS = 999

FREQUENCY_SCORE = _scale(">=", ((50, 5), (25, 4), (10, 3), (3, 2)), 1)
MONETARY_SCORE = _scale(">=", ((20000, 5), (3000, 4), (800, 3), (150, 2)), 1)
RECENCY_SCORES = (5, 4, 3, 2)
RECENCY_SCORE_FLOOR = 1

ACTIVITY_HEALTH = _scale("<=", ((0, 0), (2, 20), (9, 45), (24, 70), (49, 85)), 100)
REVENUE_HEALTH = Scale(
    (Step("==", 0, 0), Step("<=", 100, 25), Step("<=", 400, 50), Step("<=", 2000, 75)), 100
)
RECENCY_HEALTH_SCORES = (100, 85, 60, 35)
RECENCY_HEALTH_FLOOR = 0
PRIOR_RECENCY_HEALTH = _scale(">", ((10, 90), (0, 60)), 10)

HEALTH_WEIGHTS = {
    "activity": Decimal("0.30"),
    "revenue": Decimal("0.35"),
    "recency": Decimal("0.25"),
    "engagement": Decimal("0.10"),
}
HEALTH_CATEGORY = _scale(">=", ((70, HEALTHY), (45, WATCHLIST), (25, AT_RISK)), CRITICAL)
HEALTH_TREND_POINTS = 5

DEPENDENCY_SCORE = _scale(
    ">=",
    ((Decimal("0.50"), "CRITICAL"), (Decimal("0.40"), "HIGH"), (Decimal("0.30"), "MEDIUM")),
    "LOW",
)
HEALTH_RATING = _scale(">=", ((50, "Strong"), (30, "Moderate")), "Weak")
CONCENTRATION_TIERS = (10, 20, 50)

# Rule label -> identifier prefix of the alerts it raises.
EXCEPTION_PREFIX = {
    "CRITICAL CUSTOMER": "EXC_CRIT_",
    "VIP DETERIORATING": "EXC_VIPDET_",
    "REVENUE DECLINE": "EXC_REVDEC_",
    "ACTIVITY CLIFF": "EXC_CLIFF_",
    "SEGMENT DOWNGRADE": "EXC_DOWN_",
}
EXCEPTION_TYPES = tuple(EXCEPTION_PREFIX)

# An alert the model can add: healthy customers on their way down. See PortfolioConfig.early_warning.
EARLY_WARNING = "HEALTHY DETERIORATING"
EARLY_WARNING_PREFIX = "EXC_HLTDET_"

NEWLY_DORMANT, RECENTLY_DORMANT, LONG_DORMANT, NEVER_ACTIVE = (
    "Newly dormant", "Recently dormant", "Long-term dormant", "Never active",
)
DORMANCY_TIERS = (NEWLY_DORMANT, RECENTLY_DORMANT, LONG_DORMANT, NEVER_ACTIVE)

# Segment pairs are compared by level: a higher level than before is an upgrade.
SEGMENT_LEVEL = {VIP: 2, GROWTH: 2, REGULAR: 1, AT_RISK: 0, DORMANT: 0}


class ActionTexts(NamedTuple):
    """What puts a customer in the workbook, for each kind of action: the rule with its bounds."""

    retain_vip: str = "Retention case: VIP with a health score under 45, or 5 points down."
    retain_growth: str = "Retention case: Growth client with a health score under 45, or 5 points down."
    retain_critical: str = "Retention case: health score under 25."
    retain: str = "Retention case: At-Risk segment and a score of 25 to 45, or 5 points down."
    cross_sell_vip: str = "Sales case: VIP scoring 45 or more, not 5 points down."
    cross_sell: str = "Sales case: Growth client not losing ground, or score of 70 and 5 points up."
    reactivate: str = "Win-back case: 0 transactions in the current period."
    review: str = "Check: score of 25 to 45 or 5 points down, or At-Risk segment."
    monitor: str = "No rule applies: next look in 30 days."


class ExceptionTexts(NamedTuple):
    """Alert wording; ``{...}`` marks the places filled from the customer's row."""

    critical: str = "Health score below 25 of 100."
    critical_todo: str = "Score the four health dimensions apart and start with the one at 0."
    vip_deteriorating: str = "{segment}: health score 5 or more points under the prior period's."
    vip_deteriorating_todo: str = "Set both periods' dimension scores side by side; act on the largest loss."
    revenue_decline: str = "Fee revenue {drop}% under the prior period (limit 20%): \u00a3{revenue} left."
    revenue_decline_todo: str = "Split the loss by product and channel and set a figure for the next period."
    activity_cliff: str = "{after} transactions after {before}: {drop}% fewer (limit 40%)."
    activity_cliff_todo: str = "List the channels used in the prior period and not since."
    segment_downgrade: str = "Segment {before} became {after}."
    segment_downgrade_todo: str = "The workbook line of segment and health applies, within its SLA days."
    healthy_deteriorating: str = "Health score {score}, still 70 or more, but 5 or more points down."
    healthy_deteriorating_todo: str = "Act before the score passes 70: compare counts and revenue of both periods."


def _shift_months(day: dt.date, months: int) -> dt.date:
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    month += 1
    return dt.date(year, month, min(day.day, calendar.monthrange(year, month)[1]))


@dataclass(frozen=True)
class PortfolioConfig:
    """Parameters of one snapshot run. The defaults are the model's standard set-up."""

    snapshot_date: dt.date = dt.date(2024, 1, 31)
    window_days: int = 90
    ltm_months: int = 12
    ltm_days: int | None = None
    """Length of the long window in days; ``None`` means ``ltm_months`` whole months."""

    products_total: int = 5
    digital_channels: tuple[str, ...] = ("Online", "Mobile")
    recency_days: tuple[int, int, int, int] = (14, 30, 60, 90)

    growing_ratio: Decimal = Decimal("1.10")
    declining_ratio: Decimal = Decimal("0.75")
    declining_min_prior: int = 3

    vip_revenue: int = 20000
    vip_txns: int = 10
    growth_revenue: int = 800
    at_risk_min_prior: int = 3
    prior_annualiser: int = 4
    prior_at_risk_txns: tuple[int, int] = (1, 2)

    revenue_decline_pct: int = -20
    revenue_decline_severe_pct: int = -40
    activity_cliff_pct: int = -40
    activity_cliff_min_prior: int = 5
    early_warning: bool = False
    """Whether healthy but deteriorating customers raise an alert of their own as well."""
    early_warning_revenue: int = 2000
    """Long-period revenue from which that alert is P2 for customers other than VIP and Growth."""

    newly_dormant_days: int = 30
    """Days beyond the current period within which a dormant customer counts as newly so."""

    action_texts: ActionTexts = field(default_factory=ActionTexts)
    exception_texts: ExceptionTexts = field(default_factory=ExceptionTexts)

    # -- period bounds, all inclusive ------------------------------------------------

    @property
    def ltm_start(self) -> dt.date:
        if self.ltm_days is not None:
            return self.snapshot_date - dt.timedelta(days=self.ltm_days - 1)
        return _shift_months(self.snapshot_date + dt.timedelta(days=1), -self.ltm_months)

    @property
    def current_start(self) -> dt.date:
        return self.snapshot_date - dt.timedelta(days=self.window_days - 1)

    @property
    def prior_start(self) -> dt.date:
        return self.snapshot_date - dt.timedelta(days=2 * self.window_days - 1)

    @property
    def prior_end(self) -> dt.date:
        return self.snapshot_date - dt.timedelta(days=self.window_days)

    # -- scales that depend on the recency days --------------------------------------

    @property
    def recency_score(self) -> Scale:
        return _scale("<=", zip(self.recency_days, RECENCY_SCORES), RECENCY_SCORE_FLOOR)

    @property
    def recency_health(self) -> Scale:
        return _scale("<=", zip(self.recency_days, RECENCY_HEALTH_SCORES), RECENCY_HEALTH_FLOOR)

    @property
    def dormancy_tier(self) -> Scale:
        """Tier by days since the last transaction: newly, up to the end of the prior period, longer."""
        newly, prior = self.window_days - 1 + self.newly_dormant_days, 2 * self.window_days - 1
        return _scale("<=", ((newly, NEWLY_DORMANT), (prior, RECENTLY_DORMANT)), LONG_DORMANT)

    def at(self, snapshot_date: dt.date) -> PortfolioConfig:
        return replace(self, snapshot_date=snapshot_date)


STAR_SCHEMA_CONFIG = PortfolioConfig(
    snapshot_date=dt.date(2001, 8, 1),
    window_days=360,
    ltm_days=1440,
    products_total=6,
    digital_channels=("1-URGENT", "2-HIGH"),
    recency_days=(56, 120, 240, 360),
)
"""Settings that suit the order/line-item tables, whose activity is about four times sparser."""

EVENT_CONFIG = PortfolioConfig(
    snapshot_date=dt.date(2024, 1, 30),
    window_days=7,
    ltm_days=28,
    products_total=1,
    digital_channels=("click", "view"),
    recency_days=(1, 2, 4, 7),
)
"""Settings that suit the event table, which spans a month."""
