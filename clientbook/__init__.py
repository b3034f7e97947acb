"""Customer-portfolio analytics as lazy Spark DataFrame plans.

Start at :class:`clientbook.plans.portfolio.Portfolio`: give it a customers
frame and a transactions frame (see :mod:`clientbook.schemas`) and every
profile, score, alert, KPI and view hangs off it.
"""

from clientbook.config import PortfolioConfig
from clientbook.plans.portfolio import Portfolio

__all__ = ["Portfolio", "PortfolioConfig"]
