"""Predicates for the current, prior and long comparison periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clientbook.config import PortfolioConfig


def known_by(cfg: PortfolioConfig, day: Column) -> Column:
    """Nothing after the snapshot date may influence a snapshot."""
    return day <= F.lit(cfg.snapshot_date)


def in_ltm(cfg: PortfolioConfig, day: Column) -> Column:
    return day.between(F.lit(cfg.ltm_start), F.lit(cfg.snapshot_date))


def in_current(cfg: PortfolioConfig, day: Column) -> Column:
    return day.between(F.lit(cfg.current_start), F.lit(cfg.snapshot_date))


def in_prior(cfg: PortfolioConfig, day: Column) -> Column:
    return day.between(F.lit(cfg.prior_start), F.lit(cfg.prior_end))


def in_any(cfg: PortfolioConfig, day: Column) -> Column:
    """Covers all three periods with one range, so that it can reach the scan."""
    start = min(cfg.ltm_start, cfg.prior_start, cfg.current_start)
    return day.between(F.lit(start), F.lit(cfg.snapshot_date))
