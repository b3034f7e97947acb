"""Health history and trend lines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientbook.operators import history
from clientbook.plans.portfolio import Portfolio

TREND_MONTHS = 6


def health_history(book: Portfolio, dates: Sequence[dt.date] | None = None, months: int = 12) -> DataFrame:
    """Health and segment of each customer on each date (the last ``months`` months if none are given)."""
    dates = dates or history.month_ends(book.cfg.snapshot_date, months)
    rows = history.book_history(book.customers, book.transactions, book.cfg, sorted(set(dates)))
    return rows.select(
        "customer_id",
        "snapshot_date",
        "health_score",
        "health_category",
        "health_trend",
        "segment",
        "segment_change",
        "revenue_90d",
        "txn_count_90d",
        "days_since_last_txn",
    )


def trend_lines(scores: DataFrame) -> DataFrame:
    """One row per customer from (customer_id, snapshot_date, health_score).

    ``slope`` is the least-squares change of the score from one date to the next, dates being taken as
    evenly spaced. ``change_date`` is the first date of the later of two stretches whose means explain
    the scores best, the earliest one on a tie; it and the means of both stretches are null where all
    scores are equal. Scores are counted in whole tenths, so every sum is exact. A customer has as
    many scores as there are dates, so a list per customer stays short.
    """
    tenths = F.round(F.col("health_score") * 10, 0).cast("bigint")
    lists = (
        scores.filter("health_score IS NOT NULL")
        .groupBy("customer_id")
        .agg(F.array_sort(F.collect_list(F.struct("snapshot_date", tenths.alias("score")))).alias("points"))
    )
    points, n = F.col("points"), F.size("points").cast("bigint")
    zero = F.lit(0).cast("bigint")

    def total(items: Column, value) -> Column:
        return F.aggregate(items, zero, lambda s, x: s + value(x))

    numbered = F.transform(points, lambda p, i: F.struct(i.cast("bigint").alias("x"), p["score"].alias("y")))
    sx, sy = total(numbered, lambda p: p["x"]), total(numbered, lambda p: p["y"])
    sxy, sxx = total(numbered, lambda p: p["x"] * p["y"]), total(numbered, lambda p: p["x"] * p["x"])
    sums = lists.select(
        "customer_id", "points", n.alias("n"), sy.alias("sy"), (n * sxy - sx * sy).alias("up"), (n * sxx - sx * sx).alias("along")
    )

    def split(k: Column) -> Column:
        """What parting before position ``k`` explains: the squared gap of the sums over the sizes."""
        first = total(F.slice(points, 1, k), lambda p: p["score"])
        gap = F.col("n") * first - k * F.col("sy")
        explained = (gap * gap).cast("double") / (k * (F.col("n") - k)).cast("double")
        return F.struct(explained.alias("explained"), (-k).alias("order"), first.alias("first"))

    best = F.array_max(F.transform(F.sequence(F.lit(1), F.col("n").cast("int") - 1), split))
    found = sums.withColumn("best", F.when(F.col("n") > 1, best)).withColumn("k", -F.col("best.order"))
    moved = F.col("best.explained") > 0
    one = F.lit(10.0)
    return found.select(
        "customer_id",
        F.col("n").alias("dates"),
        F.element_at("points", -1)["snapshot_date"].alias("snapshot_date"),
        (F.element_at("points", -1)["score"] / one).alias("health_score"),
        F.when(F.col("along") > 0, F.round(F.col("up").cast("double") / F.col("along") / 10, 4)).alias("slope"),
        F.when(moved, F.get(F.col("points.snapshot_date"), F.col("k").cast("int"))).alias("change_date"),
        F.when(moved, F.round(F.col("best.first").cast("double") / F.col("k") / 10, 4)).alias("mean_before"),
        F.when(moved, F.round((F.col("sy") - F.col("best.first")).cast("double") / (F.col("n") - F.col("k")) / 10, 4)).alias("mean_after"),
    )


def health_trend(book: Portfolio, months: int = TREND_MONTHS) -> DataFrame:
    """Slope and change point of each customer's health over the last ``months`` months."""
    return trend_lines(health_history(book, months=months))
