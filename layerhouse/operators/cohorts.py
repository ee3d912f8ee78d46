"""Streaks, cohorts, churn and funnels over user-day and user-to-date tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from layerhouse.functions.ratios import safe_ratio
from layerhouse.functions.times import within


def user_days(daily: DataFrame, as_of: dt.date, days: int, user: str, date: str) -> DataFrame:
    """Distinct (user, day) pairs of the window: at most ``days`` rows per user."""
    return daily.where(within(F.col(date), as_of, days)).select(user, date).distinct()


def users_by_lead(
    daily: DataFrame, as_of: dt.date, days: int = 7, run: int = 3, max_gap: int | None = None,
    user: str = "user_id", date: str = "dt",
) -> DataFrame:
    """Users with ``run`` active days inside ``max_gap`` days of each other.

    Without ``max_gap`` the days must follow each other (gap = run - 1).
    """
    gap = run - 1 if max_gap is None else max_gap
    ordered = Window.partitionBy(user).orderBy(date)
    reach = F.datediff(F.lead(date, run - 1).over(ordered), F.col(date))
    marked = user_days(daily, as_of, days, user, date).withColumn("__reach", reach)
    return marked.where(F.col("__reach") <= gap).select(user).distinct()


def users_by_islands(
    daily: DataFrame, as_of: dt.date, days: int = 7, run: int = 3,
    user: str = "user_id", date: str = "dt",
) -> DataFrame:
    """The same users by gaps and islands: consecutive days share ``day - position``."""
    ordered = Window.partitionBy(user).orderBy(date)
    island = F.date_sub(F.col(date), F.row_number().over(ordered))
    return (
        user_days(daily, as_of, days, user, date)
        .withColumn("__island", island)
        .groupBy(user, "__island").agg(F.count("*").alias("__n"))
        .where(F.col("__n") >= run).select(user).distinct()
    )


def users_by_bitmap(
    daily: DataFrame, as_of: dt.date, days: int = 7, run: int = 3,
    user: str = "user_id", date: str = "dt",
) -> DataFrame:
    """The same users by a day bitmap per user, with no window: one digit per day of the span."""
    age = F.datediff(F.lit(as_of), F.col(date))
    digits = F.sum(F.pow(F.lit(10), age).cast("bigint"))
    return (
        user_days(daily, as_of, days, user, date)
        .groupBy(user).agg(digits.cast("string").alias("__days"))
        .where(F.col("__days").contains("1" * run)).select(user)
    )


def new_in_spans(
    first: DataFrame, as_of: dt.date, spans: Sequence[int], date: str, into: str
) -> DataFrame:
    """How many keys have their first date in each span; one pass, one row per non-empty span."""
    counts = first.where(within(F.col(date), as_of, max(spans))).agg(*[
        F.count(F.when(within(F.col(date), as_of, span), 1)).alias(f"s{span}") for span in spans
    ])
    rows = F.explode(F.array(*[
        F.struct(F.lit(span).alias("recent_days"), F.col(f"s{span}").alias(into)) for span in spans
    ]))
    return counts.select(rows.alias("r")).select("r.*").where(F.col(into) > 0)


def retention(
    logins: DataFrame, as_of: dt.date, days: int = 7,
    first: str = "login_date_first", last: str = "login_date_last",
) -> DataFrame:
    """Cohorts of the previous ``days`` days: how many were active on the run date."""
    low, high = as_of - dt.timedelta(days=days), as_of - dt.timedelta(days=1)
    kept = F.count(F.when(F.col(last) == F.lit(as_of), 1))
    return (
        logins.where(F.col(first).between(F.lit(low), F.lit(high)))
        .groupBy(F.col(first).alias("create_date"))
        .agg(kept.alias("retention_count"), F.count("*").alias("new_user_count"))
        .withColumn("retention_day", F.datediff(F.lit(as_of), F.col("create_date")))
        .withColumn(
            "retention_rate",
            safe_ratio(F.col("retention_count") * 100, F.col("new_user_count"), 2).cast("decimal(16,2)"),
        )
    )


def streak_report(users: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    return users.agg(F.count("*").alias("order_continuously_user_count")).select(
        F.lit(as_of).alias("dt"), F.lit(days).alias("recent_days"), "order_continuously_user_count"
    )
