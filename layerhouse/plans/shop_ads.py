"""E-commerce reports.  Every report takes its run date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from layerhouse.functions.ratios import mean_of, safe_ratio
from layerhouse.functions.times import within
from layerhouse.operators import cohorts
from layerhouse.operators.joins import lookup, side_by_side
from layerhouse.operators.members import rolled_members
from layerhouse.operators.ordering import in_sequence, topk_with_ties
from layerhouse.operators.spans import recent_by, rolled, unpivot_spans
from layerhouse.plans.shop_dws import BRAND, CATEGORY, PROVINCE

SPANS = (1, 7, 30)


def _on(df: DataFrame, as_of: dt.date) -> DataFrame:
    return df.where(F.col("dt") == F.lit(as_of))


def coupon_stats(used_1d: DataFrame, as_of: dt.date) -> DataFrame:
    return _on(used_1d, as_of).groupBy("coupon_id", "coupon_name").agg(
        F.sum("used_count_1d").alias("used_count"), F.count("*").alias("used_user_count")
    ).withColumn("dt", F.lit(as_of))


def new_order_user_stats(order_td: DataFrame, as_of: dt.date) -> DataFrame:
    counts = cohorts.new_in_spans(
        order_td, as_of, SPANS, "order_date_first", "new_order_user_count"
    )
    return counts.withColumn("dt", F.lit(as_of))


def order_by_province(daily: DataFrame, as_of: dt.date) -> DataFrame:
    """Orders per province and span; a province idle today has no 1-day row."""
    keys = ["province_id", *PROVINCE]
    stems = {"order_count": "order_count_1d", "order_total_amount": "order_total_amount_1d"}
    wide = rolled(daily, keys, stems, as_of, SPANS)
    rows = unpivot_spans(wide, keys, list(stems), SPANS)
    return rows.where((F.col("recent_days") > 1) | (F.col("order_count") > 0)).withColumn(
        "dt", F.lit(as_of)
    )


def order_streaks(user_days: DataFrame, as_of: dt.date, method: str) -> DataFrame:
    """Users ordering three days running within a week, by any of four equivalent or looser rules."""
    users = {
        "lead": lambda: cohorts.users_by_lead(user_days, as_of),
        "islands": lambda: cohorts.users_by_islands(user_days, as_of),
        "bitmap": lambda: cohorts.users_by_bitmap(user_days, as_of),
        "one_gap": lambda: cohorts.users_by_lead(user_days, as_of, max_gap=3),
    }[method]()
    return cohorts.streak_report(users, as_of)


def order_streaks_all(user_days: DataFrame, as_of: dt.date) -> DataFrame:
    reports = [
        order_streaks(user_days, as_of, m).withColumn("method", F.lit(m))
        for m in ("lead", "islands", "bitmap", "one_gap")
    ]
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


def _orders_and_buyers(sku_daily: DataFrame, keys: list[str], as_of: dt.date) -> DataFrame:
    # one row per key and buyer first: the distinct count becomes a plain count, with no
    # expansion per span
    per_user = rolled(sku_daily, [*keys, "user_id"], {"n": "order_count_1d"}, as_of, SPANS)
    wide = per_user.groupBy(*keys).agg(*[
        out for span in SPANS for out in (
            F.sum(f"n_{span}d").alias(f"order_count_{span}d"),
            F.count(F.when(F.col(f"n_{span}d") > 0, 1)).alias(f"order_user_count_{span}d"),
        )
    ])
    return _buyer_rows(wide, keys, as_of)


def _buyer_rows(wide: DataFrame, keys: list[str], as_of: dt.date) -> DataFrame:
    rows = unpivot_spans(wide, keys, ["order_count", "order_user_count"], SPANS)
    return rows.where((F.col("recent_days") > 1) | (F.col("order_count") > 0)).withColumn(
        "dt", F.lit(as_of)
    )


def order_stats_by_category(sku_daily: DataFrame, as_of: dt.date) -> DataFrame:
    return _orders_and_buyers(sku_daily, CATEGORY, as_of)


def order_stats_by_brand(sku_daily: DataFrame, as_of: dt.date) -> DataFrame:
    return _orders_and_buyers(sku_daily, BRAND, as_of)


def order_stats_from_state(buyers: DataFrame, keys: list[str], as_of: dt.date) -> DataFrame:
    """The category or brand report from the stored daily states alone (``shop_dws.buyers_1d``)."""
    wide = rolled_members(buyers, keys, ["order_count"], as_of, SPANS)
    named = {f"members_{span}d": f"order_user_count_{span}d" for span in SPANS}
    return _buyer_rows(wide.withColumnsRenamed(named), keys, as_of)


def order_to_pay_interval(flow: DataFrame, as_of: dt.date) -> DataFrame:
    """Mean seconds from order to payment over the paid orders of the flow."""
    gap = F.unix_timestamp("payment_time") - F.unix_timestamp("order_time")
    paid = flow.where(F.col("payment_time").isNotNull())
    return paid.agg(
        mean_of(F.sum(gap), F.count(gap)).cast("bigint").alias("order_to_pay_interval_avg")
    ).withColumn("dt", F.lit(as_of))


def visits_on(views: DataFrame, as_of: dt.date) -> DataFrame:
    """Page views of a day with what orders them in their session."""
    return _on(views, as_of).select(
        "session_id", "view_time", F.col("page_item").cast("bigint").alias("item"), "page_id"
    )


def page_path(views: DataFrame, as_of: dt.date) -> DataFrame:
    """Steps of every session: how often page A at step n leads to page B at step n+1."""
    steps = in_sequence(visits_on(views, as_of), ["session_id"], ["view_time", "item"], "page_id")
    source = F.concat(F.lit("step-"), F.col("rn"), F.lit(":"), F.col("page_id"))
    target = F.concat(F.lit("step-"), F.col("rn") + 1, F.lit(":"), F.col("next"))
    return steps.select(
        source.alias("source"), F.coalesce(target, F.lit("null")).alias("target")
    ).groupBy("source", "target").agg(F.count("*").alias("path_count")).withColumn("dt", F.lit(as_of))


def repeat_purchase_by_brand(sku_daily: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Share of a brand's buyers who ordered at least twice in the span."""
    per_user = rolled(sku_daily, [*BRAND, "user_id"], {"n": "order_count_1d"}, as_of, (days,))
    n = F.col(f"n_{days}d")
    again, once = F.count(F.when(n >= 2, 1)), F.count(F.when(n >= 1, 1))
    return per_user.groupBy(*BRAND).agg(
        safe_ratio(again, once, 2).cast("decimal(16,2)").alias("order_repeat_rate")
    ).select(F.lit(as_of).alias("dt"), F.lit(days).alias("recent_days"), *BRAND, "order_repeat_rate")


def cart_top3_by_category(cart: DataFrame, sku: DataFrame, as_of: dt.date, k: int = 3) -> DataFrame:
    totals = cart.groupBy("sku_id").agg(F.sum("sku_num").alias("cart_num"))
    rows = lookup(totals, sku, {"sku_id": "id"}, ["sku_name", *CATEGORY])
    keys = ["category1_id", "category2_id", "category3_id"]
    return topk_with_ties(rows, keys, "cart_num", k).withColumn("dt", F.lit(as_of))


def favor_top3_by_brand(favor_1d: DataFrame, as_of: dt.date, k: int = 3) -> DataFrame:
    rows = _on(favor_1d, as_of).select(*BRAND, "sku_id", "sku_name", "favor_add_count_1d")
    return topk_with_ties(rows, ["tm_id"], "favor_add_count_1d", k).withColumn("dt", F.lit(as_of))


def traffic_by_channel(sessions: DataFrame, as_of: dt.date) -> DataFrame:
    """Visitors, mean time and pages, sessions and bounce rate per channel and span."""
    daily = sessions.withColumns({
        "one": F.lit(1), "bounced": F.when(F.col("page_count_1d") == 1, 1).otherwise(0)
    })
    stems = {"time": "during_time_1d", "pages": "page_count_1d", "sv": "one", "bounced": "bounced"}
    per_device = rolled(daily, ["channel", "mid_id"], stems, as_of, SPANS)
    wide = per_device.groupBy("channel").agg(*[
        out for span in SPANS for out in (
            F.count(F.when(F.col(f"sv_{span}d") > 0, 1)).alias(f"uv_count_{span}d"),
            *[F.sum(f"{stem}_{span}d").alias(f"{stem}_{span}d") for stem in stems],
        )
    ])
    rows = unpivot_spans(wide, ["channel"], ["uv_count", *stems], SPANS).where(F.col("sv") > 0)
    return rows.select(
        F.lit(as_of).alias("dt"), "recent_days", "channel", "uv_count",
        (mean_of(F.col("time"), F.col("sv")) / 1000).cast("bigint").alias("avg_duration_sec"),
        mean_of(F.col("pages"), F.col("sv")).cast("bigint").alias("avg_page_count"),
        F.col("sv").alias("sv_count"),
        safe_ratio(F.col("bounced"), F.col("sv"), 2).cast("decimal(16,2)").alias("bounce_rate"),
    )


def user_action(
    pages_1d: DataFrame, cart_1d: DataFrame, order_1d: DataFrame, payment_1d: DataFrame, as_of: dt.date
) -> DataFrame:
    """Funnel home -> detail -> cart -> order -> pay on the run date."""
    def visitors(page: str):
        return F.count(F.when(F.col("page_id") == page, 1))

    pages = _on(pages_1d, as_of).where(F.col("page_id").isin("home", "good_detail")).agg(
        visitors("home").alias("home_count"), visitors("good_detail").alias("good_detail_count")
    )
    counted = {"cart_count": cart_1d, "order_count": order_1d, "payment_count": payment_1d}
    steps = [_on(df, as_of).agg(F.count("*").alias(name)) for name, df in counted.items()]
    return side_by_side(pages, *steps).withColumn("dt", F.lit(as_of))


def user_change(users: DataFrame, logins: DataFrame, as_of: dt.date) -> DataFrame:
    """Churned: last login exactly 7 days ago.  Returned: back today after 8 days or more.

    One aggregation of the logins gives a user's last day up to ``as_of`` and up to the day before;
    registering counts as a login.
    """
    before = as_of - dt.timedelta(days=1)
    seen = logins.where(F.col("dt") <= F.lit(as_of)).groupBy(F.col("user_id").cast("bigint").alias("seen_id")).agg(
        F.max("dt").alias("last"), F.max(F.when(F.col("dt") <= F.lit(before), F.col("dt"))).alias("previous"))
    known = users.select("id", F.to_date("create_time").alias("first")).where(F.col("first") <= F.lit(as_of))
    rows = lookup(known, seen, {"id": "seen_id"}, ["last", "previous"])
    last, previous = F.coalesce("last", "first"), F.coalesce("previous", "first")
    back = (last == F.lit(as_of)) & (F.col("first") <= F.lit(before)) & (F.datediff(F.lit(as_of), previous) >= 8)
    return rows.agg(
        F.count(F.when(last == F.lit(as_of - dt.timedelta(days=7)), 1)).alias("user_churn_count"),
        F.count(F.when(back, 1)).alias("user_back_count"),
    ).withColumn("dt", F.lit(as_of))


def user_retention(login_td: DataFrame, as_of: dt.date) -> DataFrame:
    return cohorts.retention(login_td, as_of).withColumn("dt", F.lit(as_of))


def user_stats(login_td: DataFrame, as_of: dt.date) -> DataFrame:
    """New and active users per span, in one pass."""
    seen = login_td.where(within(F.col("login_date_last"), as_of, max(SPANS)))
    last, first = F.col("login_date_last"), F.col("login_date_first")
    wide = seen.agg(*[
        out for span in SPANS for out in (
            F.sum(recent_by(first, as_of, span) * recent_by(last, as_of, span)).alias(f"new_user_count_{span}d"),
            F.sum(recent_by(last, as_of, span)).alias(f"active_user_count_{span}d"),
        )
    ])
    rows = unpivot_spans(wide, [], ["new_user_count", "active_user_count"], SPANS)
    return rows.where(F.col("active_user_count") > 0).withColumn("dt", F.lit(as_of))
