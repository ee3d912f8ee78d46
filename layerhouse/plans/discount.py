"""Discount tool: sent and redeemed discounts per activity and per agent."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from layerhouse.functions.ratios import safe_ratio
from layerhouse.functions.times import OPEN_END, within
from layerhouse.operators.joins import lookup, sum_facts
from layerhouse.operators.spans import moving
from layerhouse.sources.files import clean

# Discount types and the names of the report windows.
FIXED_DISCOUNT = "固定优惠"
CUSTOM_DISCOUNT = "自定义优惠"
WINDOWS = {"day": 1, "7days": 7, "30days": 30}

#: Days of window ends that the reports show.
ENDS = 31


def sends_with_expiry(sends: DataFrame) -> DataFrame:
    """Expiry from the send time and the validity in hours."""
    return sends.withColumn(
        "expire_time", F.col("send_time") + F.make_dt_interval(hours=F.col("validity_period"))
    )


def valid_activity(activity: DataFrame) -> DataFrame:
    return activity.where((F.col("is_valid") == 1) & F.col("activity_id").isNotNull()).select(
        "activity_id", "activity_name", "activity_level", "discount_type", "max_discount_amount",
        "start_time", "end_time", "status", "create_time", "update_time",
    )


def product_discount(relation: DataFrame, activity: DataFrame) -> DataFrame:
    """Activity products with the amount or the limit their discount type uses."""
    rows = relation.where((F.col("is_delete") == 0) & F.col("rel_id").isNotNull())
    rows = lookup(rows, activity, {"activity_id": "activity_id"}, ["discount_type", "max_discount_amount"])
    return rows.select(
        "rel_id", "activity_id", "product_id", "sku_id", "discount_type",
        F.when(F.col("discount_type") == FIXED_DISCOUNT, F.col("fixed_discount")).alias("fixed_discount_amount"),
        F.when(F.col("discount_type") == CUSTOM_DISCOUNT, F.col("max_discount_amount")).alias("custom_discount_limit"),
        "max_buy_count", "add_time",
    )


def send_detail(sends: DataFrame, activity: DataFrame) -> DataFrame:
    rows = sends_with_expiry(sends.where(F.col("send_id").isNotNull()))
    return lookup(rows, activity, {"activity_id": "activity_id"}, ["discount_type"])


def cleaned_verify(raw: DataFrame) -> DataFrame:
    return clean(
        raw, decimals={"pay_amount": "decimal(10,2)"},
        stamps={"verify_time": "yyyy-MM-dd'T'HH:mm:ss"}, required=["verify_id", "send_id"],
    )


def verify_detail(verify: DataFrame, sends: DataFrame) -> DataFrame:
    """Redemptions with the customer, agent, product and activity of the send they answer."""
    return lookup(
        verify.where(F.col("verify_id").isNotNull()), sends.where(F.col("send_id").isNotNull()),
        {"send_id": "send_id"},
        ["send_discount_amount", "customer_id", "service_id", "product_id", "activity_id"],
    )


ACTIVITY = ["activity_name", "status", "discount_type"]


def activity_daily(activity: DataFrame, sends: DataFrame, verify: DataFrame) -> DataFrame:
    """Sends and redemptions per activity and day, with the distinct customers who redeemed.

    An activity with no send keeps one row without a day.  Facts are added up by activity and day
    before the activity's names are joined.
    """
    sent = sends.groupBy("activity_id", F.to_date("send_time").alias("dt")).agg(
        F.count("send_id").alias("send_count"), F.sum("send_discount_amount").alias("send_amount")
    )
    known = activity.select("activity_id").join(sent, "activity_id", "left").withColumn(
        "send_count", F.coalesce("send_count", F.lit(0))
    )
    redeemed = verify.groupBy("activity_id", F.to_date("verify_time").alias("dt")).agg(
        F.count("verify_id").alias("verify_count"), F.sum("pay_amount").alias("verify_amount"),
        F.sum("buy_count").alias("buy_count"), F.countDistinct("customer_id").alias("pay_customer_count"),
    )
    measures = {
        "send_count": "daily_send_count", "send_amount": "daily_send_amount",
        "verify_count": "daily_verify_count", "verify_amount": "daily_verify_amount",
        "buy_count": "daily_buy_count", "pay_customer_count": "daily_pay_customer_count",
    }
    daily = sum_facts(["activity_id", "dt"], list(measures), known, redeemed)
    daily = daily.withColumnsRenamed(measures)
    return lookup(daily, activity, {"activity_id": "activity_id"}, ACTIVITY)


def agent_daily(sends: DataFrame, verify: DataFrame) -> DataFrame:
    sent = sends.groupBy("service_id", F.to_date("send_time").alias("dt")).agg(
        F.count("send_id").alias("total_send_count"), F.sum("send_discount_amount").alias("total_send_amount")
    )
    redeemed = verify.groupBy("service_id", F.to_date("verify_time").alias("dt")).agg(
        F.count("verify_id").alias("total_verify_count"), F.sum("pay_amount").alias("total_verify_amount")
    )
    measures = ["total_send_count", "total_send_amount", "total_verify_count", "total_verify_amount"]
    daily = sum_facts(["service_id", "dt"], measures, sent, redeemed)
    return daily.withColumn(
        "conversion_rate", safe_ratio(F.col("total_verify_count"), F.col("total_send_count"), 4)
    )


def _windows(daily: DataFrame, key: str, measures: list[str], as_of: dt.date, frame: str, ends: int) -> DataFrame:
    """Day, 7-day and 30-day totals per key for the window ends of the last ``ends`` days.

    The windows are computed on all days they reach back to: of calendar days that is the longest
    window more, of days with data it is the whole history.
    """
    read = (within(F.col("dt"), as_of, ends + max(WINDOWS.values()) - 1) if frame == "range"
            else F.col("dt") <= F.lit(as_of))
    rows = moving(daily.where(read), [key], measures, WINDOWS, frame=frame)
    return rows.where(within(F.col("end_date"), as_of, ends))


def tool_overview(
    daily: DataFrame, verify: DataFrame, as_of: dt.date, frame: str = "range", ends: int = ENDS
) -> DataFrame:
    """Totals of all activities per window end, with the distinct paying customers of the window.

    ``rows`` frames count days with data, ``range`` frames count calendar days.
    """
    measures = ["daily_send_count", "daily_send_amount", "daily_verify_count", "daily_verify_amount"]
    totals = _windows(daily, "activity_id", measures, as_of, frame, ends).groupBy(
        "time_type", "start_date", "end_date"
    ).agg(
        F.sum("daily_send_count").alias("total_send_count"),
        F.sum("daily_send_amount").alias("total_send_amount"),
        F.sum("daily_verify_count").alias("total_pay_count"),
        F.sum("daily_verify_amount").alias("total_pay_amount"),
    )
    rows = lookup(
        totals, window_customers(verify, as_of, ends),
        {"time_type": "time_type", "end_date": "end_date"}, ["pay_customer_num"],
    ).withColumn("pay_customer_num", F.coalesce("pay_customer_num", F.lit(0)))
    return rows.withColumn(
        "avg_pay_per_customer", safe_ratio(F.col("total_pay_amount"), F.col("pay_customer_num"), 2)
    )


def window_customers(verify: DataFrame, as_of: dt.date, ends: int = ENDS) -> DataFrame:
    """Distinct paying customers of every day, 7-day and 30-day window that ends in the last ``ends`` days.

    Each (customer, day) counts for the window ends it reaches that no later day of the same
    customer already covers, so the count is a sum and no customer is repeated per window.
    """
    paid = verify.where(F.col("customer_id").isNotNull()).select(
        "customer_id", F.to_date("verify_time").alias("day")
    ).where(within(F.col("day"), as_of, ends + max(WINDOWS.values()) - 1)).distinct()
    following = F.lead("day").over(Window.partitionBy("customer_id").orderBy("day"))
    paid = paid.withColumn("next", F.coalesce(following, F.lit(OPEN_END)))
    reached = F.explode(F.array(*[
        F.struct(
            F.lit(name).alias("time_type"),
            F.least(F.date_add("day", days - 1), F.date_sub("next", 1), F.lit(as_of)).alias("last"),
        )
        for name, days in WINDOWS.items()
    ]))
    counted = paid.select("day", reached.alias("e")).groupBy("e.time_type", "day", "e.last").agg(
        F.count("*").alias("n")
    )
    return counted.select("time_type", "n", F.explode(F.sequence("day", "last")).alias("end_date")).groupBy(
        "time_type", "end_date"
    ).agg(F.sum("n").alias("pay_customer_num")).where(within(F.col("end_date"), as_of, ends))


def agent_windows(daily: DataFrame, as_of: dt.date, frame: str = "range", ends: int = ENDS) -> DataFrame:
    """Day, 7-day and 30-day totals and conversion per agent."""
    measures = ["total_send_count", "total_send_amount", "total_verify_count", "total_verify_amount"]
    rows = _windows(daily, "service_id", measures, as_of, frame, ends)
    return rows.select(
        "service_id", "time_type", "start_date", "end_date",
        F.col("total_send_count").alias("send_count"), F.col("total_send_amount").alias("send_amount"),
        F.col("total_verify_count").alias("pay_count"), F.col("total_verify_amount").alias("pay_amount"),
        safe_ratio(F.col("total_verify_count"), F.col("total_send_count"), 4).alias("conversion_rate"),
    )
