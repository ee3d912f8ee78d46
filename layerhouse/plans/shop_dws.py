"""E-commerce summaries: per day (1d), rolling (nd) and to date (td)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from layerhouse.operators.joins import lookup
from layerhouse.operators.members import daily_members
from layerhouse.operators.spans import rolled

PROVINCE = ["province_name", "area_code", "iso_code", "iso_3166_2"]
CATEGORY = [
    "category1_id", "category1_name", "category2_id", "category2_name",
    "category3_id", "category3_name",
]
BRAND = ["tm_id", "tm_name"]
AMOUNTS = {
    "order_original_amount": "split_original_amount",
    "activity_reduce_amount": "split_activity_amount",
    "coupon_reduce_amount": "split_coupon_amount",
    "order_total_amount": "split_total_amount",
}


def _amounts() -> list:
    return [F.sum(source).alias(f"{name}_1d") for name, source in AMOUNTS.items()]


def province_order_1d(lines: DataFrame, province: DataFrame) -> DataFrame:
    daily = lines.groupBy("province_id", "dt").agg(
        F.countDistinct("order_id").alias("order_count_1d"), *_amounts()
    )
    return lookup(daily, province, {"province_id": "id"}, PROVINCE)


def province_order_nd(daily: DataFrame, as_of: dt.date, spans=(7, 30)) -> DataFrame:
    stems = {name: f"{name}_1d" for name in ["order_count", *AMOUNTS]}
    return rolled(daily, ["province_id", *PROVINCE], stems, as_of, spans)


def sku_favor_1d(favor: DataFrame, sku: DataFrame) -> DataFrame:
    daily = favor.groupBy("sku_id", "dt").agg(F.count("*").alias("favor_add_count_1d"))
    return lookup(daily, sku, {"sku_id": "id"}, ["sku_name", *CATEGORY, *BRAND])


def user_coupon_used_1d(used: DataFrame, coupon: DataFrame) -> DataFrame:
    daily = used.groupBy("user_id", "coupon_id", "dt").agg(F.count("*").alias("used_count_1d"))
    return lookup(
        daily, coupon, {"coupon_id": "id"},
        {"coupon_name": "coupon_name", "coupon_type_code": "coupon_type",
         "coupon_type_name": "coupon_type_name", "benefit_rule": "benefit_rule"},
    )


def user_cart_1d(cart: DataFrame) -> DataFrame:
    return cart.groupBy("user_id", "dt").agg(
        F.count("*").alias("cart_add_count_1d"), F.sum("sku_num").alias("cart_add_num_1d")
    )


def user_order_1d(lines: DataFrame) -> DataFrame:
    return lines.groupBy("user_id", "dt").agg(
        F.countDistinct("order_id").alias("order_count_1d"),
        F.sum("sku_num").alias("order_num_1d"), *_amounts(),
    )


def user_order_td(daily: DataFrame, as_of: dt.date) -> DataFrame:
    return daily.where(F.col("dt") <= F.lit(as_of)).groupBy("user_id").agg(
        F.min("dt").alias("order_date_first"), F.max("dt").alias("order_date_last"),
        F.sum("order_count_1d").alias("order_count_td"), F.sum("order_num_1d").alias("order_num_td"),
        F.sum("order_original_amount_1d").alias("original_amount_td"),
        F.sum("activity_reduce_amount_1d").alias("activity_reduce_amount_td"),
        F.sum("coupon_reduce_amount_1d").alias("coupon_reduce_amount_td"),
        F.sum("order_total_amount_1d").alias("total_amount_td"),
    )


def user_payment_1d(paid: DataFrame) -> DataFrame:
    return paid.groupBy("user_id", "dt").agg(
        F.countDistinct("order_id").alias("payment_count_1d"),
        F.sum("sku_num").alias("payment_num_1d"),
        F.sum("split_payment_amount").alias("payment_amount_1d"),
    )


def user_sku_order_1d(lines: DataFrame, sku: DataFrame) -> DataFrame:
    daily = lines.groupBy("user_id", "sku_id", "dt").agg(
        F.count("*").alias("order_count_1d"), F.sum("sku_num").alias("order_num_1d"), *_amounts()
    )
    return lookup(daily, sku, {"sku_id": "id"}, ["sku_name", *CATEGORY, *BRAND])


def buyers_1d(sku_daily: DataFrame, keys: list[str]) -> DataFrame:
    """Daily state of the buyer reports: who bought, as bitmaps, and how many order lines."""
    return daily_members(sku_daily, keys, "user_id", {"order_count": "order_count_1d"})


def user_sku_order_nd(daily: DataFrame, as_of: dt.date, spans=(7, 30)) -> DataFrame:
    stems = {name: f"{name}_1d" for name in ["order_count", "order_num", *AMOUNTS]}
    keys = ["user_id", "sku_id", "sku_name", *CATEGORY, *BRAND]
    return rolled(daily, keys, stems, as_of, spans)


def visitor_page_1d(views: DataFrame) -> DataFrame:
    return views.groupBy("mid_id", "brand", "model", "operate_system", "page_id", "dt").agg(
        F.sum("during_time").alias("during_time_1d"), F.count("*").alias("view_count_1d")
    )


def session_page_1d(views: DataFrame) -> DataFrame:
    keys = ["session_id", "mid_id", "brand", "model", "operate_system", "version_code", "channel"]
    return views.groupBy(*keys, "dt").agg(
        F.sum("during_time").alias("during_time_1d"), F.count("*").alias("page_count_1d")
    )


def user_login_td(users: DataFrame, logins: DataFrame, as_of: dt.date) -> DataFrame:
    """Every user known by ``as_of``, with first and last login; registering counts as one login."""
    known = users.select(
        F.col("id").alias("user_id"), F.to_date("create_time").alias("login_date_first")
    ).where(F.col("login_date_first") <= F.lit(as_of))
    seen = logins.where(F.col("dt") <= F.lit(as_of)).groupBy("user_id").agg(
        F.max("dt").alias("last"), F.count("*").alias("count")
    ).withColumn("user_id", F.col("user_id").cast("bigint"))
    rows = lookup(known, seen, {"user_id": "user_id"}, ["last", "count"])
    return rows.select(
        "user_id", F.coalesce("last", "login_date_first").alias("login_date_last"),
        "login_date_first", F.coalesce("count", F.lit(1)).alias("login_count_td"),
    )
