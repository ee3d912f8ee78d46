"""E-commerce detail facts: one row per event, with a business date ``dt``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from layerhouse.functions.parsing import parse_json
from layerhouse.functions.times import OPEN_END, from_epoch_ms
from layerhouse.operators.joins import lookup, with_all
from layerhouse.operators.ordering import first_per

LOCAL_ZONE = "GMT+8"

# The event log: one JSON text per event.
LOG = (
    "common struct<ar:string,ba:string,ch:string,is_new:string,md:string,mid:string,os:string,"
    "uid:string,vc:string,sid:string>,"
    "page struct<item:string,item_type:string,last_page_id:string,page_id:string,"
    "from_pos_id:string,from_pos_seq:string,refer_id:string,during_time:bigint>,"
    "ts bigint"
)


def favor_add(favor: DataFrame) -> DataFrame:
    return favor.select(
        "id", "user_id", "sku_id", F.to_date("create_time").alias("dt"), "create_time"
    )


def coupon_used(use: DataFrame) -> DataFrame:
    return use.select("id", "coupon_id", "user_id", "order_id", F.to_date("used_time").alias("dt"))


def cart_add(cart: DataFrame) -> DataFrame:
    return cart.select(
        "id", "user_id", "sku_id", F.to_date("create_time").alias("dt"), "create_time", "sku_num"
    )


def cart_full(cart: DataFrame) -> DataFrame:
    """Lines still in the cart."""
    return cart.where(F.col("is_ordered") == "0").select(
        "id", "user_id", "sku_id", "sku_name", "sku_num"
    )


def order_line(detail: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with their buyer and province, and split amounts."""
    lines = detail.select(
        "id", "order_id", "sku_id", F.to_date("create_time").alias("dt"), "create_time", "sku_num",
        (F.col("sku_num") * F.col("order_price")).cast("decimal(18,2)").alias("split_original_amount"),
        F.coalesce("split_activity_amount", F.lit(0).cast("decimal(18,4)")).alias("split_activity_amount"),
        F.coalesce("split_coupon_amount", F.lit(0).cast("decimal(18,4)")).alias("split_coupon_amount"),
        "split_total_amount",
    )
    return lookup(lines, orders, {"order_id": "id"}, ["user_id", "province_id"])


def _promotions(lines: DataFrame, activity: DataFrame, coupon: DataFrame) -> DataFrame:
    lines = lookup(lines, activity, {"id": "order_detail_id"}, ["activity_id", "activity_rule_id"])
    return lookup(lines, coupon, {"id": "order_detail_id"}, ["coupon_id"])


def order_detail(
    detail: DataFrame, orders: DataFrame, activity: DataFrame, coupon: DataFrame
) -> DataFrame:
    return _promotions(order_line(detail, orders), activity, coupon)


def pay_line(detail: DataFrame, payment: DataFrame) -> DataFrame:
    """Paid order lines; ``dt`` is the day the payment came back."""
    paid = payment.select(
        "order_id", F.col("user_id").alias("payer"), "payment_type", "callback_time"
    )
    lines = detail.select(
        "id", "order_id", "sku_id", "sku_num",
        (F.col("sku_num") * F.col("order_price")).cast("decimal(18,2)").alias("split_original_amount"),
        F.coalesce("split_activity_amount", F.lit(0).cast("decimal(18,4)")).alias("split_activity_amount"),
        F.coalesce("split_coupon_amount", F.lit(0).cast("decimal(18,4)")).alias("split_coupon_amount"),
        F.col("split_total_amount").alias("split_payment_amount"),
    )
    return lines.join(paid, "order_id").withColumnRenamed("payer", "user_id").withColumn(
        "dt", F.to_date("callback_time")
    )


def pay_detail(
    detail: DataFrame, payment: DataFrame, orders: DataFrame,
    activity: DataFrame, coupon: DataFrame, dic: DataFrame,
) -> DataFrame:
    lines = lookup(pay_line(detail, payment), orders, {"order_id": "id"}, ["province_id"])
    lines = _promotions(lines, activity, coupon)
    payment_types = dic.where(F.col("parent_code") == "11")
    return lookup(lines, payment_types, {"payment_type": "dic_code"}, {"payment_type_name": "dic_name"})


def trade_flow(orders: DataFrame, payment: DataFrame, status_log: DataFrame) -> DataFrame:
    """Accumulating snapshot order -> payment -> finish; ``dt`` is the finish day or the open end."""
    flow = orders.select(
        F.col("id").alias("order_id"), "user_id", "province_id",
        F.to_date("create_time").alias("order_date"), F.col("create_time").alias("order_time"),
        F.col("original_total_amount").alias("order_original_amount"),
        F.col("activity_reduce_amount").alias("order_activity_amount"),
        F.col("coupon_reduce_amount").alias("order_coupon_amount"),
        F.col("total_amount").alias("order_total_amount"),
    )
    flow = lookup(
        flow, payment, {"order_id": "order_id"},
        {"payment_time": "callback_time", "payment_amount": "total_amount"},
    )
    done = status_log.where(F.col("order_status") == "1004")
    flow = lookup(flow, done, {"order_id": "order_id"}, {"finish_time": "operate_time"})
    return flow.withColumns({
        "payment_date": F.to_date("payment_time"),
        "finish_date": F.to_date("finish_time"),
        "payment_amount": F.coalesce("payment_amount", F.lit(0).cast("decimal(16,2)")),
        "dt": F.coalesce(F.to_date("finish_time"), F.lit(OPEN_END)),
    })


def parsed_log(log: DataFrame) -> DataFrame:
    return parse_json(log, "log", LOG)


def recent_log(log: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """Log lines stored in the span, a day more on either side for the zone: a bound before the parse."""
    first, last = as_of - dt.timedelta(days=days), as_of + dt.timedelta(days=2)
    return log.where((F.col("log_time") >= F.lit(first).cast("timestamp")) & (F.col("log_time") < F.lit(last).cast("timestamp")))


def _visitor(*names: str) -> list:
    # warehouse column -> key of the log's common part
    source = {
        "province_id": "ar", "brand": "ba", "channel": "ch", "is_new": "is_new", "model": "md",
        "mid_id": "mid", "operate_system": "os", "user_id": "uid", "version_code": "vc",
        "session_id": "sid",
    }
    return [F.col(f"common.{source[n]}").alias(n) for n in names or source]


def page_view(log: DataFrame) -> DataFrame:
    stamp = from_epoch_ms(F.col("ts"), LOCAL_ZONE)
    return parsed_log(log).where(F.col("page").isNotNull()).select(
        *_visitor(),
        F.col("page.item").alias("page_item"), F.col("page.item_type").alias("page_item_type"),
        "page.last_page_id", "page.page_id", "page.from_pos_id", "page.from_pos_seq",
        "page.refer_id", F.to_date(stamp).alias("dt"), stamp.alias("view_time"),
        "page.during_time",
    )


def user_login(log: DataFrame) -> DataFrame:
    """The first page of each session by a known user."""
    pages = parsed_log(log).where(
        F.col("page").isNotNull() & F.col("common.uid").isNotNull()
    ).select(
        *_visitor("session_id", "user_id", "channel", "province_id", "version_code", "mid_id",
                  "brand", "model", "operate_system"),
        "ts", F.col("page.item").cast("bigint").alias("item"),
    )
    stamp = from_epoch_ms(F.col("ts"), LOCAL_ZONE)
    return first_per(pages, ["session_id"], ["ts", "item"]).select(
        "user_id", F.to_date(stamp).alias("dt"), stamp.alias("login_time"), "channel",
        "province_id", "version_code", "mid_id", "brand", "model", "operate_system",
    )


def user_register(users: DataFrame, log: DataFrame) -> DataFrame:
    """Registered users with the device they registered from, where the log has the page."""
    pages = parsed_log(log).where(
        (F.col("page.page_id") == "register") & F.col("common.uid").isNotNull()
    ).select(
        *_visitor("channel", "province_id", "version_code", "mid_id", "brand", "model",
                  "operate_system"),
        F.col("common.uid").cast("bigint").alias("log_user"),
    )
    people = users.select(
        F.col("id").alias("user_id"), F.to_date("create_time").alias("dt"), "create_time"
    )
    return with_all(people, pages, {"user_id": "log_user"})
