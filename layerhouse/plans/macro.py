"""Product macro monitor: visits, favourites, carts, orders and payments per product and day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from layerhouse.functions.ratios import mean_of, safe_ratio
from layerhouse.operators.joins import lookup
from layerhouse.operators.ordering import first_per
from layerhouse.sources.files import clean

# Operation types and the paid status in the source data.
FAVOURITE = "收藏"
ADD_TO_CART = "加购"
PAID = "已支付"


def latest_product(product: DataFrame) -> DataFrame:
    """One row per product, so that joining it cannot multiply facts."""
    newest = product.withColumn("__age", -F.datediff(F.to_date("update_date"), F.lit(dt.date(1970, 1, 1))))
    return first_per(newest, ["product_id"], ["__age"]).drop("__age")


def visit_detail(visits: DataFrame, product: DataFrame) -> DataFrame:
    rows = visits.select(
        F.col("log_id").alias("visit_id"), "user_id", "product_id", "visit_time", "terminal",
        "stay_time", "is_click", F.to_date("visit_time").alias("dt"),
    )
    return lookup(rows, product, {"product_id": "product_id"}, ["category_id"], hot=True)


def add_detail(adds: DataFrame, product: DataFrame) -> DataFrame:
    rows = adds.select(
        "record_id", "user_id", "product_id", "op_type", "op_time", "add_cart_count", "terminal",
        F.to_date("op_time").alias("dt"),
    )
    return lookup(rows, product, {"product_id": "product_id"}, ["category_id"], hot=True)


def cleaned_orders(raw: DataFrame) -> DataFrame:
    return clean(
        raw,
        decimals={c: "decimal(10,2)" for c in ("product_price", "buy_amount", "pay_amount")},
        stamps={c: "yyyy-MM-dd HH:mm:ss" for c in ("pay_time", "create_time")},
        required=["order_id", "order_date"],
    )


def trade_detail(orders: DataFrame, product: DataFrame) -> DataFrame:
    rows = orders.where(F.col("order_id").isNotNull()).select(
        "order_id", "user_id", "product_id", "product_price", "buy_count", "buy_amount",
        "pay_status", "pay_time", "pay_amount", "terminal", F.to_date("create_time").alias("dt"),
    )
    return lookup(rows, product, {"product_id": "product_id"}, ["category_id"], hot=True)


VISITS = ["visitor_count", "view_count", "avg_stay_time", "bounce_rate"]
INTERACTION = ["favorite_user_count", "add_to_cart_quantity", "add_to_cart_user_count"]
TRADE = [
    "order_user_count", "order_quantity", "order_amount", "pay_user_count", "pay_quantity",
    "pay_amount",
]


def product_daily(visits: DataFrame, adds: DataFrame, trades: DataFrame) -> DataFrame:
    """Thirteen measures per product, category and day, plus the distinct buyers.

    Each fact is reduced on its own before they are aligned, so visits never count rows that came
    from another fact.
    """
    keys = ["product_id", "category_id", "dt"]
    favourite, cart = F.col("op_type") == FAVOURITE, F.col("op_type") == ADD_TO_CART
    paid = F.col("pay_status") == PAID
    seen = visits.groupBy(*keys).agg(
        F.countDistinct("user_id").alias("visitor_count"), F.count("visit_id").alias("view_count"),
        F.sum("stay_time").alias("stay"), F.count("stay_time").alias("stays"),
        F.count(F.when(F.col("is_click") == 0, 1)).alias("no_click"),
    )
    added = adds.groupBy(*keys).agg(
        F.count(F.when(favourite, 1)).alias("favorite_user_count"),
        F.sum(F.when(cart, F.col("add_cart_count"))).alias("add_to_cart_quantity"),
        F.count(F.when(cart, 1)).alias("add_to_cart_user_count"),
    )
    traded = trades.groupBy(*keys).agg(
        F.count("*").alias("order_user_count"), F.sum("buy_count").alias("order_quantity"),
        F.sum("buy_amount").alias("order_amount"), F.count(F.when(paid, 1)).alias("pay_user_count"),
        F.sum(F.when(paid, F.col("buy_count"))).alias("pay_quantity"),
        F.sum(F.when(paid, F.col("pay_amount"))).alias("pay_amount"),
        F.countDistinct("user_id").alias("buyer_count"),
    )
    stacked = seen.unionByName(added, True).unionByName(traded, True)
    summed = ["visitor_count", "view_count", "stay", "stays", "no_click", *INTERACTION, *TRADE, "buyer_count"]
    daily = stacked.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in summed])
    return daily.withColumns({
        "avg_stay_time": mean_of(F.col("stay"), F.col("stays")),
        "bounce_rate": safe_ratio(F.col("no_click"), F.col("visitor_count")),
    }).drop("stay", "stays", "no_click")


def _per(top: str, bottom: str) -> Column:
    return safe_ratio(F.col(top), F.col(bottom))


RATES = {
    "visit_to_collect_rate": ("favorite_user_count", "visitor_count"),
    "visit_to_add_to_cart_rate": ("add_to_cart_user_count", "visitor_count"),
    "order_conversion_rate": ("order_user_count", "visitor_count"),
    "payment_conversion_rate": ("pay_user_count", "visitor_count"),
    "avg_order_value": ("pay_amount", "pay_user_count"),
    "avg_visitor_value": ("pay_amount", "visitor_count"),
}


def _report(daily: DataFrame, product: DataFrame, as_of: dt.date, columns: list[str]) -> DataFrame:
    rows = daily.where(F.col("dt") == F.lit(as_of))
    rows = lookup(rows, product, {"product_id": "product_id"}, ["product_name", "category_name"])
    rates = {c: _per(*RATES[c]) for c in columns if c in RATES}
    if rates:
        rows = rows.withColumns(rates)
    return rows.select(
        F.col("dt").alias("statistical_time"), "product_id", "product_name", "category_id",
        "category_name", *columns,
    )


def macro_monitor(daily: DataFrame, product: DataFrame, as_of: dt.date) -> DataFrame:
    return _report(daily, product, as_of, [*VISITS, *INTERACTION, *TRADE, *RATES])


def visit_stats(daily: DataFrame, product: DataFrame, as_of: dt.date) -> DataFrame:
    return _report(daily, product, as_of, VISITS)


def interaction_stats(daily: DataFrame, product: DataFrame, as_of: dt.date) -> DataFrame:
    return _report(daily, product, as_of, [
        *INTERACTION, "visit_to_collect_rate", "visit_to_add_to_cart_rate"
    ])


def transaction_stats(daily: DataFrame, product: DataFrame, as_of: dt.date) -> DataFrame:
    return _report(daily, product, as_of, [
        *TRADE, "order_conversion_rate", "payment_conversion_rate", "avg_order_value", "avg_visitor_value"
    ])
