"""Product ranking: cleaned sales and traffic, sales rank, price strength and warnings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layerhouse.functions.ratios import safe_ratio
from layerhouse.operators.joins import lookup
from layerhouse.operators.ordering import number_rows

# Fixed value: reason written on a warning.
LOW_STAR = "持续低星商品"


def sales_clean(sales: DataFrame) -> DataFrame:
    """Sales rows that pass four checks: positive amount, counts not negative, buyers <= units."""
    valid = (
        (F.col("pay_amount") > 0) & (F.col("sales_num") >= 0) & (F.col("pay_buyer_num") >= 0)
        & (F.col("pay_buyer_num") <= F.col("sales_num"))
    )
    return sales.where(valid).select(
        "goods_id", "sku_id", F.col("pay_amount").cast("decimal(10,2)").alias("total_sales"),
        F.col("sales_num").alias("total_sales_num"), "pay_buyer_num", F.to_date("pay_date").alias("pay_date"),
    )


def traffic_clean(traffic: DataFrame, sales: DataFrame) -> DataFrame:
    """Traffic with the buyers of the same product and day over its visitors."""
    buyers = sales.groupBy("goods_id", F.to_date("pay_date").alias("pay_date")).agg(
        F.sum("pay_buyer_num").alias("pay_buyer_num")
    )
    rows = traffic.where(F.col("visitor_num") >= 0).withColumn("visit_date", F.to_date("visit_date"))
    rows = lookup(
        rows, buyers, {"goods_id": "goods_id", "visit_date": "pay_date"}, ["pay_buyer_num"], hot=True
    )
    return rows.select(
        "goods_id", "traffic_source", "visitor_num",
        safe_ratio(F.col("pay_buyer_num"), F.col("visitor_num")).alias("pay_conver_rate"), "visit_date",
    )


def sales_sum(clean: DataFrame, base: DataFrame) -> DataFrame:
    daily = clean.groupBy("goods_id", F.col("pay_date").alias("stat_date")).agg(
        F.sum("total_sales").alias("total_sales"), F.sum("total_sales_num").alias("total_sales_num")
    )
    return lookup(daily, base, {"goods_id": "goods_id"}, ["category_name"])


def price_strength_sum(strength: DataFrame, base: DataFrame) -> DataFrame:
    """Strong (4 stars or more) and weak (2 or fewer) products per category and day."""
    rows = lookup(strength, base, {"goods_id": "goods_id"}, ["category_name"])
    star = F.col("price_strength_star")
    return rows.groupBy("category_name", F.to_date("record_date").alias("stat_date")).agg(
        F.count(F.when(star >= 4, 1)).alias("excellent_num"),
        F.count(F.when(star <= 2, 1)).alias("poor_num"),
    )


def all_goods_rank(daily: DataFrame, base: DataFrame) -> DataFrame:
    """Every product-day numbered by falling sales, without a single-task sort."""
    numbered = number_rows(
        daily, [F.col("total_sales").desc_nulls_last(), F.col("goods_id"), F.col("stat_date")], into="rank"
    )
    return lookup(numbered, base, {"goods_id": "goods_id"}, ["goods_name"])


def price_warnings(strength: DataFrame, base: DataFrame) -> DataFrame:
    low = strength.where(F.col("is_low_star") == 1)
    rows = lookup(low, base, {"goods_id": "goods_id"}, ["goods_name"])
    return rows.select(
        "goods_id", "goods_name", F.lit(LOW_STAR).alias("warn_reason"),
        F.to_date("record_date").alias("warn_date"),
    )
