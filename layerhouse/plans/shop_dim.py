"""E-commerce dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layerhouse.functions.masking import mask_email, mask_name, mask_phone
from layerhouse.functions.times import OPEN_END
from layerhouse.operators.joins import label_code, lookup

# Wording of the benefit texts.
AMOUNT_OFF = ("满", "元减", "元")
NTH_ITEM = ("满", "件打", " 折")
DISCOUNT = ("打", "折")
CASH = ("减", "元")


def _dictionary(dic: DataFrame, parent: str) -> DataFrame:
    return dic.where(F.col("parent_code") == parent)


def _between(words: tuple[str, ...], *values: str) -> Column:
    parts = []
    for i, word in enumerate(words):
        parts.append(F.lit(word))
        if i < len(values):
            parts.append(F.col(values[i]))
    return F.concat(*parts)


def _amount_off() -> Column:
    return _between(AMOUNT_OFF, "condition_amount", "benefit_amount")


def _nth_item() -> Column:
    return _between(NTH_ITEM, "condition_num", "benefit_discount")


def activity_full(rule: DataFrame, info: DataFrame, dic: DataFrame) -> DataFrame:
    """One row per activity rule, with its activity and a readable benefit."""
    rows = lookup(
        rule, info, {"activity_id": "id"},
        ["activity_name", "activity_desc", "start_time", "end_time", "create_time"],
    )
    rows = lookup(
        rows, _dictionary(dic, "31"), {"activity_type": "dic_code"}, {"activity_type_name": "dic_name"}
    )
    benefit = label_code(F.col("activity_type"), {
        "3101": _amount_off(), "3102": _nth_item(),
        "3103": F.concat(F.lit(DISCOUNT[0]), F.col("benefit_discount"), F.lit(DISCOUNT[1])),
    })
    return rows.withColumnRenamed("id", "activity_rule_id").withColumn("benefit_rule", benefit)


def coupon_full(coupon: DataFrame, dic: DataFrame) -> DataFrame:
    """One row per coupon with names of its type and range and a readable benefit."""
    rows = lookup(
        coupon, _dictionary(dic, "32"), {"coupon_type": "dic_code"}, {"coupon_type_name": "dic_name"}
    )
    rows = lookup(
        rows, _dictionary(dic, "33"), {"range_type": "dic_code"}, {"range_type_name": "dic_name"}
    )
    benefit = label_code(F.col("coupon_type"), {
        "3201": _amount_off(), "3202": _nth_item(),
        "3203": F.concat(F.lit(CASH[0]), F.col("benefit_amount"), F.lit(CASH[1])),
    })
    return rows.withColumn("benefit_rule", benefit)


def calendar(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Date dimension for a closed range of days."""
    return date_parts(spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date_id")
    ))


def calendar_of(df: DataFrame, column: str) -> DataFrame:
    """Date dimension covering every day between the first and last date found in ``column``."""
    bounds = df.agg(F.to_date(F.min(column)).alias("lo"), F.to_date(F.max(column)).alias("hi"))
    return date_parts(bounds.select(F.explode(F.sequence("lo", "hi")).alias("date_id")))


def date_parts(days: DataFrame) -> DataFrame:
    d = F.col("date_id")
    return days.select(
        d, F.weekofyear(d).alias("week_id"), (F.weekday(d) + 1).alias("week_day"),
        F.dayofmonth(d).alias("day"), F.month(d).alias("month"), F.quarter(d).alias("quarter"),
        F.year(d).alias("year"), F.when(F.weekday(d) < 5, 1).otherwise(0).alias("is_workday"),
    )


def promotion_pos_full(pos: DataFrame) -> DataFrame:
    return pos.select(
        "id", "pos_location", "pos_type", "promotion_type", "create_time", "operate_time"
    )


def promotion_refer_full(refer: DataFrame) -> DataFrame:
    return refer.select("id", "refer_name", "create_time", "operate_time")


def province_full(province: DataFrame, region: DataFrame) -> DataFrame:
    rows = province.withColumnRenamed("name", "province_name")
    return lookup(rows, region, {"region_id": "id"}, ["region_name"])


def sku_categories(
    sku: DataFrame, c3: DataFrame, c2: DataFrame, c1: DataFrame, trademark: DataFrame
) -> DataFrame:
    """SKU with its category path and brand: the columns the trade summaries carry."""
    rows = lookup(sku, c3, {"category3_id": "id"}, {"category3_name": "name", "category2_id": "category2_id"})
    rows = lookup(rows, c2, {"category2_id": "id"}, {"category2_name": "name", "category1_id": "category1_id"})
    rows = lookup(rows, c1, {"category1_id": "id"}, {"category1_name": "name"})
    return lookup(rows, trademark, {"tm_id": "id"}, ["tm_name"])


def sku_full(
    sku: DataFrame, spu: DataFrame, c3: DataFrame, c2: DataFrame, c1: DataFrame,
    trademark: DataFrame, attrs: DataFrame, sale_attrs: DataFrame,
) -> DataFrame:
    """One row per SKU with names of everything it belongs to and its attribute sets."""
    def sets(values: DataFrame, names: list[str], into: str) -> DataFrame:
        # collect_set needs no shuffle of duplicates; sorting makes the array reproducible
        fields = F.struct(*[F.col(n).cast("string").alias(n) for n in names])
        return values.groupBy("sku_id").agg(F.sort_array(F.collect_set(fields)).alias(into))

    rows = lookup(sku, spu, {"spu_id": "id"}, ["spu_name"])
    rows = sku_categories(rows, c3, c2, c1, trademark)
    rows = lookup(
        rows, sets(attrs, ["attr_id", "value_id", "attr_name", "value_name"], "attrs"),
        {"id": "sku_id"}, ["attrs"],
    )
    rows = lookup(
        rows,
        sets(
            sale_attrs,
            ["sale_attr_id", "sale_attr_value_id", "sale_attr_name", "sale_attr_value_name"],
            "sale_attrs",
        ),
        {"id": "sku_id"}, ["sale_attrs"],
    )
    return rows.withColumn("is_sale", F.col("is_sale").cast("boolean"))


def user_zip(users: DataFrame, start: dt.date) -> DataFrame:
    """Masked users as open validity intervals."""
    return users.select(
        "id", mask_name(F.col("name")).alias("name"), mask_phone(F.col("phone_num")).alias("phone_num"),
        mask_email(F.col("email")).alias("email"), "user_level", "birthday", "gender",
        "create_time", "operate_time",
        F.lit(start).alias("start_date"), F.lit(OPEN_END).alias("end_date"),
    )


def close_out(current: DataFrame, snapshot: DataFrame, as_of: dt.date, key: str = "id") -> DataFrame:
    """Fold a new snapshot into a validity-interval dimension.

    Unchanged rows stay open; a changed row closes the day before ``as_of`` and reopens with the
    new values; new keys open; keys gone from the snapshot stay open.  A row that opened on ``as_of``
    itself is replaced by the corrected one: there was no day on which it held.  One aggregation by
    key: an open row and its new version meet in the same group, which holds at most two rows.
    """
    values = [c for c in current.columns if c not in (key, "start_date", "end_date")]
    closed = current.where(F.col("end_date") != F.lit(OPEN_END))
    opened = current.where(F.col("end_date") == F.lit(OPEN_END))
    both = (
        opened.select(key, F.struct(*values).alias("v"), "start_date", F.lit(0).alias("new"))
        .unionByName(snapshot.select(
            key, F.struct(*values).alias("v"), F.lit(as_of).alias("start_date"), F.lit(1).alias("new")
        ))
        .groupBy(key).agg(
            F.max(F.when(F.col("new") == 0, F.struct("start_date", "v"))).alias("old"),
            F.max(F.when(F.col("new") == 1, F.struct("start_date", "v"))).alias("now"),
        )
    )
    changed = F.col("old").isNotNull() & F.col("now").isNotNull() & (
        ~F.col("old.v").eqNullSafe(F.col("now.v"))
    )
    def version(source: str, end) -> Column:
        return F.struct(
            F.col(f"{source}.v").alias("v"), F.col(f"{source}.start_date").alias("start_date"),
            F.lit(end).alias("end_date"),
        )
    kept = F.when(changed & (F.col("old.start_date") >= F.lit(as_of)), F.array(
        version("now", OPEN_END)
    )).when(changed, F.array(
        version("old", as_of - dt.timedelta(days=1)), version("now", OPEN_END)
    )).when(F.col("old").isNull(), F.array(version("now", OPEN_END))).otherwise(
        F.array(version("old", OPEN_END))
    )
    rows = both.select(key, F.explode(kept).alias("r")).select(key, "r.v.*", "r.start_date", "r.end_date")
    return closed.unionByName(rows)
