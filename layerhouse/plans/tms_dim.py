"""Logistics dimensions: daily snapshots without soft-deleted rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layerhouse.functions.masking import hashed_email, hashed_phone
from layerhouse.functions.times import OPEN_END, from_iso
from layerhouse.operators.joins import lookup
from layerhouse.sources.tables import live


def complex_full(complexes: DataFrame, regions: DataFrame, couriers: DataFrame) -> DataFrame:
    """Residential complexes with province, city and the set of couriers serving them."""
    serving = live(couriers).groupBy("complex_id").agg(
        F.sort_array(F.collect_set(F.col("courier_emp_id").cast("string"))).alias("courier_emp_ids")
    )
    rows = live(complexes).select(
        "id", "complex_name", "province_id", "city_id", "district_id", "district_name"
    )
    rows = lookup(rows, regions, {"province_id": "id"}, {"province_name": "name"}, "inner")
    rows = lookup(rows, regions, {"city_id": "id"}, {"city_name": "name"}, "inner")
    return lookup(rows, serving, {"id": "complex_id"}, ["courier_emp_ids"])


def organ_full(organs: DataFrame, regions: DataFrame) -> DataFrame:
    """Organisations with their region and their parent's name."""
    rows = live(organs).select("id", "org_name", "org_level", "region_id", "org_parent_id")
    rows = lookup(rows, regions, {"region_id": "id"}, {"region_name": "name", "region_code": "dict_code"})
    return lookup(rows, live(organs), {"org_parent_id": "id"}, {"org_parent_name": "org_name"})


def region_full(regions: DataFrame) -> DataFrame:
    return regions.select("id", "parent_id", "name", "dict_code")


def express_courier_full(couriers: DataFrame, organs: DataFrame, dic: DataFrame) -> DataFrame:
    rows = live(couriers).select(
        "id", "emp_id", "org_id", F.md5("working_phone").alias("working_phone"), "express_type"
    )
    rows = lookup(rows, live(organs), {"org_id": "id"}, ["org_name"], "inner")
    return lookup(rows, dic, {"express_type": "id"}, {"express_type_name": "name"}, "inner")


LINE = [
    "line_no", "line_level", "org_id", "transport_line_type_id", "start_org_id",
    "start_org_name", "end_org_id", "end_org_name", "pair_line_id", "distance", "cost",
    "estimated_time",
]


def shift_full(shifts: DataFrame, lines: DataFrame, dic: DataFrame) -> DataFrame:
    rows = live(shifts).select(
        "id", "line_id", "start_time", "driver1_emp_id", "driver2_emp_id", "truck_id", "pair_shift_id"
    )
    rows = lookup(rows, live(lines), {"line_id": "id"}, {"line_name": "name", **{c: c for c in LINE}}, "inner")
    return lookup(
        rows, dic, {"transport_line_type_id": "id"}, {"transport_line_type_name": "name"}, "inner"
    )


def truck_driver_full(drivers: DataFrame, organs: DataFrame, teams: DataFrame) -> DataFrame:
    rows = lookup(live(drivers).drop("is_deleted"), live(organs), {"org_id": "id"}, ["org_name"], "inner")
    return lookup(rows, live(teams), {"team_id": "id"}, {"team_name": "name"}, "inner")


MODEL = [
    "truck_weight", "load_weight", "total_weight", "eev", "boxcar_len", "boxcar_wd",
    "boxcar_hg", "max_speed", "oil_vol",
]


def truck_full(
    trucks: DataFrame, teams: DataFrame, models: DataFrame, organs: DataFrame, dic: DataFrame
) -> DataFrame:
    rows = live(trucks).drop("is_deleted").withColumn("truck_no", F.md5("truck_no"))
    rows = lookup(
        rows, live(teams), {"team_id": "id"},
        {"team_name": "name", "team_no": "team_no", "org_id": "org_id", "manager_emp_id": "manager_emp_id"},
        "inner",
    )
    rows = lookup(
        rows, live(models), {"truck_model_id": "id"},
        {"truck_model_name": "model_name", "truck_model_type": "model_type",
         "truck_model_no": "model_no", "truck_brand": "brand", **{c: c for c in MODEL}},
        "inner",
    )
    rows = lookup(rows, live(organs), {"org_id": "id"}, ["org_name"], "inner")
    rows = lookup(rows, dic, {"truck_model_type": "id"}, {"truck_model_type_name": "name"}, "inner")
    return lookup(rows, dic, {"truck_brand": "id"}, {"truck_brand_name": "name"}, "inner")


def truck_models(trucks: DataFrame, models: DataFrame, dic: DataFrame) -> DataFrame:
    """Truck -> model type and its name: the part of the truck dimension the summaries use."""
    rows = live(trucks).select("id", "truck_model_id")
    rows = lookup(rows, live(models), {"truck_model_id": "id"}, {"truck_model_type": "model_type"}, "inner")
    return lookup(rows, dic, {"truck_model_type": "id"}, {"truck_model_type_name": "name"}, "inner")


def user_zip(users: DataFrame) -> DataFrame:
    """Users with hashed personal data, as open validity intervals."""
    return live(users).select(
        "id", "login_name", "nick_name", F.md5("passwd").alias("passwd"),
        F.md5("real_name").alias("realname"), hashed_phone(F.col("phone_num")).alias("phone_num"),
        hashed_email(F.col("email")).alias("email"), "user_level",
        F.date_from_unix_date(F.col("birthday").try_cast("int")).alias("birthday"), "gender",
        F.to_date("create_time").alias("start_date"), F.lit(OPEN_END).alias("end_date"),
    )


def user_address_zip(addresses: DataFrame) -> DataFrame:
    return live(addresses).select(
        "id", "user_id", hashed_phone(F.col("phone")).alias("phone"), "province_id", "city_id",
        "district_id", "complex_id", "address", "is_default",
        from_iso(F.col("create_time")).alias("start_date"), F.lit(OPEN_END).alias("end_date"),
    )
