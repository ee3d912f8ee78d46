"""Logistics summaries.  Facts are reduced to their keys before any dimension is joined."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from layerhouse.operators.hierarchy import ancestor, closure
from layerhouse.operators.joins import lookup
from layerhouse.operators.spans import span_totals
from layerhouse.session import written

ROLLING = (7, 30)
CITY = ["city_id", "city_name"]
PROVINCE = ["province_id", "province_name"]
ORG = ["org_id", "org_name"]
TRUCK = ["truck_model_type", "truck_model_type_name"]
ORDERS = {"order_count": "order_count", "order_amount": "order_amount"}
TRIPS = ["trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec"]


def _once_per_order(detail: DataFrame, keys: list[str]) -> DataFrame:
    """Cargo lines repeat their order's amount: keep one amount per order, then count and add."""
    single = detail.groupBy("order_id", *keys).agg(F.max("amount").alias("amount"))
    return single.groupBy(*keys).agg(
        F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount")
    )


def organ_paths(organs: DataFrame, regions: DataFrame) -> DataFrame:
    """Organisations with their region and the regions above it, nearest first: stored as a dimension.

    The regions are closed and joined here, once, so that a fact needs a single look-up.
    """
    rows = organs.select("id", "org_name", "org_level", "region_id")
    return written(lookup(rows, closure(regions), {"region_id": "id"}, ["path"]))


def places(paths: DataFrame) -> DataFrame:
    """Organisations with the city and province they belong to.

    A level-1 organisation sits in its city, any other in a district below one.
    """
    first = F.col("org_level") == 1
    return paths.select("id", "org_name", "org_level", "region_id", *[
        F.when(first, ancestor(steps, part)).otherwise(ancestor(steps + 1, part)).alias(f"{place}_{part}")
        for steps, place in enumerate(("city", "province")) for part in ("id", "name")
    ])


def district_places(paths: DataFrame) -> DataFrame:
    """District -> its organisation, city and province, walking up from the district."""
    return paths.select("region_id", F.col("id").alias("org_id"), "org_name", *[
        ancestor(steps, part).alias(f"{place}_{part}")
        for steps, place in enumerate(("city", "province"), 1) for part in ("id", "name")
    ])


def org_cargo_order_1d(detail: DataFrame, organs: DataFrame, regions: DataFrame) -> DataFrame:
    cargo = ["cargo_type", "cargo_type_name"]
    by_district = _once_per_order(detail, [*cargo, "sender_district_id", "sender_city_id", "dt"])
    rows = lookup(
        by_district, organs, {"sender_district_id": "region_id"}, {"org_id": "id", "org_name": "org_name"}
    )
    rows = rows.groupBy(*ORG, F.col("sender_city_id").alias("city_id"), *cargo, "dt").agg(
        *[F.sum(m).alias(m) for m in ORDERS]
    )
    return lookup(rows, regions, {"city_id": "id"}, {"city_name": "name"})


def org_cargo_order_nd(daily: DataFrame, as_of: dt.date, spans=ROLLING) -> DataFrame:
    return span_totals(daily, [*ORG, *CITY, "cargo_type", "cargo_type_name"], ORDERS, as_of, spans)


def org_receive_1d(detail: DataFrame, paths: DataFrame) -> DataFrame:
    by_district = _once_per_order(detail, ["sender_district_id", "dt"])
    rows = lookup(
        by_district, district_places(paths), {"sender_district_id": "region_id"},
        [*ORG, *CITY, *PROVINCE],
    )
    return rows.groupBy(*ORG, *CITY, *PROVINCE, "dt").agg(*[F.sum(m).alias(m) for m in ORDERS])


def org_receive_nd(daily: DataFrame, as_of: dt.date, spans=ROLLING) -> DataFrame:
    return span_totals(daily, [*ORG, *CITY, *PROVINCE], ORDERS, as_of, spans)


def dispatch_1d(detail: DataFrame) -> DataFrame:
    return _once_per_order(detail, ["dt"])


def dispatch_nd(daily: DataFrame, as_of: dt.date, spans=ROLLING) -> DataFrame:
    return span_totals(daily, [], ORDERS, as_of, spans)


def dispatch_td(daily: DataFrame, as_of: dt.date) -> DataFrame:
    return daily.where(F.col("dt") <= F.lit(as_of)).agg(*[F.sum(m).alias(m) for m in ORDERS])


def bound_finish_td(detail: DataFrame, as_of: dt.date) -> DataFrame:
    return _once_per_order(detail.where(F.col("dt") <= F.lit(as_of)), [])


def org_deliver_1d(detail: DataFrame, paths: DataFrame) -> DataFrame:
    orders = detail.select("order_id", "receiver_district_id", "dt").dropDuplicates()
    counted = orders.groupBy("receiver_district_id", "dt").agg(F.count("order_id").alias("order_count"))
    rows = lookup(
        counted, district_places(paths), {"receiver_district_id": "region_id"},
        [*ORG, *CITY, *PROVINCE],
    )
    return rows.groupBy(*ORG, *CITY, *PROVINCE, "dt").agg(F.sum("order_count").alias("order_count"))


def org_deliver_nd(daily: DataFrame, as_of: dt.date, spans=ROLLING) -> DataFrame:
    return span_totals(daily, [*ORG, *CITY, *PROVINCE], {"order_count": "order_count"}, as_of, spans)


def org_sort_1d(sorts: DataFrame, paths: DataFrame) -> DataFrame:
    counted = sorts.groupBy("org_id", "dt").agg(F.count("*").alias("sort_count"))
    return lookup(
        counted, places(paths), {"org_id": "id"}, ["org_name", *CITY, *PROVINCE]
    )


def org_sort_nd(daily: DataFrame, as_of: dt.date, spans=ROLLING) -> DataFrame:
    return span_totals(daily, [*ORG, *CITY, *PROVINCE], {"sort_count": "sort_count"}, as_of, spans)


def org_truck_trips_1d(trips: DataFrame, trucks: DataFrame) -> DataFrame:
    by_truck = trips.groupBy(
        F.col("start_org_id").alias("org_id"), F.col("start_org_name").alias("org_name"), "truck_id", "dt"
    ).agg(
        F.count("id").alias("trans_finish_count"), F.sum("actual_distance").alias("trans_finish_distance"),
        F.sum("finish_dur_sec").alias("trans_finish_dur_sec"),
    )
    rows = lookup(by_truck, trucks, {"truck_id": "id"}, TRUCK)
    return rows.groupBy(*ORG, *TRUCK, "dt").agg(*[F.sum(m).alias(m) for m in TRIPS])


def place_trips_nd(trips: DataFrame, paths: DataFrame, as_of: dt.date, spans=ROLLING) -> DataFrame:
    """Trips per organisation, its city and span: what place reports need of ``shift_trips_nd``, with one look-up."""
    measured = trips.select(
        F.col("start_org_id").alias("org_id"), F.col("start_org_name").alias("org_name"), "dt", F.lit(1).alias("one"),
        "actual_distance", "finish_dur_sec",
    )
    rows = span_totals(measured, ORG, dict(zip(TRIPS, ["one", "actual_distance", "finish_dur_sec"], strict=True)), as_of, spans)
    return lookup(rows, places(paths), {"org_id": "id"}, CITY)


SHIFT_MEASURES = [*TRIPS, "trans_finish_order_count", "trans_finish_delay_count"]


def shift_trips_nd(
    trips: DataFrame, paths: DataFrame, shifts: DataFrame, trucks: DataFrame,
    as_of: dt.date, spans=ROLLING,
) -> DataFrame:
    """Trips per shift, line, crew, truck and span, with orders carried and late arrivals."""
    crew = ["driver1_emp_id", "driver1_name", "driver2_emp_id", "driver2_name"]
    measured = trips.select(
        "shift_id", "line_id", F.col("start_org_id").alias("org_id"),
        F.col("start_org_name").alias("org_name"), *crew, "truck_id", "dt",
        F.lit(1).alias("one"), "actual_distance", "finish_dur_sec", "order_num",
        F.when(F.col("actual_end_time") > F.col("estimate_end_time"), 1).otherwise(0).alias("late"),
    )
    rows = span_totals(
        measured, ["shift_id", "line_id", *ORG, *crew, "truck_id"],
        {"trans_finish_count": "one", "trans_finish_distance": "actual_distance",
         "trans_finish_dur_sec": "finish_dur_sec", "trans_finish_order_count": "order_num",
         "trans_finish_delay_count": "late"},
        as_of, spans,
    )
    rows = lookup(rows, places(paths), {"org_id": "id"}, CITY)
    rows = lookup(rows, shifts, {"shift_id": "id"}, ["line_name"])
    return lookup(rows, trucks, {"truck_id": "id"}, TRUCK)
