"""Logistics reports for spans 1 (the run day), 7 and 30.

The inputs are span tables: rolling summaries built for ``SPANS``, or a stored 7/30-day table with
the run day added by ``with_today``.  Each report returns the new rows of its run date;
``sources.tables.merge_history`` adds them to the history so that a re-run replaces them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from layerhouse.functions.ratios import mean_of
from layerhouse.operators.joins import align_facts, net
from layerhouse.plans.tms_dws import CITY, ORDERS, ORG, PROVINCE, TRIPS, TRUCK

SPANS = (1, 7, 30)
TRIP_SUMS = {m: m for m in TRIPS}


def with_today(daily: DataFrame, rolling: DataFrame, as_of: dt.date) -> DataFrame:
    """A span table from a stored daily and a stored rolling table."""
    today = daily.where(F.col("dt") == F.lit(as_of)).withColumn("recent_days", F.lit(1))
    common = [c for c in rolling.columns if c in today.columns and c != "dt"]
    return today.select(*common).unionByName(rolling.select(*common))


def _sums(spans: DataFrame, keys: list[str], measures: dict[str, str]) -> DataFrame:
    return spans.groupBy("recent_days", *keys).agg(
        *[F.sum(source).alias(name) for name, source in measures.items()]
    )


def _stamped(rows: DataFrame, as_of: dt.date) -> DataFrame:
    return rows.withColumn("dt", F.lit(as_of))


def _with_means(rows: DataFrame) -> DataFrame:
    count = F.col("trans_finish_count")
    return rows.withColumns({
        "avg_trans_finish_distance": mean_of(F.col("trans_finish_distance"), count),
        "avg_trans_finish_dur_sec": mean_of(F.col("trans_finish_dur_sec"), count),
    })


def _received(spans: DataFrame, keys: list[str]) -> DataFrame:
    return _sums(spans, keys, {
        "receive_order_count": "order_count", "receive_order_amount": "order_amount"
    })


def _delivered(spans: DataFrame, keys: list[str]) -> DataFrame:
    return _sums(spans, keys, {"deliver_suc_count": "order_count"})


def _sorted(spans: DataFrame, keys: list[str]) -> DataFrame:
    return _sums(spans, keys, {"sort_count": "sort_count"})


def trans_order_stats(receive: DataFrame, dispatch: DataFrame, as_of: dt.date) -> DataFrame:
    sent = _sums(dispatch, [], {
        "dispatch_order_count": "order_count", "dispatch_order_amount": "order_amount"
    })
    return _stamped(align_facts(["recent_days"], _received(receive, []), sent), as_of)


def trans_stats(trips: DataFrame, as_of: dt.date) -> DataFrame:
    return _stamped(_sums(trips, [], TRIP_SUMS), as_of)


def trans_order_stats_td(dispatch_td: DataFrame, finish_td: DataFrame, as_of: dt.date) -> DataFrame:
    """Orders on the road: dispatched to date minus line-haul finished to date."""
    rest = net([], ["order_count", "order_amount"], dispatch_td, finish_td)
    return _stamped(rest.select(
        F.col("order_count").alias("bounding_order_count"),
        F.col("order_amount").alias("bounding_order_amount"),
    ), as_of)


def order_stats(orders: DataFrame, as_of: dt.date) -> DataFrame:
    return _stamped(_sums(orders, [], ORDERS), as_of)


def order_cargo_stats(orders: DataFrame, as_of: dt.date) -> DataFrame:
    return _stamped(_sums(orders, ["cargo_type", "cargo_type_name"], ORDERS), as_of)


def _orders_and_trips(orders: DataFrame, trips: DataFrame, keys: list[str], as_of: dt.date) -> DataFrame:
    both = align_facts(
        ["recent_days", *keys], _sums(orders, keys, ORDERS), _sums(trips, keys, TRIP_SUMS)
    )
    return _stamped(_with_means(both), as_of)


def city_stats(orders: DataFrame, trips: DataFrame, as_of: dt.date) -> DataFrame:
    """Orders and trips per city; a city with only one of them is kept."""
    return _orders_and_trips(orders, trips, CITY, as_of)


def org_stats(orders: DataFrame, trips: DataFrame, as_of: dt.date) -> DataFrame:
    return _orders_and_trips(orders, trips, ORG, as_of)


def shift_stats(trips: DataFrame, as_of: dt.date) -> DataFrame:
    return _stamped(trips.where(F.col("recent_days") > 1).select(
        "recent_days", "shift_id", *TRIPS, "trans_finish_order_count"
    ), as_of)


def line_stats(trips: DataFrame, as_of: dt.date) -> DataFrame:
    measures = {**TRIP_SUMS, "trans_finish_order_count": "trans_finish_order_count"}
    rolling = trips.where(F.col("recent_days") > 1)
    return _stamped(_sums(rolling, ["line_id", "line_name"], measures), as_of)


def driver_stats(trips: DataFrame, as_of: dt.date) -> DataFrame:
    """Trips per driver; distance and time of a two-driver trip are split in half."""
    crews = trips.where(F.col("recent_days") > 1).groupBy(
        "recent_days", "driver1_emp_id", "driver1_name", "driver2_emp_id", "driver2_name"
    ).agg(*[F.sum(m).alias(m) for m in TRIPS])
    share = F.when(F.col("driver2_emp_id").isNull(), 1.0).otherwise(0.5)

    def person(n: int):
        return F.struct(
            F.col(f"driver{n}_emp_id").alias("driver_emp_id"), F.col(f"driver{n}_name").alias("driver_name")
        )

    drivers = F.filter(F.array(person(1), person(2)), lambda p: p.driver_emp_id.isNotNull())
    rows = crews.select(
        "recent_days", "trans_finish_count",
        (F.col("trans_finish_distance") * share).alias("trans_finish_distance"),
        (F.col("trans_finish_dur_sec") * share).alias("trans_finish_dur_sec"),
        F.explode(drivers).alias("p"),
    ).select("*", "p.*")
    return _stamped(_with_means(_sums(rows, ["driver_emp_id", "driver_name"], TRIP_SUMS)), as_of)


def truck_stats(trips: DataFrame, as_of: dt.date) -> DataFrame:
    rolling = trips.where(F.col("recent_days") > 1)
    return _stamped(_with_means(_sums(rolling, TRUCK, TRIP_SUMS)), as_of)


def express_stats(deliver: DataFrame, sort: DataFrame, as_of: dt.date) -> DataFrame:
    return _stamped(align_facts(["recent_days"], _delivered(deliver, []), _sorted(sort, [])), as_of)


PLACES = {"province": PROVINCE, "city": CITY, "org": ORG}


def express_place_stats(
    place: str, receive: DataFrame, deliver: DataFrame, sort: DataFrame, as_of: dt.date
) -> DataFrame:
    """Received, delivered and sorted per province, city or organisation.

    A place found in any one of the three facts gives one row, whichever fact it is.
    """
    keys = PLACES[place]
    return _stamped(align_facts(
        ["recent_days", *keys], _received(receive, keys), _delivered(deliver, keys), _sorted(sort, keys)
    ), as_of)
