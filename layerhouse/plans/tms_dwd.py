"""Logistics detail facts: waybill milestones, truck trips and scans at organisations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from layerhouse.functions.masking import mask_name
from layerhouse.functions.times import OPEN_END, from_epoch_ms, from_iso
from layerhouse.operators.joins import key_filter, lookup
from layerhouse.session import written
from layerhouse.sources.tables import live

CARGO = ["cargo_type", "volume_length", "volume_width", "volume_height", "weight"]
PARTIES = [
    "receiver_complex_id", "receiver_province_id", "receiver_city_id", "receiver_district_id",
    "sender_complex_id", "sender_province_id", "sender_city_id", "sender_district_id",
]
CLOSED = ("60080", "60999")


@dataclass(frozen=True)
class Milestone:
    """Which waybills have reached a step.  ``reached`` lists status codes; with ``past`` they are
    the codes that have *not* reached it."""

    time: str
    reached: Sequence[str]
    past: bool = False

    def holds(self, status: Column) -> Column:
        listed = status.isin(*self.reached)
        return ~listed if self.past else listed


# Status codes of each milestone.
PAID = Milestone("payment_time", ["60020"])
CANCELLED = Milestone("cancel_time", ["60999"])
RECEIVED = Milestone("receive_time", ["60030"])
DISPATCHED = Milestone("dispatch_time", ["60050"])
BOUND_FINISHED = Milestone("bound_finish_time", ["60060"])
DELIVERED = Milestone(
    "deliver_suc_time",
    ["60010", "60020", "60030", "60040", "60050", "60060", "60999"], past=True,
)
SIGNED = Milestone(
    "sign_time",
    ["60010", "60020", "60030", "60040", "60050", "60060", "60070", "60999"], past=True,
)


def _info(orders: DataFrame) -> DataFrame:
    return live(orders).select(
        F.col("id").alias("info_id"), "order_no", "status", "collect_type", "user_id", *PARTIES,
        mask_name(F.col("receiver_name")).alias("receiver_name"),
        mask_name(F.col("sender_name")).alias("sender_name"),
        "payment_type", "cargo_num", "amount",
        from_epoch_ms(F.col("estimate_arrive_time")).alias("estimate_arrive_time"), "distance",
        from_iso(F.col("update_time")).alias("update_time"),
    )


def _named(rows: DataFrame, dic: DataFrame, *codes: str) -> DataFrame:
    """Role-playing look-ups of one dictionary; its keys are cast, the fact is left as it is."""
    for column in codes:
        rows = lookup(rows, dic, {column: "id"}, {f"{column}_name": "name"})
    return rows


def _waybill(cargo: DataFrame, orders: DataFrame) -> DataFrame:
    lines = live(cargo).select(
        "id", "order_id", *CARGO, from_iso(F.col("create_time")).alias("order_time")
    )
    return lines.join(_info(orders), F.col("order_id") == F.col("info_id")).drop("info_id")


def order_detail(cargo: DataFrame, orders: DataFrame, dic: DataFrame) -> DataFrame:
    """Placed waybills, one row per cargo line, by order day."""
    rows = _named(_waybill(cargo, orders), dic, "cargo_type", "status", "collect_type")
    return rows.drop("update_time", "payment_type").withColumn("dt", F.to_date("order_time"))


def milestone(
    cargo: DataFrame, orders: DataFrame, dic: DataFrame, step: Milestone
) -> DataFrame:
    """Cargo lines of the waybills that have reached a step, by the day they did."""
    reached = orders.where(step.holds(F.col("status")))
    rows = _named(
        _waybill(cargo, reached), dic, "cargo_type", "status", "collect_type", "payment_type"
    )
    return rows.withColumnRenamed("update_time", step.time).drop("order_time").withColumn(
        "dt", F.to_date(step.time)
    )


def milestone_from_open(
    open_rows: DataFrame | None, new_rows: DataFrame, orders: DataFrame, dic: DataFrame, step: Milestone
) -> DataFrame:
    """Daily load of a milestone: waybills still open, plus those placed today, that reached it.

    Both inputs carry the columns of ``order_detail``; status, payment and time come from the
    changed orders.  A waybill that is in both is taken from the open ones.  Rows of orders that did
    not reach the step are dropped where they are read; only the others are shuffled.
    """
    carried = [c for c in new_rows.columns if c not in (
        "status", "status_name", "dt", "payment_type", "payment_type_name", "start_date", "end_date"
    )]
    changed = live(orders).where(step.holds(F.col("status"))).select(
        F.col("id").alias("changed_id"), "status", "payment_type",
        from_iso(F.col("update_time")).alias(step.time),
    )
    pending = new_rows.select(*carried)
    if open_rows is not None:
        changed = written(changed)
        near = key_filter(changed, "changed_id")
        fresh = near(pending, "order_id")
        # waybills in both, by identifiers alone; as a stored frame, so that a small one is broadcast
        ids = written(fresh.select(F.col("id").alias("new_id")))
        known = key_filter(ids, "new_id")(open_rows.select(F.col("id").alias("open_id")), "open_id")
        twice = written(known.join(ids, F.col("open_id") == F.col("new_id"), "left_semi"))
        pending = near(open_rows.select(*carried), "order_id").unionByName(
            fresh.join(twice, F.col("id") == F.col("open_id"), "left_anti"))
    rows = pending.join(changed, F.col("order_id") == F.col("changed_id")).drop("changed_id")
    rows = _named(rows, dic, "status", "payment_type")
    return rows.drop("order_time").withColumn("dt", F.to_date(step.time))


def order_process(cargo: DataFrame, orders: DataFrame, dic: DataFrame) -> DataFrame:
    """Accumulating snapshot: ``dt`` is the day a waybill closed, or the open end."""
    rows = _named(
        _waybill(cargo, orders), dic, "cargo_type", "status", "collect_type", "payment_type"
    )
    end = F.when(F.col("status").isin(*CLOSED), F.to_date("update_time")).otherwise(F.lit(OPEN_END))
    return rows.withColumns({
        "start_date": F.to_date("order_time"), "end_date": end, "dt": end,
    }).drop("update_time")


def finished(tasks: DataFrame) -> DataFrame:
    """Finished trips with their duration."""
    start, end = F.col("actual_start_time").try_cast("bigint"), F.col("actual_end_time").try_cast("bigint")
    return live(tasks).where(F.col("actual_end_time").isNotNull()).select(
        "id", "shift_id", "line_id", "start_org_id", "start_org_name", "end_org_id", "end_org_name",
        "order_num", "driver1_emp_id", mask_name(F.col("driver1_name")).alias("driver1_name"),
        "driver2_emp_id", mask_name(F.col("driver2_name")).alias("driver2_name"),
        "truck_id", F.md5("truck_no").alias("truck_no"),
        F.timestamp_millis(start).alias("actual_start_time"),
        F.timestamp_millis(end).alias("actual_end_time"), "actual_distance",
        ((end - start) / 1000).cast("bigint").alias("finish_dur_sec"),
    ).withColumn("dt", F.to_date("actual_end_time"))


def trans_finish(tasks: DataFrame, shifts: DataFrame) -> DataFrame:
    """Finished trips with the estimated end: start plus the shift's minutes."""
    rows = lookup(finished(tasks), shifts, {"shift_id": "id"}, ["estimated_time"])
    late_by = F.make_dt_interval(mins=F.col("estimated_time"))
    return rows.withColumn("estimate_end_time", F.col("actual_start_time") + late_by).drop(
        "estimated_time"
    )


def bound(scans: DataFrame, step: str, employee: str) -> DataFrame:
    """Scans of one kind (inbound, sort or outbound) at an organisation."""
    stamp = from_epoch_ms(F.col(f"{step}_time"))
    return live(scans).where(F.col(f"{step}_time").isNotNull()).select(
        "id", "order_id", "org_id", stamp.alias(f"{step}_time"), employee, F.to_date(stamp).alias("dt")
    )
