"""Run the registered queries as table loads: stored tables in, a partition of a table out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from layerhouse.catalog import QUERIES, Layers, Query
from layerhouse.functions.times import OPEN_END, business_date
from layerhouse.plans import shop_ads
from layerhouse.plans.shop_dim import close_out
from layerhouse.session import scratch, written
from layerhouse.sources import tables
from layerhouse.sources.keyed import Keyed


class Stored(Layers):
    """Layers read from stored tables for one run date.

    ``bound`` maps an attribute (a raw table such as ``order_detail`` or a stored layer such as
    ``order_1d``) to a table name.  Raw tables are read for the run date's partition; names in
    ``history`` are read whole, for reports over several days; names in ``opened`` are read for the
    rows that are still open (waybills of the order process that have not closed).
    """

    def __init__(
        self, spark: SparkSession, bound: Mapping[str, str], day: str | dt.date,
        history: tuple[str, ...] = (), partition: str = "dt", opened: tuple[str, ...] = (),
    ):
        day = business_date(day)
        super().__init__(spark, "", order_day=day, event_day=day, last_day=day)
        tables.require_tables(spark, bound.values())
        for attribute, table in bound.items():
            df = (
                spark.table(table) if attribute in history
                else tables.read_partition(spark, table, OPEN_END if attribute in opened else day, partition)
            )
            # a value in the instance dictionary takes the place of the view of that name
            self.__dict__[attribute] = df
        for narrow, whole in (("order_amounts", "order_detail"), ("finished_trips", "trips")):
            if whole in bound:  # the stored table has all that the narrower view has
                self.__dict__.setdefault(narrow, self.__dict__[whole])


#: Keys of tables whose rows arrive after their day: a load merges them into the day's partition.
LATE = {
    "e14_dwd_pay_detail": ["id"],
    "l10_dwd_order_detail": ["id"], "l11_dwd_pay_suc": ["id"], "l12_dwd_order_cancel": ["id"],
    "l13_dwd_receive": ["id"], "l14_dwd_dispatch": ["id"], "l15_dwd_bound_finish": ["id"],
    "l16_dwd_deliver_suc": ["id"], "l17_dwd_sign": ["id"], "l19_dwd_trans_finish": ["id"],
    "l20_dwd_inbound": ["id"], "l21_dwd_sort": ["id"], "l22_dwd_outbound": ["id"],
}

#: Keys of accumulating tables: a row stays in the open partition until it moves to its end date's.
ACCUMULATING = {"e15_dwd_trade_flow": ["order_id"], "l18_dwd_order_process": ["id"]}

#: Keys of validity intervals, besides the day they start.
INTERVALS = {"e8_dim_user_zip": "id", "l8_dim_user_zip": "id", "l9_dim_user_address_zip": "id"}


def load(
    name: str, layers: Layers, table: str, fmt: str = "parquet", days: Iterable[dt.date | str] | None = None, stamp: str | None = None,
) -> int:
    """Write a query's result to ``table``; returns the rows written.

    Rows that arrive late or whose end is not known yet are found by key, wherever they are stored, and move
    to their day.  Other results replace the partitions they have rows for and empty those of ``days`` that
    they have none for; over stored tables that is the run day, unless told otherwise.  A result without
    ``dt`` replaces the table.  ``stamp`` names a column for the time of the load.  A repeated load changes nothing else.
    """
    if days is None:
        days = [layers.order_day] if isinstance(layers, Stored) else []
    return store(name, QUERIES[name].frame(layers), table, fmt, days, stamp)


def _created(df: DataFrame, table: str, fmt: str) -> None:
    """Create a table, or give it the columns the contract has gained; they are null in older rows."""
    spark = df.sparkSession
    tables.create_table(spark, table, df.schema, fmt=fmt)
    tables.evolve_table(spark, table, {f.name: f.dataType.simpleString() for f in df.schema if f.name != "dt"})


def store(
    name: str, df: DataFrame, table: str, fmt: str = "parquet", days: Iterable[dt.date | str] = (), stamp: str | None = None,
    durable: bool = False, spread: bool | None = None,
) -> int:
    """``load`` of rows that are already there; ``durable`` where they read stored files, ``spread`` as ``Keyed.merge`` has it."""
    spark = df.sparkSession
    if stamp:
        df = df.withColumn(stamp, F.current_timestamp())
    if "dt" not in df.columns:
        return tables.save_table(df, table, fmt=fmt)
    df = df.select(*[c for c in df.columns if c != "dt"], "dt")
    _created(df, table, fmt)
    if name in LATE or name in ACCUMULATING:
        return Keyed(spark, table, LATE.get(name) or ACCUMULATING[name]).merge(df, durable, spread)
    return tables.replace_days(df, table, days)


def load_intervals(name: str, snapshot: DataFrame, table: str, as_of: dt.date | str, fmt: str = "parquet") -> int:
    """Fold the day's snapshot of a dimension into its validity intervals; returns the rows written."""
    rows = snapshot.select(*[c for c in snapshot.columns if c not in ("start_date", "end_date", "dt")]).withColumns(
        {c: F.lit(OPEN_END) for c in ("start_date", "end_date", "dt")})
    _created(rows, table, fmt)
    return Keyed(snapshot.sparkSession, table, [INTERVALS[name], "start_date"]).fold(rows, business_date(as_of), close_out, INTERVALS[name])


def _scratch_table() -> str:
    return f"load_{uuid4().hex}"


def _external(spark: SparkSession, table: str, like: DataFrame) -> Keyed:
    """A table in the folder of intermediate results: its files stay until the application ends."""
    columns = [f for f in like.schema if f.name != "dt"]
    tables.create_table(spark, table, T.StructType([*columns, like.schema["dt"]]), location=scratch(spark, "table"))
    return Keyed(spark, table, [])


def _files_of(table: Keyed) -> DataFrame:
    """All rows of an external table, from its files: they are there when the table is dropped."""
    schema, path = table.read().schema, table.location()
    return table.spark.read.schema(schema).parquet(path)


def loads(name: str, layers: Layers, *versions: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Load a table once with each version of its rows and read it back whole."""
    spark, table, whole = layers.spark, _scratch_table(), written(QUERIES[name].frame(layers))
    kept = _external(spark, table, whole)
    try:
        for rows in versions:
            store(name, rows(whole), table, durable=True)
        return _files_of(kept)
    finally:
        kept.drop()


def from_open_rows(name: str, layers: Layers) -> DataFrame:
    """Two daily loads of a milestone over stored tables alone.

    On the first day half of the waybills are placed and none has come further, so the load writes nothing.  On
    the second day the others are placed and all have their statuses: the waybills of the first day are
    known from the open partition of the order process only.
    """
    spark, day = layers.spark, layers.order_day
    process, fact, changed, target = (_scratch_table() for _ in range(4))
    kept = _external(spark, target, QUERIES[name].frame(layers))
    early = F.pmod(F.xxhash64("order_id"), F.lit(2)) == 0
    try:
        placed = _still_open()(QUERIES["l18_dwd_order_process"].frame(layers).where(early))
        store("l18_dwd_order_process", placed.withColumn("status", F.lit("60010")), process, spread=False)  # all in the open partition
        store("l10_dwd_order_detail", QUERIES["l10_dwd_order_detail"].frame(layers).where(~early), fact, spread=True)
        orders, eve = layers.tms_order_info, day - dt.timedelta(days=1)
        tables.save_table(orders.withColumn("status", F.lit("60010")).withColumn("dt", F.lit(eve)).unionByName(
            orders.withColumn("dt", F.lit(day))), changed, partition="dt")
        bound = {"open_orders": process, "tms_order": fact, "tms_order_info": changed}
        for today in (eve, day):
            load(name, Stored(spark, bound, today, history=("tms_order",), opened=("open_orders",)), target)
        return _files_of(kept)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {changed}")
        for table in (process, fact, target):
            Keyed(spark, table, ["id"]).drop()


#: Days between the snapshots of ``three_snapshots``.
STEP = dt.timedelta(days=1)


def three_snapshots(name: str, layers: Layers, changing: str) -> DataFrame:
    """Three snapshots of a dimension folded into its intervals, the last twice, and all intervals read back.

    Every seventh row appears on the second day, every third one changes on that day and every sixth again on the
    third.
    """
    spark, table = layers.spark, _scratch_table()
    whole, first = written(QUERIES[name].frame(layers)), layers.event_day
    number = F.col(INTERVALS[name])

    def seen(turn: int) -> DataFrame:
        marks = F.when((number % 6 == 0) & F.lit(turn > 1), "++").when((number % 3 == 0) & F.lit(turn > 0), "+").otherwise("")
        rows = whole.withColumn(changing, F.concat(F.coalesce(changing, F.lit("")), marks))
        return rows if turn else rows.where(number % 7 != 0)

    try:
        for turn in (0, 1, 2, 2):
            load_intervals(name, seen(turn), table, first + turn * STEP)
        return written(spark.table(table))
    finally:
        Keyed(spark, table, []).drop()


def rerun(name: str, layers: Layers, more: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Load a report, first with rows that its second run no longer has, and read it back whole."""
    table, whole = _scratch_table(), written(QUERIES[name].frame(layers))
    try:
        for rows in (more(whole), whole, whole):
            store(name, rows, table)
        return written(layers.spark.table(table))
    finally:
        layers.spark.sql(f"DROP TABLE IF EXISTS {table}")


def from_states(state: str, keys: list[str], layers: Layers) -> DataFrame:
    """A buyer report over stored daily states: all days are loaded, the run day a second time, then only states are read."""
    table, whole = _scratch_table(), written(getattr(layers, state))
    try:
        for rows in (whole, whole.where(F.col("dt") == F.lit(layers.order_day))):
            store(state, rows, table)
        stored = Stored(layers.spark, {state: table}, layers.order_day, history=(state,))
        return written(shop_ads.order_stats_from_state(getattr(stored, state), keys, layers.order_day))
    finally:
        layers.spark.sql(f"DROP TABLE IF EXISTS {table}")


def _half(parity: int) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.where(F.pmod(F.xxhash64("id"), F.lit(2)) == parity)


def _still_open(*unknown: str) -> Callable[[DataFrame], DataFrame]:
    """Every row before anything was finished: in the open partition, the end unknown."""
    def rows(df: DataFrame) -> DataFrame:
        end = {c: F.lit(OPEN_END).cast(df.schema[c].dataType) for c in ("dt", "end_date") if c in df.columns}
        return df.withColumns({**{c: F.lit(None).cast(df.schema[c].dataType) for c in unknown}, **end})

    return rows


def _closed(df: DataFrame) -> DataFrame:
    return df.where(F.col("dt") != F.lit(OPEN_END).cast(df.schema["dt"].dataType))


def _elsewhere(df: DataFrame) -> DataFrame:
    """Closed rows under another end, one to three days too early."""
    off = -(F.pmod(F.xxhash64("dt"), F.lit(3)) + 1).cast("int")
    return _closed(df).withColumns({c: F.date_add(c, off) for c in ("dt", "end_date") if c in df.columns})


def _misdated(df: DataFrame) -> DataFrame:
    """Half of the rows, each under one of the three days before its own."""
    return _half(0)(df).withColumn("dt", F.date_sub("dt", (F.pmod(F.xxhash64("id"), F.lit(3)) + 1).cast("int")))


def _register(name: str, of: str, *versions: Callable) -> None:
    QUERIES[name] = Query(QUERIES[of].contract, lambda w: loads(of, w, *versions))


_unfinished = ("finish_date", "finish_time")
_register("l16_late_rows_load", "l16_dwd_deliver_suc", _half(0), _half(1), _half(1))  # the second load twice
_register("l16_corrected_day_load", "l16_dwd_deliver_suc", _misdated, lambda df: df)
_register("l18_two_day_load", "l18_dwd_order_process", _still_open(), _closed)
_register("l18_three_day_load", "l18_dwd_order_process", _still_open(), _elsewhere, _closed)
_register("e15_two_day_load", "e15_dwd_trade_flow", _still_open(*_unfinished), _closed)
_register("e15_three_day_load", "e15_dwd_trade_flow", _still_open(*_unfinished), _elsewhere, _closed)
for _of in ("l11_dwd_pay_suc", "l13_dwd_receive"):
    QUERIES[f"{_of.split('_')[0]}_two_day_load"] = Query(QUERIES[_of].contract, lambda w, of=_of: from_open_rows(of, w))
for _of, _changing in (("e8_dim_user_zip", "user_level"), ("l8_dim_user_zip", "user_level"), ("l9_dim_user_address_zip", "address")):
    QUERIES[f"{_of.split('_')[0]}_three_snapshots_load"] = Query(
        QUERIES[_of].contract, lambda w, of=_of, changing=_changing: three_snapshots(of, w, changing))
QUERIES["l42_rerun_load"] = Query(QUERIES["l42_ads_city_stats"].contract, lambda w: rerun(
    "l42_ads_city_stats", w, lambda df: df.unionByName(df.withColumn("city_id", F.col("city_id") + 100_000))))
for _of, _state, _keys in (("e36_ads_order_by_category", "category_buyers", shop_ads.CATEGORY), ("e37_ads_order_by_brand", "brand_buyers", shop_ads.BRAND)):
    QUERIES[f"{_of.split('_')[0]}_from_daily_states"] = Query(
        QUERIES[_of].contract, lambda w, state=_state, keys=_keys: from_states(state, keys, w))
