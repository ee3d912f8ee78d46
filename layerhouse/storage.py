"""Queries that go through the table sources and sinks: rows are written, and what is stored is the answer.

All use the buyers' daily totals, stored by month, so that the partition is computed and a table has few of them.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, functions as F

from layerhouse.catalog import QUERIES, Layers, Query
from layerhouse.session import scratch, written
from layerhouse.sources import tables
from layerhouse.sources.keyed import Keyed

BASE, PARTITION, GAINED = "e24_dws_user_order_1d", "month", "order_total_amount_1d"
CONTRACT = f"{QUERIES[BASE].contract} {PARTITION}:s"


def monthly(w: Layers) -> DataFrame:
    return QUERIES[BASE].frame(w).withColumn(PARTITION, F.trunc("dt", "month"))


def _even() -> Column:
    return F.col("user_id") % 2 == 0


def parquet_at_a_path(rows: DataFrame, table: str, w: Layers) -> DataFrame:
    """An external Parquet table, replaced by a second write and not added to."""
    path = scratch(w.spark, "external")
    tables.save_table(rows.where(_even()), table, PARTITION, location=path)
    tables.save_table(rows, table, PARTITION, location=path)
    return w.spark.table(table)


def orc(rows: DataFrame, table: str, w: Layers) -> DataFrame:
    tables.save_table(rows, table, PARTITION, "orc", compression="snappy")
    return w.spark.table(table)


def appended(rows: DataFrame, table: str, w: Layers) -> DataFrame:
    """Two appends, the second with its columns in another order: they are matched by name."""
    tables.create_table(w.spark, table, rows.schema, PARTITION)
    tables.append(rows.where(_even()), table)
    tables.append(rows.where(~_even()).select(*reversed(rows.columns)), table)
    return w.spark.table(table)


def evolved(rows: DataFrame, table: str, w: Layers) -> DataFrame:
    """A table that gains a column between two appends; it is null in the older rows."""
    narrow = rows.where(_even()).drop(GAINED)
    tables.create_table(w.spark, table, narrow.schema, PARTITION)
    tables.append(narrow, table)
    tables.evolve_table(w.spark, table, {GAINED: rows.schema[GAINED].dataType.simpleString()})
    tables.append(rows.where(~_even()), table)
    return w.spark.table(table)


def filled(rows: DataFrame, table: str, w: Layers) -> DataFrame:
    """Rows aligned to the table's schema; a column they lack holds its type's default."""
    tables.create_table(w.spark, table, rows.schema, PARTITION)
    tables.append(tables.align_to(rows.drop(GAINED), w.spark.table(table).schema, fill=True), table)
    return w.spark.table(table)


def one_partition(rows: DataFrame, table: str, w: Layers) -> DataFrame:
    """The partition of one month, the only one that is read."""
    tables.save_table(rows, table, PARTITION)
    return tables.read_partition(w.spark, table, w.order_day.replace(day=1), PARTITION)


def added_to_its_history(rows: DataFrame, table: str, w: Layers) -> DataFrame:
    """Each load reads what the table holds, which is nothing the first time, and rewrites it with the new rows."""
    for new in (rows.where(_even()), rows.where(~_even())):
        held = tables.read_or_empty(w.spark, table, rows.schema)
        tables.save_table(written(held.unionByName(new)), table, PARTITION)
    return w.spark.table(table)


def checked(rows: DataFrame, table: str, w: Layers) -> DataFrame:
    """A load whose staged rows are counted before they are published, then one of an empty source, which writes nothing."""
    tables.create_table(w.spark, table, rows.schema, PARTITION)
    target = Keyed(w.spark, table, ["user_id", "dt"], PARTITION)
    try:
        target.merge(rows)
        before = target._loads()
        if target.merge(rows.where(F.lit(False))) or target._loads() != before:
            raise RuntimeError(f"{table}: an empty source has been loaded")
        return written(target.read())
    finally:
        target.drop()


def in_a_database(rows: DataFrame, table: str, w: Layers) -> DataFrame:
    """A table of a database at a given place; the load looks for the tables it needs first."""
    spark = w.spark
    try:
        tables.create_database(spark, table, scratch(spark, "database"))
        tables.save_table(rows, f"{table}.totals", PARTITION)
        tables.require_tables(spark, [f"{table}.totals"])
        return written(spark.table(f"{table}.totals"))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {table} CASCADE")


def _query(use: Callable[[DataFrame, str, Layers], DataFrame]) -> Query:
    def build(w: Layers) -> DataFrame:
        table = f"storage_{uuid4().hex}"
        try:
            return written(use(written(monthly(w)), table, w))
        finally:
            w.spark.sql(f"DROP TABLE IF EXISTS {table}")

    return Query(CONTRACT, build)


QUERIES |= {
    "s1_partition_scan": _query(one_partition),
    "s5_read_or_empty_history": _query(added_to_its_history),
    "k1_append_by_name": _query(appended),
    "k2_parquet_at_a_path": _query(parquet_at_a_path),
    "k3_orc_table": _query(orc),
    "k9_gained_column": _query(evolved),
    "k10_k12_database_and_required_tables": _query(in_a_database),
    "k11_checked_load": _query(checked),
    "k13_aligned_and_filled": _query(filled),
}
