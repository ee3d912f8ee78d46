"""Reading and writing partitioned warehouse tables.

Columns are matched by name, writes are idempotent partition overwrites, and row counts come from
the write itself.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from layerhouse.functions.times import business_date
from layerhouse.session import written

# ---------------------------------------------------------------- reading


def read_partition(
    spark: SparkSession, table: str, day: dt.date | str, column: str = "dt", live_only: bool = False
) -> DataFrame:
    """One partition of a table; ``live_only`` also drops soft-deleted rows.

    A text partition column may hold either date format; both are asked for, and still prune.
    """
    df, day = spark.table(table), business_date(day)
    if isinstance(df.schema[column].dataType, T.DateType):
        df = df.where(F.col(column) == F.lit(day))
    else:
        df = df.where(F.col(column).isin(day.strftime("%Y-%m-%d"), day.strftime("%Y%m%d")))
    return live(df) if live_only else df


def live(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_deleted") == "0")


def read_or_empty(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty frame of the given schema where it does not exist yet."""
    if spark.catalog.tableExists(table):
        return align_to(spark.table(table), schema)
    return spark.createDataFrame([], schema)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def require_tables(spark: SparkSession, tables: Iterable[str]) -> None:
    missing = [t for t in tables if not spark.catalog.tableExists(t)]
    if missing:
        raise LookupError(f"missing tables: {', '.join(missing)}")


# ---------------------------------------------------------------- shaping


def align_to(
    df: DataFrame, schema: T.StructType, fill: bool = False
) -> DataFrame:
    """Columns of ``schema``, in its order and types; columns the frame lacks become null.

    ``fill`` puts a type default in place of nulls: 0, empty text, 1970-01-01.
    """
    out = []
    for field in schema.fields:
        value = F.col(field.name) if field.name in df.columns else F.lit(None)
        value = value.cast(field.dataType)
        if fill:
            value = F.coalesce(value, _default(field.dataType))
        out.append(value.alias(field.name))
    return df.select(*out)


def _default(kind: T.DataType):
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.lit(dt.date(1970, 1, 1)).cast(kind)
    return F.lit(None).cast(kind)


def add_columns(df: DataFrame, new: Mapping[str, str]) -> DataFrame:
    """Schema evolution: columns a table has gained, null in older rows."""
    return df.withColumns({
        name: F.lit(None).cast(kind) for name, kind in new.items() if name not in df.columns
    })


# ---------------------------------------------------------------- writing


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{at}")


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partition: str | None = "dt",
    fmt: str = "parquet",
    location: str | None = None,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
    comments: Mapping[str, str] | None = None,
) -> None:
    """Create a table with column comments, format, location and properties if it is missing."""
    quote = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    notes = comments or {}
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" COMMENT {quote(notes[f.name])}" if f.name in notes else "")
        for f in schema.fields
    )
    parts = [f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt}"]
    if partition:
        parts.append(f"PARTITIONED BY (`{partition}`)")
    if location:
        parts.append(f"LOCATION {quote(location)}")
    if comment:
        parts.append(f"COMMENT {quote(comment)}")
    if properties:
        pairs = ", ".join(f"{quote(k)}={quote(v)}" for k, v in properties.items())
        parts.append(f"TBLPROPERTIES ({pairs})")
    spark.sql(" ".join(parts))


def evolve_table(spark: SparkSession, table: str, new: Mapping[str, str]) -> None:
    missing = {n: k for n, k in new.items() if n not in spark.table(table).columns}
    if missing:
        columns = ", ".join(f"`{n}` {k}" for n, k in missing.items())
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def append(df: DataFrame, table: str) -> int:
    """Append by name to an existing table; returns the rows written."""
    target = df.sparkSession.table(table).schema
    return _counted(align_to(df, target), lambda out: out.write.insertInto(table))


def overwrite_partitions(df: DataFrame, table: str) -> int:
    """Replace the partitions ``df`` has rows for, leaving the others; returns the rows written."""
    spark = df.sparkSession
    with _dynamic_overwrite(spark):
        return _counted(
            align_to(df, spark.table(table).schema),
            lambda out: out.write.insertInto(table, overwrite=True),
        )


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """``insertInto`` takes the overwrite mode from the session only, not from a write option."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def overwrite_path(
    df: DataFrame, path: str, partition: str | None = "dt", fmt: str = "parquet", **options: str
) -> int:
    """Overwrite files under ``path``; with a partition column only the partitions in ``df``."""
    def write(out: DataFrame) -> None:
        writer = out.write.mode("overwrite").format(fmt).options(**options)
        if partition:
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition)
        writer.save(path)

    return _counted(df, write)


def save_table(
    df: DataFrame, table: str, partition: str | None = None, fmt: str = "parquet",
    location: str | None = None, **options: str,
) -> int:
    """Replace a whole table, creating it where missing."""
    def write(out: DataFrame) -> None:
        writer = out.write.mode("overwrite").format(fmt).options(**options)
        if partition:
            writer = writer.partitionBy(partition)
        if location:
            writer = writer.option("path", location)
        writer.saveAsTable(table)

    return _counted(df, write)


def write_text_table(df: DataFrame, path: str) -> int:
    """A tab-delimited text result table."""
    return _counted(df, lambda out: out.write.mode("overwrite").csv(path, sep="\t"))


def replace_days(df: DataFrame, table: str, days: Iterable[dt.date | str] = (), column: str = "dt") -> int:
    """Replace the partitions ``df`` has rows for and empty those of ``days`` it has none for."""
    spark, wanted = df.sparkSession, {str(business_date(d)) for d in days}
    if wanted:
        df = written(df)  # read for its days as well
        wanted -= {str(r[0]) for r in df.where(F.col(column).cast("string").isin(*wanted)).select(column).distinct().collect()}
    rows = overwrite_partitions(df.hint("rebalance", F.col(column)), table)
    for day in sorted(wanted):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{column}` = '{day}')")
    return rows


def merge_rows(df: DataFrame, table: str, keys: Sequence[str], also: Iterable[dt.date | str] = (), column: str = "dt") -> int:
    """Merge rows into the partitions they belong to; returns the rows written.

    Stored rows of the touched partitions stay unless their key comes again; ``also`` names further
    partitions a key may be stored in (the open one of an accumulating table), from which it moves.
    Only touched partitions are read and written, in one overwrite, after the result is materialised;
    a repeated merge changes nothing.  Null keys are equal.
    """
    spark = df.sparkSession
    also = [business_date(d) for d in also]
    fresh = written(align_to(df, spark.table(table).schema))
    # one row per day reaches the driver, and the days reach the scan as literals
    touched = {str(r[0]) for r in fresh.where(F.col(column).isNotNull()).select(column).distinct().collect()} | {str(d) for d in also}
    stored = spark.table(table).where(F.col(column).isin(*touched) if touched else F.lit(False))
    again = fresh.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    kept = stored.join(again, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left_anti")
    merged = kept.select(*fresh.columns).unionByName(fresh)
    # the partitions that are overwritten are also read, so the result is materialised first
    return replace_days(merged if also else written(merged), table, also, column)


def merge_history(df: DataFrame, table: str, keys: Sequence[str]) -> int:
    """Add report rows to a history table so that a re-run replaces rather than repeats them."""
    return merge_rows(df, table, keys)


def _counted(df: DataFrame, write) -> int:
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]
