"""Ranks, first rows, top-k and event sequences that hold up when one key has most of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from layerhouse.session import written


def _meet(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Inner join in which null keys match; the right side's keys are dropped."""
    renamed = {name: f"__r_{name}" for name in names}
    right = right.withColumnsRenamed(renamed)
    condition = F.lit(True)
    for name, other in renamed.items():
        condition = condition & F.col(name).eqNullSafe(F.col(other))
    return left.join(right, condition).drop(*renamed.values())


def _in_order(df: DataFrame, layout: Sequence[Column], tasks: int | None) -> DataFrame:
    """Rows range-partitioned and sorted by ``layout``, written out with their task and their place in it.

    Without ``tasks`` their number follows the data (AQE merges small neighbours).
    """
    ranged = df.repartitionByRange(tasks, *layout) if tasks else df.repartitionByRange(*layout)
    return written(ranged.sortWithinPartitions(*layout).select(
        "*", F.spark_partition_id().alias("__task"), F.monotonically_increasing_id().alias("__at")
    ))


def number_rows(
    df: DataFrame,
    order: Sequence[Column],
    keys: Sequence[str] = (),
    into: str = "rn",
    tasks: int | None = None,
) -> DataFrame:
    """``row_number()`` over ``keys`` without sending a key, or the whole table, to one task.

    Rows are range-partitioned by key and order, so a hot key spreads over many tasks, and written
    out with their task and their place in it.  A row's number is its place plus the rows of its
    key in earlier tasks.  ``order`` should end in a unique column.
    """
    placed = _in_order(df, [*[F.col(k) for k in keys], *order], tasks)
    runs = placed.groupBy("__task", *keys).agg(
        F.min("__at").alias("__first"), F.count("*").alias("__n")
    )
    # At most one row per key and task here, so this window is bounded by the number of tasks.
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    runs = runs.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    # without keys there is one offset per task, which travels to the rows instead of the rows to it
    joined = _meet(placed, runs, ["__task", *keys]) if keys else placed.join(F.broadcast(runs), "__task")
    number = F.col("__before") + F.col("__at") - F.col("__first") + 1
    return joined.select(*df.columns, number.alias(into))


def number_by_each(
    df: DataFrame, keys: Sequence[str], unique: Sequence[str], ranks: Mapping[str, str]
) -> DataFrame:
    """Several descending row numbers per key in one layout.

    ``ranks`` maps output column -> ordering column; ties fall to the ``unique`` columns.  The
    orderings are stacked, numbered together and folded back to one row.
    """
    orderings = F.explode(F.array(*[
        F.struct(F.lit(name).alias("__rank"), F.col(source).cast("double").alias("__by"))
        for name, source in ranks.items()
    ]))
    stacked = df.select(*keys, *unique, orderings.alias("__o")).select(*keys, *unique, "__o.*")
    numbered = number_rows(
        stacked,
        [F.col("__by").desc_nulls_last(), *[F.col(u) for u in unique]],
        ["__rank", *keys],
        into="__rn",
    )
    folded = numbered.groupBy(*keys, *unique).agg(*[
        F.max(F.when(F.col("__rank") == name, F.col("__rn"))).alias(name) for name in ranks
    ])
    return _meet(df, folded, [*keys, *unique]).select(*df.columns, *ranks)


def topk_with_ties(
    df: DataFrame, keys: Sequence[str], by: str, k: int, into: str = "rk"
) -> DataFrame:
    """Rows whose ``rank()`` by descending ``by`` is at most ``k``, ties included.

    Ranks are worked out on distinct values, of which at most ``k`` per key are kept by each map
    task, so neither a big key nor a long tie passes through one task.
    """
    values = df.groupBy(*keys, by).agg(F.count("*").alias("__n"))
    falling = Window.partitionBy(*keys).orderBy(F.col(by).desc_nulls_last())
    top = values.withColumn("__place", F.row_number().over(falling)).where(F.col("__place") <= k)
    above = F.sum("__n").over(falling.rowsBetween(Window.unboundedPreceding, -1))
    ranked = top.withColumn(into, (F.coalesce(above, F.lit(0)) + 1).cast("int")).where(
        F.col(into) <= k
    ).drop("__n", "__place")
    return _meet(df, ranked, [*keys, by]).select(*df.columns, into)


def first_per(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The first row per key, as an aggregate: each map task sends at most one row per key."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("__row")).select(*keys, "__row.*")


def in_sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    number: str = "rn",
    following: str = "next",
    tasks: int | None = None,
) -> DataFrame:
    """``row_number()`` and ``lead(value)`` per key, as a scan over segments of the ordered rows.

    Rows are range-partitioned by key and order, so a hot key spreads over many tasks even where its
    rows share a moment.  Numbers and next values are found inside a task; only the key a task ends
    with can go on in the next one, so one row per task carries counts and first values across.
    ``order`` should end in a unique column.  Null keys are one key.
    """
    placed = _in_order(df, [F.col(c) for c in [*keys, *order]], tasks)
    key = F.struct(*keys)
    inner = Window.partitionBy("__task", *keys).orderBy("__at")
    local = placed.withColumns({
        "__rn": F.row_number().over(inner), "__next": F.lead(value).over(inner),
        "__ends": F.lead("__at").over(inner).isNull(),
    })
    return local.join(F.broadcast(_carried(placed, key, value)), "__task").select(
        *df.columns,
        (F.col("__rn") + F.when(key.eqNullSafe(F.col("__head")), F.col("__before")).otherwise(0)).alias(number),
        F.when(~F.col("__ends"), F.col("__next"))
        .when(key.eqNullSafe(F.col("__tail")), F.col("__after")).alias(following),
    )


def _carried(placed: DataFrame, key: Column, value: str) -> DataFrame:
    """Per task its first and last key, the rows of the first in earlier tasks, and the value after the last."""
    ends = placed.groupBy("__task").agg(
        F.min_by(F.struct(key.alias("key"), F.col(value).alias("value")), "__at").alias("first"),
        F.max_by(key, "__at").alias("__tail"),
    )
    tails = placed.join(F.broadcast(ends.select("__task", "__tail")), "__task").where(
        key.eqNullSafe(F.col("__tail"))
    ).groupBy("__task").agg(F.count("*").alias("n"))
    # One row per task, so these windows are bounded by the number of tasks.
    line = Window.partitionBy(F.lit(0)).orderBy("__task")
    so_far = F.sum("n").over(Window.partitionBy("__tail").orderBy("__task"))
    runs = ends.join(tails, "__task").withColumn("so_far", so_far).withColumns({
        "earlier": F.lag(F.struct("__tail", "so_far")).over(line), "later": F.lead("first").over(line),
    })
    before = F.when(F.col("earlier.__tail").eqNullSafe(F.col("first.key")), F.col("earlier.so_far"))
    return runs.select(
        "__task", F.col("first.key").alias("__head"), "__tail",
        F.coalesce(before, F.lit(0)).alias("__before"),
        F.when(F.col("later.key").eqNullSafe(F.col("__tail")), F.col("later.value")).alias("__after"),
    )
