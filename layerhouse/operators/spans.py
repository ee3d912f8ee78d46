"""Rolling day spans: 1/7/30-day totals ending at a run date, and moving windows per day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from layerhouse.functions.times import within


def rolled(
    daily: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
    as_of: dt.date,
    spans: Sequence[int] = (7, 30),
    date: str = "dt",
    zero: bool = True,
) -> DataFrame:
    """Wide totals per key, one pass: ``measures`` maps output stem -> daily column.

    Gives ``<stem>_<n>d`` for each span.  Only the longest span is read, and rows are not
    multiplied by the number of spans.
    """
    def total(source: str, span: int) -> Column:
        inside = F.when(within(F.col(date), as_of, span), F.col(source))
        return F.coalesce(F.sum(inside), F.lit(0)) if zero else F.sum(inside)

    return (
        daily.where(within(F.col(date), as_of, max(spans)))
        .groupBy(*keys)
        .agg(*[
            total(source, span).alias(f"{stem}_{span}d")
            for span in spans for stem, source in measures.items()
        ])
    )


def unpivot_spans(
    wide: DataFrame, keys: Sequence[str], stems: Sequence[str], spans: Sequence[int]
) -> DataFrame:
    """``<stem>_<n>d`` columns to one row per span with ``recent_days``."""
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(span).alias("recent_days"),
            *[F.col(f"{stem}_{span}d").alias(stem) for stem in stems],
        )
        for span in spans
    ]))
    return wide.select(*keys, rows.alias("r")).select(*keys, "r.*")


def span_totals(
    daily: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
    as_of: dt.date,
    spans: Sequence[int] = (7, 30),
    date: str = "dt",
) -> DataFrame:
    """One row per key and span, only for spans in which the key has a row."""
    marked = daily.withColumn("__seen", F.lit(1))
    wide = rolled(
        marked, keys, {**measures, "__seen": "__seen"}, as_of, spans, date, zero=False
    )
    long = unpivot_spans(wide, keys, [*measures, "__seen"], spans)
    return long.where(F.col("__seen") > 0).drop("__seen")


def moving(
    daily: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    windows: Mapping[str, int],
    date: str = "dt",
    frame: str = "range",
) -> DataFrame:
    """Moving sums per key for each day and each named window, as rows.

    ``range`` counts calendar days, so a missing day shortens the window; ``rows`` counts rows.
    The input is one row per key and day, so a window partition holds at most one row per day; all
    windows share its one sort.  Gives ``time_type, start_date, end_date`` and the measures.
    """
    if frame == "range":
        order = Window.partitionBy(*keys).orderBy(F.datediff(F.col(date), F.lit(dt.date(1970, 1, 1))))
        frames = {name: order.rangeBetween(-(days - 1), 0) for name, days in windows.items()}
    else:
        order = Window.partitionBy(*keys).orderBy(date)
        frames = {name: order.rowsBetween(-(days - 1), 0) for name, days in windows.items()}
    wide = daily.select(*keys, date, *[
        F.sum(m).over(frames[name]).alias(f"{name}__{m}") for name in windows for m in measures
    ])
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(name).alias("time_type"), F.date_sub(date, days - 1).alias("start_date"),
            F.col(date).alias("end_date"), *[F.col(f"{name}__{m}").alias(m) for m in measures],
        )
        for name, days in windows.items()
    ]))
    return wide.select(*keys, rows.alias("r")).select(*keys, "r.*")


def recent_by(first: Column, as_of: dt.date, span: int) -> Column:
    """1 when a date falls in the span ending at ``as_of``, else 0."""
    return F.when(within(first, as_of, span), 1).otherwise(0)
