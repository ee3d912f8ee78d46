"""Distinct members over rolling spans from small daily states, without reading member rows again.

A state holds, per key and day, who was there.  Exact states are bitmaps: the members of a key are
split into blocks of 32,768 consecutive identifiers, so a hot key spreads over its blocks and no row
is larger than 4 KB.  They suit dense integer identifiers; a block with one member costs as much in
memory as a full one (on disk it compresses to a few bytes).  Sketched states are a choice for other
identifiers: about ``1.04 / sqrt(2 ** precision)`` relative standard error, one row per key and day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from layerhouse.functions.times import within

PRECISION = 14


def daily_members(
    rows: DataFrame, keys: Sequence[str], member: str, measures: Mapping[str, str], date: str = "dt",
) -> DataFrame:
    """State per key, day and block: ``members`` (bitmap) and the sums of ``measures`` (name -> column).

    ``member`` is an integer.  A null member is in no bitmap, but its measures count.
    """
    number = F.col(member).cast("bigint")
    once = rows.groupBy(*keys, date, number.alias("__member")).agg(*[F.sum(source).alias(name) for name, source in measures.items()])
    # one narrow row per member is shuffled to its block; a bitmap is made where all its members are
    blocks = once.withColumn("block", F.bitmap_bucket_number("__member")).repartition(*keys, date, "block")
    return blocks.groupBy(*keys, date, "block").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__member")).alias("members"),
        *[F.sum(name).cast(once.schema[name].dataType).alias(name) for name in measures],
    )


def _inside(value: str, date: str, as_of: dt.date, span: int) -> Column:
    return F.when(within(F.col(date), as_of, span), F.col(value))


def rolled_members(
    state: DataFrame, keys: Sequence[str], measures: Sequence[str], as_of: dt.date, spans: Sequence[int], date: str = "dt",
) -> DataFrame:
    """``members_<n>d`` and ``<measure>_<n>d`` per key from the states of the longest span's days.

    Blocks are united first, each by key and block, so that no task holds a key's whole membership.
    """
    blocks = state.where(within(F.col(date), as_of, max(spans))).groupBy(*keys, "block").agg(*[
        out for span in spans for out in (
            F.bitmap_count(F.bitmap_or_agg(_inside("members", date, as_of, span))).alias(f"members_{span}d"),
            *[F.sum(_inside(name, date, as_of, span)).alias(f"{name}_{span}d") for name in measures],
        )
    ])
    return _added(blocks, keys, ["members", *measures], spans)


def daily_sketches(
    rows: DataFrame, keys: Sequence[str], member: str, measures: Mapping[str, str], date: str = "dt", precision: int = PRECISION,
) -> DataFrame:
    """As ``daily_members`` for identifiers of any integer or text type, approximate: one sketch per key and day."""
    return rows.groupBy(*keys, date).agg(
        F.hll_sketch_agg(member, precision).alias("members"),
        *[F.sum(source).alias(name) for name, source in measures.items()],
    )


def rolled_sketches(
    state: DataFrame, keys: Sequence[str], measures: Sequence[str], as_of: dt.date, spans: Sequence[int], date: str = "dt",
) -> DataFrame:
    """As ``rolled_members`` over sketched states."""
    return state.where(within(F.col(date), as_of, max(spans))).groupBy(*keys).agg(*[
        out for span in spans for out in (
            F.coalesce(
                F.hll_sketch_estimate(F.hll_union_agg(_inside("members", date, as_of, span), True)), F.lit(0)
            ).alias(f"members_{span}d"),
            *[F.coalesce(F.sum(_inside(name, date, as_of, span)), F.lit(0)).alias(f"{name}_{span}d") for name in measures],
        )
    ])


def _added(blocks: DataFrame, keys: Sequence[str], stems: Sequence[str], spans: Sequence[int]) -> DataFrame:
    columns = [f"{stem}_{span}d" for span in spans for stem in stems]
    return blocks.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])
