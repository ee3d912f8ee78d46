"""Weighted rendezvous hashing of stable record keys over shards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from layerhouse.session import written

#: Shards the query fills; all weigh the same there.
SHARDS = 8


def shard_of(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key: the one whose score ``-weight / ln(u)`` is the largest.

    ``u`` in (0, 1) is a hash of key and shard alone, so a new shard only draws rows to itself and a
    changed weight only moves rows to or from that shard.  A null key hashes like any other value.
    Of equal scores the smaller shard wins.
    """
    def score(shard: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double")
        return -F.lit(float(weight)) / F.log((bits + 0.5) / F.lit(2.0**53))

    scored = [F.struct(score(s, w).alias("score"), F.lit(-s).alias("rank")) for s, w in sorted(weights.items()) if w > 0]
    if not scored:
        raise ValueError("no shard has a positive weight")
    best = scored[0] if len(scored) == 1 else F.greatest(*scored)
    return (-best["rank"]).cast("int")


def even(shards: int) -> dict[int, float]:
    return {shard: 1.0 for shard in range(shards)}


def number_within(df: DataFrame, group: str, alias: str) -> DataFrame:
    """Gapless numbers from 0 within ``group``, no matter how large a group is.

    The rows are written once with the task that wrote them; each task's rows of a group are numbered
    by themselves and start after those of the tasks before it.
    """
    row = F.monotonically_increasing_id()
    placed = written(df.withColumn("__row", row).withColumn("__task", F.shiftright("__row", 33)))
    counts = placed.groupBy(group, "__task").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(group).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    own = F.row_number().over(Window.partitionBy(group, "__task").orderBy("__row"))
    numbered = placed.withColumn("__own", own).join(starts, [group, "__task"])
    return numbered.select(*df.columns, (F.col("__start") + F.col("__own") - 1).alias(alias))


def rendezvous(df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
               weights: Mapping[int, float] | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``df``.

    ``size`` is the text's bytes plus 1, a null text having none.  ``grown_shard`` is the shard with
    one more shard of weight 1.  Rows that repeat an identifier share a shard and have slots of their
    own; a null identifier has a shard like any key.  An empty table gives an empty result.
    """
    now = dict(weights or even(shards))
    grown = now | {max(now) + 1: 1.0}
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    placed = df.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"),
        shard_of(F.col(id_col), now).alias("shard"), shard_of(F.col(id_col), grown).alias("grown_shard"),
    )
    numbered = number_within(placed, "shard", "slot")
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(df: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id",
                 weights: Mapping[int, float] | None = None, files_per_shard: int = 1,
                 keep: Sequence[str] | None = None) -> None:
    """Write the rows as Parquet, one folder per shard and ``files_per_shard`` files in each."""
    now = dict(weights or even(shards))
    columns = list(keep or df.columns)
    name = "shard" if "shard" not in columns else "__shard"
    part = F.pmod(F.xxhash64(F.lit("file"), F.col(id_col)), F.lit(files_per_shard))
    (df.select(*columns, shard_of(F.col(id_col), now).alias(name))
       .repartition(len(now) * files_per_shard, F.col(name), part)
       .write.partitionBy(name).parquet(path))
