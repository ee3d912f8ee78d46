"""Exact duplicates by a tree-merge of sorted digest runs; DataFrame operations only.

Each input partition reduces its rows to a run: one row per digest, holding the best identifier and
the number of rows.  In round ``r`` the runs meet in cliques of ``RADIX``: a row moves to the member of
its clique that the ``r``-th digit of its digest names, and every member merges the runs it receives
(a sort-based aggregate over at most ``RADIX`` sorted runs), again keeping the best identifier only.
After ``log(runs)`` rounds each run owns one range of digests.  A group of copies is one row per run
from the first level on, so no task ever receives a hot group, and no task owns all digests.

Texts are told apart by SHA-256, the byte length and a second, unrelated hash of the normalised text
at every level: rows merge only if all three agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from layerhouse.llm.inputs import texts, without_blanks
from layerhouse.session import written

RADIX = 4
IDENTITY = ["digest", "n_bytes", "second"]


def _digit(number: Column, place: int) -> Column:
    return F.pmod(F.floor(number / F.lit(RADIX**place)), F.lit(RADIX)).cast("int")


def tree_merge(facts: DataFrame, levels: int) -> DataFrame:
    """One row per identity with ``best`` (the smallest) and ``rows``, by ``levels`` merge rounds.

    ``facts`` has the identity columns and ``best``, a comparable value.  There are
    ``RADIX ** levels`` runs.
    """
    runs = RADIX**levels
    merged = [F.min("best").alias("best"), F.sum("rows").alias("rows")]
    run = facts.select(*IDENTITY, "best", F.lit(1).cast("long").alias("rows"),
                       F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"))
    run = run.groupBy("run", *IDENTITY).agg(*merged)
    goal = F.pmod(F.xxhash64("digest"), F.lit(runs))
    for place in range(levels):
        there = (F.col("run") + (_digit(goal, place) - _digit(F.col("run"), place)) * RADIX**place).cast("int")
        run = run.withColumn("run", there).repartitionById(runs, F.col("run"))
        run = run.groupBy("run", *IDENTITY).agg(*merged)
    return run.drop("run")


def levels_for(runs: int) -> int:
    levels = 1
    while RADIX**levels < runs:
        levels += 1
    return levels


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``df``.

    Texts are equal when they are identical without the characters of ``BLANKS``; a null text is an
    empty text, and all empty texts are one group.  Of a group the row with the most code points in
    its original text stays, of those the one with the smallest identifier (a null identifier last).
    Rows that repeat an identifier and its text count in ``group_size`` and are kept or dropped
    together.  An empty table gives an empty result; other columns are not read.
    """
    spark = df.sparkSession
    normal = without_blanks(F.col("text"))
    facts = written(texts(df, id_col, text_col).select(
        "doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("points"),
        F.unhex(F.sha2(normal, 256)).alias("digest"), F.octet_length(normal).alias("n_bytes"),
        F.xxhash64(normal).alias("second"),
    ))
    best = F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("unnamed"), "doc_id")
    levels = levels_for(int(spark.conf.get("spark.sql.shuffle.partitions")))
    winners = written(tree_merge(facts.select(*IDENTITY, best.alias("best")), levels).select(
        *IDENTITY, F.col("best.doc_id").alias("keep_id"), (-F.col("best.points")).alias("keep_points"),
        F.col("rows").alias("group_size"),
    ))
    return facts.join(winners, IDENTITY).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns; a repeated row stays once."""
    stay = exact_dedup(df, id_col, text_col).where("kept").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__digest"),
    ).distinct()
    marked = df.withColumn("__sha", F.sha2(without_blanks(F.col(text_col).cast("string")), 256))
    here = marked.join(stay, marked[id_col].eqNullSafe(stay["__id"]) & (marked["__sha"] == stay["__digest"]), "left_semi")
    return here.dropDuplicates([id_col, "__sha"]).drop("__sha")
