"""Ancestors of every node of a tree that is stored as child and parent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from layerhouse.session import written


def closure(nodes: DataFrame, node: str = "id", parent: str = "parent_id", name: str = "name") -> DataFrame:
    """``id`` and ``path``: the node itself and its ancestors (structs of ``id`` and ``name``), nearest first.

    Pointer doubling: each round a path takes over the path of the node that it ends below, so a tree
    of depth d needs about log2(d) rounds, each one join on the node.  Rounds are written to the
    shared folder, and a lost executor costs one of them.  ``node`` is unique and not null.  A parent
    that is not in the table ends a path.  A path that comes back to a node it holds is an error that
    names nodes on such a cycle.
    """
    at = nodes.select(
        F.col(node).alias("id"), F.array(F.struct(F.col(node).alias("id"), F.col(name).alias("name"))).alias("path"),
        F.col(parent).cast(nodes.schema[node].dataType).alias("above"),
    )
    while True:
        at = written(at)
        more = at.where(F.col("above").isNotNull())
        if more.isEmpty():
            return at.select("id", "path")
        twice = more.where(F.size(F.array_distinct("path.id")) < F.size("path"))
        if found := [r.id for r in twice.select("id").limit(10).collect()]:
            raise ValueError(f"nodes below a cycle of parents: {sorted(found)}")
        ahead = at.select(F.col("id").alias("above"), F.col("path").alias("rest"), F.col("above").alias("further"))
        at = at.join(ahead, "above", "left").select(
            "id", F.concat("path", F.coalesce("rest", F.array().cast(at.schema["path"].dataType))).alias("path"),
            F.col("further").alias("above"),
        )


def ancestor(steps: int, part: str) -> Column:
    """``id`` or ``name`` of the ancestor some steps up (0: the node itself), null above the root."""
    return F.get("path", F.lit(steps))[part]
