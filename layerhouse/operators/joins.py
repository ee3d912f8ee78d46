"""Look-ups, hierarchy walks and the alignment of facts on shared keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Bits of a key filter for each key, so that one in 16 other keys passes at most, and in all (32 MB); beyond it more pass.
KEY_BITS, MOST_BITS = 16, 1 << 28

#: Bits in a block of a key filter (4 KB).
BLOCK_BITS = 1 << 15


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str] | Sequence[str],
    how: str = "left",
    hot: bool = False,
) -> DataFrame:
    """Add dimension columns to a fact.

    ``on`` maps fact column -> dimension key (cast to the fact's type, so the fact side stays
    untouched); ``take`` maps new column -> dimension column.  The dimension must be unique on
    its key.  Whether it is broadcast is left to Spark's size check; a large dimension joins by
    shuffle, where AQE splits hot or null keys.  Set ``hot`` where the dimension is itself an
    aggregate on the key (see ``splittable``).
    """
    take = dict(take) if isinstance(take, Mapping) else {name: name for name in take}
    keys = {key: f"__{i}" for i, key in enumerate(on)}
    picked = dim.select(
        *[F.col(on[key]).cast(fact.schema[key].dataType).alias(keys[key]) for key in on],
        *[F.col(source).alias(name) for name, source in take.items()],
    )
    met = [fact[key] == picked[keys[key]] for key in on]
    if hot:
        met.append(splittable([fact[key] for key in on], [picked[keys[key]] for key in on]))
    return fact.join(picked, met, how).drop(*keys.values())


def splittable(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """A condition implied by equal keys that lets AQE split a hot one.

    A side already partitioned by the join key, as an aggregate on it is, joins without a shuffle
    of its own, and run-time skew handling works only on two fresh shuffles.  No existing
    partitioning covers this extra key, so both sides are shuffled for the join.
    """
    return F.xxhash64(*left) == F.xxhash64(*right)


def with_all(one: DataFrame, many: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Left join of unique rows to any number of others, when one key may own most of the others.

    Skew on the right of a left join cannot be split at run time; on either side of an inner join
    it can.  So matches are joined inner, and rows without a match are added by an anti join
    against the distinct keys.  ``on`` maps column of ``one`` -> column of ``many``.
    """
    renamed = {source: f"__{i}" for i, source in enumerate(on.values())}
    others = many.withColumnsRenamed(renamed)
    keys = [F.col(key) == F.col(renamed[source]) for key, source in on.items()]
    hot = splittable([F.col(key) for key in on], [F.col(name) for name in renamed.values()])
    matched = one.join(others, [*keys, hot], "inner").drop(*renamed.values())
    known = others.select(*renamed.values()).distinct()
    lonely = one.join(known, keys, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def key_filter(keys: DataFrame, key: str) -> Callable[[DataFrame, str], DataFrame]:
    """Drop rows that meet none of ``keys`` where they are read, ahead of a join that shuffles the rest.

    Gives a function of rows and their key column that returns every row whose key is among ``keys`` and few others:
    a bitmap of hashed keys, of bounded size, is sent to all tasks.  ``keys`` is read twice, so it is a stored frame.
    """
    kind, bits = keys.schema[key].dataType, BLOCK_BITS
    wanted = min(KEY_BITS * keys.count(), MOST_BITS)
    while bits < wanted:
        bits *= 2

    def place(column: str) -> Column:
        return F.xxhash64(column).bitwiseAND(F.lit(bits - 1))

    # one narrow row per key is shuffled to its block, however often the key is there
    placed = keys.where(F.col(key).isNotNull()).select(place(key).alias("__place")).distinct()
    blocks = placed.select(
        F.floor(F.col("__place") / BLOCK_BITS).alias("__block"), (F.col("__place") % BLOCK_BITS).alias("__bit")
    ).repartition("__block").groupBy("__block").agg(F.bitmap_construct_agg("__bit").alias("__bits"))

    def near(rows: DataFrame, column: str) -> DataFrame:
        if rows.schema[column].dataType != kind or kind not in (T.IntegerType(), T.LongType(), T.StringType()):
            return rows  # equal keys may have different hashes
        bit = place(column) % BLOCK_BITS
        byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        met = (F.floor(place(column) / BLOCK_BITS) == F.col("__block")) & (F.getbit(byte, (bit % 8).cast("int")) == 1)
        return rows.join(F.broadcast(blocks), met, "left_semi")

    return near


def walk_up(
    df: DataFrame,
    regions: DataFrame,
    start: str,
    levels: Sequence[str],
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Follow ``parent_id`` from the region in ``start``, one look-up per level.

    Adds ``<level>_id`` and ``<level>_name`` for each level; the first level is the region itself.
    """
    names = {"id": "id", "name": "name", "parent": "parent_id", **(columns or {})}
    at = start
    for i, level in enumerate(levels):
        df = lookup(
            df, regions, {at: names["id"]},
            {f"{level}_id": names["id"], f"{level}_name": names["name"], f"__up{i}": names["parent"]},
        )
        at = f"__up{i}"
    return df.drop(*[f"__up{i}" for i in range(len(levels))])


def align_facts(keys: Sequence[str], *facts: DataFrame) -> DataFrame:
    """Full outer join of any number of facts that are unique on ``keys``.

    One union and one shuffle replace a chain of full joins; a key present only in a later fact
    still meets the others, and measures a fact does not carry stay null.
    """
    stacked = facts[0]
    for fact in facts[1:]:
        stacked = stacked.unionByName(fact, allowMissingColumns=True)
    measures = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in measures])


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """Put one-row aggregates next to each other."""
    return align_facts([], *one_row)


def sum_facts(keys: Sequence[str], measures: Sequence[str], *facts: DataFrame) -> DataFrame:
    """Align several rows per key: union, then sum; an absent measure counts as zero."""
    stacked = facts[0]
    for fact in facts[1:]:
        stacked = stacked.unionByName(fact, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]
    )


def net(keys: Sequence[str], measures: Sequence[str], plus: DataFrame, minus: DataFrame) -> DataFrame:
    """``plus - minus`` per key, keeping keys found on one side only."""
    signed = minus.select(*keys, *[(-F.col(m)).alias(m) for m in measures])
    stacked = plus.select(*keys, *measures).unionByName(signed)
    return stacked.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def label_code(column: Column, labels: Mapping[str, Column]) -> Column:
    """A simple CASE over codes; an unknown code gives null."""
    out = F.lit(None)
    for code, value in labels.items():
        out = F.when(column == code, value).otherwise(out)
    return out
