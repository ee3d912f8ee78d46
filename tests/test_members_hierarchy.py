"""Daily member states against plain distinct counts, and ancestor paths against walking up."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from layerhouse.operators import hierarchy, members
from layerhouse.plans import shop_ads, shop_dws, tms_dws

D = dt.date(2025, 6, 30)
SPANS = (1, 7, 30)


def _visits(spark, many=4000, reach=40):
    """One key holds half of the rows; identifiers lie on both sides of the block edges, some are null."""
    random.seed(5)
    near = [0, 1, 32767, 32768, 32769, 65536, 65537, -1, -32768, 10**12]
    rows = []
    for _ in range(many):
        who = random.choice([*near, *range(2, 300), None])
        key = random.choice(["hot", "hot", "hot", "a", "b", None])
        rows.append((key, D - dt.timedelta(days=random.randrange(-2, reach)), who, random.randrange(5)))
    return rows, spark.createDataFrame(rows, "k string, dt date, who long, n long")


def _expected(rows):
    out = {}
    for key in {r[0] for r in rows if 0 <= (D - r[1]).days < 30}:
        line = []
        for span in SPANS:
            inside = [r for r in rows if r[0] == key and 0 <= (D - r[1]).days < span]
            line += [len({r[2] for r in inside} - {None}), sum(r[3] for r in inside)]
        out[key] = line
    return out


def test_rolled_members_equal_distinct_counts(spark):
    rows, df = _visits(spark)
    state = members.daily_members(df, ["k"], "who", {"n": "n"})
    assert {r[0]: list(r[1:]) for r in members.rolled_members(state, ["k"], ["n"], D, SPANS).collect()} == _expected(rows)


def test_a_hot_key_is_split_into_blocks(spark):
    df = spark.range(200_000).select(F.lit("hot").alias("k"), F.lit(D).alias("dt"), F.col("id").alias("who"), F.lit(1).alias("n"))
    state = members.daily_members(df, ["k"], "who", {"n": "n"})
    sizes = state.select(F.octet_length("members").alias("bytes")).collect()
    assert len(sizes) == 8 and max(r.bytes for r in sizes) == 4096  # block 0 holds zero alone
    total = members.rolled_members(state, ["k"], ["n"], D, (1, 7)).first()
    assert tuple(total) == ("hot", 200_000, 200_000, 200_000, 200_000)


def test_no_rows_give_no_members(spark):
    _, df = _visits(spark, 10)
    none = df.where("false")
    for state, roll in ((members.daily_members, members.rolled_members), (members.daily_sketches, members.rolled_sketches)):
        assert roll(state(none, ["k"], "who", {"n": "n"}), ["k"], ["n"], D, SPANS).collect() == []


def test_sketches_stay_within_their_bound(spark):
    df = spark.range(60_000).select(
        F.lit("k").alias("k"), F.date_sub(F.lit(D), (F.col("id") % 30).cast("int")).alias("dt"),
        F.concat(F.lit("user "), F.col("id") % 40_000).alias("who"), F.lit(1).alias("n"))
    state = members.daily_sketches(df, ["k"], "who", {"n": "n"})
    exact = df.agg(F.countDistinct("who")).first()[0]
    found = members.rolled_sketches(state, ["k"], ["n"], D, (1, 30)).first()
    assert abs(found.members_30d - exact) <= 4 * 1.04 / 2 ** (members.PRECISION / 2) * exact
    assert found.n_30d == 60_000


def test_the_report_reads_only_the_days_of_its_states(spark, tmp_path):
    _, visits = _visits(spark)
    daily = visits.select(
        F.col("k").alias("tm_id"), F.col("k").alias("tm_name"), "dt", F.col("who").alias("user_id"), (F.col("n") + 1).alias("order_count_1d")
    ).where("user_id IS NOT NULL")
    shop_dws.buyers_1d(daily, shop_ads.BRAND).write.partitionBy("dt").parquet(f"{tmp_path}/state")
    stored = spark.read.parquet(f"{tmp_path}/state")
    report = shop_ads.order_stats_from_state(stored, shop_ads.BRAND, D)
    plan = report._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scan) == 1 and "PartitionFilters: [isnotnull(dt" in scan[0] and "2025-06-01" in scan[0] and "user_id" not in scan[0]
    columns = ["dt", "recent_days", "tm_id", "tm_name", "order_count", "order_user_count"]
    direct = shop_ads.order_stats_by_brand(daily, D)
    assert sorted(map(str, report.select(*columns).collect())) == sorted(map(str, direct.select(*columns).collect()))


# ---------------------------------------------------------------- paths


@pytest.mark.parametrize("depth", [1, 2, 3, 8, 13])
def test_paths_of_any_depth(spark, depth):
    """A chain of ``depth`` nodes with two leaves on each, and a node whose parent is unknown."""
    parents = {i: i - 1 if i else None for i in range(depth)}
    parents |= {100 + 2 * i + j: i for i in range(depth) for j in (0, 1)} | {999: 5000}
    nodes = spark.createDataFrame([(i, p, f"n{i}") for i, p in parents.items()], "id long, parent_id long, name string")
    found = {r.id: [(p.id, p.name) for p in r.path] for r in hierarchy.closure(nodes).collect()}

    def walk(i):
        return [(i, f"n{i}"), *(walk(parents[i]) if parents.get(i) in parents else [])]

    assert found == {i: walk(i) for i in parents}


def test_no_nodes_no_paths(spark):
    assert hierarchy.closure(spark.createDataFrame([], "id long, parent_id long, name string")).count() == 0


@pytest.mark.parametrize("rows", [[(1, 1)], [(1, 2), (2, 3), (3, 1), (9, 3)]])
def test_a_cycle_is_named(spark, rows):
    nodes = spark.createDataFrame([(i, p, "x") for i, p in [*rows, (50, None), (51, 50)]], "id long, parent_id long, name string")
    with pytest.raises(ValueError, match=r"cycle of parents: \[1"):
        hierarchy.closure(nodes)


def test_places_of_both_levels(spark, rows):
    regions = spark.createDataFrame(
        [(1, None, "P"), (10, 1, "C"), (100, 10, "D")], "id long, parent_id long, name string")
    organs = spark.createDataFrame(
        [(7, "top", 1, 10), (8, "sub", 2, 100), (9, "lost", 2, 555)], "id long, org_name string, org_level int, region_id long")
    paths = tms_dws.organ_paths(organs, regions)
    named = ["id", "city_id", "city_name", "province_id", "province_name"]
    assert rows(tms_dws.places(paths), *named) == [(7, 10, "C", 1, "P"), (8, 10, "C", 1, "P"), (9, None, None, None, None)]
    named[0] = "org_id"
    assert rows(tms_dws.district_places(paths), *named) == [
        (7, 1, "P", None, None), (8, 10, "C", 1, "P"), (9, None, None, None, None)]


def test_no_bitmap_is_shuffled_while_states_are_built(spark):
    _, df = _visits(spark, 100)
    state = members.daily_members(df, ["k"], "who", {"n": "n"})
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.rindex("bitmap_construct_agg") < plan.index("Exchange")
