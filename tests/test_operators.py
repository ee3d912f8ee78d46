import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from layerhouse import session
from layerhouse.operators import cohorts, joins, ordering, spans

D = dt.date(2025, 6, 30)


def days(n):
    return D - dt.timedelta(days=n)


# ---------------------------------------------------------------- joins


def test_lookup_casts_the_dimension_key_and_keeps_unmatched(spark, rows):
    fact = spark.createDataFrame([("1", 10), ("2", 20), (None, 30)], "code string, n int")
    dim = spark.createDataFrame([(1, "one")], "id int, name string")
    assert rows(joins.lookup(fact, dim, {"code": "id"}, {"label": "name"})) == [
        ("1", 10, "one"), ("2", 20, None), (None, 30, None)]
    assert rows(joins.lookup(fact, dim, {"code": "id"}, {"label": "name"}, "inner")) == [("1", 10, "one")]


def test_role_playing_lookups(spark, rows):
    fact = spark.createDataFrame([(1, 2), (2, 9)], "a int, b int")
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string")
    out = joins.lookup(joins.lookup(fact, dim, {"a": "id"}, {"an": "name"}), dim, {"b": "id"}, {"bn": "name"})
    assert rows(out) == [(1, 2, "x", "y"), (2, 9, "y", None)]


def test_walk_up_three_levels(spark, rows):
    regions = spark.createDataFrame(
        [(1, None, "P"), (10, 1, "C"), (100, 10, "D")], "id int, parent_id int, name string")
    start = spark.createDataFrame([(100,), (10,), (7,)], "r int")
    out = joins.walk_up(start, regions, "r", ["district", "city", "province"])
    assert rows(out) == [
        (10, 10, "C", 1, "P", None, None), (100, 100, "D", 10, "C", 1, "P"), (7, None, None, None, None, None, None)]


def test_align_three_facts_meets_keys_missing_in_the_first(spark, rows):
    a = spark.createDataFrame([(1, 5)], "k int, a int")
    b = spark.createDataFrame([(2, 6)], "k int, b int")
    c = spark.createDataFrame([(2, 7), (3, 8)], "k int, c int")
    want = [(1, 5, None, None), (2, None, 6, 7), (3, None, None, 8)]
    assert rows(joins.align_facts(["k"], a, b, c), "k", "a", "b", "c") == want
    assert rows(joins.align_facts(["k"], c, b, a), "k", "a", "b", "c") == want


def test_side_by_side_and_net(spark, rows):
    one, two = (spark.sql(f"SELECT {n} AS {c}") for n, c in ((3, "x"), (4, "y")))
    assert rows(joins.side_by_side(one, two)) == [(3, 4)]
    plus = spark.createDataFrame([(1, 10), (2, 5)], "k int, n int")
    minus = spark.createDataFrame([(1, 4), (3, 1)], "k int, n int")
    assert rows(joins.net(["k"], ["n"], plus, minus)) == [(1, 6), (2, 5), (3, -1)]


def test_sum_facts_counts_absent_measures_as_zero(spark, rows):
    a = spark.createDataFrame([(1, 5), (1, 6)], "k int, a int")
    b = spark.createDataFrame([(2, 7)], "k int, b int")
    assert rows(joins.sum_facts(["k"], ["a", "b"], a, b)) == [(1, 11, 0), (2, 0, 7)]


def test_with_all_equals_a_left_join(spark, rows):
    rng = random.Random(5)
    one = spark.createDataFrame([(i, f"n{i}") for i in range(30)], "id int, name string")
    many = spark.createDataFrame(
        [(7 if rng.random() < 0.4 else rng.randrange(60), j) for j in range(500)], "user int, j int")
    want = one.join(many, one.id == many.user, "left").drop("user")
    assert rows(joins.with_all(one, many, {"id": "user"})) == rows(want)


# ---------------------------------------------------------------- spans


@pytest.fixture
def daily(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), days(rng.randrange(-3, 40)), rng.randrange(100)) for _ in range(400)]
    return spark.createDataFrame(data, "k string, dt date, x int").groupBy("k", "dt").agg(F.sum("x").alias("x"))


def test_rolled_equals_explode_and_brute_force(daily, rows):
    wide = spans.rolled(daily, ["k"], {"x": "x"}, D, (1, 7, 30))
    long = spans.unpivot_spans(wide, ["k"], ["x"], (1, 7, 30)).select("k", "recent_days", "x")
    exploded = (
        daily.where(F.col("dt") <= F.lit(D)).withColumn("recent_days", F.explode(F.array(*map(F.lit, (1, 7, 30)))))
        .where(F.expr(f"dt >= date_add(date'{D}', -recent_days + 1)"))
        .groupBy("k", "recent_days").agg(F.sum("x").alias("x"))
    )
    seen = {(r.k, r.recent_days): r.x for r in exploded.collect()}
    got = {(r.k, r.recent_days): r.x for r in long.collect()}
    assert {key: v for key, v in got.items() if v} == {key: v for key, v in seen.items() if v}
    assert rows(spans.span_totals(daily, ["k"], {"x": "x"}, D, (1, 7, 30))) == rows(exploded.select("k", "recent_days", "x"))


def test_rolled_reads_only_the_longest_span(daily):
    plan = spans.rolled(daily, ["k"], {"x": "x"}, D)._jdf.queryExecution().optimizedPlan().toString()
    assert "2025-06-01" in plan and "2025-06-30" in plan


def test_moving_range_and_rows_differ_on_missing_days(spark, rows):
    df = spark.createDataFrame([("a", days(9), 1), ("a", days(8), 2), ("a", days(0), 4)], "k string, dt date, x int")
    windows = {"day": 1, "week": 7}
    assert rows(spans.moving(df, ["k"], ["x"], windows), "time_type", "end_date", "start_date", "x") == [
        ("day", days(9), days(9), 1), ("day", days(8), days(8), 2), ("day", days(0), days(0), 4),
        ("week", days(9), days(15), 1), ("week", days(8), days(14), 3), ("week", days(0), days(6), 4)]
    by_rows = spans.moving(df, ["k"], ["x"], windows, frame="rows").where("time_type = 'week'")
    assert [r[1] for r in rows(by_rows, "end_date", "x")] == [1, 3, 7]


# ---------------------------------------------------------------- ordering


@pytest.fixture
def skewed(spark):
    """One key holds most of the rows, and many values tie."""
    rng = random.Random(2)
    data = [("hot" if rng.random() < 0.6 else rng.choice(["x", "y", None]), rng.randrange(20), i) for i in range(3000)]
    return spark.createDataFrame(data, "k string, v int, id int").repartition(6)


def test_number_rows_equals_the_window(skewed, rows):
    window = Window.partitionBy("k").orderBy(F.col("v").desc(), "id")
    want = skewed.withColumn("rn", F.row_number().over(window).cast("bigint"))
    got = ordering.number_rows(skewed, [F.col("v").desc(), F.col("id")], ["k"])
    assert rows(got) == rows(want)


def test_global_number_rows(skewed):
    got = ordering.number_rows(skewed, [F.col("v").desc(), F.col("id")], into="rank").collect()
    ordered = sorted(got, key=lambda r: r["rank"])
    assert [r["rank"] for r in ordered] == list(range(1, 3001))
    assert [(-r.v, r.id) for r in ordered] == sorted((-r.v, r.id) for r in got)


def test_a_hot_key_is_spread_over_tasks(skewed):
    laid = skewed.where("k = 'hot'").repartitionByRange(8, F.col("k"), F.col("v").desc(), F.col("id"))
    sizes = [len(p) for p in laid.rdd.glom().collect()]
    assert max(sizes) < 0.3 * sum(sizes)


def test_number_by_each(skewed, rows):
    df = skewed.withColumn("w", F.col("id") % 7)
    def rank(by):
        return F.row_number().over(Window.partitionBy("k").orderBy(F.col(by).desc(), "id")).cast("bigint")
    want = df.withColumn("a", rank("v")).withColumn("b", rank("w"))
    assert rows(ordering.number_by_each(df, ["k"], ["id"], {"a": "v", "b": "w"})) == rows(want)


@pytest.mark.parametrize("k", [1, 3, 50])
def test_topk_with_ties_equals_rank(skewed, rows, k):
    window = Window.partitionBy("k").orderBy(F.col("v").desc())
    want = skewed.withColumn("rk", F.rank().over(window)).where(F.col("rk") <= k)
    assert rows(ordering.topk_with_ties(skewed, ["k"], "v", k)) == rows(want)


def test_topk_prunes_before_the_shuffle(skewed):
    plan = ordering.topk_with_ties(skewed, ["k"], "v", 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_joins_with_an_aggregate_shuffle_afresh(spark):
    """Run-time skew handling needs a shuffle of its own on both sides of the join."""
    fact = spark.range(1000).selectExpr("id % 7 AS k", "id AS x")
    dim = fact.groupBy("k").agg(F.max("x").alias("m"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def shuffles(df):
            return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        assert shuffles(joins.lookup(fact, dim, {"k": "k"}, ["m"])) == 2
        assert shuffles(joins.lookup(fact, dim, {"k": "k"}, ["m"], hot=True)) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_per(spark, rows):
    df = spark.createDataFrame([("s", 2, 1, "b"), ("s", 1, 9, "z"), ("s", 1, 3, "a"), ("t", 5, 5, None)],
                               "s string, ts int, item int, page string")
    assert rows(ordering.first_per(df, ["s"], ["ts", "item"])) == [("s", 1, 3, "a"), ("t", 5, 5, None)]


def test_in_sequence_equals_lead_and_row_number(spark, rows):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.5 else f"s{rng.randrange(9)}", rng.randrange(500), i, f"p{rng.randrange(4)}")
            for i in range(1500)]
    df = spark.createDataFrame(data, "s string, ts int, id int, page string")
    window = Window.partitionBy("s").orderBy("ts", "id")
    want = df.withColumn("rn", F.row_number().over(window).cast("bigint")).withColumn("next", F.lead("page").over(window))
    for tasks in (None, 1, 8):
        assert rows(ordering.in_sequence(df, ["s"], ["ts", "id"], "page", tasks=tasks)) == rows(want)


@pytest.mark.parametrize("data", [
    [], [("a", 1, 1, None)], [(None, 1, i, "p") for i in range(5)] + [("a", 1, 9, None)],
    [(k, 1, i, None if i % 3 else k) for k in "abc" for i in range(4)],
])
def test_in_sequence_with_nulls_and_tasks_that_hold_part_of_a_key(spark, rows, data):
    df = spark.createDataFrame(data, "s string, ts int, id int, page string")
    window = Window.partitionBy("s").orderBy("ts", "id")
    want = df.withColumn("rn", F.row_number().over(window).cast("bigint")).withColumn("next", F.lead("page").over(window))
    for tasks in (1, 3, 12):
        assert rows(ordering.in_sequence(df, ["s"], ["ts", "id"], "page", tasks=tasks)) == rows(want)


def test_a_hot_session_in_one_minute_spreads_over_all_tasks(spark):
    """A third of all events are one session's, within one minute: no task, and no group of a window, holds much more than its share."""
    df = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 997)).alias("s"),
        F.when(F.col("id") % 3 == 0, F.lit(60)).otherwise(F.col("id")).alias("ts"), "id",
        (F.col("id") % 7).cast("string").alias("page"))
    placed = ordering._in_order(df, [F.col(c) for c in ("s", "ts", "id")], 9)
    sizes = [r["count"] for r in placed.groupBy("__task").count().collect()]
    groups = placed.groupBy("__task", "s").count().agg(F.max("count")).first()[0]
    assert len(sizes) == 9 and max(sizes) < 2 * 10_000 and groups < 2 * 10_000
    got = ordering.in_sequence(df, ["s"], ["ts", "id"], "page", tasks=9).where("s = 'hot'")
    seen = got.agg(F.count("*"), F.min("rn"), F.max("rn"), F.countDistinct("rn"), F.count(F.when(F.col("next").isNull(), 1))).first()
    assert tuple(seen) == (30_000, 1, 30_000, 30_000, 1)
    assert got.where(F.col("next") != ((F.col("id") + 3) % 7).cast("string")).count() == 0


# ---------------------------------------------------------------- cohorts


def streak_users(data, run, gap):
    out = set()
    for user in {u for u, _ in data}:
        mine = sorted({d for u, d in data if u == user})
        if any(len([e for e in mine if d <= e <= d + dt.timedelta(days=gap)]) >= run for d in mine):
            out.add(user)
    return sorted(out)


def test_streaks_agree_with_each_other_and_brute_force(spark):
    rng = random.Random(4)
    data = [(u, days(rng.randrange(0, 9))) for u in range(60) for _ in range(rng.randrange(1, 7))]
    df = spark.createDataFrame(data, "user_id int, dt date")
    inside = [(u, d) for u, d in data if d >= days(6)]
    want = streak_users(inside, 3, 2)
    for users in (cohorts.users_by_lead, cohorts.users_by_islands, cohorts.users_by_bitmap):
        assert sorted(r.user_id for r in users(df, D).collect()) == want
    loose = sorted(r.user_id for r in cohorts.users_by_lead(df, D, max_gap=3).collect())
    assert loose == streak_users(inside, 3, 3) and set(want) <= set(loose)


def test_retention_and_new_in_spans(spark, rows):
    df = spark.createDataFrame(
        [(1, days(3), days(0)), (2, days(3), days(2)), (3, days(8), days(0)), (4, days(0), days(0))],
        "user_id int, login_date_first date, login_date_last date")
    got = cohorts.retention(df, D).collect()
    assert [(r.create_date, r.retention_day, r.retention_count, r.new_user_count, float(r.retention_rate)) for r in got] == [
        (days(3), 3, 1, 2, 50.0)]
    assert rows(cohorts.new_in_spans(df, D, (1, 7, 30), "login_date_first", "n")) == [(1, 1), (30, 4), (7, 3)]


@pytest.mark.parametrize("most", [joins.BLOCK_BITS, joins.MOST_BITS])
def test_a_key_filter_keeps_every_match_and_few_others(spark, monkeypatch, most):
    monkeypatch.setattr(joins, "MOST_BITS", most)
    number = spark.range(100_000).select("id", F.concat(F.lit("k"), "id").alias("text"))
    some = number.where("id % 10 = 3")
    keys = session.written(some.unionByName(some).unionByName(spark.createDataFrame([(None, None)], "id bigint, text string")))
    for column in ("id", "text"):
        near = joins.key_filter(keys, column)(number, column)
        assert near.where("id % 10 = 3").count() == 10_000 and near.columns == number.columns
        if most > joins.BLOCK_BITS:
            assert near.count() < 10_000 + 90_000 / 12
    assert joins.key_filter(keys, "id")(number.select(F.col("id").cast("int")), "id").count() == 100_000  # other types hash differently
    assert joins.key_filter(session.written(some.where("id < 0")), "id")(number, "id").count() == 0
