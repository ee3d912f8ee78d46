"""Every registered query against its SQL on the smallest tables."""

import datetime as dt
import os

import pytest

import __spark_entry__ as entry
from layerhouse.catalog import QUERIES, Layers
from layerhouse import storage  # noqa: F401  registers its queries
from layerhouse.jobs import Stored, load
from layerhouse.plans import shop_ads
from layerhouse.sources import tables

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    return "" if value is None else str(value)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())


def test_results_load_into_tables_and_stored_layers_feed_reports(spark, rows):
    """Raw tables -> stored detail -> stored summary -> report, each step reading only tables."""
    day = dt.date(1996, 6, 30)
    tables.create_database(spark, "t_jobs")
    try:
        raw = Layers(spark, FOLDER)
        first = load("e24_dws_user_order_1d", raw, "t_jobs.user_order_1d", fmt="orc")
        assert first == load("e24_dws_user_order_1d", raw, "t_jobs.user_order_1d", fmt="orc")
        assert spark.table("t_jobs.user_order_1d").count() == first
        stored = Stored(spark, {"order_1d": "t_jobs.user_order_1d"}, "19960630", history=("order_1d",))
        for name in ("e25_dws_user_order_td", "e33_ads_new_order_user"):
            direct = Layers(spark, FOLDER, order_day=day, last_day=day)
            assert rows(QUERIES[name].frame(stored)) == rows(QUERIES[name].frame(direct))
    finally:
        spark.sql("DROP DATABASE t_jobs CASCADE")


def scans(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in line]


@pytest.mark.parametrize(("name", "table", "column"), [
    ("e43_ads_traffic_by_channel", "events", "ts"),
    ("e36_ads_order_by_category", "orders", "o_orderdate"),
])
def test_the_day_range_reaches_the_scan(spark, name, table, column):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        found = [s for s in scans(entry.queries()[name](spark, FOLDER)) if f"{table}.parquet" in s and f"GreaterThanOrEqual({column}," in s]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert found


def test_the_day_range_of_page_paths_reaches_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        raw = Layers(spark, FOLDER)
        found = scans(shop_ads.visits_on(raw.page_view_in(1), raw.event_day))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert any("events.parquet" in s and "GreaterThanOrEqual(ts," in s for s in found)


def test_milestones_read_the_cargo_lines_once(spark):
    plan = scans(QUERIES["l11_dwd_pay_suc"].run(spark, FOLDER))
    assert sum("lineitem.parquet" in s for s in plan) == 1 and sum("orders.parquet" in s for s in plan) <= 2


@pytest.mark.parametrize(("name", "most"), [("l43_ads_org_stats", 12), ("l50_ads_express_city_stats", 18)])
def test_places_cost_few_exchanges(spark, name, most):
    """There were 30 and 29 when each fact walked up the regions by itself, and trips met dimensions no place needs."""
    plan = QUERIES[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= most


def test_another_zone_is_refused(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            Layers(spark, FOLDER)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_snapshot_of_the_next_day_leaves_the_first(spark):
    tables.create_database(spark, "t_days")
    try:
        for day in (dt.date(1996, 6, 29), dt.date(1996, 6, 30)):
            load("l24_dws_org_cargo_order_nd", Layers(spark, FOLDER, order_day=day), "t_days.nd")
        assert {str(r.dt) for r in spark.table("t_days.nd").select("dt").distinct().collect()} == {"1996-06-29", "1996-06-30"}
        # a day without rows is emptied on request
        empty = spark.table("t_days.nd").limit(0)
        tables.replace_days(empty, "t_days.nd", ["1996-06-29"])
        assert {str(r.dt) for r in spark.table("t_days.nd").select("dt").distinct().collect()} == {"1996-06-30"}
    finally:
        spark.sql("DROP DATABASE t_days CASCADE")
