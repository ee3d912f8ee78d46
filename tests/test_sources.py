import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from layerhouse import session
from layerhouse.sources import files, tables

D1, D2 = dt.date(2025, 6, 29), dt.date(2025, 6, 30)
REPORT = "dt date, recent_days int, n bigint"


@pytest.fixture
def db(spark):
    name = "t_sources"
    tables.create_database(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def frame(spark, data, schema=REPORT):
    return spark.createDataFrame(data, schema)


def test_create_table_with_comments_and_properties(spark, db):
    tables.create_table(
        spark, f"{db}.r", T.StructType.fromDDL(REPORT), comment="it's a report", fmt="orc",
        comments={"n": "how many"}, properties={"team": "bi"})
    described = {r.col_name: r for r in spark.sql(f"DESCRIBE EXTENDED {db}.r").collect()}
    assert described["n"].comment == "how many" and described["Comment"].data_type == "it's a report"
    assert described["Provider"].data_type == "orc" and "team=bi" in described["Table Properties"].data_type
    assert spark.table(f"{db}.r").columns[-1] == "dt"


def test_append_matches_by_name(spark, db, rows):
    tables.create_table(spark, f"{db}.r", T.StructType.fromDDL(REPORT))
    shuffled = frame(spark, [(5, D1, 7)], "n int, dt date, recent_days int")
    assert tables.append(shuffled, f"{db}.r") == 1
    assert rows(spark.table(f"{db}.r"), "dt", "recent_days", "n") == [(D1, 7, 5)]


def test_overwrite_replaces_only_the_partitions_it_has(spark, db, rows):
    table = f"{db}.r"
    tables.create_table(spark, table, T.StructType.fromDDL(REPORT))
    assert tables.overwrite_partitions(frame(spark, [(D1, 1, 1), (D2, 1, 2)]), table) == 2
    for _ in range(2):  # a re-run changes nothing
        tables.overwrite_partitions(frame(spark, [(D2, 1, 9)]), table)
    assert rows(spark.table(table), "dt", "n") == [(D1, 1), (D2, 9)]


def test_merge_history_is_idempotent_and_replaces_same_keys(spark, db, rows):
    table = f"{db}.r"
    tables.create_table(spark, table, T.StructType.fromDDL(REPORT))
    tables.overwrite_partitions(frame(spark, [(D1, 1, 1), (D2, 1, 2), (D2, 7, 3)]), table)
    for _ in range(2):
        tables.merge_history(frame(spark, [(D2, 7, 30), (D2, 30, 4)]), table, ["dt", "recent_days"])
    assert rows(spark.table(table), "dt", "recent_days", "n") == [(D1, 1, 1), (D2, 1, 2), (D2, 30, 4), (D2, 7, 30)]


def test_reading_partitions(spark, db, rows):
    table = f"{db}.p"
    data = frame(spark, [(1, "0", "20250630"), (2, "1", "20250630"), (3, "0", "20250629")], "id int, is_deleted string, dt string")
    tables.save_table(data, table, partition="dt")
    assert rows(tables.read_partition(spark, table, "20250630"), "id") == [(1,), (2,)]
    assert rows(tables.read_partition(spark, table, D2), "id") == [(1,), (2,)]
    assert rows(tables.read_partition(spark, table, "20250630", live_only=True), "id") == [(1,)]
    plan = tables.read_partition(spark, table, "20250630")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [dt" in plan and "20250630" in plan.split("PartitionFilters")[1]


def test_read_or_empty_and_required_tables(spark, db):
    schema = T.StructType.fromDDL("id int, name string")
    assert tables.read_or_empty(spark, f"{db}.none", schema).schema == schema
    tables.save_table(frame(spark, [("x", 1)], "name string, id bigint"), f"{db}.some")
    assert tables.read_or_empty(spark, f"{db}.some", schema).schema == schema
    with pytest.raises(LookupError, match="none"):
        tables.require_tables(spark, [f"{db}.some", f"{db}.none"])


def test_align_fills_by_type(spark):
    schema = T.StructType.fromDDL("a int, b string, c date, d decimal(10,2)")
    row = tables.align_to(frame(spark, [(None, "3.456")], "a int, d string"), schema, fill=True).first()
    assert tuple(row) == (0, "", dt.date(1970, 1, 1), Decimal("3.46"))


def test_schema_evolution(spark, db):
    tables.save_table(frame(spark, [(1,)], "id int"), f"{db}.e")
    tables.evolve_table(spark, f"{db}.e", {"id": "int", "ds": "string"})
    tables.evolve_table(spark, f"{db}.e", {"ds": "string"})
    assert spark.table(f"{db}.e").columns == ["id", "ds"]
    assert tables.add_columns(frame(spark, [(1,)], "id int"), {"ds": "string"}).first().ds is None


def test_path_sinks(spark, folder, rows):
    df = frame(spark, [(D1, 1, 1), (D2, 1, 2)])
    assert tables.overwrite_path(df, f"{folder}/o", fmt="orc", compression="snappy") == 2
    tables.overwrite_path(frame(spark, [(D2, 1, 5)]), f"{folder}/o", fmt="orc")
    assert rows(spark.read.orc(f"{folder}/o"), "n") == [(1,), (5,)]
    assert tables.write_text_table(df, f"{folder}/t") == 2
    assert spark.read.text(f"{folder}/t").first().value.count("\t") == 2


def test_json_with_schema_and_clean_up(spark, folder):
    lines = [
        {"verify_id": "v1", "send_id": "s1", "order_id": "o1", "pay_amount": "124.115", "verify_time": "2025-07-30T10:00:01", "buy_count": 2},
        {"verify_id": "v2", "send_id": "s2", "order_id": "o2", "pay_amount": "much", "verify_time": "later", "buy_count": 1},
        {"verify_id": None, "send_id": "s3", "order_id": "o3", "pay_amount": "1", "verify_time": None, "buy_count": 1},
    ]
    with open(f"{folder}/v.json", "w") as out:
        out.write("\n".join(map(json.dumps, lines)))
    got = {r.verify_id: r for r in files.load_landing(spark, f"{folder}/v.json", "discount_verify").collect()}
    assert set(got) == {"v1", "v2"}
    assert got["v1"].pay_amount == Decimal("124.12") and got["v1"].verify_time == dt.datetime(2025, 7, 30, 10, 0, 1)
    assert got["v2"].pay_amount is None and got["v2"].verify_time is None


def test_product_orders_keep_unpaid_rows(spark, folder):
    with open(f"{folder}/o.json", "w") as out:
        out.write(json.dumps({"order_id": "1", "order_date": "2025-06-30", "pay_time": None, "pay_amount": None,
                              "buy_amount": "3.50", "create_time": "2025-06-30 01:02:03"}))
    row = files.dated(files.load_landing(spark, f"{folder}/o.json", "product_order"), "create_time").first()
    assert row.pay_amount is None and row.buy_amount == Decimal("3.50") and row.dt == D2


def test_headerless_csv(spark, folder):
    with open(f"{folder}/b.csv", "w") as out:
        out.write("p1,cat_name,10,5,0.5,1,2,0.9,12.50,3,8,2025-06-30,2025-06-30 01:00:00\n")
    row = files.read_csv(spark, f"{folder}/b.csv", files.PRODUCT_BEHAVIOUR).first()
    assert row.product_id == "p1" and row.sales_amount == Decimal("12.50") and row.stat_date == D2


def test_literal_rows(spark, rows):
    assert rows(tables.literal_rows(spark, [(1, "a")], "id int, s string")) == [(1, "a")]


def test_shared_dir_is_the_one_the_session_names(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == configured
    df = session.durable(spark.range(100).withColumn("x", F.rand()))
    assert df.agg(F.sum("x")).first() == df.agg(F.sum("x")).first()
