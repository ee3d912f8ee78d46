"""Loads by key: rows that move between days, pruned scans, interrupted loads, intervals."""

import datetime as dt
from uuid import uuid4

import pytest
from pyspark.sql import functions as F, types as T

from layerhouse import jobs
from layerhouse.catalog import Layers
from layerhouse.functions.times import OPEN_END
from layerhouse.plans.shop_dim import close_out
from layerhouse.sources import tables
from layerhouse.sources.keyed import Keyed

D = [dt.date(2025, 6, n) for n in range(1, 31)]
ROW = "id bigint, v string, dt date"


@pytest.fixture
def make(spark):
    made = []

    def new(rows, schema=ROW, keys=("id",)):
        table = Keyed(spark, f"keyed_{uuid4().hex}", keys)
        tables.create_table(spark, table.table, T.StructType.fromDDL(schema))
        made.append(table)
        if rows:
            table.merge(spark.createDataFrame(rows, schema))
        return table

    yield new
    for table in made:
        table.drop()


def stored(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def test_a_corrected_row_leaves_its_old_day(spark, make):
    table = make([(1, "a", D[5]), (2, "b", D[5]), (3, "c", D[6]), (None, "n", D[6])])
    for _ in range(2):  # a repeated load changes nothing
        assert table.merge(spark.createDataFrame([(1, "a2", D[6]), (3, "c2", D[9]), (None, "n2", D[7])], ROW)) >= 3
        assert stored(table) == sorted([(1, "a2", D[6]), (2, "b", D[5]), (3, "c2", D[9]), (None, "n2", D[7])], key=str)
        assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {table.table}").collect()} == {f"dt={D[n]}" for n in (5, 6, 7, 9)}


def test_only_the_days_concerned_are_read(spark, make):
    table = make([(n, "x", D[n]) for n in range(30)])
    fresh = spark.createDataFrame([(3, "y", D[20]), (40, "new", D[21])], ROW)
    days = table.days_of(fresh)
    assert days == [D[3], D[20], D[21]]
    side = table.on(days)
    assert {f.split("dt=")[1][:10] for f in side.inputFiles()} == {str(d) for d in days}
    scan = next(x for x in side._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x)
    assert str((D[3] - dt.date(1970, 1, 1)).days) in scan.split("PartitionFilters")[1] or str(D[3]) in scan.split("PartitionFilters")[1]


def test_the_index_is_not_shuffled(spark, make):
    table = make([(n, "x", D[n % 30]) for n in range(300)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        entries, met = spark.table(table.index), table._entry(spark.createDataFrame([(3, "y", D[2])], ROW))
        plan = entries.join(met, table._same(entries, met), "left_semi")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the load's own keys


def test_an_interrupted_load_is_old_or_new(spark, make, monkeypatch):
    table = make([(1, "a", D[5]), (2, "b", D[5])])
    before = stored(table)
    move = spark.createDataFrame([(1, "a2", D[8]), (2, "b2", D[9])], ROW)

    def cut(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # before the manifest: nothing has happened
        m.setattr(Keyed, "_publish", cut)
        with pytest.raises(RuntimeError):
            table.merge(move)
    assert stored(table) == before
    with monkeypatch.context() as m:  # after it, between the new days and the emptied one
        m.setattr(Keyed, "_append", cut)
        with pytest.raises(RuntimeError):
            table.merge(move)
    assert stored(table) == [(1, "a2", D[8]), (2, "b2", D[9])]
    assert table.merge(spark.createDataFrame([(1, "a3", D[5])], ROW)) == 1
    assert stored(table) == [(1, "a3", D[5]), (2, "b2", D[9])]


def test_a_load_whose_staged_rows_do_not_count_is_not_published(spark, make, monkeypatch):
    table = make([(1, "a", D[5])])

    class Wrong:
        get = {"rows": 7}

    with monkeypatch.context() as m:
        m.setattr("layerhouse.sources.keyed.Observation", lambda: Wrong)
        m.setattr("pyspark.sql.DataFrame.observe", lambda self, *_: self, raising=False)
        m.setattr("pyspark.sql.classic.dataframe.DataFrame.observe", lambda self, *_: self, raising=False)
        with pytest.raises(OSError, match="nothing is published"):
            table.merge(spark.createDataFrame([(1, "b", D[6])], ROW))
    assert stored(table) == [(1, "a", D[5])]


def test_an_empty_source_writes_nothing(spark, make):
    table = make([(1, "a", D[5])])
    assert table.merge(spark.createDataFrame([], ROW)) == 0
    assert stored(table) == [(1, "a", D[5])] and table._loads() == [1]


def test_a_table_from_before_the_index_and_a_compacted_one(spark, make):
    table = make([])
    tables.overwrite_partitions(spark.createDataFrame([(1, "a", D[1]), (2, "b", D[2])], ROW), table.table)
    table.merge(spark.createDataFrame([(1, "a2", D[3])], ROW))
    table.compact()
    assert len(table._loads()) == 1 and table.latest().count() == 2
    table.merge(spark.createDataFrame([(1, "a3", D[2]), (2, "b3", D[1])], ROW))
    assert stored(table) == [(1, "a3", D[2]), (2, "b3", D[1])]


def test_intervals_neither_overlap_nor_leave_gaps(spark, make):
    schema = "id bigint, v string, start_date date, end_date date, dt date"
    table = make([], schema, ["id", "start_date"])

    def snapshot(*rows):
        return spark.createDataFrame([(i, v, OPEN_END, OPEN_END) for i, v in rows], "id bigint, v string, start_date date, end_date date")

    turns = [[(1, "a"), (2, "x")], [(1, "b"), (2, "x")], [(1, "c"), (2, "x"), (3, None)], [(1, "c"), (2, "y"), (3, None)]]
    for day, rows in zip(D, turns, strict=False):
        for _ in range(2):
            table.fold(snapshot(*rows), day, close_out)
    found = sorted(tuple(r) for r in table.read().select("id", "start_date", "end_date").collect())
    assert found == [(1, D[0], D[0]), (1, D[1], D[1]), (1, D[2], OPEN_END), (2, D[0], D[2]), (2, D[3], OPEN_END), (3, D[2], OPEN_END)]
    assert table.read().where("dt <> end_date").count() == 0


def test_loads_empty_their_run_day_and_carry_a_stamp(spark):
    folder, day = "/root/testdata/sf0.001", dt.date(1996, 6, 30)
    raw, report = Layers(spark, folder), f"run_{uuid4().hex}"
    source = f"src_{uuid4().hex}"
    try:
        jobs.load("l25_dws_org_receive_1d", raw, source)
        names = dict(history=("receive_1d",))
        assert jobs.load("l25_dws_org_receive_1d", jobs.Stored(spark, {"receive_1d": source}, day, **names), report, stamp="etl_time") > 0
        assert spark.table(report).where(F.col("etl_time").isNull()).count() == 0
        present = {r[0] for r in spark.table(report).select("dt").distinct().collect()}
        gone = next(iter(sorted(present)))
        spark.sql(f"ALTER TABLE {source} DROP PARTITION (dt = '{gone}')")
        jobs.load("l25_dws_org_receive_1d", jobs.Stored(spark, {"receive_1d": source}, gone, **names), report)
        assert gone not in {r[0] for r in spark.table(report).select("dt").distinct().collect()}
    finally:
        for name in (source, report):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _files(table):
    return {f.split("/dt=")[1] for f in table.read().inputFiles()}


def test_only_files_that_hold_keys_of_a_load_are_replaced(spark, make):
    table = make([(1, "a", D[5]), (3, "c", D[6])])
    table.merge(spark.createDataFrame([(2, "b", D[5])], ROW))  # no key comes again: the file of the day stays
    first = _files(table)
    assert len(first) == 3
    table.merge(spark.createDataFrame([(2, "b2", D[5])], ROW))  # its own file goes whole, that of key 1 stays
    assert len(_files(table) & first) == 2
    assert stored(table) == sorted([(1, "a", D[5]), (2, "b2", D[5]), (3, "c", D[6])], key=str)


@pytest.mark.parametrize("rows_at_once", [1, 10_000])
def test_rows_stay_in_files_that_lose_others(spark, make, monkeypatch, rows_at_once):
    monkeypatch.setattr("layerhouse.sources.keyed.PASS_ROWS", rows_at_once)
    table = make([])
    old = spark.range(2_000).select(F.when(F.col("id") > 4, F.col("id")).alias("id"), F.lit("x").alias("v"), F.when(F.col("id") % 3 > 0, F.date_add(F.lit(D[0]), (F.col("id") % 3).cast("int"))).alias("dt"))
    table.merge(old)
    for _ in range(2):
        table.merge(old.where("id % 5 = 0 OR id IS NULL AND dt IS NULL").withColumn("v", F.lit("y")))
        held = table.read()
        assert held.count() == 1_995 + 2 and held.where("id IS NULL").count() == 2  # null keys are one key
        assert held.where("id % 5 = 0 AND v = 'x' OR id % 5 <> 0 AND v = 'y'").count() == 0
        assert held.exceptAll(old.withColumn("v", F.when(F.expr("id % 5 = 0 OR id IS NULL"), "y").otherwise("x"))).count() == 0


def test_a_key_under_two_days_leaves_both(spark, make):
    table = make([(1, "a", D[3]), (1, "b", D[7]), (2, "c", D[3])])
    table.compact()
    table.merge(spark.createDataFrame([(1, "d", D[9])], ROW))
    assert stored(table) == [(1, "d", D[9]), (2, "c", D[3])]


def test_the_days_of_a_key_are_ranked_not_gathered(spark, make):
    table = make([(1, "a", D[3]), (2, "b", D[4]), (3, "x", D[5]), (None, "n", D[4])])
    for rows in ([(1, "c", D[7]), (1, "d", D[8]), (1, "e", D[8]), (None, "m", None)], [(3, "y", D[6]), (4, "z", D[6])]):
        table.merge(spark.createDataFrame(rows, ROW))
    latest = table.latest()
    found = sorted(((r["id"], r["day"]) for r in latest.collect()), key=str)  # a day that comes twice is one entry
    assert found == sorted([(1, D[7]), (1, D[8]), (2, D[4]), (3, D[6]), (4, D[6]), (None, None)], key=str)
    assert table._known(spark.createDataFrame([(1, "f", D[1]), (None, "o", D[1])], ROW)) == [D[7], D[8], None]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and plan.count("Exchange") == 0


def test_a_load_of_one_day_is_not_shuffled(spark, make):
    table = make([])
    before = table.merge(spark.range(0, 4_000, 1, 4).select("id", F.lit("x").alias("v"), F.lit(D[1]).alias("dt")), durable=True)
    assert before == 4_000 and len(_files(table)) == 4  # one file of each task


@pytest.mark.parametrize("spread", [False, True])
def test_rows_of_a_known_spread_are_written_once(spark, make, monkeypatch, spread):
    table, rows = make([]), [(n, "x", D[n % 3]) for n in range(60)] + [(None, "n", None)]
    with monkeypatch.context() as m:  # no copy of the rows is written beside the staged ones
        m.setattr("layerhouse.sources.keyed.written", None)
        assert table.merge(spark.createDataFrame([], ROW), spread=spread) == 0
        assert table._loads() == [] and not table._listed(table._path())
        assert table.merge(spark.createDataFrame(rows, ROW).repartition(4), spread=spread) == 61
    files = _files(table)
    assert len(files) == 4 if spread else len(files) > 4
    table.merge(spark.createDataFrame([(1, "y", D[9]), (None, "m", D[1])], ROW), spread=spread)
    assert stored(table) == sorted([r for r in rows if r[0] not in (1, None)] + [(1, "y", D[9]), (None, "m", D[1])], key=str)


def test_staged_rows_are_listed_once_and_new_days_move_whole(spark, make, monkeypatch):
    table, listed, read, append = make([(1, "a", D[5])]), [], Keyed._read, Keyed._append
    monkeypatch.setattr(Keyed, "_read", lambda self, paths, base="": listed.append(paths) or read(self, paths, base))
    table.merge(spark.createDataFrame([(2, "b", D[5]), (3, "c", D[6]), (None, "n", None)], ROW))
    assert len(listed) == 1
    rows = [(1, "a", D[5]), (2, "b", D[5]), (3, "c", D[6]), (None, "n", None)]
    assert stored(table) == sorted(rows, key=str)

    def late(self, entries, load):  # interrupted after one of the new days came
        append(self, entries, load)
        files, path = self._files(self._path()), self._at
        files.rename(path(f"_loads/{load}/rows/dt={D[8]}"), path(f"dt={D[8]}"))
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(Keyed, "_append", late)
        with pytest.raises(RuntimeError):
            table.merge(spark.createDataFrame([(3, "d", D[8]), (4, "e", D[9]), (5, "f", D[5])], ROW))
    rows = [r for r in rows if r[0] != 3] + [(3, "d", D[8]), (4, "e", D[9]), (5, "f", D[5])]
    assert stored(table) == sorted(rows, key=str)
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {table.table}").collect()} == {*(f"dt={D[n]}" for n in (5, 8, 9)), "dt=__HIVE_DEFAULT_PARTITION__"}
