import json
import os
import random
import secrets
import shutil

import pytest
from pyspark.sql import functions as F

from layerhouse.plans import security
from layerhouse.streaming import cdc

ROW = "id bigint, name string, n int"


def change(op, before, after, ts, seq):
    return {"before": before, "after": after, "op": op, "ts_ms": ts, "seq": seq}


def image(i, name, n):
    return {"id": i, "name": name, "n": n}


LOG = [
    change("r", None, image(1, "a", 1), 1, 1),
    change("r", None, image(2, "b", 1), 1, 2),
    change("u", image(1, "a", 1), image(1, "a2", 2), 5, 3),
    change("d", image(2, "b", 1), None, 6, 4),
    change("c", None, image(3, "c", 1), 7, 5),
    change("u", image(3, "c", 1), image(4, "c", 2), 8, 6),  # the key changes
    change("c", None, image(2, "b-again", 9), 9, 7),
    change("u", image(1, "a2", 2), image(1, "a3", 3), 5, 8),  # same millisecond, later sequence
]
FINAL = [(1, "a3", 3), (2, "b-again", 9), (4, "c", 2)]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_replay_in_any_file_order_gives_the_same_table(spark, folder, rows, seed):
    log = LOG[:]
    random.Random(seed).shuffle(log)
    os.makedirs(f"{folder}/log")
    for i, entry in enumerate(log):
        with open(f"{folder}/log/{i:03}.json", "w") as out:
            out.write(json.dumps(entry))
    changes = cdc.read_changes(spark, f"{folder}/log", ROW, files_per_batch=3)
    cdc.run(changes, "id", f"{folder}/state", f"{folder}/progress")
    assert len(os.listdir(f"{folder}/state/changes")) >= 3
    assert rows(cdc.current(spark, f"{folder}/state", ROW)) == FINAL
    cdc.compact(spark, f"{folder}/state")
    assert os.listdir(f"{folder}/state/changes") == []
    assert rows(cdc.current(spark, f"{folder}/state", ROW)) == FINAL
    with open(f"{folder}/log/900.json", "w") as out:
        out.write(json.dumps(change("u", image(4, "c", 2), image(4, "d", 5), 20, 9)))
    cdc.run(changes, "id", f"{folder}/state", f"{folder}/progress")
    assert rows(cdc.current(spark, f"{folder}/state", ROW)) == [*FINAL[:2], (4, "d", 5)]
    cdc.compact(spark, f"{folder}/state")
    cdc.compact(spark, f"{folder}/state")
    assert cdc._bases(spark, f"{folder}/state")[1] == []  # one version of each bucket
    assert rows(cdc.current(spark, f"{folder}/state", ROW)) == [*FINAL[:2], (4, "d", 5)]


def land(folder, name, entries):
    os.makedirs(f"{folder}/log", exist_ok=True)
    with open(f"{folder}/log/{name}.json", "w") as out:
        out.write("\n".join(map(json.dumps, entries)))


def follow(spark, folder):
    cdc.run(cdc.read_changes(spark, f"{folder}/log", ROW), "id", f"{folder}/state", f"{folder}/progress")


def test_a_compaction_after_a_change_of_one_key_reads_and_rewrites_its_bucket_alone(spark, folder, rows):
    state = f"{folder}/state"
    land(folder, "a", [change("c", None, image(i, "x", 0), 1, i) for i in range(400)])
    follow(spark, folder)
    assert len(cdc.compact(spark, state)) == cdc.BUCKETS
    before = {b: os.stat(f).st_ino for b, f in cdc._bases(spark, state)[0].items()}
    land(folder, "b", [change("u", image(7, "x", 0), image(7, "y", 1), 2, 900)])
    follow(spark, folder)
    read = cdc.compact(spark, state)
    assert len(read) == 2 and len({f.rsplit("/", 1)[1] for f in read}) == 1
    held, replaced, version = cdc._bases(spark, state)
    assert version == 2 and replaced == [] and sum(before[b] != os.stat(f).st_ino for b, f in held.items()) == 1
    want = sorted([(i, "x", 0) for i in range(400) if i != 7] + [(7, "y", 1)], key=str)
    assert sorted(rows(cdc.current(spark, state, ROW)), key=str) == want
    assert cdc.compact(spark, state) == []  # nothing to fold


def test_a_compaction_that_was_cut_off_changes_nothing(spark, folder, rows):
    state = f"{folder}/state"
    land(folder, "a", LOG[:5])
    follow(spark, folder)
    cdc.compact(spark, state)
    land(folder, "b", LOG[5:])
    follow(spark, folder)
    shutil.copytree(state, f"{folder}/kept")
    cdc.compact(spark, state)
    # the new version is complete, what it replaces is still there
    shutil.copytree(f"{folder}/kept", state, dirs_exist_ok=True)
    assert rows(cdc.current(spark, state, ROW)) == FINAL
    cdc.compact(spark, state)
    assert rows(cdc.current(spark, state, ROW)) == FINAL and cdc._bases(spark, state)[1] == []
    # the new version is not complete
    shutil.copytree(f"{folder}/kept", f"{folder}/other")
    os.makedirs(f"{folder}/other/base/version=9/bucket=0")
    assert rows(cdc.current(spark, f"{folder}/other", ROW)) == FINAL


def test_another_number_of_buckets_gives_the_same_table(spark, folder, rows):
    state = f"{folder}/state"
    land(folder, "a", LOG[:4])
    cdc.run(cdc.read_changes(spark, f"{folder}/log", ROW), "id", state, f"{folder}/progress", buckets=3)
    cdc.compact(spark, state, buckets=3)
    land(folder, "b", LOG[4:])
    follow(spark, folder)
    assert rows(cdc.current(spark, state, ROW)) == FINAL
    cdc.compact(spark, state)
    assert rows(cdc.current(spark, state, ROW)) == FINAL


@pytest.mark.parametrize("position", range(len(LOG) + 1))
def test_a_snapshot_hands_over_to_the_log_at_its_position(spark, folder, rows, position):
    """The log holds everything from the start, the snapshot what was true after some of it."""
    log = [{**c, "ts_ms": n, "seq": n} for n, c in enumerate(LOG, 1)]
    table = {}
    for entry in log[:position]:
        if entry["before"]:
            table.pop(entry["before"]["id"], None)
        if entry["after"]:
            table[entry["after"]["id"]] = tuple(entry["after"].values())
    snapshot = spark.createDataFrame(list(table.values()), ROW)
    state = f"{folder}/state"
    cdc.start(snapshot, "id", state, position, position)
    assert rows(cdc.current(spark, state, ROW)) == sorted(table.values())
    land(folder, "a", log)
    follow(spark, folder)
    folded = cdc._batches(spark, state)[0]
    assert bool(folded) == (position < len(log))
    assert rows(cdc.current(spark, state, ROW)) == FINAL
    cdc.compact(spark, state)
    assert rows(cdc.current(spark, state, ROW)) == FINAL


def test_a_state_without_batches_is_empty(spark, folder):
    assert cdc.current(spark, f"{folder}/state", ROW).collect() == []
    cdc.compact(spark, f"{folder}/state")
    assert cdc.current(spark, f"{folder}/state", ROW).columns == ["id", "name", "n"]


def test_a_restart_continues_and_a_retried_batch_changes_nothing(spark, folder, rows):
    os.makedirs(f"{folder}/log")

    def land(name, entries):
        with open(f"{folder}/log/{name}.json", "w") as out:
            out.write("\n".join(map(json.dumps, entries)))

    def go(progress):
        cdc.run(cdc.read_changes(spark, f"{folder}/log", ROW), "id", f"{folder}/state", progress)

    land("a", LOG[:4])
    go(f"{folder}/progress")
    assert rows(cdc.current(spark, f"{folder}/state", ROW)) == [(1, "a2", 2)]
    land("b", LOG[4:])
    go(f"{folder}/progress")
    assert rows(cdc.current(spark, f"{folder}/state", ROW)) == FINAL
    go(f"{folder}/progress-lost")  # everything again, as batch 0
    assert rows(cdc.current(spark, f"{folder}/state", ROW)) == FINAL


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([(1, "plain"), (2, "粤BEJ546"), (3, ""), (4, None)], "id int, t string")


def test_round_trip_and_layout(texts, rows):
    key = secrets.token_bytes(32)
    sealed = security.encrypt(texts, "t", key, into="c").cache()
    lengths = {r.id: r.n for r in sealed.select("id", (F.length("c") / 2 - F.octet_length("t")).alias("n")).collect()}
    assert lengths == {1: 28, 2: 28, 3: 28, 4: None}  # 12 bytes of IV and 16 of tag
    assert rows(security.decrypt(sealed, "c", key), "id", "c") == rows(texts)


def test_the_key_is_not_in_printed_plans(texts, capsys):
    key = secrets.token_bytes(32)
    security.decrypt(security.encrypt(texts, "t", key), "t", key).explain(True)
    printed = capsys.readouterr().out.lower()
    assert "redacted" in printed and key.hex() not in printed


def test_a_pattern_of_the_session_does_not_show_the_key(spark, texts, capsys):
    before = spark.conf.get(security.REDACTION, None)
    spark.conf.set(security.REDACTION, "(?i)password")
    try:
        key = secrets.token_bytes(32)
        security.encrypt(texts.withColumn("p", F.lit("PASSWORD")), "t", key).explain(True)
        printed = capsys.readouterr().out.lower()
        assert key.hex() not in printed and "password" not in printed
    finally:
        spark.conf.set(security.REDACTION, before) if before else spark.conf.unset(security.REDACTION)


def test_iv_is_random(texts):
    key = secrets.token_bytes(32)
    twice = [security.encrypt(texts, "t", key).where("id = 1").first().t for _ in range(2)]
    assert twice[0] != twice[1]


def test_tampered_and_foreign_payloads_are_rejected(spark, texts, rows):
    key = secrets.token_bytes(32)
    sealed = security.encrypt(texts, "t", key)
    damaged = spark.createDataFrame([
        (r.id, None if r.t is None else r.t[:-2] + ("00" if r.t[-2:] != "00" else "11") if r.id == 1 else r.t)
        for r in sealed.collect()] + [(9, "not hex"), (10, "AB")], "id int, t string")
    good, bad = security.split_rejects(damaged, "t", key)
    assert rows(good) == [(2, "粤BEJ546"), (3, ""), (4, None)]
    assert rows(bad, "id") == [(1,), (10,), (9,)]
    assert security.split_rejects(sealed, "t", secrets.token_bytes(32))[0].count() == 1  # only the null


def test_keys_come_from_the_session(spark):
    spark.conf.unset(security.KEY_SETTING)
    with pytest.raises(LookupError):
        security.column_key(spark)
    with pytest.raises(ValueError):
        security.encrypt(spark.sql("SELECT 'x' AS t"), "t", b"short")
    spark.conf.set(security.KEY_SETTING, "ab" * 32)
    assert security.column_key(spark) == b"\xab" * 32


def test_telemetry_flattens_nested_reports(spark):
    report = {"UPEXGMSGREALLOCATION": {
        "dateTime": "20250730121804", "altitude": 48, "lon": 114.179001, "lat": 22.708228, "direction": 343,
        "alarm": {"overSpeed": 1, "oilError": 0, "stolen": 1}, "state": {"acc": 1, "door": 0}}, "VEHICLENO": "粤BEJ546"}
    df = spark.createDataFrame([(1, json.dumps(report)), (2, "broken")], "id int, payload string")
    got = {r.id: r for r in security.telemetry(df).collect()}
    assert got[1].vehicle_no == "粤BEJ546" and got[1].alarms == ["overSpeed", "stolen"] and got[1].acc == 1
    assert str(got[1].lon) == "114.179001" and got[1].report_time.isoformat() == "2025-07-30T12:18:04"
    assert got[1].alarm_overSpeed == 1 and got[1].alarm_oilError == 0
    assert got[2].vehicle_no is None and got[2].alarms == []
    assert len([c for c in security.telemetry(df).columns if c.startswith("alarm_")]) == 29
