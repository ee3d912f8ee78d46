import datetime as dt
import hashlib

from pyspark.sql import functions as F

from layerhouse.functions import masking, parsing, ratios, times


def one(spark, value, kind, expression):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x")).alias("y")).first().y


def test_phone_and_mail_masks(spark):
    assert one(spark, "13812345678", "string", masking.mask_phone) == "138*"
    assert one(spark, "12012345678", "string", masking.mask_phone) is None
    assert one(spark, "a-b@mail.example.com", "string", masking.mask_email) == "*@mail.example.com"
    assert one(spark, "no-at-sign", "string", masking.mask_email) is None
    assert one(spark, "a@nodot", "string", masking.mask_email) is None
    assert one(spark, "Wang", "string", masking.mask_name) == "W*"
    assert one(spark, None, "string", masking.mask_name) is None


def test_hash_only_valid_values(spark):
    want = hashlib.md5(b"13812345678").hexdigest()
    assert one(spark, "13812345678", "string", masking.hashed_phone) == want
    assert one(spark, "138123", "string", masking.hashed_phone) is None
    assert one(spark, "broken@", "string", masking.hashed_email) is None


def test_business_dates():
    day = dt.date(2025, 6, 30)
    assert times.business_date("2025-06-30") == times.business_date("20250630") == times.business_date(day) == day


def test_parse_date_reads_both_formats(spark):
    day = dt.date(2025, 6, 30)
    assert one(spark, "20250630", "string", times.parse_date) == day
    assert one(spark, "2025-06-30", "string", times.parse_date) == day
    assert one(spark, "June", "string", times.parse_date) is None


def test_epoch_is_milliseconds(spark):
    stamp = one(spark, "0", "string", lambda c: times.as_text(times.from_epoch_ms(c, "GMT+8")))
    assert stamp == "1970-01-01 08:00:00"
    assert one(spark, "soon", "string", times.from_epoch_ms) is None


def test_iso_text_keeps_the_wall_clock(spark):
    text = one(spark, "2025-07-11T09:08:07Z", "string", lambda c: times.as_text(times.from_iso(c)))
    assert text == "2025-07-11 09:08:07"
    assert one(spark, "x", "string", times.from_iso) is None


def test_within_has_both_bounds(spark):
    df = spark.sql("SELECT explode(sequence(date'2025-06-20', date'2025-07-02')) AS d")
    kept = [r.d.day for r in df.where(times.within(F.col("d"), dt.date(2025, 6, 30), 7)).collect()]
    assert kept == list(range(24, 31))


def test_ratio_guards(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 2)], "a int, b int")
    got = [r[0] for r in df.select(ratios.safe_ratio(F.col("a"), F.col("b"), 4)).collect()]
    assert got == [0.3333, 0.0, None]
    assert [r[0] for r in df.select(ratios.mean_of(F.col("a"), F.col("b"))).collect()][1] is None


def test_rounding_is_exact_on_ties(spark):
    df = spark.sql("SELECT cast(8716.47 AS decimal(16,2)) AS a, 14 AS b UNION ALL SELECT 29, 200")
    assert [r[0] for r in df.select(ratios.safe_ratio(F.col("a"), F.col("b"), 2)).collect()] == [622.61, 0.15]


def test_clamp_count(spark):
    df = spark.createDataFrame([("7",), ("-1",), ("x",), (None,), ("9223372036854775808",)], "a string")
    assert [r[0] for r in df.select(ratios.clamp_count(F.col("a"))).collect()] == [7, 0, 0, 0, 0]


def test_a_parse_is_not_repeated(spark):
    df = spark.createDataFrame([('{"a":1,"b":2}',), ("broken",)], "j string")
    parsed = parsing.parse_json(df, "j", "a int, b int").where(F.col("a") == 1)
    assert [tuple(r) for r in parsed.collect()] == [(1, 2)]
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
