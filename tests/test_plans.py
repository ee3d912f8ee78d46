"""Edge rows: nulls, ties, zero denominators, repeated keys, open intervals."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerhouse import session
from layerhouse.functions.times import OPEN_END
from layerhouse.plans import (
    diagnosis, discount, goods, macro, shop_ads, shop_dim, shop_dwd, shop_dws, tms_ads, tms_dwd, tms_dws,
)

D = dt.date(2025, 6, 30)


def days(n):
    return D - dt.timedelta(days=n)


def at(hour, day=D):
    return dt.datetime(day.year, day.month, day.day, hour)


def test_interval_dimension_closes_changed_rows(spark, rows):
    schema = "id int, name string, start_date date, end_date date"
    current = spark.createDataFrame([
        (1, "a", days(9), OPEN_END), (2, "b", days(9), OPEN_END), (3, None, days(9), OPEN_END),
        (1, "old", days(20), days(10)), (5, "gone", days(9), OPEN_END)], schema)
    snapshot = spark.createDataFrame([(1, "a"), (2, "b2"), (3, None), (4, "new")], "id int, name string")
    after = shop_dim.close_out(current, snapshot, D)
    assert rows(after) == sorted([
        (1, "a", days(9), OPEN_END), (1, "old", days(20), days(10)),
        (2, "b", days(9), days(1)), (2, "b2", D, OPEN_END), (3, None, days(9), OPEN_END),
        (4, "new", D, OPEN_END), (5, "gone", days(9), OPEN_END)], key=lambda r: [(v is None, str(v)) for v in r])
    assert rows(shop_dim.close_out(after, snapshot, D)) == rows(after)  # a re-run changes nothing


def test_calendar(spark):
    table = shop_dim.calendar(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 2)).collect()
    assert [(r.date_id.day, r.week_day, r.is_workday) for r in table] == [(28, 3, 1), (29, 4, 1), (1, 5, 1), (2, 6, 0)]


def test_unpaid_orders_stay_open(spark):
    orders = spark.createDataFrame(
        [(1, 7, 3, at(1), Decimal(10)), (2, 7, 3, at(1), Decimal(20))], "id int, user_id int, province_id int, create_time timestamp, total_amount decimal(16,2)"
    ).withColumns({c: F.lit(0) for c in ("original_total_amount", "activity_reduce_amount", "coupon_reduce_amount")})
    payment = spark.createDataFrame([(1, at(3), Decimal(10))], "order_id int, callback_time timestamp, total_amount decimal(16,2)")
    log = spark.createDataFrame([(1, "1004", at(9)), (2, "1002", at(9))], "order_id int, order_status string, operate_time timestamp")
    flow = {r.order_id: r for r in shop_dwd.trade_flow(orders, payment, log).collect()}
    assert flow[1].dt == D and flow[1].payment_amount == 10
    assert flow[2].dt == OPEN_END and flow[2].payment_time is None and flow[2].payment_amount == 0
    gap = shop_ads.order_to_pay_interval(shop_dwd.trade_flow(orders, payment, log), D).first()
    assert gap.order_to_pay_interval_avg == 7200  # paid orders only


def test_log_without_page_or_user(spark):
    log = spark.createDataFrame([(line,) for line in (
        '{"common":{"sid":"s","uid":"1"},"page":{"page_id":"home","item":"2"},"ts":1751241600000}',
        '{"common":{"sid":"s","uid":"1"},"page":{"page_id":"cart","item":"1"},"ts":1751241600000}',
        '{"common":{"sid":"t"},"page":{"page_id":"home","item":"3"},"ts":0}',
        '{"common":{"sid":"u","uid":"2"},"ts":5}', "broken")], "log string")
    assert shop_dwd.page_view(log).count() == 3
    login = shop_dwd.user_login(log).collect()
    assert [(r.user_id, str(r.login_time)) for r in login] == [("1", "2025-06-30 08:00:00")]


def test_page_path_steps(spark, rows):
    seen = [("s", 1, "home"), ("s", 2, "item"), ("s", 3, "cart"), ("t", 1, "home")]
    views = spark.createDataFrame(
        [(s, D, at(0) + dt.timedelta(minutes=m), str(m), p) for s, m, p in seen],
        "session_id string, dt date, view_time timestamp, page_item string, page_id string")
    assert rows(shop_ads.page_path(views, D), "source", "target", "path_count") == [
        ("step-1:home", "null", 1), ("step-1:home", "step-2:item", 1),
        ("step-2:item", "step-3:cart", 1), ("step-3:cart", "null", 1)]


def test_login_to_date_counts_registering(spark, rows):
    users = spark.createDataFrame([(1, at(1, days(9))), (2, at(1, days(3))), (3, at(1, days(-1)))], "id bigint, create_time timestamp")
    logins = spark.createDataFrame([("1", days(8)), ("1", days(0)), ("1", days(-1))], "user_id string, dt date")
    today = shop_dws.user_login_td(users, logins, D)
    assert rows(today) == [(1, D, days(9), 2), (2, days(3), days(3), 1)]
    change = shop_ads.user_change(users, logins, D).first()
    assert (change.user_churn_count, change.user_back_count) == (0, 1)


WAYBILL = dict(
    order_no="N", collect_type="72001", user_id=1, receiver_name="Li", sender_name="Wu", payment_type="73001",
    cargo_num=1, estimate_arrive_time="1751241600000", distance=1.5, is_deleted="0", **{p: 1 for p in tms_dwd.PARTIES})


@pytest.fixture
def waybills(spark):
    codes = ["60010", "60020", "60030", "60050", "60060", "60070", "60080", "60999"]
    orders = spark.createDataFrame([
        {**WAYBILL, "id": i, "status": c, "amount": 100 + i, "update_time": "2025-06-30T10:00:00Z"} for i, c in enumerate(codes)])
    cargo = spark.createDataFrame([
        {"id": 10 * i + j, "order_id": i, "cargo_type": "71001", "volume_length": 1, "volume_width": 1, "volume_height": 1,
         "weight": 1, "create_time": "2025-06-29T09:00:00Z", "is_deleted": "1" if j == 2 else "0"}
        for i in range(len(codes)) for j in range(3)])
    dic = spark.createDataFrame([(60020, "paid"), (71001, "parcel"), (72001, "door")], "id int, name string")
    return cargo, orders, dic


def test_milestones_split_the_codes(waybills):
    cargo, orders, dic = waybills
    found = {}
    for step in (tms_dwd.PAID, tms_dwd.CANCELLED, tms_dwd.RECEIVED, tms_dwd.DISPATCHED, tms_dwd.BOUND_FINISHED,
                 tms_dwd.DELIVERED, tms_dwd.SIGNED):
        got = tms_dwd.milestone(cargo, orders, dic, step).collect()
        found[step.time] = sorted({r.status for r in got})
        assert all(r.dt == D and r.receiver_name == "L*" and r.cargo_type_name == "parcel" for r in got)
        assert len(got) == 2 * len(found[step.time])  # the deleted cargo line is dropped
    assert found == {
        "payment_time": ["60020"], "cancel_time": ["60999"], "receive_time": ["60030"], "dispatch_time": ["60050"],
        "bound_finish_time": ["60060"], "deliver_suc_time": ["60070", "60080"], "sign_time": ["60080"]}


def test_open_and_new_rows_meet_the_changed_orders(waybills, rows):
    cargo, orders, dic = waybills
    placed = tms_dwd.order_detail(cargo, orders, dic)
    whole = tms_dwd.milestone(cargo, orders, dic, tms_dwd.PAID)
    split = tms_dwd.milestone_from_open(placed.where("id % 2 = 0"), placed.where("id % 2 = 1"), orders, dic, tms_dwd.PAID)
    columns = ["id", "status", "status_name", "payment_time", "amount", "dt"]
    assert rows(split, *columns) == rows(whole, *columns)


def _shuffled(plan):
    """Rows that went through the shuffles of a plan that has run."""
    inner = {"AdaptiveSparkPlan": "executedPlan", "ShuffleQueryStage": "plan", "BroadcastQueryStage": "plan", "ResultQueryStage": "plan"}.get(plan.nodeName())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if plan.nodeName() == "Exchange" else 0
    children = plan.children()
    return own + sum(map(_shuffled, [getattr(plan, inner)()] if inner else [children.apply(i) for i in range(children.size())]))


def test_a_load_shuffles_only_rows_of_orders_that_reached_the_step(spark, waybills, rows):
    cargo, orders, dic = waybills
    many = orders.crossJoin(spark.range(200).select((F.col("id") * 100).alias("more")))
    orders = session.written(many.withColumn("id", F.col("id") + F.col("more")).drop("more"))
    lines = cargo.crossJoin(spark.range(200).select((F.col("id") * 100).alias("more")))
    cargo = lines.withColumns({"id": F.col("id") + 10 * F.col("more"), "order_id": F.col("order_id") + F.col("more")}).drop("more")
    placed = session.written(tms_dwd.order_detail(cargo, orders, dic))
    again = placed.where("id % 3 = 0").withColumn("order_id", F.col("order_id") + 1)  # placed a second time: the open one counts
    today = placed.where("id % 2 = 1").unionByName(again.where("id % 2 = 0"))
    columns = ["id", "order_id", "status", "status_name", "payment_time", "amount", "dt"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = tms_dwd.milestone_from_open(placed.where("id % 2 = 0"), today, orders, dic, tms_dwd.PAID).select(*columns)
        found = split.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) == 400 and {tuple(r) for r in found} == set(rows(tms_dwd.milestone(cargo, orders, dic, tms_dwd.PAID), *columns))
    # 3,200 rows, of which 400 reached it; before over 7,000 were shuffled
    assert 400 <= _shuffled(split._jdf.queryExecution().executedPlan()) < placed.count()


def test_process_closes_finished_and_cancelled(waybills):
    closing = {r.status: r.dt for r in tms_dwd.order_process(*waybills).collect()}
    assert closing["60080"] == closing["60999"] == D and closing["60020"] == OPEN_END


def test_one_amount_per_order(spark, rows):
    detail = spark.createDataFrame([(1, D, 10), (1, D, 10), (1, D, 12), (2, D, 5)], "order_id int, dt date, amount int")
    assert rows(tms_dws.dispatch_1d(detail), "order_count", "order_amount") == [(2, 17)]


def test_two_driver_trips_are_shared(spark, rows):
    schema = "recent_days int, driver1_emp_id int, driver1_name string, driver2_emp_id int, driver2_name string, trans_finish_count int, trans_finish_distance decimal(16,2), trans_finish_dur_sec bigint"
    trips = spark.createDataFrame([
        (7, 1, "A", None, None, 1, Decimal(10), 100), (7, 1, "A", 2, "B", 1, Decimal(10), 100),
        (7, 1, "A", 2, "B", 1, Decimal(10), 100)], schema)  # equal rows are not merged
    assert rows(tms_ads.driver_stats(trips, D), "driver_emp_id", "trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec") == [
        (1, 3, 20.0, 200.0), (2, 2, 10.0, 100.0)]


def test_late_trips_compare_with_start_plus_shift(spark):
    base = dict(shift_id=1, line_id=1, start_org_id=1, start_org_name="o", end_org_id=2, end_org_name="p", order_num=1,
                driver1_emp_id=1, driver1_name="A", driver2_emp_id=2, driver2_name="B", truck_id=1, truck_no="T",
                actual_distance=3, is_deleted="0")
    tasks = spark.createDataFrame([
        {**base, "id": 1, "actual_start_time": "0", "actual_end_time": "3600000"},
        {**base, "id": 2, "actual_start_time": "0", "actual_end_time": "3600001"},
        {**base, "id": 3, "actual_start_time": "0", "actual_end_time": None}])
    shifts = spark.createDataFrame([(1, 60)], "id int, estimated_time int")
    got = {r.id: r for r in tms_dwd.trans_finish(tasks, shifts).collect()}
    assert set(got) == {1, 2} and got[1].finish_dur_sec == 3600
    assert [got[i].actual_end_time > got[i].estimate_end_time for i in (1, 2)] == [False, True]


def test_window_customers_equal_brute_force(spark):
    rng = random.Random(6)
    data = [(rng.choice([None, *"abcdef"]), days(rng.randrange(0, 75))) for _ in range(120)]
    verify = spark.createDataFrame([(c, at(5, d)) for c, d in data], "customer_id string, verify_time timestamp")
    got = {(r.time_type, r.end_date): r.pay_customer_num for r in discount.window_customers(verify, D).collect()}
    for name, span in discount.WINDOWS.items():
        for n in range(31):
            end = days(n)
            low = end - dt.timedelta(days=span - 1)
            want = len({c for c, d in data if c and low <= d <= end})
            assert got.get((name, end), 0) == want


def test_windows_reach_back_before_the_first_end(spark):
    daily = spark.createDataFrame([("s", days(n), 1, Decimal(1), 1, Decimal(1)) for n in range(70)],
                                  "service_id string, dt date, total_send_count long, total_send_amount decimal(9,2), total_verify_count long, total_verify_amount decimal(9,2)")
    for frame in ("range", "rows"):
        for ends in (1, 7, 31):
            got = discount.agent_windows(daily, D, frame, ends).collect()
            assert len(got) == 3 * ends
            assert all(r.send_count == discount.WINDOWS[r.time_type] == (r.end_date - r.start_date).days + 1 for r in got)


def test_a_corrected_snapshot_of_the_same_day_replaces_its_rows(spark, rows):
    schema = "id long, name string, start_date date, end_date date"
    current = spark.createDataFrame([(1, "a", days(9), dt.date(9999, 12, 31)), (2, "x", D, dt.date(9999, 12, 31))], schema)
    snapshot = spark.createDataFrame([(1, "a"), (2, "y"), (3, "z")], "id long, name string")
    after = shop_dim.close_out(current, snapshot, D)
    assert rows(after, "id", "name", "start_date") == [(1, "a", days(9)), (2, "y", D), (3, "z", D)]
    assert after.where("start_date > end_date").count() == 0


def test_activity_daily_keeps_silent_activities(spark, rows):
    activity = spark.createDataFrame([("a", "A", "on", "t"), ("b", "B", "on", "t")], "activity_id string, activity_name string, status string, discount_type string")
    sends = spark.createDataFrame([("s1", "a", 5, at(1))], "send_id string, activity_id string, send_discount_amount int, send_time timestamp")
    verify = spark.createDataFrame([("v1", "a", "c", Decimal(9), 2, at(2)), ("v2", "a", "c", Decimal(1), 1, at(3)), ("v3", None, None, Decimal(4), 1, at(3))],
                                   "verify_id string, activity_id string, customer_id string, pay_amount decimal(10,2), buy_count int, verify_time timestamp")
    got = rows(discount.activity_daily(activity, sends, verify), "activity_id", "dt", "daily_send_count", "daily_verify_count", "daily_pay_customer_count", "activity_name")
    assert got == [("a", D, 1, 2, 1, "A"), ("b", None, 0, 0, 0, "B"), (None, D, 0, 1, 0, None)]


def test_discount_amount_by_type(spark, rows):
    activity = spark.createDataFrame([("f", discount.FIXED_DISCOUNT, 9), ("c", discount.CUSTOM_DISCOUNT, 9)], "activity_id string, discount_type string, max_discount_amount int")
    relation = spark.createDataFrame([("1", "f", 3, 0), ("2", "c", 3, 0), ("3", "x", 3, 0), ("4", "f", 3, 1)], "rel_id string, activity_id string, fixed_discount int, is_delete int").withColumns(
        {c: F.lit("") for c in ("product_id", "sku_id", "max_buy_count", "add_time")})
    assert rows(discount.product_discount(relation, activity), "rel_id", "fixed_discount_amount", "custom_discount_limit") == [
        ("1", 3, None), ("2", None, 9), ("3", None, None)]


def test_macro_measures_do_not_mix_facts(spark):
    visits = spark.createDataFrame([("v", "u1", "p", 10, 0)], "visit_id string, user_id string, product_id string, stay_time int, is_click int")
    adds = spark.createDataFrame([("u2", "p", macro.ADD_TO_CART, 3), ("u3", "p", macro.FAVOURITE, None)], "user_id string, product_id string, op_type string, add_cart_count int")
    trades = spark.createDataFrame([("u4", "p", 2, Decimal(8), macro.PAID, Decimal(8)), ("u4", "p", 1, Decimal(4), "no", None)], "user_id string, product_id string, buy_count int, buy_amount decimal(10,2), pay_status string, pay_amount decimal(10,2)")
    keyed = [df.withColumns({"category_id": F.lit("c"), "dt": F.lit(D)}) for df in (visits, adds, trades)]
    row = macro.product_daily(*keyed).first()
    assert (row.visitor_count, row.view_count, row.avg_stay_time, row.bounce_rate) == (1, 1, 10.0, 1.0)
    assert (row.favorite_user_count, row.add_to_cart_quantity, row.add_to_cart_user_count) == (1, 3, 1)
    assert (row.order_user_count, row.pay_user_count, row.pay_amount, row.buyer_count) == (2, 1, 8, 1)
    empty = macro.product_daily(keyed[0].limit(0), keyed[1], keyed[2])
    product = spark.createDataFrame([("p", "old", "c", "2024-01-01"), ("p", "new", "c", "2025-01-01")], "product_id string, product_name string, category_name string, update_date string")
    report = macro.macro_monitor(empty, macro.latest_product(product), D).collect()
    assert len(report) == 1 and report[0].product_name == "new" and report[0].order_conversion_rate == 0


def test_goods_quality_rules(spark, rows):
    sales = spark.createDataFrame([("ok", 1.0, 2, 1), ("free", 0.0, 2, 1), ("neg", 1.0, -1, 0), ("many", 1.0, 1, 2)], "goods_id string, pay_amount double, sales_num int, pay_buyer_num int").withColumns(
        {"sku_id": F.lit("s"), "pay_date": F.lit("2025-06-30")})
    assert rows(goods.sales_clean(sales), "goods_id") == [("ok",)]


def test_grades_and_text_counts(spark):
    raw = spark.createDataFrame([("1", "cat_x", "10", "12", "0"), ("", "cat", "1", "1", "1"), ("2", None, "-5", "x", None)], "product_id string, product_name string, traffic_cnt string, click_cnt string, sales_cnt string").withColumn("sales_amount", F.lit(5))
    got = {r.product_id: r for r in diagnosis.cleaned(raw).collect()}
    assert set(got) == {"1", "2"}
    assert (got["1"].category, got["1"].click_rate, got["1"].avg_price) == ("cat", 1.2, 0.0)
    assert (got["2"].category, got["2"].traffic_cnt, got["2"].click_rate) == (None, 0, 0.0)
    rates = spark.createDataFrame([(str(i), s, 0.0, 0.0, 0.0, 0.0) for i, s in enumerate([300.0, 200.0, 150.0, 0.0])], "product_id string, click_rate double, conversion_rate double, content_interact_rate double, new_user_rate double, service_rating double").withColumns(
        {"product_name": F.lit("n"), "stat_date": F.lit(D)})
    scored = {r.product_id: r for r in diagnosis.scored(rates, diagnosis.DIAGNOSIS).collect()}
    assert [scored[str(i)].score_level for i in range(4)] == ["A级", "B级", "C级", "D级"]
    assert [scored[str(i)].traffic_rank for i in range(4)] == [1, 2, 3, 4] and scored["0"].competitiveness_index == 104
