"""The SQL body of every query, over the views of ``oracle.raw``."""

from __future__ import annotations

from layerhouse.functions import masking
from layerhouse.plans.shop_dim import AMOUNT_OFF, DISCOUNT, NTH_ITEM
from oracle.raw import CUT, MEAN_PRICE, half_up, stamp

DAY = "DATE '1996-06-30'"
EVENT_DAY = "DATE '2024-01-30'"
BODIES: dict[str, str] = {}


def add(name: str, sql: str) -> None:
    BODIES[name] = sql


SKU = "sku_name, category1_id, category1_name, category2_id, category2_name, category3_id, category3_name, tm_id, tm_name"
PROV = "province_id, province_name, area_code, iso_code, iso_3166_2"
SPLIT = "original AS split_original_amount, activity AS split_activity_amount, coupon AS split_coupon_amount"
SUMS = """sum(original) AS order_original_amount_1d, sum(activity) AS activity_reduce_amount_1d,
 sum(coupon) AS coupon_reduce_amount_1d, sum(total) AS order_total_amount_1d"""


def wide(pairs: dict[str, str], spans: tuple[int, ...] = (7, 30)) -> str:
    return ", ".join(
        f"coalesce(sum({src}) FILTER (dt > {DAY} - {n}), 0) AS {name}_{n}d" for n in spans for name, src in pairs.items()
    )


LAST30 = f"dt BETWEEN {DAY} - 29 AND {DAY}"

add("e1_dim_activity", f"""
SELECT cut * 10 + ln AS activity_rule_id, cut AS activity_id, CASE WHEN cut > 0 THEN 'activity ' || cut END AS activity_name,
 t AS activity_type, CASE t WHEN '3101' THEN 'amount off' WHEN '3102' THEN 'nth item' WHEN '3103' THEN 'discount' END AS activity_type_name,
 CASE WHEN cut > 0 THEN 'cut ' || cut END AS activity_desc, CASE WHEN cut > 0 THEN '1995-01-01' END AS start_time,
 CASE WHEN cut > 0 THEN '2001-12-31' END AS end_time, CASE WHEN cut > 0 THEN '1994-12-01' END AS create_time,
 ln * 100 AS condition_amount, ln AS condition_num, cut * 5 AS benefit_amount, cut AS benefit_discount,
 CASE t WHEN '3101' THEN '{AMOUNT_OFF[0]}' || CAST(ln * 100 AS DECIMAL(16,2)) || '{AMOUNT_OFF[1]}' || CAST(cut * 5 AS DECIMAL(16,2)) || '{AMOUNT_OFF[2]}'
  WHEN '3102' THEN '{NTH_ITEM[0]}' || ln || '{NTH_ITEM[1]}' || CAST(cut AS DECIMAL(16,2)) || '{NTH_ITEM[2]}'
  WHEN '3103' THEN '{DISCOUNT[0]}' || CAST(cut AS DECIMAL(16,2)) || '{DISCOUNT[1]}' END AS benefit_rule, ln AS benefit_level
FROM (SELECT *, CASE WHEN ln <= 2 THEN '3101' WHEN ln <= 4 THEN '3102' WHEN ln <= 6 THEN '3103' ELSE '3199' END AS t
 FROM (SELECT DISTINCT {CUT} AS cut, l_linenumber AS ln FROM lineitem))""")
add("e2_dim_coupon", """
SELECT *, '1994-12-01' AS create_time, id * 1000 AS limit_num, id * 10 AS taken_count, '1995-01-01' AS start_time,
 '2001-12-31' AS end_time, '1994-12-02' AS operate_time, '2002-01-31' AS expire_time FROM coupon""")
add("e3_dim_date", """
SELECT d AS date_id, week(d) AS week_id, isodow(d) AS week_day, day(d) AS day, month(d) AS month, quarter(d) AS quarter,
 year(d) AS year, CASE WHEN isodow(d) <= 5 THEN 1 ELSE 0 END AS is_workday
FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""")
add("e4_dim_promotion_pos", """SELECT n_nationkey AS id, n_name AS pos_location, n_regionkey AS pos_type, 'banner' AS promotion_type,
 '2020-01-01' AS create_time, '2020-01-02' AS operate_time FROM nation""")
add("e5_dim_promotion_refer", """SELECT r_regionkey AS id, r_name AS refer_name, '2020-01-01' AS create_time, '2020-01-02' AS operate_time FROM region""")
add("e6_dim_province", "SELECT * FROM province")
add("e7_dim_sku", """
SELECT s.id, CAST(p_retailprice AS DECIMAL(16,2)) AS price, sku_name, p_type || ' ' || sku_name AS sku_desc, category3_id AS weight,
 category3_id > 5 AS is_sale, p_type AS spu_id, lower(p_type) AS spu_name, s.* EXCLUDE (id, sku_name, p_type, p_retailprice),
 '1:' || string_split(sku_name, ' ')[1] || ':colour:' || string_split(sku_name, ' ')[1] || ',2:' || string_split(sku_name, ' ')[2] || ':kind:' || string_split(sku_name, ' ')[2] AS attrs,
 f.sale_attrs, '2020-01-01 00:00:00' AS create_time
FROM sku s LEFT JOIN (SELECT l_partkey, string_agg('9:' || l_returnflag || ':flag:' || lower(l_returnflag), ',' ORDER BY l_returnflag) AS sale_attrs
 FROM (SELECT DISTINCT l_partkey, l_returnflag FROM lineitem) GROUP BY l_partkey) f ON s.id = f.l_partkey""")
PHONE, EMAIL = f"'{masking.PHONE}'", f"'{masking.EMAIL}'"
add("e8_dim_user_zip", f"""
SELECT id, name[1] || '*' AS name, CASE WHEN regexp_matches(phone_num, {PHONE}) THEN phone_num[1:3] || '*' END AS phone_num,
 CASE WHEN regexp_matches(email, {EMAIL}) THEN '*@' || string_split(email, '@')[2] END AS email, user_level, birthday, gender,
 {stamp('create_time')} AS create_time, {EVENT_DAY} AS start_date, '9999-12-31' AS end_date FROM users""")
add("e9_dwd_favor_add", f"SELECT event_id AS id, user_id, k AS sku_id, dt, {stamp('ts')} AS create_time FROM ev WHERE event_type = 'view'")
add("e10_dwd_coupon_used", "SELECT * FROM coupon_used")
add("e11_dwd_cart_add", f"""SELECT event_id AS id, user_id, k AS sku_id, dt, {stamp('ts')} AS create_time, ceil(value) AS sku_num
FROM ev WHERE event_type = 'click'""")
add("e12_dwd_cart_full", """SELECT event_id AS id, user_id, k AS sku_id, 'sku ' || k AS sku_name, ceil(value) AS sku_num
FROM ev WHERE event_type = 'click' AND value <= 60""")
add("e13_dwd_order_detail", f"""
SELECT l.id, order_id, user_id, sku_id, province_id, a.activity_id, a.activity_rule_id, c.coupon_id, dt, {stamp('create_time')} AS create_time,
 sku_num, {SPLIT}, total AS split_total_amount FROM order_line l
LEFT JOIN (SELECT id, activity_id, activity_rule_id FROM lines WHERE activity_id IS NOT NULL) a ON l.id = a.id
LEFT JOIN (SELECT id, coupon_id FROM lines WHERE coupon_id IS NOT NULL) c ON l.id = c.id""")
add("e14_dwd_pay_detail", f"""
SELECT l.id, order_id, l.user_id, sku_id, o.province_id, a.activity_id, a.activity_rule_id, c.coupon_id, payment_type, payment_type_name,
 paid_day AS dt, {stamp('callback_time')} AS callback_time, sku_num, {SPLIT}, total AS split_payment_amount FROM pay_line l
LEFT JOIN shop_orders o ON l.order_id = o.id
LEFT JOIN (SELECT id, activity_id, activity_rule_id FROM lines WHERE activity_id IS NOT NULL) a ON l.id = a.id
LEFT JOIN (SELECT id, coupon_id FROM lines WHERE coupon_id IS NOT NULL) c ON l.id = c.id""")
FLOW = """SELECT o.id AS order_id, o.user_id, o.province_id, o.create_time, p.callback_time, f.finish, o.total_amount,
 coalesce(p.total_amount, 0) AS payment_amount FROM shop_orders o LEFT JOIN payment p ON o.id = p.order_id
 LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS finish FROM lineitem GROUP BY 1) f ON o.id = f.l_orderkey"""
add("e15_dwd_trade_flow", f"""
SELECT order_id, user_id, province_id, CAST(create_time AS DATE) AS order_date, {stamp('create_time')} AS order_time,
 CAST(callback_time AS DATE) AS payment_date, {stamp('callback_time')} AS payment_time, CAST(finish AS DATE) AS finish_date,
 {stamp('finish')} AS finish_time, total_amount + 20 AS order_original_amount, 15 AS order_activity_amount, 5 AS order_coupon_amount,
 total_amount AS order_total_amount, payment_amount, coalesce(CAST(CAST(finish AS DATE) AS VARCHAR), '9999-12-31') AS dt FROM ({FLOW})""")
add("e16_dwd_page_view", "SELECT * FROM pages_seen")
add("e17_dwd_user_login", "SELECT * FROM logins")
add("e18_dwd_user_register", f"""
SELECT u.id AS user_id, CAST(u.create_time AS DATE) AS dt, {stamp('u.create_time')} AS create_time, channel, province_id, version_code,
 mid_id, brand, model, operate_system FROM users u LEFT JOIN (SELECT * FROM pages_seen WHERE page_id = 'register' AND user_id IS NOT NULL) p
 ON u.id = CAST(p.user_id AS BIGINT)""")
add("e19_dws_province_order_1d", f"""
SELECT {PROV}, dt, d.order_count AS order_count_1d, original AS order_original_amount_1d, activity AS activity_reduce_amount_1d,
 coupon AS coupon_reduce_amount_1d, total AS order_total_amount_1d FROM province_days d LEFT JOIN province p ON d.province_id = p.id""")
ND = {"order_count": "order_count", "order_original_amount": "original", "activity_reduce_amount": "activity",
      "coupon_reduce_amount": "coupon", "order_total_amount": "total"}
add("e20_dws_province_order_nd", f"""
SELECT {PROV}, {wide(ND)} FROM province_days d LEFT JOIN province p ON d.province_id = p.id WHERE {LAST30} GROUP BY {PROV}""")
FAVOR = f"""SELECT f.sku_id, {SKU}, f.n AS favor_add_count_1d, f.dt FROM
 (SELECT k AS sku_id, dt, count(*) AS n FROM ev WHERE event_type = 'view' GROUP BY k, dt) f LEFT JOIN sku s ON f.sku_id = s.id"""
add("e21_dws_sku_favor_1d", FAVOR)
add("e22_dws_user_coupon_used_1d", """
SELECT u.user_id, u.coupon_id, c.coupon_name, c.coupon_type AS coupon_type_code, c.coupon_type_name, c.benefit_rule, u.used_count_1d, u.dt
FROM (SELECT user_id, coupon_id, dt, count(*) AS used_count_1d FROM coupon_used GROUP BY ALL) u LEFT JOIN coupon c ON u.coupon_id = c.id""")
add("e23_dws_user_cart_1d", """SELECT user_id, count(*) AS cart_add_count_1d, sum(ceil(value)) AS cart_add_num_1d, dt
FROM ev WHERE event_type = 'click' GROUP BY user_id, dt""")
add("e24_dws_user_order_1d", f"""SELECT user_id, dt, count(DISTINCT order_id) AS order_count_1d, sum(sku_num) AS order_num_1d, {SUMS}
FROM order_line GROUP BY user_id, dt""")
add("e25_dws_user_order_td", """
SELECT user_id, min(dt) AS order_date_first, max(dt) AS order_date_last, count(DISTINCT order_id) AS order_count_td, sum(sku_num) AS order_num_td,
 sum(original) AS original_amount_td, sum(activity) AS activity_reduce_amount_td, sum(coupon) AS coupon_reduce_amount_td, sum(total) AS total_amount_td
FROM order_line GROUP BY user_id""")
add("e26_dws_user_payment_1d", """SELECT user_id, count(DISTINCT order_id) AS payment_count_1d, sum(sku_num) AS payment_num_1d,
 sum(total) AS payment_amount_1d, paid_day AS dt FROM pay_line GROUP BY user_id, paid_day""")
add("e27_dws_user_sku_order_1d", f"SELECT u.*, {SKU} FROM user_sku_days u LEFT JOIN sku s ON u.sku_id = s.id")
ND2 = {n: f"{n}_1d" for n in ("order_count", "order_num", "order_original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_total_amount")}
add("e28_dws_user_sku_order_nd", f"""SELECT user_id, sku_id, {SKU}, {wide(ND2)} FROM user_sku_days u LEFT JOIN sku s ON u.sku_id = s.id
WHERE {LAST30} GROUP BY user_id, sku_id, {SKU}""")
VISITOR = "SELECT mid_id, brand, model, operate_system, page_id, dt, sum(during_time) AS during_time_1d, count(*) AS view_count_1d FROM pages_seen GROUP BY ALL"
add("e29_dws_visitor_page_1d", VISITOR)
SESSION = """SELECT session_id, mid_id, brand, model, operate_system, version_code, channel, dt, sum(during_time) AS during_time_1d, count(*) AS page_count_1d
 FROM pages_seen GROUP BY ALL"""
add("e30_dws_session_page_1d", SESSION)
add("e31_dws_user_login_td", "SELECT * FROM login_td_today")
add("e32_ads_coupon_stats", f"""
SELECT {DAY} AS dt, coupon_id, coupon_name, count(*) AS used_count, count(DISTINCT user_id) AS used_user_count
FROM coupon_used u LEFT JOIN (SELECT id AS cid, coupon_name FROM coupon) c ON u.coupon_id = c.cid WHERE dt = {DAY} GROUP BY coupon_id, coupon_name""")
add("e33_ads_new_order_user", f"""
SELECT {DAY} AS dt, recent_days, count(*) AS new_order_user_count FROM (SELECT user_id, min(dt) AS first_day FROM order_line GROUP BY user_id)
JOIN span ON first_day BETWEEN {DAY} - (recent_days - 1) AND {DAY} GROUP BY recent_days""")
add("e34_ads_order_by_province", f"""
WITH p AS (SELECT d.*, {PROV.replace('province_id, ', '')} FROM province_days d LEFT JOIN province q ON d.province_id = q.id)
SELECT {DAY} AS dt, 1 AS recent_days, {PROV}, order_count, total AS order_total_amount FROM p WHERE dt = {DAY}
UNION ALL SELECT {DAY}, n, {PROV}, coalesce(sum(order_count) FILTER (dt > {DAY} - n), 0), coalesce(sum(total) FILTER (dt > {DAY} - n), 0)
FROM p, (SELECT unnest([7, 30]) AS n) WHERE {LAST30} GROUP BY n, {PROV}""")
BUYS = f"SELECT DISTINCT user_id, dt FROM ev WHERE event_type = 'purchase' AND dt BETWEEN {EVENT_DAY} - 6 AND {EVENT_DAY}"
for letter, method, rule in (
    ("a", "lead", "c.dt = a.dt + 2"), ("b", "islands", "c.dt = a.dt + 2"), ("c", "bitmap", "c.dt = a.dt + 2"),
    ("d", "one_gap", "c.dt <= a.dt + 3"),
):
    add(f"e35{letter}_ads_order_streak_{method}", f"""
WITH d AS ({BUYS}) SELECT {EVENT_DAY} AS dt, 7 AS recent_days, count(DISTINCT a.user_id) AS order_continuously_user_count
FROM d a JOIN d b ON a.user_id = b.user_id AND b.dt > a.dt JOIN d c ON a.user_id = c.user_id AND c.dt > b.dt AND {rule}""")


def buyers(keys: str) -> str:
    return f"""
WITH u AS (SELECT {keys}, user_id, dt, order_count_1d FROM user_sku_days d LEFT JOIN sku s ON d.sku_id = s.id WHERE {LAST30})
SELECT {DAY} AS dt, 1 AS recent_days, {keys}, sum(order_count_1d) AS order_count, count(DISTINCT user_id) AS order_user_count FROM u WHERE dt = {DAY} GROUP BY {keys}
UNION ALL SELECT {DAY}, n, {keys}, coalesce(sum(order_count_1d) FILTER (dt > {DAY} - n), 0), count(DISTINCT user_id) FILTER (dt > {DAY} - n)
FROM u, (SELECT unnest([7, 30]) AS n) GROUP BY n, {keys}"""


CATS = "category1_id, category1_name, category2_id, category2_name, category3_id, category3_name"
add("e36_ads_order_by_category", buyers(CATS))
add("e37_ads_order_by_brand", buyers("tm_id, tm_name"))
add("e38_ads_order_to_pay_interval", f"""SELECT DATE '2001-12-31' AS dt, trunc(avg(epoch(callback_time) - epoch(create_time))) AS order_to_pay_interval_avg
FROM ({FLOW}) WHERE callback_time IS NOT NULL""")
add("e39_ads_page_path", f"""
SELECT {EVENT_DAY} AS dt, 'step-' || rn || ':' || page_id AS source, coalesce('step-' || (rn + 1) || ':' || nxt, 'null') AS target, count(*) AS path_count
FROM (SELECT page_id, lead(page_id) OVER w AS nxt, row_number() OVER w AS rn FROM pages_seen WHERE dt = {EVENT_DAY}
 WINDOW w AS (PARTITION BY session_id ORDER BY epoch_ms(ts), event_id)) GROUP BY ALL""")
add("e40_ads_repeat_purchase_by_brand", f"""
SELECT {DAY} AS dt, 30 AS recent_days, tm_id, tm_name, {half_up('count(*) FILTER (n >= 2)', 'count(*)', 2)} AS order_repeat_rate FROM
 (SELECT tm_id, tm_name, user_id, sum(order_count_1d) AS n FROM user_sku_days d LEFT JOIN sku s ON d.sku_id = s.id WHERE {LAST30} GROUP BY ALL) GROUP BY tm_id, tm_name""")
add("e41_ads_cart_top3_by_category", f"""
SELECT {EVENT_DAY} AS dt, * FROM (SELECT {CATS}, c.sku_id, sku_name, cart_num,
 rank() OVER (PARTITION BY category1_id, category2_id, category3_id ORDER BY cart_num DESC) AS rk FROM
 (SELECT k AS sku_id, sum(ceil(value)) AS cart_num FROM ev WHERE event_type = 'click' AND value <= 60 GROUP BY k) c LEFT JOIN sku s ON c.sku_id = s.id) WHERE rk <= 3""")
add("e42_ads_favor_top3_by_brand", f"""
SELECT * FROM (SELECT dt, tm_id, tm_name, sku_id, sku_name, favor_add_count_1d, rank() OVER (PARTITION BY tm_id ORDER BY favor_add_count_1d DESC) AS rk
 FROM ({FAVOR}) WHERE dt = {EVENT_DAY}) WHERE rk <= 3""")
add("e43_ads_traffic_by_channel", f"""
SELECT {EVENT_DAY} AS dt, recent_days, channel, count(DISTINCT mid_id) AS uv_count, trunc(avg(during_time_1d) / 1000) AS avg_duration_sec,
 trunc(avg(page_count_1d)) AS avg_page_count, count(*) AS sv_count, {half_up('count(*) FILTER (page_count_1d = 1)', 'count(*)', 2)} AS bounce_rate
FROM ({SESSION}) JOIN span ON dt BETWEEN {EVENT_DAY} - (recent_days - 1) AND {EVENT_DAY} GROUP BY recent_days, channel""")
add("e44_ads_user_action", f"""
SELECT {EVENT_DAY} AS dt, (SELECT count(*) FROM ({VISITOR}) WHERE dt = {EVENT_DAY} AND page_id = 'home') AS home_count,
 (SELECT count(*) FROM ({VISITOR}) WHERE dt = {EVENT_DAY} AND page_id = 'good_detail') AS good_detail_count,
 (SELECT count(DISTINCT user_id) FROM ev WHERE dt = {EVENT_DAY} AND event_type = 'click') AS cart_count,
 (SELECT count(DISTINCT user_id) FROM order_line WHERE dt = {DAY}) AS order_count,
 (SELECT count(DISTINCT user_id) FROM pay_line WHERE paid_day = {DAY}) AS payment_count""")
add("e45_ads_user_change", f"""
SELECT {EVENT_DAY} AS dt, (SELECT count(*) FROM login_td_today WHERE login_date_last = {EVENT_DAY} - 7) AS user_churn_count,
 (SELECT count(*) FROM login_td_today t JOIN login_td_before b ON t.user_id = b.user_id
  WHERE t.login_date_last = {EVENT_DAY} AND t.login_date_last - b.login_date_last >= 8) AS user_back_count""")
add("e46_ads_user_retention", f"""
SELECT {EVENT_DAY} AS dt, login_date_first AS create_date, {EVENT_DAY} - login_date_first AS retention_day,
 count(*) FILTER (login_date_last = {EVENT_DAY}) AS retention_count, count(*) AS new_user_count,
 {half_up(f'count(*) FILTER (login_date_last = {EVENT_DAY}) * 100', 'count(*)', 2)} AS retention_rate
FROM login_td_today WHERE login_date_first BETWEEN {EVENT_DAY} - 7 AND {EVENT_DAY} - 1 GROUP BY login_date_first""")
add("e47_ads_user_stats", f"""
SELECT {EVENT_DAY} AS dt, recent_days, count(*) FILTER (login_date_first > {EVENT_DAY} - recent_days) AS new_user_count, count(*) AS active_user_count
FROM login_td_today JOIN span ON login_date_last BETWEEN {EVENT_DAY} - (recent_days - 1) AND {EVENT_DAY} GROUP BY recent_days""")

# ---------------------------------------------------------------- logistics
LIVE = "c_acctbal >= -900"
add("l1_dim_complex", f"""
SELECT c.c_custkey AS id, 'Complex ' || c_name AS complex_name, q.ids AS courier_emp_ids, p.id AS province_id, p.name AS province_name,
 t.id AS city_id, t.name AS city_name, c_custkey % 1000 + 10000 AS district_id, c_mktsegment AS district_name
FROM customer c JOIN region_info p ON c_custkey % 5 + 1 = p.id JOIN region_info t ON c_nationkey + 100 = t.id
LEFT JOIN (SELECT o_custkey, string_agg(e, ',' ORDER BY e) AS ids FROM (SELECT DISTINCT o_custkey, CAST(o_orderkey % 7 AS VARCHAR) AS e FROM orders) GROUP BY 1) q
 ON c_custkey = q.o_custkey WHERE {LIVE}""")
add("l2_dim_organ", """SELECT o.*, r.name AS region_name, r.dict_code AS region_code, p.org_name AS org_parent_name FROM organ o
LEFT JOIN region_info r ON o.region_id = r.id LEFT JOIN organ p ON o.org_parent_id = p.id""")
add("l3_dim_region", "SELECT * FROM region_info")
add("l4_dim_express_courier", f"""
SELECT c_custkey AS id, 'E' || c_custkey AS emp_id, o.id AS org_id, o.org_name, md5('138' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')) AS working_phone,
 CASE WHEN c_acctbal < 5000 THEN '74001' ELSE '74002' END AS express_type, CASE WHEN c_acctbal < 5000 THEN 'inner city' ELSE 'suburban' END AS express_type_name
FROM customer JOIN organ o ON c_custkey % 1000 = o.id WHERE {LIVE}""")
add("l5_dim_shift", "SELECT * FROM shift")
add("l6_dim_truck_driver", f"""
SELECT c_custkey AS id, 'D' || c_custkey AS emp_id, o.id AS org_id, o.org_name, c_custkey % 10 AS team_id, 'Team ' || (c_custkey % 10) AS team_name,
 'A2' AS license_type, '1990-01-01' AS init_license_date, '2030-01-01' AS expire_date, 'LIC' || c_custkey AS license_no, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS is_enabled
FROM customer JOIN organ o ON c_custkey % 1000 = o.id JOIN (SELECT DISTINCT s_suppkey % 10 AS t FROM supplier) ON c_custkey % 10 = t WHERE {LIVE}""")
MODEL = ["truck_weight", "load_weight", "total_weight", "eev", "boxcar_len", "boxcar_wd", "boxcar_hg", "max_speed", "oil_vol"]
add("l7_dim_truck", f"""
SELECT s_suppkey AS id, s_suppkey % 10 AS team_id, 'Team ' || (s_suppkey % 10) AS team_name, 'TM' || (s_suppkey % 10) AS team_no, o.id AS org_id, o.org_name,
 (s_suppkey % 10) * 100 AS manager_emp_id, md5('TRK' || s_suppkey) AS truck_no, s_suppkey % 8 AS truck_model_id, 'Model ' || (s_suppkey % 8) AS truck_model_name,
 t.truck_model_type, t.truck_model_type_name, 'MN' || (s_suppkey % 8) AS truck_model_no, CASE WHEN s_suppkey % 8 < 3 THEN '77001' ELSE '77002' END AS truck_brand,
 CASE WHEN s_suppkey % 8 < 3 THEN 'north' ELSE 'south' END AS truck_brand_name, {', '.join(f's_suppkey % 8 + {i} AS {m}' for i, m in enumerate(MODEL))},
 'GPS' || s_suppkey AS device_gps_id, 'ENG' || s_suppkey AS engine_no, '1999-01-01' AS license_registration_date, '2000-01-01' AS license_last_check_date,
 '2005-01-01' AS license_expire_date, CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS is_enabled
FROM supplier JOIN organ o ON s_suppkey % 10 = o.id JOIN truck_type t ON s_suppkey = t.id""")
add("l8_dim_user_zip", f"""
SELECT id, login_name, nick_name, md5(passwd) AS passwd, md5(name) AS realname, CASE WHEN regexp_matches(phone_num, {PHONE}) THEN md5(phone_num) END AS phone_num,
 CASE WHEN regexp_matches(email, {EMAIL}) THEN md5(email) END AS email, user_level, DATE '1970-01-01' + CAST(birthday AS INTEGER) AS birthday, gender,
 CAST(create_time AS DATE) AS start_date, '9999-12-31' AS end_date FROM users WHERE {LIVE}""")
add("l9_dim_user_address_zip", f"""
SELECT c_custkey + 1 AS id, c_custkey AS user_id, CASE WHEN c_acctbal >= 0 THEN md5('151' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')) END AS phone,
 c_custkey % 5 + 1 AS province_id, c_nationkey + 100 AS city_id, c_custkey % 1000 + 10000 AS district_id, c_custkey % 50 AS complex_id,
 'Road ' || c_name AS address, 1 AS is_default, '1998-03-04 05:06:07' AS start_date, '9999-12-31' AS end_date FROM customer WHERE {LIVE}""")
add("l10_dwd_order_detail", "SELECT *, order_day AS dt FROM waybill")
for name, column, codes in (
    ("l11_dwd_pay_suc", "payment_time", "'60020'"), ("l12_dwd_order_cancel", "cancel_time", "'60999'"),
    ("l13_dwd_receive", "receive_time", "'60030'"), ("l14_dwd_dispatch", "dispatch_time", "'60050'"),
    ("l15_dwd_bound_finish", "bound_finish_time", "'60060'"), ("l16_dwd_deliver_suc", "deliver_suc_time", "'60070', '60080'"),
    ("l17_dwd_sign", "sign_time", "'60080'"),
):
    add(name, f"SELECT *, reached_time AS {column}, reached_day AS dt FROM waybill WHERE status IN ({codes})")
add("l18_dwd_order_process", """
SELECT *, order_day AS start_date, end_date AS dt FROM (SELECT *, CASE WHEN status IN ('60080', '60999') THEN CAST(reached_day AS VARCHAR) ELSE '9999-12-31' END AS end_date FROM waybill)""")
add("l19_dwd_trans_finish", f"""SELECT *, {stamp('t0')} AS actual_start_time, {stamp('t1')} AS actual_end_time, {stamp('due')} AS estimate_end_time,
 CAST(t1 AS DATE) AS dt FROM trips""")
LID = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"
for name, step, employee, extra, shift_by, rows in (
    ("l20_dwd_inbound", "inbound", "inbound_emp_id", 0, "0 HOUR", "true"), ("l21_dwd_sort", "sort", "sorter_emp_id", 3, "2 HOUR", "l_returnflag <> 'N'"),
    ("l22_dwd_outbound", "outbound", "outbound_emp_id", 4, "25 HOUR", "l_returnflag = 'R'"),
):
    add(name, f"""SELECT {LID} AS id, l_orderkey AS order_id, l_suppkey AS org_id, {stamp(f'l_shipdate + INTERVAL {shift_by}')} AS {step}_time,
 l_suppkey * 10 + {extra} AS {employee}, CAST(l_shipdate + INTERVAL {shift_by} AS DATE) AS dt FROM lineitem WHERE {rows}""")
ORD = "sum(order_count) AS order_count, sum(order_amount) AS order_amount"
TRIP = "sum(trans_finish_count) AS trans_finish_count, sum(trans_finish_distance) AS trans_finish_distance, sum(trans_finish_dur_sec) AS trans_finish_dur_sec"
MEAN = """sum(trans_finish_distance)::DOUBLE / sum(trans_finish_count) AS avg_trans_finish_distance,
 sum(trans_finish_dur_sec)::DOUBLE / sum(trans_finish_count) AS avg_trans_finish_dur_sec"""
ORG, CITY, PROVINCE, CARGO = "org_id, org_name", "city_id, city_name", "province_id, province_name", "cargo_type, cargo_type_name"
TRUCK = "truck_model_type, truck_model_type_name"
add("l23_dws_org_cargo_order_1d", "SELECT * FROM cargo_days")
add("l24_dws_org_cargo_order_nd", f"SELECT {ORG}, {CITY}, {CARGO}, recent_days, {ORD} FROM cargo_spans WHERE recent_days > 1 GROUP BY ALL")
add("l25_dws_org_receive_1d", "SELECT * FROM receive_days")
add("l26_dws_org_receive_nd", f"SELECT {ORG}, {CITY}, {PROVINCE}, recent_days, {ORD} FROM receive_spans WHERE recent_days > 1 GROUP BY ALL")
add("l27_dws_dispatch_1d", "SELECT * FROM dispatch_days")
add("l28_dws_dispatch_nd", f"SELECT recent_days, {ORD} FROM dispatch_spans WHERE recent_days > 1 GROUP BY recent_days")
add("l29_dws_dispatch_td", f"SELECT {ORD} FROM dispatch_days WHERE dt <= DATE '2001-12-31'")
add("l30_dws_bound_finish_td", "SELECT * FROM finish_total")
add("l31_dws_org_deliver_1d", "SELECT * FROM deliver_days")
add("l32_dws_org_deliver_nd", f"SELECT {ORG}, {CITY}, {PROVINCE}, recent_days, sum(order_count) AS order_count FROM deliver_spans WHERE recent_days > 1 GROUP BY ALL")
add("l33_dws_org_sort_1d", "SELECT * FROM sort_days")
add("l34_dws_org_sort_nd", f"SELECT {ORG}, {CITY}, {PROVINCE}, recent_days, sum(sort_count) AS sort_count FROM sort_spans WHERE recent_days > 1 GROUP BY ALL")
add("l35_dws_org_truck_trips_1d", "SELECT * FROM trip_days")
add("l36_dws_shift_trips_nd", "SELECT * FROM shift_spans WHERE recent_days > 1")
add("l37_ads_trans_order_stats", f"""
SELECT {DAY} AS dt, coalesce(r.recent_days, d.recent_days) AS recent_days, r.n AS receive_order_count, r.a AS receive_order_amount, d.n AS dispatch_order_count, d.a AS dispatch_order_amount
FROM (SELECT recent_days, sum(order_count) AS n, sum(order_amount) AS a FROM receive_spans GROUP BY 1) r
FULL JOIN (SELECT recent_days, sum(order_count) AS n, sum(order_amount) AS a FROM dispatch_spans GROUP BY 1) d ON r.recent_days = d.recent_days""")
add("l38_ads_trans_stats", f"""
SELECT {DAY} AS dt, 1 AS recent_days, {TRIP} FROM trip_days WHERE dt = {DAY} HAVING count(*) > 0
UNION ALL SELECT {DAY}, recent_days, {TRIP} FROM shift_spans WHERE recent_days > 1 GROUP BY recent_days""")
add("l39_ads_trans_order_stats_td", """
SELECT DATE '2001-12-31' AS dt, d.n - f.order_count AS bounding_order_count, d.a - f.order_amount AS bounding_order_amount
FROM (SELECT sum(order_count) AS n, sum(order_amount) AS a FROM dispatch_days WHERE dt <= DATE '2001-12-31') d, finish_total f""")
add("l40_ads_order_stats", f"SELECT {DAY} AS dt, recent_days, {ORD} FROM cargo_spans GROUP BY recent_days")
add("l41_ads_order_cargo_stats", f"SELECT {DAY} AS dt, recent_days, {CARGO}, {ORD} FROM cargo_spans GROUP BY recent_days, {CARGO}")


def both(keys: str) -> str:
    on = " AND ".join(f"o.{k} IS NOT DISTINCT FROM t.{k}" for k in ["recent_days", *keys.split(", ")])
    names = ", ".join(f"coalesce(o.{k}, t.{k}) AS {k}" for k in ["recent_days", *keys.split(", ")])
    return f"""
SELECT {DAY} AS dt, {names}, order_count, order_amount, trans_finish_count, trans_finish_distance, trans_finish_dur_sec, avg_trans_finish_distance, avg_trans_finish_dur_sec
FROM (SELECT recent_days, {keys}, {ORD} FROM cargo_spans GROUP BY ALL) o FULL JOIN (SELECT recent_days, {keys}, {TRIP}, {MEAN} FROM shift_spans GROUP BY ALL) t ON {on}"""


add("l42_ads_city_stats", both(CITY))
add("l43_ads_org_stats", both(ORG))
add("l44_ads_shift_stats", f"SELECT {DAY} AS dt, * FROM shift_spans WHERE recent_days > 1")
add("l45_ads_line_stats", f"""SELECT {DAY} AS dt, recent_days, line_id, line_name, {TRIP}, sum(trans_finish_order_count) AS trans_finish_order_count
FROM shift_spans WHERE recent_days > 1 GROUP BY recent_days, line_id, line_name""")
add("l46_ads_driver_stats", f"""
SELECT {DAY} AS dt, recent_days, driver_emp_id, driver_name, {TRIP}, {MEAN} FROM (
 SELECT recent_days, driver1_emp_id AS driver_emp_id, driver1_name AS driver_name, trans_finish_count, trans_finish_distance::DOUBLE AS trans_finish_distance, trans_finish_dur_sec::DOUBLE AS trans_finish_dur_sec
 FROM shift_spans WHERE driver2_emp_id IS NULL
 UNION ALL SELECT recent_days, driver1_emp_id, driver1_name, trans_finish_count, trans_finish_distance / 2.0, trans_finish_dur_sec / 2.0 FROM shift_spans WHERE driver2_emp_id IS NOT NULL
 UNION ALL SELECT recent_days, driver2_emp_id, driver2_name, trans_finish_count, trans_finish_distance / 2.0, trans_finish_dur_sec / 2.0 FROM shift_spans WHERE driver2_emp_id IS NOT NULL)
WHERE recent_days > 1 GROUP BY recent_days, driver_emp_id, driver_name""")
add("l47_ads_truck_stats", f"SELECT {DAY} AS dt, recent_days, {TRUCK}, {TRIP}, {MEAN} FROM shift_spans WHERE recent_days > 1 GROUP BY recent_days, {TRUCK}")
add("l48_ads_express_stats", f"""
SELECT {DAY} AS dt, coalesce(d.recent_days, s.recent_days) AS recent_days, deliver_suc_count, sort_count
FROM (SELECT recent_days, sum(order_count) AS deliver_suc_count FROM deliver_spans GROUP BY 1) d
FULL JOIN (SELECT recent_days, sum(sort_count) AS sort_count FROM sort_spans GROUP BY 1) s ON d.recent_days = s.recent_days""")
for name, keys in (("l49_ads_express_province_stats", PROVINCE), ("l50_ads_express_city_stats", CITY), ("l51_ads_express_org_stats", ORG)):
    add(name, f"""
WITH r AS (SELECT recent_days, {keys}, sum(order_count) AS receive_order_count, sum(order_amount) AS receive_order_amount FROM receive_spans GROUP BY ALL),
 d AS (SELECT recent_days, {keys}, sum(order_count) AS deliver_suc_count FROM deliver_spans GROUP BY ALL),
 s AS (SELECT recent_days, {keys}, sum(sort_count) AS sort_count FROM sort_spans GROUP BY ALL),
 k AS (SELECT recent_days, {keys} FROM r UNION SELECT recent_days, {keys} FROM d UNION SELECT recent_days, {keys} FROM s)
SELECT {DAY} AS dt, k.*, receive_order_count, receive_order_amount, deliver_suc_count, sort_count FROM k """ + " ".join(
        f"LEFT JOIN {t} ON " + " AND ".join(f"k.{c} IS NOT DISTINCT FROM {t}.{c}" for c in ["recent_days", *keys.split(", ")]) for t in "rds"
    ))

# ---------------------------------------------------------------- product marts
add("pd1_ods_product_behaviour", "SELECT * FROM behaviour")
CLEAN = f"""SELECT *, {half_up('click_cnt', 'traffic_cnt', 4)} AS click_rate,
 {MEAN_PRICE} AS avg_price FROM behaviour"""
add("pd2_dwd_product_behaviour", CLEAN)
add("pd3_dwd_product_narrow", CLEAN)
add("pd4_dws_product_daily", "SELECT * FROM rates")


def score(total: str) -> str:
    ranks = ", ".join(
        f"row_number() OVER (PARTITION BY stat_date ORDER BY {by} DESC, product_id) AS {name}" for name, by in (
            ("traffic_rank", "click_rate"), ("conversion_rank", "conversion_rate"), ("content_rank", "content_interact_rate"),
            ("new_user_rank", "new_user_rate"), ("service_rank", "service_rating"))
    )
    return f"""
SELECT *, CASE WHEN total_score >= 85 THEN 'A级' WHEN total_score >= 70 THEN 'B级' WHEN total_score >= 50 THEN 'C级' ELSE 'D级' END AS score_level,
 round(total_score * 0.8 + 20, 2) AS competitiveness_index, {ranks} FROM (SELECT *, round({total}, 2) AS total_score FROM rates)"""


def weighted(w: tuple, service: int) -> str:
    names = ("click_rate", "conversion_rate", "content_interact_rate", "new_user_rate", "service_rating")
    scale = (1, 100, 1, 1, service)
    return " + ".join(f"CAST({n} AS DECIMAL(14,4)) * {x} * {s}" for n, x, s in zip(names, w, scale))


add("pd5_ads_product_diagnosis", score(weighted((0.35, 0.30, 0.1, 0.1, 0.15), 100)))
add("pd6_ads_product_value", score(weighted((0.2,) * 5, 20)))
add("dt1_ods_discount_send", "SELECT * FROM sends")
add("dt2_ods_discount_verify", "SELECT * FROM verified")
ACTIVITY = """SELECT *, '2024-01-01' AS start_time, '2024-12-31' AS end_time, '2023-12-01' AS create_time, '2023-12-02' AS update_time FROM activity"""
add("dt3_dwd_discount_activity", ACTIVITY)
add("dt4_dwd_product_discount", """
SELECT 'rel_' || p_partkey AS rel_id, 'act_' || p_size AS activity_id, p_partkey AS product_id, 'sku_' || p_partkey AS sku_id, a.discount_type,
 CASE WHEN a.discount_type = '固定优惠' THEN p_size + 5 END AS fixed_discount_amount, CASE WHEN a.discount_type = '自定义优惠' THEN a.max_discount_amount END AS custom_discount_limit,
 p_size * 3 AS max_buy_count, '2024-01-01 08:00:00' AS add_time FROM part LEFT JOIN activity a ON 'act_' || p_size = a.activity_id WHERE p_type <> 'PROMO'""")
add("dt5_dwd_discount_send", "SELECT s.*, a.discount_type FROM sends s LEFT JOIN activity a ON s.activity_id = a.activity_id")
add("dt6_dwd_discount_verify", "SELECT * FROM verified")
add("dt7_dws_activity_effect", "SELECT * FROM activity_days")
add("dt8_dws_agent_performance", f"""
SELECT service_id, dt, send_count AS total_send_count, send_amount AS total_send_amount, pay_count AS total_verify_count, pay_amount AS total_verify_amount,
 {half_up('pay_count', 'send_count', 4)} AS conversion_rate FROM agent_days""")
def frames(source: str, key: str, measures: list[str], how: str = "range", ends: int = 31) -> str:
    parts = []
    for name, n in (("day", 1), ("7days", 7), ("30days", 30)):
        frame = (f"RANGE BETWEEN INTERVAL {n - 1} DAY PRECEDING AND CURRENT ROW" if how == "range"
                 else f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW")
        sums = ", ".join(f"sum({m}) OVER w AS {m}" for m in measures)
        parts.append(f"""SELECT * FROM (SELECT {key}, '{name}' AS time_type, dt - {n - 1} AS start_date, dt AS end_date, {n} AS days, {sums} FROM {source}
 WINDOW w AS (PARTITION BY {key} ORDER BY dt {frame})) WHERE end_date BETWEEN {EVENT_DAY} - {ends - 1} AND {EVENT_DAY}""")
    return " UNION ALL ".join(parts)


for suffix, how, ends in (("", "range", 31), ("_rows", "rows", 31), ("_last7", "range", 7), ("_rows_last7", "rows", 7)):
    add(f"dt9_ads_tool_overview{suffix}", f"""
WITH f AS ({frames('activity_days', 'activity_id', ['daily_send_count', 'daily_send_amount', 'daily_verify_count', 'daily_verify_amount'], how, ends)}),
 t AS (SELECT time_type, start_date, end_date, days, sum(daily_send_count) AS total_send_count, sum(daily_send_amount) AS total_send_amount,
  sum(daily_verify_count) AS total_pay_count, sum(daily_verify_amount) AS total_pay_amount FROM f GROUP BY ALL),
 c AS (SELECT t.time_type, t.end_date, count(DISTINCT v.customer_id) AS n FROM t LEFT JOIN verified v
  ON v.dt BETWEEN t.end_date - (t.days - 1) AND t.end_date GROUP BY ALL)
SELECT t.*, c.n AS pay_customer_num, {half_up('total_pay_amount * 100', 'c.n * 100', 2)} AS avg_pay_per_customer
FROM t JOIN c ON t.time_type = c.time_type AND t.end_date = c.end_date""")
    add(f"dt10_ads_agent_detail{suffix}", f"""SELECT *, {half_up('pay_count', 'send_count', 4)} AS conversion_rate
FROM ({frames('agent_days', 'service_id', ['send_count', 'send_amount', 'pay_count', 'pay_amount'], how, ends)})""")
add("mm1_ods_visit_log", "SELECT *, visit_id AS log_id FROM visits")
add("mm2_ods_product_order", "SELECT *, dt AS order_date FROM trades")
add("mm3_dwd_visit", "SELECT * FROM visits")
add("mm4_dwd_favourite_cart", "SELECT * FROM adds")
add("mm5_dwd_trade", "SELECT * FROM trades")
add("mm6_dws_product_daily", "SELECT * FROM product_days")
for name in ("mm7_ads_macro_monitor", "mm8_ads_visit_stats", "mm9_ads_interaction_stats", "mm10_ads_transaction_stats"):
    add(name, "SELECT * FROM product_report")
add("rk1_ods_price_strength", "SELECT goods_id, star AS price_strength_star, CASE WHEN star <= 2 THEN 1 ELSE 0 END AS is_low_star, record_date FROM stars")
add("rk2_dwd_sales_clean", """
SELECT l_partkey AS goods_id, 'sku_' || l_partkey AS sku_id, CAST(l_extendedprice AS DECIMAL(10,2)) AS total_sales, l_quantity AS total_sales_num,
 l_linenumber AS pay_buyer_num, CAST(l_shipdate AS DATE) AS pay_date FROM lineitem WHERE l_extendedprice > 0 AND l_linenumber <= l_quantity""")
add("rk3_dwd_traffic_clean", """
SELECT l_partkey AS goods_id, l_returnflag AS traffic_source, l_quantity * l_linenumber + 10 AS visitor_num,
 b.n::DOUBLE / (l_quantity * l_linenumber + 10) AS pay_conver_rate, CAST(l_shipdate AS DATE) AS visit_date
FROM lineitem l JOIN (SELECT l_partkey AS pk, l_shipdate AS sd, sum(l_linenumber) AS n FROM lineitem GROUP BY 1, 2) b ON l_partkey = pk AND l_shipdate = sd""")
add("rk4_dws_sales_sum", "SELECT * FROM goods_days")
add("rk5_dws_price_strength_sum", """SELECT category_name, count(*) FILTER (star >= 4) AS excellent_num, count(*) FILTER (star <= 2) AS poor_num,
 record_date AS stat_date FROM stars GROUP BY category_name, record_date""")
add("rk6_ads_all_goods_rank", "SELECT *, row_number() OVER (ORDER BY total_sales DESC, goods_id, stat_date) AS rank FROM goods_days")
add("rk7_ads_price_warning", "SELECT goods_id, goods_name, '持续低星商品' AS warn_reason, record_date AS warn_date FROM stars WHERE star <= 2")

# ---------------------------------------------------------------- change capture and security
# The alarm flags of a position report, in message order.
ALARMS = """terminalLcdError earlyWarning terminalMainPowerUnderVoltage inOutRoute oilError overSpeed emergencyAlarm rolloverWarning
illegalMove inOutArea gnssAntennaDisconnect laneDepartureError stopTimeout vssError ttsModuleError fatigueDriving gnssAntennaShortCircuit
collisionRollover overspeedWarning cameraError illegalIgnition roadDrivingTimeout icModuleError banOnDrivingWarning stolen gnssModuleError
cumulativeDrivingTimeout terminalMainPowerFailure driverFatigueMonitor""".split()
add("c1_cdc_current_state", """
SELECT user_id AS id, event_type AS state, value AS balance FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts) DESC, event_id DESC) AS rn FROM ev)
WHERE rn = 1 AND event_type <> 'error'""")
FLAGS = " || ',' || ".join(f"""'"{a}":' || CASE WHEN k = {i} THEN 1 ELSE 0 END""" for i, a in enumerate(ALARMS))
add("c2_column_round_trip", f"""
SELECT event_id, '{{"UPEXGMSGREALLOCATION":{{"dateTime":"' || strftime(ts, '%Y%m%d%H%M%S') || '","altitude":' || (k * 2) || ',"vec3":' || event_id
 || ',"alarm":{{' || {FLAGS} || '}},"msgId":4610,"encrypy":0,"vec2":' || k || ',"vec1":' || k
 || ',"lon":' || CAST(114 + CAST(k AS DECIMAL(9,6)) / 100 AS DECIMAL(9,6)) || ',"state":{{"acc":' || CASE WHEN event_type = 'click' THEN 1 ELSE 0 END
 || ',"door":' || CASE WHEN event_type = 'view' THEN 1 ELSE 0 END || '}},"lat":' || CAST(22 + CAST(k AS DECIMAL(9,6)) / 100 AS DECIMAL(9,6))
 || ',"direction":' || (k * 3) || '}},"DATATYPE":4610,"VEHICLENO":"V' || user_id || '","VEHICLECOLOR":2}}' AS payload FROM ev""")
add("c3_telemetry", f"""
SELECT event_id, 'V' || user_id AS vehicle_no, {stamp('ts')} AS report_time, 114 + k / 100 AS lon, 22 + k / 100 AS lat, k * 2 AS altitude, k * 3 AS direction,
 CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS acc, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS door,
 CASE WHEN k < 29 THEN [{', '.join(f"'{a}'" for a in ALARMS)}][k + 1] ELSE '' END AS alarms FROM ev""")

# what loads leave behind is the whole table
for name, of in {
    "l16_late_rows_load": "l16_dwd_deliver_suc", "l16_corrected_day_load": "l16_dwd_deliver_suc",
    "l18_two_day_load": "l18_dwd_order_process", "l18_three_day_load": "l18_dwd_order_process",
    "e15_two_day_load": "e15_dwd_trade_flow", "e15_three_day_load": "e15_dwd_trade_flow",
    "l11_two_day_load": "l11_dwd_pay_suc", "l13_two_day_load": "l13_dwd_receive", "l42_rerun_load": "l42_ads_city_stats",
    "e36_from_daily_states": "e36_ads_order_by_category", "e37_from_daily_states": "e37_ads_order_by_brand",
}.items():
    add(name, BODIES[of])

# three daily snapshots: new rows on the second, changes on the second and third
for name, of, changing in (("e8_three_snapshots_load", "e8_dim_user_zip", "user_level"), ("l8_three_snapshots_load", "l8_dim_user_zip", "user_level"),
                           ("l9_three_snapshots_load", "l9_dim_user_address_zip", "address")):
    add(name, f"""
SELECT s.* REPLACE (coalesce(CAST(s.{changing} AS VARCHAR), '') || v.mark AS {changing}, strftime({EVENT_DAY} + greatest(v.since, a.seen), '%Y-%m-%d') AS start_date,
 CASE WHEN v.until IS NULL THEN '9999-12-31' ELSE strftime({EVENT_DAY} + v.until, '%Y-%m-%d') END AS end_date)
FROM ({BODIES[of]}) s
JOIN (SELECT 0 AS seen, false AS late UNION ALL SELECT 1, true) a ON (s.id % 7 = 0) = a.late
JOIN (VALUES (1, 0, NULL, ''), (3, 0, 0, ''), (3, 1, NULL, '+'), (6, 0, 0, ''), (6, 1, 1, '+'), (6, 2, NULL, '++')) AS v(kind, since, until, mark)
 ON v.kind = CASE WHEN s.id % 6 = 0 THEN 6 WHEN s.id % 3 = 0 THEN 3 ELSE 1 END
WHERE v.until IS NULL OR v.until >= a.seen""")

# landing files: every raw row comes back
add("dt1_ods_discount_activity", """
SELECT DISTINCT 'act_' || p_size AS activity_id, 'Activity ' || p_size AS activity_name, CASE WHEN p_size < 20 THEN 'product' ELSE 'shop' END AS activity_level,
 CASE WHEN p_size <= 25 THEN '固定优惠' ELSE '自定义优惠' END AS discount_type, p_size * 2 AS max_discount_amount, '2024-01-01 00:00:00' AS start_time,
 '2024-12-31 00:00:00' AS end_time, 'on' AS status, '2023-12-01 00:00:00' AS create_time, '2023-12-02 00:00:00' AS update_time,
 CASE WHEN p_size <= 45 THEN 1 ELSE 0 END AS is_valid FROM part""")
add("dt1_ods_product_relation", """
SELECT 'rel_' || p_partkey AS rel_id, 'act_' || p_size AS activity_id, p_partkey AS product_id, 'sku_' || p_partkey AS sku_id, p_size + 5 AS fixed_discount,
 p_size * 3 AS max_buy_count, '2024-01-01 08:00:00' AS add_time, CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END AS is_delete FROM part""")
add("mm1_ods_favourite_cart", "SELECT * FROM adds")
add("mm2_ods_product", """SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category_id, lower(p_type) AS category_name,
 CAST(p_retailprice AS DECIMAL(10,2)) AS product_price, '2024-01-01' AS update_date FROM part""")
add("rk1_ods_goods_base", """SELECT p_partkey AS goods_id, p_name AS goods_name, p_size AS category_id, p_type AS category_name, p_brand AS shop_id,
 CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS is_price_strength FROM part""")
add("rk1_ods_goods_sales", """SELECT l_partkey AS goods_id, 'sku_' || l_partkey AS sku_id, l_extendedprice AS pay_amount, CAST(l_quantity AS INTEGER) AS sales_num,
 l_linenumber AS pay_buyer_num, strftime(l_shipdate, '%Y-%m-%d') AS pay_date FROM lineitem""")
add("rk1_ods_goods_traffic", """SELECT l_partkey AS goods_id, l_returnflag AS traffic_source, CAST(l_quantity * l_linenumber + 10 AS INTEGER) AS visitor_num,
 strftime(l_shipdate, '%Y-%m-%d') AS visit_date FROM lineitem""")

# table sources and sinks: what is stored is the buyers' daily totals by month
MONTHLY = f"SELECT t.*, CAST(date_trunc('month', t.dt) AS DATE) AS month FROM ({BODIES['e24_dws_user_order_1d']}) t"
for name in ("s5_read_or_empty_history", "k1_append_by_name", "k2_parquet_at_a_path", "k3_orc_table", "k10_k12_database_and_required_tables", "k11_checked_load"):
    add(name, MONTHLY)
add("s1_partition_scan", f"SELECT * FROM ({MONTHLY}) m WHERE month = date_trunc('month', {DAY})")
add("k9_gained_column", f"SELECT m.* REPLACE (CASE WHEN user_id % 2 = 1 THEN order_total_amount_1d END AS order_total_amount_1d) FROM ({MONTHLY}) m")
add("k13_aligned_and_filled", f"SELECT m.* REPLACE (0 AS order_total_amount_1d) FROM ({MONTHLY}) m")

# a snapshot that hands over to the log leaves what the log alone leaves
add("c1_cdc_snapshot_handover", BODIES["c1_cdc_current_state"])
