"""Raw warehouse tables as SQL over the test tables, in dependency order."""

from layerhouse.plans.shop_dim import AMOUNT_OFF, CASH, NTH_ITEM

RAW: dict[str, str] = {}

LID = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"
CUT = "CAST(CAST(l_discount * 100 AS DECIMAL(4,0)) AS INTEGER)"
TAX = "CAST(CAST(l_tax * 100 AS DECIMAL(4,0)) AS INTEGER)"


def stamp(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S')"


def half_up(top: str, bottom: str, digits: int) -> str:
    """``top / bottom`` rounded half up, in whole numbers: a double quotient may miss a tie."""
    return (f"CASE WHEN ({bottom}) = 0 THEN 0 ELSE ((CAST({top} AS BIGINT) * {2 * 10 ** digits} + ({bottom})) // (2 * ({bottom}))) "
            f"/ {10 ** digits}.0 END")


RAW["base_dic"] = """SELECT * FROM (VALUES ('11','1101','card'), ('11','1102','wallet'),
 ('31','3101','amount off'), ('31','3102','nth item'), ('31','3103','discount'),
 ('32','3201','amount off'), ('32','3202','nth item'), ('32','3203','cash'),
 ('33','3301','category'), ('33','3302','brand')) t(parent_code, dic_code, dic_name)"""
RAW["tms_dic"] = """SELECT CAST(id AS VARCHAR) AS id, name FROM (VALUES
 (60010,'placed'), (60020,'paid'), (60030,'received'), (60040,'loaded'), (60050,'dispatched'),
 (60060,'line-haul done'), (60070,'delivered'), (60080,'closed'), (60999,'cancelled'),
 (71001,'parcel'), (71002,'freight'), (71003,'fragile'), (72001,'door'), (72002,'counter'),
 (73001,'prepaid'), (73002,'on delivery'), (73003,'monthly'), (74001,'inner city'), (74002,'suburban'),
 (75001,'trunk'), (75002,'branch'), (76001,'box'), (76002,'flat'), (77001,'north'), (77002,'south')) t(id, name)"""

# ---------------------------------------------------------------- e-commerce
RAW["province"] = """SELECT n_nationkey AS id, n_name AS province_name, '0' || n_nationkey AS area_code,
 'P-' || n_nationkey AS iso_code, 'XX-' || n_nationkey AS iso_3166_2, n_regionkey AS region_id, r_name AS region_name
 FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""
RAW["sku"] = """SELECT p_partkey AS id, p_name AS sku_name, p_size AS category3_id, 'size ' || p_size AS category3_name,
 p_size // 10 AS category2_id, 'band ' || (p_size // 10) AS category2_name,
 CASE WHEN p_size < 30 THEN 1 ELSE 2 END AS category1_id,
 'group ' || CASE WHEN p_size < 30 THEN 1 ELSE 2 END AS category1_name,
 p_brand AS tm_id, upper(p_brand) AS tm_name, p_type, p_retailprice FROM part"""
RAW["coupon"] = f"""SELECT id, 'coupon ' || id AS coupon_name, CASE WHEN id <= 2 THEN '3201' WHEN id <= 5 THEN '3202' ELSE '3203' END AS coupon_type,
 CASE WHEN id <= 2 THEN 'amount off' WHEN id <= 5 THEN 'nth item' ELSE 'cash' END AS coupon_type_name,
 CAST(id * 100 AS DECIMAL(16,2)) AS condition_amount, id AS condition_num, id AS activity_id,
 CAST(id * 2 AS DECIMAL(16,2)) AS benefit_amount, CAST(id AS DECIMAL(16,2)) AS benefit_discount,
 CASE WHEN id <= 2 THEN '{AMOUNT_OFF[0]}' || CAST(id * 100 AS DECIMAL(16,2)) || '{AMOUNT_OFF[1]}' || CAST(id * 2 AS DECIMAL(16,2)) || '{AMOUNT_OFF[2]}'
      WHEN id <= 5 THEN '{NTH_ITEM[0]}' || id || '{NTH_ITEM[1]}' || CAST(id AS DECIMAL(16,2)) || '{NTH_ITEM[2]}'
      ELSE '{CASH[0]}' || CAST(id * 2 AS DECIMAL(16,2)) || '{CASH[1]}' END AS benefit_rule,
 CASE WHEN id <= 4 THEN '3301' ELSE '3302' END AS range_type, CASE WHEN id <= 4 THEN 'category' ELSE 'brand' END AS range_type_name
 FROM (SELECT DISTINCT {TAX} AS id FROM lineitem)"""
RAW["shop_orders"] = """SELECT o_orderkey AS id, o_custkey AS user_id, c_nationkey AS province_id, o_orderdate AS create_time,
 CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount, o_orderstatus AS status
 FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""
RAW["lines"] = f"""SELECT {LID} AS id, l_orderkey AS order_id, l_partkey AS sku_id, o_orderdate AS create_time,
 CAST(o_orderdate AS DATE) AS dt, CAST(l_quantity AS BIGINT) AS sku_num,
 CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_quantity AS DECIMAL(4,0)) AS original,
 CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_quantity AS DECIMAL(4,0)) * CAST(l_discount AS DECIMAL(4,2)) AS activity,
 CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_quantity AS DECIMAL(4,0)) * CAST(l_tax AS DECIMAL(4,2)) AS coupon,
 CASE WHEN l_discount > 0 THEN {CUT} END AS activity_id,
 CASE WHEN l_discount > 0 THEN {CUT} * 10 + l_linenumber END AS activity_rule_id,
 CASE WHEN l_tax > 0 THEN {TAX} END AS coupon_id FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""
RAW["promoted"] = """SELECT l.id, a.activity_id, a.activity_rule_id, c.coupon_id FROM
 (SELECT id FROM lines) l LEFT JOIN (SELECT id, activity_id, activity_rule_id FROM lines WHERE activity_id IS NOT NULL) a USING (id)
 LEFT JOIN (SELECT id, coupon_id FROM lines WHERE coupon_id IS NOT NULL) c USING (id)"""
RAW["order_line"] = """SELECT l.*, l.original - l.activity - l.coupon AS total, o.user_id, o.province_id
 FROM lines l LEFT JOIN shop_orders o ON l.order_id = o.id"""
RAW["payment"] = """SELECT o_custkey AS user_id, o_orderkey AS order_id,
 CASE WHEN o_totalprice < 250000 THEN '1101' ELSE '1102' END AS payment_type,
 CASE WHEN o_totalprice < 250000 THEN 'card' ELSE 'wallet' END AS payment_type_name,
 o_orderdate + to_hours(CAST(trunc(o_totalprice / 10000) AS INTEGER)) AS callback_time,
 CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount FROM orders WHERE o_orderstatus = 'F'"""
RAW["pay_line"] = """SELECT l.*, l.original - l.activity - l.coupon AS total, p.user_id, p.payment_type, p.payment_type_name,
 p.callback_time, CAST(p.callback_time AS DATE) AS paid_day FROM lines l JOIN payment p ON l.order_id = p.order_id"""
RAW["coupon_used"] = f"""SELECT {LID} AS id, {TAX} AS coupon_id, o_custkey AS user_id, o_orderkey AS order_id,
 CAST(o_orderdate AS DATE) AS dt FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_tax > 0"""
RAW["ev"] = """SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(16,2)) AS value,
 CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(ts AS DATE) AS dt FROM events"""
RAW["pages_seen"] = f"""SELECT CAST(user_id % 25 AS VARCHAR) AS province_id, 'brand' || (user_id % 3) AS brand, 'ch' || (k % 5) AS channel,
 CASE WHEN value < 5 THEN '1' ELSE '0' END AS is_new, 'model' || (user_id % 7) AS model, 'mid' || user_id AS mid_id,
 CASE WHEN user_id % 2 = 0 THEN 'ios' ELSE 'android' END AS operate_system,
 CASE WHEN value >= 2 THEN CAST(user_id AS VARCHAR) END AS user_id, 'v' || (user_id % 4) AS version_code,
 user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
 event_id, CAST(event_id AS VARCHAR) AS page_item, 'event' AS page_item_type, NULL AS last_page_id,
 CASE event_type WHEN 'signup' THEN 'register' WHEN 'click' THEN 'cart' WHEN 'purchase' THEN 'payment'
  ELSE CASE WHEN k < 50 THEN 'home' ELSE 'good_detail' END END AS page_id,
 CAST(k % 10 AS VARCHAR) AS from_pos_id, CAST(k % 4 AS VARCHAR) AS from_pos_seq, CAST(k % 6 AS VARCHAR) AS refer_id,
 CAST(value * 100 AS BIGINT) AS during_time, ts, CAST(ts + INTERVAL 8 HOUR AS DATE) AS dt,
 {stamp("ts + INTERVAL 8 HOUR")} AS view_time FROM ev WHERE event_type <> 'error'"""
RAW["logins"] = """SELECT user_id, dt, view_time AS login_time, channel, province_id, version_code, mid_id, brand, model, operate_system
 FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY epoch_ms(ts), event_id) AS rn
       FROM pages_seen WHERE user_id IS NOT NULL) WHERE rn = 1"""
RAW["users"] = """SELECT c_custkey AS id, c_name AS name, CASE WHEN c_acctbal < 0 THEN '120' ELSE '138' END || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS phone_num,
 CASE WHEN c_mktsegment = 'BUILDING' THEN 'user' || c_custkey ELSE 'user' || c_custkey || '@mail.example.com' END AS email,
 CAST(c_nationkey AS VARCHAR) AS user_level, CAST(c_custkey % 15000 AS VARCHAR) AS birthday,
 CASE WHEN c_acctbal > 5000 THEN 'F' ELSE 'M' END AS gender, TIMESTAMP '2024-01-01 05:00:00' + to_days(c_nationkey) AS create_time,
 lower(c_name) AS login_name, c_mktsegment AS nick_name, 'pw' || c_custkey AS passwd, c_acctbal FROM customer"""
RAW["login_td_today"] = """SELECT u.id AS user_id, coalesce(l.last_day, CAST(u.create_time AS DATE)) AS login_date_last,
 CAST(u.create_time AS DATE) AS login_date_first, coalesce(l.n, 1) AS login_count_td FROM users u LEFT JOIN
 (SELECT CAST(user_id AS BIGINT) AS user_id, max(dt) AS last_day, count(*) AS n FROM logins WHERE dt <= DATE '2024-01-30' GROUP BY 1) l
 ON u.id = l.user_id WHERE CAST(u.create_time AS DATE) <= DATE '2024-01-30'"""
RAW["login_td_before"] = RAW["login_td_today"].replace("2024-01-30", "2024-01-29")
RAW["user_sku_days"] = """SELECT user_id, sku_id, dt, count(*) AS order_count_1d, sum(sku_num) AS order_num_1d, sum(original) AS order_original_amount_1d,
 sum(activity) AS activity_reduce_amount_1d, sum(coupon) AS coupon_reduce_amount_1d, sum(total) AS order_total_amount_1d
 FROM order_line GROUP BY user_id, sku_id, dt"""
RAW["province_days"] = """SELECT province_id, dt, count(DISTINCT order_id) AS order_count, sum(original) AS original, sum(activity) AS activity,
 sum(coupon) AS coupon, sum(total) AS total FROM order_line GROUP BY province_id, dt"""

# ---------------------------------------------------------------- logistics
RAW["region_info"] = """SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, NULL AS parent_id, r_name AS name, 'province' AS dict_code FROM region
 UNION ALL SELECT n_nationkey + 100, n_regionkey + 1, n_name, 'city' FROM nation
 UNION ALL SELECT s_suppkey + 10000, s_nationkey + 100, s_name, 'district' FROM supplier"""
RAW["organ"] = """SELECT s_suppkey AS id, 'Org ' || s_name AS org_name, CASE WHEN s_acctbal > 5000 THEN 1 ELSE 2 END AS org_level,
 CASE WHEN s_acctbal > 5000 THEN s_nationkey + 100 ELSE s_suppkey + 10000 END AS region_id,
 CASE WHEN s_acctbal > 5000 THEN NULL ELSE s_suppkey - 1 END AS org_parent_id FROM supplier"""
RAW["org_place"] = """SELECT o.id AS org_id, o.org_name, o.org_level, own.id AS own_id, own.name AS own_name, up.id AS up_id, up.name AS up_name,
 top.id AS top_id, top.name AS top_name,
 CASE WHEN o.org_level = 1 THEN own.id ELSE up.id END AS city_id, CASE WHEN o.org_level = 1 THEN own.name ELSE up.name END AS city_name,
 CASE WHEN o.org_level = 1 THEN up.id ELSE top.id END AS province_id, CASE WHEN o.org_level = 1 THEN up.name ELSE top.name END AS province_name
 FROM organ o LEFT JOIN region_info own ON o.region_id = own.id LEFT JOIN region_info up ON own.parent_id = up.id
 LEFT JOIN region_info top ON up.parent_id = top.id"""
RAW["waybill_info"] = f"""SELECT o_orderkey AS info_id, 'NO' || o_orderkey AS order_no,
 CASE o_orderstatus
  WHEN 'F' THEN CASE WHEN p <= 2 THEN '60080' WHEN p <= 4 THEN '60070' ELSE '60999' END
  WHEN 'O' THEN CASE WHEN p = 1 THEN '60010' WHEN p <= 3 THEN '60020' ELSE '60030' END
  ELSE CASE WHEN p <= 2 THEN '60040' WHEN p <= 4 THEN '60050' ELSE '60060' END END AS status,
 CASE WHEN o_totalprice < 200000 THEN '72001' ELSE '72002' END AS collect_type, o_custkey AS user_id,
 o_orderkey % 50 AS receiver_complex_id, 1 AS receiver_province_id, 100 + o_orderkey % 25 AS receiver_city_id,
 10000 + o_orderkey % 1000 AS receiver_district_id, 'R*' AS receiver_name,
 o_custkey % 50 AS sender_complex_id, 2 AS sender_province_id, 100 + o_custkey % 25 AS sender_city_id,
 10000 + o_custkey % 1000 AS sender_district_id, 'S*' AS sender_name,
 CASE WHEN o_totalprice < 100000 THEN '73001' WHEN o_totalprice < 300000 THEN '73002' ELSE '73003' END AS payment_type,
 p AS cargo_num, CAST(o_totalprice AS DECIMAL(16,2)) AS amount, {stamp("o_orderdate + INTERVAL 2 DAY")} AS estimate_arrive_time,
 CAST(o_totalprice AS DECIMAL(16,2)) * 0.01 AS distance, o_orderdate + INTERVAL 30 HOUR AS update_time
 FROM (SELECT *, CAST(o_orderpriority[1] AS INTEGER) AS p FROM orders)"""
RAW["cargo"] = f"""SELECT {LID} AS id, l_orderkey AS order_id,
 CASE l_returnflag WHEN 'A' THEN '71001' WHEN 'N' THEN '71002' ELSE '71003' END AS cargo_type,
 l_linenumber AS volume_length, l_linenumber * 2 AS volume_width, l_linenumber * 3 AS volume_height,
 CAST(l_quantity AS DECIMAL(16,2)) AS weight, l_shipdate + INTERVAL 9 HOUR AS order_stamp FROM lineitem WHERE l_tax < 0.08"""
RAW["waybill"] = f"""SELECT c.*, i.*, ct.name AS cargo_type_name, st.name AS status_name, co.name AS collect_type_name, pt.name AS payment_type_name,
 {stamp("c.order_stamp")} AS order_time, {stamp("i.update_time")} AS reached_time,
 CAST(c.order_stamp AS DATE) AS order_day, CAST(i.update_time AS DATE) AS reached_day
 FROM cargo c JOIN waybill_info i ON c.order_id = i.info_id LEFT JOIN tms_dic ct ON c.cargo_type = ct.id
 LEFT JOIN tms_dic st ON i.status = st.id LEFT JOIN tms_dic co ON i.collect_type = co.id LEFT JOIN tms_dic pt ON i.payment_type = pt.id"""
RAW["shift"] = """SELECT s.id, s.id % 50 AS line_id, 'Line ' || (s.id % 50) AS line_name, 'L' || (s.id % 50) AS line_no,
 CASE WHEN s.id % 50 < 10 THEN 1 ELSE 2 END AS line_level, (s.id % 50) % 10 AS org_id,
 CASE WHEN s.id % 50 < 25 THEN '75001' ELSE '75002' END AS transport_line_type_id,
 CASE WHEN s.id % 50 < 25 THEN 'trunk' ELSE 'branch' END AS transport_line_type_name,
 s.id % 50 AS start_org_id, 'Org ' || (s.id % 50) AS start_org_name, s.id % 50 + 1 AS end_org_id, 'Org ' || (s.id % 50 + 1) AS end_org_name,
 49 - s.id % 50 AS pair_line_id, CAST((s.id % 50) * 10 AS DECIMAL(10,2)) AS distance, CAST((s.id % 50) * 7 AS DECIMAL(10,2)) AS cost,
 (s.id % 50) * 10 AS estimated_time, '08:00' AS start_time, s.id * 10 + 1 AS driver1_emp_id, s.id * 10 + 2 AS driver2_emp_id,
 s.id % 10 AS truck_id, 199 - s.id AS pair_shift_id FROM (SELECT DISTINCT p_partkey % 200 AS id FROM part) s
 JOIN (SELECT DISTINCT p_partkey % 50 AS line FROM part) l ON s.id % 50 = l.line"""
RAW["truck_type"] = """SELECT s_suppkey AS id, CASE WHEN s_suppkey % 8 < 4 THEN '76001' ELSE '76002' END AS truck_model_type,
 CASE WHEN s_suppkey % 8 < 4 THEN 'box' ELSE 'flat' END AS truck_model_type_name FROM supplier"""
RAW["trips"] = f"""SELECT {LID} AS id, l_partkey % 200 AS shift_id, (l_partkey % 200) % 50 AS line_id, l_suppkey AS start_org_id,
 'Org Supplier ' || l_suppkey AS start_org_name, l_suppkey + 1 AS end_org_id, 'Org Supplier ' || (l_suppkey + 1) AS end_org_name,
 CAST(l_linenumber AS BIGINT) AS order_num, l_suppkey * 10 + 1 AS driver1_emp_id, 'A*' AS driver1_name,
 CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey * 10 + 2 END AS driver2_emp_id, CASE WHEN l_linenumber % 2 = 0 THEN 'B*' END AS driver2_name,
 l_suppkey AS truck_id, md5('TRK' || l_suppkey) AS truck_no, l_shipdate + to_hours(l_linenumber) AS t0,
 l_shipdate + to_hours(l_linenumber) + to_minutes(CAST(l_quantity * 10 AS INTEGER)) AS t1,
 s.id IS NOT NULL AS known, l_shipdate + to_hours(l_linenumber) + to_minutes(s.estimated_time) AS due,
 CAST(l_quantity AS DECIMAL(16,2)) AS actual_distance, CAST(l_quantity * 600 AS BIGINT) AS finish_dur_sec
 FROM lineitem LEFT JOIN shift s ON l_partkey % 200 = s.id WHERE l_linestatus = 'F'"""
RAW["cargo_days"] = """SELECT o.id AS org_id, o.org_name, w.sender_city_id AS city_id, r.name AS city_name, w.cargo_type, w.cargo_type_name,
 count(*) AS order_count, sum(w.amount) AS order_amount, w.dt FROM
 (SELECT order_id, cargo_type, cargo_type_name, sender_district_id, sender_city_id, order_day AS dt, max(amount) AS amount FROM waybill GROUP BY ALL) w
 LEFT JOIN organ o ON w.sender_district_id = o.region_id LEFT JOIN region_info r ON w.sender_city_id = r.id GROUP BY ALL"""
RAW["receive_days"] = """SELECT o.org_id, o.org_name, o.up_id AS city_id, o.up_name AS city_name, o.top_id AS province_id, o.top_name AS province_name,
 count(*) AS order_count, sum(w.amount) AS order_amount, w.dt FROM
 (SELECT order_id, sender_district_id, reached_day AS dt, max(amount) AS amount FROM waybill WHERE status = '60030' GROUP BY ALL) w
 LEFT JOIN org_place o ON w.sender_district_id = o.own_id AND o.org_level = 2 GROUP BY ALL"""
RAW["dispatch_days"] = """SELECT count(*) AS order_count, sum(amount) AS order_amount, dt FROM
 (SELECT order_id, reached_day AS dt, max(amount) AS amount FROM waybill WHERE status = '60050' GROUP BY ALL) GROUP BY dt"""
RAW["finish_total"] = """SELECT count(*) AS order_count, sum(amount) AS order_amount FROM
 (SELECT order_id, max(amount) AS amount FROM waybill WHERE status = '60060' AND reached_day <= DATE '2001-12-31' GROUP BY order_id)"""
RAW["deliver_days"] = """SELECT o.org_id, o.org_name, o.up_id AS city_id, o.up_name AS city_name, o.top_id AS province_id, o.top_name AS province_name,
 count(*) AS order_count, w.dt FROM
 (SELECT DISTINCT order_id, receiver_district_id, reached_day AS dt FROM waybill WHERE status IN ('60070', '60080')) w
 LEFT JOIN org_place o ON w.receiver_district_id = o.own_id AND o.org_level = 2 GROUP BY ALL"""
RAW["sort_days"] = """SELECT l_suppkey AS org_id, o.org_name, o.city_id, o.city_name, o.province_id, o.province_name, count(*) AS sort_count,
 CAST(l_shipdate + INTERVAL 2 HOUR AS DATE) AS dt FROM lineitem LEFT JOIN org_place o ON l_suppkey = o.org_id
 WHERE l_returnflag <> 'N' GROUP BY ALL"""
RAW["trip_days"] = """SELECT start_org_id AS org_id, start_org_name AS org_name, truck_model_type, truck_model_type_name, count(*) AS trans_finish_count,
 sum(actual_distance) AS trans_finish_distance, sum(finish_dur_sec) AS trans_finish_dur_sec, CAST(t1 AS DATE) AS dt
 FROM trips LEFT JOIN truck_type t ON truck_id = t.id GROUP BY ALL"""
RAW["span"] = "SELECT unnest([1, 7, 30]) AS recent_days"
RAW["shift_spans"] = """SELECT t.shift_id, o.city_id, o.city_name, t.start_org_id AS org_id, t.start_org_name AS org_name, t.line_id, s.line_name,
 t.driver1_emp_id, t.driver1_name, t.driver2_emp_id, t.driver2_name, t.truck_id, k.truck_model_type, k.truck_model_type_name, recent_days,
 count(*) AS trans_finish_count, sum(t.actual_distance) AS trans_finish_distance, sum(t.finish_dur_sec) AS trans_finish_dur_sec,
 sum(t.order_num) AS trans_finish_order_count, count(*) FILTER (t.t1 > t.due) AS trans_finish_delay_count
 FROM trips t JOIN span ON CAST(t.t1 AS DATE) BETWEEN DATE '1996-06-30' - (recent_days - 1) AND DATE '1996-06-30'
 LEFT JOIN org_place o ON t.start_org_id = o.org_id LEFT JOIN shift s ON t.shift_id = s.id LEFT JOIN truck_type k ON t.truck_id = k.id
 GROUP BY ALL"""
for _days in ("cargo", "receive", "dispatch", "deliver", "sort"):
    RAW[f"{_days}_spans"] = (
        f"SELECT * FROM {_days}_days JOIN span ON dt BETWEEN DATE '1996-06-30' - (recent_days - 1) AND DATE '1996-06-30'"
    )

# ---------------------------------------------------------------- product marts
MEAN_PRICE = half_up("sales_amount * 100", "sales_cnt * 100", 2)
RAW["behaviour"] = """SELECT CAST(k AS VARCHAR) AS product_id, p_type || '_' || p_name AS product_name, p_type AS category,
 count(*) FILTER (event_type IN ('view', 'click', 'signup')) AS traffic_cnt, count(*) FILTER (event_type = 'click') AS click_cnt,
 CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN 0.25::DOUBLE ELSE 0.05::DOUBLE END AS conversion_rate,
 count(*) FILTER (event_type = 'error') AS content_interact_cnt, count(*) FILTER (event_type = 'signup') AS new_user_cnt,
 CASE WHEN max(value) > 40 THEN 0.9::DOUBLE ELSE 0.5::DOUBLE END AS service_rating,
 coalesce(sum(value) FILTER (event_type = 'purchase'), 0) AS sales_amount, count(*) FILTER (event_type = 'purchase') AS sales_cnt,
 count(DISTINCT user_id) AS visitor_cnt, dt AS stat_date FROM ev LEFT JOIN part ON k = p_partkey GROUP BY k, dt, p_type, p_name"""
RAW["rates"] = f"""SELECT * EXCLUDE (category),
 {half_up("click_cnt * 100", "traffic_cnt", 2)} AS click_rate,
 {half_up("content_interact_cnt * 100", "traffic_cnt", 2)} AS content_interact_rate,
 {half_up("new_user_cnt * 100", "visitor_cnt", 2)} AS new_user_rate,
 {MEAN_PRICE} AS avg_price FROM behaviour"""
RAW["activity"] = """SELECT DISTINCT 'act_' || p_size AS activity_id, 'Activity ' || p_size AS activity_name,
 CASE WHEN p_size < 20 THEN 'product' ELSE 'shop' END AS activity_level,
 CASE WHEN p_size <= 25 THEN '固定优惠' ELSE '自定义优惠' END AS discount_type, p_size * 2 AS max_discount_amount,
 'on' AS status FROM part WHERE p_size <= 45"""
RAW["sends"] = f"""SELECT 's' || event_id AS send_id, 'act_' || k AS activity_id, CAST(k AS VARCHAR) AS product_id, 'sku_' || k AS sku_id,
 'c' || user_id AS customer_id, 'serv_' || (user_id % 10) AS service_id, CAST(floor(value) AS INTEGER) AS send_discount_amount,
 k % 24 + 1 AS validity_period, {stamp("ts")} AS send_time, {stamp("ts + to_hours(CAST(k % 24 + 1 AS INTEGER))")} AS expire_time,
 'sent' AS remark, dt FROM ev WHERE event_type = 'click'"""
RAW["verified"] = f"""SELECT 'v' || event_id AS verify_id, 's' || (event_id - 1) AS send_id, 'o' || event_id AS order_id, value AS pay_amount,
 {stamp("ts")} AS verify_time, k % 5 + 1 AS buy_count, s.send_discount_amount, s.customer_id, s.service_id, s.product_id, s.activity_id, e.dt
 FROM ev e LEFT JOIN sends s ON 's' || (e.event_id - 1) = s.send_id WHERE event_type = 'purchase'"""
RAW["activity_days"] = """SELECT x.*, a.activity_name, a.status, a.discount_type FROM
 (SELECT activity_id, dt, sum(sc) AS daily_send_count, sum(sa) AS daily_send_amount, sum(vc) AS daily_verify_count,
  sum(va) AS daily_verify_amount, sum(bc) AS daily_buy_count, count(DISTINCT customer) AS daily_pay_customer_count FROM
  (SELECT a.activity_id, s.dt, CASE WHEN s.send_id IS NULL THEN 0 ELSE 1 END AS sc, coalesce(s.send_discount_amount, 0) AS sa, 0 AS vc, 0 AS va, 0 AS bc, NULL AS customer
   FROM activity a LEFT JOIN sends s ON a.activity_id = s.activity_id
   UNION ALL SELECT activity_id, dt, 0, 0, 1, pay_amount, buy_count, customer_id FROM verified) GROUP BY activity_id, dt) x
 LEFT JOIN activity a ON x.activity_id = a.activity_id"""
RAW["agent_days"] = """SELECT service_id, dt, sum(sc) AS send_count, sum(sa) AS send_amount, sum(vc) AS pay_count, sum(va) AS pay_amount FROM
 (SELECT service_id, dt, 1 AS sc, send_discount_amount AS sa, 0 AS vc, 0 AS va FROM sends
  UNION ALL SELECT service_id, dt, 0, 0, 1, pay_amount FROM verified) GROUP BY service_id, dt"""
RAW["visits"] = f"""SELECT CAST(event_id AS VARCHAR) AS visit_id, 'u' || user_id AS user_id, CAST(k AS VARCHAR) AS product_id, p_type AS category_id,
 {stamp("ts")} AS visit_time, CASE WHEN user_id % 2 = 0 THEN 'app' ELSE 'web' END AS terminal, CAST(floor(value) AS INTEGER) AS stay_time,
 CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS is_click, dt FROM ev LEFT JOIN part ON k = p_partkey WHERE event_type IN ('view', 'click')"""
RAW["adds"] = f"""SELECT CAST(event_id AS VARCHAR) AS record_id, 'u' || user_id AS user_id, CAST(k AS VARCHAR) AS product_id, p_type AS category_id,
 CASE WHEN event_type = 'signup' THEN '收藏' ELSE '加购' END AS op_type, {stamp("ts")} AS op_time,
 CASE WHEN event_type = 'error' THEN k % 3 + 1 END AS add_cart_count, CASE WHEN user_id % 2 = 0 THEN 'app' ELSE 'web' END AS terminal, dt
 FROM ev LEFT JOIN part ON k = p_partkey WHERE event_type IN ('signup', 'error')"""
RAW["trades"] = f"""SELECT CAST(event_id AS VARCHAR) AS order_id, 'u' || user_id AS user_id, CAST(k AS VARCHAR) AS product_id, p_type AS category_id,
 value AS product_price, k % 4 + 1 AS buy_count, value * (k % 4 + 1) AS buy_amount, CASE WHEN value >= 10 THEN '已支付' ELSE '未支付' END AS pay_status,
 CASE WHEN value >= 10 THEN {stamp("ts")} END AS pay_time, CASE WHEN value >= 10 THEN value * (k % 4 + 1) END AS pay_amount,
 CASE WHEN user_id % 2 = 0 THEN 'app' ELSE 'web' END AS terminal, {stamp("ts")} AS create_time, dt
 FROM ev LEFT JOIN part ON k = p_partkey WHERE event_type = 'purchase'"""
RAW["product_days"] = """SELECT product_id, category_id, dt, count(DISTINCT user_id) FILTER (f = 'v') AS visitor_count, count(*) FILTER (f = 'v') AS view_count,
 CAST(sum(stay_time) AS DOUBLE) / count(stay_time) AS avg_stay_time,
 CASE WHEN count(DISTINCT user_id) FILTER (f = 'v') = 0 THEN 0 ELSE count(*) FILTER (f = 'v' AND is_click = 0)::DOUBLE / count(DISTINCT user_id) FILTER (f = 'v') END AS bounce_rate,
 count(*) FILTER (op_type = '收藏') AS favorite_user_count, coalesce(sum(add_cart_count) FILTER (op_type = '加购'), 0) AS add_to_cart_quantity,
 count(*) FILTER (op_type = '加购') AS add_to_cart_user_count, count(*) FILTER (f = 't') AS order_user_count,
 coalesce(sum(buy_count), 0) AS order_quantity, coalesce(sum(buy_amount), 0) AS order_amount, count(*) FILTER (pay_status = '已支付') AS pay_user_count,
 coalesce(sum(buy_count) FILTER (pay_status = '已支付'), 0) AS pay_quantity, coalesce(sum(pay_amount) FILTER (pay_status = '已支付'), 0) AS pay_amount,
 count(DISTINCT user_id) FILTER (f = 't') AS buyer_count FROM
 (SELECT 'v' AS f, * FROM visits UNION ALL BY NAME SELECT 'a' AS f, * FROM adds UNION ALL BY NAME SELECT 't' AS f, * FROM trades)
 GROUP BY product_id, category_id, dt"""
RAW["product_report"] = """SELECT d.dt AS statistical_time, d.*, p_name AS product_name, lower(p_type) AS category_name,
 CASE WHEN visitor_count = 0 THEN 0 ELSE favorite_user_count::DOUBLE / visitor_count END AS visit_to_collect_rate,
 CASE WHEN visitor_count = 0 THEN 0 ELSE add_to_cart_user_count::DOUBLE / visitor_count END AS visit_to_add_to_cart_rate,
 CASE WHEN visitor_count = 0 THEN 0 ELSE order_user_count::DOUBLE / visitor_count END AS order_conversion_rate,
 CASE WHEN visitor_count = 0 THEN 0 ELSE pay_user_count::DOUBLE / visitor_count END AS payment_conversion_rate,
 CASE WHEN pay_user_count = 0 THEN 0 ELSE CAST(pay_amount AS DOUBLE) / pay_user_count END AS avg_order_value,
 CASE WHEN visitor_count = 0 THEN 0 ELSE CAST(pay_amount AS DOUBLE) / visitor_count END AS avg_visitor_value
 FROM product_days d LEFT JOIN part ON d.product_id = CAST(p_partkey AS VARCHAR) WHERE d.dt = DATE '2024-01-30'"""
RAW["goods_days"] = """SELECT CAST(l_partkey AS VARCHAR) AS goods_id, p_type AS category_name, p_name AS goods_name, CAST(l_shipdate AS DATE) AS stat_date,
 sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS total_sales, sum(CAST(l_quantity AS INTEGER)) AS total_sales_num
 FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE l_extendedprice > 0 AND l_linenumber <= l_quantity GROUP BY ALL"""
RAW["stars"] = """SELECT CAST(l_partkey AS VARCHAR) AS goods_id, p_name AS goods_name, p_type AS category_name, CAST(l_shipdate AS DATE) AS record_date,
 least(max(l_linenumber), 5) AS star FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY ALL"""
