"""The raw (ODS) tables the plans read, as views over the star-schema test tables.

A deployment binds these attributes to its own tables (``layerhouse.jobs.Stored``); the plans do
not change.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layerhouse.plans.discount import CUSTOM_DISCOUNT, FIXED_DISCOUNT
from layerhouse.plans.macro import ADD_TO_CART, FAVOURITE, PAID
from layerhouse.plans.security import ALARMS

# Run dates of the reports over each group of facts.
ORDER_DAY = dt.date(1996, 6, 30)
EVENT_DAY = dt.date(2024, 1, 30)
LAST_DAY = dt.date(2001, 12, 31)
UNPAID = "未支付"


def money(name: str, kind: str = "decimal(16,2)") -> Column:
    return F.col(name).cast(kind)


def numbered_text(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def code(column: Column, pairs: dict[str, str], default: str | None = None) -> Column:
    out = F.lit(default)
    for key, value in pairs.items():
        out = F.when(column == key, value).otherwise(out)
    return out


def iso(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")


class Warehouse:
    """Raw tables, plus the run dates of reports over orders, events and everything to date."""

    def __init__(
        self, spark: SparkSession, folder: str, order_day: dt.date = ORDER_DAY,
        event_day: dt.date = EVENT_DAY, last_day: dt.date = LAST_DAY,
    ):
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            raise ValueError("business days are days in UTC: build the session with layerhouse.session")
        self.spark = spark
        self.folder = folder
        self.order_day, self.event_day, self.last_day = order_day, event_day, last_day

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def values(self, rows: list[tuple], names: str) -> DataFrame:
        """A small inline table whose size the optimizer knows."""
        return self.spark.sql(f"SELECT * FROM VALUES {', '.join(map(repr, rows))} AS t({names})")

    # ------------------------------------------------------------ dictionaries
    @cached_property
    def base_dic(self) -> DataFrame:
        """(parent_code, dic_code, dic_name): activity, coupon, range and payment types."""
        rows = [
            ("11", "1101", "card"), ("11", "1102", "wallet"),
            ("31", "3101", "amount off"), ("31", "3102", "nth item"), ("31", "3103", "discount"),
            ("32", "3201", "amount off"), ("32", "3202", "nth item"), ("32", "3203", "cash"),
            ("33", "3301", "category"), ("33", "3302", "brand"),
        ]
        return self.values(rows, "parent_code, dic_code, dic_name")

    @cached_property
    def tms_dic(self) -> DataFrame:
        """(id, name): waybill status, cargo, collect, payment, courier, line, truck types."""
        rows = [
            (60010, "placed"), (60020, "paid"), (60030, "received"), (60040, "loaded"),
            (60050, "dispatched"), (60060, "line-haul done"), (60070, "delivered"),
            (60080, "closed"), (60999, "cancelled"),
            (71001, "parcel"), (71002, "freight"), (71003, "fragile"),
            (72001, "door"), (72002, "counter"),
            (73001, "prepaid"), (73002, "on delivery"), (73003, "monthly"),
            (74001, "inner city"), (74002, "suburban"),
            (75001, "trunk"), (75002, "branch"),
            (76001, "box"), (76002, "flat"), (77001, "north"), (77002, "south"),
        ]
        return self.values(rows, "id, name")

    # ------------------------------------------------------------ e-commerce
    @cached_property
    def base_region(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").alias("id"), F.col("r_name").alias("region_name")
        )

    @cached_property
    def base_province(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.raw("nation").select(
            key.alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region_id"),
            numbered_text("0", key).alias("area_code"), numbered_text("P-", key).alias("iso_code"),
            numbered_text("XX-", key).alias("iso_3166_2"),
        )

    @cached_property
    def base_trademark(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_brand").alias("id"), F.upper("p_brand").alias("tm_name")
        ).distinct()

    @cached_property
    def base_category3(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_size").alias("id"), numbered_text("size ", F.col("p_size")).alias("name"),
            F.floor(F.col("p_size") / 10).cast("int").alias("category2_id"),
        ).distinct()

    @cached_property
    def base_category2(self) -> DataFrame:
        band = F.floor(F.col("p_size") / 10).cast("int")
        return self.raw("part").select(
            band.alias("id"), numbered_text("band ", band).alias("name"),
            F.when(band < 3, 1).otherwise(2).alias("category1_id"),
        ).distinct()

    @cached_property
    def base_category1(self) -> DataFrame:
        top = F.when(F.floor(F.col("p_size") / 10) < 3, 1).otherwise(2)
        return self.raw("part").select(
            top.alias("id"), numbered_text("group ", top).alias("name")
        ).distinct()

    @cached_property
    def spu_info(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_type").alias("id"), F.lower("p_type").alias("spu_name")
        ).distinct()

    @cached_property
    def sku_info(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("id"), money("p_retailprice").alias("price"),
            F.col("p_name").alias("sku_name"), F.concat_ws(" ", "p_type", "p_name").alias("sku_desc"),
            F.col("p_size").cast("decimal(16,2)").alias("weight"),
            F.when(F.col("p_size") > 5, "1").otherwise("0").alias("is_sale"),
            F.col("p_type").alias("spu_id"), F.col("p_size").alias("category3_id"),
            F.col("p_brand").alias("tm_id"), F.lit("2020-01-01 00:00:00").alias("create_time"),
        )

    @cached_property
    def sku_attr_value(self) -> DataFrame:
        """Colour and noun of the part name as attributes 1 and 2."""
        words = F.split("p_name", " ")
        pairs = F.posexplode(F.array(F.get(words, F.lit(0)), F.get(words, F.lit(1))))
        return self.raw("part").select(F.col("p_partkey").alias("sku_id"), pairs).select(
            "sku_id", (F.col("pos") + 1).alias("attr_id"), F.col("col").alias("value_id"),
            F.when(F.col("pos") == 0, "colour").otherwise("kind").alias("attr_name"),
            F.col("col").alias("value_name"),
        )

    @cached_property
    def sku_sale_attr_value(self) -> DataFrame:
        """The return flags a part was sold under."""
        return self.raw("lineitem").select(
            F.col("l_partkey").alias("sku_id"), F.lit(9).alias("sale_attr_id"),
            F.col("l_returnflag").alias("sale_attr_value_id"), F.lit("flag").alias("sale_attr_name"),
            F.lower("l_returnflag").alias("sale_attr_value_name"),
        )

    @cached_property
    def activity_rule(self) -> DataFrame:
        cut = (F.col("l_discount") * 100).cast("decimal(4,0)").cast("int")
        line = F.col("l_linenumber")
        kinds = self.raw("lineitem").select(cut.alias("cut"), line.alias("line")).distinct()
        return kinds.select(
            (F.col("cut") * 10 + F.col("line")).alias("id"), F.col("cut").alias("activity_id"),
            F.when(F.col("line") <= 2, "3101").when(F.col("line") <= 4, "3102")
            .when(F.col("line") <= 6, "3103").otherwise("3199").alias("activity_type"),
            (F.col("line") * 100).cast("decimal(16,2)").alias("condition_amount"),
            F.col("line").alias("condition_num"),
            (F.col("cut") * 5).cast("decimal(16,2)").alias("benefit_amount"),
            F.col("cut").cast("decimal(16,2)").alias("benefit_discount"),
            F.col("line").alias("benefit_level"),
        )

    @cached_property
    def activity_info(self) -> DataFrame:
        cut = (F.col("l_discount") * 100).cast("decimal(4,0)").cast("int")
        return self.raw("lineitem").select(cut.alias("id")).where(F.col("id") > 0).distinct().select(
            "id", numbered_text("activity ", F.col("id")).alias("activity_name"),
            F.lit("3101").alias("activity_type"), numbered_text("cut ", F.col("id")).alias("activity_desc"),
            F.lit("1995-01-01").alias("start_time"), F.lit("2001-12-31").alias("end_time"),
            F.lit("1994-12-01").alias("create_time"),
        )

    @cached_property
    def coupon_info(self) -> DataFrame:
        tax = (F.col("l_tax") * 100).cast("decimal(4,0)").cast("int")
        c = F.col("id")
        return self.raw("lineitem").select(tax.alias("id")).distinct().select(
            "id", numbered_text("coupon ", c).alias("coupon_name"),
            F.when(c <= 2, "3201").when(c <= 5, "3202").otherwise("3203").alias("coupon_type"),
            (c * 100).cast("decimal(16,2)").alias("condition_amount"), c.alias("condition_num"),
            c.alias("activity_id"), (c * 2).cast("decimal(16,2)").alias("benefit_amount"),
            c.cast("decimal(16,2)").alias("benefit_discount"),
            F.lit("1994-12-01").alias("create_time"),
            F.when(c <= 4, "3301").otherwise("3302").alias("range_type"),
            (c * 1000).alias("limit_num"), (c * 10).alias("taken_count"),
            F.lit("1995-01-01").alias("start_time"), F.lit("2001-12-31").alias("end_time"),
            F.lit("1994-12-02").alias("operate_time"), F.lit("2002-01-31").alias("expire_time"),
        )

    @cached_property
    def promotion_pos(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("pos_location"),
            F.col("n_regionkey").alias("pos_type"), F.lit("banner").alias("promotion_type"),
            F.lit("2020-01-01").alias("create_time"), F.lit("2020-01-02").alias("operate_time"),
        )

    @cached_property
    def promotion_refer(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").alias("id"), F.col("r_name").alias("refer_name"),
            F.lit("2020-01-01").alias("create_time"), F.lit("2020-01-02").alias("operate_time"),
        )

    @cached_property
    def order_info(self) -> DataFrame:
        """Shop orders.  The province is the customer's."""
        total = money("o_totalprice")
        customers = self.raw("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("province_id")
        )
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").cast("timestamp").alias("create_time"),
            total.alias("total_amount"), F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"),
        )
        return orders.join(customers, "user_id", "left").select(
            "id", "user_id", "province_id", "create_time",
            (F.col("total_amount") + 20).cast("decimal(16,2)").alias("original_total_amount"),
            F.lit(15).cast("decimal(16,2)").alias("activity_reduce_amount"),
            F.lit(5).cast("decimal(16,2)").alias("coupon_reduce_amount"),
            "total_amount", "status", "priority",
        )

    @cached_property
    def order_amounts(self) -> DataFrame:
        """Shop order lines without their day; the reduction columns are null where nothing was taken off."""
        original = (money("l_extendedprice") * F.col("l_quantity").cast("decimal(4,0)"))
        activity = F.when(F.col("l_discount") > 0, original * money("l_discount", "decimal(4,2)"))
        coupon = F.when(F.col("l_tax") > 0, original * money("l_tax", "decimal(4,2)"))
        zero = F.lit(0).cast("decimal(4,2)")
        kept = original - F.coalesce(activity, zero) - F.coalesce(coupon, zero)
        return self.raw("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
            F.col("l_quantity").cast("bigint").alias("sku_num"),
            money("l_extendedprice").alias("order_price"),
            kept.cast("decimal(18,4)").alias("split_total_amount"),
            activity.cast("decimal(18,4)").alias("split_activity_amount"),
            coupon.cast("decimal(18,4)").alias("split_coupon_amount"),
        )

    @cached_property
    def order_detail(self) -> DataFrame:
        """Shop order lines, made when their order was."""
        placed = self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("timestamp").alias("create_time")
        )
        return self.order_amounts.join(placed, "order_id", "left")

    @cached_property
    def order_detail_activity(self) -> DataFrame:
        cut = (F.col("l_discount") * 100).cast("decimal(4,0)").cast("int")
        return self.raw("lineitem").where(F.col("l_discount") > 0).select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("order_detail_id"),
            cut.alias("activity_id"), (cut * 10 + F.col("l_linenumber")).alias("activity_rule_id"),
        )

    @cached_property
    def order_detail_coupon(self) -> DataFrame:
        tax = (F.col("l_tax") * 100).cast("decimal(4,0)").cast("int")
        return self.raw("lineitem").where(F.col("l_tax") > 0).select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("order_detail_id"),
            tax.alias("coupon_id"),
        )

    @cached_property
    def payment_info(self) -> DataFrame:
        """Finished orders are paid, some hours after they were placed (hours from the amount)."""
        wait = F.expr("make_interval(0, 0, 0, 0, cast(o_totalprice / 10000 as int), 0, 0)")
        return self.raw("orders").where(F.col("o_orderstatus") == "F").select(
            F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("order_id"),
            F.when(F.col("o_totalprice") < 250000, "1101").otherwise("1102").alias("payment_type"),
            (F.col("o_orderdate").cast("timestamp") + wait).alias("callback_time"),
            money("o_totalprice").alias("total_amount"),
        )

    @cached_property
    def order_status_log(self) -> DataFrame:
        """An order is done (1004) when its last line has shipped."""
        return self.raw("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
            F.max("l_shipdate").cast("timestamp").alias("operate_time")
        ).withColumn("order_status", F.lit("1004"))

    @cached_property
    def coupon_use(self) -> DataFrame:
        tax = (F.col("l_tax") * 100).cast("decimal(4,0)").cast("int")
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").cast("timestamp").alias("used_time"),
        )
        used = self.raw("lineitem").where(F.col("l_tax") > 0).select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
            tax.alias("coupon_id"), F.col("l_orderkey").alias("order_id"),
        )
        return used.join(orders, "order_id").select(
            "id", "coupon_id", "user_id", "order_id", "used_time"
        )

    # ------------------------------------------------------------ events
    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events").select(
            "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type",
            money("value").alias("value"),
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        )

    @cached_property
    def favor_info(self) -> DataFrame:
        return self.events.where(F.col("event_type") == "view").select(
            F.col("event_id").alias("id"), "user_id", F.col("k").alias("sku_id"),
            F.col("ts").alias("create_time"),
        )

    @cached_property
    def cart_info(self) -> DataFrame:
        return self.events.where(F.col("event_type") == "click").select(
            F.col("event_id").alias("id"), "user_id", F.col("k").alias("sku_id"),
            numbered_text("sku ", F.col("k")).alias("sku_name"),
            F.ceil("value").cast("bigint").alias("sku_num"), F.col("ts").alias("create_time"),
            F.when(F.col("value") > 60, "1").otherwise("0").alias("is_ordered"),
        )

    @cached_property
    def z_log(self) -> DataFrame:
        """Raw event log: one JSON text per event, beside the time it is stored under; error events carry no page."""
        k, user = F.col("k"), F.col("user_id")
        common = F.struct(
            (user % 25).cast("string").alias("ar"), numbered_text("brand", user % 3).alias("ba"),
            numbered_text("ch", k % 5).alias("ch"),
            F.when(F.col("value") < 5, "1").otherwise("0").alias("is_new"),
            numbered_text("model", user % 7).alias("md"), numbered_text("mid", user).alias("mid"),
            F.when(user % 2 == 0, "ios").otherwise("android").alias("os"),
            F.when(F.col("value") >= 2, user.cast("string")).alias("uid"),
            numbered_text("v", user % 4).alias("vc"),
            F.concat_ws("-", user, F.date_format("ts", "yyyyMMdd")).alias("sid"),
        )
        page = F.when(F.col("event_type") != "error", F.struct(
            F.col("event_id").cast("string").alias("item"), F.lit("event").alias("item_type"),
            F.when(F.col("event_type") == "signup", "register")
            .when(F.col("event_type") == "click", "cart")
            .when(F.col("event_type") == "purchase", "payment")
            .when(k < 50, "home").otherwise("good_detail").alias("page_id"),
            (k % 10).cast("string").alias("from_pos_id"), (k % 4).cast("string").alias("from_pos_seq"),
            (k % 6).cast("string").alias("refer_id"),
            (F.col("value") * 100).cast("bigint").alias("during_time"),
        ))
        line = F.struct(common.alias("common"), page.alias("page"), F.unix_millis("ts").alias("ts"))
        return self.events.select(F.to_json(line).alias("log"), F.col("ts").alias("log_time"))

    @cached_property
    def user_info(self) -> DataFrame:
        key = F.col("c_custkey")
        digits = F.lpad(key.cast("string"), 8, "0")
        return self.raw("customer").select(
            key.alias("id"), F.lower("c_name").alias("login_name"), F.col("c_mktsegment").alias("nick_name"),
            F.concat(F.lit("pw"), key.cast("string")).alias("passwd"), F.col("c_name").alias("real_name"),
            F.col("c_name").alias("name"),
            F.when(F.col("c_acctbal") < 0, F.concat(F.lit("120"), digits))
            .otherwise(F.concat(F.lit("138"), digits)).alias("phone_num"),
            F.when(F.col("c_mktsegment") == "BUILDING", numbered_text("user", key))
            .otherwise(F.concat(F.lit("user"), key.cast("string"), F.lit("@mail.example.com"))).alias("email"),
            F.col("c_nationkey").cast("string").alias("user_level"),
            (key % 15000).cast("string").alias("birthday"),
            F.when(F.col("c_acctbal") > 5000, "F").otherwise("M").alias("gender"),
            F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, cast(c_nationkey as int), 5, 0, 0)").alias("create_time"),
            F.lit(None).cast("timestamp").alias("operate_time"),
            F.when(F.col("c_acctbal") < -900, "1").otherwise("0").alias("is_deleted"),
        )

    # ------------------------------------------------------------ logistics
    @cached_property
    def region_info(self) -> DataFrame:
        """Provinces (regions), cities (nations) and districts (one per supplier)."""
        province = self.raw("region").select(
            (F.col("r_regionkey") + 1).cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("parent_id"),
            F.col("r_name").alias("name"), F.lit("province").alias("dict_code"),
        )
        city = self.raw("nation").select(
            (F.col("n_nationkey") + 100).cast("bigint").alias("id"),
            (F.col("n_regionkey") + 1).cast("bigint").alias("parent_id"),
            F.col("n_name").alias("name"), F.lit("city").alias("dict_code"),
        )
        district = self.raw("supplier").select(
            (F.col("s_suppkey") + 10000).alias("id"), (F.col("s_nationkey") + 100).cast("bigint").alias("parent_id"),
            F.col("s_name").alias("name"), F.lit("district").alias("dict_code"),
        )
        return province.unionByName(city).unionByName(district)

    @cached_property
    def base_organ(self) -> DataFrame:
        """One organisation per supplier: level 1 sits in a city, level 2 in a district."""
        key = F.col("s_suppkey")
        top = F.col("s_acctbal") > 5000
        return self.raw("supplier").select(
            key.alias("id"), F.concat(F.lit("Org "), F.col("s_name")).alias("org_name"),
            F.when(top, 1).otherwise(2).alias("org_level"),
            F.when(top, (F.col("s_nationkey") + 100).cast("bigint")).otherwise(key + 10000).alias("region_id"),
            F.when(~top, key - 1).alias("org_parent_id"), F.lit("0").alias("is_deleted"),
        )

    @cached_property
    def tms_order_info(self) -> DataFrame:
        """Waybills: status from order status and priority, times as epoch ms and ISO text."""
        key, user = F.col("o_orderkey"), F.col("o_custkey")
        urgency = F.substring("o_orderpriority", 1, 1).cast("int")
        status = (
            F.when(F.col("o_orderstatus") == "F", F.when(urgency <= 2, "60080").when(urgency <= 4, "60070").otherwise("60999"))
            .when(F.col("o_orderstatus") == "O", F.when(urgency == 1, "60010").when(urgency <= 3, "60020").otherwise("60030"))
            .otherwise(F.when(urgency <= 2, "60040").when(urgency <= 4, "60050").otherwise("60060"))
        )
        stamp = F.col("o_orderdate").cast("timestamp")
        sender = (10000 + user % 1000)
        receiver = (10000 + key % 1000)
        return self.raw("orders").select(
            key.alias("id"), numbered_text("NO", key).alias("order_no"), status.alias("status"),
            F.when(F.col("o_totalprice") < 200000, "72001").otherwise("72002").alias("collect_type"),
            user.alias("user_id"), (key % 50).alias("receiver_complex_id"),
            F.lit(1).cast("bigint").alias("receiver_province_id"), (100 + key % 25).alias("receiver_city_id"),
            receiver.alias("receiver_district_id"), numbered_text("Receiver ", key).alias("receiver_name"),
            (user % 50).alias("sender_complex_id"), F.lit(2).cast("bigint").alias("sender_province_id"),
            (100 + user % 25).alias("sender_city_id"), sender.alias("sender_district_id"),
            numbered_text("Sender ", user).alias("sender_name"),
            F.when(F.col("o_totalprice") < 100000, "73001").when(F.col("o_totalprice") < 300000, "73002")
            .otherwise("73003").alias("payment_type"),
            urgency.alias("cargo_num"), money("o_totalprice").alias("amount"),
            (F.unix_millis(stamp) + 172800000).cast("string").alias("estimate_arrive_time"),
            (money("o_totalprice") * F.lit(0.01).cast("decimal(4,2)")).cast("decimal(18,4)").alias("distance"),
            iso(stamp + F.expr("interval 30 hours")).alias("update_time"),
            F.lit("0").alias("is_deleted"),
        )

    @cached_property
    def order_cargo(self) -> DataFrame:
        """Cargo lines of waybills; lines at the top tax rate are soft-deleted."""
        return self.raw("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
            F.col("l_orderkey").alias("order_id"),
            code(F.col("l_returnflag"), {"A": "71001", "N": "71002", "R": "71003"}).alias("cargo_type"),
            F.col("l_linenumber").alias("volume_length"), (F.col("l_linenumber") * 2).alias("volume_width"),
            (F.col("l_linenumber") * 3).alias("volume_height"), money("l_quantity").alias("weight"),
            iso(F.col("l_shipdate").cast("timestamp") + F.expr("interval 9 hours")).alias("create_time"),
            F.when(F.col("l_tax") >= 0.08, "1").otherwise("0").alias("is_deleted"),
        )

    @cached_property
    def transport_task(self) -> DataFrame:
        """Truck trips: one per line item; open lines have not arrived yet."""
        start = F.unix_millis(F.col("l_shipdate").cast("timestamp")) + F.col("l_linenumber") * 3600000
        ends = start + F.col("l_quantity").cast("bigint") * 600000
        shift = F.col("l_partkey") % 200
        driver = F.col("l_suppkey") * 10
        return self.raw("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
            shift.alias("shift_id"), (shift % 50).alias("line_id"),
            F.col("l_suppkey").alias("start_org_id"), numbered_text("Org Supplier ", F.col("l_suppkey")).alias("start_org_name"),
            (F.col("l_suppkey") + 1).alias("end_org_id"), numbered_text("Org Supplier ", F.col("l_suppkey") + 1).alias("end_org_name"),
            F.col("l_linenumber").cast("bigint").alias("order_num"),
            (driver + 1).alias("driver1_emp_id"), numbered_text("A driver ", driver + 1).alias("driver1_name"),
            F.when(F.col("l_linenumber") % 2 == 0, driver + 2).alias("driver2_emp_id"),
            F.when(F.col("l_linenumber") % 2 == 0, numbered_text("B driver ", driver + 2)).alias("driver2_name"),
            F.col("l_suppkey").alias("truck_id"), numbered_text("TRK", F.col("l_suppkey")).alias("truck_no"),
            start.cast("string").alias("actual_start_time"),
            F.when(F.col("l_linestatus") == "F", ends.cast("string")).alias("actual_end_time"),
            money("l_quantity").alias("actual_distance"), F.lit("0").alias("is_deleted"),
        )

    @cached_property
    def org_bound(self) -> DataFrame:
        """Inbound, sort and outbound scans at an organisation, epoch ms."""
        base = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
        return self.raw("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
            F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("org_id"),
            base.cast("string").alias("inbound_time"), (F.col("l_suppkey") * 10).alias("inbound_emp_id"),
            F.when(F.col("l_returnflag") != "N", (base + 7200000).cast("string")).alias("sort_time"),
            (F.col("l_suppkey") * 10 + 3).alias("sorter_emp_id"),
            F.when(F.col("l_returnflag") == "R", (base + 90000000).cast("string")).alias("outbound_time"),
            (F.col("l_suppkey") * 10 + 4).alias("outbound_emp_id"), F.lit("0").alias("is_deleted"),
        )

    @cached_property
    def base_complex(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("id"), F.concat(F.lit("Complex "), F.col("c_name")).alias("complex_name"),
            (F.col("c_custkey") % 5 + 1).alias("province_id"),
            (F.col("c_nationkey") + 100).cast("bigint").alias("city_id"),
            (F.col("c_custkey") % 1000 + 10000).alias("district_id"), F.col("c_mktsegment").alias("district_name"),
            F.when(F.col("c_acctbal") < -900, "1").otherwise("0").alias("is_deleted"),
        )

    @cached_property
    def express_courier_complex(self) -> DataFrame:
        return self.raw("orders").select(
            (F.col("o_orderkey") % 7).alias("courier_emp_id"), F.col("o_custkey").alias("complex_id"),
            F.lit("0").alias("is_deleted"),
        )

    @cached_property
    def express_courier(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("id"), numbered_text("E", F.col("c_custkey")).alias("emp_id"),
            (F.col("c_custkey") % 1000).alias("org_id"),
            F.concat(F.lit("138"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("working_phone"),
            F.when(F.col("c_acctbal") < 5000, "74001").otherwise("74002").alias("express_type"),
            F.when(F.col("c_acctbal") < -900, "1").otherwise("0").alias("is_deleted"),
        )

    @cached_property
    def line_info(self) -> DataFrame:
        line = (F.col("p_partkey") % 50).alias("id")
        return self.raw("part").select(line).distinct().select(
            "id", numbered_text("Line ", F.col("id")).alias("name"), numbered_text("L", F.col("id")).alias("line_no"),
            F.when(F.col("id") < 10, 1).otherwise(2).alias("line_level"), (F.col("id") % 10).alias("org_id"),
            F.when(F.col("id") < 25, "75001").otherwise("75002").alias("transport_line_type_id"),
            F.col("id").alias("start_org_id"), numbered_text("Org ", F.col("id")).alias("start_org_name"),
            (F.col("id") + 1).alias("end_org_id"), numbered_text("Org ", F.col("id") + 1).alias("end_org_name"),
            (49 - F.col("id")).alias("pair_line_id"), (F.col("id") * 10).cast("decimal(10,2)").alias("distance"),
            (F.col("id") * 7).cast("decimal(10,2)").alias("cost"), (F.col("id") * 10).alias("estimated_time"),
            F.lit("0").alias("is_deleted"),
        )

    @cached_property
    def line_shift(self) -> DataFrame:
        shift = (F.col("p_partkey") % 200).alias("id")
        return self.raw("part").select(shift).distinct().select(
            "id", (F.col("id") % 50).alias("line_id"), F.lit("08:00").alias("start_time"),
            (F.col("id") * 10 + 1).alias("driver1_emp_id"), (F.col("id") * 10 + 2).alias("driver2_emp_id"),
            (F.col("id") % 10).alias("truck_id"), (199 - F.col("id")).alias("pair_shift_id"),
            F.lit("0").alias("is_deleted"),
        )

    @cached_property
    def truck_team(self) -> DataFrame:
        return self.raw("supplier").select((F.col("s_suppkey") % 10).alias("id")).distinct().select(
            "id", numbered_text("Team ", F.col("id")).alias("name"), numbered_text("TM", F.col("id")).alias("team_no"),
            F.col("id").alias("org_id"), (F.col("id") * 100).alias("manager_emp_id"), F.lit("0").alias("is_deleted"),
        )

    @cached_property
    def truck_model(self) -> DataFrame:
        m = F.col("id")
        return self.raw("supplier").select((F.col("s_suppkey") % 8).alias("id")).distinct().select(
            "id", numbered_text("Model ", m).alias("model_name"),
            F.when(m < 4, "76001").otherwise("76002").alias("model_type"), numbered_text("MN", m).alias("model_no"),
            F.when(m < 3, "77001").otherwise("77002").alias("brand"),
            *[(m + i).cast("decimal(10,2)").alias(name) for i, name in enumerate([
                "truck_weight", "load_weight", "total_weight", "eev", "boxcar_len", "boxcar_wd",
                "boxcar_hg", "max_speed", "oil_vol",
            ])], F.lit("0").alias("is_deleted"),
        )

    @cached_property
    def truck_info(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            key.alias("id"), (key % 10).alias("team_id"), numbered_text("TRK", key).alias("truck_no"),
            (key % 8).alias("truck_model_id"), numbered_text("GPS", key).alias("device_gps_id"),
            numbered_text("ENG", key).alias("engine_no"), F.lit("1999-01-01").alias("license_registration_date"),
            F.lit("2000-01-01").alias("license_last_check_date"), F.lit("2005-01-01").alias("license_expire_date"),
            F.when(F.col("s_acctbal") > 0, 1).otherwise(0).alias("is_enabled"), F.lit("0").alias("is_deleted"),
        )

    @cached_property
    def truck_driver(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("id"), numbered_text("D", key).alias("emp_id"), (key % 1000).alias("org_id"),
            (key % 10).alias("team_id"), F.lit("A2").alias("license_type"), F.lit("1990-01-01").alias("init_license_date"),
            F.lit("2030-01-01").alias("expire_date"), numbered_text("LIC", key).alias("license_no"),
            F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("is_enabled"),
            F.when(F.col("c_acctbal") < -900, "1").otherwise("0").alias("is_deleted"),
        )

    @cached_property
    def tms_user_address(self) -> DataFrame:
        key = F.col("c_custkey")
        digits = F.lpad(key.cast("string"), 8, "0")
        return self.raw("customer").select(
            (key + 1).alias("id"), key.alias("user_id"),
            F.when(F.col("c_acctbal") < 0, F.concat(F.lit("120"), digits))
            .otherwise(F.concat(F.lit("151"), digits)).alias("phone"),
            (key % 5 + 1).alias("province_id"), (F.col("c_nationkey") + 100).alias("city_id"),
            (key % 1000 + 10000).alias("district_id"), (key % 50).alias("complex_id"),
            F.concat(F.lit("Road "), F.col("c_name")).alias("address"), F.lit(1).alias("is_default"),
            F.lit("1998-03-04T05:06:07Z").alias("create_time"),
            F.when(F.col("c_acctbal") < -900, "1").otherwise("0").alias("is_deleted"),
        )

    # ------------------------------------------------------------ product marts
    @cached_property
    def product_behaviour(self) -> DataFrame:
        """One row per product and day: traffic, clicks, interaction, new users, sales."""
        kind, value = F.col("event_type"), F.col("value")

        def count(*kinds: str) -> Column:
            return F.count(F.when(kind.isin(*kinds), 1))

        daily = self.events.groupBy(F.col("k").alias("product_key"), F.to_date("ts").alias("stat_date")).agg(
            count("view", "click", "signup").alias("traffic_cnt"), count("click").alias("click_cnt"),
            count("error").alias("content_interact_cnt"), count("signup").alias("new_user_cnt"),
            F.countDistinct("user_id").alias("visitor_cnt"), count("purchase").alias("sales_cnt"),
            F.coalesce(F.sum(F.when(kind == "purchase", value)), F.lit(0)).cast("decimal(16,2)").alias("sales_amount"),
            F.max(value).alias("top"),
        )
        parts = self.raw("part").select(
            F.col("p_partkey").alias("product_key"), F.concat_ws("_", "p_type", "p_name").alias("product_name")
        )
        return daily.join(parts, "product_key", "left").select(
            F.col("product_key").cast("string").alias("product_id"), "product_name", "traffic_cnt",
            "click_cnt", F.when(F.col("sales_cnt") > 0, 0.25).otherwise(0.05).alias("conversion_rate"),
            "content_interact_cnt", "new_user_cnt",
            F.when(F.col("top") > 40, 0.9).otherwise(0.5).alias("service_rating"),
            "sales_amount", "sales_cnt", "visitor_cnt", "stat_date",
        )

    @cached_property
    def discount_activity(self) -> DataFrame:
        size = F.col("p_size")
        return self.raw("part").select(size).distinct().select(
            numbered_text("act_", size).alias("activity_id"), numbered_text("Activity ", size).alias("activity_name"),
            F.when(size < 20, "product").otherwise("shop").alias("activity_level"),
            F.when(size <= 25, FIXED_DISCOUNT).otherwise(CUSTOM_DISCOUNT).alias("discount_type"),
            (size * 2).alias("max_discount_amount"), F.lit("2024-01-01").alias("start_time"),
            F.lit("2024-12-31").alias("end_time"), F.lit("on").alias("status"),
            F.lit("2023-12-01").alias("create_time"), F.lit("2023-12-02").alias("update_time"),
            F.when(size <= 45, 1).otherwise(0).alias("is_valid"),
        )

    @cached_property
    def discount_product(self) -> DataFrame:
        return self.raw("part").select(
            numbered_text("rel_", F.col("p_partkey")).alias("rel_id"),
            numbered_text("act_", F.col("p_size")).alias("activity_id"),
            F.col("p_partkey").cast("string").alias("product_id"), numbered_text("sku_", F.col("p_partkey")).alias("sku_id"),
            (F.col("p_size") + 5).alias("fixed_discount"), (F.col("p_size") * 3).alias("max_buy_count"),
            F.lit("2024-01-01 08:00:00").alias("add_time"),
            F.when(F.col("p_type") == "PROMO", 1).otherwise(0).alias("is_delete"),
        )

    @cached_property
    def discount_send(self) -> DataFrame:
        return self.events.where(F.col("event_type") == "click").select(
            numbered_text("s", F.col("event_id")).alias("send_id"), numbered_text("act_", F.col("k")).alias("activity_id"),
            F.col("k").cast("string").alias("product_id"), numbered_text("sku_", F.col("k")).alias("sku_id"),
            numbered_text("c", F.col("user_id")).alias("customer_id"),
            numbered_text("serv_", F.col("user_id") % 10).alias("service_id"),
            F.floor("value").cast("int").alias("send_discount_amount"),
            (F.col("k") % 24 + 1).cast("int").alias("validity_period"), F.col("ts").alias("send_time"),
            F.lit("sent").alias("remark"),
        )

    @cached_property
    def discount_verify(self) -> DataFrame:
        """Redemptions, as landed: amounts and times are text.  Each refers to the event before."""
        return self.events.where(F.col("event_type") == "purchase").select(
            numbered_text("v", F.col("event_id")).alias("verify_id"),
            numbered_text("s", F.col("event_id") - 1).alias("send_id"),
            numbered_text("o", F.col("event_id")).alias("order_id"),
            F.col("value").cast("string").alias("pay_amount"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("verify_time"),
            (F.col("k") % 5 + 1).cast("int").alias("buy_count"),
        )

    @cached_property
    def product(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category_id"), F.lower("p_type").alias("category_name"),
            money("p_retailprice", "decimal(10,2)").alias("product_price"),
            F.lit("2024-01-01").alias("update_date"),
        )

    @cached_property
    def visit_log(self) -> DataFrame:
        return self.events.where(F.col("event_type").isin("view", "click")).select(
            F.col("event_id").cast("string").alias("log_id"), numbered_text("u", F.col("user_id")).alias("user_id"),
            F.col("k").cast("string").alias("product_id"), F.col("ts").alias("visit_time"),
            F.when(F.col("user_id") % 2 == 0, "app").otherwise("web").alias("terminal"),
            F.floor("value").cast("int").alias("stay_time"),
            F.when(F.col("event_type") == "click", 1).otherwise(0).alias("is_click"),
        )

    @cached_property
    def product_add(self) -> DataFrame:
        favourite = F.col("event_type") == "signup"
        return self.events.where(F.col("event_type").isin("signup", "error")).select(
            F.col("event_id").cast("string").alias("record_id"), numbered_text("u", F.col("user_id")).alias("user_id"),
            F.col("k").cast("string").alias("product_id"),
            F.when(favourite, FAVOURITE).otherwise(ADD_TO_CART).alias("op_type"), F.col("ts").alias("op_time"),
            F.when(~favourite, (F.col("k") % 3 + 1).cast("int")).alias("add_cart_count"),
            F.when(F.col("user_id") % 2 == 0, "app").otherwise("web").alias("terminal"),
        )

    @cached_property
    def product_order(self) -> DataFrame:
        paid = F.col("value") >= 10
        count = (F.col("k") % 4 + 1).cast("int")
        stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
        return self.events.where(F.col("event_type") == "purchase").select(
            F.col("event_id").cast("string").alias("order_id"), numbered_text("u", F.col("user_id")).alias("user_id"),
            F.col("k").cast("string").alias("product_id"), F.col("value").cast("string").alias("product_price"),
            count.alias("buy_count"), (F.col("value") * count).cast("string").alias("buy_amount"),
            F.when(paid, PAID).otherwise(UNPAID).alias("pay_status"), F.when(paid, stamp).alias("pay_time"),
            F.when(paid, (F.col("value") * count).cast("string")).alias("pay_amount"),
            F.when(F.col("user_id") % 2 == 0, "app").otherwise("web").alias("terminal"),
            stamp.alias("create_time"), F.date_format("ts", "yyyy-MM-dd").alias("order_date"),
        )

    @cached_property
    def goods_base(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").cast("string").alias("goods_id"), F.col("p_name").alias("goods_name"),
            F.col("p_size").cast("string").alias("category_id"), F.col("p_type").alias("category_name"),
            F.col("p_brand").alias("shop_id"), F.when(F.col("p_size") > 25, 1).otherwise(0).alias("is_price_strength"),
        )

    @cached_property
    def goods_sales(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_partkey").cast("string").alias("goods_id"), numbered_text("sku_", F.col("l_partkey")).alias("sku_id"),
            F.col("l_extendedprice").alias("pay_amount"), F.col("l_quantity").cast("int").alias("sales_num"),
            F.col("l_linenumber").alias("pay_buyer_num"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("pay_date"),
        )

    @cached_property
    def goods_traffic(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_partkey").cast("string").alias("goods_id"), F.col("l_returnflag").alias("traffic_source"),
            (F.col("l_quantity") * F.col("l_linenumber") + 10).cast("int").alias("visitor_num"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("visit_date"),
        )

    @cached_property
    def price_strength(self) -> DataFrame:
        """Star of a part on a day: the highest line number it was sold under, at most 5."""
        star = F.least(F.max("l_linenumber"), F.lit(5))
        daily = self.raw("lineitem").groupBy("l_partkey", "l_shipdate").agg(star.alias("star"))
        return daily.select(
            F.col("l_partkey").cast("string").alias("goods_id"), F.col("star").alias("price_strength_star"),
            F.when(F.col("star") <= 2, 1).otherwise(0).alias("is_low_star"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("record_date"),
        )

    # ------------------------------------------------------------ change log and telemetry
    @cached_property
    def change_log(self) -> DataFrame:
        """Change envelopes of a user-profile table, one JSON text per change, from the events.

        A user's first change creates, an error event deletes, anything else updates.
        """
        row = F.struct(
            F.col("user_id").alias("id"), F.col("event_type").alias("state"), F.col("value").alias("balance")
        )
        deleted = F.col("event_type") == "error"
        envelope = F.struct(
            F.when(deleted, row).alias("before"), F.when(~deleted, row).alias("after"),
            F.when(deleted, "d").when(F.col("event_type") == "signup", "c").otherwise("u").alias("op"),
            F.unix_millis("ts").alias("ts_ms"), F.col("event_id").alias("seq"),
        )
        return self.events.select(F.to_json(envelope).alias("value"))

    @cached_property
    def telemetry(self) -> DataFrame:
        """Vehicle position reports as JSON text; alarms raised from the event's kind and value."""
        alarm = F.struct(*[
            F.when(F.col("k") == i, 1).otherwise(0).alias(name) for i, name in enumerate(ALARMS)
        ])
        message = F.struct(
            F.date_format("ts", "yyyyMMddHHmmss").alias("dateTime"), (F.col("k") * 2).alias("altitude"),
            F.col("event_id").alias("vec3"), alarm.alias("alarm"), F.lit(4610).alias("msgId"),
            F.lit(0).alias("encrypy"), F.col("k").alias("vec2"), F.col("k").alias("vec1"),
            (F.col("k") / 100 + 114).cast("decimal(9,6)").alias("lon"),
            F.struct(
                F.when(F.col("event_type") == "click", 1).otherwise(0).alias("acc"),
                F.when(F.col("event_type") == "view", 1).otherwise(0).alias("door"),
            ).alias("state"),
            (F.col("k") / 100 + 22).cast("decimal(9,6)").alias("lat"), (F.col("k") * 3).alias("direction"),
        )
        report = F.struct(
            message.alias("UPEXGMSGREALLOCATION"), F.lit(4610).alias("DATATYPE"),
            numbered_text("V", F.col("user_id")).alias("VEHICLENO"), F.lit(2).alias("VEHICLECOLOR"),
        )
        return self.events.select("event_id", F.to_json(report).alias("payload"))
