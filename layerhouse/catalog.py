"""Every registered query: its name, its column contract, and how it is built from raw tables.

A contract lists ``column:type`` pairs (i int, l bigint, d double, s text, b boolean).  Dates and times leave as text, decimals as doubles, arrays as joined text, so
results compare across engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from layerhouse.plans import (
    diagnosis, discount, goods, macro, security, shop_ads, shop_dim, shop_dwd, shop_dws, tms_ads,
    tms_dim, tms_dwd, tms_dws,
)
from layerhouse.plans.tms_ads import SPANS
from layerhouse.session import scratch, written
from layerhouse.sources import files
from layerhouse.sources.warehouse import Warehouse
from layerhouse.streaming import cdc


class Layers(Warehouse):
    """Intermediate layers over the raw tables.  All are lazy; a deployment would store them."""

    # e-commerce
    @cached_property
    def sku(self) -> DataFrame:
        return shop_dim.sku_categories(
            self.sku_info, self.base_category3, self.base_category2, self.base_category1,
            self.base_trademark,
        )

    @cached_property
    def province(self) -> DataFrame:
        return shop_dim.province_full(self.base_province, self.base_region)

    @cached_property
    def coupon(self) -> DataFrame:
        return shop_dim.coupon_full(self.coupon_info, self.base_dic)

    @cached_property
    def order_line(self) -> DataFrame:
        return shop_dwd.order_line(self.order_detail, self.order_info)

    @cached_property
    def pay_line(self) -> DataFrame:
        return shop_dwd.pay_line(self.order_amounts, self.payment_info)

    @cached_property
    def trade_flow(self) -> DataFrame:
        return shop_dwd.trade_flow(self.order_info, self.payment_info, self.order_status_log)

    @cached_property
    def page_view(self) -> DataFrame:
        return shop_dwd.page_view(self.z_log)

    def page_view_in(self, days: int) -> DataFrame:
        """Page views from the log lines of the days up to the run day alone."""
        return shop_dwd.page_view(shop_dwd.recent_log(self.z_log, self.event_day, days))

    @cached_property
    def login(self) -> DataFrame:
        return shop_dwd.user_login(self.z_log)

    @cached_property
    def province_1d(self) -> DataFrame:
        return shop_dws.province_order_1d(self.order_line, self.province)

    @cached_property
    def favor_1d(self) -> DataFrame:
        return shop_dws.sku_favor_1d(shop_dwd.favor_add(self.favor_info), self.sku)

    @cached_property
    def coupon_1d(self) -> DataFrame:
        return shop_dws.user_coupon_used_1d(shop_dwd.coupon_used(self.coupon_use), self.coupon)

    @cached_property
    def cart_1d(self) -> DataFrame:
        return shop_dws.user_cart_1d(shop_dwd.cart_add(self.cart_info))

    @cached_property
    def order_1d(self) -> DataFrame:
        return shop_dws.user_order_1d(self.order_line)

    @cached_property
    def payment_1d(self) -> DataFrame:
        return shop_dws.user_payment_1d(self.pay_line)

    @cached_property
    def user_sku_1d(self) -> DataFrame:
        return shop_dws.user_sku_order_1d(self.order_line, self.sku)

    @cached_property
    def category_buyers(self) -> DataFrame:
        return shop_dws.buyers_1d(self.user_sku_1d, shop_ads.CATEGORY)

    @cached_property
    def brand_buyers(self) -> DataFrame:
        return shop_dws.buyers_1d(self.user_sku_1d, shop_ads.BRAND)

    @cached_property
    def purchase_1d(self) -> DataFrame:
        """User-days with a purchase event: the active-day fact of the streak reports."""
        return self.events.where(F.col("event_type") == "purchase").groupBy(
            "user_id", F.to_date("ts").alias("dt")
        ).agg(F.count("*").alias("order_count_1d"))

    def order_run_day(self, daily: DataFrame) -> DataFrame:
        """The run day of the orders under the date of the events' run day, for reports over both."""
        return daily.where(F.col("dt") == F.lit(self.order_day)).withColumn("dt", F.lit(self.event_day))

    def login_td(self, as_of) -> DataFrame:
        return shop_dws.user_login_td(self.user_info, self.login, as_of)

    # logistics
    @cached_property
    def tms_order(self) -> DataFrame:
        return tms_dwd.order_detail(self.order_cargo, self.tms_order_info, self.tms_dic)

    def tms_milestone(self, step: tms_dwd.Milestone) -> DataFrame:
        return tms_dwd.milestone(self.order_cargo, self.tms_order_info, self.tms_dic, step)

    @cached_property
    def open_orders(self) -> DataFrame | None:
        """The stored open partition of the order process, where a load binds it."""
        return None

    def tms_from_open(self, step: tms_dwd.Milestone) -> DataFrame:
        """Daily load: the stored open waybills and those the order fact has for the day.

        Without a stored partition every waybill of the fact is still to be looked at.
        """
        return tms_dwd.milestone_from_open(self.open_orders, self.tms_order, self.tms_order_info, self.tms_dic, step)

    @cached_property
    def trips(self) -> DataFrame:
        return tms_dwd.trans_finish(self.transport_task, self.line_info_shifts)

    @cached_property
    def finished_trips(self) -> DataFrame:
        return tms_dwd.finished(self.transport_task)

    @cached_property
    def line_info_shifts(self) -> DataFrame:
        return tms_dim.shift_full(self.line_shift, self.line_info, self.tms_dic)

    @cached_property
    def organ_paths(self) -> DataFrame:
        """The place dimension, written once per run and read by every fact."""
        return tms_dws.organ_paths(self.base_organ, self.region_info)

    @cached_property
    def trucks(self) -> DataFrame:
        return tms_dim.truck_models(self.truck_info, self.truck_model, self.tms_dic)

    @cached_property
    def cargo_1d(self) -> DataFrame:
        return tms_dws.org_cargo_order_1d(self.tms_order, self.base_organ, self.region_info)

    def cargo_nd(self, spans=tms_dws.ROLLING) -> DataFrame:
        return tms_dws.org_cargo_order_nd(self.cargo_1d, self.order_day, spans)

    @cached_property
    def receive_1d(self) -> DataFrame:
        return tms_dws.org_receive_1d(
            self.tms_milestone(tms_dwd.RECEIVED), self.organ_paths
        )

    def receive_nd(self, spans=tms_dws.ROLLING) -> DataFrame:
        return tms_dws.org_receive_nd(self.receive_1d, self.order_day, spans)

    @cached_property
    def dispatch_1d(self) -> DataFrame:
        return tms_dws.dispatch_1d(self.tms_milestone(tms_dwd.DISPATCHED))

    def dispatch_nd(self, spans=tms_dws.ROLLING) -> DataFrame:
        return tms_dws.dispatch_nd(self.dispatch_1d, self.order_day, spans)

    @cached_property
    def dispatch_td(self) -> DataFrame:
        return tms_dws.dispatch_td(self.dispatch_1d, self.last_day)

    @cached_property
    def finish_td(self) -> DataFrame:
        return tms_dws.bound_finish_td(self.tms_milestone(tms_dwd.BOUND_FINISHED), self.last_day)

    @cached_property
    def deliver_1d(self) -> DataFrame:
        return tms_dws.org_deliver_1d(
            self.tms_milestone(tms_dwd.DELIVERED), self.organ_paths
        )

    def deliver_nd(self, spans=tms_dws.ROLLING) -> DataFrame:
        return tms_dws.org_deliver_nd(self.deliver_1d, self.order_day, spans)

    @cached_property
    def sort_1d(self) -> DataFrame:
        scans = tms_dwd.bound(self.org_bound, "sort", "sorter_emp_id")
        return tms_dws.org_sort_1d(scans, self.organ_paths)

    def sort_nd(self, spans=tms_dws.ROLLING) -> DataFrame:
        return tms_dws.org_sort_nd(self.sort_1d, self.order_day, spans)

    @cached_property
    def trips_1d(self) -> DataFrame:
        return tms_dws.org_truck_trips_1d(self.trips, self.trucks)

    def shift_nd(self, spans=tms_dws.ROLLING) -> DataFrame:
        return tms_dws.shift_trips_nd(
            self.trips, self.organ_paths, self.line_info_shifts, self.trucks, self.order_day, spans,
        )

    def place_trips_nd(self, spans=tms_dws.ROLLING) -> DataFrame:
        return tms_dws.place_trips_nd(self.finished_trips, self.organ_paths, self.order_day, spans)

    # product marts
    @cached_property
    def rates(self) -> DataFrame:
        return diagnosis.daily_rates(self.product_behaviour)

    @cached_property
    def activity(self) -> DataFrame:
        return discount.valid_activity(self.discount_activity)

    @cached_property
    def sends(self) -> DataFrame:
        return discount.send_detail(self.discount_send, self.activity)

    @cached_property
    def verified(self) -> DataFrame:
        return discount.verify_detail(discount.cleaned_verify(self.discount_verify), self.sends)

    @cached_property
    def activity_1d(self) -> DataFrame:
        return discount.activity_daily(self.activity, self.sends, self.verified)

    @cached_property
    def agent_1d(self) -> DataFrame:
        return discount.agent_daily(self.sends, self.verified)

    @cached_property
    def products(self) -> DataFrame:
        return macro.latest_product(self.product)

    @cached_property
    def macro_1d(self) -> DataFrame:
        return macro.product_daily(
            macro.visit_detail(self.visit_log, self.products),
            macro.add_detail(self.product_add, self.products),
            macro.trade_detail(macro.cleaned_orders(self.product_order), self.products),
        )

    @cached_property
    def goods_1d(self) -> DataFrame:
        return goods.sales_sum(goods.sales_clean(self.goods_sales), self.goods_base)


# ---------------------------------------------------------------- contracts

TYPES = {"i": "int", "l": "bigint", "d": "double", "s": "string", "b": "boolean"}


@dataclass(frozen=True)
class Query:
    contract: str
    build: Callable[[Layers], DataFrame]

    @property
    def columns(self) -> list[tuple[str, str]]:
        return [tuple(part.split(":")) for part in self.contract.split()]

    def frame(self, layers: Layers) -> DataFrame:
        """The result with its own types: dates, decimals, arrays."""
        return self.build(layers).select(*[name for name, _ in self.columns])

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(Layers(spark, folder))
        return df.select(*[_plain(df, name, kind) for name, kind in self.columns])


def _plain(df: DataFrame, name: str, kind: str) -> Column:
    value, source = F.col(name), df.schema[name].dataType
    if isinstance(source, T.TimestampType):
        value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    elif isinstance(source, T.DateType):
        value = F.date_format(value, "yyyy-MM-dd")
    elif isinstance(source, T.ArrayType):
        inner = source.elementType
        if isinstance(inner, T.StructType):
            value = F.transform(value, lambda s: F.concat_ws(":", *[s[f] for f in inner.names]))
        value = F.array_join(value, ",")
    return value.cast(TYPES[kind]).alias(name)


QUERIES: dict[str, Query] = {}


def _add(name: str, contract: str, build: Callable[[Layers], DataFrame]) -> None:
    QUERIES[name] = Query(contract, build)


# ---------------------------------------------------------------- e-commerce

_RULE = "condition_amount:d condition_num:i benefit_amount:d benefit_discount:d benefit_rule:s"
_CATEGORY = (
    "category1_id:i category1_name:s category2_id:i category2_name:s category3_id:i category3_name:s"
)
_BRAND = "tm_id:s tm_name:s"
_SPLIT = "split_original_amount:d split_activity_amount:d split_coupon_amount:d"
_PROVINCE = "province_id:i province_name:s area_code:s iso_code:s iso_3166_2:s"


def _amounts(suffix: str, lead: str = "order_count") -> str:
    names = [*lead.split(), "order_original_amount", "activity_reduce_amount", "coupon_reduce_amount",
             "order_total_amount"]
    return " ".join(f"{n}_{suffix}:{'d' if n.endswith('amount') else 'l'}" for n in names)


_add("e1_dim_activity", f"activity_rule_id:l activity_id:l activity_name:s activity_type:s activity_type_name:s activity_desc:s start_time:s end_time:s create_time:s {_RULE} benefit_level:i",
     lambda w: shop_dim.activity_full(w.activity_rule, w.activity_info, w.base_dic))
_add("e2_dim_coupon", f"id:i coupon_name:s coupon_type:s coupon_type_name:s activity_id:i {_RULE} create_time:s range_type:s range_type_name:s limit_num:i taken_count:i start_time:s end_time:s operate_time:s expire_time:s",
     lambda w: w.coupon)
_add("e3_dim_date", "date_id:s week_id:i week_day:i day:i month:i quarter:i year:i is_workday:i",
     lambda w: shop_dim.calendar_of(w.raw("orders"), "o_orderdate"))
_add("e4_dim_promotion_pos", "id:i pos_location:s pos_type:i promotion_type:s create_time:s operate_time:s",
     lambda w: shop_dim.promotion_pos_full(w.promotion_pos))
_add("e5_dim_promotion_refer", "id:i refer_name:s create_time:s operate_time:s",
     lambda w: shop_dim.promotion_refer_full(w.promotion_refer))
_add("e6_dim_province", "id:i province_name:s area_code:s iso_code:s iso_3166_2:s region_id:i region_name:s",
     lambda w: w.province)
_add("e7_dim_sku", f"id:l price:d sku_name:s sku_desc:s weight:d is_sale:b spu_id:s spu_name:s {_CATEGORY} {_BRAND} attrs:s sale_attrs:s create_time:s",
     lambda w: shop_dim.sku_full(
         w.sku_info, w.spu_info, w.base_category3, w.base_category2, w.base_category1,
         w.base_trademark, w.sku_attr_value, w.sku_sale_attr_value))
_add("e8_dim_user_zip", "id:l name:s phone_num:s email:s user_level:s birthday:s gender:s create_time:s start_date:s end_date:s",
     lambda w: shop_dim.user_zip(w.user_info, w.event_day))
_add("e9_dwd_favor_add", "id:l user_id:l sku_id:l dt:s create_time:s",
     lambda w: shop_dwd.favor_add(w.favor_info))
_add("e10_dwd_coupon_used", "id:s coupon_id:i user_id:l order_id:l dt:s",
     lambda w: shop_dwd.coupon_used(w.coupon_use))
_add("e11_dwd_cart_add", "id:l user_id:l sku_id:l dt:s create_time:s sku_num:l",
     lambda w: shop_dwd.cart_add(w.cart_info))
_add("e12_dwd_cart_full", "id:l user_id:l sku_id:l sku_name:s sku_num:l",
     lambda w: shop_dwd.cart_full(w.cart_info))
_add("e13_dwd_order_detail", f"id:s order_id:l user_id:l sku_id:l province_id:i activity_id:l activity_rule_id:l coupon_id:i dt:s create_time:s sku_num:l {_SPLIT} split_total_amount:d",
     lambda w: shop_dwd.order_detail(
         w.order_detail, w.order_info, w.order_detail_activity, w.order_detail_coupon))
_add("e14_dwd_pay_detail", f"id:s order_id:l user_id:l sku_id:l province_id:i activity_id:l activity_rule_id:l coupon_id:i payment_type:s payment_type_name:s dt:s callback_time:s sku_num:l {_SPLIT} split_payment_amount:d",
     lambda w: shop_dwd.pay_detail(
         w.order_amounts, w.payment_info, w.order_info, w.order_detail_activity,
         w.order_detail_coupon, w.base_dic))
_add("e15_dwd_trade_flow", "order_id:l user_id:l province_id:i order_date:s order_time:s payment_date:s payment_time:s finish_date:s finish_time:s order_original_amount:d order_activity_amount:d order_coupon_amount:d order_total_amount:d payment_amount:d dt:s",
     lambda w: w.trade_flow)
_add("e16_dwd_page_view", "province_id:s brand:s channel:s is_new:s model:s mid_id:s operate_system:s user_id:s version_code:s page_item:s page_item_type:s last_page_id:s page_id:s from_pos_id:s from_pos_seq:s refer_id:s dt:s view_time:s session_id:s during_time:l",
     lambda w: w.page_view)
_add("e17_dwd_user_login", "user_id:s dt:s login_time:s channel:s province_id:s version_code:s mid_id:s brand:s model:s operate_system:s",
     lambda w: w.login)
_add("e18_dwd_user_register", "user_id:l dt:s create_time:s channel:s province_id:s version_code:s mid_id:s brand:s model:s operate_system:s",
     lambda w: shop_dwd.user_register(w.user_info, w.z_log))
_add("e19_dws_province_order_1d", f"{_PROVINCE} dt:s {_amounts('1d')}", lambda w: w.province_1d)
_add("e20_dws_province_order_nd", f"{_PROVINCE} {_amounts('7d')} {_amounts('30d')}",
     lambda w: shop_dws.province_order_nd(w.province_1d, w.order_day))
_add("e21_dws_sku_favor_1d", f"sku_id:l sku_name:s {_CATEGORY} {_BRAND} favor_add_count_1d:l dt:s",
     lambda w: w.favor_1d)
_add("e22_dws_user_coupon_used_1d", "user_id:l coupon_id:i coupon_name:s coupon_type_code:s coupon_type_name:s benefit_rule:s used_count_1d:l dt:s",
     lambda w: w.coupon_1d)
_add("e23_dws_user_cart_1d", "user_id:l cart_add_count_1d:l cart_add_num_1d:l dt:s", lambda w: w.cart_1d)
_add("e24_dws_user_order_1d", f"user_id:l dt:s {_amounts('1d', 'order_count order_num')}", lambda w: w.order_1d)
_add("e25_dws_user_order_td", "user_id:l order_date_first:s order_date_last:s order_count_td:l order_num_td:l original_amount_td:d activity_reduce_amount_td:d coupon_reduce_amount_td:d total_amount_td:d",
     lambda w: shop_dws.user_order_td(w.order_1d, w.last_day))
_add("e26_dws_user_payment_1d", "user_id:l payment_count_1d:l payment_num_1d:l payment_amount_1d:d dt:s",
     lambda w: w.payment_1d)
_add("e27_dws_user_sku_order_1d", f"user_id:l sku_id:l sku_name:s {_CATEGORY} {_BRAND} dt:s {_amounts('1d', 'order_count order_num')}",
     lambda w: w.user_sku_1d)
_add("e28_dws_user_sku_order_nd", f"user_id:l sku_id:l sku_name:s {_CATEGORY} {_BRAND} {_amounts('7d', 'order_count order_num')} {_amounts('30d', 'order_count order_num')}",
     lambda w: shop_dws.user_sku_order_nd(w.user_sku_1d, w.order_day))
_add("e29_dws_visitor_page_1d", "mid_id:s brand:s model:s operate_system:s page_id:s dt:s during_time_1d:l view_count_1d:l",
     lambda w: shop_dws.visitor_page_1d(w.page_view))
_add("e30_dws_session_page_1d", "session_id:s mid_id:s brand:s model:s operate_system:s version_code:s channel:s dt:s during_time_1d:l page_count_1d:l",
     lambda w: shop_dws.session_page_1d(w.page_view))
_add("e31_dws_user_login_td", "user_id:l login_date_last:s login_date_first:s login_count_td:l",
     lambda w: w.login_td(w.event_day))
_add("e32_ads_coupon_stats", "dt:s coupon_id:i coupon_name:s used_count:l used_user_count:l",
     lambda w: shop_ads.coupon_stats(w.coupon_1d, w.order_day))
_add("e33_ads_new_order_user", "dt:s recent_days:i new_order_user_count:l",
     lambda w: shop_ads.new_order_user_stats(shop_dws.user_order_td(w.order_1d, w.order_day), w.order_day))
_add("e34_ads_order_by_province", f"dt:s recent_days:i {_PROVINCE} order_count:l order_total_amount:d",
     lambda w: shop_ads.order_by_province(w.province_1d, w.order_day))
for _letter, _method in zip("abcd", ("lead", "islands", "bitmap", "one_gap")):
    _add(f"e35{_letter}_ads_order_streak_{_method}", "dt:s recent_days:i order_continuously_user_count:l",
         lambda w, m=_method: shop_ads.order_streaks(w.purchase_1d, w.event_day, m))
_add("e36_ads_order_by_category", f"dt:s recent_days:i {_CATEGORY} order_count:l order_user_count:l",
     lambda w: shop_ads.order_stats_by_category(w.user_sku_1d, w.order_day))
_add("e37_ads_order_by_brand", f"dt:s recent_days:i {_BRAND} order_count:l order_user_count:l",
     lambda w: shop_ads.order_stats_by_brand(w.user_sku_1d, w.order_day))
_add("e38_ads_order_to_pay_interval", "dt:s order_to_pay_interval_avg:l",
     lambda w: shop_ads.order_to_pay_interval(w.trade_flow, w.last_day))
_add("e39_ads_page_path", "dt:s source:s target:s path_count:l",
     lambda w: shop_ads.page_path(w.page_view_in(1), w.event_day))
_add("e40_ads_repeat_purchase_by_brand", f"dt:s recent_days:i {_BRAND} order_repeat_rate:d",
     lambda w: shop_ads.repeat_purchase_by_brand(w.user_sku_1d, w.order_day))
_add("e41_ads_cart_top3_by_category", f"dt:s {_CATEGORY} sku_id:l sku_name:s cart_num:l rk:i",
     lambda w: shop_ads.cart_top3_by_category(shop_dwd.cart_full(w.cart_info), w.sku, w.event_day))
_add("e42_ads_favor_top3_by_brand", f"dt:s {_BRAND} sku_id:l sku_name:s favor_add_count_1d:l rk:i",
     lambda w: shop_ads.favor_top3_by_brand(w.favor_1d, w.event_day))
_add("e43_ads_traffic_by_channel", "dt:s recent_days:i channel:s uv_count:l avg_duration_sec:l avg_page_count:l sv_count:l bounce_rate:d",
     lambda w: shop_ads.traffic_by_channel(shop_dws.session_page_1d(w.page_view_in(30)), w.event_day))
_add("e44_ads_user_action", "dt:s home_count:l good_detail_count:l cart_count:l order_count:l payment_count:l",
     lambda w: shop_ads.user_action(
         shop_dws.visitor_page_1d(w.page_view_in(1)), w.cart_1d, w.order_run_day(w.order_1d),
         w.order_run_day(w.payment_1d), w.event_day))
_add("e45_ads_user_change", "dt:s user_churn_count:l user_back_count:l",
     lambda w: shop_ads.user_change(
         w.user_info, w.login, w.event_day))
_add("e46_ads_user_retention", "dt:s create_date:s retention_day:i retention_count:l new_user_count:l retention_rate:d",
     lambda w: shop_ads.user_retention(w.login_td(w.event_day), w.event_day))
_add("e47_ads_user_stats", "dt:s recent_days:i new_user_count:l active_user_count:l",
     lambda w: shop_ads.user_stats(w.login_td(w.event_day), w.event_day))

# ---------------------------------------------------------------- logistics

_CARGO = "id:s order_id:l cargo_type:s cargo_type_name:s volume_length:i volume_width:i volume_height:i weight:d"
_WAYBILL = (
    "order_no:s status:s status_name:s collect_type:s collect_type_name:s user_id:l "
    "receiver_complex_id:l receiver_province_id:l receiver_city_id:l receiver_district_id:l receiver_name:s "
    "sender_complex_id:l sender_province_id:l sender_city_id:l sender_district_id:l sender_name:s "
    "cargo_num:i amount:d estimate_arrive_time:s distance:d dt:s"
)
_PAYTYPE = "payment_type:s payment_type_name:s"
_MODEL = " ".join(f"{c}:d" for c in tms_dim.MODEL)

_add("l1_dim_complex", "id:l complex_name:s courier_emp_ids:s province_id:l province_name:s city_id:l city_name:s district_id:l district_name:s",
     lambda w: tms_dim.complex_full(w.base_complex, w.region_info, w.express_courier_complex))
_add("l2_dim_organ", "id:l org_name:s org_level:i region_id:l region_name:s region_code:s org_parent_id:l org_parent_name:s",
     lambda w: tms_dim.organ_full(w.base_organ, w.region_info))
_add("l3_dim_region", "id:l parent_id:l name:s dict_code:s", lambda w: tms_dim.region_full(w.region_info))
_add("l4_dim_express_courier", "id:l emp_id:s org_id:l org_name:s working_phone:s express_type:s express_type_name:s",
     lambda w: tms_dim.express_courier_full(w.express_courier, w.base_organ, w.tms_dic))
_add("l5_dim_shift", "id:l line_id:l line_name:s line_no:s line_level:i org_id:l transport_line_type_id:s transport_line_type_name:s start_org_id:l start_org_name:s end_org_id:l end_org_name:s pair_line_id:l distance:d cost:d estimated_time:l start_time:s driver1_emp_id:l driver2_emp_id:l truck_id:l pair_shift_id:l",
     lambda w: w.line_info_shifts)
_add("l6_dim_truck_driver", "id:l emp_id:s org_id:l org_name:s team_id:l team_name:s license_type:s init_license_date:s expire_date:s license_no:s is_enabled:i",
     lambda w: tms_dim.truck_driver_full(w.truck_driver, w.base_organ, w.truck_team))
_add("l7_dim_truck", f"id:l team_id:l team_name:s team_no:s org_id:l org_name:s manager_emp_id:l truck_no:s truck_model_id:l truck_model_name:s truck_model_type:s truck_model_type_name:s truck_model_no:s truck_brand:s truck_brand_name:s {_MODEL} device_gps_id:s engine_no:s license_registration_date:s license_last_check_date:s license_expire_date:s is_enabled:i",
     lambda w: tms_dim.truck_full(w.truck_info, w.truck_team, w.truck_model, w.base_organ, w.tms_dic))
_add("l8_dim_user_zip", "id:l login_name:s nick_name:s passwd:s realname:s phone_num:s email:s user_level:s birthday:s gender:s start_date:s end_date:s",
     lambda w: tms_dim.user_zip(w.user_info))
_add("l9_dim_user_address_zip", "id:l user_id:l phone:s province_id:l city_id:l district_id:l complex_id:l address:s is_default:i start_date:s end_date:s",
     lambda w: tms_dim.user_address_zip(w.tms_user_address))
_add("l10_dwd_order_detail", f"{_CARGO} order_time:s {_WAYBILL}", lambda w: w.tms_order)
for _key, _step in {
    "l11_dwd_pay_suc": tms_dwd.PAID, "l12_dwd_order_cancel": tms_dwd.CANCELLED,
    "l13_dwd_receive": tms_dwd.RECEIVED, "l14_dwd_dispatch": tms_dwd.DISPATCHED,
    "l15_dwd_bound_finish": tms_dwd.BOUND_FINISHED,
}.items():
    _add(_key, f"{_CARGO} {_step.time}:s {_PAYTYPE} {_WAYBILL}", lambda w, s=_step: w.tms_from_open(s))
for _key, _step in {
    "l16_dwd_deliver_suc": tms_dwd.DELIVERED, "l17_dwd_sign": tms_dwd.SIGNED,
}.items():
    _add(_key, f"{_CARGO} {_step.time}:s {_PAYTYPE} {_WAYBILL}", lambda w, s=_step: w.tms_milestone(s))
_add("l18_dwd_order_process", f"{_CARGO} order_time:s {_PAYTYPE} {_WAYBILL} start_date:s end_date:s",
     lambda w: tms_dwd.order_process(w.order_cargo, w.tms_order_info, w.tms_dic))
_add("l19_dwd_trans_finish", "id:s shift_id:l line_id:l start_org_id:l start_org_name:s end_org_id:l end_org_name:s order_num:l driver1_emp_id:l driver1_name:s driver2_emp_id:l driver2_name:s truck_id:l truck_no:s actual_start_time:s actual_end_time:s estimate_end_time:s actual_distance:d finish_dur_sec:l dt:s",
     lambda w: w.trips)
for _n, _scan, _employee in ((20, "inbound", "inbound_emp_id"), (21, "sort", "sorter_emp_id"), (22, "outbound", "outbound_emp_id")):
    _add(f"l{_n}_dwd_{_scan}", f"id:s order_id:l org_id:l {_scan}_time:s {_employee}:l dt:s",
         lambda w, s=_scan, e=_employee: tms_dwd.bound(w.org_bound, s, e))

_ORG, _CITY, _PROV = "org_id:l org_name:s", "city_id:l city_name:s", "province_id:l province_name:s"
_CT = "cargo_type:s cargo_type_name:s"
_ORD = "order_count:l order_amount:d"
_TRIP = "trans_finish_count:l trans_finish_distance:d trans_finish_dur_sec:l"
_MEAN = "avg_trans_finish_distance:d avg_trans_finish_dur_sec:d"
_TM = "truck_model_type:s truck_model_type_name:s"
_STAMP = "dt:s recent_days:i"

_add("l23_dws_org_cargo_order_1d", f"{_ORG} {_CITY} {_CT} {_ORD} dt:s", lambda w: w.cargo_1d)
_add("l24_dws_org_cargo_order_nd", f"{_ORG} {_CITY} {_CT} recent_days:i {_ORD}", lambda w: w.cargo_nd())
_add("l25_dws_org_receive_1d", f"{_ORG} {_CITY} {_PROV} {_ORD} dt:s", lambda w: w.receive_1d)
_add("l26_dws_org_receive_nd", f"{_ORG} {_CITY} {_PROV} recent_days:i {_ORD}", lambda w: w.receive_nd())
_add("l27_dws_dispatch_1d", f"{_ORD} dt:s", lambda w: w.dispatch_1d)
_add("l28_dws_dispatch_nd", f"recent_days:i {_ORD}", lambda w: w.dispatch_nd())
_add("l29_dws_dispatch_td", _ORD, lambda w: w.dispatch_td)
_add("l30_dws_bound_finish_td", _ORD, lambda w: w.finish_td)
_add("l31_dws_org_deliver_1d", f"{_ORG} {_CITY} {_PROV} order_count:l dt:s", lambda w: w.deliver_1d)
_add("l32_dws_org_deliver_nd", f"{_ORG} {_CITY} {_PROV} recent_days:i order_count:l", lambda w: w.deliver_nd())
_add("l33_dws_org_sort_1d", f"{_ORG} {_CITY} {_PROV} sort_count:l dt:s", lambda w: w.sort_1d)
_add("l34_dws_org_sort_nd", f"{_ORG} {_CITY} {_PROV} recent_days:i sort_count:l", lambda w: w.sort_nd())
_add("l35_dws_org_truck_trips_1d", f"{_ORG} {_TM} {_TRIP} dt:s", lambda w: w.trips_1d)
_add("l36_dws_shift_trips_nd", f"shift_id:l {_CITY} {_ORG} line_id:l line_name:s driver1_emp_id:l driver1_name:s driver2_emp_id:l driver2_name:s truck_id:l {_TM} recent_days:i {_TRIP} trans_finish_order_count:l trans_finish_delay_count:l",
     lambda w: w.shift_nd())
_add("l37_ads_trans_order_stats", f"{_STAMP} receive_order_count:l receive_order_amount:d dispatch_order_count:l dispatch_order_amount:d",
     lambda w: tms_ads.trans_order_stats(w.receive_nd(SPANS), w.dispatch_nd(SPANS), w.order_day))
_add("l38_ads_trans_stats", f"{_STAMP} {_TRIP}",
     lambda w: tms_ads.trans_stats(tms_ads.with_today(w.trips_1d, w.shift_nd(), w.order_day), w.order_day))
_add("l39_ads_trans_order_stats_td", "dt:s bounding_order_count:l bounding_order_amount:d",
     lambda w: tms_ads.trans_order_stats_td(w.dispatch_td, w.finish_td, w.last_day))
_add("l40_ads_order_stats", f"{_STAMP} {_ORD}", lambda w: tms_ads.order_stats(w.cargo_nd(SPANS), w.order_day))
_add("l41_ads_order_cargo_stats", f"{_STAMP} {_CT} {_ORD}",
     lambda w: tms_ads.order_cargo_stats(w.cargo_nd(SPANS), w.order_day))
_add("l42_ads_city_stats", f"{_STAMP} {_CITY} {_ORD} {_TRIP} {_MEAN}",
     lambda w: tms_ads.city_stats(w.cargo_nd(SPANS), w.place_trips_nd(SPANS), w.order_day))
_add("l43_ads_org_stats", f"{_STAMP} {_ORG} {_ORD} {_TRIP} {_MEAN}",
     lambda w: tms_ads.org_stats(w.cargo_nd(SPANS), w.place_trips_nd(SPANS), w.order_day))
_add("l44_ads_shift_stats", f"{_STAMP} shift_id:l {_TRIP} trans_finish_order_count:l",
     lambda w: tms_ads.shift_stats(w.shift_nd(), w.order_day))
_add("l45_ads_line_stats", f"{_STAMP} line_id:l line_name:s {_TRIP} trans_finish_order_count:l",
     lambda w: tms_ads.line_stats(w.shift_nd(), w.order_day))
_add("l46_ads_driver_stats", f"{_STAMP} driver_emp_id:l driver_name:s trans_finish_count:l trans_finish_distance:d trans_finish_dur_sec:d {_MEAN}",
     lambda w: tms_ads.driver_stats(w.shift_nd(), w.order_day))
_add("l47_ads_truck_stats", f"{_STAMP} {_TM} {_TRIP} {_MEAN}", lambda w: tms_ads.truck_stats(w.shift_nd(), w.order_day))
_add("l48_ads_express_stats", f"{_STAMP} deliver_suc_count:l sort_count:l",
     lambda w: tms_ads.express_stats(w.deliver_nd(SPANS), w.sort_nd(SPANS), w.order_day))
for _n, _place, _cols in ((49, "province", _PROV), (50, "city", _CITY), (51, "org", _ORG)):
    _add(f"l{_n}_ads_express_{_place}_stats",
         f"{_STAMP} {_cols} receive_order_count:l receive_order_amount:d deliver_suc_count:l sort_count:l",
         lambda w, p=_place: tms_ads.express_place_stats(
             p, w.receive_nd(SPANS), w.deliver_nd(SPANS), w.sort_nd(SPANS), w.order_day))

# ---------------------------------------------------------------- product marts

_BEHAVIOUR = "product_id:s product_name:s traffic_cnt:l click_cnt:l"
_add("pd1_ods_product_behaviour", f"{_BEHAVIOUR} conversion_rate:d content_interact_cnt:l new_user_cnt:l service_rating:d sales_amount:d sales_cnt:l visitor_cnt:l stat_date:s",
     lambda w: w.product_behaviour)
_add("pd2_dwd_product_behaviour", f"{_BEHAVIOUR} category:s click_rate:d conversion_rate:d content_interact_cnt:l new_user_cnt:l visitor_cnt:l service_rating:d sales_amount:d sales_cnt:l avg_price:d stat_date:s",
     lambda w: diagnosis.cleaned(w.product_behaviour))
_add("pd3_dwd_product_narrow", f"{_BEHAVIOUR} category:s click_rate:d stat_date:s",
     lambda w: diagnosis.cleaned_narrow(w.product_behaviour))
_add("pd4_dws_product_daily", f"{_BEHAVIOUR} click_rate:d conversion_rate:d content_interact_cnt:l content_interact_rate:d new_user_cnt:l visitor_cnt:l new_user_rate:d service_rating:d sales_amount:d sales_cnt:l avg_price:d stat_date:s",
     lambda w: w.rates)
_SCORE = "product_id:s product_name:s total_score:d score_level:s traffic_rank:i conversion_rank:i content_rank:i new_user_rank:i service_rank:i competitiveness_index:d stat_date:s"
_add("pd5_ads_product_diagnosis", _SCORE, lambda w: diagnosis.scored(w.rates, diagnosis.DIAGNOSIS))
_add("pd6_ads_product_value", _SCORE, lambda w: diagnosis.scored(w.rates, diagnosis.VALUE))

_SEND = "send_id:s activity_id:s product_id:s sku_id:s customer_id:s service_id:s send_discount_amount:i validity_period:i send_time:s expire_time:s remark:s"
_add("dt1_ods_discount_send", _SEND, lambda w: discount.sends_with_expiry(w.discount_send))
_add("dt2_ods_discount_verify", "verify_id:s send_id:s order_id:s pay_amount:d verify_time:s buy_count:i",
     lambda w: discount.cleaned_verify(w.discount_verify))
_add("dt3_dwd_discount_activity", "activity_id:s activity_name:s activity_level:s discount_type:s max_discount_amount:i start_time:s end_time:s status:s create_time:s update_time:s",
     lambda w: w.activity)
_add("dt4_dwd_product_discount", "rel_id:s activity_id:s product_id:s sku_id:s discount_type:s fixed_discount_amount:i custom_discount_limit:i max_buy_count:i add_time:s",
     lambda w: discount.product_discount(w.discount_product, w.activity))
_add("dt5_dwd_discount_send", f"{_SEND} discount_type:s", lambda w: w.sends)
_add("dt6_dwd_discount_verify", "verify_id:s send_id:s order_id:s pay_amount:d verify_time:s buy_count:i send_discount_amount:i customer_id:s service_id:s product_id:s activity_id:s",
     lambda w: w.verified)
_add("dt7_dws_activity_effect", "activity_id:s activity_name:s status:s discount_type:s dt:s daily_send_count:l daily_send_amount:l daily_verify_count:l daily_verify_amount:d daily_buy_count:l daily_pay_customer_count:l",
     lambda w: w.activity_1d)
_add("dt8_dws_agent_performance", "service_id:s dt:s total_send_count:l total_send_amount:l total_verify_count:l total_verify_amount:d conversion_rate:d",
     lambda w: w.agent_1d)
_TOOL = "time_type:s start_date:s end_date:s total_send_count:l total_send_amount:l total_pay_count:l total_pay_amount:d pay_customer_num:l avg_pay_per_customer:d"
_FRAMES = {"": ("range", discount.ENDS), "_rows": ("rows", discount.ENDS), "_last7": ("range", 7), "_rows_last7": ("rows", 7)}
for _suffix, _how in _FRAMES.items():  # the last 7 ends show that windows reach back before the first end
    _add(f"dt9_ads_tool_overview{_suffix}", _TOOL,
         lambda w, how=_how: discount.tool_overview(w.activity_1d, w.verified, w.event_day, *how))
_AGENT = "service_id:s time_type:s start_date:s end_date:s send_count:l send_amount:l pay_count:l pay_amount:d conversion_rate:d"
for _suffix, _how in _FRAMES.items():
    _add(f"dt10_ads_agent_detail{_suffix}", _AGENT,
         lambda w, how=_how: discount.agent_windows(w.agent_1d, w.event_day, *how))

_add("mm1_ods_visit_log", "log_id:s user_id:s product_id:s visit_time:s terminal:s stay_time:i is_click:i",
     lambda w: w.visit_log)
_add("mm2_ods_product_order", "order_id:s user_id:s product_id:s product_price:d buy_count:i buy_amount:d pay_status:s pay_time:s pay_amount:d terminal:s create_time:s order_date:s",
     lambda w: macro.cleaned_orders(w.product_order))
_add("mm3_dwd_visit", "visit_id:s user_id:s product_id:s category_id:s visit_time:s terminal:s stay_time:i is_click:i dt:s",
     lambda w: macro.visit_detail(w.visit_log, w.products))
_add("mm4_dwd_favourite_cart", "record_id:s user_id:s product_id:s category_id:s op_type:s op_time:s add_cart_count:i terminal:s dt:s",
     lambda w: macro.add_detail(w.product_add, w.products))
_add("mm5_dwd_trade", "order_id:s user_id:s product_id:s category_id:s product_price:d buy_count:i buy_amount:d pay_status:s pay_time:s pay_amount:d terminal:s dt:s",
     lambda w: macro.trade_detail(macro.cleaned_orders(w.product_order), w.products))
_VISIT = "visitor_count:l view_count:l avg_stay_time:d bounce_rate:d"
_ADD = "favorite_user_count:l add_to_cart_quantity:l add_to_cart_user_count:l"
_TRADE = "order_user_count:l order_quantity:l order_amount:d pay_user_count:l pay_quantity:l pay_amount:d"
_PRODUCT = "statistical_time:s product_id:s product_name:s category_id:s category_name:s"
_R1 = "visit_to_collect_rate:d visit_to_add_to_cart_rate:d"
_R2 = "order_conversion_rate:d payment_conversion_rate:d avg_order_value:d avg_visitor_value:d"
_add("mm6_dws_product_daily", f"product_id:s category_id:s dt:s {_VISIT} {_ADD} {_TRADE} buyer_count:l", lambda w: w.macro_1d)
_add("mm7_ads_macro_monitor", f"{_PRODUCT} {_VISIT} {_ADD} {_TRADE} {_R1} {_R2}",
     lambda w: macro.macro_monitor(w.macro_1d, w.products, w.event_day))
_add("mm8_ads_visit_stats", f"{_PRODUCT} {_VISIT}", lambda w: macro.visit_stats(w.macro_1d, w.products, w.event_day))
_add("mm9_ads_interaction_stats", f"{_PRODUCT} {_ADD} {_R1}",
     lambda w: macro.interaction_stats(w.macro_1d, w.products, w.event_day))
_add("mm10_ads_transaction_stats", f"{_PRODUCT} {_TRADE} {_R2}",
     lambda w: macro.transaction_stats(w.macro_1d, w.products, w.event_day))

_add("rk1_ods_price_strength", "goods_id:s price_strength_star:i is_low_star:i record_date:s", lambda w: w.price_strength)
_add("rk2_dwd_sales_clean", "goods_id:s sku_id:s total_sales:d total_sales_num:i pay_buyer_num:i pay_date:s",
     lambda w: goods.sales_clean(w.goods_sales))
_add("rk3_dwd_traffic_clean", "goods_id:s traffic_source:s visitor_num:i pay_conver_rate:d visit_date:s",
     lambda w: goods.traffic_clean(w.goods_traffic, w.goods_sales))
_add("rk4_dws_sales_sum", "goods_id:s category_name:s total_sales:d total_sales_num:l stat_date:s", lambda w: w.goods_1d)
_add("rk5_dws_price_strength_sum", "category_name:s excellent_num:l poor_num:l stat_date:s",
     lambda w: goods.price_strength_sum(w.price_strength, w.goods_base))
_add("rk6_ads_all_goods_rank", "rank:l goods_id:s goods_name:s total_sales:d total_sales_num:l category_name:s stat_date:s",
     lambda w: goods.all_goods_rank(w.goods_1d, w.goods_base))
_add("rk7_ads_price_warning", "goods_id:s goods_name:s warn_reason:s warn_date:s",
     lambda w: goods.price_warnings(w.price_strength, w.goods_base))

# ---------------------------------------------------------------- change capture and security


def _current_profiles(w: Layers) -> DataFrame:
    root, row = scratch(w.spark, "cdc"), "id bigint, state string, balance decimal(16,2)"
    w.change_log.write.text(f"{root}/log")
    cdc.run(cdc.read_changes(w.spark, f"{root}/log", row), "id", f"{root}/state", f"{root}/progress")
    return cdc.current(w.spark, f"{root}/state", row)


def _handed_over(w: Layers) -> DataFrame:
    """A snapshot of the table as it was when the last day began, then the whole log, folded once."""
    root, row = scratch(w.spark, "cdc"), "id bigint, state string, balance decimal(16,2)"
    position = int(dt.datetime.combine(w.event_day, dt.time(), dt.UTC).timestamp() * 1000)
    last = F.max_by(F.struct(F.col("event_type").alias("state"), F.col("value").cast("decimal(16,2)").alias("balance")),
                    F.struct(F.unix_millis("ts"), "event_id"))
    before = w.events.where(F.unix_millis("ts") < position).groupBy(F.col("user_id").alias("id")).agg(last.alias("c"))
    cdc.start(before.select("id", "c.*").where(F.col("state") != "error"), "id", f"{root}/state", position, -1)
    w.change_log.write.text(f"{root}/log")
    cdc.run(cdc.read_changes(w.spark, f"{root}/log", row), "id", f"{root}/state", f"{root}/progress")
    cdc.compact(w.spark, f"{root}/state")
    return cdc.current(w.spark, f"{root}/state", row)


def _sealed(w: Layers) -> DataFrame:
    """The encrypted table, stored: each row is sealed once, under one random IV."""
    return written(security.encrypt(w.telemetry, "payload", security.column_key(w.spark)))


def _opened(w: Layers) -> DataFrame:
    good, _ = security.split_rejects(_sealed(w), "payload", security.column_key(w.spark))
    return good


_add("c1_cdc_current_state", "id:l state:s balance:d", _current_profiles)
_add("c1_cdc_snapshot_handover", "id:l state:s balance:d", _handed_over)
_add("c2_column_round_trip", "event_id:l payload:s", _opened)
_add("c3_telemetry", "event_id:l vehicle_no:s report_time:s lon:d lat:d altitude:i direction:i acc:i door:i alarms:s",
     lambda w: security.telemetry(_opened(w)))

# ---------------------------------------------------------------- landing files


def _landed(kind: str, raw: str) -> Callable[[Layers], DataFrame]:
    """The raw rows written as landing files and loaded by their declared layout."""
    def build(w: Layers) -> DataFrame:
        path = scratch(w.spark, "landing")
        files.land(getattr(w, raw), path, kind)
        return files.load_landing(w.spark, path, kind)

    return build


for _name, _kind, _raw in (
    ("pd1_ods_product_behaviour", "product_behaviour", "product_behaviour"),
    ("dt2_ods_discount_verify", "discount_verify", "discount_verify"),
    ("mm1_ods_visit_log", "product_visit", "visit_log"),
    ("mm2_ods_product_order", "product_order", "product_order"),
    ("rk1_ods_price_strength", "price_strength", "price_strength"),
):
    QUERIES[_name] = Query(QUERIES[_name].contract, _landed(_kind, _raw))
_add("dt1_ods_discount_activity", "activity_id:s activity_name:s activity_level:s discount_type:s max_discount_amount:i start_time:s end_time:s status:s create_time:s update_time:s is_valid:i",
     _landed("discount_activity", "discount_activity"))
QUERIES["dt1_ods_discount_send"] = Query(_SEND, lambda w: discount.sends_with_expiry(_landed("discount_send", "discount_send")(w)))
_add("dt1_ods_product_relation", "rel_id:s activity_id:s product_id:s sku_id:s fixed_discount:i max_buy_count:i add_time:s is_delete:i",
     _landed("discount_product", "discount_product"))
_add("mm1_ods_favourite_cart", "record_id:s user_id:s product_id:s op_type:s op_time:s add_cart_count:i terminal:s",
     _landed("product_add", "product_add"))
_add("mm2_ods_product", "product_id:s product_name:s category_id:s category_name:s product_price:d update_date:s",
     _landed("product", "product"))
_add("rk1_ods_goods_base", "goods_id:s goods_name:s category_id:s category_name:s shop_id:s is_price_strength:i",
     _landed("goods_base", "goods_base"))
_add("rk1_ods_goods_sales", "goods_id:s sku_id:s pay_amount:d sales_num:i pay_buyer_num:i pay_date:s",
     _landed("goods_sales", "goods_sales"))
_add("rk1_ods_goods_traffic", "goods_id:s traffic_source:s visitor_num:i visit_date:s",
     _landed("goods_traffic", "goods_traffic"))

# ---------------------------------------------------------------- snapshot dates

#: Tables that hold a state and not events: their rows carry the day of the snapshot, so that each
#: load writes its own partition.  Validity intervals are stored by the day they end.
SNAPSHOTS = {
    **dict.fromkeys((
        "e1_dim_activity", "e2_dim_coupon", "e4_dim_promotion_pos", "e5_dim_promotion_refer", "e6_dim_province",
        "e7_dim_sku", "e12_dwd_cart_full", "e31_dws_user_login_td"), "event_day"),
    **dict.fromkeys((
        "e20_dws_province_order_nd", "e28_dws_user_sku_order_nd", "l24_dws_org_cargo_order_nd", "l26_dws_org_receive_nd",
        "l28_dws_dispatch_nd", "l32_dws_org_deliver_nd", "l34_dws_org_sort_nd", "l36_dws_shift_trips_nd"), "order_day"),
    **dict.fromkeys((
        "e25_dws_user_order_td", "l1_dim_complex", "l2_dim_organ", "l3_dim_region", "l4_dim_express_courier", "l5_dim_shift",
        "l6_dim_truck_driver", "l7_dim_truck", "l29_dws_dispatch_td", "l30_dws_bound_finish_td"), "last_day"),
    **dict.fromkeys(("e8_dim_user_zip", "l8_dim_user_zip", "l9_dim_user_address_zip"), "end_date"),
}


def _dated(build: Callable[[Layers], DataFrame], day: str) -> Callable[[Layers], DataFrame]:
    return lambda w: build(w).withColumn("dt", F.col(day) if day == "end_date" else F.lit(getattr(w, day)))


for _name, _day in SNAPSHOTS.items():
    _query = QUERIES[_name]
    QUERIES[_name] = Query(f"{_query.contract} dt:s", _dated(_query.build, _day))
