"""File sources with explicit schemas: JSON lines, headerless CSV, and their clean-up on load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Raw layouts of the landing files.
PRODUCT_BEHAVIOUR = (
    "product_id string, product_name string, traffic_cnt bigint, click_cnt bigint, "
    "conversion_rate double, content_interact_cnt bigint, new_user_cnt bigint, "
    "service_rating double, sales_amount decimal(16,2), sales_cnt bigint, visitor_cnt bigint, "
    "stat_date date, etl_time timestamp"
)
DISCOUNT_ACTIVITY = (
    "activity_id string, activity_name string, activity_level string, discount_type string, "
    "max_discount_amount int, start_time timestamp, end_time timestamp, status string, "
    "create_time timestamp, update_time timestamp, is_valid int, raw_data string"
)
DISCOUNT_PRODUCT = (
    "rel_id string, activity_id string, product_id string, sku_id string, fixed_discount int, "
    "max_buy_count int, add_time timestamp, is_delete int"
)
DISCOUNT_SEND = (
    "send_id string, activity_id string, product_id string, sku_id string, customer_id string, "
    "service_id string, send_discount_amount int, validity_period int, send_time timestamp, "
    "expire_time timestamp, remark string"
)
DISCOUNT_VERIFY = (
    "verify_id string, send_id string, order_id string, pay_amount string, verify_time string, "
    "buy_count int"
)
PRODUCT_VISIT = (
    "log_id string, user_id string, product_id string, visit_time timestamp, terminal string, "
    "stay_time int, is_click int, source string"
)
PRODUCT_ADD = (
    "record_id string, user_id string, product_id string, op_type string, op_time timestamp, "
    "add_cart_count int, terminal string"
)
PRODUCT = (
    "product_id string, product_name string, category_id string, category_name string, "
    "product_price decimal(10,2), update_time timestamp, update_date string"
)
PRODUCT_ORDER = (
    "order_id string, user_id string, product_id string, category_id string, "
    "product_price string, buy_count int, buy_amount string, pay_status string, pay_time string, "
    "pay_amount string, terminal string, create_time string, order_date string"
)
GOODS_BASE = (
    "goods_id string, goods_name string, category_id string, category_name string, "
    "shop_id string, is_price_strength int, create_time string"
)
GOODS_SALES = (
    "goods_id string, sku_id string, pay_amount double, sales_num int, pay_buyer_num int, "
    "pay_date string"
)
GOODS_TRAFFIC = "goods_id string, traffic_source string, visitor_num int, visit_date string"
PRICE_STRENGTH = "goods_id string, price_strength_star int, is_low_star int, record_date string"


def read_json(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """Headerless CSV with a declared schema, so no extra pass infers one."""
    return spark.read.schema(schema).csv(path, header=False)


def clean(
    df: DataFrame,
    decimals: Mapping[str, str] | None = None,
    stamps: Mapping[str, str] | None = None,
    required: Sequence[str] = (),
) -> DataFrame:
    """Load-time clean-up: text to decimals and timestamps (unreadable -> null), required keys."""
    parsed = {c: F.col(c).try_cast(kind) for c, kind in (decimals or {}).items()}
    parsed |= {
        c: F.try_to_timestamp(F.col(c), F.lit(fmt)) for c, fmt in (stamps or {}).items()
    }
    df = df.withColumns(parsed) if parsed else df
    for name in required:
        df = df.where(F.col(name).isNotNull())
    return df


def dated(df: DataFrame, stamp: str, into: str = "dt") -> DataFrame:
    """Partition by day rather than by full timestamp."""
    return df.withColumn(into, F.to_date(stamp))


@dataclass(frozen=True)
class Landing:
    """How a kind of landing file is read: its layout, its format, and the clean-up of its text fields."""

    schema: str
    fmt: str = "json"
    decimals: Mapping[str, str] = field(default_factory=dict)
    stamps: Mapping[str, str] = field(default_factory=dict)
    required: Sequence[str] = ()


LANDINGS = {
    "product_behaviour": Landing(PRODUCT_BEHAVIOUR, "csv", required=["product_id"]),
    "discount_activity": Landing(DISCOUNT_ACTIVITY, required=["activity_id"]),
    "discount_product": Landing(DISCOUNT_PRODUCT, required=["rel_id"]),
    "discount_send": Landing(DISCOUNT_SEND, required=["send_id"]),
    "discount_verify": Landing(
        DISCOUNT_VERIFY, decimals={"pay_amount": "decimal(10,2)"}, stamps={"verify_time": "yyyy-MM-dd'T'HH:mm:ss"},
        required=["verify_id", "send_id"]),
    "product_visit": Landing(PRODUCT_VISIT, required=["log_id"]),
    "product_add": Landing(PRODUCT_ADD, required=["record_id"]),
    "product": Landing(PRODUCT, required=["product_id"]),
    "product_order": Landing(
        PRODUCT_ORDER, decimals={c: "decimal(10,2)" for c in ("product_price", "buy_amount", "pay_amount")},
        stamps={c: "yyyy-MM-dd HH:mm:ss" for c in ("pay_time", "create_time")}, required=["order_id", "order_date"]),
    "goods_base": Landing(GOODS_BASE, required=["goods_id"]),
    "goods_sales": Landing(GOODS_SALES, required=["goods_id"]),
    "goods_traffic": Landing(GOODS_TRAFFIC, required=["goods_id"]),
    "price_strength": Landing(PRICE_STRENGTH, required=["goods_id"]),
}


def load_landing(spark: SparkSession, path: str | Sequence[str], kind: str) -> DataFrame:
    """Landing files of a kind, read by their declared layout and cleaned."""
    land = LANDINGS[kind]
    df = (read_csv if land.fmt == "csv" else read_json)(spark, path, land.schema)
    return clean(df, land.decimals, land.stamps, land.required)


def land(df: DataFrame, path: str, kind: str) -> None:
    """Write rows as landing files of a kind; columns the rows lack are left empty."""
    layout = T.StructType.fromDDL(LANDINGS[kind].schema)
    rows = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in layout])
    rows.write.csv(path, header=False) if LANDINGS[kind].fmt == "csv" else rows.write.json(path)
