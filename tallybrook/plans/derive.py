"""The shop's records, derived from the driver's tables.

Every function takes frames (static or streaming), so the batch queries and
their streamed twins share one derivation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallybrook.functions.times import stamp
from tallybrook.schemas import MONEY
from tallybrook.sources.files import table

DAY_MS = 24 * 3600 * 1000
# the fixed "now" of ages and processing-time columns
AS_OF = "2024-02-01 00:00:00"
AS_OF_MS = 1706745600000
# The part types in the order of their category numbers.
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def as_of() -> Column:
    return F.to_timestamp(F.lit(AS_OF))


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# -- behaviour log -----------------------------------------------------------
def page_log(events: DataFrame, with_start: bool = False) -> DataFrame:
    """Events as page views: signup is an entry page, a click comes from the
    search page, a view shows a product."""
    kind, uid = F.col("event_type"), F.col("user_id")
    k = F.get_json_object("props", "$.k")
    common = F.struct(
        text(uid).alias("mid"),
        F.when(kind.isin("signup", "view"), "1").otherwise("0").alias("is_new"),
        text(uid % 2).alias("vc"),
        text(uid % 3).alias("ch"),
        text(uid % 5).alias("ar"),
    )
    page = F.struct(
        F.when(kind == "view", "good_detail").otherwise(kind).alias("page_id"),
        F.when(kind == "click", "search").when(kind != "signup", "home").alias("last_page_id"),
        k.alias("item"),
        F.lit("sku_id").alias("item_type"),
        F.round(F.col("value") * 100).cast("bigint").alias("during_time"),
    )
    displays = F.array(
        F.struct(k.alias("item"), F.lit("sku_id").alias("item_type")),
        F.struct(
            text(k.cast("bigint") + 1).alias("item"),
            F.when(kind == "error", "promotion_id").otherwise("sku_id").alias("item_type"),
        ),
    )
    start = F.when(kind == "signup", '{"entry":"icon"}') if with_start else F.lit(None)
    return events.select(
        common.alias("common"),
        page.alias("page"),
        displays.alias("displays"),
        start.cast("string").alias("start"),
        F.unix_millis("ts").alias("ts"),
        F.col("event_id").alias("seq"),
    )


def log_lines(events: DataFrame) -> DataFrame:
    """The log as JSON lines, every tenth one cut off in the middle."""
    whole = F.to_json(F.struct("common", "page", "displays", "start", "ts"))
    return page_log(events, with_start=True).select(
        F.when(F.col("seq") % 10 == 0, F.substring(whole, 1, 40)).otherwise(whole).alias("value"),
        "seq",
    )


def stamped(events: DataFrame, kind: str) -> DataFrame:
    """One kind of event as a record with ``sku_id`` and ``create_time``."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.filter(F.col("event_type") == kind).select(
        k.alias("sku_id"),
        F.when(k % 4 == 0, "1201").otherwise("1202").alias("appraise"),
        stamp("ts").alias("create_time"),
    )


# -- facts -------------------------------------------------------------------
def order_info(orders: DataFrame, customer: DataFrame) -> DataFrame:
    home = customer.select("c_custkey", "c_nationkey")
    null_money = F.lit(None).cast(MONEY)
    return orders.join(home, orders["o_custkey"] == home["c_custkey"], "left").select(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").cast("bigint").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
        null_money.alias("activity_reduce_amount"),
        null_money.alias("coupon_reduce_amount"),
        F.col("o_totalprice").cast(MONEY).alias("original_total_amount"),
        null_money.alias("feight_fee"),
        stamp(F.date_add("o_orderdate", 1).cast("timestamp")).alias("expire_time"),
        stamp("o_orderdate").alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
    )


def order_detail(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").cast(MONEY).alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.lit(None).cast("string").alias("sku_name"),
        stamp("l_shipdate").alias("create_time"),
        F.col("l_extendedprice").cast(MONEY).alias("split_total_amount"),
        F.col("l_discount").cast(MONEY).alias("split_activity_amount"),
        F.col("l_tax").cast(MONEY).alias("split_coupon_amount"),
    )


def payment_info(orders: DataFrame) -> DataFrame:
    """One payment per order, up to 39 days after it; some without a user."""
    key = F.col("o_orderkey")
    return orders.select(
        key.alias("id"),
        key.alias("order_id"),
        F.when(key % 7 != 0, F.col("o_custkey")).alias("user_id"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
        F.col("o_orderpriority").alias("subject"),
        text(1101 + key % 3).alias("payment_type"),
        stamp(F.date_add("o_orderdate", (key % 40).cast("int")).cast("timestamp")).alias(
            "create_time"
        ),
        F.lit(None).cast("string").alias("callback_time"),
    )


def refund_info(lineitem: DataFrame) -> DataFrame:
    return lineitem.filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").cast(MONEY).alias("refund_amount"),
        stamp("l_shipdate").alias("create_time"),
    )


# -- dimensions --------------------------------------------------------------
def user_dim(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1960-01-01").cast("date"), (key % 15000).cast("int"))
    return customer.select(
        text(key).alias("ID"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("GENDER"),
        text(born).alias("BIRTHDAY"),
    )


def province_dim(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left").select(
        text("n_nationkey").alias("ID"),
        F.col("n_name").alias("NAME"),
        F.col("r_name").alias("AREA_CODE"),
        F.concat(F.lit("CN-"), text("n_nationkey")).alias("ISO_CODE"),
        F.concat(F.lit("R-"), text("n_regionkey")).alias("ISO_3166_2"),
    )


def product_dims(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    part, supplier = table(spark, folder, "part"), table(spark, folder, "supplier")
    brand = F.regexp_extract("p_brand", "([0-9]+)", 1)
    kind = text(F.array_position(F.array(*[F.lit(t) for t in PART_TYPES]), F.col("p_type")))
    return {
        "DIM_SKU_INFO": part.select(
            text("p_partkey").alias("ID"),
            F.col("p_name").alias("SKU_NAME"),
            text(F.col("p_retailprice").cast(MONEY)).alias("PRICE"),
            text(F.col("p_size") * F.col("p_size")).alias("SPU_ID"),
            brand.alias("TM_ID"),
            kind.alias("CATEGORY3_ID"),
        ),
        "DIM_SPU_INFO": supplier.select(
            text("s_suppkey").alias("ID"), F.col("s_name").alias("SPU_NAME")
        ),
        "DIM_BASE_TRADEMARK": part.select("p_brand").distinct().select(
            brand.alias("ID"), F.col("p_brand").alias("TM_NAME")
        ),
        "DIM_BASE_CATEGORY3": part.select("p_type").distinct().select(
            kind.alias("ID"), F.col("p_type").alias("NAME")
        ),
    }


def dims(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "DIM_USER_INFO": user_dim(table(spark, folder, "customer")),
        "DIM_BASE_PROVINCE": province_dim(spark, folder),
        **product_dims(spark, folder),
    }


# -- change feed -------------------------------------------------------------
def order_changes_raw(orders: DataFrame) -> DataFrame:
    """Debezium-like JSON records: every order is created, each third one is
    updated, each seventh one deleted."""
    key = F.col("o_orderkey")

    def row(status: Column) -> Column:
        return F.struct(
            text(key).alias("id"),
            text("o_custkey").alias("user_id"),
            status.alias("order_status"),
            text(F.col("o_totalprice").cast(MONEY)).alias("total_amount"),
        )

    old = row(F.col("o_orderstatus"))
    new = F.when(key % 3 == 0, row(F.lit("U"))).otherwise(old)
    gone = F.lit(None)

    def record(op: str, before: Column, after: Column, n: int) -> Column:
        shape = "struct<id:string,user_id:string,order_status:string,total_amount:string>"
        return F.struct(
            F.lit(op).alias("op"),
            before.cast(shape).alias("before"),
            after.cast(shape).alias("after"),
            (key * 10 + n).alias("seq"),
        )

    steps = F.array_compact(
        F.array(
            record("c", gone, old, 0),
            F.when(key % 3 == 0, record("u", old, new, 1)),
            F.when(key % 7 == 0, record("d", new, gone, 2)),
        )
    )
    steps = orders.select(F.explode(steps).alias("s"))
    return steps.select(
        F.lit("server.shop.order_info").alias("topic"),
        F.to_json(F.struct("s.before", "s.after", "s.op")).alias("value"),
        F.col("s.seq").alias("seq"),
    )
