"""Wide facts: order with its details and dimensions, payment with its order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallybrook.functions.columns import first_non_null, overlay
from tallybrook.functions.times import age_years, create_parts, parse_stamp, parse_stamp_or
from tallybrook.operators.joins import dim_join, interval_join
from tallybrook.schemas import ORDER_WIDE, PAYMENT_WIDE

MINUTE_MS = 60_000
PRODUCT_NAMES = ("spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name")


def with_create_parts(orders: DataFrame) -> DataFrame:
    """Add create_date, create_hour and create_ts."""
    day, hour, ts = create_parts("create_time")
    return (
        orders.withColumn("create_date", day)
        .withColumn("create_hour", hour)
        .withColumn("create_ts", ts)
    )


def join_details(
    orders: DataFrame,
    details: DataFrame,
    lower_ms: int = -5_000,
    upper_ms: int = 5_000,
    delay: str = "0 seconds",
    slice_ms: int | None = None,
) -> DataFrame:
    """Orders with their details, created within the bounds of each other.

    An order has one row, so the static form relies on AQE to split an order
    with very many details; see ``slice_ms`` of :func:`interval_join`.
    """
    o = orders.withColumn("_ot", parse_stamp("create_time"))
    d = details.withColumn("_dt", parse_stamp("create_time"))
    if orders.isStreaming:
        o, d = o.withWatermark("_ot", delay), d.withWatermark("_dt", delay)
    from_detail = {
        "detail_id": "r.id", "sku_id": "r.sku_id", "sku_name": "r.sku_name",
        "order_price": "r.order_price", "sku_num": "r.sku_num",
        "split_activity_amount": "r.split_activity_amount",
        "split_coupon_amount": "r.split_coupon_amount",
        "split_total_amount": "r.split_total_amount", "order_id": "l.id",
    }
    # parts of the creation time are made after the join, so that its state and shuffles
    # need not have them
    parts = ("create_date", "create_hour")
    have = set(o.columns)
    # names of the product, where the details have them already
    from_detail |= {c: f"r.{c}" for c in PRODUCT_NAMES if c in details.columns}
    cols = []
    for f in ORDER_WIDE.fields:
        if f.name in from_detail:
            c = F.col(from_detail[f.name])
        elif f.name in parts:
            continue
        elif f.name in have:
            c = F.col(f"l.{f.name}")
        else:  # dimension columns, filled later; there is no per-detail freight
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    time = ["_ot"] if orders.isStreaming else []
    cols += [F.col(f"l.{c}") for c in time]
    wide = interval_join(o, d, [("id", "order_id")], "_ot", "_dt", lower_ms, upper_ms,
                         project=cols, slice_ms=slice_ms)
    return with_create_parts(wide).select(*[f.name for f in ORDER_WIDE.fields], *time)


def _no_more_to_find(key: str, there: str) -> Column:
    """Whether a dimension row was found, or there is no key to look for."""
    return F.col(key).isNull() | F.coalesce(F.col(there), F.lit(False))


def snowflake(dims: Mapping[str, DataFrame], missing: str = "keep") -> DataFrame:
    """SKU with its SPU, trademark and category resolved; ``_whole`` says whether all
    that it names was found.

    Joining the dimensions with one another first means the facts are joined,
    and at scale shuffled, once instead of four times.
    """
    sku = dims["DIM_SKU_INFO"].select("ID", "SKU_NAME", "PRICE", "SPU_ID", "TM_ID", "CATEGORY3_ID")
    whole = F.lit(True)
    for dim, key, out, name in (
        ("DIM_SPU_INFO", "SPU_ID", "SPU_NAME", "SPU_NAME"),
        ("DIM_BASE_TRADEMARK", "TM_ID", "TM_NAME", "TM_NAME"),
        ("DIM_BASE_CATEGORY3", "CATEGORY3_ID", "CATEGORY3_NAME", "NAME"),
    ):
        sku = dim_join(sku, dims[dim], key, {out: name, f"_{key}": F.lit(True)}, missing=missing)
        whole = whole & _no_more_to_find(key, f"_{key}")
    return sku.withColumn("_whole", whole).drop("_SPU_ID", "_TM_ID", "_CATEGORY3_ID")


def _and_there(columns: dict, there: str | None, mark: Column) -> dict:
    return {**columns, there: mark} if there else columns


def enrich_user(wide: DataFrame, users: DataFrame, as_of: Column | None = None,
                missing: str = "keep", there: str | None = None) -> DataFrame:
    """Gender and age of the buyer; ``there`` names a column that is true where found."""
    columns = {"user_gender": "GENDER", "user_age": age_years("BIRTHDAY", as_of)}
    return dim_join(wide, users, "user_id", _and_there(columns, there, F.lit(True)), missing=missing)


def enrich_province(wide: DataFrame, provinces: DataFrame, missing: str = "keep",
                    there: str | None = None) -> DataFrame:
    """Name and codes of the province; ``there`` names a column that is true where found."""
    columns = {"province_name": "NAME", "province_area_code": "AREA_CODE",
               "province_iso_code": "ISO_CODE", "province_3166_2_code": "ISO_3166_2"}
    return dim_join(wide, provinces, "province_id", _and_there(columns, there, F.lit(True)), missing=missing)


def enrich_product(wide: DataFrame, flake: DataFrame, missing: str = "keep",
                   there: str | None = None) -> DataFrame:
    """SKU name, SPU, trademark and category of the product; ``there`` names a column
    that is true where all of them were found."""
    columns = {
        "sku_name": "SKU_NAME",
        "spu_id": F.col("SPU_ID").try_cast("bigint"),
        "tm_id": F.col("TM_ID").try_cast("bigint"),
        "category3_id": F.col("CATEGORY3_ID").try_cast("bigint"),
        "spu_name": "SPU_NAME", "tm_name": "TM_NAME", "category3_name": "CATEGORY3_NAME",
    }
    return dim_join(wide, flake, "sku_id", _and_there(columns, there, F.col("_whole") if there else None), missing=missing)


def enrich_order_wide(wide: DataFrame, dims: Mapping[str, DataFrame],
                      as_of: Column | None = None, missing: str = "keep") -> DataFrame:
    """All dimensions of the order-wide fact, on a static frame (on a stream:
    inside ``foreachBatch`` with freshly read dimensions)."""
    out = enrich_province(wide, dims["DIM_BASE_PROVINCE"], missing)
    out = enrich_user(out, dims["DIM_USER_INFO"], as_of, missing)
    out = enrich_product(out, snowflake(dims, missing), missing)
    return out.select([F.col(f.name).cast(f.dataType) for f in ORDER_WIDE.fields])


def join_enriched(orders: DataFrame, details: DataFrame, dims: Mapping[str, DataFrame], lower_ms: int, upper_ms: int,
                  as_of: Column | None = None, missing: str = "keep") -> DataFrame:
    """:func:`join_details` and :func:`enrich_order_wide` on static frames, where nearly all
    details find their order: orders get their buyer and province and details their
    product first, while their rows are short and fewer.  The facts come out placed by
    order, so that a join by order that follows need not shuffle them."""
    o = enrich_province(orders, dims["DIM_BASE_PROVINCE"], missing)
    o = enrich_user(o, dims["DIM_USER_INFO"], as_of, missing)
    d = enrich_product(details, snowflake(dims, missing), missing)
    return join_details(o, d, lower_ms, upper_ms)


def enrich_or_wait(wide: DataFrame, dims: Mapping[str, DataFrame], newest: Column, wait_ms: int,
                   time: str = "_ot", as_of: Column | None = None) -> DataFrame:
    """Order-wide facts with ``time`` and ``status``: ``found`` if every dimension row they
    ask for is there, ``timeout`` if one is not and their time is more than ``wait_ms``
    behind ``newest``, else ``waiting``.  A key that is NULL asks for nothing; a fact
    without a time can't wait.  A fact may come again, with what it had found before."""
    out = enrich_province(wide, dims["DIM_BASE_PROVINCE"], there="_province")
    out = enrich_user(out, dims["DIM_USER_INFO"], as_of, there="_user")
    out = enrich_product(out, snowflake(dims), there="_product")
    found = (
        _no_more_to_find("province_id", "_province")
        & _no_more_to_find("user_id", "_user")
        & _no_more_to_find("sku_id", "_product")
    )
    waiting = F.coalesce(F.unix_millis(time) + wait_ms >= newest, F.lit(False))
    status = F.when(found, "found").when(waiting, "waiting").otherwise("timeout")
    return out.select([F.col(f.name).cast(f.dataType) for f in ORDER_WIDE.fields] + [F.col(time), status.alias("status")])


def join_payments(
    payments: DataFrame,
    wide: DataFrame,
    lower_ms: int = -15 * MINUTE_MS,
    upper_ms: int = 5_000,
    delay: str = "0 seconds",
    record_time: Column | None = None,
    slice_ms: int | None = None,
) -> DataFrame:
    """Payments with the order-wide rows created up to 15 minutes before (or
    5 seconds after) them.  A payment's own fields win over the order's; its
    NULL fields do not.  A malformed creation stamp falls back to
    ``record_time`` (default: a column ``record_time``, if there is one)."""

    def at(df: DataFrame) -> Column:
        if record_time is not None:
            return parse_stamp_or("create_time", record_time)
        if "record_time" in df.columns:
            return parse_stamp_or("create_time", F.col("record_time"))
        return parse_stamp_or("create_time", F.lit(None).cast("timestamp"))

    p = payments.withColumn("_pt", at(payments))
    w = wide.withColumn("_wt", at(wide))
    if payments.isStreaming:
        p, w = p.withWatermark("_pt", delay), w.withWatermark("_wt", delay)
    pay_cols = [c for c in payments.columns if c != "record_time"]
    # the key is the same on both sides; as the payment's plain column it tells how rows are placed
    wide_cols = [c for c in wide.columns if c not in ("record_time", "_ot", "order_id")]
    cols = overlay(
        "r", wide_cols, "l", pay_cols,
        {"payment_id": "l.id", "payment_create_time": "l.create_time",
         "order_create_time": "r.create_time"},
    )
    joined = interval_join(p, w, [("order_id", "order_id")], "_pt", "_wt", lower_ms, upper_ms,
                           project=cols, slice_ms=slice_ms)
    return joined.select([F.col(f.name).cast(f.dataType) for f in PAYMENT_WIDE.fields])


def merge_wide(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Two partial wide records of one key, field by field the first non-NULL."""
    rest = [c for c in a.columns if c not in keys]
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return a.alias("a").join(b.alias("b"), cond, "inner").select(
        *[F.col(f"a.{k}") for k in keys], *first_non_null("a", "b", rest)
    )
