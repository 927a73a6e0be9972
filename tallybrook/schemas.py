"""Record types of every layer and the column order of the result tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(16, 2)
MONEY_SUM = T.DecimalType(38, 2)


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "money": MONEY,
    "map": T.MapType(T.StringType(), T.StringType()),
}


def _struct(spec: str, **nested: T.DataType) -> T.StructType:
    """``"a:bigint b:string"`` to a StructType, without needing a session."""
    parts = [p.split(":", 1) for p in spec.split()]
    return T.StructType([T.StructField(n, nested.get(t) or _TYPES[t]) for n, t in parts])


# Fixed values from here on: names and order of fields, which records, sinks and
# reports bind by.
# -- behaviour log -----------------------------------------------------------
LOG = _struct(
    "common:common page:page displays:displays start:string ts:bigint",
    common=_struct(
        "mid:string is_new:string vc:string ch:string ar:string uid:string os:string md:string"
        " ba:string"
    ),
    page=_struct(
        "page_id:string last_page_id:string item:string item_type:string during_time:bigint"
        " source_type:string"
    ),
    displays=T.ArrayType(
        _struct("item:string item_type:string display_type:string order:string pos_id:string")
    ),
)
# what tells a record's visitor, time and kind
LOG_KEYS = _struct("common:common start:string ts:bigint", common=_struct("mid:string is_new:string"))
PAGE_TIME = _struct("page:page ts:bigint", page=_struct("page_id:string"))

# -- database changes --------------------------------------------------------
CHANGE = _struct("database:string tableName:string before:map after:map type:string")
RAW_CHANGE = _struct("op:string before:map after:map")
RULE = _struct(
    "sourceTable:string operateType:string sinkType:string sinkTable:string"
    " sinkColumns:string sinkPK:string sinkExtend:string"
)

# -- facts -------------------------------------------------------------------
ORDER_INFO = _struct(
    "id:bigint province_id:bigint order_status:string user_id:bigint total_amount:money"
    " activity_reduce_amount:money coupon_reduce_amount:money original_total_amount:money"
    " feight_fee:money expire_time:string create_time:string operate_time:string"
)
ORDER_DETAIL = _struct(
    "id:bigint order_id:bigint sku_id:bigint order_price:money sku_num:bigint sku_name:string"
    " create_time:string split_total_amount:money split_activity_amount:money"
    " split_coupon_amount:money"
)
PAYMENT_INFO = _struct(
    "id:bigint order_id:bigint user_id:bigint total_amount:money subject:string"
    " payment_type:string create_time:string callback_time:string"
)
FAVOR = _struct("sku_id:bigint create_time:string")
CART = FAVOR
REFUND = _struct("order_id:bigint sku_id:bigint refund_amount:money create_time:string")
COMMENT = _struct("sku_id:bigint appraise:string create_time:string")

ORDER_WIDE = _struct(
    "detail_id:bigint order_id:bigint sku_id:bigint order_price:money sku_num:bigint"
    " sku_name:string province_id:bigint order_status:string user_id:bigint total_amount:money"
    " activity_reduce_amount:money coupon_reduce_amount:money original_total_amount:money"
    " feight_fee:money split_feight_fee:money split_activity_amount:money"
    " split_coupon_amount:money split_total_amount:money expire_time:string create_time:string"
    " operate_time:string create_date:string create_hour:string province_name:string"
    " province_area_code:string province_iso_code:string province_3166_2_code:string"
    " user_age:int user_gender:string spu_id:bigint tm_id:bigint category3_id:bigint"
    " spu_name:string tm_name:string category3_name:string"
)
PAYMENT_WIDE = T.StructType(
    _struct(
        "payment_id:bigint subject:string payment_type:string payment_create_time:string"
        " callback_time:string"
    ).fields
    + [
        T.StructField("order_create_time", f.dataType) if f.name == "create_time" else f
        for f in ORDER_WIDE.fields
        if f.name not in ("expire_time", "operate_time", "create_date", "create_hour")
    ]
)

# -- dimensions (every column a string) --------------------------------------
DIM_COLUMNS = {
    "DIM_USER_INFO": ["ID", "GENDER", "BIRTHDAY"],
    "DIM_BASE_PROVINCE": ["ID", "NAME", "AREA_CODE", "ISO_CODE", "ISO_3166_2"],
    "DIM_SKU_INFO": ["ID", "SKU_NAME", "PRICE", "SPU_ID", "TM_ID", "CATEGORY3_ID"],
    "DIM_SPU_INFO": ["ID", "SPU_NAME"],
    "DIM_BASE_TRADEMARK": ["ID", "TM_NAME"],
    "DIM_BASE_CATEGORY3": ["ID", "NAME"],
}


def strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# -- result tables: sinks bind by position, so the order is part of the API ---
RESULT_COLUMNS = {
    "visitor_stats": (
        "stt edt vc ch ar is_new uv_ct pv_ct sv_ct uj_ct dur_sum ts".split()
    ),
    "product_stats": (
        "stt edt sku_id sku_name sku_price spu_id spu_name tm_id tm_name category3_id"
        " category3_name display_ct click_ct favor_ct cart_ct order_sku_num order_amount"
        " order_ct payment_amount paid_order_ct refund_order_ct refund_amount comment_ct"
        " good_comment_ct ts".split()
    ),
    "province_stats": (
        "stt edt province_id province_name province_area_code province_iso_code"
        " province_3166_2_code order_amount order_count ts".split()
    ),
    "keyword_stats": "keyword ct source stt edt ts".split(),
}
