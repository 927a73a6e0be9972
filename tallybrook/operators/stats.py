"""Windowed statistics: visitors, products, provinces."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallybrook.functions.codes import CODES
from tallybrook.functions.times import millis_time, now_millis, parse_stamp, stamp, stamp_millis
from tallybrook.operators.joins import dim_join
from tallybrook.operators.logs import is_entry
from tallybrook.schemas import MONEY, MONEY_SUM, RESULT_COLUMNS

WINDOW = "10 seconds"
# a product's windows are dealt to so many tasks, each with the product's names
SALTS = 8


def tumble(rows: DataFrame, time: Column, width: str, keys: Sequence[str],
           measures: Sequence[Column], delay: str | None = None) -> DataFrame:
    """Event-time tumbling aggregate with the column ``window``.

    Partial sums are formed before the shuffle, so a hot key ships one row per
    map task and window.  ``delay`` sets the watermark of a stream.
    """
    timed = rows.withColumn("_et", time)
    if delay is not None and rows.isStreaming:
        timed = timed.withWatermark("_et", delay)
    return timed.groupBy(F.window("_et", width).alias("window"), *keys).agg(*measures)


def bounds(df: DataFrame) -> DataFrame:
    """Replace ``window`` by the formatted ``stt`` and exclusive ``edt``."""
    return df.select(
        stamp("window.start").alias("stt"),
        stamp("window.end").alias("edt"),
        *[c for c in df.columns if c != "window"],
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _sums(columns: Sequence[str]) -> list[Column]:
    return [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in columns]


# -- visitors ----------------------------------------------------------------
_VISITOR_KEYS = ["ar", "ch", "is_new", "vc"]
_VISITOR_SUMS = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]


def _visitor_rows(df: DataFrame, **measures: Column) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return df.select(
        *[F.col(f"common.{k}").alias(k) for k in ("vc", "ch", "ar", "is_new")],
        *[measures.get(m, zero).cast("bigint").alias(m) for m in _VISITOR_SUMS],
        "ts",
    )


def uv_rows(visits: DataFrame) -> DataFrame:
    return _visitor_rows(visits, uv_ct=F.lit(1))


def jump_rows(jumps: DataFrame) -> DataFrame:
    return _visitor_rows(jumps, uj_ct=F.lit(1))


def page_rows(pages: DataFrame) -> DataFrame:
    return _visitor_rows(
        pages,
        pv_ct=F.lit(1),
        sv_ct=F.when(is_entry(), 1).otherwise(0),
        dur_sum=F.coalesce(F.col("page.during_time"), F.lit(0)),
    )


def visitor_stats(rows: DataFrame, width: str = WINDOW, delay: str = "11 seconds") -> DataFrame:
    """Unique visits, page views, entries, bounces and stay per visitor group
    and window.  ``ts`` is the earliest of the window's rows."""
    agg = tumble(rows, millis_time("ts"), width, _VISITOR_KEYS,
                 _sums(_VISITOR_SUMS) + [F.min("ts").alias("ts")], delay)
    return bounds(agg).select(RESULT_COLUMNS["visitor_stats"])


# -- products ----------------------------------------------------------------
_COUNTS = ["display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct",
           "good_comment_ct"]
_AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]
_ID_KINDS = {"order_ct": "order", "paid_order_ct": "paid", "refund_order_ct": "refund"}


def _product_rows(df: DataFrame, ts: Column, sku: Column | None = None, kind: str | None = None,
                  id_: Column | None = None, **measures: Column) -> DataFrame:
    def amount(c: Column) -> Column:
        return c.cast(MONEY)

    zero = F.lit(0).cast("bigint")
    return df.select(
        (F.col("sku_id") if sku is None else sku).cast("bigint").alias("sku_id"),
        *[measures.get(m, zero).cast("bigint").alias(m) for m in _COUNTS],
        *[amount(measures.get(m, zero)).alias(m) for m in _AMOUNTS],
        F.lit(kind).cast("string").alias("id_kind"),
        (F.lit(None) if id_ is None else id_).cast("bigint").alias("id"),
        ts.cast("bigint").alias("ts"),
    )


def click_and_display_rows(pages: DataFrame) -> DataFrame:
    """Page views of a product page as clicks and shown products as displays,
    none to many rows per page, in one scan."""
    on_product = (F.col("page.page_id") == "good_detail") & (F.col("page.item_type") == "sku_id")
    click = F.when(
        on_product, F.array(F.struct(F.col("page.item").alias("item"), F.lit(1).alias("click")))
    ).otherwise(F.array().cast("array<struct<item:string,click:int>>"))
    shown = F.transform(
        F.filter("displays", lambda d: d["item_type"] == "sku_id"),
        lambda d: F.struct(d["item"].alias("item"), F.lit(0).alias("click")),
    )
    none = F.array().cast("array<struct<item:string,click:int>>")
    hits = pages.select("ts", F.inline(F.concat(click, F.coalesce(shown, none))))
    return _product_rows(hits, F.col("ts"), sku=F.col("item").try_cast("bigint"),
                         click_ct=F.col("click"), display_ct=F.lit(1) - F.col("click"))


def favor_rows(favors: DataFrame) -> DataFrame:
    return _product_rows(favors, stamp_millis("create_time"), favor_ct=F.lit(1))


def cart_rows(carts: DataFrame) -> DataFrame:
    return _product_rows(carts, stamp_millis("create_time"), cart_ct=F.lit(1))


def order_rows(wide: DataFrame) -> DataFrame:
    return _product_rows(wide, stamp_millis("create_time"), kind="order", id_=F.col("order_id"),
                         order_sku_num=F.col("sku_num"), order_amount=F.col("split_total_amount"))


def payment_rows(payments: DataFrame) -> DataFrame:
    return _product_rows(payments, stamp_millis("payment_create_time"), kind="paid",
                         id_=F.col("order_id"), payment_amount=F.col("split_total_amount"))


def refund_rows(refunds: DataFrame) -> DataFrame:
    return _product_rows(refunds, stamp_millis("create_time"), kind="refund",
                         id_=F.col("order_id"), refund_amount=F.col("refund_amount"))


def comment_rows(comments: DataFrame) -> DataFrame:
    good = F.col("appraise").eqNullSafe(CODES["APPRAISE_GOOD"])
    return _product_rows(comments, stamp_millis("create_time"), comment_ct=F.lit(1),
                         good_comment_ct=F.when(good, 1).otherwise(0))


def product_measures(rows: DataFrame | Sequence[DataFrame], width: str = WINDOW, delay: str = "2 seconds") -> DataFrame:
    """Counts, amounts and distinct orders per product and window.

    Distinct ids are exact and need no set per group: rows are first summed per
    (window, product, kind of id, id), which spreads a hot product over its
    ids, then per (window, product), where each row stands for one id.  The same
    two aggregates run on a stream, chained under one watermark.

    Static frames may come one by one, if no two of them have ids of one kind.  Each is
    then summed per id by itself: orders that a join has put in place by their id are
    summed there, without a shuffle.
    """
    return _shown(_measures(_per_id(rows, width, delay)))


def _per_id(rows: DataFrame | Sequence[DataFrame], width: str, delay: str | None = None) -> DataFrame:
    frames = [rows] if isinstance(rows, DataFrame) else rows
    return union_all([
        tumble(f, millis_time("ts"), width, ["sku_id", "id_kind", "id"],
               _sums(_COUNTS + _AMOUNTS) + [F.min("ts").alias("ts")], delay)
        for f in frames
    ])


def _measures(per_id: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    kinds = [
        F.sum(F.when(F.col("id_kind") == kind, 1).otherwise(0)).cast("bigint").alias(out)
        for out, kind in _ID_KINDS.items()
    ]
    return per_id.groupBy("window", "sku_id", *also).agg(
        *[F.sum(c).alias(c) for c in _COUNTS + _AMOUNTS], *kinds, F.min("ts").alias("ts")
    )


def _shown(agg: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    return bounds(agg).select(
        "stt", "edt", "sku_id", *_COUNTS,
        *[F.col(c).cast(MONEY_SUM).alias(c) for c in _AMOUNTS], *_ID_KINDS, "ts", *also,
    )


def enrich_product_stats(stats: DataFrame, flake: DataFrame, missing: str = "keep",
                         also: Sequence[str] = ()) -> DataFrame:
    """Product names after the aggregate, when few rows are left to join."""
    out = dim_join(
        stats, flake, "sku_id",
        {
            "sku_name": "SKU_NAME",
            "sku_price": F.col("PRICE").try_cast("decimal(16,2)"),
            "spu_id": F.col("SPU_ID").try_cast("bigint"),
            "tm_id": F.col("TM_ID").try_cast("bigint"),
            "category3_id": F.col("CATEGORY3_ID").try_cast("bigint"),
            "spu_name": "SPU_NAME", "tm_name": "TM_NAME", "category3_name": "CATEGORY3_NAME",
        },
        missing=missing, also=also,
    )
    return out.select(RESULT_COLUMNS["product_stats"])


def product_stats(rows: DataFrame | Sequence[DataFrame], dims: Mapping[str, DataFrame], width: str = WINDOW,
                  missing: str = "keep") -> DataFrame:
    """The whole product table on static frames; ``rows`` as in :func:`product_measures`.

    One shuffle by product serves both the second aggregate and the join of the names.
    So that a hot product is not one task, its windows are dealt to ``SALTS`` parts, and
    the products are copied to each.
    """
    from tallybrook.operators.wide import snowflake

    salt = F.pmod(F.xxhash64("window.start"), F.lit(SALTS))
    dealt = _per_id(rows, width).withColumn("_salt", salt).repartition("sku_id", "_salt")
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    flake = snowflake(dims, missing).withColumn("_salt", copies)
    return enrich_product_stats(_shown(_measures(dealt, ["_salt"]), ["_salt"]), flake, missing, ["_salt"])


# -- provinces ---------------------------------------------------------------
_PROVINCE_KEYS = ["province_id", "province_name", "province_area_code", "province_iso_code",
                  "province_3166_2_code"]


def province_stats(wide: DataFrame, width: str = WINDOW, delay: str | None = "1 second",
                   time: Column | None = None, as_of: int | None = None) -> DataFrame:
    """Distinct orders and amount per province and window, by the same two
    aggregates as the products: five provinces would else be five hot groups.

    On a stream that already carries a watermark pass its column as ``time``
    and ``delay=None``.
    """
    per_order = tumble(wide, parse_stamp("create_time") if time is None else time, width, [*_PROVINCE_KEYS, "order_id"],
                       [F.sum("split_total_amount").alias("order_amount")], delay)
    agg = per_order.groupBy("window", *_PROVINCE_KEYS).agg(
        F.sum("order_amount").cast(MONEY_SUM).alias("order_amount"),
        F.count("order_id").alias("order_count"),
    )
    return bounds(agg).withColumn("ts", now_millis(as_of)).select(
        RESULT_COLUMNS["province_stats"]
    )
