import random

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import wide
from tallybrook.operators.joins import broadcast_if_small, dim_join, interval_join


def pairs(spark, left, right, lower, upper, slice_ms=0, **bounds):
    l = spark.createDataFrame(left, "id string, a int, t double").withColumn(
        "t", F.timestamp_millis((F.col("t") * 1000).cast("bigint")))
    r = spark.createDataFrame(right, "id string, b int, u double").withColumn(
        "u", F.timestamp_millis((F.col("u") * 1000).cast("bigint")))
    out = interval_join(l, r, [("id", "id")], "t", "u", lower, upper,
                        project=[F.col("l.a"), F.col("r.b")], slice_ms=slice_ms, **bounds)
    return sorted((x.a, x.b) for x in out.collect())


def test_bounds(spark):
    left = [("a", 0, 100.0)]
    right = [("a", 1, 105.0), ("a", 2, 95.0), ("a", 3, 106.0), ("a", 4, 104.0), ("b", 5, 100.0)]
    assert pairs(spark, left, right, -5000, 5000) == [(0, 1), (0, 2), (0, 4)]
    assert pairs(spark, left, right, -5000, 5000, lower_inclusive=False,
                 upper_inclusive=False) == [(0, 4)]
    assert pairs(spark, left, right, -5000, 5000, upper_inclusive=False) == [(0, 2), (0, 4)]
    with pytest.raises(ValueError):
        pairs(spark, left, right, 5, -5)


@pytest.mark.parametrize("slice_ms", [0, 1, 700, 10_000, None])
def test_hot_key_against_brute_force(spark, slice_ms):
    rnd = random.Random(1)
    key = lambda: "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(20)}"
    left = [(key(), i, rnd.randrange(-3000, 3000) / 10) for i in range(300)]
    right = [(key(), i, rnd.randrange(-3000, 3000) / 10) for i in range(300)]
    want = sorted((a, b) for k, a, t in left for m, b, u in right
                  if k == m and -2.0 <= round(u - t, 3) <= 0.5)
    assert pairs(spark, left, right, -2000, 500, slice_ms) == want


def test_dim_join_keeps_drops_and_overwrites(spark):
    fact = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "k bigint, name string")
    dim = spark.createDataFrame([("1", "new", "x"), ("9", "no", "y")],
                                "ID string, NAME string, C string")
    kept = dim_join(fact, dim, "k", {"name": "NAME", "c": "C"})
    assert kept.columns == ["k", "name", "c"]
    assert sorted(kept.collect(), key=str) == sorted(
        [(1, "new", "x"), (2, "old", None), (None, "old", None)], key=str)
    dropped = dim_join(fact, dim, "k", {"name": "NAME"}, missing="drop")
    assert [tuple(r) for r in dropped.collect()] == [(1, "new")]
    with pytest.raises(ValueError):
        dim_join(fact, dim, "k", {}, missing="maybe")


def test_broadcast_is_checked(spark):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()

    assert hinted(broadcast_if_small(spark.range(10), 10))
    assert not hinted(broadcast_if_small(spark.range(11), 10))
    assert not hinted(broadcast_if_small(spark.range(10), 10, max_bytes=50))


def order(id_, at, **more):
    row = {"id": id_, "user_id": 7, "province_id": 1, "create_time": at, "total_amount": "9.50"}
    return {**row, **more}


def frames(spark, orders, details):
    from tallybrook import schemas
    from tallybrook.functions.jsonlines import records

    def load(rows, schema):
        import json

        return records(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"),
                       schema)

    return load(orders, schemas.ORDER_INFO), load(details, schemas.ORDER_DETAIL)


def test_order_wide_bounds_and_columns(spark):
    from tallybrook import schemas

    o, d = frames(
        spark,
        [order(1, "2024-01-01 00:00:10", expire_time="2024-01-02 00:00:00"), order(2, "2024-01-01 00:00:00")],
        [{"id": i, "order_id": 1, "sku_id": 5, "create_time": f"2024-01-01 00:00:{s:02d}"}
         for i, s in enumerate([5, 10, 15, 16, 4])],
    )
    got = wide.join_details(o, d)
    assert got.columns == schemas.ORDER_WIDE.names
    rows = got.collect()
    assert sorted(r.detail_id for r in rows) == [0, 1, 2]
    assert rows[0].create_date == "2024-01-01" and rows[0].create_hour == "00"
    assert rows[0].expire_time == "2024-01-02 00:00:00" and rows[0].split_feight_fee is None


def test_payment_bounds_and_fields(spark):
    from tallybrook import schemas

    o, d = frames(spark, [order(1, "2024-01-01 00:15:00")],
                  [{"id": 1, "order_id": 1, "sku_id": 5, "create_time": "2024-01-01 00:15:00"}])
    w = wide.join_details(o, d)
    pays = [(1, "2024-01-01 00:30:00", None), (2, "2024-01-01 00:30:01", 8),
            (3, "2024-01-01 00:14:55", 8), (4, "2024-01-01 00:14:54", 8), (5, "bad", 8)]
    p = spark.createDataFrame(
        [(i, 1, u, t) for i, t, u in pays], "id bigint, order_id bigint, user_id bigint, create_time string"
    ).select("*", F.lit("1.00").cast("decimal(16,2)").alias("total_amount"),
             F.lit("s").alias("subject"), F.lit("1101").alias("payment_type"),
             F.lit(None).cast("string").alias("callback_time"),
             F.to_timestamp(F.lit("2024-01-01 00:20:00")).alias("record_time"))
    got = wide.join_payments(p, w)
    assert got.columns == schemas.PAYMENT_WIDE.names
    rows = {r.payment_id: r for r in got.collect()}
    assert set(rows) == {1, 3, 5}
    assert rows[1].user_id == 7 and rows[3].user_id == 8  # a NULL does not wipe the order's
    assert str(rows[1].total_amount) == "1.00"
    assert rows[1].order_create_time == "2024-01-01 00:15:00"
    assert rows[1].payment_create_time == "2024-01-01 00:30:00"


def test_snowflake_joins_product_once(spark):
    s = "string"
    dims = {
        "DIM_SKU_INFO": spark.createDataFrame(
            [("5", "ring", "2.50", "50", "500", "3"), ("6", "bolt", "1.00", "51", None, "9")],
            f"ID {s}, SKU_NAME {s}, PRICE {s}, SPU_ID {s}, TM_ID {s}, CATEGORY3_ID {s}"),
        "DIM_SPU_INFO": spark.createDataFrame([("50", "rings")], f"ID {s}, SPU_NAME {s}"),
        "DIM_BASE_TRADEMARK": spark.createDataFrame([("500", "Acme")], f"ID {s}, TM_NAME {s}"),
        "DIM_BASE_CATEGORY3": spark.createDataFrame([("3", "jewels")], f"ID {s}, NAME {s}"),
    }
    keep = {r.ID: r for r in wide.snowflake(dims).collect()}
    assert keep["5"].TM_NAME == "Acme" and keep["5"].CATEGORY3_NAME == "jewels"
    assert keep["6"].SPU_NAME is None and keep["6"].SPU_ID == "51"
    assert [r.ID for r in wide.snowflake(dims, "drop").collect()] == ["5"]


def test_merge_wide(spark):
    a = spark.createDataFrame([(1, None, "x")], "k int, p string, q string")
    b = spark.createDataFrame([(1, "y", "z")], "k int, p string, q string")
    assert [tuple(r) for r in wide.merge_wide(a, b, ["k"]).collect()] == [(1, "y", "x")]
