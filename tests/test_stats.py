import random
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import T0, drain, feed, log_frame, page
from tallybrook import schemas
from tallybrook.operators import keywords, reports, stats, visits
from tallybrook.operators.stats import union_all


def test_visitor_stats_windows(spark):
    rows = [page("m1", 0, None, 1, during=5), page("m1", 9999, "home", 2, during=7),
            page("m2", 10_000, "", 3)]
    p = log_frame(spark, rows)
    every = union_all([stats.uv_rows(visits.unique_visits(p)),
                       stats.jump_rows(visits.user_jumps(p)), stats.page_rows(p)])
    df = stats.visitor_stats(every)
    assert df.columns == schemas.RESULT_COLUMNS["visitor_stats"]
    got = [tuple(r) for r in df.orderBy("stt").collect()]
    base = ("v1", "c1", "a1", "0")
    assert got == [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:10", *base, 1, 2, 1, 0, 12, T0),
        ("2024-01-01 00:00:10", "2024-01-01 00:00:20", *base, 1, 1, 1, 1, 0, T0 + 10_000),
    ]


def test_clicks_and_displays(spark):
    p = log_frame(spark, [
        page("m", 0, seq=1, page_id="good_detail", item="5", item_type="sku_id"),
        page("m", 1, seq=2, page_id="good_detail", item="5", item_type="promotion"),
        page("m", 2, seq=3, page_id="home"),
    ])
    shown = F.array(*[F.struct(F.lit(i).alias("item"), F.lit(t).alias("item_type"))
                      for i, t in [("5", "sku_id"), ("6", "sku_id"), ("7", "coupon")]])
    p = p.withColumn("displays", F.when(F.col("seq") == 3, shown))
    got = {r.sku_id: (r.click_ct, r.display_ct)
           for r in stats.product_measures(stats.click_and_display_rows(p)).collect()}
    assert got == {5: (1, 1), 6: (0, 1)}


def product_inputs(spark, n=600, seed=5):
    rnd = random.Random(seed)
    stamp = "timestamp_millis(t)"
    rows = [(7 if rnd.random() < 0.5 else rnd.randrange(5), rnd.randrange(40),
             rnd.randrange(10_000) / 100, T0 + 1000 * rnd.randrange(40), rnd.choice(["1201", "1203"]))
            for _ in range(n)]
    df = spark.createDataFrame(rows, "sku_id bigint, order_id bigint, x double, t bigint, appraise string")
    df = df.withColumn("create_time", F.expr(f"date_format({stamp}, 'yyyy-MM-dd HH:mm:ss')"))
    money = F.col("x").cast("decimal(16,2)")
    df = df.withColumn("split_total_amount", money).withColumn("refund_amount", money)
    df = df.withColumn("sku_num", F.lit(2)).withColumn("payment_create_time", F.col("create_time"))
    return rows, df


def product_union(df):
    return union_all([stats.order_rows(df), stats.payment_rows(df), stats.refund_rows(df),
                      stats.favor_rows(df), stats.cart_rows(df), stats.comment_rows(df)])


def products_by_hand(rows):
    out = {}
    for sku, oid, x, t, appraise in rows:
        g = out.setdefault((sku, (t - T0) // 10_000), {"n": 0, "ids": set(), "sum": Decimal(0),
                                                      "good": 0, "ts": t})
        g["n"] += 1
        g["ids"].add(oid)
        g["sum"] += Decimal(str(x)).quantize(Decimal("0.01"))
        g["good"] += appraise == "1201"
        g["ts"] = min(g["ts"], t)
    return sorted(
        (sku, w, g["n"], 2 * g["n"], len(g["ids"]), len(g["ids"]), len(g["ids"]), g["sum"],
         g["sum"], g["sum"], g["good"], g["ts"]) for (sku, w), g in out.items())


def products_of(df):
    got = df.withColumn("w", ((F.unix_timestamp("stt") * 1000 - T0) / 10_000).cast("int"))
    return sorted(
        tuple(r) for r in got.select(
            "sku_id", "w", "cart_ct", "order_sku_num", "order_ct", "paid_order_ct",
            "refund_order_ct", "order_amount", "payment_amount", "refund_amount",
            "good_comment_ct", "ts").collect())


def test_product_stats_hot_product(spark):
    rows, df = product_inputs(spark)
    got = stats.product_measures(product_union(df))
    assert products_of(got) == products_by_hand(rows)


def test_product_stats_stream_equals_batch(spark, tmp_path):
    rows, df = product_inputs(spark)
    last = [(99, 1, 1.0, T0 + 3_600_000, "1201")]
    _, end = product_inputs(spark, 0)[0], spark.createDataFrame(
        last, "sku_id bigint, order_id bigint, x double, t bigint, appraise string")
    end = end.withColumn("create_time", F.expr("date_format(timestamp_millis(t), 'yyyy-MM-dd HH:mm:ss')"))
    end = end.select("*", F.col("x").cast("decimal(16,2)").alias("split_total_amount"),
                     F.col("x").cast("decimal(16,2)").alias("refund_amount"), F.lit(2).alias("sku_num"),
                     F.col("create_time").alias("payment_create_time"))
    half = T0 + 20_000
    src = feed(spark, df.unionByName(end), str(tmp_path / "in"),
               [f"t < {half}", f"t >= {half} and sku_id < 99", "sku_id = 99"])
    out, _ = drain(spark, stats.product_measures(product_union(src)), tmp_path)
    assert products_of(out) == products_by_hand(rows)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    from tallybrook.streaming.run import late_rows

    # a micro-batch judges lateness by the watermark of the batch before it
    rows = [page("m", 0, seq=1), page("m", 60_000, seq=2), page("m", 61_000, seq=3),
            page("m", 500, seq=4), page("m", 600_000, seq=5)]
    src = feed(spark, log_frame(spark, rows), str(tmp_path / "in"), [f"seq = {i}" for i in range(1, 6)])
    out, q = drain(spark, stats.visitor_stats(stats.page_rows(src)), tmp_path)
    assert sorted((r.stt[-8:], r.pv_ct) for r in out.collect()) == [("00:00:00", 1), ("00:01:00", 2)]
    assert late_rows(q) == 1


def test_restart_from_checkpoint(spark, tmp_path):
    rows = [page("m", 1000 * i, seq=i) for i in range(30)] + [page("e", 3_600_000, seq=99)]
    frame = log_frame(spark, rows)
    src = feed(spark, frame, str(tmp_path / "in"), ["seq < 15"])
    drain(spark, stats.visitor_stats(stats.page_rows(src)), tmp_path)
    src = feed(spark, frame, str(tmp_path / "in"), ["seq between 15 and 29", "seq = 99"])
    out, _ = drain(spark, stats.visitor_stats(stats.page_rows(src)), tmp_path)
    assert sorted((r.stt[-2:], r.pv_ct) for r in out.collect()) == [("00", 10), ("10", 10), ("20", 10)]


def test_province_stats_keeps_cents_and_counts_orders_once(spark):
    rows = [(1, "P", "010", "CN-1", "R", o, a, t) for o, a, t in [
        (1, "12.56", "2024-01-01 00:00:00"), (1, "0.44", "2024-01-01 00:00:09"),
        (2, "1.00", "2024-01-01 00:00:01"), (3, "2.00", "2024-01-01 00:00:10")]]
    df = spark.createDataFrame(
        rows, "province_id bigint, province_name string, province_area_code string,"
        " province_iso_code string, province_3166_2_code string, order_id bigint, a string,"
        " create_time string").withColumn("split_total_amount", F.col("a").cast("decimal(16,2)"))
    got = stats.province_stats(df, as_of=5)
    assert got.columns == schemas.RESULT_COLUMNS["province_stats"]
    assert sorted((r.stt[-2:], str(r.order_amount), r.order_count, r.ts) for r in got.collect()) == [
        ("00", "14.00", 2, 5), ("10", "2.00", 1, 5)]


def searches(spark):
    rows = [("search", "red ring RED", 0), ("search", None, 0), ("home", "blue", 0),
            ("search", "  ", 0), ("search", "red", 10_000)]
    return spark.createDataFrame([(a, b, T0 + t) for a, b, t in rows],
                                 "last_page_id string, item string, ts bigint").select(
        F.create_map(F.lit("last_page_id"), F.col("last_page_id"), F.lit("item"), F.col("item")).alias("page"),
        "ts")


WORDS = [("red", "00", 2), ("red", "10", 1), ("ring", "00", 1)]


def test_keyword_stats(spark):
    words = keywords.split_words(keywords.search_words(searches(spark)))
    got = keywords.keyword_stats(words, as_of=5)
    assert got.columns == schemas.RESULT_COLUMNS["keyword_stats"]
    assert sorted((r.keyword, r.stt[-2:], r.ct) for r in got.collect()) == WORDS
    assert {(r.source, r.ts) for r in got.collect()} == {("search", 5)}


def test_keyword_stats_as_sql_over_a_stream(spark, tmp_path):
    """The declared table, the table function and the window in SQL text."""
    from tallybrook.functions.jsonlines import as_value
    from tallybrook.functions.times import second_time
    from tallybrook.functions.words import register_split_words
    from tallybrook.sources.topics import json_view

    register_split_words(spark)
    end = searches(spark).limit(1).withColumn("ts", F.lit(T0 + 3_600_000))
    lines = as_value(searches(spark).unionByName(end))
    src = feed(spark, lines, str(tmp_path / "in"), ["true"])
    json_view(spark, src, "page_view", "common map<string,string>, page map<string,string>, ts bigint",
              {"rt": second_time("ts")}, ("rt", "1 second"))
    table = spark.sql("""
        select word keyword, count(*) ct, 'search' source,
               date_format(window.start, 'yyyy-MM-dd HH:mm:ss') stt
        from (select word, rt from (select page['item'] full_word, rt from page_view
                where page['last_page_id'] = 'search' and page['item'] is not null) t,
              lateral split_words(full_word)) w
        group by word, window(rt, '10 seconds')""")
    out, _ = drain(spark, table, tmp_path)
    assert sorted((r.keyword, r.stt[-2:], r.ct) for r in out.collect()) == WORDS


def report_table(spark):
    rows = [("2024-01-01 00:00:00", "a", 10, 3), ("2024-01-01 10:00:00", "b", 10, 5),
            ("2024-01-01 10:00:10", "a", 5, 3), ("2024-01-01 10:00:20", None, 1, 1),
            ("2024-01-01 10:00:30", "c", 15, 9), ("2024-01-02 00:00:00", "a", 99, 1)]
    return spark.createDataFrame(rows, "stt string, tm_name string, order_amount int, sku_price int")


def test_reports(spark):
    t = report_table(spark)
    assert reports.gmv(t, 20240101).first().gmv == 41
    assert reports.gmv(t, 20240101, "sku_price").first().gmv == 21
    top = reports.gmv_by_trademark(t, 20240101, 3)
    assert [tuple(r) for r in top.collect()] == [("a", 15), ("c", 15), ("b", 10)]
    assert reports.gmv_by_trademark(t, 20240101, 50).count() == 4
    as_map = reports.as_map(top)
    assert as_map.first().amounts == {"a": 15, "c": 15, "b": 10}
    assert as_map.select(F.map_keys("amounts").alias("k")).first().k == ["a", "c", "b"]
    assert reports.gmv(t).first().gmv is None  # today
