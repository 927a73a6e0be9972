import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from tallybrook import schemas
from tallybrook.functions import codes, columns, jsonlines, times, words


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def test_stamps(spark):
    text = F.lit("2024-01-02 03:04:05")
    assert one(spark, times.stamp_millis(text)) == 1704164645000
    assert one(spark, times.stamp(times.parse_stamp(text))) == "2024-01-02 03:04:05"
    assert one(spark, times.day_number(text)) == 20240102
    assert one(spark, times.second_time(F.lit(1704164645999))) == one(
        spark, times.parse_stamp(text).cast("timestamp")
    )
    day, hour, ms = times.create_parts(text)
    assert (one(spark, day), one(spark, hour), one(spark, ms)) == (
        "2024-01-02", "03", 1704164645000)


def test_bad_stamps(spark):
    fallback = F.timestamp_millis(F.lit(0))
    for bad in ("soon", "2024-01-02", "", "2024-99-99 00:00:00"):
        assert one(spark, times.parse_stamp_or(F.lit(bad), fallback)) == one(spark, fallback)
    for bad in ("soon", "2024-01-02", "2024-99-99 00:00:00"):
        df = spark.createDataFrame([(bad,)], "t string").select(times.parse_stamp("t"))
        with pytest.raises(Exception, match="CANNOT_PARSE|CAST_INVALID|DATETIME"):
            df.collect()


def test_age_in_365_day_years(spark):
    now = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    birth = dt.date(2024, 1, 1) - dt.timedelta(days=365 * 30)
    assert one(spark, times.age_years(F.lit(str(birth)), now)) == 30
    late = birth + dt.timedelta(days=1)
    assert one(spark, times.age_years(F.lit(str(late)), now)) == 29


def test_now_millis(spark):
    assert one(spark, times.now_millis(5)) == 5
    assert one(spark, times.now_millis()) % 1000 == 0


def test_tokens(spark):
    text = F.lit("Kite数据仓库视频教程 Spark4 好 数据")
    got = sorted(one(spark, words.tokens(text)))
    run = "数据仓库视频教程"
    want = ["kite", "spark4", "好", "数据", run] + [run[i:i + 2] for i in range(len(run) - 1)]
    assert got == sorted(want)
    mixed = one(spark, words.tokens(F.lit("Größe café привет ガラス 한국어 ２０ 数据 e\u0301tude")))
    assert sorted(mixed) == sorted(
        ["größe", "café", "привет", "２０", "e\u0301tude", "ガラ", "ラス", "ガラス", "한국", "국어", "한국어", "数据"]
    )
    assert one(spark, words.tokens(F.lit(" -!"))) == []
    long = one(spark, words.tokens(F.lit("é" * 60_000 + " " + "数" * 30_000)))
    assert len(long) == 1 + 29_999 + 1


def test_split_words_table_function(spark):
    words.register_split_words(spark)
    sql = "select word from values ('red Ring'), (null), ('') t(full_word)," \
          " lateral split_words(full_word)"
    assert sorted(r.word for r in spark.sql(sql).collect()) == ["red", "ring"]

    def broken(text):
        raise ValueError

    words.register_split_words(spark, "keep_text", broken)
    got = spark.sql("select word from values ('a b') t(x), lateral keep_text(x)").collect()
    assert [r.word for r in got] == ["a b"]


def test_lenient_json(spark):
    schema = T.StructType.fromDDL("id bigint, at string, inner struct<n:bigint,s:string>,"
                                  " list array<struct<k:int>>, m map<string,string>")
    lines = ['{"id":"7","at":5,"inner":{"n":"x","s":{"a":1}},"list":[{"k":"3"}],"m":{"p":1}}',
             '{"id":1.5}', '[1]', "12", "", "{bad", None, '{"id":3} {"id":4}x']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = jsonlines.records(df, schema).collect()
    assert got[0] == (7, "5", (None, '{"a":1}'), [(3,)], {"p": "1"})
    assert len(got) == len(lines)
    assert all(r.id is None for r in got[2:])


def test_strict_json_fails(spark):
    df = spark.createDataFrame([("{bad",)], "value string")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        jsonlines.strict(df, T.StructType.fromDDL("id bigint")).collect()


def test_dirty_lines(spark):
    good = '{"common":{"mid":"m","is_new":"1"},"page":{"page_id":"x"},"ts":"12"}'
    bad = ["{bad", "", '{"ts":1}', '{"common":{}}', "[]"]
    df = spark.createDataFrame([(x,) for x in [good, *bad]], "value string")
    parsed = jsonlines.parse_log(df)
    assert sorted(r.raw for r in jsonlines.dirty_lines(parsed).collect()) == sorted(bad)
    row = jsonlines.good_lines(parsed).first()
    assert (row.common.mid, row.page.page_id, row.ts, row.raw) == ("m", "x", 12, good)
    plan = jsonlines.good_lines(parsed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_value_round_trip(spark):
    df = spark.createDataFrame([(1, None)], "a bigint, b string")
    assert jsonlines.as_value(df).first().value == '{"a":1}'


def test_codes(spark):
    assert one(spark, codes.decode(F.lit("1201"))) == "APPRAISE_GOOD"
    assert one(spark, codes.decode(F.lit("x"))) is None
    assert len(set(codes.CODES.values())) == len(codes.CODES)


def test_column_helpers(spark):
    assert columns.camel("sku_num_total") == "skuNumTotal"
    assert columns.snake("skuNumTotal") == "sku_num_total"
    df = spark.createDataFrame([(1, 2)], "sku_id int, order_ct int")
    assert columns.camel_columns(df).columns == ["skuId", "orderCt"]
    assert columns.without(df, ["order_ct"]).columns == ["sku_id"]


def test_record_shapes():
    assert len(schemas.ORDER_WIDE) == 35 and len(schemas.PAYMENT_WIDE) == 36
    sizes = {k: len(v) for k, v in schemas.RESULT_COLUMNS.items()}
    assert sizes == {"visitor_stats": 12, "product_stats": 25, "province_stats": 10,
                     "keyword_stats": 6}


def test_prepare_keeps_what_the_caller_set(spark):
    from tallybrook.session import prepare

    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    prepare(other)
    assert other.conf.get("spark.sql.session.timeZone") == "Asia/Shanghai"
    row = other.sql("select timestamp_millis(1704067200000) as t").selectExpr("cast(to_date(t) as string) d", "hour(t) h")
    assert tuple(row.head()) == ("2024-01-01", 8)
    assert prepare(other, "UTC").conf.get("spark.sql.session.timeZone") == "UTC"


def test_one_value(spark):
    lines = ['{"a":1}', ' {"a":1} ', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1} junk }', "[1,2]", "{", "", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, v string")
    got = {r.i for r in df.filter(jsonlines.one_value(F.col("v"))).collect()}
    assert got == {0, 1, 5}
