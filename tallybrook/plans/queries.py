"""One query per operator or pipeline, over the driver's tables.

The operators' own windows and bounds are seconds; these tables span months,
so the queries pass wider ones.  Amounts come out as DOUBLE with two decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallybrook.functions.codes import decode
from tallybrook.functions.columns import camel_columns
from tallybrook.functions.jsonlines import dirty_lines, good_lines, parse_log
from tallybrook.functions.times import (
    age_years, create_parts, day_number, millis_time, parse_stamp, parse_stamp_or, second_time, stamp,
)
from tallybrook.functions.words import register_split_words, tokens
from tallybrook.operators import (
    changelog, envelope, joins, keywords, logs, reports, routing, stats, visits, wide,
)
from tallybrook.plans import derive
from tallybrook.plans.derive import AS_OF_MS, DAY_MS
from tallybrook.schemas import RULE
from tallybrook.session import prepare, release, scratch
from tallybrook.sinks import dims as dim_store, tables as result_tables
from tallybrook.sinks.history import History
from tallybrook.sources.changes import change_view, snapshot_then_changes
from tallybrook.sources.files import result_table, table, table_stream
from tallybrook.sources.topics import first_deliveries
from tallybrook.streaming.run import ONCE, start, start_batches

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MONTH = 30 * DAY_MS
EVER = 3000 * DAY_MS
JUMP_MS = 6 * 3600 * 1000


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(prepare(spark), folder)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def doubles(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE for comparison across engines."""
    return df.select(
        *[
            F.round(F.col(f.name), 2).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return derive.page_log(table(spark, folder, "events"))


def page_stream(spark: SparkSession, folder: str) -> DataFrame:
    return derive.page_log(table_stream(spark, folder, "events"))


def flat(df: DataFrame, *more: str) -> DataFrame:
    return df.select(F.col("common.mid").alias("mid"), "seq", "ts", *more)


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return derive.order_info(table(spark, folder, "orders"), table(spark, folder, "customer"))


def details(spark: SparkSession, folder: str) -> DataFrame:
    return derive.order_detail(table(spark, folder, "lineitem"))


def wide_rows(spark: SparkSession, folder: str, span: int) -> DataFrame:
    return wide.join_details(orders(spark, folder), details(spark, folder), -span, span)


def enriched(spark: SparkSession, folder: str, span: int, missing: str = "keep") -> DataFrame:
    return wide.enrich_order_wide(
        wide_rows(spark, folder, span), derive.dims(spark, folder), derive.as_of(), missing
    )


def payments_wide(spark: SparkSession, folder: str) -> DataFrame:
    paid = derive.payment_info(table(spark, folder, "orders"))
    facts = wide.join_enriched(
        orders(spark, folder), details(spark, folder), derive.dims(spark, folder), -EVER, EVER, derive.as_of()
    )
    return wide.join_payments(paid, facts, -MONTH, 5_000)


# -- logs --------------------------------------------------------------------
@query
def dirty_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = derive.log_lines(table(spark, folder, "events"))
    return dirty_lines(parse_log(lines))


@query
def parsed_log(spark: SparkSession, folder: str) -> DataFrame:
    lines = derive.log_lines(table(spark, folder, "events"))
    good = good_lines(parse_log(lines, keep=("seq",)))
    return good.select(
        "seq", "common.mid", "common.is_new", "page.page_id", "page.last_page_id", "page.item",
        "page.during_time", F.size("displays").cast("bigint").alias("n_displays"), "start", "ts",
    )


@query
def log_pass_through(spark: SparkSession, folder: str) -> DataFrame:
    """Page records with fields that no schema declares, as written on."""
    lines = derive.log_lines(table(spark, folder, "events"))
    more = F.concat(
        F.regexp_replace("value", r"\}$", ""), F.lit(',"seq":'), F.col("seq").cast("string"),
        F.lit(',"err":{"code":'), F.col("seq").cast("string"), F.lit(',"tags":["a","b"]}}'),
    )
    good = good_lines(parse_log(lines.withColumn("value", more), keep=("seq",)))
    pages_ = logs.page_logs(good).withColumn("was", F.col("common.is_new"))
    fixed = logs.correct_new_visitors(pages_)
    record = logs.full_record("raw", F.col("was"), F.col("common.is_new"))
    value = F.col("value")
    return fixed.select("seq", record.alias("value")).select(
        "seq",
        F.get_json_object(value, "$.common.mid").alias("mid"),
        F.get_json_object(value, "$.common.is_new").alias("is_new"),
        F.get_json_object(value, "$.err.code").cast("bigint").alias("code"),
        F.get_json_object(value, "$.err.tags[1]").alias("tag"),
        F.get_json_object(value, "$.page.page_id").alias("page_id"),
        F.get_json_object(value, "$.seq").cast("bigint").alias("written_seq"),
    )


@query
def odd_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that hold two records, junk behind one, or a time that is no number
    are dirty, whole."""
    lines = derive.log_lines(table(spark, folder, "events"))
    n, v = F.col("seq") % 5, F.col("value")
    odd = (
        F.when(n == 1, F.concat(v, v)).when(n == 2, F.concat(v, F.lit(" junk }")))
        .when(n == 3, F.regexp_replace(v, r'"ts":[0-9]+', '"ts":"oops"')).when(n == 4, F.concat(v, F.lit(","), v)).otherwise(v)
    )
    marked = parse_log(lines.withColumn("value", odd), keep=("seq",))
    return marked.select("seq", "dirty")


@query
def new_visitor_fix(spark: SparkSession, folder: str) -> DataFrame:
    return flat(logs.correct_new_visitors(pages(spark, folder)), "common.is_new")


def raw_log(spark: SparkSession, folder: str) -> DataFrame:
    return derive.page_log(table(spark, folder, "events"), with_start=True)


@query
def log_split_start(spark: SparkSession, folder: str) -> DataFrame:
    return flat(logs.start_logs(raw_log(spark, folder)), "start")


@query
def log_split_page(spark: SparkSession, folder: str) -> DataFrame:
    return flat(logs.page_logs(raw_log(spark, folder)), "page.page_id")


@query
def log_split_display(spark: SparkSession, folder: str) -> DataFrame:
    return logs.display_logs(logs.page_logs(raw_log(spark, folder)), carry=("seq",))


@query
def unique_visit(spark: SparkSession, folder: str) -> DataFrame:
    return flat(visits.unique_visits(pages(spark, folder)))


@query
def user_jump(spark: SparkSession, folder: str) -> DataFrame:
    return flat(visits.user_jumps(pages(spark, folder), JUMP_MS), "reason")


@query
def visitor_stats(spark: SparkSession, folder: str) -> DataFrame:
    p = pages(spark, folder)
    rows = stats.union_all(
        [
            stats.uv_rows(visits.unique_visits(p)),
            stats.jump_rows(visits.user_jumps(p, JUMP_MS)),
            stats.page_rows(p),
        ]
    )
    return stats.visitor_stats(rows, "1 day")


# -- facts -------------------------------------------------------------------
@query
def order_wide(spark: SparkSession, folder: str) -> DataFrame:
    return doubles(enriched(spark, folder, MONTH))


@query
def order_wide_drop(spark: SparkSession, folder: str) -> DataFrame:
    """Orders without a complete set of dimension rows are dropped."""
    return doubles(enriched(spark, folder, MONTH, "drop")).select(
        "detail_id", "order_id", "sku_id", "split_total_amount", "spu_name"
    )


@query
def payment_wide(spark: SparkSession, folder: str) -> DataFrame:
    return doubles(payments_wide(spark, folder))


def _interval(spark: SparkSession, folder: str, inclusive: bool) -> DataFrame:
    return joins.interval_join(
        table(spark, folder, "orders").select("o_orderkey", "o_orderdate"),
        table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"),
        [("o_orderkey", "l_orderkey")], "o_orderdate", "l_shipdate", -MONTH, MONTH,
        inclusive, inclusive,
        project=[F.col("l.o_orderkey"), F.col("r.l_linenumber"),
                 stamp("l.o_orderdate").alias("ordered"), stamp("r.l_shipdate").alias("shipped")],
    )


@query
def interval_join_closed(spark: SparkSession, folder: str) -> DataFrame:
    return _interval(spark, folder, True)


@query
def interval_join_open(spark: SparkSession, folder: str) -> DataFrame:
    return _interval(spark, folder, False)


@query
def wide_merge(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    even = F.col("o_orderkey") % 2 == 0

    def half(keep: bool) -> DataFrame:
        pick = even if keep else ~even
        return o.select(
            F.col("o_orderkey").alias("order_id"),
            F.when(pick, F.col("o_orderstatus")).alias("order_status"),
            F.when(~pick, F.col("o_custkey")).alias("user_id"),
            F.col("o_totalprice").alias("total_amount"),
        )

    return wide.merge_wide(half(True), half(False), ["order_id"])


# -- statistics --------------------------------------------------------------
@query
def province_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = wide.enrich_province(wide_rows(spark, folder, EVER), derive.province_dim(spark, folder))
    return doubles(stats.province_stats(rows, "1 day", as_of=AS_OF_MS))


@query
def province_stats_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The same in SQL text over a view with a computed time column."""
    rows = wide.enrich_province(wide_rows(spark, folder, EVER), derive.province_dim(spark, folder))
    rows.withColumn("rt", parse_stamp("create_time")).createOrReplaceTempView("order_wide")
    place = ("province_id, province_name, province_area_code, province_iso_code,"
             " province_3166_2_code")
    return doubles(spark.sql(f"""
        select date_format(window.start, 'yyyy-MM-dd HH:mm:ss') as stt,
               date_format(window.end, 'yyyy-MM-dd HH:mm:ss') as edt, {place},
               sum(split_total_amount) as order_amount,
               count(distinct order_id) as order_count, bigint({AS_OF_MS}) as ts
        from order_wide group by {place}, window(rt, '1 day')"""))


def product_rows(spark: SparkSession, folder: str) -> list[DataFrame]:
    events, lineitem = table(spark, folder, "events"), table(spark, folder, "lineitem")
    bought = wide_rows(spark, folder, EVER)
    paid = wide.join_payments(
        derive.payment_info(table(spark, folder, "orders")), bought, -MONTH, 5_000
    )
    return [
        stats.click_and_display_rows(derive.page_log(events)),
        stats.favor_rows(derive.stamped(events, "signup")),
        stats.cart_rows(derive.stamped(events, "click")),
        stats.order_rows(bought),
        stats.payment_rows(paid),
        stats.refund_rows(derive.refund_info(lineitem)),
        stats.comment_rows(derive.stamped(events, "error")),
    ]


@query
def product_stats(spark: SparkSession, folder: str) -> DataFrame:
    return doubles(
        stats.product_stats(
            product_rows(spark, folder), derive.product_dims(spark, folder), "30 days"
        )
    )


def daily_products(spark: SparkSession, folder: str, day: int) -> DataFrame:
    """The stored product table of all rows, one window per day, written by each report
    that asks for it.  The report reads its day."""
    found = stats.product_stats(
        product_rows(spark, folder), derive.product_dims(spark, folder), "1 day"
    )
    path = scratch(spark, "product_stats")
    result_tables.write_large_result(found, path, "product_stats", 0, scratch(spark, "product_stats-blocks"))
    return result_table(spark, path, day)


@query
def gmv(spark: SparkSession, folder: str) -> DataFrame:
    return doubles(reports.gmv(daily_products(spark, folder, 19970115), 19970115))


@query
def gmv_by_tm(spark: SparkSession, folder: str) -> DataFrame:
    return doubles(reports.gmv_by_trademark(daily_products(spark, folder, 19970115), 19970115, 5))


@query
def gmv_list_price(spark: SparkSession, folder: str) -> DataFrame:
    daily = daily_products(spark, folder, 19970115)
    return doubles(reports.gmv_by_trademark(daily, 19970115, 5, "sku_price"))


def document_searches(docs: DataFrame) -> DataFrame:
    """Documents as searched texts, a minute apart."""
    return docs.select(
        F.create_map(
            F.lit("item"), F.col("text"), F.lit("last_page_id"), F.lit("search")
        ).alias("page"),
        (F.lit(AS_OF_MS) + F.col("doc_id") * 60_000).alias("ts"),
    )


@query
def keyword_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents per hour."""
    texts = keywords.search_words(document_searches(table(spark, folder, "documents")))
    return keywords.keyword_stats(keywords.split_words(texts), "1 hour", as_of=AS_OF_MS)


def searches(events: DataFrame, part: DataFrame) -> DataFrame:
    """Page log whose item is the product's name instead of its number."""
    log = derive.page_log(events).select("page", "ts")
    named = joins.dim_join(
        log.select(F.col("page.item").cast("bigint").alias("k"), "page", "ts"),
        part, "k", {"p_name": "p_name"}, dim_key="p_partkey",
    )
    return named.select(F.col("page").withField("item", F.col("p_name")).alias("page"), "ts")


@query
def keyword_stats_search(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the product names searched for, per day."""
    log = searches(table(spark, folder, "events"), table(spark, folder, "part"))
    words = keywords.split_words(keywords.search_words(log))
    return keywords.keyword_stats(words, "1 day", as_of=AS_OF_MS)


@query
def keyword_stats_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The same in SQL text, with the table function ``split_words``."""
    register_split_words(spark)
    log = searches(table(spark, folder, "events"), table(spark, folder, "part"))
    log.select("page", second_time("ts").alias("rt")).createOrReplaceTempView("page_view")
    return spark.sql(f"""
        select word as keyword, count(*) as ct, 'search' as source,
               date_format(min(day.start), 'yyyy-MM-dd HH:mm:ss') as stt,
               date_format(min(day.end), 'yyyy-MM-dd HH:mm:ss') as edt, bigint({AS_OF_MS}) as ts
        from (select window(rt, '1 day') as day, page from page_view),
             lateral split_words(page.item)
        where page.last_page_id = 'search'
        group by word, day""")


@query
def script_words(spark: SparkSession, folder: str) -> DataFrame:
    """Words in scripts without spaces, and accented ones, behind each document."""
    tails = F.array(*[F.lit(t) for t in ("数据仓库", "ガラスと木", "한국어 Größe ２０ 数据")])
    docs = table(spark, folder, "documents").select(
        "doc_id", tokens(F.concat_ws(" ", "text", F.get(tails, (F.col("doc_id") % 3).cast("int")))).alias("w")
    )
    dense = F.filter("w", lambda x: x.rlike(r"^[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]+$"))
    return docs.select(
        "doc_id", F.size("w").cast("bigint").alias("n_words"), F.array_join(dense, ",").alias("dense"),
        F.array_contains("w", "größe").alias("has_word"),
    )


@query
def document_words(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.size(tokens("text")).cast("bigint").alias("n_words"))


# -- change feed -------------------------------------------------------------
def changes(spark: SparkSession, folder: str) -> DataFrame:
    raw = derive.order_changes_raw(table(spark, folder, "orders"))
    return envelope.from_debezium(raw, keep=("seq",))


def _field(side: str, name: str):
    return F.try_element_at(side, F.lit(name))


@query
def cdc_envelope(spark: SparkSession, folder: str) -> DataFrame:
    return changes(spark, folder).select(
        "seq", "database", "tableName", "type",
        _field("before", "order_status").alias("old_status"),
        _field("after", "order_status").alias("new_status"),
        F.size("before").cast("bigint").alias("n_before"),
        F.size("after").cast("bigint").alias("n_after"),
    )


def rules(spark: SparkSession) -> DataFrame:
    rows = [
        ("order_info", "insert", "kafka", "dwd_order_info", "id,user_id,total_amount", None, None),
        ("order_info", "update", "hbase", "dim_order_status", "id, order_status", "id", None),
        ("customer", "update", "hbase", "dim_customer", "id", "id", None),
    ]
    return spark.createDataFrame(rows, RULE)


@query
def cdc_route(spark: SparkSession, folder: str) -> DataFrame:
    """Deletes left out, facts and dimensions routed; snapshot rows of the
    customers have no rule."""
    feed = envelope.not_deleted(changes(spark, folder))
    snap = envelope.snapshot_as_changes(table(spark, folder, "customer"), "shop", "customer")
    every = feed.unionByName(snap.withColumn("seq", F.lit(-1).cast("bigint")))
    routed = routing.route(every, rules(spark))
    return routed.filter(routing.lane().isNotNull()).select(
        routing.lane().alias("lane"), "seq", "sinkTable",
        F.array_join(F.array_sort(F.map_keys("after")), ",").alias("columns"),
    )


@query
def route_changing_rules(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of changes in three parts, each run after a restart, while its rules are
    added, widened and deleted; one rule comes a part later than its changes."""
    feed = envelope.not_deleted(changes(spark, folder)).withColumn("_rule", F.lit(False))
    top = feed.agg(F.max("seq")).first()[0]

    def at(tenth: int) -> int:
        return top * tenth // 10

    def rule(op: str, sink: str, name: str, columns: str) -> dict[str, str]:
        return {"sourceTable": "order_info", "operateType": op, "sinkType": sink, "sinkTable": name,
                "sinkColumns": columns}

    slim = rule("insert", "kafka", "dwd_order_info", "id,user_id")
    wider = rule("insert", "kafka", "dwd_order_info", "id, user_id, total_amount")
    state = rule("update", "hbase", "dim_order_status", "id,order_status")
    # part in which it comes, type, before, after, sequence number
    rule_feed = [
        (0, "read", {}, slim, at(9)), (1, "insert", {}, state, at(2)), (1, "update", slim, wider, at(5)),
        (2, "delete", state, {}, at(8)),
    ]
    shape = T.StructType.fromDDL(
        "type string, before map<string,string>, after map<string,string>, seq bigint"
    )
    sent, base = scratch(spark, "rule-feed"), scratch(spark, "rule-history")
    envelope_schema = feed.drop("_rule").schema
    kept = [History(spark, f"{base}/{n}", envelope_schema) for n in ("rules", "waiting")]
    out = History(spark, f"{base}/routed", "lane string, seq bigint, sinkTable string, columns string")

    def shown(routed: DataFrame) -> DataFrame:
        return routed.select(
            routing.lane().alias("lane"), "seq", "sinkTable",
            F.array_join(F.array_sort(F.map_keys("after")), ",").alias("columns"),
        )

    def write(batch: DataFrame, batch_id: int) -> None:
        routed, _ = routing.route_batch(batch, batch_id, *kept)
        out.append(shown(routed.filter("sinkType IS NOT NULL")), batch_id)

    for part in range(3):
        now = [r[1:] for r in rule_feed if r[0] == part]
        own = spark.createDataFrame(now, shape).select(
            F.lit("shop").alias("database"), F.lit("table_process").alias("tableName"),
            "before", "after", "type", "seq", F.lit(True).alias("_rule"),
        )
        mine = (F.col("seq") > at(3 * part)) if part else F.lit(True)
        mine = mine & (F.col("seq") <= at(3 * part + 3)) if part < 2 else mine
        feed.filter(mine).unionByName(own).write.mode("append").parquet(sent)
        stream = spark.readStream.schema(feed.schema).parquet(sent)
        start_batches(stream, write, f"{base}/checkpoint", trigger=ONCE).awaitTermination()
    left = routing.route_as_of(kept[1].read().drop("batch_id"), routing.rule_versions(kept[0].read()))
    return out.read().drop("batch_id").unionByName(shown(routing.unrouted(left)))


@query
def cdc_changelog(spark: SparkSession, folder: str) -> DataFrame:
    signed = changelog.to_changelog(changes(spark, folder), keep=("seq",))
    return signed.select(
        "seq", "is_add", _field("row", "id").alias("id"),
        _field("row", "order_status").alias("order_status"),
    )


@query
def cdc_latest(spark: SparkSession, folder: str) -> DataFrame:
    state = changelog.latest_state(changes(spark, folder), "id")
    return state.select(
        _field("row", "id").alias("id"), _field("row", "order_status").alias("order_status"),
        _field("row", "total_amount").alias("total_amount"), "seq",
    )


@query
def cdc_view_sql(spark: SparkSession, folder: str) -> DataFrame:
    """A change feed as a SQL table."""
    change_view(spark, changes(spark, folder), ["id", "order_status", "user_id"], "order_binlog")
    return spark.sql("select order_status, count(*) as n from order_binlog group by order_status")


@query
def snapshot_and_changes(spark: SparkSession, folder: str) -> DataFrame:
    """All orders as a snapshot, then the feed's updates and deletes."""
    o = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("order_status")
    )
    later = changes(spark, folder).filter("type <> 'insert'")
    every = snapshot_then_changes(o, later, "shop", "order_info", seq="seq")
    state = changelog.latest_state(every, "id")
    return state.select(
        _field("row", "id").alias("id"), _field("row", "order_status").alias("order_status")
    )


@query
def dim_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches into a customer dimension: all inserts, then updates that
    mention only some columns."""
    root = scratch(spark, "dims")
    c = table(spark, folder, "customer")
    dim_store.create_dim(spark, root, "dim_customer", "id,name,segment", "id")
    key = F.col("c_custkey")

    def change(**cols) -> DataFrame:
        pairs = [x for k, v in cols.items() for x in (F.lit(k), v.cast("string"))]
        return F.create_map(*pairs).alias("after")

    first = c.select(change(id=key, name=F.col("c_name"), segment=F.col("c_mktsegment")),
                     key.alias("seq"))
    later = c.filter(key % 3 == 0).select(change(id=key, segment=F.lit("MOVED")),
                                          key.alias("seq"))
    dim_store.upsert_dim(spark, first, root, "dim_customer", 0)
    dim_store.upsert_dim(spark, later, root, "dim_customer", 1)
    return dim_store.read_dim(spark, root, "dim_customer").select(
        F.col("ID").alias("id"), F.col("NAME").alias("name"), F.col("SEGMENT").alias("segment")
    )


# -- scalar helpers ----------------------------------------------------------
@query
def scalar_functions(spark: SparkSession, folder: str) -> DataFrame:
    """Time, code and naming helpers over all orders."""
    o = derive.payment_info(table(spark, folder, "orders"))
    day, hour, ts = create_parts("create_time")
    out = o.select(
        F.col("id").alias("order_id"),
        day.alias("create_date"), hour.alias("create_hour"), ts.alias("create_ts"),
        day_number("create_time").alias("day_key"),
        stamp(millis_time(ts)).alias("back_again"),
        decode("payment_type").alias("payment_name"),
        age_years(day, derive.as_of()).alias("age_in_years"),
    )
    return camel_columns(out)


# -- streamed twins ----------------------------------------------------------
def drain(spark: SparkSession, df: DataFrame, name: str, idle: bool = True) -> DataFrame:
    """Run a stream over all there is and read back what it wrote."""
    out = scratch(spark, name)
    start(df, scratch(spark, f"{name}-checkpoint"), trigger=ONCE, path=out, idle=idle).awaitTermination()
    release(spark)
    return spark.read.schema(df.schema).parquet(out)


@query
def new_visitor_fix_stream(spark: SparkSession, folder: str) -> DataFrame:
    fixed = logs.correct_new_visitors(page_stream(spark, folder))
    return drain(spark, flat(fixed, "common.is_new"), "new_visitor")


@query
def unique_visit_stream(spark: SparkSession, folder: str) -> DataFrame:
    return drain(spark, flat(visits.unique_visits(page_stream(spark, folder))), "unique_visit")


@query
def user_jump_stream(spark: SparkSession, folder: str) -> DataFrame:
    jumps = visits.user_jumps(page_stream(spark, folder), JUMP_MS)
    return drain(spark, flat(jumps, "reason"), "user_jump")


@query
def visitor_page_stats_stream(spark: SparkSession, folder: str) -> DataFrame:
    rows = stats.page_rows(page_stream(spark, folder))
    return drain(spark, stats.visitor_stats(rows, "1 day"), "visitor_stats")


@query
def visitor_stats_stream(spark: SparkSession, folder: str) -> DataFrame:
    """All three inputs: the streams of unique visits and of bounces, written on
    by their own jobs, and the pages."""
    log = page_stream(spark, folder)
    drained = [
        drain(spark, visits.unique_visits(log), "visits"),
        drain(spark, visits.user_jumps(log, JUMP_MS).drop("reason"), "jumps"),
    ]
    uv, jumps = (
        spark.readStream.schema(d.schema).parquet(d.inputFiles()[0].rsplit("/", 1)[0])
        for d in drained
    )
    rows = stats.union_all([stats.uv_rows(uv), stats.jump_rows(jumps), stats.page_rows(log)])
    return drain(spark, stats.visitor_stats(rows, "1 day"), "visitor_stats")


@query
def replayed_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Events whose micro-batch was written twice count once."""
    events = table(spark, folder, "events").select("event_id", "ts", "event_type")
    sent = scratch(spark, "replayed")
    for _ in range(2):
        events.write.mode("append").parquet(sent)
    twice = spark.readStream.schema(events.schema).parquet(sent)
    once = drain(spark, first_deliveries(twice, ["event_id"], "ts", "60 days"), "replayed-once")
    return once.groupBy("event_type").agg(F.count("*").alias("n"))


@query
def bad_stamps(spark: SparkSession, folder: str) -> DataFrame:
    """Event time from text; where it is malformed, the record's own time."""
    n, made = F.col("o_orderkey") % 4, stamp("o_orderdate")
    text = F.when(n == 1, F.substring(made, 1, 10)).when(n == 2, "soon").when(n == 3, F.lit(None)).otherwise(made)
    own = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), stamp(parse_stamp_or(text, own)).alias("event_time")
    )


@query
def shop_zone_times(spark: SparkSession, folder: str) -> DataFrame:
    """Days and hours of event times, a minute apart, in the shop's own zone and in a
    session of its own."""
    shop = spark.newSession()
    shop.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    log = table(prepare(shop), folder, "events").select(
        (F.lit(AS_OF_MS) + F.col("event_id") * 60_000).alias("ts")
    )
    return log.groupBy(
        stamp(F.date_trunc("hour", millis_time("ts"))).alias("hour"), day_number(millis_time("ts")).alias("day")
    ).agg(F.count("*").alias("n"))


@query
def keyword_stats_stream(spark: SparkSession, folder: str) -> DataFrame:
    log = searches(table_stream(spark, folder, "events"), table(spark, folder, "part"))
    words = keywords.split_words(keywords.search_words(log))
    return drain(spark, keywords.keyword_stats(words, "1 day", as_of=AS_OF_MS), "keyword_stats")


@query
def product_stats_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Union of four streams, two chained aggregates, product names joined and
    written per micro-batch."""
    events = table_stream(spark, folder, "events")
    lines = table_stream(spark, folder, "lineitem")
    rows = stats.union_all(
        [
            stats.click_and_display_rows(derive.page_log(events)),
            stats.cart_rows(derive.stamped(events, "click")),
            stats.refund_rows(derive.refund_info(lines)),
            stats.comment_rows(derive.stamped(events, "error")),
        ]
    )
    out = scratch(spark, "product_stats_stream")

    def write(batch: DataFrame, batch_id: int) -> None:
        flake = wide.snowflake(derive.product_dims(spark, folder))
        result_tables.write_result(
            stats.enrich_product_stats(batch, flake), out, "product_stats", batch_id
        )

    q = start_batches(stats.product_measures(rows, "30 days"), write,
                      scratch(spark, "product_stats-checkpoint"), trigger=ONCE)
    q.awaitTermination()
    return doubles(result_table(spark, out).drop("dt", "batch_id"))


@query
def order_wide_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams joined by interval; an order shows with its details."""
    o = derive.order_info(table_stream(spark, folder, "orders"), table(spark, folder, "customer"))
    d = derive.order_detail(table_stream(spark, folder, "lineitem"))
    joined = wide.join_details(o, d, -MONTH, MONTH).drop("_ot")
    return doubles(drain(spark, joined, "order_wide", idle=False)).select(
        "detail_id", "order_id", "sku_id", "sku_num", "create_time", "split_total_amount",
        "total_amount", "province_id",
    )


@query
def province_stats_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Interval join and two chained aggregates in one streaming query."""
    o = derive.order_info(table_stream(spark, folder, "orders"), table(spark, folder, "customer"))
    d = derive.order_detail(table_stream(spark, folder, "lineitem"))
    joined = wide.join_details(o, d, -MONTH, MONTH)
    named = wide.enrich_province(joined, derive.province_dim(spark, folder))
    found = stats.province_stats(named, "30 days", time=F.col("_ot"), delay=None, as_of=AS_OF_MS)
    return doubles(drain(spark, found, "province_stats"))
