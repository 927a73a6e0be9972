"""Queries keep their whole job, and their large steps stay small."""

import datetime as dt
import os
import time

from tallybrook.operators import stats, wide
from tallybrook.plans import derive, queries
from tallybrook.plans.queries import QUERIES
from tallybrook.sources.files import table, table_stream
from tallybrook.sources.topics import FolderTopics
from tallybrook.streaming import run


def events(spark, folder, rows):
    """An events table of (event_id, minute, user_id, event_type, k)."""
    made = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), u, kind, 1.5, f'{{"k": {k}}}') for i, m, u, kind, k in rows]
    spark.createDataFrame(
        made, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
    ).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_passed_records_show_their_number(spark, tmp_path):
    folder = events(spark, tmp_path, [(1, 0, 7, "view", 3), (2, 1, 7, "view", 4), (10, 2, 7, "view", 5), (11, 3, 8, "signup", 5), (12, 4, 8, "click", 5)])
    got = QUERIES["log_pass_through"](spark, folder).orderBy("seq").collect()
    assert [(r.seq, r.code, r.written_seq, r.is_new) for r in got] == [(1, 1, 1, "1"), (2, 2, 2, "0"), (12, 12, 12, "0")]


def shop(spark, folder):
    """Orders with lines, buyers (one of them twice), parts, and a line without any order."""
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    tables = {
        "customer": ([(1, "c1", 0, "A"), (2, "c2", 1, "B"), (2, "c2", 1, "B")], "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string"),
        "orders": ([(k, 1 + k % 3, "O", 10.0 * k, day(k), "1-URGENT") for k in range(1, 9)],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(k, n, 1 + (k + n) % 4, n, 2.5 * n, 0.1, 0.2, "R" if k % 2 else "N", day(k + n)) for k in range(1, 10) for n in (1, 2, 2)],
                     "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity int, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp"),
        "part": ([(k, f"p{k}", f"Brand#{k % 2}", "PROMO", k, 1.5 * k) for k in range(1, 4)],
                 "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "supplier": ([(k, f"s{k}") for k in (1, 4)], "s_suppkey bigint, s_name string"),
        "nation": ([(0, "N0", 0), (1, "N1", 9)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R0")], "r_regionkey int, r_name string"),
    }
    for name, (rows, shape) in tables.items():
        spark.createDataFrame(rows, shape).write.parquet(f"{folder}/{name}.parquet")
    return events(spark, folder, [(i, 60 * i, i % 3, ("view", "click", "signup", "error")[i % 4], i % 5) for i in range(20)])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_are_joined_with_payments_where_they_lie(spark, tmp_path):
    folder, limit = shop(spark, tmp_path), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        late = wide.join_payments(
            derive.payment_info(table(spark, folder, "orders")), queries.enriched(spark, folder, queries.EVER), -queries.MONTH, 5_000)
        first = queries.payments_wide(spark, folder)
        # the facts are not shuffled by order once more
        by_order = [plan(df).count("Exchange hashpartitioning(order_id") for df in (late, first)]
        assert by_order[1] == by_order[0] - 1, by_order
        want = sorted(map(str, late.collect()))
        assert sorted(map(str, first.collect())) == want and len(want) > 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_products_are_summed_by_order_without_a_shuffle(spark, tmp_path):
    folder, limit = shop(spark, tmp_path), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    frames, dims = queries.product_rows(spark, folder), derive.product_dims(spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for frame in frames[3:5]:  # orders, payments: placed by order
            alone, given = plan(stats._per_id(frame, "1 day")), plan(frame)
            assert alone.count("Exchange") == given.count("Exchange")
        split = stats.product_stats(frames, dims, "1 day")
        whole = stats.enrich_product_stats(stats.product_measures(stats.union_all(frames), "1 day"), wide.snowflake(dims))
        want = sorted(map(str, whole.collect()))
        assert sorted(map(str, split.collect())) == want and len(want) > 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_each_report_stores_its_own_table(spark, tmp_path):
    folder = shop(spark, tmp_path)
    paths = [queries.daily_products(spark, folder, 20240102).inputFiles()[0] for _ in range(2)]
    assert paths[0] != paths[1]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


def test_a_report_leaves_its_table_and_no_shuffle_files(spark, tmp_path):
    folder = shop(spark, tmp_path)
    whole = stats.product_stats(queries.product_rows(spark, folder), derive.product_dims(spark, folder), "1 day")
    want = sorted(map(str, whole.collect()))
    root = spark.conf.get("spark.checkpoint.dir")
    before, kept = shuffle_files(spark), set(os.listdir(root))
    day = queries.daily_products(spark, folder, 20240102)
    until = time.time() + 20  # they go in the background
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    (made,) = set(os.listdir(root)) - kept
    stored = spark.read.parquet(f"{root}/{made}").drop("dt", "batch_id")
    assert sorted(map(str, stored.collect())) == want and 0 < day.count() < len(want)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_joined_streams_keep_one_store(spark, tmp_path):
    folder = shop(spark, tmp_path)
    assert spark.conf.get("spark.sql.streaming.join.stateFormatVersion") == "3"
    before = spark.conf.get(run.NO_DATA)
    o = derive.order_info(table_stream(spark, folder, "orders"), table(spark, folder, "customer"))
    joined = wide.join_details(o, derive.order_detail(table_stream(spark, folder, "lineitem")), -queries.MONTH, queries.MONTH).drop("_ot")
    q = run.start(joined, str(tmp_path / "cp"), trigger=run.ONCE, path=str(tmp_path / "out"), idle=False)
    q.awaitTermination()
    assert [p["numInputRows"] > 0 for p in q.recentProgress] == [True] and spark.conf.get(run.NO_DATA) == before
    stores = {p.name for p in (tmp_path / "cp" / "state" / "0" / "0").iterdir() if p.is_dir() and not p.name.startswith("_")}
    assert not any("left" in s or "right" in s for s in stores)
    # 24 lines of orders 1 to 8, those of customer 2 twice
    assert spark.read.parquet(str(tmp_path / "out")).count() == 24 + 3 * 3


def test_streamed_orders_keep_little_state(spark, tmp_path, capsys):
    folder = shop(spark, tmp_path)
    o = derive.order_info(table_stream(spark, folder, "orders"), table(spark, folder, "customer"))
    joined = wide.join_details(o, derive.order_detail(table_stream(spark, folder, "lineitem")), -queries.MONTH, queries.MONTH).drop("_ot")
    q = run.start(joined, str(tmp_path / "cp"), trigger=run.ONCE, path=str(tmp_path / "out"), idle=False)
    q.awaitTermination()
    assert '"spark.sql.streaming.stateStore.compression.codec":"zstd"' in (tmp_path / "cp" / "offsets" / "0").read_text()
    capsys.readouterr()
    q.explain()
    after, before = capsys.readouterr().out.split("StreamingSymmetricHashJoin", 1)
    # the parts of a time are not kept with it
    assert "split(" in after and "split(" not in before
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.create_time, r.create_date, r.create_hour) for r in rows} == {
        (f"2024-01-{1 + k:02d} 00:00:00", f"2024-01-{1 + k:02d}", "00") for k in range(1, 9)}


def test_topics_are_packed_and_plain_files_still_read(spark, tmp_path):
    topics = FolderTopics(spark, str(tmp_path / "topics"), str(tmp_path / "cp"))
    lines = [(f"r{i}", f'{{"n": {i}, "text": "the same text in all"}}') for i in range(2000)]
    topics.append(spark.createDataFrame(lines, "rid string, value string").coalesce(1), "t", "job", 0)
    (part,) = (tmp_path / "topics" / "t" / f"job-{0:012d}").glob("part-*")
    assert part.stat().st_size < sum(len(v) for _, v in lines) / 2
    (tmp_path / "topics" / "t" / "plain.txt").write_text("\x02own\x03plain\n")
    assert sorted((r.rid, r.value) for r in topics.lines("t").collect()) == sorted([*lines, ("own", "plain")])
    seen = queries.drain(spark, topics.read("t").select("rid", "value"), "packed-topic")
    assert sorted((r.rid, r.value) for r in seen.collect()) == sorted([*lines, ("own", "plain")])


def test_ended_queries_let_go_of_their_shuffles(spark, tmp_path):
    before = shuffle_files(spark)
    spark.range(1000).repartition(4, "id").write.parquet(str(tmp_path / "rows"))
    stream = spark.readStream.schema("id bigint").parquet(f"{tmp_path}/rows").dropDuplicates(["id"])
    out = queries.drain(spark, stream, "ended")
    until = time.time() + 20  # they go in the background
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert out.count() == 1000
