"""Rules of their time, records that come twice or late, text changed in place."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallybrook.functions import jsontext
from tallybrook.operators import logs, reports, routing
from tallybrook.plans import jobs, recovery
from tallybrook.schemas import CHANGE
from tallybrook.sinks.dims import read_dim
from tallybrook.sinks.history import History
from tallybrook.sources import topics
from tallybrook.streaming.late import MARKS, split_late
from tallybrook.streaming.lookup import _wait
from tallybrook.streaming.run import ONCE, start
from tallybrook.streaming.upserts import _materialise

MAPS = "type string, before map<string,string>, after map<string,string>, seq bigint"


def rule(table, op, columns, sink="kafka", name="t"):
    return {"sourceTable": table, "operateType": op, "sinkType": sink, "sinkTable": name, "sinkColumns": columns}


# -- text in place ---------------------------------------------------------------
@pytest.mark.parametrize("text,want", [
    ('{"common":{"is_new":"1"}}', '{"common":{"is_new":"0"}}'),
    ('{ "a" : [{"is_new":"1"}], "common" : {"x":{"is_new":"1"} , "is_new" : 1.0 , "y":"\\"is_new\\":\\"1\\""} }',
     '{ "a" : [{"is_new":"1"}], "common" : {"x":{"is_new":"1"} , "is_new" : "0" , "y":"\\"is_new\\":\\"1\\""} }'),
    ('{"common":{},"n":1.10}', '{"common":{"is_new":"0"},"n":1.10}'),
    ('{"common":{"a":1}}', '{"common":{"is_new":"0","a":1}}'),
    ('{"common":5}', '{"common":5}'), ('{"other":{}}', '{"other":{}}'), ("[1]", "[1]"), ("", ""), ("{}", "{}"),
])
def test_one_value_is_replaced(text, want):
    assert jsontext.replaced(text, ("common", "is_new"), '"0"') == want


def test_items_keep_their_text(spark):
    line = '{"displays": [ {"a":1.10,"s":"]}\\"x"}, {} ,5, {"page_id":"own","b":1e400}], "page":{"page_id" : "p\\u0041" }}'
    rows = spark.createDataFrame([(1, line), (2, None), (3, "{broken displays"), (4, '{"displays":null}'), (5, '{"displays":[{"a":1}]}')], "k int, raw string")
    got = [tuple(r) for r in logs.full_displays(rows, keep=("k",)).orderBy("k", "place").collect()]
    assert got == [
        (1, 0, '{"page_id":"p\\u0041","a":1.10,"s":"]}\\"x"}'), (1, 1, '{"page_id":"p\\u0041"}'),
        (1, 2, '{"page_id":"p\\u0041","b":1e400}'), (5, 0, '{"page_id":null,"a":1}'),
    ]
    same = logs.full_record("raw", F.lit("1"), F.lit("1"))
    assert [r[0] for r in rows.orderBy("k").select(same).collect()] == [r.raw for r in rows.orderBy("k").collect()]
    fixed = logs.full_record("raw", F.lit("1"), F.lit("0"))
    assert rows.filter("k = 3").select(fixed).first()[0] == "{broken displays"


# -- rules ----------------------------------------------------------------------
def test_versions_of_rules(spark):
    a, b, moved = rule("a", "insert", "id"), rule("a", "insert", "id,x"), rule("b", "insert", "id,x")
    feed = spark.createDataFrame(
        [("read", {}, a, 50), ("update", a, b, 10), ("update", b, moved, 20), ("delete", moved, {}, 30),
         ("insert", {}, a, 30), ("delete", a, {}, 30), ("insert", {}, rule("c", "update", "id"), 7)], MAPS)
    got = {(r.sourceTable, r.sinkColumns, r.since, r.until) for r in routing.rule_versions(feed).collect()}
    assert got == {
        ("a", "id", routing.FIRST, 10), ("a", "id,x", 10, 20), ("b", "id,x", 20, 30), ("a", "id", 30, routing.NEVER),
        ("c", "id", 7, routing.NEVER),
    }
    changes = spark.createDataFrame(
        [("db", t, {}, {"id": "1", "x": "2", "y": "3"}, "insert", s) for t in "ab" for s in (9, 10, 19, 20, 29, 30, None)],
        "database string, tableName string, before map<string,string>, after map<string,string>, type string, seq bigint")
    routed = routing.route_as_of(changes, routing.rule_versions(feed))
    assert routed.count() == changes.count()
    got = {(r.tableName, r.seq): sorted(r.after) for r in routed.collect()}
    every = ["id", "x", "y"]
    assert got == {
        ("a", 9): ["id"], ("a", 10): ["id", "x"], ("a", 19): ["id", "x"], ("a", 20): every, ("a", 29): every, ("a", 30): ["id"],
        ("b", 9): every, ("b", 10): every, ("b", 19): every, ("b", 20): ["id", "x"], ("b", 29): ["id", "x"], ("b", 30): every,
        ("a", None): every, ("b", None): every,
    }


def lines(spark, rows):
    return spark.createDataFrame([(f"srv.shop.{t}", json.dumps({"op": op, "before": b, "after": a}), s) for t, op, b, a, s in rows],
                                 "topic string, value string, seq bigint")


def test_base_db_follows_its_rules(spark, tmp_path):
    base = str(tmp_path)
    wh = recovery.house(spark, base)
    wh.rule_topic = "ods_rules"

    def land(rows, rules):
        for name, found in (("changes", rows), ("rules", rules)):
            lines(spark, found).coalesce(1).write.mode("append").parquet(f"{base}/{name}")
        feed = spark.readStream.schema("topic string, value string, seq bigint")
        wh.land_changes(feed.parquet(f"{base}/changes"), "shop").awaitTermination()
        ruled = jobs.database_changes(feed.parquet(f"{base}/rules"), keep=("seq",))
        wh.topics.write(jobs.identified(ruled, F.col("seq").cast("string")), "ods_rules", "land_rules", ONCE).awaitTermination()
        wh.base_db().awaitTermination()

    fact = rule("orders", "insert", "id,a", name="dwd_orders")
    land([("orders", "c", None, {"id": 1, "a": 1, "b": 1}, 1), ("users", "c", None, {"id": 7, "n": "x", "z": 0}, 2)],
         [("table_process", "c", None, fact, 0)])
    # the rule of the users comes a batch after its first change, the orders' is widened and goes
    users = rule("users", "insert", "id, n", "hbase", "dim_users")
    land([("orders", "c", None, {"id": i, "a": i, "b": i}, 10 * i) for i in (2, 4, 6)] + [("users", "c", None, {"id": 8, "n": "y"}, 70)],
         [("table_process", "c", None, users, 1), ("table_process", "u", fact, rule("orders", "insert", "id,b", name="dwd_orders"), 30),
          ("table_process", "d", rule("orders", "insert", "id,b"), None, 50)])
    facts = sorted(r.value for r in wh.topics.lines("dwd_orders").collect())
    assert [json.loads(f) for f in facts] == [{"id": "1", "a": "1"}, {"id": "2", "a": "2"}, {"id": "4", "b": "4"}]
    assert sorted(map(tuple, read_dim(spark, wh.dims, "dim_users").collect())) == [("7", "x"), ("8", "y")]
    lost = [json.loads(r.value)["after"]["id"] for r in wh.topics.lines("unrouted").collect()]
    assert sorted(lost) == ["6", "7"]  # the user's first change had no rule when it came


def test_history_is_read_as_of_a_batch(spark, tmp_path):
    h = History(spark, str(tmp_path / "h"), "a int")
    assert h.read().count() == 0 and not h.append(spark.createDataFrame([], "a int"), 0)
    for _ in range(2):
        assert h.append(spark.range(3).selectExpr("cast(id as int) a", "1 as more"), 1)
    h.append(spark.range(1).selectExpr("cast(id as int) a"), 4)
    assert [h.read(n).count() for n in (0, 1, 3, 4)] == [0, 3, 3, 4]
    assert CHANGE.names == ["database", "tableName", "before", "after", "type"]


# -- repeats ----------------------------------------------------------------------
def test_stamped_ids_are_made_alike(spark):
    rows = [("2024-01-01 00:00:00", "same")] * 25_000 + [("2024-01-02 00:00:00", "same"), ("2024-01-01 00:00:00", "other"), ("2024-01-01 00:00:00", "")]
    batch = spark.createDataFrame(rows, "t string, value string").select(F.to_timestamp("t").alias("record_time"), "value")
    one, two = (topics.stamped(b, "job", 3) for b in (batch, batch.repartition(7)))
    assert one.count() == one.select("rid").distinct().count() == len(rows)
    assert one.select("rid", "value").exceptAll(two.select("rid", "value")).count() == 0


def test_kafka_records_carry_their_id(spark):
    raw = spark.createDataFrame([(bytearray(b"id-1"), bytearray(b"v"), "t", 3, 17), (None, bytearray(b"w"), "t", 3, 18)],
                                "key binary, value binary, topic string, partition int, offset bigint").withColumn("timestamp", F.current_timestamp())
    got = [(r.rid, r.value, r.offset) for r in topics.KafkaTopics.records(raw).orderBy("offset").collect()]
    assert got == [("id-1", "v", 17), ("t-3-18", "w", 18)]
    sent = topics.KafkaTopics.rows(raw.select(F.lit("x").alias("rid"), F.lit("v").alias("value"), F.lit("t").alias("topic")))
    assert sent.columns == ["key", "value", "topic"]
    assert topics.KafkaTopics.rows(raw.select("value")).columns == ["value"]


def test_a_reader_leaves_out_what_it_had(spark, tmp_path):
    def run(folder, remember):
        t = topics.FolderTopics(spark, f"{tmp_path}/topics", str(tmp_path), remember_ms=remember)
        q = start(t.read("a").select("rid", "value"), f"{tmp_path}/{folder}-cp", trigger=ONCE, path=f"{tmp_path}/{folder}")
        q.awaitTermination()
        return sorted(r.value for r in spark.read.parquet(f"{tmp_path}/{folder}").collect())

    t = topics.FolderTopics(spark, f"{tmp_path}/topics", str(tmp_path))
    two = spark.createDataFrame([("r1", "x\ty"), ("r2", "é"), ("r2", "é")], "rid string, value string")
    t.append(two, "a", "job", 0)
    assert run("once", 10_000_000) == ["x\ty", "é"] and run("all", None) == ["x\ty", "é", "é"]
    t.append(two, "a", "job", 0)  # the batch again, in other files
    t.append(spark.createDataFrame([("plain",), ("plain",)], "value string"), "a", "other", 0)
    assert run("once", 10_000_000) == ["plain", "plain", "x\ty", "é"]
    assert len(run("all", None)) == 8
    assert sorted(r.value for r in t.lines("a").collect()) == ["plain", "plain", "x\ty", "é", "é"]


# -- state as functions ----------------------------------------------------------------
def test_upserts_become_a_changelog():
    empty = pd.DataFrame({"pk": pd.Series([], dtype=object), "seq": pd.Series([], dtype="int64"), "row": pd.Series([], dtype=object)})

    def rows(*found):
        return pd.DataFrame(found, columns=["pk", "seq", "row"])

    state, out, _ = _materialise(empty, rows(("a", 2, "A2"), ("a", 1, "A1"), ("b", 3, None)), 0)
    assert sorted(out.itertuples(index=False, name=None)) == [(1, True, "A1"), (2, False, "A1"), (2, True, "A2")]
    state, out, _ = _materialise(state, rows(("a", 5, None), ("a", 2, "A2"), ("a", 1, "A1"), ("b", 2, "late"), ("c", 1, "C")), 0)
    assert sorted(out.itertuples(index=False, name=None)) == [(1, True, "C"), (5, False, "A2")]
    state, out, _ = _materialise(state, rows(("a", 5, None), ("a", 6, "A6")), 0)
    assert list(out.itertuples(index=False, name=None)) == [(6, True, "A6")]
    assert sorted(state["pk"]) == ["a", "b", "c"]


def test_facts_wait_for_their_dimension():
    step = _wait(60)
    none = pd.DataFrame({"k": pd.Series([], dtype=object), "at": pd.Series([], dtype="int64"), "payload": pd.Series([], dtype=object), "is_dim": pd.Series([], dtype=bool)})

    def rows(*found):
        return pd.DataFrame(found, columns=["k", "at", "payload", "is_dim"])

    def shown(out):
        return sorted((p, f if isinstance(f, str) else None, s) for p, f, s in out.itertuples(index=False, name=None))

    state, out, wake = step(none, rows(("a", 100, "f1", False), ("b", 100, "f2", False), ("b", 90, "B", True)), 0)
    assert shown(out) == [("f2", "B", "found")] and wake == 161
    # a version of the exact time, one in the last moment, one a moment too late
    state, out, wake = step(state, rows(("b", 120, "B2", True), ("b", 120, "f3", False), ("a", 161, "A", True), ("c", 120, "f4", False), ("c", 180, "C", True)), 100)
    assert shown(out) == [("f3", "B2", "found"), ("f4", "C", "late")] and wake == 161
    state, out, wake = step(state, rows().iloc[:0], 161)
    assert shown(out) == [("f1", None, "timeout")] and wake is None
    assert sorted(state["payload"]) == ["A", "B2", "C"]  # B is older than what may be asked for


def test_late_rows_are_told_by_the_batches_before(spark, tmp_path):
    marks = History(spark, str(tmp_path / "m"), MARKS)

    def run(batch_id, *times, width=None):
        batch = spark.createDataFrame([(t,) for t in times], "ms bigint")
        marked = split_late(batch, batch_id, marks, F.col("ms"), 5, width)
        return [r.ms for r in marked.filter("late").orderBy("ms").collect()]

    assert run(0, 10, 100) == []
    for _ in range(2):  # a batch that runs again is judged alike
        assert run(1, 94, 95, 300, None) == [94]
    assert run(2, 294, 295) == [294]
    assert run(3, 289, 290, 299, 270, width=10) == [270, 289]  # at 295 the window to 290 has ended
    assert tuple(marks.read().agg(F.sum("late"), F.sum("total")).first()) == (4, 12)


def test_map_of_a_report_without_names(spark):
    top = spark.createDataFrame([("b", 2.0), (None, 1.0), ("", 4.0), ("a", 2.0)], "tm_name string, order_amount double")
    assert list(reports.as_map(top).first().amounts.items()) == [("", 5.0), ("a", 2.0), ("b", 2.0)]
    assert reports.as_map(top.limit(0)).first().amounts == {}


def test_carried_rows_of_a_batch_that_runs_again(spark, tmp_path):
    from tallybrook.sinks.history import Carried

    c = Carried(spark, str(tmp_path / "c"), "a int")

    def rows(*values):
        return spark.createDataFrame([(v,) for v in values], "a int")

    def seen(batch_id):
        return sorted(r.a for r in c.read(batch_id).collect())

    assert seen(0) == []
    c.write(rows(1, 2), 0)
    c.write(rows(), 1)
    assert seen(1) == [1, 2] and seen(2) == []
    c.write(rows(3), 1)  # the batch runs again
    assert seen(1) == [1, 2] and seen(2) == [3]
    c.write(rows(4), 2)
    assert seen(2) == [3] and seen(3) == [4]
    assert len([p for p in (tmp_path / "c").iterdir()]) == 2


def test_facts_that_wait_for_their_dimensions(spark):
    from tallybrook import schemas
    from tallybrook.operators import wide

    rows = spark.createDataFrame(
        [(1, 7, None, None, 100), (2, 8, None, None, 100), (3, 8, None, None, 20), (4, None, None, 5, 100),
         (5, None, None, 6, 100), (6, None, 1, None, 100), (7, None, None, None, None), (8, 8, None, None, None)],
        "detail_id bigint, user_id bigint, province_id bigint, sku_id bigint, at bigint")
    fields = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
              for f in schemas.ORDER_WIDE.fields]
    rows = rows.select(*fields, F.timestamp_millis("at").alias("_ot"))
    dims = {n: spark.createDataFrame([], ", ".join(f"{c} string" for c in cols)) for n, cols in schemas.DIM_COLUMNS.items()}
    dims["DIM_USER_INFO"] = spark.createDataFrame([("7", None, None)], "ID string, GENDER string, BIRTHDAY string")
    sku = "ID string, SKU_NAME string, PRICE string, SPU_ID string, TM_ID string, CATEGORY3_ID string"
    # product 5 names a trademark that is not there yet, product 6 names nothing
    dims["DIM_SKU_INFO"] = spark.createDataFrame([("5", "a", "1", None, "9", None), ("6", "b", "1", None, None, None)], sku)
    out = {r.detail_id: r for r in wide.enrich_or_wait(rows, dims, F.lit(130), 60).collect()}
    got = {k: r.status for k, r in out.items()}
    assert got == {1: "found", 2: "waiting", 3: "timeout", 4: "waiting", 5: "found", 6: "waiting", 7: "found", 8: "timeout"}
    assert out[4].sku_name == "a" and out[6].province_name is None
