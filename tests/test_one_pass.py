"""The job that splits the log: what its topic costs is paid once."""

import json

import pandas as pd
from pyspark.sql import functions as F

from conftest import drain, feed
from tallybrook.functions import jsontext
from tallybrook.functions.jsonlines import parse_log
from tallybrook.operators import logs
from tallybrook.schemas import LOG, LOG_KEYS
from tallybrook.sources.topics import FolderTopics

LINES = [
    '{"common":{"mid":"a","is_new":"1"},"ts":5}', '{"common":{"mid":"a","is_new":"1"},"ts":4}',
    '{"common":{"mid":"a","is_new":"0"},"ts":1}', '{"common":{"mid":"b"},"ts":1}', '{"common":{"mid":"b","is_new":"x"},"ts":2}',
    '{"common":{"is_new":"1"},"ts":3}', '{"common":null,"ts":3}', "{broken", "", '{"common":{"mid":"b","is_new":"1"},"ts":9}',
]
WANT = ["0", "1", "0", None, "x", "1", None, None, None, "1"]


def test_topic_and_parse_run_once_for_marked_and_other_rows(spark, tmp_path):
    topics = FolderTopics(spark, str(tmp_path / "topics"), str(tmp_path / "cp"))
    rows = spark.createDataFrame([(str(i), line) for i, line in enumerate(LINES)], "rid string, value string")
    topics.append(rows, "log", "test", 0)
    raw = topics.read("log").withColumn("seq", F.xxhash64("rid"))
    parsed = parse_log(raw, schema=LOG_KEYS, keep=("seq", "rid"))
    slim = parsed.select("raw", "common", "start", "ts", "seq", "rid", "dirty")
    fixed = logs.correct_new_visitors(slim)
    assert fixed.schema.names == slim.schema.names
    out, query = drain(spark, fixed, tmp_path)
    assert len(query.lastProgress["stateOperators"]) == 2  # the topic's ids, the visitors
    got = {int(r.rid): (r.raw, r.common and r.common.is_new) for r in out.collect()}
    assert got == dict(enumerate(zip(LINES, WANT)))


def test_hot_visitor_among_rows_that_only_pass(spark, tmp_path):
    rows = spark.range(300).select(
        F.struct(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("m"), (F.col("id") % 7).cast("string"))).alias("mid"),
                 F.when(F.col("id") % 2 == 0, "1").when(F.col("id") % 5 == 0, "0").alias("is_new")).alias("common"),
        (F.col("id") % 50).alias("ts"), F.when(F.col("id") % 4 < 3, F.col("id")).alias("seq"), "id",
    )
    kept = [r.asDict(True) for r in rows.collect()]
    fixed = logs.correct_new_visitors(feed(spark, rows, str(tmp_path / "in"), ["true"]))
    out, _ = drain(spark, fixed, tmp_path)
    got = {r.id: r.common.is_new for r in out.collect()}
    assert len(got) == len(kept) and out.count() == len(kept)
    marked = [r for r in kept if r["common"]["is_new"] == "1" and r["common"]["mid"]]
    assert {i: got[i] for i in got if i not in {r["id"] for r in marked}} == {r["id"]: r["common"]["is_new"] for r in kept if r not in marked}
    for mid in {r["common"]["mid"] for r in marked}:
        assert sorted(got[r["id"]] for r in marked if r["common"]["mid"] == mid)[-2:] in (["0", "1"], ["1"])


def test_keys_alone_are_read_as_from_whole_records(spark):
    c = '"common":{"mid":"m","is_new":"1","vc":5}'
    more = [f'{{{c},"ts":1,{x}}}' for x in ('"page":5', '"page":"x","displays":[5]', '"displays":{"a":1}', '"start":{"e":1}', '"start":[1,2]',
                                            '"displays":[{"item":{"a":1}},7,[1]]', '"page":{"page_id":}', '"page":NaN', '"ts":2', '"page":{"during_time":"x"}')]
    df = spark.createDataFrame([(x,) for x in [*LINES, *more, f'{{{c},"ts":1}}{{"a":1}}', f'{{{c},"ts":1.5}}', f'{{{c},"ts":"7"}}', '{"common":5,"ts":1}']], "value string")
    whole, keys = (parse_log(df, schema=s).select("raw", "common.mid", "common.is_new", "start", "ts", "dirty").collect() for s in (LOG, LOG_KEYS))
    assert whole == keys


def test_one_reader_serves_a_batch(monkeypatch):
    made, kept = [], []
    decoder = json.JSONDecoder
    monkeypatch.setattr(jsontext.json, "JSONDecoder", lambda **k: made.append(1) or decoder(**k))
    monkeypatch.setattr(jsontext.F, "pandas_udf", lambda _: lambda f: kept.append(f) or (lambda c: c))
    jsontext.carried_items(None, "displays", ("page", "page_id"))
    jsontext.with_value(None, ("common", "is_new"), '"0"')
    texts = pd.Series(['{"page":{"page_id":"p"},"displays":[{"a":1},{"b":2}]}', None, "{"] * 20)
    assert kept[0](texts).tolist()[0] == ['{"page_id":"p","a":1}', '{"page_id":"p","b":2}']
    kept[1](texts)
    assert len(made) <= 2
