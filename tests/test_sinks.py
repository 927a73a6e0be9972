import pytest
from pyspark.sql import functions as F

from tallybrook import schemas
from tallybrook.operators import reports
from tallybrook.session import scratch
from tallybrook.sinks import dims, tables
from tallybrook.sources import files, topics


def changes(spark, rows):
    return spark.createDataFrame(rows, "after map<string,string>, seq bigint")


def state(spark, root, name="dim_x"):
    return sorted(tuple(r) for r in dims.read_dim(spark, root, name).collect())


def test_dim_is_created_once_and_checked(spark, tmp_path):
    root = str(tmp_path)
    schema = dims.create_dim(spark, root, "dim_x", "id, tm_name")
    assert schema.names == ["ID", "TM_NAME"]
    assert dims.create_dim(spark, root, "dim_x", "id,other").names == ["ID", "TM_NAME", "OTHER"]
    assert dims.create_dim(spark, root, "dim_x", "id").names == ["ID", "TM_NAME", "OTHER"]
    assert state(spark, root) == []
    with pytest.raises(ValueError):
        dims.create_dim(spark, root, "dim_y", "name,logo")


def test_dim_upserts(spark, tmp_path):
    root = str(tmp_path)
    dims.create_dim(spark, root, "dim_x", "id,a,b")
    many = [({"id": str(i), "a": f"a{i}", "b": "x"}, i) for i in range(20)]
    dims.upsert_dim(spark, changes(spark, many), root, "dim_x", 0)
    want = {str(i): [f"a{i}", "x"] for i in range(20)}
    batch = [({"id": "3", "a": "old"}, 1), ({"id": "3", "a": "new"}, 2), ({"id": "3", "b": "y"}, 1),
             ({"id": "4", "a": None}, 1), ({"id": "30", "a": "n"}, 1), ({"a": "no key"}, 5)]
    for _ in range(2):  # a repeated batch changes nothing
        dims.upsert_dim(spark, changes(spark, batch), root, "dim_x", 1)
        want.update({"3": ["new", "y"], "4": [None, "x"], "30": ["n", None]})
        got = {k: [a, b] for k, a, b in state(spark, root)}
        assert got == want
    # a new base ends the search for older deltas
    dims.merge_dim(spark, root, "dim_x")
    dims.upsert_dim(spark, changes(spark, [({"id": "5", "a": "five"}, 1)]), root, "dim_x", 50)
    want["5"][0] = "five"
    assert {k: [a, b] for k, a, b in state(spark, root)} == want
    dims.upsert_dim(spark, changes(spark, [({"id": "6", "a": "six"}, 1)]), root, "dim_x", 51)
    want["6"][0] = "six"
    assert {k: [a, b] for k, a, b in state(spark, root)} == want
    rejected = spark.read.text(f"{root}/DIM_X/rejected/*").collect()
    assert [r.value for r in rejected] == ['{"A":"no key"}']


def test_unfinished_version_is_ignored(spark, tmp_path):
    root = str(tmp_path)
    dims.create_dim(spark, root, "dim_x", "id,a")
    dims.upsert_dim(spark, changes(spark, [({"id": "1", "a": "x"}, 1)]), root, "dim_x", 0)
    for folder in ("schema", "base", "delta"):
        (tmp_path / "DIM_X" / folder / "v=000000000001.000000000001").mkdir(parents=True)
    assert state(spark, root) == [("1", "x")]
    dims.upsert_dim(spark, changes(spark, [({"id": "1", "a": "y"}, 2)]), root, "dim_x", 1)
    assert state(spark, root) == [("1", "y")]


def product_rows(spark, n=4):
    cols = schemas.RESULT_COLUMNS["product_stats"]
    df = spark.range(n).select(
        F.concat(F.lit("2024-01-0"), (F.col("id") % 2 + 1).cast("string"), F.lit(" 00:00:00")).alias("stt"),
        *[F.col("id").alias(c) for c in cols if c not in ("stt",)], F.lit("x").alias("order_id_set"))
    return df.select(*reversed(df.columns))


def test_result_table_is_positional_idempotent_and_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        tables.write_result(product_rows(spark), path, "product_stats", 7)
    tables.write_result(product_rows(spark, 2), path, "product_stats", 8)
    t = files.result_table(spark, path)
    assert t.columns[:25] == schemas.RESULT_COLUMNS["product_stats"]
    assert t.count() == 6
    day = reports.of_day(t, 20240101)
    assert day.count() == 3
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_result_over_jdbc(spark, tmp_path):
    url = f"jdbc:derby:memory:{tmp_path.name};create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([("red", 2, "search", "a", "b", 5)],
                               "keyword string, ct bigint, source string, stt string, edt string, ts bigint")
    mixed = df.select("ts", "edt", "stt", "source", "ct", "keyword")
    for _ in range(2):
        tables.write_jdbc(mixed, url, "keyword_stats", batchsize=5, **driver)
    got = files.result_table_jdbc(spark, url, "keyword_stats", **driver)
    assert [c.lower() for c in got.columns] == schemas.RESULT_COLUMNS["keyword_stats"]
    assert [tuple(r) for r in got.collect()] == [("red", 2, "search", "a", "b", 5)] * 2


def test_kafka_options():
    read = topics.kafka_read_options("a:1, b:2", " t ", "g", "earliest", 32)
    assert read == {"kafka.bootstrap.servers": "a:1,b:2", "subscribe": "t",
                    "startingOffsets": "earliest", "groupIdPrefix": "g", "minPartitions": "32"}
    assert topics.kafka_read_options("a:1", "t")["startingOffsets"] == "latest"
    assert topics.kafka_write_options("a:1") == {"kafka.bootstrap.servers": "a:1"}
    assert topics.kafka_write_options("a:1", " t ")["topic"] == "t"
    with pytest.raises(ValueError):
        topics.kafka_read_options("a:1", "t", starting="middle")


def test_delimited_stream_join(spark, tmp_path):
    """Two delimited streams joined within five seconds."""
    from conftest import drain
    from tallybrook.operators.joins import interval_join

    for name, lines in {"l": ["a,ann,100", "z,end,9999"],
                        "r": ["a,f,105", "a,m,95", "a,x,106", "b,f,100", "z,q,20000"]}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "1.csv").write_text("\n".join(lines))
    left = files.delimited_stream(spark, str(tmp_path / "l"), "id string, name string, ts bigint")
    right = files.delimited_stream(spark, str(tmp_path / "r"), "id string, sex string, ts bigint")
    left = left.select("id", "name", F.timestamp_seconds("ts").alias("t")).withWatermark("t", "0 seconds")
    right = right.select(F.col("id").alias("rid"), "sex", F.timestamp_seconds("ts").alias("u")).withWatermark(
        "u", "0 seconds")
    joined = interval_join(left, right, [("id", "rid")], "t", "u", -5000, 5000,
                           project=[F.col("l.name"), F.col("r.sex")])
    out, _ = drain(spark, joined, tmp_path)
    assert sorted(tuple(r) for r in out.collect()) == [("ann", "f"), ("ann", "m")]
    assert files.delimited(spark, str(tmp_path / "l"), "id string, name string, ts bigint").count() == 2


def test_text_lines_and_console(spark, tmp_path):
    from tallybrook.streaming.run import ONCE, debug_print

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("one\ntwo\n")
    assert files.text_lines(spark, str(tmp_path / "in")).count() == 2
    src = files.text_topic(spark, str(tmp_path / "in"))
    q = debug_print(src, str(tmp_path / "cp"), "lines", ONCE)
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 2


def test_scratch_is_shared(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch(spark, "x").startswith(root) and scratch(spark, "x") != scratch(spark, "x")


def test_dim_widens_with_its_rules(spark, tmp_path):
    root = str(tmp_path / "wide")
    dims.create_dim(spark, root, "dim_user", "id,gender")

    def put(batch, seq, **after):
        rows = [({k: v for k, v in after.items()}, seq)] if after else []
        df = spark.createDataFrame(rows, "after map<string,string>, seq bigint")
        dims.upsert_dim(spark, df, root, "dim_user", batch, merge_after=2)

    def versions(kind):
        return [v[:2] for v in dims._versions(spark, f"{root}/DIM_USER/{kind}")]

    put(0, 1, id="1", gender="F")
    assert dims.create_dim(spark, root, "dim_user", "id,name,phone").names == ["ID", "GENDER", "NAME", "PHONE"]
    assert versions("schema") == [(0, 0), (1, 0)]  # the old one is not touched
    put(1, 2, id="1", name="ann")
    put(2, 0)  # a quiet batch leaves nothing
    want = [{"ID": "1", "GENDER": "F", "NAME": "ann", "PHONE": None}]
    assert [r.asDict() for r in dims.read_dim(spark, root, "dim_user").collect()] == want
    assert versions("delta") == [(0, 0), (1, 1)]
    for batch in range(3, 9):
        put(batch, batch, id=str(batch), gender="M")
        put(batch, batch, id=str(batch), gender="M")  # again: the same delta
    assert versions("base")[-1][0] >= 3 and len(versions("base")) <= 2 and len(versions("delta")) <= 6
    got = {r.ID: (r.GENDER, r.NAME) for r in dims.read_dim(spark, root, "dim_user", ["ID", "GENDER", "AGE"]).collect()}
    assert got == {"1": ("F", "ann"), **{str(i): ("M", None) for i in range(3, 9)}}
    put(0, 1, id="1", gender="X")  # a lost checkpoint counts from 0 again
    assert dims.read_dim(spark, root, "dim_user").filter("ID = 1").first().GENDER == "X"


def test_older_changes_only_fill_gaps(spark, tmp_path):
    root = str(tmp_path)
    dims.create_dim(spark, root, "dim_x", "id,a,b")
    dims.upsert_dim(spark, changes(spark, [({"id": "1", "a": "new"}, 9)]), root, "dim_x", 0, ordered=True)
    dims.upsert_dim(spark, changes(spark, [({"id": "1", "a": "old", "b": "x"}, 5)]), root, "dim_x", 1, ordered=True)
    assert state(spark, root) == [("1", "new", "x")]
    none = dims.read_dim(spark, root, "dim_none", ["ID", "N"])
    assert none.columns == ["ID", "N"] and none.count() == 0


def test_late_rows_are_summed_over_the_whole_run():
    from types import SimpleNamespace as N

    from tallybrook.streaming.run import LateRows

    heard = LateRows()
    heard.onQueryStarted(N(id="q"))
    for _ in range(150):
        heard.onQueryProgress(N(progress=N(id="q", stateOperators=[N(numRowsDroppedByWatermark=2)])))
    assert heard.of(N(id="q")) == 300
