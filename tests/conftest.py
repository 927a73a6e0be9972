from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from tallybrook.session import prepare

    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(home / "shared"))
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={home}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield prepare(session)
    session.stop()


T0 = 1704067200000  # 2024-01-01 00:00:00 UTC


def page(mid, ms, last="home", seq=0, **more):
    """One page row as a dict for ``log_frame``."""
    return {"mid": mid, "ts": T0 + ms, "last": last, "seq": seq, **more}


def log_frame(spark, rows):
    """Page-log rows with the nested log schema."""
    from pyspark.sql import functions as F

    flat = spark.createDataFrame(
        [
            (
                r["mid"], r.get("is_new", "0"), r["last"], r.get("page_id", "p"),
                r.get("item"), r.get("item_type"), r.get("during"), r["ts"], r["seq"],
            )
            for r in rows
        ],
        "mid string, is_new string, last string, page_id string, item string,"
        " item_type string, during bigint, ts bigint, seq bigint",
    )
    return flat.select(
        F.struct("mid", "is_new", F.lit("v1").alias("vc"), F.lit("c1").alias("ch"),
                 F.lit("a1").alias("ar")).alias("common"),
        F.struct("page_id", F.col("last").alias("last_page_id"), "item", "item_type",
                 F.col("during").alias("during_time")).alias("page"),
        F.lit(None).cast("array<struct<item:string,item_type:string>>").alias("displays"),
        F.lit(None).cast("string").alias("start"),
        "ts",
        "seq",
    )


def feed(spark, frame, folder, batches):
    """Write a frame as parquet files, one per filter in ``batches``, and read
    it back as a stream that takes one file per micro-batch."""
    import time

    for cond in batches:
        frame.filter(cond).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)  # file times order the micro-batches
    return (
        spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    )


def drain(spark, df, tmp_path, name="out"):
    """Run a stream to the end of its input and read what it wrote."""
    from tallybrook.streaming.run import ONCE, start

    out = str(tmp_path / name)
    q = start(df, str(tmp_path / f"{name}-cp"), trigger=ONCE, path=out)
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out), q
