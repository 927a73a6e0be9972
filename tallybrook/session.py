"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import gc
import os
import tempfile
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

# Runtime SQL settings every job relies on.  They are all dynamic, so they can
# be applied to a session somebody else built.
RUNTIME_CONF = {
    # one zone for every date-time string (production: the shop's own zone)
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # hot join keys are split at run time, also where that costs one more shuffle
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # parquet is several times smaller on disk than in a broadcast: plan with the
    # size in memory, and let AQE decide the rest on measured sizes
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # transformWithState needs RocksDB; changelog checkpoints keep commits small
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # a join of streams keeps one store per partition instead of four, and no write
    # looks its key up only to count rows
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # state lies on disk twice, in the store and in the checkpoint: half the bytes of lz4
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
}

# Settings that only count when a session is built.
STARTUP_CONF = {
    # recording the Python line of every column call doubles the time it takes
    # to build a long plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def prepare(spark: SparkSession, zone: str | None = None) -> SparkSession:
    """Apply the runtime settings to an existing session, but for those that the
    caller has set; ``zone`` is set in any case."""
    given = spark.conf.getAll
    for key, value in RUNTIME_CONF.items():
        if key not in given:
            spark.conf.set(key, value)
    if zone:
        spark.conf.set("spark.sql.session.timeZone", zone)
    sc = spark.sparkContext
    if sc.master.startswith("local") and "spark.sql.shuffle.partitions" not in given:
        # 200 state stores on one machine only cost start-up time
        spark.conf.set("spark.sql.shuffle.partitions", str(sc.defaultParallelism))
    return spark


def small_batches(spark: SparkSession) -> SparkSession:
    """Rows of long texts go to Python workers a few MB at a time, not 10,000 rows at a
    time, whatever those take on both sides; not if the caller has set it."""
    if ARROW_BYTES not in spark.conf.getAll:
        spark.conf.set(ARROW_BYTES, "4m")
    return spark


@contextlib.contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written in here go with the write.  Not for frames that
    are run more than once, which would find them gone."""
    had = spark.conf.get(FILE_CLEANUP)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(FILE_CLEANUP, had)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of queries that have ended.  Spark removes them when the
    driver's collector finds them without an owner, and a driver with memory to spare may
    not collect for half an hour.  A query's thread may end a little after the query, so
    there is a second round."""
    for wait in (0, 0.5):
        time.sleep(wait)
        gc.collect()
        spark._jvm.System.gc()


def build(app: str = "tallybrook", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STARTUP_CONF, **conf}.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for checkpoints and intermediate tables.

    It lives under the shared folder named by ``spark.checkpoint.dir``, which
    every executor can reach.  Without that setting only a local session may
    fall back to a temporary folder.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = os.path.join(tempfile.gettempdir(), "tallybrook")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
