"""Result-table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallybrook.schemas import RESULT_COLUMNS
from tallybrook.session import shuffles_end
from tallybrook.sinks.dims import _fs

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def positional(df: DataFrame, table: str) -> DataFrame:
    """Exactly the table's columns, in its order."""
    return df.select(RESULT_COLUMNS[table])


def write_result(df: DataFrame, path: str, table: str, batch_id: int) -> None:
    """Write a micro-batch to a parquet result table, below ``dt=D/batch_id=N``.

    The window's day is the outer folder, so a report of one day lists and opens
    that day only.  A repeated ``batch_id`` replaces what it wrote before; an
    empty batch writes nothing.
    """
    out = positional(df, table).withColumn("dt", F.to_date("stt"))
    # few files per day; AQE splits a day that is too large for one task
    out = out.hint("rebalance", "dt").withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "batch_id")
        .parquet(path)
    )


def write_large_result(df: DataFrame, path: str, table: str, batch_id: int, aside: str, blocks: int = 8) -> None:
    """:func:`write_result` for rows that are too many to be shuffled by day all at once.

    They are first written to ``aside`` by blocks of days, and what was shuffled to make
    them goes.  Then one block after the other is written as a result and leaves ``aside``.
    """
    spark = df.sparkSession
    block = F.coalesce(F.pmod(F.unix_date(F.to_date("stt")), F.lit(blocks)), F.lit(0))
    rows = positional(df, table).withColumn("_block", block)
    had = spark.conf.get(WRITERS)
    with shuffles_end(spark):
        spark.conf.set(WRITERS, str(blocks))  # a file per block is open, so that rows need not be sorted
        try:
            rows.write.option("compression", "zstd").partitionBy("_block").parquet(aside)
        finally:
            spark.conf.set(WRITERS, had)
        written = spark.read.schema(rows.schema).parquet(aside)
        for n in range(blocks):
            write_result(written.filter(F.col("_block") == n), path, table, batch_id)
            fs, p = _fs(spark, f"{aside}/_block={n}")
            fs.delete(p, True)
    fs, p = _fs(spark, aside)
    fs.delete(p, True)


def land_lines(lines: DataFrame, path: str, batch_id: int) -> None:
    """Write the lines (``value``, ``record_time``) of a micro-batch as text below
    ``dt=D/batch_id=N``, D the day they came.  A repeated ``batch_id`` replaces what it
    wrote before."""
    out = lines.select(
        "value", F.to_date("record_time").alias("dt"), F.lit(batch_id).cast("bigint").alias("batch_id")
    )
    (
        out.hint("rebalance", "dt").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "batch_id")
        .text(path)
    )


def write_jdbc(df: DataFrame, url: str, table: str, batchsize: int = 1000,
               **options: str) -> None:
    """Append a micro-batch to a database table by column position,
    ``batchsize`` rows per statement; at-least-once."""
    out = positional(df, table) if table in RESULT_COLUMNS else df
    out.write.format("jdbc").mode("append").options(
        url=url, dbtable=table, batchsize=str(batchsize), **options
    ).save()
