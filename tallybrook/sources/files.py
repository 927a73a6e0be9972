"""File sources: driver tables, text topics, delimited streams, result tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table with zone-less timestamps read as TIMESTAMP.

    Event time must be TIMESTAMP for watermarks; a cast keeps column pruning
    and the file filters on all other columns.
    """
    return _zoned(spark.read.parquet(f"{folder}/{name}.parquet"))


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a stream (a single file or a folder of part files)."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    # braces make it a glob, so that one file is accepted like a folder
    return _zoned(spark.readStream.schema(schema).parquet(f"{folder}/{{{name}.parquet}}"))


def _zoned(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("timestamp").alias(f.name)
            if isinstance(f.dataType, T.TimestampNTZType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def text_topic(spark: SparkSession, folder: str, per_batch: int | None = None) -> DataFrame:
    """A folder of text files as a stream of ``value`` lines.

    ``record_time`` is the file's time, the closest there is to a broker's, and
    ``offset`` orders whole files by it; where the order of lines matters they
    must carry a sequence of their own.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    at = F.col("_metadata.file_modification_time")
    return reader.load(folder).select(
        "value", at.alias("record_time"), F.unix_micros(at).alias("offset")
    )


def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same folder as a static frame."""
    return spark.read.option("recursiveFileLookup", "true").text(folder)


def delimited_stream(spark: SparkSession, folder: str, schema: T.StructType | str,
                     sep: str = ",") -> DataFrame:
    """Delimited lines as typed rows."""
    return spark.readStream.schema(schema).option("sep", sep).csv(folder)


def delimited(spark: SparkSession, folder: str, schema: T.StructType | str,
              sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).option("sep", sep).csv(folder)


def result_table(spark: SparkSession, path: str, day: int | None = None) -> DataFrame:
    """A result table written by :func:`tallybrook.sinks.tables.write_result`; with
    ``day`` (yyyyMMdd) only that day's folder is listed."""
    if day is not None:
        d = str(day)
        one = f"{path}/dt={d[:4]}-{d[4:6]}-{d[6:]}"
        try:
            return spark.read.option("basePath", path).parquet(one)
        except AnalysisException:  # nothing of that day
            return spark.read.parquet(path).filter(F.col("dt") == F.to_date(F.lit(d), "yyyyMMdd"))
    return spark.read.parquet(path)


def result_table_jdbc(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """A result table in a database."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()
