"""Token ids as ORC files in document order.

Documents are dealt by ranges of doc_id and sorted, so a file holds one range;
ids are integer lists that ORC stores run-length encoded.  Stripes carry row
indexes and a Bloom filter on doc_id: a reader of some documents opens the
stripes that can hold them, and any reader can split a file by stripes.
``local_start`` counts the ids before a document within its file, so the place
of a document in the whole needs only one number per file.

A NULL or empty text has the end id alone.  Rows with a NULL doc_id come first.
Rows that share a doc_id stay separate, in no stated order among themselves.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybrook.llm.common import sliced
from tallybrook.llm.tokens import encoder

MAX_FILES = 100_000  # whose places in the whole are broadcast
OPTIONS = {
    "orc.compress": "ZSTD",
    "orc.stripe.size": str(16 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, kind: str = "byte") -> None:
    """Encode every text, append ``end_id`` and write doc_id, local_start,
    n_tokens and ids below ``path``."""

    def encode(batches):
        code, start = encoder(tokenizer, kind), 0
        for batch in sliced(batches, "text", 8 << 20):
            ids, at = code.encode(batch.column("text"))
            n = len(at) - 1
            ids = np.insert(ids.astype(np.int32), at[1:], end_id)
            at = at + np.arange(n + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(start + at[:-1]),
                    pa.array(np.diff(at)),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids)),
                ],
                names=["doc_id", "local_start", "n_tokens", "ids"],
            )
            start += int(at[-1])

    key = dict(docs.dtypes)["doc_id"]
    (
        docs.select("doc_id", "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id")
        .mapInArrow(encode, f"doc_id {key}, local_start bigint, n_tokens bigint, ids array<int>")
        # places count by file: one file for each task, whatever the session's limit
        .write.options(**OPTIONS, maxRecordsPerFile=0)
        .orc(path)
    )


def read_ids(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The files as doc_id, start, n_tokens and ids.  A condition on doc_id is
    checked against file, stripe and row-group statistics and Bloom filters
    before any ids are read."""
    rows = spark.read.orc(path).withColumn("file", F.col("_metadata.file_name"))
    # one row per file: its ids, and those of the files before it
    files = rows.groupBy("file").agg(F.min("doc_id").alias("low"), F.sum("n_tokens").alias("n"), F.max("doc_id").alias("high"))
    # a file of one key alone comes after the file that ends with that key
    before = Window.orderBy(F.asc_nulls_first("low"), F.asc_nulls_first("high"), "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if len(spark.read.orc(path).inputFiles()) <= MAX_FILES:
        # two numbers for each file: then the ids need not be shuffled
        files = F.broadcast(files)
    if where is not None:
        rows = rows.filter(where)
    return rows.join(files, "file").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids"
    )


def with_digest(read: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as unsigned little-endian
    32-bit integers."""

    def digest(batches):
        for batch in batches:
            ids = batch.column("ids")
            at = ids.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<u4"))).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    key = dict(read.dtypes)["doc_id"]
    return read.mapInArrow(digest, f"doc_id {key}, start bigint, n_tokens bigint, ids_crc32 bigint")
