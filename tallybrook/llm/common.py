"""Helpers that the text operators share: words, packed rows, sizes and keys."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
from collections.abc import Callable, Iterable, Iterator
from itertools import count
from types import ModuleType

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def worker_cache(key, make, alone: bool = False):
    """What a Python worker keeps from task to task.  The functions of this package
    travel to the workers by value, so module variables would be new in each task.
    With ``alone`` it is made in place of all that is kept."""
    kept = sys.modules.setdefault("_tallybrook_kept", ModuleType("_tallybrook_kept"))
    if key not in kept.__dict__:
        if alone:
            kept.__dict__.clear()
            give_back()
        kept.__dict__[key] = make()
    return kept.__dict__[key]


class WordHashes(dict):
    """64-bit hash of each word met, kept between calls and emptied when full."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_hashes() -> WordHashes:
    return worker_cache("word hashes", WordHashes)


def split_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text; bytes split at just these."""
    return text.split() if text else []


def pack(table: pa.Table) -> bytes:
    """A table as compressed bytes, to travel as one value of a row."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_all()


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a piece holds about ``limit`` bytes of a text
    column at most (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column(column)
        ends = np.cumsum(byte_lengths(sizes))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def give_back() -> None:
    """Hand freed memory back to the system at the end of a task: workers live on,
    and what they hold counts beside the next stage's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def byte_lengths(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    n = pc.binary_length(texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()))
    return pc.fill_null(n, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def as_bytes(texts: pa.Array) -> list[bytes | None]:
    return texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()).to_pylist()


def spread(ids: np.ndarray, groups: int) -> np.ndarray:
    """Group number of each integer key, evenly spread also for regular keys."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(groups)).astype(np.int32)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of a whole text column, for the choice of group counts."""
    return docs.select(F.sum(F.octet_length(column))).head()[0] or 0


def keyed(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Add ``_n``: 0, or the number of a row among those with the same key,
    ordered by text, so that (key, _n) names a row.  A NULL key is a value of its
    own.  Rows are only shuffled for this if a key does occur twice."""
    again = docs.groupBy(key).count().filter("count > 1").limit(1)
    if again.isEmpty():
        return docs.withColumn("_n", F.lit(0))
    return docs.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("text")) - 1)


def aside(docs: DataFrame, taken: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The input with other names for the columns whose names (whatever their case) an
    operator needs for its own, and what gives them their names back."""
    low, used = {t.lower() for t in taken}, {c.lower() for c in docs.columns}
    free = (f"_own{i}" for i in count() if f"_own{i}" not in used | low)
    hidden = {c: next(free) for c in docs.columns if c.lower() in low}
    shown = {new: old for old, new in hidden.items()}
    return docs.withColumnsRenamed(hidden), lambda df: df.withColumnsRenamed(shown)


def shared(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one that all executors share."""
    from tallybrook.session import scratch

    return scratch(spark, name)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage so
    that a lost executor costs no more than the work since then."""
    path = shared(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")
