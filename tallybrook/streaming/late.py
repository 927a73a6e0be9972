"""Late rows as a lane of their own, ahead of a window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallybrook.sinks.history import History

# What a stage keeps of every micro-batch: its newest event time, and how many rows
# were late.
MARKS = "newest bigint, late bigint, total bigint"


def is_late(ms: Column, mark: int | None, width_ms: int | None = None) -> Column:
    """Whether a row's event time is behind the mark or, with a width, whether the window
    it belongs to has ended by then.  Nothing is late before there is a mark."""
    if mark is None:
        return F.lit(False)
    if width_ms is None:
        return F.coalesce(ms < F.lit(mark), F.lit(False))
    end = ms - F.pmod(ms, F.lit(width_ms)) + width_ms
    return F.coalesce(end <= F.lit(mark), F.lit(False))


def split_late(batch: DataFrame, batch_id: int, marks: History, ms: Column, delay_ms: int,
               width_ms: int | None = None) -> DataFrame:
    """A micro-batch with the column ``late``, judged by the mark of the batches before it:
    their newest event time less ``delay_ms``.  Marks are read as of the batch, so one that
    runs again is judged alike.  Rows without a time are not late.
    """
    before = marks.read(batch_id - 1).agg(F.max("newest")).first()[0]
    mark = None if before is None else before - delay_ms
    marked = batch.withColumn("late", is_late(ms, mark, width_ms))
    marks.append(
        marked.agg(
            F.max(ms).alias("newest"), F.count(F.when(F.col("late"), 1)).alias("late"), F.count("*").alias("total")
        ),
        batch_id,
    )
    return marked
