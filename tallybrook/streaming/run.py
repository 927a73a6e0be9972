"""Starting streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

# a checkpoint every five seconds, as the jobs' settings ask
TRIGGER = {"processingTime": "5 seconds"}
ONCE = {"availableNow": True}
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def _start(df: DataFrame, w: DataStreamWriter, trigger: dict | None, idle: bool) -> StreamingQuery:
    w = w.trigger(**(trigger or TRIGGER))
    if idle:
        return w.start()
    conf = df.sparkSession.conf
    had = conf.get(NO_DATA)
    conf.set(NO_DATA, "false")  # a query keeps the settings it was started with
    try:
        return w.start()
    finally:
        conf.set(NO_DATA, had)


def start(df: DataFrame, checkpoint: str, name: str | None = None, sink: str = "parquet",
          trigger: dict | None = None, mode: str = "append", idle: bool = True, **options: str) -> StreamingQuery:
    """Start a query with its own checkpoint; append mode, so every row of a
    window comes once, after the watermark has closed it.

    ``idle=False`` runs no micro-batch without new rows.  It is for queries that emit
    nothing when only time has passed, such as an inner join of two streams; state that
    has expired then goes with the next rows.
    """
    w = df.writeStream.format(sink).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return _start(df, w.options(**options), trigger, idle)


def start_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  name: str | None = None, trigger: dict | None = None, idle: bool = True) -> StreamingQuery:
    """Start a query whose micro-batches go through ``write(frame, batch_id)``.

    ``foreachBatch`` may run a batch again after a failure, so ``write`` must
    replace what the same ``batch_id`` wrote before.  ``idle`` as in :func:`start`.
    """
    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return _start(df, w, trigger, idle)


def debug_print(df: DataFrame, checkpoint: str, prefix: str,
                trigger: dict | None = None) -> StreamingQuery:
    """Print a stream to the console."""
    return start(df, checkpoint, prefix, "console", trigger, truncate="false")


class LateRows(StreamingQueryListener):
    """Rows dropped as late, per query and summed over its whole run.

    ``spark.streams.addListener(LateRows())`` before the queries start; a query's
    own reports only go back a hundred micro-batches.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(int(op.numRowsDroppedByWatermark) for op in event.progress.stateOperators)
        key = str(event.progress.id)
        self.dropped[key] = self.dropped.get(key, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> int:
        return self.dropped.get(str(query.id), 0)


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped as late in the micro-batches a query still reports (a hundred)."""
    return sum(
        int(op.get("numRowsDroppedByWatermark", 0))
        for p in query.recentProgress
        for op in p["stateOperators"]
    )
