"""Live numbers of running streams."""

from __future__ import annotations

from collections import deque

from pyspark.sql.streaming.listener import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """The latest micro-batches as (batch, input rows, rows per second, milliseconds by phase).

    Add it with ``spark.streams.addListener``. Outcomes per batch come from the
    pipeline's ``on_batch``.
    """

    def __init__(self, keep: int = 1000) -> None:
        self.batches: deque = deque(maxlen=keep)
        self.failures: deque = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches.append((p.batchId, p.numInputRows, p.processedRowsPerSecond, dict(p.durationMs)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures.append(event.exception)
