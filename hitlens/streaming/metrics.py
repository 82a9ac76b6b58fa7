"""What a stream did, batch by batch, without another pass over its rows (AGG-13, FIL-4, STR-1).

The counts are observed in the plan that writes (``functions.observed``); the listener reads them and the batch's time from
the stream's progress.  A batch that reads its rows more than once must keep them meanwhile, or its counts add up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql.streaming import StreamingQueryListener

INTERVAL_MS = 10_000        # fixed value: the 10 s micro-batch


class BatchLog(StreamingQueryListener):
    """Calls ``tell`` with a dict per micro-batch: query, batch_id, total_lines, good_lines, rejected_lines, empty,
    millis, in_time (within ``interval_ms``)."""

    def __init__(self, tell: Callable[[dict], None], interval_ms: int = INTERVAL_MS, name: str = "lines"):
        self.tell, self.interval_ms, self.name = tell, interval_ms, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(self.name)
        if counts is None:
            return
        self.tell({"query": str(progress.id), "batch_id": progress.batchId, **counts.asDict(),
                   "empty": not counts["total_lines"], "millis": progress.batchDuration,
                   "in_time": progress.batchDuration <= self.interval_ms})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
