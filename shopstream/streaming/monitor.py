"""Per-micro-batch logging from the query listener: input rows, duration, state
size and rows dropped behind the watermark of every stateful step, and counts of
odd input. No extra Spark jobs."""

from __future__ import annotations

import logging

from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger("shopstream.streaming")


class ProgressLogger(StreamingQueryListener):
    def onQueryStarted(self, event) -> None:
        log.info("query %s started (run %s)", event.name or event.id, event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        # Chained aggregates have a state operator each.
        state = [(s.numRowsTotal, s.numRowsDroppedByWatermark) for s in p.stateOperators]
        checks = {name: row.asDict() for name, row in (p.observedMetrics or {}).items()}
        log.info("batch %s: %s input rows, %s ms, (state rows, dropped by watermark) %s, checks %s",
                 p.batchId, p.numInputRows, p.batchDuration, state, checks)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            log.error("query %s failed: %s", event.id, event.exception)
        else:
            log.info("query %s stopped", event.id)
