"""Progress of running queries in the log: counts per batch, never rows."""

from __future__ import annotations

import logging

from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)


class ProgressLog(StreamingQueryListener):
    """Register with ``spark.streams.addListener(ProgressLog())``."""

    def onQueryStarted(self, event) -> None:
        log.info("%s started", event.name)

    def onQueryProgress(self, event) -> None:
        done = event.progress
        log.info("%s batch %d: %d rows read", done.name, done.batchId, done.numInputRows)

    def onQueryIdle(self, event) -> None:
        log.debug("query %s is idle", event.id)

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            log.error("query %s failed: %s", event.id, event.exception)
        else:
            log.info("query %s ended", event.id)
