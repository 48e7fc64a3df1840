"""Streams that fail are started again while the others run; a signal drains them all."""

from __future__ import annotations

import logging
import signal
import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)

Start = Callable[[], StreamingQuery]


@dataclass
class _Watched:
    name: str
    start: Start
    query: StreamingQuery | None = None
    failures: int = 0
    again_at: float | None = 0.0
    error: str | None = None


class _Wake(StreamingQueryListener):
    """Tells the supervisor that some query has ended."""

    def __init__(self, ended: threading.Event):
        super().__init__()
        self.ended = ended

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


class Supervisor:
    """Runs streams until they end, are drained, or have failed too often.

    A query that fails is started again after ``pause`` seconds, twice as long after
    each further failure in a row and ``longest`` at most; the others go on meanwhile.
    After ``restarts`` failures in a row it is given up. A run that finished a batch
    ends the row. Every start continues from the query's checkpoint.

    ``draining`` is set once the streams shall end; pass its ``is_set`` as ``closed`` to
    the streams, so that none begins another batch. One that does not ask is stopped when
    the batch it is in has ended.
    """

    def __init__(
        self,
        spark: SparkSession,
        starts: dict[str, Start],
        *,
        restarts: int = 5,
        pause: float = 1.0,
        longest: float = 300.0,
        draining: threading.Event | None = None,
    ):
        self.spark, self.restarts, self.pause, self.longest = spark, restarts, pause, longest
        self._watched = [_Watched(name, start) for name, start in starts.items()]
        self._ended, self._draining = threading.Event(), draining or threading.Event()

    @property
    def queries(self) -> dict[str, StreamingQuery]:
        """The queries that run just now."""
        return {w.name: w.query for w in self._watched if w.query is not None}

    def drain(self) -> None:
        """Ask for an end: each query finishes the batch it is in and is not started
        again. May be called from a signal handler or another thread."""
        self._draining.set()
        self._ended.set()

    def run(self) -> dict[str, str | None]:
        """Per query the error it was given up with, None if it ended well."""
        wake = _Wake(self._ended)
        self.spark.streams.addListener(wake)
        try:
            while not self._draining.is_set() and any([self._look(w) for w in self._watched]):
                self._ended.wait(0.5)
                self._ended.clear()
        finally:
            self.spark.streams.removeListener(wake)
            for watched in self._watched:
                self._stop(watched)
        return {w.name: w.error for w in self._watched}

    def _look(self, watched: _Watched) -> bool:
        """Starts what is due; whether the query runs or will."""
        if watched.query is None:
            if watched.again_at is None:
                return False
            if time.monotonic() >= watched.again_at:
                try:
                    watched.query, watched.again_at = watched.start(), None
                except Exception as failure:  # noqa: BLE001 - the others must go on
                    self._failed(watched, str(failure))
            return watched.query is not None or watched.again_at is not None
        if watched.query.isActive:
            return True
        failure = watched.query.exception()
        if failure is not None:
            if watched.query.recentProgress:
                watched.failures = 0
            self._failed(watched, str(failure))
        watched.query = None
        return watched.again_at is not None

    def _failed(self, watched: _Watched, error: str) -> None:
        watched.failures += 1
        if watched.failures > self.restarts:
            log.error("%s is given up: %s", watched.name, error)
            watched.error, watched.again_at = error, None
            return
        wait = min(self.longest, self.pause * 2 ** (watched.failures - 1))
        log.warning("%s failed and starts again in %.1f s: %s", watched.name, wait, error)
        watched.again_at = time.monotonic() + wait

    def _stop(self, watched: _Watched, grace: float = 600.0) -> None:
        """At a batch's border: none is active, or another one is due."""
        query = watched.query
        if query is None:
            return
        until, begun = time.monotonic() + grace, _batches(query)
        while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
            if _batches(query) > begun:
                break
            time.sleep(0.02)
        query.stop()
        watched.query = None


def _batches(query: StreamingQuery) -> int:
    """The last batch that is done."""
    progress = query.lastProgress
    return -1 if progress is None else progress["batchId"]


@contextmanager
def drained_by(supervisor: Supervisor, *signals: signal.Signals) -> Iterator[None]:
    """Within, the given signals (SIGTERM and Ctrl-C if none are named) drain."""
    wanted = signals or (signal.SIGTERM, signal.SIGINT)
    if threading.current_thread() is not threading.main_thread():
        wanted = ()  # only the main thread may say what a signal does
    before = {s: signal.signal(s, lambda *_: supervisor.drain()) for s in wanted}
    try:
        yield
    finally:
        for number, handler in before.items():
            signal.signal(number, handler)
