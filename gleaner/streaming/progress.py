"""Progress of a run: a heartbeat of observed counters, and the progress of streaming queries."""

from __future__ import annotations

import sys
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener


class Heartbeat:
    """Prints the counters that were last observed, every ``interval_s`` and at each stage's ends.

    Nothing is estimated: what has not been observed is not shown.
    """

    def __init__(self, interval_s: float = 30.0, out: Callable[[str], None] | None = None) -> None:
        self.interval_s, self.out = interval_s, out or (lambda line: print(line, file=sys.stderr, flush=True))
        self.counters: dict[str, int] = {}
        self.stage, self.wait_until = "", None
        self._lock, self._stop = threading.Lock(), threading.Event()
        self._thread: threading.Thread | None = None

    def line(self) -> str:
        with self._lock:
            parts = [f"{k}={v}" for k, v in self.counters.items()]
            if {"records", "attempted"} <= self.counters.keys():
                parts.append(f"queue={max(0, self.counters['records'] - self.counters['attempted'])}")
            if self.wait_until is not None:
                parts.append(f"waiting {max(0, round(self.wait_until - time.time()))} s")
            return " ".join([self.stage or "idle", *parts])

    def update(self, **counters: int) -> None:
        with self._lock:
            self.counters |= counters

    def begin(self, stage: str) -> None:
        self.stage = stage
        self.out(self.line())

    def end(self) -> None:
        self.out(self.line())
        self.stage = ""

    def waiting(self, until: float | None) -> None:
        self.wait_until = until

    def start(self) -> Heartbeat:
        self._thread = threading.Thread(target=self._beat, daemon=True)
        self._thread.start()
        return self

    def stop(self) -> None:
        self._stop.set()
        if self._thread:
            self._thread.join()

    def _beat(self) -> None:
        while not self._stop.wait(self.interval_s):
            self.out(self.line())


class StreamProgress(StreamingQueryListener):
    """Feeds a heartbeat with the rows that streaming queries have taken."""

    def __init__(self, heartbeat: Heartbeat) -> None:
        self.heartbeat, self.rows = heartbeat, 0

    def onQueryStarted(self, event) -> None:
        self.heartbeat.begin(event.name or "stream")

    def onQueryProgress(self, event) -> None:
        self.rows += event.progress.numInputRows
        self.heartbeat.update(rows=self.rows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.heartbeat.end()


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a count of its rows that its next action brings along."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
