"""Counters of an intake, timings, and a listener that reports them with Spark's own."""

from __future__ import annotations

import json
import logging
import threading
import time
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger("sluiceway")

# The counters.
NAMES = ("received", "receive_failed", "parsed", "parse_failed", "discarded", "consumed", "consume_failed", "deleted", "delete_failed", "visibility_set", "visibility_failed", "fetched", "fetch_failed", "fetch_timed_out")


class Metrics:
    """Counters that several threads may raise."""

    def __init__(self) -> None:
        self._lock, self._counts = threading.Lock(), Counter({n: 0 for n in NAMES})

    def add(self, name: str, n: int = 1) -> None:
        if name not in NAMES:
            raise KeyError(name)
        with self._lock:
            self._counts[name] += n

    def __getitem__(self, name: str) -> int:
        return self._counts[name]

    def snapshot(self) -> dict[str, int]:
        with self._lock:
            return dict(self._counts)

    def json(self) -> str:
        return json.dumps(self.snapshot())


@contextmanager
def timed(what: str, report: Callable[[str, float], None] | None = None) -> Iterator[None]:
    """Logs (or reports) how many milliseconds the block took."""
    began = time.monotonic()
    try:
        yield
    finally:
        took = (time.monotonic() - began) * 1000
        (report or (lambda w, ms: log.info("%s took %.0f ms", w, ms)))(what, took)


class MetricsListener(StreamingQueryListener):
    """Keeps the progress of queries, with the counters of an intake and the state stores' own metrics."""

    def __init__(self, metrics: Metrics | None = None) -> None:
        self.metrics, self.progress, self.ended = metrics, [], []

    def onQueryStarted(self, event: Any) -> None:  # noqa: N802
        log.info("query %s started", event.id)

    def onQueryProgress(self, event: Any) -> None:  # noqa: N802
        p = json.loads(event.progress.json)
        stores = {str(i): dict(s.get("customMetrics", {})) for i, s in enumerate(p.get("stateOperators", ()))}
        self.progress.append({"batch": p["batchId"], "rows": p.get("numInputRows", 0), "ms": p.get("durationMs", {}), "stores": stores} | ({"intake": self.metrics.snapshot()} if self.metrics else {}))

    def onQueryIdle(self, event: Any) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event: Any) -> None:  # noqa: N802
        self.ended.append(str(event.id))
        if self.metrics:
            log.info("intake ended: %s", self.metrics.json())
