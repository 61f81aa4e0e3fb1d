"""Admission by keyed state: each path's time in Spark's RocksDB state store, for streams of announced files."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ADMITTED = "path string, event_ms long"


class AdmitOnce(StatefulProcessor):
    """Passes the first row of a path, and another one only when it is more than max_age_ms later than that."""

    def __init__(self, max_age_ms: int) -> None:
        self.max_age_ms = max_age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._admitted = handle.getValueState("admitted", "event_ms long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self._admitted.get()
        known, out = None if held is None else held[0], []
        for ms in sorted(ms for pdf in rows for ms in pdf["event_ms"].tolist()):
            if known is None or ms - known > self.max_age_ms:
                known = ms
                out.append(ms)
        if out:
            self._admitted.update((known,))
        yield pd.DataFrame({"path": [key[0]] * len(out), "event_ms": out}).astype({"path": object, "event_ms": "int64"})

    def close(self) -> None:
        """Nothing is held open."""


def admit_once(files: DataFrame, max_age_ms: int) -> DataFrame:
    """The rows of a stream of announced files (path, event_ms) that are new; needs the RocksDB state store (options.state_store_confs)."""
    return files.select("path", "event_ms").groupBy("path").transformWithStateInPandas(AdmitOnce(max_age_ms), outputStructType=ADMITTED, outputMode="Append", timeMode="None")
