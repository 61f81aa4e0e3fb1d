"""Options of an intake, validated at once; unknown ones under our prefix are errors."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from sluiceway.functions.durations import duration_ms
from sluiceway.functions.globs import glob_to_regex

PREFIX = "sluiceway."

NO_REPROCESS, DRY_RUN, IN_ACTION = "NoReprocess", "DryRun", "InAction"

#: Spark's names for settings of the built-in state store, by our suffix.
STATE_STORE = "spark.sql.streaming.stateStore.rocksdb."
STATE_STORE_OPTIONS = {"compactOnCommit": bool, "blockSizeKB": int, "blockCacheSizeMB": int, "lockAcquireTimeoutMs": int, "resetStatsOnLoad": bool, "formatVersion": int}


class IntakeError(RuntimeError):
    """Base of the errors of an intake."""


class NoSchemaError(IntakeError):
    pass


class UnsupportedQueueTypeError(IntakeError):
    pass


class LogAddError(IntakeError):
    pass


class ReprocessError(IntakeError):
    pass


class ReprocessDryRun(ReprocessError):
    """Ends a dry run with what it would have read."""


class ReprocessLocked(ReprocessError):
    """Another reprocessing holds the lock."""


def _bool(text: str) -> bool:
    if str(text).strip().lower() not in ("true", "false"):
        raise ValueError(f"not true or false: {text!r}")
    return str(text).strip().lower() == "true"


def _int(text: str, low: int, high: int | None = None) -> int:
    n = int(str(text).strip())
    if n < low or high is not None and n > high:
        raise ValueError(f"{n} is not in {low} to {'any' if high is None else high}")
    return n


def _columns(text: str) -> tuple[str, ...]:
    return tuple(c.strip() for c in text.split(",") if c.strip())


def _limit(text: str) -> int | None:
    """-1 is unlimited; anything but that or a positive number is an error."""
    n = int(str(text).strip())
    if n == -1:
        return None
    return _int(text, 1)


def _glob(text: str) -> str:
    glob_to_regex(text)
    return text


# Option names, their defaults and ranges.
_READERS = {
    "fileFormat": str,
    "queueUrl": str,
    "queueRegion": str,
    "queueType": str,
    "maxFilesPerTrigger": _limit,
    "maxFileAge": duration_ms,
    "pathGlobFilter": _glob,
    "partitionColumns": _columns,
    "queueFetchWaitTimeoutSeconds": lambda t: _int(t, 0),
    "reprocessStartBatchId": lambda t: _int(t, 0),
    "reprocessEndBatchId": lambda t: _int(t, 0),
    "reprocessDryRun": _bool,
    "queue.longPollingWaitTimeSeconds": lambda t: _int(t, 0, 20),
    "queue.maxRetries": lambda t: _int(t, 1),
    "queue.maxConcurrency": lambda t: _int(t, 1),
    "queue.visibilityTimeoutSeconds": lambda t: _int(t, 1),
    "queue.keepMessageForConsumerError": _bool,
    "firstRecordOnly": _bool,
}
_REQUIRED = ("fileFormat", "queueUrl", "queueRegion")
_DEFAULTS = {"queueType": "directory", "maxFilesPerTrigger": "100", "maxFileAge": "15d", "reprocessDryRun": "true", "queue.longPollingWaitTimeSeconds": "10", "queue.maxRetries": "10", "queue.maxConcurrency": "50", "queue.visibilityTimeoutSeconds": "60", "queue.keepMessageForConsumerError": "false", "firstRecordOnly": "false"}


@dataclass(frozen=True)
class Options:
    file_format: str
    queue_url: str
    queue_region: str
    queue_type: str = "directory"
    max_files: int | None = 100
    max_file_age_ms: int = duration_ms("15d")
    glob: str | None = None
    partition_columns: tuple[str, ...] = ()
    base_path: str | None = None
    fetch_wait_seconds: int = 20
    reprocess_start: int | None = None
    reprocess_end: int | None = None
    reprocess_dry_run: bool = True
    long_poll_seconds: int = 10
    max_retries: int = 10
    max_concurrency: int = 50
    visibility_seconds: int = 60
    keep_message_for_consumer_error: bool = False
    first_record_only: bool = False
    #: What isn't ours goes to Spark's reader unchanged.
    reader: Mapping[str, str] = field(default_factory=dict)

    @property
    def reprocess_state(self) -> str:
        """Both ids ask for reprocessing; one alone is ignored."""
        if self.reprocess_start is None or self.reprocess_end is None:
            return NO_REPROCESS
        return DRY_RUN if self.reprocess_dry_run else IN_ACTION

    @classmethod
    def parse(cls, given: Mapping[str, str]) -> Options:
        own = {k[len(PREFIX) :]: v for k, v in given.items() if k.startswith(PREFIX)}
        unknown = sorted(set(own) - set(_READERS))
        if unknown:
            raise ValueError(f"unknown options: {', '.join(PREFIX + k for k in unknown)}")
        missing = [PREFIX + k for k in _REQUIRED if not own.get(k)]
        if missing:
            raise ValueError(f"missing options: {', '.join(missing)}")
        values = {}
        for name, text in (_DEFAULTS | own).items():
            try:
                values[name] = _READERS[name](text)
            except ValueError as e:
                raise ValueError(f"{PREFIX}{name}: {e}") from e
        if values["maxFileAge"] < 0:
            raise ValueError(f"{PREFIX}maxFileAge must not be negative")
        start, end = values.get("reprocessStartBatchId"), values.get("reprocessEndBatchId")
        if start is not None and end is not None and start > end:
            raise ValueError(f"{PREFIX}reprocessStartBatchId {start} is above reprocessEndBatchId {end}")
        base = given.get("basePath")
        if values.get("partitionColumns") and not base:
            raise ValueError("partitionColumns need a basePath; without one they would be read as null")
        poll = values["queue.longPollingWaitTimeSeconds"]
        return cls(
            values["fileFormat"], values["queueUrl"], values["queueRegion"], values["queueType"], values["maxFilesPerTrigger"], values["maxFileAge"], values.get("pathGlobFilter"), values.get("partitionColumns", ()), base,
            values.get("queueFetchWaitTimeoutSeconds", 2 * poll), start, end, values["reprocessDryRun"], poll, values["queue.maxRetries"], values["queue.maxConcurrency"], values["queue.visibilityTimeoutSeconds"],
            values["queue.keepMessageForConsumerError"], values["firstRecordOnly"], {k: v for k, v in given.items() if not k.startswith(PREFIX)},
        )


def state_store_confs(given: Mapping[str, str]) -> dict[str, str]:
    """Settings of Spark's state store provider from ours: same suffixes, checked."""
    out = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
    for name, text in given.items():
        if name == "versionsToRetain":
            out["spark.sql.streaming.minBatchesToRetain"] = str(_int(text, 1))
        elif name not in STATE_STORE_OPTIONS:
            raise ValueError(f"unknown state store option: {name}")
        else:
            out[STATE_STORE + name] = str(_bool(text)).lower() if STATE_STORE_OPTIONS[name] is bool else str(_int(text, 0))
    return out


@contextmanager
def settings(spark: SparkSession, confs: Mapping[str, str]) -> Iterator[None]:
    """The session has these settings inside of the block; a query keeps those that it was started with."""
    before = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
