"""The queue client: bounded parallel fetches, consumption and acknowledgement."""

from __future__ import annotations

import json
import re
import threading
import time
from collections import Counter
from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor, wait
from concurrent.futures import TimeoutError as FutureTimeout
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import unquote_plus

from sluiceway.functions.notifications import SCHEME, TIME_PATTERN
from sluiceway.sources.options import Options
from sluiceway.sources.queue import PER_CALL, Message, MessageQueue
from sluiceway.streaming.metrics import Metrics

# Outcomes of a poll, and the most polls at a time.
OK, PARSE_NONE, CONSUMER_EXCEPTION, RECEIVE_EMPTY, RECEIVE_EXCEPTION = "Ok", "ParseNone", "ConsumerException", "ReceiveEmpty", "ReceiveException"
MOST_POLLS = 200


@dataclass(frozen=True)
class AnnouncedFile:
    path: str
    event_ms: int
    receipt: str | None
    body: str = ""
    name: str = ""


def event_millis(text: str) -> int:
    """As functions.notifications.event_millis; ValueError where it isn't a time."""
    if not re.match(TIME_PATTERN, text):
        raise ValueError(f"not a time: {text!r}")
    whole, _, fraction = text[:-1].partition(".")
    seconds = int(datetime.strptime(whole, "%Y-%m-%dT%H:%M:%S").replace(tzinfo=timezone.utc).timestamp())
    return 1000 * seconds + int(fraction.ljust(3, "0")[:3])


def object_path(bucket: str, key: str) -> str:
    """As functions.notifications.object_path; ValueError where an escape is none."""
    path = f"{SCHEME}{bucket}/{key}"
    if not isinstance(bucket, str) or not isinstance(key, str) or re.search("%(?![0-9A-Fa-f]{2})", path):
        raise ValueError(f"not a path: {path!r}")
    return unquote_plus(path)


def parse_message(message: Message, first_record_only: bool = False) -> tuple[list[AnnouncedFile], int, int]:
    """Files that a message announces; how many other events it has; how many parts can't be read."""
    try:
        body = json.loads(message.body)
        if "Records" not in body and isinstance(body.get("Message"), str):
            body = json.loads(body["Message"])
        records = body["Records"]
        records = [r for r in records if r is not None][: 1 if first_record_only else None] if isinstance(records, list) else [None]
    except (ValueError, KeyError, TypeError, AttributeError):
        return [], 0, 1
    files, others, bad = [], 0, 0 if records else 1
    for r in records:
        try:
            if "ObjectCreated" not in r["eventName"]:
                others += 1
                continue
            files.append(AnnouncedFile(object_path(r["s3"]["bucket"]["name"], r["s3"]["object"]["key"]), event_millis(r["eventTime"]), message.receipt, message.body, message.message_id))
        except (ValueError, KeyError, TypeError):
            bad += 1
    return files, others, bad


class QueueClient:
    """Fetches messages and hands each announced file to `consumer`, which may raise."""

    def __init__(self, queue: MessageQueue, options: Options, consumer: Callable[[AnnouncedFile], None], metrics: Metrics | None = None, retry_wait: float = 0.1) -> None:
        self.queue, self.options, self.consumer, self.metrics, self.retry_wait = queue, options, consumer, metrics or Metrics(), retry_wait
        self.polls = min(options.max_concurrency, MOST_POLLS)
        self._pool = ThreadPoolExecutor(self.polls, "sluiceway-poll")
        self._fetcher = ThreadPoolExecutor(1, "sluiceway-fetch")
        self._fetching: Future | None = None
        self._closing = threading.Event()

    # Receiving.

    def poll(self) -> Counter:
        """One receive call and all that follows for its messages: outcomes and their numbers."""
        try:
            messages = self.queue.receive(PER_CALL, self.options.long_poll_seconds, self.options.visibility_seconds)
        except Exception:  # noqa: BLE001 a client may raise anything
            self.metrics.add("receive_failed")
            return Counter({RECEIVE_EXCEPTION: 1})
        if not messages:
            return Counter({RECEIVE_EMPTY: 1})
        self.metrics.add("received", len(messages))
        return sum((self._consume(m) for m in messages), Counter())

    def _consume(self, message: Message) -> Counter:
        files, others, bad = parse_message(message, self.options.first_record_only)
        for name, n in (("parsed", len(files)), ("discarded", others), ("parse_failed", bad)):
            self.metrics.add(name, n)
        if not files:
            self.delete(message.receipt)
            return Counter({PARSE_NONE: 1})
        try:
            for f in files:
                self.consumer(f)
        except Exception:  # noqa: BLE001 the consumer is the user's
            self.metrics.add("consume_failed")
            return Counter({CONSUMER_EXCEPTION: 1})
        self.metrics.add("consumed", len(files))
        return Counter({OK: 1})

    def fetch(self) -> Counter:
        """Rounds of parallel polls until enough messages came, or a round brought nothing and the wait is over.

        Rounds that only fail end with the wait too, so a broken queue doesn't hold the trigger.
        """
        began, total = time.monotonic(), Counter()
        limit = self.options.max_files
        try:
            while not self._closing.is_set():
                futures = [self._pool.submit(self.poll) for _ in range(self.polls)]
                wait(futures)
                found = sum((f.result() for f in futures), Counter())
                total += found
                over = time.monotonic() - began > self.options.fetch_wait_seconds
                idle = not found[OK] and not found[PARSE_NONE] and not found[CONSUMER_EXCEPTION]
                if idle and over or limit is not None and total[OK] >= limit:
                    break
                if found[RECEIVE_EXCEPTION] and idle:
                    time.sleep(self.retry_wait)
            self.metrics.add("fetched")
        except Exception:
            self.metrics.add("fetch_failed")
            raise
        return total

    def fetch_or_timeout(self, timeout: float) -> Counter | None:
        """Waits for a fetch; None on timeout, when it goes on behind the trigger."""
        if self._fetching is None or self._fetching.done():
            self._fetching = self._fetcher.submit(self.fetch)
        try:
            return self._fetching.result(timeout)
        except FutureTimeout:
            self.metrics.add("fetch_timed_out")
            return None

    # Acknowledging.

    def delete(self, receipt: str) -> bool:
        try:
            done = self.queue.delete(receipt)
        except Exception:  # noqa: BLE001
            done = False
        self.metrics.add("deleted" if done else "delete_failed")
        return done

    def delete_batch(self, receipts: Sequence[str]) -> bool:
        """Deletes in calls of PER_CALL; what a call fails on is tried singly. Whether all are deleted."""
        return all([self._delete_call(receipts[i : i + PER_CALL]) for i in range(0, len(receipts), PER_CALL)])

    def _delete_call(self, receipts: Sequence[str]) -> bool:
        try:
            done = self.queue.delete_batch(receipts)
        except Exception:  # noqa: BLE001
            done = [False] * len(receipts)
        self.metrics.add("deleted", sum(done))
        return all([self.delete(r) for r, ok in zip(receipts, done, strict=True) if not ok])

    def set_visibility(self, receipt: str) -> bool:
        try:
            done = self.queue.set_visibility(receipt, self.options.visibility_seconds)
        except Exception:  # noqa: BLE001
            done = False
        self.metrics.add("visibility_set" if done else "visibility_failed")
        return done

    def handle_invalid(self, receipt: str) -> bool:
        """A message whose file isn't admitted: kept for a while, or deleted."""
        return self.set_visibility(receipt) if self.options.keep_message_for_consumer_error else self.delete(receipt)

    def handle_processed(self, receipts: Sequence[str]) -> bool:
        return self.delete_batch(receipts)

    def close(self) -> None:
        """Ends the fetch, then the polls, then the queue."""
        self._closing.set()
        self._fetcher.shutdown(wait=True)
        self._pool.shutdown(wait=True)
        self.queue.close()
