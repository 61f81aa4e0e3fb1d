"""Message queues: the interface, an offline one in a directory, and an adapter for cloud clients."""

from __future__ import annotations

import json
import os
import threading
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path
from typing import Any, Protocol

from sluiceway.sources.options import Options, UnsupportedQueueTypeError

#: Fixed value: messages a queue gives or takes in one call.
PER_CALL = 10


@dataclass(frozen=True)
class Message:
    body: str
    receipt: str
    message_id: str


class MessageQueue(Protocol):
    def receive(self, limit: int, wait_seconds: float, visibility_seconds: int) -> list[Message]: ...

    def delete(self, receipt: str) -> bool: ...

    def delete_batch(self, receipts: Sequence[str]) -> list[bool]:
        """Whether each was deleted; raises if the call as a whole failed."""

    def set_visibility(self, receipt: str, seconds: int) -> bool: ...

    def close(self) -> None: ...


class DirectoryQueue:
    """A queue whose messages are files, with at-least-once delivery as in the cloud.

    A received message is hidden for its visibility timeout and then delivered again; a
    receipt is void once the message was received anew. Several threads may use it.
    """

    def __init__(self, path: str) -> None:
        self.path = Path(path)
        self.path.mkdir(parents=True, exist_ok=True)
        self._lock = threading.Lock()
        self._hidden: dict[str, tuple[float, str]] = {}  # file -> (until, receipt)

    def send(self, body: str) -> str:
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}.json"
        temporary = self.path / f".{name}"
        temporary.write_text(body)
        os.replace(temporary, self.path / name)
        return name

    def _visible(self, limit: int, visibility: int) -> list[Message]:
        out, now = [], time.monotonic()
        with self._lock:
            for p in sorted(self.path.glob("[0-9]*.json")):
                if self._hidden.get(p.name, (0.0, ""))[0] > now:
                    continue
                try:
                    body = p.read_text()
                except FileNotFoundError:
                    continue
                receipt = f"{p.name}/{uuid.uuid4().hex}"
                self._hidden[p.name] = (now + visibility, receipt)
                out.append(Message(body, receipt, p.name))
                if len(out) == limit:
                    break
        return out

    def receive(self, limit: int = PER_CALL, wait_seconds: float = 0, visibility_seconds: int = 60) -> list[Message]:
        until = time.monotonic() + wait_seconds
        while not (found := self._visible(min(limit, PER_CALL), visibility_seconds)) and time.monotonic() < until:
            time.sleep(0.02)
        return found

    def _held(self, receipt: str) -> str | None:
        name = receipt.partition("/")[0]
        return name if self._hidden.get(name, (0.0, ""))[1] == receipt else None

    def delete(self, receipt: str) -> bool:
        with self._lock:
            name = self._held(receipt)
            if name is None:
                return False
            (self.path / name).unlink(missing_ok=True)
            del self._hidden[name]
            return True

    def delete_batch(self, receipts: Sequence[str]) -> list[bool]:
        if len(receipts) > PER_CALL:
            raise ValueError(f"more than {PER_CALL} receipts in a call")
        return [self.delete(r) for r in receipts]

    def set_visibility(self, receipt: str, seconds: int) -> bool:
        with self._lock:
            name = self._held(receipt)
            if name is None:
                return False
            self._hidden[name] = (time.monotonic() + seconds, receipt)
            return True

    def depth(self) -> int:
        return sum(1 for _ in self.path.glob("[0-9]*.json"))

    def close(self) -> None:
        pass


class ClientQueue:
    """A queue behind a cloud client with receive_message, delete_message, delete_message_batch and change_message_visibility."""

    def __init__(self, client: Any, url: str) -> None:
        self.client, self.url = client, url

    def receive(self, limit: int = PER_CALL, wait_seconds: float = 0, visibility_seconds: int = 60) -> list[Message]:
        found = self.client.receive_message(QueueUrl=self.url, MaxNumberOfMessages=min(limit, PER_CALL), WaitTimeSeconds=int(wait_seconds), VisibilityTimeout=visibility_seconds)
        return [Message(m["Body"], m["ReceiptHandle"], m.get("MessageId", "")) for m in found.get("Messages", ())]

    def delete(self, receipt: str) -> bool:
        self.client.delete_message(QueueUrl=self.url, ReceiptHandle=receipt)
        return True

    def delete_batch(self, receipts: Sequence[str]) -> list[bool]:
        answer = self.client.delete_message_batch(QueueUrl=self.url, Entries=[{"Id": str(i), "ReceiptHandle": r} for i, r in enumerate(receipts)])
        failed = {f["Id"] for f in answer.get("Failed", ())}
        return [str(i) not in failed for i in range(len(receipts))]

    def set_visibility(self, receipt: str, seconds: int) -> bool:
        self.client.change_message_visibility(QueueUrl=self.url, ReceiptHandle=receipt, VisibilityTimeout=seconds)
        return True

    def close(self) -> None:
        close = getattr(self.client, "close", None)
        if close:
            close()


def open_queue(options: Options, client: Any = None) -> MessageQueue:
    """The queue that the options name. queueType `client` needs a cloud client, made with its own retries and region."""
    if options.queue_type == "directory":
        return DirectoryQueue(options.queue_url.removeprefix("file://"))
    if options.queue_type == "client" and client is not None:
        return ClientQueue(client, options.queue_url)
    raise UnsupportedQueueTypeError(f"no queue of type {options.queue_type!r}")


def client_settings(options: Options) -> dict[str, Any]:
    """What a cloud client is to be made with."""
    return {"region_name": options.queue_region, "max_pool_connections": options.max_concurrency, "retries": {"max_attempts": options.max_retries, "mode": "adaptive"}, "connect_timeout": 60}


def notification(bucket: str, key: str, event_time: str, event: str = "ObjectCreated:Put") -> str:
    """A body as a bucket would send it. key: URL-encoded."""
    return json.dumps({"Records": [{"eventName": event, "eventTime": event_time, "s3": {"bucket": {"name": bucket}, "object": {"key": key}}}]})
