import threading
import time

import pytest

from sluiceway.sources.client import CONSUMER_EXCEPTION, MOST_POLLS, OK, PARSE_NONE, RECEIVE_EMPTY, RECEIVE_EXCEPTION, QueueClient
from sluiceway.sources.options import DRY_RUN, IN_ACTION, NO_REPROCESS, Options, UnsupportedQueueTypeError, state_store_confs
from sluiceway.sources.queue import ClientQueue, DirectoryQueue, Message, client_settings, notification, open_queue
from sluiceway.streaming.metrics import NAMES, Metrics, timed

BASE = {"sluiceway.fileFormat": "csv", "sluiceway.queueUrl": "testurl", "sluiceway.queueRegion": "testregion"}


def options(**more):
    return Options.parse(BASE | {f"sluiceway.{k}": str(v) for k, v in more.items()})


FAST = {"queue.longPollingWaitTimeSeconds": 0, "queueFetchWaitTimeoutSeconds": 0, "queue.maxConcurrency": 1, "maxFilesPerTrigger": -1}
CREATED = notification("testbucket", "a.csv", "2023-02-14T22:53:31.748Z")
REMOVED = CREATED.replace("Created", "Removed")


class Scripted:
    """A queue that gives `batches` in turn, then nothing; an error in them is raised."""

    def __init__(self, batches=(), fail=(), fail_call=False):
        self.batches, self.fail, self.fail_call, self.deleted, self.seen = list(batches), set(fail), fail_call, [], []
        self.lock = threading.Lock()

    def receive(self, limit, wait, visibility):
        with self.lock:
            got = self.batches.pop(0) if self.batches else []
        if isinstance(got, Exception):
            raise got
        return got

    def delete(self, receipt):
        if receipt in self.fail:
            raise OSError(receipt)
        self.deleted.append(receipt)
        return True

    def delete_batch(self, receipts):
        if self.fail_call:
            raise OSError("call")
        self.deleted += [r for r in receipts if r not in self.fail]
        return [r not in self.fail for r in receipts]

    def set_visibility(self, receipt, seconds):
        self.seen.append((receipt, seconds))
        return receipt not in self.fail

    def close(self):
        self.closed = True


def messages(n, body=CREATED):
    return [Message(body, f"r{i}", f"m{i}") for i in range(n)]


def client(queue, consumer=lambda f: None, **more):
    return QueueClient(queue, options(**(FAST | more)), consumer, retry_wait=0)


def counts(c):
    return {n: k for n, k in c.metrics.snapshot().items() if k}


@pytest.mark.parametrize(
    ("batch", "outcome", "counters"),
    [
        (messages(1), OK, {"received": 1, "parsed": 1, "consumed": 1}),
        (messages(1, REMOVED), PARSE_NONE, {"received": 1, "discarded": 1, "deleted": 1}),
        (messages(1, '{"Records":"bad message"}'), PARSE_NONE, {"received": 1, "parse_failed": 1, "deleted": 1}),
        (OSError(), RECEIVE_EXCEPTION, {"receive_failed": 1}),
        ([], RECEIVE_EMPTY, {}),
    ],
)
def test_polls(batch, outcome, counters):
    c = client(Scripted([batch]))
    assert c.poll() == {outcome: 1} and counts(c) == counters
    c.close()


def test_consumer_errors_are_counted():
    def broken(_):
        raise ValueError

    c = client(Scripted([messages(1)]), broken)
    assert c.poll() == {CONSUMER_EXCEPTION: 1} and counts(c) == {"received": 1, "parsed": 1, "consume_failed": 1}
    c.close()


def test_fetch_reads_all_past_errors():
    got = []
    c = client(Scripted([messages(10), messages(10), OSError(), messages(1)]), got.append, queueFetchWaitTimeoutSeconds=1)
    assert c.fetch()[OK] == 21 and len(got) == 21 and got[0].event_ms == 1676415211748 and got[0].path == "s3://testbucket/a.csv"
    c.close()


def test_fetch_stops_at_the_limit():
    c = client(Scripted([messages(10)] * 5), maxFilesPerTrigger=15)
    assert c.fetch()[OK] == 20
    c.close()


def test_fetch_of_errors_ends():
    c = client(Scripted([OSError()] * 10_000))
    assert c.fetch()[RECEIVE_EXCEPTION] >= 1
    c.close()


def test_timeout_leaves_the_fetch_running():
    class Slow(Scripted):
        def receive(self, *a):
            time.sleep(0.3)
            return super().receive(*a)

    c = client(Slow([messages(3)]))
    assert c.fetch_or_timeout(0.05) is None and c.metrics["fetch_timed_out"] == 1
    assert c.fetch_or_timeout(5)[OK] == 3
    c.close()
    assert c.queue.closed


@pytest.mark.parametrize(("good", "bad"), [(0, 0), (21, 0), (0, 16), (21, 16), (20, 0), (0, 30), (20, 30)])
@pytest.mark.parametrize("call", [False, True])
def test_batch_deletes_retry_singly(good, bad, call):
    receipts = [f"g{i}" for i in range(good)] + [f"b{i}" for i in range(bad)]
    q = Scripted(fail={f"b{i}" for i in range(bad)}, fail_call=call)
    c = client(q)
    assert c.handle_processed(receipts) == (bad == 0)
    assert sorted(q.deleted) == sorted(f"g{i}" for i in range(good))
    assert counts(c) == {k: v for k, v in {"deleted": good, "delete_failed": bad}.items() if v}
    c.close()


def test_invalid_messages():
    q = Scripted(fail={"x"})
    c = client(q)
    assert c.handle_invalid("a") and not c.handle_invalid("x") and q.deleted == ["a"]
    k = client(q, **{"queue.keepMessageForConsumerError": "true", "queue.visibilityTimeoutSeconds": 7})
    assert k.handle_invalid("b") and not k.handle_invalid("x") and q.seen == [("b", 7), ("x", 7)]
    assert counts(k) == {"visibility_set": 1, "visibility_failed": 1}
    assert client(q, **{"queue.maxConcurrency": 999}).polls == MOST_POLLS


def test_directory_queue_delivers_at_least_once(tmp_path):
    q = DirectoryQueue(str(tmp_path))
    for i in range(12):
        q.send(str(i))
    first = q.receive(10, 0, 60)
    assert [m.body for m in first] == [str(i) for i in range(10)] and len(q.receive(10)) == 2 and q.receive() == []
    assert q.set_visibility(first[0].receipt, 0)
    again = q.receive()
    assert again[0].body == "0" and not q.delete(first[0].receipt) and q.delete(again[0].receipt)
    assert q.delete_batch([m.receipt for m in first]) == [False] + [True] * 9 and q.depth() == 2
    with pytest.raises(ValueError):
        q.delete_batch(["x"] * 11)


def test_client_queue():
    class Cloud:
        def receive_message(self, **a):
            self.asked = a
            return {"Messages": [{"Body": "b", "ReceiptHandle": "r", "MessageId": "m"}]}

        def delete_message(self, **a):
            self.gone = a["ReceiptHandle"]

        def delete_message_batch(self, **a):
            return {"Failed": [{"Id": "1"}]}

        def change_message_visibility(self, **a):
            self.visibility = a["VisibilityTimeout"]

    q = open_queue(options(queueType="client"), Cloud())
    assert isinstance(q, ClientQueue) and q.receive() == [Message("b", "r", "m")]
    assert q.delete("r") and q.delete_batch(["a", "b", "c"]) == [True, False, True] and q.set_visibility("r", 3)
    q.close()
    with pytest.raises(UnsupportedQueueTypeError):
        open_queue(options(queueType="pigeon"))
    assert client_settings(options())["retries"]["max_attempts"] == 10


def test_option_defaults_and_checks():
    o = options()
    assert (o.max_files, o.max_file_age_ms, o.fetch_wait_seconds, o.long_poll_seconds, o.max_concurrency, o.reprocess_state) == (100, 15 * 86_400_000, 20, 10, 50, NO_REPROCESS)
    assert options(maxFilesPerTrigger=50).max_files == 50 and options(maxFilesPerTrigger=-1).max_files is None
    assert options(reprocessStartBatchId=1).reprocess_state == options(reprocessEndBatchId=1).reprocess_state == NO_REPROCESS
    assert options(reprocessStartBatchId=1, reprocessEndBatchId=2).reprocess_state == DRY_RUN
    assert options(reprocessStartBatchId=1, reprocessEndBatchId=2, reprocessDryRun="false").reprocess_state == IN_ACTION
    assert options(**{"queue.longPollingWaitTimeSeconds": 0}).fetch_wait_seconds == 0
    assert Options.parse(BASE | {"header": "true", "basePath": "/b", "sluiceway.partitionColumns": "a, b"}).partition_columns == ("a", "b")
    bad = [{"reprocessStartBatchId": 3, "reprocessEndBatchId": 2}, {"maxFilesPerTrigger": "many"}, {"maxFilesPerTrigger": 0}, {"unknown": 1}, {"queue.longPollingWaitTimeSeconds": 21}, {"reprocessDryRun": "maybe"}, {"maxFileAge": "-1d"}, {"pathGlobFilter": "{a"}, {"partitionColumns": "a"}, {"queue.maxRetries": 0}]
    for more in bad:
        with pytest.raises(ValueError):
            options(**more)
    for name in BASE:
        with pytest.raises(ValueError, match="missing"):
            Options.parse({k: v for k, v in BASE.items() if k != name})


def test_state_store_settings():
    assert state_store_confs({"blockSizeKB": "4", "compactOnCommit": "True"})["spark.sql.streaming.stateStore.rocksdb.compactOnCommit"] == "true"
    for bad in ({"blockSizeKB": "-1"}, {"compactOnCommit": "1"}, {"x": "1"}):
        with pytest.raises(ValueError):
            state_store_confs(bad)


def test_metrics():
    m = Metrics()
    assert len(NAMES) == 14
    m.add("received", 3)
    assert m["received"] == 3 and '"received": 3' in m.json()
    with pytest.raises(KeyError):
        m.add("nonsense")
    took = []
    with timed("x", lambda w, ms: took.append((w, ms >= 0))):
        pass
    assert took == [("x", True)]
