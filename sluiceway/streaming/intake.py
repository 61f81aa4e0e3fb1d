"""The intake: announced files to rows, exactly once per path, as a streaming query.

A fetch brings messages in; each announced file gets a verdict against the pending files and
the log, which decides what becomes of its message: an admitted file is pending, a message whose
file is pending already is put off, any other is deleted or kept for other consumers. Pending
files are admitted oldest first, a bounded number at a time, by logging them under the next batch
id, and only then are their messages deleted. The log is the stream: Spark's file source reads
its batches, one in each micro-batch, keeps in its checkpoint which it has read, and Spark's
readers read the files. So a message stays in the queue until its files are logged, a logged
batch is read until the checkpoint says so, and with a sink that is idempotent for a batch id
every file counts once.
"""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sluiceway.operators.pending import Pending, PendingFiles
from sluiceway.operators.validate import ADMIT, KEEP, OK, RETRY, action, with_verdicts
from sluiceway.sources.client import AnnouncedFile, QueueClient
from sluiceway.sources.filelog import Entry, FileLog
from sluiceway.sources.options import LogAddError, NoSchemaError, Options
from sluiceway.sources.queue import open_queue
from sluiceway.sources.reader import read_with
from sluiceway.streaming.metrics import Metrics, MetricsListener, timed

Sink = Callable[[DataFrame, int], None]
#: The log is compacted once in so many batches, up to the last KEPT_APART that were read.
COMPACTED_EVERY, KEPT_APART = 100, 10
#: Logged batches that may wait for the stream before the feeder logs another one.
AHEAD = 2


class Intake:
    """An intake over a queue, a schema and a checkpoint folder, of which it is the only writer.

    sink(rows, batch_id) gets each logged batch's rows; it must be idempotent for a batch id.
    """

    def __init__(self, spark: SparkSession, options: Options, schema: StructType | str, checkpoint: str, client: Any = None) -> None:
        if not schema:
            raise NoSchemaError("an intake needs a schema")
        self.spark, self.options, self.schema, self.checkpoint = spark, options, schema, checkpoint.rstrip("/")
        self.metrics, self.missing, self.batches = Metrics(), 0, 0
        self.verdicts: Counter = Counter()
        self.log = FileLog(spark, f"{self.checkpoint}/filelog")
        self.latest = self.read = self.log.latest_batch_id()  # of this run: what was logged before is read anyway
        self.pending = PendingFiles(options.max_file_age_ms)
        if self.latest >= 0:
            self.pending.floor_ms = self.log.floor()
        self._lock, self._arrived = threading.Lock(), []
        self._open: dict[str, set[str]] = {}  # receipt -> its pending files
        self._held: set[str] = set()  # receipts that must not be deleted
        self.client = QueueClient(open_queue(options, client), options, self._arrive, self.metrics)
        self.listener = MetricsListener(self.metrics)
        self._feeder: threading.Thread | None = None
        self._listening = False
        self._stopping = threading.Event()

    def __repr__(self) -> str:
        return f"Intake[{self.options.queue_url}]"

    def locate(self, path: str) -> str:
        """Where Spark reads an announced path; for subclasses whose buckets are elsewhere."""
        return path

    # From messages to pending files.

    def _arrive(self, file: AnnouncedFile) -> None:
        with self._lock:
            self._arrived.append(file)

    def fetch(self, timeout: float | None = None) -> int:
        """Fetches once and routes what came by its verdicts; how many files came."""
        self.client.fetch() if timeout is None else self.client.fetch_or_timeout(timeout)
        with self._lock:
            files, self._arrived = self._arrived, []
        if files:
            self._route(files, self.judge(files))
        return len(files)

    def judge(self, files: list[AnnouncedFile]) -> list[tuple[str, str]]:
        """Verdict and action for each file, in one job. Of one path among them, the first is judged; it makes the others pending."""
        rows = self.spark.createDataFrame([(i, f.path, f.event_ms) for i, f in enumerate(files)], "i int, path string, event_ms long")
        floor = self.pending.floor_ms
        known = self.log.times_of(rows, floor) if self.latest >= 0 else self.spark.createDataFrame([], "path string, event_ms long")
        judged = with_verdicts(rows, self.pending.to_df(self.spark), known, floor, self.options.glob)
        keep = self.options.keep_message_for_consumer_error
        out = {r.i: (r.verdict, r.action) for r in judged.withColumn("action", action(F.col("verdict"), keep)).select("i", "verdict", "action").collect()}
        return [out[i] for i in range(len(files))]

    def _route(self, files: list[AnnouncedFile], judged: list[tuple[str, str]]) -> None:
        settled: list[str] = []
        for file, (verdict, what) in zip(files, judged, strict=True):
            mine = Pending(file.event_ms, file.receipt)
            if what == ADMIT and self.pending.add_if_absent(file.path, mine) is not mine:
                what = RETRY  # another message was first
            self.verdicts[verdict if what != RETRY or verdict != OK else "LostRace"] += 1
            if what == ADMIT:
                self._open.setdefault(file.receipt, set()).add(file.path)
            elif what in (RETRY, KEEP):
                self._held.add(file.receipt)
            settled.append(file.receipt)
        for receipt in dict.fromkeys(settled):
            if receipt in self._held:  # comes again after its visibility timeout
                self.client.set_visibility(receipt)
                if receipt not in self._open:
                    self._held.discard(receipt)
            elif receipt not in self._open:
                self.client.handle_invalid(receipt)

    # From pending files to logged batches.

    def admit(self, pending: PendingFiles | None = None) -> int | None:
        """Logs the oldest pending files, at most maxFilesPerTrigger, under the next id, and deletes the messages that are done with; the id, or None without files."""
        pending = self.pending if pending is None else pending
        chosen = pending.unprocessed(self.options.max_files)
        if not chosen:
            pending.purge()
            return None
        floor = max(pending.floor_ms, pending.latest_ms - pending.max_age_ms)
        new_id = self.latest + 1
        if not self.log.add(new_id, [Entry(p, f.event_ms) for p, f in chosen], floor_ms=max(floor, self.pending.floor_ms), glob=self.options.glob):
            raise LogAddError(f"batch {new_id} was logged by another writer")
        self.latest = new_id
        done = []
        for path, file in chosen:
            pending.mark_processed(path)
            left = self._open.get(file.receipt)
            if left is not None:
                left.discard(path)
                if not left:
                    del self._open[file.receipt]
                    if file.receipt in self._held:
                        self._held.discard(file.receipt)
                    else:
                        done.append(file.receipt)
        if done:
            self.client.handle_processed(done)
        pending.purge()
        return new_id

    def feed(self, timeout: float | None = None) -> list[int]:
        """One fetch, then batches until nothing is pending; their ids."""
        self.fetch(timeout)
        return list(iter(self.admit, None))

    # From logged batches to rows.

    def logged(self) -> DataFrame:
        """The log's batches as a stream, one in a micro-batch. The source's own age limit never applies."""
        stream = self.spark.readStream.schema("path string, event_ms long").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).option("maxFileAge", "36500d").parquet(self.log.folder.at("batches"))
        # not as a partition column, of which the source knows nothing while there is no batch
        return stream.select(F.regexp_extract("_metadata.file_path", r"batch_id=(\d+)", 1).cast("long").alias("batch_id"), "path", "event_ms")

    def run_batch(self, rows: DataFrame, sink: Sink) -> None:
        """Reads the files of the logged batches in rows, each for itself."""
        found: dict[int, list] = {}
        for r in rows.select("batch_id", "path", "event_ms").collect():  # bounded by the files per trigger
            found.setdefault(r.batch_id, [])
            if r.path is not None:
                found[r.batch_id].append((r.event_ms, r.path))
        for batch_id in sorted(found):
            with timed(f"batch {batch_id}"):
                paths = [self.locate(p) for _, p in sorted(found[batch_id])]
                if paths:
                    data, gone = read_with(self.spark, self.options, paths, self.schema)
                    self.missing += gone
                    sink(data, batch_id)
                self.batches += 1
                self.read = max(self.read, batch_id)
                if batch_id >= self.latest:  # all is read, so what is old can go
                    self.log.clean_folders(self.pending.floor_ms)
                if batch_id % COMPACTED_EVERY == COMPACTED_EVERY - 1:
                    self.log.compact(batch_id - KEPT_APART)

    def start(self, sink: Sink, trigger: dict[str, Any] | None = None, name: str | None = None, feed_every: float | None = None) -> StreamingQuery:
        """Starts (or resumes) the query. trigger: as of DataStreamWriter.trigger; default: all that is logged, then stop.

        feed_every: seconds between fetches of a thread that feeds the log while the query runs.
        """
        if not self._listening:
            self.spark.streams.addListener(self.listener)
            self._listening = True
        writer = self.logged().writeStream.foreachBatch(lambda df, _: self.run_batch(df, sink)).option("checkpointLocation", f"{self.checkpoint}/stream").trigger(**(trigger or {"availableNow": True}))
        query = (writer.queryName(name) if name else writer).start()
        if feed_every is not None:
            self._stopping.clear()
            self._feeder = threading.Thread(target=self._feed_while, args=(query, feed_every), name="sluiceway-feed", daemon=True)
            self._feeder.start()
        return query

    def _feed_while(self, query: StreamingQuery, every: float) -> None:
        """Fetches and logs; a surplus stays pending while the stream is behind."""
        try:
            while query.isActive and not self._stopping.is_set():
                if self.latest - self.read < AHEAD:
                    self.fetch()
                while self.latest - self.read < AHEAD and self.admit() is not None:
                    pass
                self._stopping.wait(every)
        except Exception:
            query.stop()  # the query must not go on as if nothing came
            raise

    def process_available(self, sink: Sink) -> None:
        """Logs what is in the queue, as far as a fetch brings it in, then reads all that is logged."""
        self.feed()
        self.start(sink).awaitTermination()

    def close(self, query: StreamingQuery | None = None) -> None:
        """Stops the feeder, the query, the queue and the log, whatever fails on the way."""
        self._stopping.set()
        if self._feeder is not None:
            self._feeder.join()
        try:
            if query is not None:
                query.stop()
        finally:
            try:
                self.client.close()
            finally:
                self.log.close()
                if self._listening:
                    self.spark.streams.removeListener(self.listener)
                    self._listening = False


def dedupe_by_watermark(files: DataFrame, time_col: str, age: str) -> DataFrame:
    """Spark's own deduplication by path within a watermark: near to the log's, but keeps a path about twice as long."""
    return files.withWatermark(time_col, age).dropDuplicatesWithinWatermark(["path"])
