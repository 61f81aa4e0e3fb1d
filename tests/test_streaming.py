import csv
import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluiceway.sources.datasource import IntakeDataSource
from sluiceway.sources.options import LogAddError, NoSchemaError, Options, ReprocessDryRun, ReprocessLocked, settings, state_store_confs
from sluiceway.sources.queue import DirectoryQueue, notification
from sluiceway.sources.reader import read_files
from sluiceway.streaming import intake, reprocess
from sluiceway.streaming.intake import Intake, dedupe_by_watermark
from sluiceway.streaming.stateful import admit_once

ROWS = [("amber", True, 310), ("birch", False, 620), ("cedar", False, 620)]
SCHEMA = "testString string, testBoolean boolean, testInt int"
PARTITIONED = [("north", True, 7, "p1", 1), ("south", False, 8, "p1", 1), ("east", False, 9, "p1", 2), ("west", True, 10, "p2", 1), ("up", False, 11, "p2", 1), ("down", True, 12, "p2", 3)]


class Bucket:
    """A local folder whose files are announced in a directory queue, and the rows that an intake made of them."""

    def __init__(self, spark, root: Path, **more):
        self.spark, self.root, self.more = spark, root, more
        self.queue, self.batches = DirectoryQueue(str(root / "queue")), {}

    def put(self, path: str, rows=ROWS, announce=True, at="2024-01-01T00:00:00.000Z"):
        target = self.root / "data" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        with target.open("w", newline="") as f:
            csv.writer(f).writerows([[str(c).lower() if isinstance(c, bool) else c for c in r] for r in rows])
        if announce:
            self.queue.send(notification("b", path.replace("=", "%3D"), at))

    def intake(self, schema=SCHEMA, **more):  # a new one, as after a restart
        given = {"sluiceway.fileFormat": "csv", "sluiceway.queueUrl": str(self.root / "queue"), "sluiceway.queueRegion": "local", "sluiceway.queue.longPollingWaitTimeSeconds": "0", "sluiceway.queue.maxConcurrency": "2", "sluiceway.maxFilesPerTrigger": "5"}
        options = Options.parse(given | self.more | more)

        class Local(Intake):
            def locate(this, path):
                return path.replace("s3://b", f"{self.root}/data", 1)

        return Local(self.spark, options, schema, f"{self.root}/checkpoint")

    def sink(self, rows, batch_id):
        self.batches[batch_id] = [tuple(r) for r in rows.collect()]

    def run(self, schema=SCHEMA, **more):
        i = self.intake(schema, **more)
        before = set(self.batches)
        try:
            i.process_available(self.sink)
        finally:
            i.close()
        return sorted(r for b in set(self.batches) - before for r in self.batches[b])


@pytest.fixture
def bucket(spark, tmp_path):
    return Bucket(spark, tmp_path)


def test_announced_files_are_read_once(bucket):
    bucket.put("a.csv")
    assert bucket.run() == ROWS
    bucket.put("a.csv")
    assert bucket.run() == []
    bucket.put("b.csv")
    assert bucket.run() == ROWS and bucket.queue.depth() == 0


def test_globs(bucket):
    for d in ("filter1", "filter2"):
        bucket.put(f"x/{d}/a.csv")
    assert bucket.run(**{"sluiceway.pathGlobFilter": "*/filter1/*.csv"}) == ROWS


def test_rate_limit(bucket):
    for i in range(12):
        bucket.put(f"{i}.csv", ROWS[:1])
    assert bucket.run() == ROWS[:1] * 12
    assert [len(v) for v in bucket.batches.values()] and max(len(v) for v in bucket.batches.values()) <= 5 and len(bucket.batches) >= 3


def test_partition_columns(bucket):
    for i, r in enumerate(PARTITIONED):
        bucket.put(f"testPart1={r[3]}/testPart2={r[4]}/{i}.csv", [r[:3]])
    how = {"sluiceway.partitionColumns": "testPart1,testPart2", "basePath": f"{bucket.root}/data", "sluiceway.maxFilesPerTrigger": "4"}
    got = []
    while bucket.queue.depth():
        got += bucket.run(f"{SCHEMA}, testPart1 string, testPart2 int", **how)
    assert sorted(got) == sorted(PARTITIONED)


def test_expired_files(bucket):
    bucket.put("new.csv", at="2024-02-01T00:00:00.000Z")
    assert bucket.run() == ROWS
    bucket.put("old.csv", at="2024-01-01T00:00:00.000Z")
    assert bucket.run() == []
    bucket.put("recent.csv", at="2024-01-25T00:00:00.000Z")
    assert bucket.run() == ROWS


def test_a_logged_batch_is_read_after_a_crash(bucket):
    bucket.put("a.csv")
    i = bucket.intake()
    assert i.feed() == [0] and bucket.queue.depth() == 0
    # the driver died after the batch was logged and before the stream read it
    i.client.close()
    assert bucket.run() == ROWS and list(bucket.batches) == [0]
    assert bucket.run() == []


def test_a_batch_whose_sink_failed_runs_again_with_its_id(bucket):
    bucket.put("a.csv")
    i, seen = bucket.intake(), []

    def failing(rows, batch_id):
        seen.append((batch_id, rows.count()))
        raise OSError("the sink is down")

    with pytest.raises(Exception, match="the sink is down"):
        i.process_available(failing)
    i.close()
    bucket.put("b.csv")
    assert bucket.run() == sorted(ROWS * 2) and seen == [(0, 3)] and sorted(bucket.batches) == [0, 1]


def test_messages_are_deleted_only_when_logged(bucket, monkeypatch):
    bucket.put("a.csv")
    i = bucket.intake()
    monkeypatch.setattr(i.log, "add", lambda *a, **k: False)
    with pytest.raises(LogAddError):
        i.feed()
    assert bucket.queue.depth() == 1
    i.close()
    bucket.queue = DirectoryQueue(str(bucket.root / "queue"))
    assert bucket.run() == ROWS and bucket.queue.depth() == 0


def test_surplus_is_carried_over(bucket):
    """Messages of many records make more files than a batch may have; the oldest are first."""
    for m in range(3):
        names = [f"{m}_{k}.csv" for k in range(4)]
        for n in names:
            bucket.put(n, ROWS[:1], announce=False)
        bodies = [json.loads(notification("b", n, f"2024-01-0{9 - m}T00:00:0{k}.000Z"))["Records"][0] for k, n in enumerate(names)]
        bucket.queue.send(json.dumps({"Records": bodies}))
    i = bucket.intake(**{"sluiceway.maxFilesPerTrigger": "5"})
    i.fetch()
    assert i.admit() == 0 and len(i.pending.unprocessed()) == 7
    assert bucket.queue.depth() == 2  # one message has all its files logged
    assert i.feed() == [1, 2] and bucket.queue.depth() == 0
    i.start(bucket.sink).awaitTermination()
    i.close()
    assert [len(bucket.batches[b]) for b in (0, 1, 2)] == [5, 5, 2]
    assert [r.path[-7] for r in i.log.get(0).orderBy("event_ms").collect()] == list("22221")


def test_pending_files_put_their_message_off(bucket):
    bucket.put("a.csv")
    bucket.put("a.csv", announce=True)
    i = bucket.intake()
    i.fetch()
    assert i.verdicts == {"Ok": 1, "LostRace": 1} and i.metrics["visibility_set"] == 1
    bucket.queue.send(notification("b", "a.csv", "2024-01-01T00:00:00.000Z"))
    i.fetch()
    assert i.verdicts["ExistInCacheNotProcessed"] == 1 and i.metrics["visibility_set"] == 2 and i.metrics["deleted"] == 0
    assert i.admit() == 0 and bucket.queue.depth() == 2
    bucket.queue.send(notification("b", "a.csv", "2024-01-01T00:00:00.000Z"))
    i.fetch()
    assert i.verdicts["PersistedInMetadataLog"] == 1 and bucket.queue.depth() == 2
    i.close()


@pytest.mark.parametrize("keep", ["true", "false"])
def test_invalid_files_keep_or_lose_their_message(bucket, keep):
    bucket.put("x/wanted.csv")
    bucket.put("x/other.txt")
    i = bucket.intake(**{"sluiceway.pathGlobFilter": "*.csv", "sluiceway.queue.keepMessageForConsumerError": keep})
    i.process_available(bucket.sink)
    assert i.verdicts == {"Ok": 1, "PatternNotMatch": 1} and bucket.queue.depth() == (keep == "true") and i.metrics["visibility_set"] == (keep == "true")
    i.close()


def test_odd_times_are_not_lost(bucket):
    for k, at in enumerate(("2024-01-03T00:00:00.123456Z", "2024-01-03T00:00:00Z", "2024-01-03T00:00:00.1Z")):
        bucket.put(f"{k}.csv", at=at)
    bucket.put("never.csv", at="yesterday")
    i = bucket.intake()
    i.process_available(bucket.sink)
    assert len(i.log.to_df().collect()) == 3 and i.metrics["parse_failed"] == 1
    assert sorted(r.event_ms % 1000 for r in i.log.to_df().collect()) == [0, 100, 123]
    i.close()


def test_a_running_intake_feeds_itself(bucket):
    i = bucket.intake()
    query = i.start(bucket.sink, {"processingTime": "200 milliseconds"}, feed_every=0.1)
    for n in range(6):
        bucket.put(f"{n}.csv")
        time.sleep(0.3)
    until = time.monotonic() + 60
    while sum(map(len, bucket.batches.values())) < 18 and time.monotonic() < until:
        time.sleep(0.2)
    i.close(query)
    assert sorted(r for b in bucket.batches.values() for r in b) == sorted(ROWS * 6) and bucket.queue.depth() == 0
    assert i.listener.progress


def test_old_batches_are_cleaned_and_compacted(bucket, monkeypatch):
    monkeypatch.setattr(intake, "COMPACTED_EVERY", 4)
    monkeypatch.setattr(intake, "KEPT_APART", 1)
    i = bucket.intake(**{"sluiceway.maxFilesPerTrigger": "1"})
    for n in range(9):
        bucket.put(f"{n}.csv", ROWS[:1])
        i.process_available(bucket.sink)
    assert i.log.batch_ids() == [7, 8] and i.log.range().count() == 9 and sum(map(len, bucket.batches.values())) == 9
    bucket.put("3.csv")
    i.process_available(bucket.sink)
    assert i.verdicts["PersistedInMetadataLog"] == 1
    i.close()


def test_an_intake_that_never_ran_closes(bucket, monkeypatch):
    i = bucket.intake()
    monkeypatch.setattr(i.spark.streams.__class__, "removeListener", lambda *_: pytest.fail("it has no listener"))
    i.close()


def test_missing_files_are_counted(bucket):
    bucket.put("a.csv")
    bucket.put("gone.csv")
    (bucket.root / "data/gone.csv").unlink()
    i = bucket.intake()
    i.process_available(bucket.sink)
    assert bucket.batches[0] == ROWS and i.missing == 1 and i.metrics["consumed"] == 2
    i.close()
    assert repr(i).startswith("Intake[")


def test_no_schema(bucket, spark):
    with pytest.raises(NoSchemaError):
        bucket.intake(schema=None)
    with pytest.raises(NoSchemaError):
        read_files(spark, [], None, "csv")


def test_reprocessing(bucket):
    for n in range(7):
        bucket.put(f"{n}.csv")
    bucket.run()
    logged = len(bucket.batches)
    i = bucket.intake()
    files, said = reprocess.dry_run(i, 0, logged - 1)
    assert said == f"{logged} batches, 7 files." and files.count() == 7
    before = dict(bucket.batches)
    bucket.put("queued.csv")
    issued = reprocess.run(i, 0, logged - 1, bucket.sink)
    assert issued == list(range(logged, logged + len(issued))) and bucket.queue.depth() == 1
    assert sorted(r for b in issued for r in bucket.batches[b]) == sorted(ROWS * 7) and before.items() <= bucket.batches.items()
    with pytest.raises(ReprocessLocked):
        reprocess.run(i, 0, 0, bucket.sink)
    assert reprocess.release_lock(i)
    i.close()
    dry = bucket.intake(**{"sluiceway.reprocessStartBatchId": "0", "sluiceway.reprocessEndBatchId": "0"})
    with pytest.raises(ReprocessDryRun, match="1 batches"):
        reprocess.by_options(dry, bucket.sink)
    dry.close()
    assert reprocess.by_options(bucket.intake(), bucket.sink) == []


def test_normal_runs_go_on_after_a_reprocessing(bucket):
    for n in range(3):
        bucket.put(f"{n}.csv")
    bucket.run()
    i = bucket.intake(**{"sluiceway.reprocessStartBatchId": "0", "sluiceway.reprocessEndBatchId": "0", "sluiceway.reprocessDryRun": "false"})
    assert reprocess.by_options(i, bucket.sink) == [1]
    i.close()
    bucket.put("new.csv", ROWS[:1])
    bucket.put("1.csv")
    assert bucket.run() == ROWS[:1] and sorted(bucket.batches) == [0, 1, 2] and bucket.queue.depth() == 0


@pytest.mark.parametrize("form", ["csv", "json", "parquet", "orc"])
def test_formats(spark, tmp_path, form):
    spark.createDataFrame(ROWS, SCHEMA).coalesce(2).write.format(form).save(f"{tmp_path}/x")
    df, gone = read_files(spark, [f"{tmp_path}/x", f"{tmp_path}/gone"], SCHEMA, form)
    assert sorted(map(tuple, df.collect())) == ROWS and gone == 1


def test_headers_and_filters(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.csv(f"{tmp_path}/x", header=True, sep="|")
    df = read_files(spark, [f"{tmp_path}/x"], SCHEMA, "csv", {"header": "true", "sep": "|"})[0]
    assert sorted(map(tuple, df.select("testString", "testInt").where("testInt = 620").collect())) == [("birch", 620), ("cedar", 620)]


def test_mismatches(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).select("testString").write.csv(f"{tmp_path}/c")
    assert [r[0] for r in read_files(spark, [f"{tmp_path}/c"], "testInt int", "csv")[0].collect()] == [None] * 3
    assert read_files(spark, [f"{tmp_path}/c"], "testInt int", "csv", {"mode": "DROPMALFORMED"})[0].collect() == []
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{tmp_path}/p")
    got = read_files(spark, [f"{tmp_path}/p"], "newtestInt int, testString string", "parquet")[0].collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == [(None, r[0]) for r in ROWS]


def test_paths_with_glob_characters(spark, tmp_path):
    target = tmp_path / "a[1]{x}.csv"
    target.write_text("amber,true,310\n")
    assert list(map(tuple, read_files(spark, [str(target)], SCHEMA, "csv")[0].collect())) == [ROWS[0]]
    assert read_files(spark, [], SCHEMA, "csv")[0].collect() == []


def test_data_source(spark, tmp_path):
    spark.dataSource.register(IntakeDataSource)
    queue = DirectoryQueue(str(tmp_path / "queue"))
    for name, form in (("a", "csv"), ("b", "csv")):
        p = tmp_path / "data" / f"{name}.{form}"
        p.parent.mkdir(exist_ok=True)
        p.write_text("".join(f"{a},{str(b).lower()},{c}\n" for a, b, c in ROWS))
        for _ in range(2):
            queue.send(notification(str(p)[1:].split("/")[0], "/".join(str(p)[1:].split("/")[1:]), "2024-01-01T00:00:00.000Z"))
    stream = spark.readStream.format("file-intake").schema(SCHEMA).option("queue", str(tmp_path / "queue")).option("log", str(tmp_path / "log")).option("format", "csv").option("local", "true").load()
    counted = stream.groupBy("testInt").count()
    query = counted.writeStream.outputMode("complete").format("memory").queryName("counted").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(map(tuple, spark.table("counted").collect())) == [(310, 2), (620, 4)]
    assert queue.depth() == 0 and len(json.loads((tmp_path / "log/0.json").read_text().splitlines()[0])) == 2


def test_watermark_variant(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "path string, s long").withColumn("t", F.timestamp_seconds("s")).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("path string, s long, t timestamp").parquet(f"{tmp_path}/in")
    dedupe_by_watermark(stream, "t", "1 day").writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.path for r in spark.table("once").collect()) == ["a", "b"]


def test_data_source_has_globs_and_partition_columns(spark, tmp_path):
    spark.dataSource.register(IntakeDataSource)
    queue = DirectoryQueue(str(tmp_path / "queue"))
    for part, name in ((1, "a.csv"), (2, "b.csv"), (2, "c.txt")):
        p = tmp_path / f"data/part={part}/{name}"
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("x,1\n")
        queue.send(notification(str(p)[1:].split("/")[0], "/".join(str(p)[1:].split("/")[1:]).replace("=", "%3D"), "2024-01-01T00:00:00.000Z"))
    stream = spark.readStream.format("file-intake").schema("s string, n int, part int").option("queue", str(tmp_path / "queue")).option("log", str(tmp_path / "log")).option("format", "csv").option("local", "true").option("pathGlobFilter", "*.csv").load()
    stream.writeStream.format("memory").queryName("parted").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.table("parted").collect())) == [("x", 1, 1), ("x", 1, 2)]


def test_files_are_admitted_once_by_keyed_state(spark, tmp_path):
    """In RocksDB: a path counts as new again when its state has expired."""
    for k, rows in enumerate(([("a", 1000), ("b", 1000), ("a", 1500)], [("a", 2000), ("c", 100_000)], [("a", 200_000), ("c", 100_500)])):
        spark.createDataFrame(rows, "path string, event_ms long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.05)
    stream = spark.readStream.schema("path string, event_ms long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    with settings(spark, state_store_confs({"compactOnCommit": "false"})):
        admit_once(stream, max_age_ms=60_000).writeStream.format("parquet").option("path", f"{tmp_path}/out").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == [("a", 1000), ("a", 200_000), ("b", 1000), ("c", 100_000)]
