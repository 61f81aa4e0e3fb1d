"""The registered queries of the intake engine and their SQL equivalents.

The events table stands for a stream of notifications: see `notifications`.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.globs import matches_glob
from sluiceway.functions.notifications import created_files, notification_body, parse
from sluiceway.operators import admission, validate
from sluiceway.sources.filelog import Entry, FileLog
from sluiceway.sources.files import scratch
from sluiceway.sources.options import Options, settings, state_store_confs
from sluiceway.sources.queue import DirectoryQueue, notification
from sluiceway.sources.reader import read_files
from sluiceway.streaming import reprocess
from sluiceway.streaming.intake import Intake
from sluiceway.streaming.stateful import admit_once

BUCKET = "bucket"
DAY_MS = 86_400_000
BATCH = 100
GLOB = "*/user_id=1*/*"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def millis(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp without a zone."""
    return F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts) / 1000).cast("long")


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, event_name, obj_key, event_ms, trigger_id and ts of every event."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.when(F.col("event_type") == "error", "ObjectRemoved:Delete").otherwise("ObjectCreated:Put").alias("event_name"),
        F.concat("event_type", F.lit("/user_id="), F.col("user_id").cast("string"), F.lit("/f"), (F.col("event_id") % 5).cast("string"), F.lit(".csv")).alias("obj_key"),
        millis(F.col("ts")).alias("event_ms"),
        F.floor(F.col("event_id") / 500).cast("long").alias("trigger_id"),
        "ts",
    )


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = notifications(spark, sf_dir)
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return n.select("event_id", notification_body(F.lit(BUCKET), F.col("obj_key"), F.col("event_name"), at).alias("body"))


def created(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = notifications(spark, sf_dir).filter(F.contains("event_name", F.lit("ObjectCreated")))
    return n.select("event_id", F.col("obj_key").alias("path"), "event_ms", "trigger_id")


def first_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.first_by_path(created(spark, sf_dir), "event_ms", "event_id")


def logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log that these notifications leave: batch_id, path, event_ms."""
    return admission.into_batches(first_files(spark, sf_dir), BATCH, "event_ms", "event_id").select("batch_id", "path", "event_ms")


def logged_by_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log that the triggers leave, each admitting what no earlier one did: path, event_ms, trigger_id."""
    return admission.first_by_path(created(spark, sf_dir), "trigger_id", "event_ms", "event_id").select("path", "event_ms", "trigger_id")


# Notifications and verdicts.


def parse_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return created_files(bodies(spark, sf_dir)).select("event_id", "path", "event_ms")


def discard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(bodies(spark, sf_dir)).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def glob_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return created(spark, sf_dir).filter(matches_glob(F.col("path"), GLOB)).select("event_id", "path")


def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_files(spark, sf_dir).select("path", "event_ms", "event_id")


def expiry_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events judged by the floor of earlier triggers, which are shuffled here so that some come late."""
    n = notifications(spark, sf_dir).withColumn("trigger_id", F.col("event_id") % 20)
    floors = admission.floors_by_trigger(n, DAY_MS)
    return n.join(floors, "trigger_id").select("event_id", F.coalesce(F.col("event_ms") < F.col("floor_ms"), F.lit(False)).alias("expired"))


def verdict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files, each against the files of the trigger before, the log of all earlier triggers and the floor after them.

    As in `logged`, a path is logged once, when it is first announced.
    """
    files = created(spark, sf_dir)
    floors = admission.floors_by_trigger(files, DAY_MS).select("trigger_id", F.coalesce("floor_ms", F.lit(0)).alias("floor_ms"))
    first = files.groupBy("trigger_id", "path").agg(F.min(F.struct("event_ms", "event_id")).alias("row"))
    pending = first.select((F.col("trigger_id") + 1).alias("trigger_id"), "path", (F.col("row.event_id") % 2 == 0).alias("processed"))
    judged = validate.with_verdicts(files.join(floors, "trigger_id"), pending, logged_by_trigger(spark, sf_dir), F.col("floor_ms"), GLOB, by="trigger_id")
    return judged.withColumn("action", validate.action(F.col("verdict"))).groupBy("verdict", "action").agg(F.count(F.lit(1)).alias("n"))


# Admission.


def batch_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.into_batches(first_files(spark, sf_dir), BATCH, "event_ms", "event_id").select("batch_id", "path", "event_ms", "event_id")


def oldest_first_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.oldest_first(logged(spark, sf_dir), 25)


def unprocessed_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = logged(spark, sf_dir).withColumn("processed", F.col("batch_id") % 2 == 0)
    return admission.unprocessed(pending).select("path", "event_ms")


def delete_subbatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups of every batch."""
    return admission.acknowledgement_groups(logged(spark, sf_dir), "batch_id").select("batch_id", "path", "group")


# The log.

#: Batches that are added singly to a written log, after the others.
SINGLY = 3


def _written(spark: SparkSession, sf_dir: str, least: int = 1, root: str | None = None) -> FileLog:
    """The whole log on disk: all batches (`least` of them at least, if need be empty ones), the last ones added singly."""
    log = FileLog(spark, root or scratch(spark))
    files = logged(spark, sf_dir).persist()
    last = files.agg(F.max("batch_id")).first()[0]
    batches = max(least, 0 if last is None else last + 1)
    filled = max(batches - SINGLY, 0)
    if filled:
        log.fill(files, filled - 1, commit_ms=0)
    for i in range(filled, batches):
        log.add(i, files.filter(F.col("batch_id") == i), commit_ms=i)
    files.unpersist()
    return log


def log_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of the whole log on disk, of which all but the last two batches are compacted."""
    log = _written(spark, sf_dir, 7)
    log.compact(log.latest_batch_id() - 2)
    return log.range(3, 5).select("batch_id", "path", "event_ms")


def log_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir).range().select("batch_id", "path", "event_ms")


def log_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir).latest()[1].select("batch_id", "path", "event_ms")


def log_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logged times of the files of the last trigger, which a fetch would ask for."""
    files = created(spark, sf_dir)
    last = files.filter(F.col("trigger_id") == files.agg(F.max("trigger_id")).first()[0])
    return _written(spark, sf_dir).times_of(last)


def log_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one cleaning of the whole log removes: 20 batches at most."""
    log = _written(spark, sf_dir)
    latest = log.to_df().agg(F.max("event_ms")).first()[0] or 0
    return spark.createDataFrame([(i,) for i in log.clean(latest - 20 * DAY_MS)], "batch_id long")  # at most 20


def log_race(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch is added by four writers at once, each with paths of its own: one of them succeeds."""
    root = scratch(spark)
    batches = logged(spark, sf_dir).groupBy("batch_id").agg(F.collect_list(F.struct("path", "event_ms")))  # batches are bounded
    logs = [FileLog(spark, root) for _ in range(4)]
    won = []
    with ThreadPoolExecutor(4) as pool:
        for i, files in batches.toLocalIterator():  # one partition of them at a time
            add = lambda w, i=i, files=files: logs[w].add(i, [Entry(f"{w}/{path}", ms) for path, ms in files], commit_ms=0)
            won.append(sum(pool.map(add, range(4))))
    if any(n != 1 for n in won):
        raise AssertionError(f"writers that succeeded, by batch: {won}")
    return logs[0].to_df().groupBy("batch_id").agg(F.count(F.lit(1)).alias("files"), F.countDistinct(F.substring("path", 1, 1)).alias("writers"))


def is_new_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trigger's files against all that earlier triggers logged."""
    files = created(spark, sf_dir).select("trigger_id", "path").distinct()
    return validate.is_new_file(files, logged_by_trigger(spark, sf_dir), by="trigger_id")


def reprocess_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark)
    _written(spark, sf_dir, 10, f"{root}/checkpoint/filelog")
    run = Intake(spark, _options(root), "x int", f"{root}/checkpoint")
    files = reprocess.dry_run(run, 2, 9)[0]
    run.close()
    return files.agg(F.countDistinct("batch_id").alias("batches"), F.count(F.lit(1)).alias("files"))


# Sources and streams.


def partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark)
    n = table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("user_id") % 7).cast("int").alias("bucket_no"))
    n.repartition(4, "event_type", "bucket_no").write.partitionBy("event_type", "bucket_no").csv(root)
    return spark.read.schema("event_id long, event_type string, bucket_no int").option("basePath", root).csv(f"{root}/event_type=*/bucket_no=*")


def _round_trip(file_format: str, name: str, **options: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch(spark)
        df = table(spark, sf_dir, name)
        df.write.format(file_format).options(**options).save(root)
        return read_files(spark, [root], df.schema, file_format, options)[0]

    query.__name__ = f"{file_format}_roundtrip"
    return query


csv_roundtrip = _round_trip("csv", "customer", header="true", sep="|")
json_roundtrip = _round_trip("json", "customer")
parquet_roundtrip = _round_trip("parquet", "customer")
orc_roundtrip = _round_trip("orc", "customer")


def csv_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark)
    table(spark, sf_dir, "nation").select("n_name", "n_nationkey").write.csv(root)
    return read_files(spark, [root], "n_name int, n_nationkey int", "csv")[0]


def csv_drop_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark)
    n = table(spark, sf_dir, "nation")
    n.select(F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(F.col("n_nationkey").cast("string")).alias("a"), "n_nationkey").write.csv(root)
    return read_files(spark, [root], "a int, n_nationkey int", "csv", {"mode": "DROPMALFORMED"})[0].select("a", "n_nationkey")


def parquet_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark)
    table(spark, sf_dir, "nation").select("n_name", "n_nationkey").write.parquet(root)
    return read_files(spark, [root], "unknown int, n_name string", "parquet")[0]


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")


def _run_stream(stream: DataFrame) -> DataFrame:
    out = scratch(stream.sparkSession)
    stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{out}/rows")


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_stream(_events_stream(spark, sf_dir).select("event_id", "event_type", "value"))


def select_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_stream(_events_stream(spark, sf_dir).select("event_id", "event_type").where("event_type = 'error'"))


def _stateful(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """(result, checkpoint) of a streaming aggregation over three micro-batches, its state in RocksDB."""
    root, keys = scratch(spark), ("event_type", "user_id")
    events = table(spark, sf_dir, "events").select("event_id", *keys)
    for i in range(3):  # a file each, the oldest is read first
        events.filter(F.pmod("event_id", F.lit(3)) == i).coalesce(1).write.mode("append").parquet(f"{root}/in")
        time.sleep(0.01)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    first = stream.groupBy(*keys).agg(F.min("event_id").alias("event_id"))
    with settings(spark, state_store_confs({"compactOnCommit": "false", "blockSizeKB": "4", "blockCacheSizeMB": "8", "versionsToRetain": "10"})):
        first.writeStream.outputMode("complete").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{root}/out")).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return f"{root}/out", f"{root}/checkpoint"


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = _stateful(spark, sf_dir)
    return spark.read.schema("event_type string, user_id long, event_id long").parquet(out)


def _state(spark: SparkSession, checkpoint: str, batch_id: int) -> DataFrame:
    with settings(spark, state_store_confs({})):
        found = spark.read.format("statestore").option("batchId", batch_id).load(checkpoint)
        return found.select("key.event_type", "key.user_id", F.col("value.min").alias("event_id"))


def state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All keys of the state store's last version."""
    return _state(spark, _stateful(spark, sf_dir)[1], 2)


def state_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version that the first micro-batch left."""
    return _state(spark, _stateful(spark, sf_dir)[1], 0)


def admit_once_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Announced files that pass the keyed state of streaming.stateful, in three micro-batches."""
    root, files = scratch(spark), created(spark, sf_dir)
    for i in range(3):
        files.filter(F.pmod("event_id", F.lit(3)) == i).select("path", "event_ms").coalesce(1).write.mode("append").parquet(f"{root}/in")
        time.sleep(0.01)
    stream = spark.readStream.schema("path string, event_ms long").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    with settings(spark, state_store_confs({})):
        return _run_stream(admit_once(stream, 1 << 50))


INTAKE_FILES = 6
_SCHEMA = "o_orderkey long, o_custkey long, o_orderstatus string, part int"


def _options(root: str, **more: str) -> Options:
    own = {"fileFormat": "csv", "queueUrl": f"{root}/queue", "queueRegion": "local", "maxFilesPerTrigger": "5", "queue.longPollingWaitTimeSeconds": "0", "queue.maxConcurrency": "2", "partitionColumns": "part"}
    return Options.parse({f"sluiceway.{k}": v for k, v in (own | more).items()} | {"basePath": f"{root}/data"})


class _Bucket:
    """Files of orders, one for each value of part, in a local folder that stands for a bucket `data`, with a queue."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        root = scratch(spark).removeprefix("file:")
        while root.startswith("//"):
            root = root[1:]
        self.spark, self.root, self.outputs = spark, root, 0
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.pmod("o_orderkey", F.lit(INTAKE_FILES)).cast("int").alias("part"))
        orders.repartition(INTAKE_FILES, "part").write.partitionBy("part").csv(f"{root}/data")
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/data").select("path").collect()
        self.keys = {int(key.partition("=")[2].partition("/")[0]): key for key in sorted(r.path.partition("/data/")[2] for r in found)}
        self.queue = DirectoryQueue(f"{root}/queue")

    def body(self, part: int, day: int = 0) -> str:
        at = (datetime(2024, 1, 1) + timedelta(days=day)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
        return notification("data", self.keys[part].replace("=", "%3D"), at)

    def open(self, **more: str) -> Intake:
        run = _LocalIntake(self.spark, _options(self.root, **more), _SCHEMA, f"{self.root}/checkpoint")
        run.folder = f"{self.root}/data"
        return run

    def sink(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/out/batch={batch_id}")

    def rows(self) -> DataFrame:
        """All rows that the sink got, with their batch."""
        return self.spark.read.schema(f"{_SCHEMA}, batch long").option("basePath", f"{self.root}/out").parquet(f"{self.root}/out/batch=*")


class _LocalIntake(Intake):
    folder = ""

    def locate(self, path: str) -> str:
        return path.replace("s3://data", self.folder, 1)


def intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of orders, announced twice in a queue, through verdicts, pending files, log and native reads."""
    bucket = _Bucket(spark, sf_dir)
    for _ in range(2):
        for part in bucket.keys:
            bucket.queue.send(bucket.body(part, part))
    run = bucket.open()
    try:
        run.process_available(bucket.sink)
    finally:
        run.close()
    return bucket.rows().drop("batch")


def intake_surplus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two messages with three files each, the newest first: batches of two files, the oldest first."""
    bucket = _Bucket(spark, sf_dir)
    for parts in ((5, 3, 1), (4, 2, 0)):
        bucket.queue.send(json.dumps({"Records": [json.loads(bucket.body(p, p))["Records"][0] for p in parts if p in bucket.keys]}))
    run = bucket.open(maxFilesPerTrigger="2")
    try:
        run.process_available(bucket.sink)
    finally:
        run.close()
    return bucket.rows().select("o_orderkey", "batch")


def intake_keep_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that the glob leaves out are not read, and their messages stay in the queue."""
    bucket = _Bucket(spark, sf_dir)
    for part in bucket.keys:
        bucket.queue.send(bucket.body(part))
    run = bucket.open(**{"pathGlobFilter": "*/part=[0-2]/*", "queue.keepMessageForConsumerError": "true"})
    try:
        run.process_available(bucket.sink)
    finally:
        run.close()
    return bucket.rows().select("o_orderkey", F.lit(bucket.queue.depth()).cast("long").alias("kept"))


def intake_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest files are read first; of those announced later, by a new run, the old ones have expired."""
    bucket = _Bucket(spark, sf_dir)
    for parts in ((5, 4), (3, 2, 1, 0)):
        for part in parts:
            if part in bucket.keys:
                bucket.queue.send(bucket.body(part, 10 * part))
        run = bucket.open(maxFileAge="25d")
        try:
            run.process_available(bucket.sink)
        finally:
            run.close()
    return bucket.rows().drop("batch")


def reprocess_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch is read again under a new id, and a file that is announced after that is read under the next one."""
    bucket = _Bucket(spark, sf_dir)
    for again, parts in ((False, range(INTAKE_FILES - 1)), (True, ()), (False, (INTAKE_FILES - 1,))):
        for part in parts:
            if part in bucket.keys:
                bucket.queue.send(bucket.body(part))
        run = bucket.open()
        try:
            if again:
                reprocess.run(run, 0, 0, bucket.sink)
            else:
                run.process_available(bucket.sink)
        finally:
            run.close()
    return bucket.rows().select("o_orderkey", "batch")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake(spark, sf_dir)


_N = """n AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'ObjectRemoved:Delete' ELSE 'ObjectCreated:Put' END AS event_name,
  event_type || '/user_id=' || user_id || '/f' || (event_id % 5) || '.csv' AS path, epoch_us(ts) // 1000 AS event_ms, event_id // 500 AS trigger_id FROM events),
c AS (SELECT * FROM n WHERE contains(event_name, 'ObjectCreated')),
f AS (SELECT path, event_ms, event_id FROM c QUALIFY row_number() OVER (PARTITION BY path ORDER BY event_ms, event_id) = 1),
l AS (SELECT CAST(floor((row_number() OVER (ORDER BY event_ms, event_id) - 1) / 100) AS BIGINT) AS batch_id, path, event_ms, event_id FROM f)"""


def _sql(rest: str, *more: str) -> str:
    return f"WITH {', '.join([_N, *more])} {rest}"


_GLOB_SQL = r"regexp_full_match(path, '.*/user_id=1.*/.*')"

_ORACLES = {
    parse_notifications: _sql("SELECT event_id, 's3://bucket/' || path AS path, event_ms FROM c"),
    discard_counts: _sql("SELECT CASE WHEN contains(event_name, 'ObjectCreated') THEN 'created' ELSE 'discarded' END AS outcome, count(*) AS n FROM n GROUP BY 1"),
    glob_filter: _sql(f"SELECT event_id, path FROM c WHERE {_GLOB_SQL}"),
    dedupe_first: _sql("SELECT path, event_ms, event_id FROM f"),
    expiry_verdict: _sql(
        "SELECT event_id, coalesce(event_ms < floor_ms, false) AS expired FROM t JOIN p USING (trigger_id)",
        "t AS (SELECT event_id, event_ms, event_id % 20 AS trigger_id FROM n)",
        "g AS (SELECT trigger_id, max(event_ms) AS latest FROM t GROUP BY 1)",
        "p AS (SELECT trigger_id, max(latest) OVER (ORDER BY trigger_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 86400000 AS floor_ms FROM g)",
    ),
    verdict_counts: _sql(
        f"""SELECT verdict, CASE verdict WHEN 'Ok' THEN 'admit' WHEN 'ExistInCacheNotProcessed' THEN 'retry' ELSE 'drop' END AS action, count(*) AS n FROM (
          SELECT CASE WHEN NOT {_GLOB_SQL} THEN 'PatternNotMatch' WHEN event_ms < floor_ms THEN 'FileExpired' WHEN processed THEN 'ExistInCacheProcessed'
            WHEN NOT processed THEN 'ExistInCacheNotProcessed' WHEN logged_by < trigger_id AND logged_ms >= floor_ms THEN 'PersistedInMetadataLog' ELSE 'Ok' END AS verdict
          FROM c JOIN x USING (trigger_id) LEFT JOIN p USING (trigger_id, path) LEFT JOIN a USING (path)) GROUP BY 1, 2""",
        "m AS (SELECT trigger_id, max(event_ms) AS latest FROM c GROUP BY 1)",
        "x AS (SELECT trigger_id, coalesce(max(latest) OVER (ORDER BY trigger_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 86400000, 0) AS floor_ms FROM m)",
        "p AS (SELECT trigger_id + 1 AS trigger_id, path, event_id % 2 = 0 AS processed FROM c QUALIFY row_number() OVER (PARTITION BY c.trigger_id, path ORDER BY event_ms, event_id) = 1)",
        "a AS (SELECT path, event_ms AS logged_ms, trigger_id AS logged_by FROM c QUALIFY row_number() OVER (PARTITION BY path ORDER BY trigger_id, event_ms, event_id) = 1)",
    ),
    batch_admission: _sql("SELECT batch_id, path, event_ms, event_id FROM l"),
    oldest_first_topk: _sql("SELECT batch_id, path, event_ms FROM l ORDER BY event_ms, path LIMIT 25"),
    unprocessed_pending: _sql("SELECT path, event_ms FROM l WHERE batch_id % 2 <> 0"),
    delete_subbatches: _sql('SELECT batch_id, path, CAST(floor((row_number() OVER (PARTITION BY batch_id ORDER BY path) - 1) / 10) AS BIGINT) AS "group" FROM l'),
    log_range: _sql("SELECT batch_id, path, event_ms FROM l WHERE batch_id BETWEEN 3 AND 5"),
    log_all: _sql("SELECT batch_id, path, event_ms FROM l"),
    log_latest: _sql("SELECT batch_id, path, event_ms FROM l WHERE batch_id = (SELECT max(batch_id) FROM l)"),
    log_lookup: _sql("SELECT path, event_ms FROM l WHERE path IN (SELECT path FROM c WHERE trigger_id = (SELECT max(trigger_id) FROM c))"),
    log_race: _sql("SELECT batch_id, count(*) AS files, 1::BIGINT AS writers FROM l GROUP BY 1"),
    is_new_file: _sql("SELECT trigger_id, path FROM (SELECT DISTINCT trigger_id, path FROM c) JOIN g USING (path) WHERE logged_by >= trigger_id", "g AS (SELECT path, min(trigger_id) AS logged_by FROM c GROUP BY 1)"),
    log_clean: _sql("SELECT batch_id FROM l GROUP BY 1 HAVING max(event_ms) < (SELECT max(event_ms) FROM l) - 20 * 86400000 ORDER BY 1 LIMIT 20"),
    reprocess_dry_run: _sql("SELECT count(DISTINCT batch_id) AS batches, count(*) AS files FROM l WHERE batch_id BETWEEN 2 AND 9"),
    partition_columns: "SELECT event_id, event_type, CAST(user_id % 7 AS INT) AS bucket_no FROM events",
    csv_roundtrip: "SELECT * FROM customer",
    json_roundtrip: "SELECT * FROM customer",
    parquet_roundtrip: "SELECT * FROM customer",
    orc_roundtrip: "SELECT * FROM customer",
    csv_mismatch: "SELECT CAST(NULL AS INT) AS n_name, n_nationkey FROM nation",
    csv_drop_malformed: "SELECT n_nationkey AS a, n_nationkey FROM nation WHERE n_nationkey % 2 <> 0",
    parquet_mismatch: "SELECT CAST(NULL AS INT) AS unknown, n_name FROM nation",
    stream_append: "SELECT event_id, event_type, value FROM events",
    select_where: "SELECT event_id, event_type FROM events WHERE event_type = 'error'",
    stream_dedupe: "SELECT event_type, user_id, min(event_id) AS event_id FROM events GROUP BY 1, 2",
    state_latest: "SELECT event_type, user_id, min(event_id) AS event_id FROM events GROUP BY 1, 2",
    admit_once_state: _sql("SELECT path, min(event_ms) AS event_ms FROM (SELECT *, event_id % 3 AS turn, min(event_id % 3) OVER (PARTITION BY path) AS first FROM c) WHERE turn = first GROUP BY 1"),
    state_version: "SELECT event_type, user_id, min(event_id) AS event_id FROM events WHERE event_id % 3 = 0 GROUP BY 1, 2",
    intake_surplus: "SELECT o_orderkey, ((o_orderkey % 6) // 2)::BIGINT AS batch FROM orders",
    intake_keep_invalid: "SELECT o_orderkey, (SELECT count(DISTINCT o_orderkey % 6) FROM orders WHERE o_orderkey % 6 > 2) AS kept FROM orders WHERE o_orderkey % 6 < 3",
    intake_expired: "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderkey % 6 AS INT) AS part FROM orders WHERE o_orderkey % 6 > 2",
    reprocess_run: "SELECT o_orderkey, 2::BIGINT AS batch FROM orders WHERE o_orderkey % 6 = 5 UNION ALL SELECT o_orderkey, unnest([0, 1])::BIGINT AS batch FROM orders WHERE o_orderkey % 6 < 5",
    intake: "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderkey % 6 AS INT) AS part FROM orders",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ORACLES}


def oracle_sql() -> dict[str, str]:
    return {f.__name__: q for f, q in _ORACLES.items()}
