"""Scale tools: a generator of announced files, the two consumers to compare, and a validator."""

from __future__ import annotations

import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.sources.options import Options
from sluiceway.sources.queue import DirectoryQueue, notification
from sluiceway.streaming.intake import Intake

SCALE_SCHEMA = "valString string, valBoolean boolean, valDouble double, valInt int, valPartition string"


def scale_rows(spark: SparkSession, rows: int, partitions: int, prefix: str = "part", seed: int = 1) -> DataFrame:
    """Rows of SCALE_SCHEMA with 10-character strings, dealt to `partitions` named partitions."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    return spark.range(rows).select(
        F.substring(h, 1, 10).alias("valString"), (F.xxhash64("id") % 2 == 0).alias("valBoolean"), F.rand(seed).alias("valDouble"), F.pmod(F.xxhash64("id"), F.lit(1_000_000)).cast("int").alias("valInt"), F.concat(F.lit(f"{prefix}_"), (F.col("id") % partitions).cast("string")).alias("valPartition")
    )


def generate(spark: SparkSession, root: str, files: int, rows_per_file: int) -> list[str]:
    """Writes the rows as CSV, a file per partition, and returns the files' paths."""
    scale_rows(spark, files * rows_per_file, files).repartition(files, "valPartition").write.partitionBy("valPartition").mode("append").csv(root)
    return [str(p) for p in sorted(Path(root).rglob("*.csv"))]


def announce(paths: list[str], root: str, queue: DirectoryQueue) -> None:
    for p in paths:
        queue.send(notification("b", str(Path(p).relative_to(root)).replace("=", "%3D"), "2024-01-01T00:00:00.000Z"))


class FolderIntake(Intake):
    """An intake whose bucket `b` is a local folder."""

    folder = ""

    def locate(self, path: str) -> str:
        return path.replace("s3://b", self.folder, 1)


def intake_consumer(spark: SparkSession, root: str, work: str, files_per_trigger: int) -> tuple[int, dict[str, float]]:
    """Reads the announced files into Parquet; rows, and seconds of the fetch (with verdicts and log) and of the query."""
    options = Options.parse({"sluiceway.fileFormat": "csv", "sluiceway.queueUrl": f"{work}/queue", "sluiceway.queueRegion": "local", "sluiceway.maxFilesPerTrigger": str(files_per_trigger), "sluiceway.queue.longPollingWaitTimeSeconds": "0", "sluiceway.queue.maxConcurrency": "4", "sluiceway.partitionColumns": "valPartition", "basePath": root})
    run = FolderIntake(spark, options, SCALE_SCHEMA, f"{work}/checkpoint")
    run.folder = root
    began = time.monotonic()
    while run.feed():
        pass
    fetched = time.monotonic()
    query = run.start(lambda rows, batch: rows.write.mode("overwrite").parquet(f"{work}/out/batch={batch}"))
    query.awaitTermination()
    ended = time.monotonic()
    run.close(query)
    return spark.read.parquet(f"{work}/out").count(), {"fetch_s": round(fetched - began, 3), "query_s": round(ended - fetched, 3)}


def file_source_consumer(spark: SparkSession, root: str, work: str, files_per_trigger: int) -> tuple[int, dict[str, float]]:
    """The same with Spark's own file source, which lists the folder."""
    began = time.monotonic()
    stream = spark.readStream.schema(SCALE_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).csv(root)
    stream.writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{work}/out").count(), {"query_s": round(time.monotonic() - began, 3)}


def validate_count(found: int, expected: int) -> None:
    if found != expected:
        raise ValueError(f"{found} rows, {expected} expected")


def compare_with_file_source(spark: SparkSession, work: str, files: int, rows_per_file: int, files_per_trigger: int = 100) -> dict:
    root = f"{work}/data"
    announce(generate(spark, root, files, rows_per_file), root, DirectoryQueue(f"{work}/intake/queue"))
    out: dict = {"files": files, "rows": files * rows_per_file}
    for name, consumer in (("file_source", file_source_consumer), ("intake", intake_consumer)):
        rows, times = consumer(spark, root, f"{work}/{name}", files_per_trigger)
        validate_count(rows, files * rows_per_file)
        out[name] = times | {"rows_per_s": round(rows / times["query_s"])}
    return out
