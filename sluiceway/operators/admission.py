"""Deduplication, rate limits and expiry of announced files as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Files an acknowledgement call takes at most.
ACKNOWLEDGED = 10
#: Parts in which files are put in order.
RANGES = 64


def first_by_path(files: DataFrame, *order: str) -> DataFrame:
    """One row per path: the first by `order`. Partial minima are combined before the shuffle."""
    rest = [c for c in files.columns if c not in order and c != "path"]
    row = F.min(F.struct(*order, *rest)).alias("row")
    return files.groupBy("path").agg(row).select("path", *(F.col(f"row.{c}").alias(c) for c in (*order, *rest))).select(files.columns)


def oldest_first(files: DataFrame, limit: int | None = None) -> DataFrame:
    """Files by event time and path; with a limit, only so many (a top-k, not a full sort)."""
    ordered = files.orderBy("event_ms", "path")
    return ordered if limit is None else ordered.limit(limit)


def unprocessed(pending: DataFrame, floor_ms: int = 0) -> DataFrame:
    return pending.filter(~F.col("processed") & (F.col("event_ms") >= floor_ms))


def _place(value: Column, bounds: list) -> Column:
    """How many of the ascending bounds are below the value, by halving."""
    if not bounds:
        return F.lit(0)
    mid = len(bounds) // 2
    return F.when(value > F.lit(bounds[mid]), F.lit(mid + 1) + _place(value, bounds[mid + 1 :])).otherwise(_place(value, bounds[:mid]))


def _ranked(files: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """files with rank (from 0) in the whole order, without ordering all rows in one task.

    Rows are cut into RANGES of about as many rows by quantiles of the first order column, so a
    backfill of one day is cut as well; counts of the ranges give each its offset, and rows are
    numbered within their range. Rows of one time are in one range.
    """
    cuts = F.percentile_approx(order[0], F.array(*(F.lit(i / RANGES) for i in range(1, RANGES))), F.lit(10 * RANGES))
    bounds = sorted(set(files.agg(cuts).first()[0] or ()))
    cut = files.withColumn("range", _place(F.col(order[0]), bounds))
    counts = cut.groupBy("range").agg(F.count(F.lit(1)).alias("held"))
    before = F.coalesce(F.sum("held").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # RANGES rows
    within = F.row_number().over(W.partitionBy("range").orderBy(*order)) - 1
    return cut.withColumn("within", within).join(counts.select("range", before.alias("before")), "range").withColumn("rank", (F.col("within") + F.col("before")).cast("long")).drop("range", "within", "before")


def into_batches(files: DataFrame, size: int, *order: str) -> DataFrame:
    """files with the batch_id in which at most `size` of them are admitted, in order of the columns (the first a time in ms)."""
    return _ranked(files, order).withColumn("batch_id", F.floor(F.col("rank") / size).cast("long")).drop("rank")


def acknowledgement_groups(files: DataFrame, *keys: str) -> DataFrame:
    """A batch's files with the group (from 0) of at most ACKNOWLEDGED in which they are acknowledged; a batch is bounded."""
    return files.withColumn("group", F.floor((F.row_number().over(W.partitionBy(*keys).orderBy("path")) - 1) / ACKNOWLEDGED).cast("long"))


def expiry_floor(latest_ms: Column, max_age_ms: int) -> Column:
    return latest_ms - max_age_ms


def floors_by_trigger(files: DataFrame, max_age_ms: int) -> DataFrame:
    """(trigger_id, floor_ms): the latest time of all earlier triggers less the age, a row per trigger; null at first."""
    latest = files.groupBy("trigger_id").agg(F.max("event_ms").alias("latest"))
    earlier = F.max("latest").over(W.orderBy("trigger_id").rowsBetween(W.unboundedPreceding, -1))
    return latest.select("trigger_id", expiry_floor(earlier, max_age_ms).alias("floor_ms"))


def cleanable_batches(log: DataFrame, floor_ms: int | Column) -> DataFrame:
    """(batch_id) of the batches that were committed before the floor and have only files before it. log: batch_id, event_ms, commit_ms."""
    return log.groupBy("batch_id").agg(F.max("event_ms").alias("latest"), F.max("commit_ms").alias("commit_ms")).filter((F.col("latest") < floor_ms) & (F.col("commit_ms") < floor_ms)).select("batch_id")
