"""Verdicts on announced files, as one column over joins with the pending files and the log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.globs import matches_glob

# The verdicts, in the order in which they are tried.
PATTERN_NOT_MATCH = "PatternNotMatch"
FILE_EXPIRED = "FileExpired"
IN_CACHE_PROCESSED = "ExistInCacheProcessed"
IN_CACHE_PENDING = "ExistInCacheNotProcessed"
IN_LOG = "PersistedInMetadataLog"
OK = "Ok"
VERDICTS = (PATTERN_NOT_MATCH, FILE_EXPIRED, IN_CACHE_PROCESSED, IN_CACHE_PENDING, IN_LOG, OK)

#: What becomes of a file's message.
ADMIT, RETRY, DROP, KEEP = "admit", "retry", "drop", "keep"


def verdict(path: Column, event_ms: Column, floor_ms: Column | int, glob: str | None, cached: Column, processed: Column, logged_ms: Column) -> Column:
    """The first verdict that holds. cached: whether the path is pending or done here; logged_ms: its time in the log."""
    floor = floor_ms if isinstance(floor_ms, Column) else F.lit(floor_ms)
    out = F.when(F.lit(False), OK)
    if glob:
        out = F.when(~matches_glob(path, glob), PATTERN_NOT_MATCH)
    return (
        out.when(event_ms < floor, FILE_EXPIRED)
        .when(F.coalesce(cached, F.lit(False)) & F.coalesce(processed, F.lit(False)), IN_CACHE_PROCESSED)
        .when(F.coalesce(cached, F.lit(False)), IN_CACHE_PENDING)
        .when(logged_ms >= floor, IN_LOG)
        .otherwise(OK)
    )


def with_verdicts(files: DataFrame, pending: DataFrame, log: DataFrame, floor_ms: Column | int, glob: str | None = None, by: str | None = None) -> DataFrame:
    """files (path, event_ms, ...) with a verdict column.

    pending: (path, processed). log: (path, event_ms), of which only rows not below the
    floor are read, since older ones count as forgotten. Spark broadcasts the smaller side
    of each join if it measures it as small, and else joins on the hashed path.

    With `by`, a column of all three, a file is judged against pending rows of the same value
    and the log's rows of smaller ones; then the floor can be a column of files, the same for
    all files of a value.
    """
    keys = ["path"] if by is None else ["path", by]
    known = pending.select(*keys, F.col("processed"), F.lit(True).alias("cached"))
    if by is None:
        held = log.filter(F.col("event_ms") >= floor_ms).select("path", F.col("event_ms").alias("logged_ms"))
    else:
        floor = floor_ms if isinstance(floor_ms, Column) else F.lit(floor_ms)
        earlier = log.select("path", F.col("event_ms").alias("logged_ms"), F.col(by).alias("logged_by"))
        asked = files.select(*keys, floor.alias("floor")).distinct()
        held = asked.join(earlier, "path").filter((F.col("logged_by") < F.col(by)) & (F.col("logged_ms") >= F.col("floor")))
    logged = held.groupBy(*keys).agg(F.max("logged_ms").alias("logged_ms"))
    joined = files.join(known, keys, "left").join(logged, keys, "left")
    out = verdict(F.col("path"), F.col("event_ms"), floor_ms, glob, F.col("cached"), F.col("processed"), F.col("logged_ms"))
    return joined.withColumn("verdict", out).drop("cached", "processed", "logged_ms")


def action(verdict_col: Column, keep_invalid: bool = False) -> Column:
    """admit a new file; retry one that is pending; drop (or keep, for others to see) the message of any other."""
    return F.when(verdict_col == OK, ADMIT).when(verdict_col == IN_CACHE_PENDING, RETRY).otherwise(KEEP if keep_invalid else DROP)


def is_new_file(files: DataFrame, log: DataFrame, floor_ms: int | None = None, by: str | None = None) -> DataFrame:
    """The files whose path isn't in the log, or only with a time below the floor.

    With `by`, a column of both, a file is compared with the log's rows of smaller values only.
    """
    held = log if floor_ms is None else log.filter(F.col("event_ms") >= floor_ms)
    if by is None:
        return files.join(held.select("path"), "path", "left_anti")
    earlier = held.select(F.col("path").alias("logged_path"), F.col(by).alias("logged_by"))
    return files.join(earlier, (F.col("path") == F.col("logged_path")) & (F.col("logged_by") < F.col(by)), "left_anti")
