"""The log of admitted files: a Parquet table with a folder per batch.

A batch is written aside and renamed into place by the one writer that holds its claim, so it
is there as a whole or not at all, and of several writers of one batch id one succeeds at most. Each batch
starts with a header row (path null) that holds its commit time, the expiry floor after it and
the glob it was admitted by. Old batches can be folded into one compacted table, which bounds
the number of small files; it is ordered by path and has Bloom filters, so a path is looked up
without reading it all. What a compaction replaces is deleted by the next one, since open
DataFrames may still read it.
"""

from __future__ import annotations

import io
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators.admission import cleanable_batches
from sluiceway.sources.files import Folder
from sluiceway.sources.options import settings

ROWS = "batch_id long, path string, event_ms long, commit_ms long, floor_ms long, glob string"
#: Fixed value: batches removed by one cleaning.
CLEANED = 20
#: Tasks that list the folders of many batches; Spark's default is one for each, up to 10,000.
LISTERS = 64
_FILE = pa.schema([("path", pa.string()), ("event_ms", pa.int64()), ("commit_ms", pa.int64()), ("floor_ms", pa.int64()), ("glob", pa.string())])


@dataclass(frozen=True)
class Entry:
    path: str
    event_ms: int


class FileLog:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.folder = spark, Folder(spark, root)
        for name in ("batches", "compacted", "aside"):
            self.folder.make(name)
        self._times: dict[int, tuple[int, int]] | None = None  # of batches with a folder: latest file and commit

    # What there is.

    def _compacted(self) -> tuple[int, int] | None:
        """(version, last batch) of the compacted table."""
        found = [tuple(map(int, n.split("-"))) for n in self.folder.names("compacted") if n[0].isdigit()]
        return max(found) if found else None

    def batch_ids(self) -> list[int]:
        """Ids with a folder of their own, after the compacted ones."""
        last = (self._compacted() or (0, -1))[1]
        return sorted(i for n in self.folder.names("batches") if n.startswith("batch_id=") and (i := int(n.partition("=")[2])) > last)

    def latest_batch_id(self) -> int:
        """-1 for an empty log."""
        own = self.batch_ids()
        return own[-1] if own else (self._compacted() or (0, -1))[1]

    def rows(self) -> DataFrame:
        """All rows, headers included."""
        parts = [self.folder.at(f"batches/batch_id={i}") for i in self.batch_ids()]
        with settings(self.spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(LISTERS)} if len(parts) > LISTERS else {}):
            out = self.spark.read.schema(ROWS).option("basePath", self.folder.at("batches")).parquet(*parts) if parts else self.spark.createDataFrame([], ROWS)
        if (c := self._compacted()) is not None:
            out = out.select(*_names()).unionByName(self.spark.read.schema(ROWS).parquet(self.folder.at(f"compacted/{c[0]}-{c[1]}")).select(*_names()))
        return out.select(*_names())

    def to_df(self) -> DataFrame:
        """(batch_id, path, event_ms, commit_ms) of all logged files."""
        return self.rows().filter("path is not null").select("batch_id", "path", "event_ms", "commit_ms")

    def show_all(self) -> DataFrame:
        """For inspection: all batches in order."""
        return self.rows().orderBy("batch_id", F.col("path").asc_nulls_first())

    # Writing.

    def add(self, batch_id: int, entries: DataFrame | Sequence[Entry], commit_ms: int | None = None, floor_ms: int = 0, glob: str | None = None, clean_floor_ms: int | None = None) -> bool:
        """Logs a batch; False if it is there already, or another writer is about to log it. With clean_floor_ms, old batches go first."""
        if batch_id < 0:
            raise ValueError("a batch id must not be negative")
        if entries is None:
            raise ValueError("entries are missing")
        if clean_floor_ms is not None:
            self.clean_folders(clean_floor_ms)
        if self.folder.exists(f"batches/batch_id={batch_id}") or batch_id <= (self._compacted() or (0, -1))[1]:
            return False
        commit_ms = int(time.time() * 1000) if commit_ms is None else commit_ms
        if not isinstance(entries, DataFrame):
            return self._add_entries(batch_id, list(entries), commit_ms, floor_ms, glob)
        header = self.spark.createDataFrame([(None, None)], "path string, event_ms long")
        rows = header.unionByName(entries.select("path", "event_ms")).withColumns({"commit_ms": F.lit(commit_ms).cast("long"), "floor_ms": F.lit(floor_ms).cast("long"), "glob": F.lit(glob).cast("string")})
        aside = f"aside/{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(self.folder.at(aside))  # a batch is bounded by the files per trigger
        if self.folder.move_new(aside, f"batches/batch_id={batch_id}"):
            return True
        self.folder.delete(aside)
        return False

    def _add_entries(self, batch_id: int, entries: list[Entry], commit_ms: int, floor_ms: int, glob: str | None) -> bool:
        """Writes a batch that the driver holds as one file, without a job; only the writer that holds the claim writes."""
        n, out, aside, to = len(entries) + 1, io.BytesIO(), f"aside/{uuid.uuid4().hex}", f"batches/batch_id={batch_id}"
        if not self.folder.claim(to):
            return False
        moved = False
        try:
            pa.parquet.write_table(pa.table([[None, *(e.path for e in entries)], [None, *(e.event_ms for e in entries)], [commit_ms] * n, [floor_ms] * n, [glob] * n], schema=_FILE), out)
            self.folder.write(f"{aside}/part-0.parquet", out.getvalue())
            moved = self.folder.move(aside, to)
        finally:
            self.folder.release(to)
            if not moved:
                self.folder.delete(aside)
        if moved and self._times is not None and entries:
            self._times[batch_id] = max(e.event_ms for e in entries), commit_ms
        return moved

    def clean_folders(self, floor_ms: int, limit: int = CLEANED) -> list[int]:
        """clean() for batches with a folder of their own, by times that are read once; compacted ones go when they are compacted anew."""
        if self._times is None:
            own = self.batch_ids()
            rows = self.to_df().filter(F.col("batch_id") >= own[0]).groupBy("batch_id").agg(F.max("event_ms"), F.max("commit_ms")).collect() if own else []
            self._times = {r[0]: (r[1], r[2]) for r in rows}
        old = sorted(i for i, (latest, commit) in self._times.items() if latest < floor_ms and commit < floor_ms)[:limit]
        for i in old:
            self.folder.delete(f"batches/batch_id={i}")
            del self._times[i]
        return old

    def fill(self, files: DataFrame, upto: int, commit_ms: int | None = None) -> bool:
        """Logs batches 0 to `upto` of an empty log at once, as compacted ones; False if a batch is there. files: batch_id, path, event_ms."""
        if upto < 0:
            raise ValueError("a batch id must not be negative")
        if self.latest_batch_id() >= 0:
            return False
        commit_ms = int(time.time() * 1000) if commit_ms is None else commit_ms
        headers = self.spark.range(upto + 1).select(F.col("id").alias("batch_id"), F.lit(None).cast("string").alias("path"), F.lit(None).cast("long").alias("event_ms"))
        entries = files.filter(F.col("batch_id") <= upto).select("batch_id", "path", "event_ms")
        rows = headers.unionByName(entries).withColumns({"commit_ms": F.lit(commit_ms).cast("long"), "floor_ms": F.lit(0).cast("long"), "glob": F.lit(None).cast("string")})
        aside = f"aside/{uuid.uuid4().hex}"
        self._write_ordered(rows, aside)
        if self.folder.move_new(aside, f"compacted/1-{upto}"):
            return True
        self.folder.delete(aside)
        return False

    def compact(self, upto: int | None = None, without: Sequence[int] = ()) -> None:
        """Folds batches up to `upto` into one table, leaving some out. Readers see the old or the new table."""
        old = self._compacted()
        upto = self.latest_batch_id() if upto is None else upto
        upto = max(upto, old[1] if old else -1)
        if upto < 0:
            return
        version, aside = (old[0] if old else 0) + 1, f"aside/{uuid.uuid4().hex}"
        kept = self.rows().filter((F.col("batch_id") <= upto) & ~F.col("batch_id").isin([int(i) for i in without]))
        self._write_ordered(kept, aside)
        if not self.folder.move_new(aside, f"compacted/{version}-{upto}"):
            self.folder.delete(aside)
            raise OSError("another compaction took place")
        for n in self.folder.names("compacted"):
            if n[0].isdigit() and int(n.partition("-")[0]) < version - 1:
                self.folder.delete(f"compacted/{n}")
        for n in self.folder.names("batches"):
            if old and n.startswith("batch_id=") and int(n.partition("=")[2]) <= old[1]:
                self.folder.delete(f"batches/{n}")
        self._times = None

    def _write_ordered(self, rows: DataFrame, name: str) -> None:
        rows.repartitionByRange(F.col("path")).sortWithinPartitions("path").write.option("parquet.bloom.filter.enabled#path", "true").parquet(self.folder.at(name))

    def clean(self, floor_ms: int, limit: int = CLEANED) -> list[int]:
        """Removes the oldest batches of which commit and files are before the floor; at most `limit` of them."""
        old = [r.batch_id for r in cleanable_batches(self.to_df(), floor_ms).orderBy("batch_id").limit(limit).collect()]
        self._times = None
        folded = [i for i in old if i <= (self._compacted() or (0, -1))[1]]
        if folded:
            self.compact((self._compacted() or (0, -1))[1], folded)
        for i in set(old) - set(folded):
            self.folder.delete(f"batches/batch_id={i}")
        return old

    # Reading.

    def get(self, batch_id: int) -> DataFrame | None:
        """A batch's files, or None if the batch isn't there."""
        if batch_id > (self._compacted() or (0, -1))[1] and self.folder.exists(f"batches/batch_id={batch_id}"):
            rows = self.spark.read.schema(ROWS).option("basePath", self.folder.at("batches")).parquet(self.folder.at(f"batches/batch_id={batch_id}"))
        elif batch_id <= (self._compacted() or (0, -1))[1]:
            rows = self.rows().filter(F.col("batch_id") == batch_id)
            if rows.isEmpty():
                return None
        else:
            return None
        return rows.filter("path is not null").select("batch_id", "path", "event_ms", "commit_ms")

    def latest(self) -> tuple[int, DataFrame] | None:
        """The last batch and its files."""
        last = self.latest_batch_id()
        if last < 0:
            return None
        found = self.get(last)
        if found is None:
            raise RuntimeError(f"log batch {last} is named but not there")
        return last, found

    def range(self, start: int | None = None, end: int | None = None) -> DataFrame:
        """Files of the batches start to end, inclusive, which must all be there. Defaults: first and last."""
        start, end = 0 if start is None else start, self.latest_batch_id() if end is None else end
        rows = self.rows().filter(F.col("batch_id").between(start, end))
        there = {r.batch_id for r in rows.filter("path is null").select("batch_id").collect()}  # a header each
        for i in range(start, end + 1):
            if i not in there:
                raise ValueError(f"log batch {i} not found")
        return rows.filter("path is not null").select("batch_id", "path", "event_ms", "commit_ms")

    def get_file(self, path: str) -> int | None:
        """The logged time of a path."""
        return self.to_df().filter(F.col("path") == path).agg(F.max("event_ms")).first()[0]

    def times_of(self, paths: DataFrame, floor_ms: int = 0) -> DataFrame:
        """(path, event_ms) of the log's rows with these paths (a bounded number) that are not below the floor."""
        return self.to_df().filter(F.col("event_ms") >= floor_ms).join(F.broadcast(paths.select("path").distinct()), "path", "left_semi").select("path", "event_ms")

    def is_new_file(self, path: str, floor_ms: int) -> bool:
        known = self.get_file(path)
        return known is None or known < floor_ms

    def floor(self) -> int:
        """The expiry floor after the last batch."""
        return self.rows().filter("path is null").agg(F.max("floor_ms")).first()[0] or 0

    def purge(self, threshold: int) -> None:
        raise NotImplementedError("batches are removed by clean() only")

    def close(self) -> None:
        """Nothing is held open."""

    def __enter__(self) -> FileLog:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def _names() -> list[str]:
    return [c.split()[0] for c in ROWS.split(", ")]
