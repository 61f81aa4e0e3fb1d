"""The intake as a Python data source: a streaming DataFrame that stateful operators can follow.

    spark.dataSource.register(IntakeDataSource)
    spark.readStream.format("file-intake").schema(...).option("queue", dir).option("log", dir)...

The driver takes notifications from a directory queue, logs the new files under the next
offset and only then deletes their messages; executors read a file each with pyarrow.
Formats: csv (with header and sep), json lines, parquet. Columns of the schema that a path names
as `column=value` are partition columns; pathGlobFilter leaves paths out.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from pathlib import Path
from typing import Any
from urllib.parse import unquote

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from sluiceway.functions.durations import duration_ms
from sluiceway.functions.globs import glob_to_regex
from sluiceway.sources.client import parse_message
from sluiceway.sources.queue import DirectoryQueue


class FilePartition(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class IntakeDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file-intake"

    def schema(self) -> str:
        raise ValueError("an intake needs a schema: use .schema(...)")

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return IntakeReader(schema, dict(self.options))


class IntakeReader(DataSourceStreamReader):
    """Offsets are {"logOffset": n}; files n of the log, a JSON line per file, are those of offset n."""

    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        for name in ("queue", "log", "format"):
            if name not in options:
                raise ValueError(f"the option {name} is missing")
        self.schema, self.options = schema, options
        self.log = Path(options["log"])
        self.limit = int(options.get("maxfilespertrigger", 100))
        self.max_age_ms = duration_ms(options.get("maxfileage", "15d"))
        self.glob = re.compile(glob_to_regex(options["pathglobfilter"]).removesuffix("\\z") + "\\Z") if "pathglobfilter" in options else None
        self._seen, self._upto = {}, -1  # logged files that haven't expired, of the batches read so far

    def __repr__(self) -> str:
        return f"IntakeReader[{self.options['queue']}]"

    def initialOffset(self) -> dict[str, int]:  # noqa: N802
        return {"logOffset": -1}

    def _ids(self) -> list[int]:
        return sorted(int(p.stem) for p in self.log.glob("[0-9]*.json")) if self.log.exists() else []

    def _files(self, i: int) -> list[dict[str, Any]]:
        return [json.loads(line) for line in (self.log / f"{i}.json").read_text().splitlines()]

    def latestOffset(self) -> dict[str, int]:  # noqa: N802
        """Logs one more batch of new files if there are some."""
        ids = self._ids()
        for i in ids:
            if i > self._upto:
                self._seen |= {f["path"]: f["event_ms"] for f in self._files(i)}
                self._upto = i
        floor = max(self._seen.values(), default=0) - self.max_age_ms
        self._seen = seen = {p: ms for p, ms in self._seen.items() if ms >= floor}
        queue, new, receipts = DirectoryQueue(self.options["queue"]), {}, []
        while len(new) < self.limit and (found := queue.receive()):
            for message in found:
                for f in parse_message(message)[0]:
                    path = f.path.removeprefix("s3:/") if self.options.get("local", "false") == "true" else f.path
                    if self.glob is not None and not self.glob.match(path):
                        continue
                    if f.event_ms >= floor and (path not in seen or seen[path] < floor):
                        new.setdefault(path, f.event_ms)
                receipts.append(message.receipt)
        last = ids[-1] if ids else -1
        if new:
            last += 1
            self.log.mkdir(parents=True, exist_ok=True)
            aside = self.log / f".{uuid.uuid4().hex}"
            aside.write_text("\n".join(json.dumps({"path": p, "event_ms": ms}) for p, ms in sorted(new.items(), key=lambda x: (x[1], x[0]))))
            os.replace(aside, self.log / f"{last}.json")
        for r in receipts:  # logged before they are deleted
            queue.delete(r)
        return {"logOffset": last}

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[InputPartition]:
        return [FilePartition(f["path"]) for i in range(start["logOffset"] + 1, end["logOffset"] + 1) for f in self._files(i) if os.path.exists(f["path"])]

    def commit(self, end: dict[str, int]) -> None:
        pass

    def read(self, partition: FilePartition) -> Iterator[Any]:
        import pyarrow as pa
        import pyarrow.csv
        import pyarrow.json
        import pyarrow.parquet
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted, form = to_arrow_schema(self.schema), self.options["format"]
        if form == "parquet":
            found = pa.parquet.read_table(partition.path)
        elif form == "json":
            found = pa.json.read_json(partition.path)
        elif form == "csv":
            header = self.options.get("header", "false") == "true"
            found = pa.csv.read_csv(partition.path, pa.csv.ReadOptions(column_names=None if header else [n for n in wanted.names if f"/{n}=" not in partition.path]), pa.csv.ParseOptions(delimiter=self.options.get("sep", ",")))
        else:
            raise ValueError(f"no reader for {form}")
        named = dict(part.split("=", 1) for part in partition.path.split("/") if "=" in part)
        for f in wanted:
            if f.name not in found.column_names and f.name in named:
                found = found.append_column(f.name, pa.array([unquote(named[f.name])] * found.num_rows, pa.string()))
        columns = [found[f.name].cast(f.type, safe=False) if f.name in found.column_names else pa.nulls(found.num_rows, f.type) for f in wanted]
        yield from pa.Table.from_arrays(columns, schema=wanted).to_batches()
