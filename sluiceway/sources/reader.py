"""Reads the admitted files with Spark's own readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sluiceway.sources.files import existing
from sluiceway.sources.options import NoSchemaError, Options


def escape_glob(path: str) -> str:
    """A path as load() has to be given it, so that its own brackets and stars aren't expanded."""
    return "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in path)


def read_files(spark: SparkSession, paths: list[str], schema: StructType | str | None, file_format: str, options: Mapping[str, str] | None = None, base_path: str | None = None) -> tuple[DataFrame, int]:
    """The rows of the files, and how many paths are gone. The schema is mandatory and read as it is.

    Hive-style partition columns are those of the schema that the folders below base_path name.
    """
    if not schema:
        raise NoSchemaError("a schema is needed; it isn't inferred from files")
    there = existing(spark, paths)
    reader = spark.read.format(file_format).schema(schema).options(**dict(options or {}))
    if base_path:
        reader = reader.option("basePath", base_path)
    if not there:
        kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        return spark.createDataFrame([], kind), len(paths)
    return reader.load([escape_glob(p) for p in there]), len(paths) - len(there)


def read_with(spark: SparkSession, options: Options, paths: list[str], schema: StructType | str) -> tuple[DataFrame, int]:
    rest = {k: v for k, v in options.reader.items() if k.lower() not in ("basepath", "pathglobfilter")}
    return read_files(spark, paths, schema, options.file_format, rest, options.base_path)
