"""What the corpus operators share: the scratch folder, written tables, tokens' limits."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from sluiceway.sources.files import Folder, scratch

#: The characters that count as white space in every contract of this package.
SPACES = " \t\n\x0b\x0c\r"
#: Text bytes that a Python worker handles at once; one longer text is handled alone.
BLOCK_BYTES = 6 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def long_id(docs: DataFrame, id_col: str) -> Column:
    """The id as `doc_id long`; TypeError where ids aren't integers, since a cast would change or refuse them."""
    kind = docs.schema[id_col].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"{id_col} must have integers, not {kind.simpleString()}")
    return F.col(id_col).cast("long").alias("doc_id")


def materialize(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage is cut, executors may be lost."""
    path = scratch(df.sparkSession)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, *tables: DataFrame, but: str | None = None) -> None:
    """Deletes written tables that nothing will read again, but for the folder of that name in them."""
    for folder in {f.rpartition("/")[0] for t in tables for f in t.inputFiles()}:
        if folder.rpartition("/")[2] != but:
            Folder(spark, folder).delete("")


def release(spark: SparkSession, *tables: DataFrame, but: str | None = None) -> None:
    """Forgets tables, and lets Spark drop the shuffle files of finished jobs.

    Spark deletes a shuffle's files when the driver collects the plan as garbage, which it
    has little reason to do soon while the executors' disks fill. The last plan stays referenced
    until another one has run.
    """
    forget(spark, *tables, but=but)
    gc.collect()
    spark.range(1).write.format("noop").mode("overwrite").save()
    spark.sparkContext._jvm.System.gc()


def strip_spaces(text: Column) -> Column:
    """Text without any of SPACES; byte-wise replacements are several times faster than a pattern."""
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most limit bytes of text, or one row."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        sizes = pa.compute.fill_null(pa.compute.binary_length(values), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                give_back()
                start, held = i, 0
            held += size
        yield batch.slice(start, n - start)
        give_back()


try:
    _LIBC = ctypes.CDLL("libc.so.6")
except OSError:  # another C library
    _LIBC = None


def give_back() -> None:
    """Returns freed memory to the system, so that waiting workers hold little of it."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def one_thread() -> None:
    """A Python worker has one core: libraries that would start threads are kept from it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"


#: Keys that join_by_key broadcasts at most.
HOT_KEYS = 1024
HOT = "__sluiceway_hot"


def join_by_key(left: DataFrame, right: DataFrame, key: str, weight: str) -> DataFrame:
    """left inner joined with right on the key; both are read twice, so they should be written tables or small plans.

    The HOT_KEYS rows of right with the greatest weight (how often left has the key) are broadcast,
    so rows with a frequent key stay where they are; of the others, none has more than one in
    HOT_KEYS of left's rows, and they are shuffled. Right has a row per key, or a few of one weight.
    """
    keys = right.groupBy(key).agg(F.max(weight).alias(weight)).orderBy(F.desc(weight), key).limit(HOT_KEYS).select(key, F.lit(True).alias(HOT))
    near = left.join(F.broadcast(keys), key, "left")
    hot = near.filter(F.col(HOT).isNotNull()).drop(HOT).join(F.broadcast(right.join(F.broadcast(keys), key).drop(HOT)), key)
    rest = near.filter(F.col(HOT).isNull()).drop(HOT).join(right, key)
    return hot.unionByName(rest)


ROW_HASH, ROW_NAME, ROW_TIMES = "__sluiceway_hash", "__sluiceway_name", "__sluiceway_times"


def row_hash(docs: DataFrame) -> Column:
    """Tells rows apart that differ in any column; rows repeated entirely have one hash."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    hashed = [F.to_json(c) if docs.schema[i].dataType.simpleString().find("map<") >= 0 else c for i, c in enumerate(columns)]
    nulls = F.concat(*(c.isNull().cast("int").cast("string") for c in columns))  # the hash passes over nulls
    return F.xxhash64(nulls, *hashed)


def pick_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of docs that `chosen` names by row_hash, `copies` times, or once without that column.

    All columns of docs are kept, whatever their names. Rows repeated entirely have one name;
    such a row is picked as often as all of `chosen` together says.
    """
    times = F.sum("copies") if "copies" in chosen.columns else F.lit(1)
    chosen = chosen.groupBy(F.col("row_hash").alias(ROW_NAME)).agg(times.cast("int").alias(ROW_TIMES)).filter(F.col(ROW_TIMES) > 0)
    rows = docs.withColumn(ROW_HASH, row_hash(docs))
    if not rows.groupBy(ROW_HASH).agg(F.count(F.lit(1)).alias(ROW_TIMES)).filter(F.col(ROW_TIMES) > 1).isEmpty():
        rows = rows.dropDuplicates([ROW_HASH])
    out = rows.join(chosen, F.col(ROW_HASH) == F.col(ROW_NAME)).withColumn(ROW_TIMES, F.explode(F.sequence(F.lit(1), F.col(ROW_TIMES))))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
