"""Mixing sources to target weights by hash-random keys and distributed prefix sums.

Each row gets a uniform 60-bit key. The key's first bits cut every source into ranges that
are even by construction, so the range sort needs no sampling and a source with a third of
all rows is spread over as many tasks as any other. Sums of the ranges (a small table) give
each range its offset; within a range a running sum ends the prefix sum. A row is taken once
for every whole epoch of its source's budget, and as far as the budget reaches in the last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluiceway.llm.common import materialize, pick_rows, row_hash

KEY_HEX = 15


def n_words(text: Column) -> Column:
    """Number of maximal runs of other characters than [\\x20\\x09-\\x0D]; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(rows: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """By skey: source_size, target. rows has skey, source, size.

    All sizes are shared by weight; a target stops at `most` times its source's size and
    the excess is shared again. In the order of cap/weight the capped sources come first,
    so prefix sums find them without iteration. One row per source is ordered in one task.
    """
    sources = rows.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").isNull(), "source"))
    sources = sources.withColumn("rank", rank).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.expr(f"cast((rank - 1) % {len(weights)} + 1 as int)")).cast("double"))
    sources = sources.withColumn("cap", (F.col("source_size") * most).cast("double"))
    order = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    sources = sources.select(
        "*",
        F.sum("source_size").over(W.partitionBy()).cast("double").alias("total"),
        F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)).alias("before"),
        F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)).alias("rest"),
    )
    sources = sources.withColumn("capped", F.col("cap") * F.col("rest") <= (F.col("total") - F.col("before")) * F.col("weight"))
    every = W.partitionBy()
    level = (F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0.0))) * F.col("weight") / F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    return sources.select("skey", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(level).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (1, 2, 3), most: int = 3, ranges: int = 1024, seed: int = 0) -> DataFrame:
    """One row per input row: id, size (words), source_size, target (its source's), taken, row_hash (of all columns).

    Sources by code point, null last as a source of its own, have the weights in turn. A
    source's taken words are its target rounded down. A null text has size 0 and is taken
    0 times, as is every row of a source without words. Ties of the key (repeated ids) are
    ordered by size and row_hash; equal rows share alike whichever comes first. Empty table: no
    rows. Other columns only count in the row_hash.
    """
    if ranges & (ranges - 1) or ranges < 1:
        raise ValueError("ranges must be a power of 2")
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, KEY_HEX), 16, 10).cast("long")
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("skey"),
            n_words(F.col(text_col)).alias("size"),
            key.alias("key"),
            row_hash(docs).alias("hash"),
        )
    ).withColumn("range", F.shiftright("key", 4 * KEY_HEX - (ranges.bit_length() - 1)))
    sums = rows.groupBy("skey", "range").agg(F.sum("size").alias("held"))
    before = F.coalesce(F.sum("held").over(W.partitionBy("skey").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    plan = sums.select("skey", "range", before.alias("offset")).join(source_targets(rows, weights, most), "skey")
    within = F.sum("size").over(W.partitionBy("skey", "range").orderBy("key", "doc_id", "size", "hash").rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("upto", within - F.col("size")).join(plan, ["skey", "range"])
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))).otherwise(0)
    rows = rows.withColumn("epochs", epochs.cast("long")).withColumn("left", budget - F.col("epochs") * F.col("source_size"))
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - (F.col("offset") + F.col("upto"))))
    return rows.select(F.col("doc_id").alias(id_col), "size", "source_size", "target", (F.col("epochs") * F.col("size") + extra).cast("long").alias("taken"), F.col("hash").alias("row_hash"))


def draw(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix as rows of docs, with all their columns: a row for each time that one is taken.

    Texts are not divided here: the last part of a row's taken words counts if it is half of
    the text or more, so a source misses its target by less than one text.
    """
    taken = mix(docs, id_col, text_col, source_col, **options).filter("size > 0")
    return pick_rows(docs, taken.withColumn("copies", F.floor(F.col("taken") / F.col("size") + 0.5)))
