"""Exact deduplication with a heavy-hitter split, in DataFrame operations only.

A Misra-Gries summary (Spark's approx_top_k keeps one per task and merges them) names the
digests that may be frequent. Their exact counts and winners are verified by a map-side
combined aggregation; at most `hot_keys` rows come of it, so they are broadcast and the rows
of frequent digests are decided where they stand, without a shuffle. The remaining digests,
none of which can hold more than about 1/tracked of the rows, take an ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import materialize, pick_rows, row_hash, strip_spaces


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_keys: int = 1024, tracked: int = 16384, hot_rows: int = 64) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, row_hash (of all columns).

    Texts are equal when identical without white space ([\\x20\\x09-\\x0D]); a null text
    counts as empty. Of equal texts the row with the most code points stays, then the one
    with the smallest id (a null id comes last), then that with the smallest row_hash; of
    rows repeated entirely, any one. Empty table: no rows. Other columns only count in the
    row_hash, whatever their names.

    hot_keys, tracked: rows broadcast at most, and counters of the summary (a power of 2).
    hot_rows: a digest with fewer rows is left to the shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.length(text).cast("long").alias("n"),
            F.unhex(F.sha2(strip_spaces(text), 256)).alias("d"),
            row_hash(docs).alias("hash"),
        ).withColumn("r", F.monotonically_increasing_id())
    )
    winner = F.min(F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("id"), F.col("hash").alias("hash"), F.col("r").alias("r"))).alias("w")
    found = keyed.agg(F.expr(f"approx_top_k(hex(d), {hot_keys}, {tracked})").alias("top"))
    named = found.select(F.explode("top.item").alias("h")).select(F.unhex("h").alias("d"))
    hot = materialize(
        keyed.join(F.broadcast(named), "d", "left_semi").groupBy("d").agg(F.count(F.lit(1)).alias("group_size"), winner).filter(F.col("group_size") >= hot_rows)
    )
    near = keyed.join(F.broadcast(hot), "d", "left")
    mine = near.filter(F.col("w").isNotNull())
    rest = near.filter(F.col("w").isNull()).select("doc_id", "n", "d", "hash", "r")
    groups = rest.groupBy("d").agg(F.count(F.lit(1)).alias("group_size"), winner)
    rest = rest.join(groups, "d")
    columns = [
        F.col("doc_id").alias(id_col),
        F.col("w.id").alias("keep_id"),
        F.col("group_size"),
        (F.col("r") == F.col("w.r")).alias("kept"),
        F.lower(F.hex("d")).alias("text_sha256"),
        F.col("hash").alias("row_hash"),
    ]
    return mine.select(columns).unionByName(rest.select(columns))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all their columns."""
    return pick_rows(docs, exact_dedup(docs, id_col, text_col).filter("kept"))
