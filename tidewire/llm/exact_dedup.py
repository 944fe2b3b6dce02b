"""Exact dedup with a heavy-hitter split (native DataFrame operations only).

Texts are equal when identical after lower-casing A-Z; the largest ``doc_id``
of a group stays. Steps:

1. one pass over the texts gives (id, SHA-256, row number), staged without a
   shuffle;
2. a Misra-Gries family summary (Spark's frequent-items sketch, built for each
   group of partitions and merged) names digests that may hold more than about
   0.2 % of all rows;
3. those candidates are counted exactly; the verified winners, at most
   ``winners`` rows, are broadcast and resolve their copies map-side;
4. all other digests go through an ordinary shuffled aggregation and join,
   whose largest group is bounded by the sketch's error.

The sketch only steers the split: what it misses or names needlessly changes
the plan's balance, never the result.

Defined cases: null text equals the empty text; null ids lose against any id
(a group of null ids only has a null ``keep_id`` and keeps one row); of rows
that repeat the same id and text one is kept; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, drop_rows, staged

#: Counters of the frequent-items sketch; its error is about 3.5 / TRACKED of all rows.
TRACKED = 4096
#: Most digests that are broadcast (about 100 bytes each).
WINNERS = 2000
#: Sketches are merged in two steps, through this many groups of partitions.
MERGE_GROUPS = 64


def frequent(rows: DataFrame, digest: str, tracked: int = TRACKED, winners: int = WINNERS) -> DataFrame:
    """Column ``candidate``: 64-bit hashes of the digests that are frequent in ``rows``."""
    hashed = rows.select(F.xxhash64(digest).alias("__h"), F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("__g"))
    return (
        hashed.groupBy("__g").agg(F.expr(f"approx_top_k_accumulate(__h, {tracked})").alias("__s"))
        .groupBy(F.col("__g") < 0)  # one group; a global aggregate fails on partitions without rows
        .agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(__s, {tracked}), {winners})").alias("__top"))
        .select(F.explode("__top").alias("__i"))
        .where("__i.count > 1")
        .select(F.col("__i.item").alias("candidate"))
    )


def resolve(rows: DataFrame, digest: str, id_col: str, row: str, tracked: int = TRACKED, winners: int = WINNERS) -> DataFrame:
    """``rows`` with ``group_size``, ``keep_id`` and ``keep_row`` (one row that has it) of each row's digest.

    ``rows`` is read several times, so pass a staged table.
    """
    candidates = F.broadcast(frequent(rows, digest, tracked, winners))
    totals = [F.count("*").alias("group_size"), F.max(F.struct(F.col(id_col).alias("id"), (-F.col(row)).alias("back"))).alias("__top")]
    heavy = staged(rows.join(candidates, F.xxhash64(digest) == F.col("candidate"), "left_semi").groupBy(digest).agg(*totals), "winners")
    split = rows.join(F.broadcast(heavy), digest, "left")
    rest = rows.join(F.broadcast(heavy.select(digest)), digest, "left_anti")
    both = split.where(F.col("group_size").isNotNull()).unionByName(rest.join(rest.groupBy(digest).agg(*totals), digest))
    return both.withColumn("keep_id", F.col("__top.id")).withColumn("keep_row", -F.col("__top.back")).drop("__top")


def _digest(text_col: str) -> Column:
    return F.unhex(F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``id``, ``digest`` (binary SHA-256 of the normalised text), ``row`` (unique once staged)."""
    return docs.select(F.col(id_col).alias("id"), _digest(text_col).alias("digest"), F.monotonically_increasing_id().alias("row"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = TRACKED, winners: int = WINNERS) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    found = resolve(staged(digests(docs, id_col, text_col), "digests"), "digest", "id", "row", tracked, winners)
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = resolve(staged(digests(docs, id_col, text_col), "digests"), "digest", "id", "row").where("row <> keep_row")
    gone = found.select("id", F.col("digest").alias("key"), F.col("id").eqNullSafe(F.col("keep_id")).alias("once"))
    return drop_rows(docs, gone, id_col, _digest(text_col))
