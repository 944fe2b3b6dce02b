"""Mixing sources to target weights by a low-discrepancy schedule (native DataFrame operations only).

Each source's documents are laid end to end in a fixed shuffled order (by MD5
of the id) and cut into blocks of ``block`` words. Targets come from
water-filling: sources share ``share`` times all words by weight, none above
``most`` times its own words. A source with target T takes the first T words of
its endlessly repeated line, so it needs n_s slots.

The schedule: with N = sum of n_s and 2**m >= N, slot i has the golden-ratio
point j = i * A mod 2**m (A odd, nearest to 2**m / phi: a permutation of the
grid). Points at or above N are unused; the others go through the cumulative
n_s to a source, which therefore gets exactly n_s slots, evenly spread. Slots
are ranked within their source, and rank r joins block r mod (number of blocks).

No step gathers a source: ranks and prefix sums are taken in small buckets, and
bucket totals are summed over buckets.

Defined cases: null or blank text has size 0 and is never taken; a null source
is a source of its own, the last; a null id sorts as the empty string; repeated
rows are documents of their own; an empty table gives an empty result; a source
without words has target 0; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, prefix_sum, staged

#: Words in a block.
BLOCK = 256
#: Source weights by rank, repeating.
WEIGHTS = (5, 2, 1)
#: Words that the mix takes, as a share of all words, and as most repeats of one source.
SHARE, MOST = 1.5, 2
#: Rows that a bucket of the prefix sums holds, about.
BUCKET = 512
#: Fixed value: the golden ratio.
PHI = 1.618033988749895


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Columns id, source, size (words), key (of the text)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.col(text_col)).alias("key"),
    )


def targets(rows: DataFrame, share: float = SHARE, most: int = MOST, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK) -> DataFrame:
    """One row per source: sid (rank), source_size, target, take (words), n_blocks, n_slots, first (slots of the sources before).

    Water-filling in closed form: in the order of cap per weight, the level
    that remains when the sources before are capped is largest just where the
    capping stops, so the common level is the maximum.
    """
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    ranked = by_source.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    w = ranked.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("w"), "sid")
    everyone = Window.partitionBy()
    level = w.withColumn("total", F.sum("source_size").over(everyone) * F.lit(float(share))).withColumn(
        "level",
        (F.col("total") - (F.sum("cap").over(order) - F.col("cap"))) / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)),
    )
    out = level.withColumn("target", F.least("cap", F.col("w") * F.max("level").over(everyone)))
    size, take = F.col("source_size"), F.col("take")
    out = out.withColumn("take", F.floor("target")).withColumn("n_blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
    out = out.withColumn("n_slots", F.when(size > 0, F.expr("take div source_size") * F.col("n_blocks") + F.expr(f"(take % source_size + {block - 1}) div {block}")).otherwise(F.lit(0)).cast("long"))
    return out.withColumn("first", F.sum("n_slots").over(Window.orderBy("sid")) - F.col("n_slots")).select(
        "source", "sid", "source_size", "docs", "target", "take", "n_blocks", "n_slots", "first"
    )


def slots(spark, goals: DataFrame, n: int, block: int = BLOCK) -> DataFrame:
    """The schedule: position, sid, rank (within the source), block_no, quota (words that the slot takes)."""
    bits = max(1, (max(n, 1) - 1).bit_length())
    step = int((1 << bits) / PHI) | 1
    wide = 1024
    points = spark.range(1 << bits).select(
        F.col("id").alias("position"),
        (F.col("id").cast("decimal(19,0)") * F.lit(step).cast("decimal(19,0)") % F.lit(1 << bits).cast("decimal(19,0)")).cast("long").alias("point"),
    ).where(F.col("point") < n)
    spans = goals.where("n_slots > 0").withColumn("cell", F.explode(F.expr(f"sequence(first div {wide}, (first + n_slots - 1) div {wide})")))
    placed = points.withColumn("cell", F.expr(f"point div {wide}")).join(spans, "cell").where("point >= first and point < first + n_slots")
    ranked = prefix_sum(placed.withColumn("__chunk", F.expr(f"position div {BUCKET}")), ["sid"], "__chunk", ["position"], F.lit(1), "rank")
    rest = F.col("take") % F.col("source_size") % F.lit(block)
    return ranked.select(
        "position", "sid", "rank",
        (F.col("rank") % F.col("n_blocks")).alias("block_no"),
        F.when((F.col("rank") == F.col("n_slots") - 1) & (rest > 0), rest).otherwise(F.lit(block)).alias("quota"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, taken, key."""
    spark = docs.sparkSession
    rows = staged(sizes(docs, id_col, text_col, source_col), "sizes")
    goals = staged(targets(rows, block=block), "targets")
    n, count = goals.agg(F.coalesce(F.sum("n_slots"), F.lit(0)), F.coalesce(F.sum("docs"), F.lit(0))).first()
    buckets = 1 << max(0, (count // BUCKET).bit_length())
    known = rows.join(goals.select(F.col("source").alias("__s"), "sid", "source_size", "target"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    known = known.withColumn("shuffle", F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))))
    known = known.withColumn("__bucket", F.expr(f"(cast(conv(substr(shuffle, 1, 8), 16, 10) as bigint) * {buckets}) div 4294967296"))
    lined = prefix_sum(known, ["sid"], "__bucket", ["shuffle", "size", "key"], F.col("size"), "start")
    pieces = lined.where("size > 0").withColumn("block_no", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
    edge = F.col("block_no") * block
    pieces = pieces.select("sid", "start", "block_no", F.greatest(F.lit(0), F.col("start") - edge).alias("lo"), F.least(F.lit(block), F.col("start") + F.col("size") - edge).alias("hi"))
    taken = pieces.join(slots(spark, goals, n, block), ["sid", "block_no"]).groupBy("sid", "start").agg(
        F.sum(F.greatest(F.lit(0), F.least("hi", "quota") - F.col("lo"))).cast("long").alias("taken")
    )
    empty = lined.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    full = lined.where("size > 0").join(taken, ["sid", "start"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    return full.unionByName(empty).select(F.col("id").alias(id_col), "size", "source_size", "target", "taken", "key")


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it, the nearest whole number of times; columns unchanged.

    Only a source's last document can be taken in part, so this is within half
    a document per source of the words that the mix takes.
    """
    taken = mix(docs, id_col, text_col, source_col)
    per = taken.where("taken > 0").groupBy(F.col(id_col).alias("__id"), F.col("key").alias("__key"), F.col("size").alias("__size")).agg(F.avg("taken").alias("__taken"))
    copies = per.select("__id", "__key", F.expr("cast(__taken / __size + 0.5 as int)").alias("__times")).where("__times > 0")
    tagged = docs.withColumn("__tag", F.xxhash64(text_col))
    hit = tagged.join(copies, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__tag") == F.col("__key")))
    return hit.withColumn("__nth", F.explode(F.expr("sequence(1, __times)"))).select(*docs.columns)
