"""Queries meet responses.

Input is one row per DNS message with at least: ``seq`` (order), ``time`` (ms),
``qr`` (0 query, 1 response), ``id``, ``qname`` (null without a question),
``qtype``, ``client`` and ``port`` (of the client side). Any other columns ride
along.

A response takes the latest pending query of its key (id, qname, client, port);
a repeated query replaces the pending one but keeps the time of the first; what
is still pending when a file ends expires once that time is ``timeout`` before
the last message. In windows over the key this is: a response whose predecessor
is a query is a pair; any other response stands alone; a query whose successor
is a query is lost; a query without a successor is pending.

Both steps hash-partition by (id, client, port), which also serves the longer
key, so the plan has one shuffle.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Milliseconds that a query stays pending.
TIMEOUT_MS = 2000
# Zone transfer query types.
AXFR, IXFR = 252, 251
FLOW = ["id", "client", "port"]
KEY = ["id", "client", "port", "qname"]
PENDING_COLUMNS = ["__run_start"]
#: The file that ends a run which no file ends.
NEVER = 2_147_483_647


def suppress_zone_transfers(messages: DataFrame, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Without the second and later responses that follow a zone transfer query of the same (id, client, port)."""
    so_far = Window.partitionBy(*FLOW).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    starts = ((F.col("qr") == 0) & F.coalesce(F.col("qtype").isin(AXFR, IXFR), F.lit(False))).cast("int")
    marked = messages.withColumn("__epoch", F.sum(starts).over(so_far))
    within = Window.partitionBy(*FLOW, "__epoch").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = marked.withColumn("__nth", F.sum(F.col("qr")).over(within))
    return ranked.where((F.col("qr") == 0) | (F.col("__epoch") == 0) | (F.col("__nth") <= 1)).drop("__epoch", "__nth")


def last_time(messages: DataFrame) -> Column:
    """Time of the last message in order (not the latest time), as a scalar subquery."""
    return messages.agg(F.max_by("time", "seq").alias("last")).scalar()


def classify(messages: DataFrame) -> DataFrame:
    """``messages`` with ``__kind`` (pair, response, pending or null), ``__before`` (the query of a pair) and ``__run_start``."""
    own = [c for c in messages.columns if c not in PENDING_COLUMNS]
    by_key = Window.partitionBy(*KEY).orderBy("seq")
    start = F.coalesce(F.col("__run_start"), F.col("time")) if "__run_start" in messages.columns else F.col("time")
    rows = messages.withColumn("__start", start).withColumn("__before", F.lag(F.struct(*own)).over(by_key)).withColumn("__after", F.lead("qr").over(by_key))
    answered = F.sum("qr").over(by_key.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("__run", answered)
    first = F.first("__start").over(Window.partitionBy(*KEY, "__run", "qr").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0))
    kind = (
        F.when((F.col("qr") == 1) & (F.col("__before.qr") == 0), "pair")
        .when((F.col("qr") == 1) & F.col("qname").isNotNull(), "response")
        .when((F.col("qr") == 0) & F.col("__after").isNull(), "pending")
    )
    return rows.withColumn("__kind", kind).withColumn("__run_start", first).drop("__start", "__after", "__run")


def match(messages: DataFrame, timeout_ms: int = TIMEOUT_MS, pending: DataFrame | None = None, transfers: bool = True) -> tuple[DataFrame, DataFrame]:
    """(joined, pending) of one file or of a table read as one file.

    ``joined`` has ``request`` and ``response`` structs, either of them null,
    and ``expired``. ``pending`` has the queries that stay for the next file;
    pass it to the next call. Expired queries without a question are removed
    and not returned. ``transfers=False`` skips zone transfer suppression, which
    looks at all files of a run and not at each.
    """
    return _match_one(suppress_zone_transfers(messages) if transfers else messages, messages, timeout_ms, pending)


def match_files(messages: DataFrame, file_col: str, files: list[str], timeout_ms: int = TIMEOUT_MS, pending: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(joined, pending) of several files in order; queries stay pending across files, and from an earlier run in ``pending``.

    One plan for all files. A run of repeated queries ends in the first file, its
    own or a later one, whose last message is more than the timeout after the
    run's first query; what of its key comes in later files starts a new run.
    Only keys whose queries, unanswered, lie in several files need to be followed
    from file to file, in an array of one entry a file.
    """
    spark = messages.sparkSession
    order = F.broadcast(spark.createDataFrame([(i, name) for i, name in enumerate(files)], "__f int, __name string"))
    own = [c for c in messages.columns if c not in PENDING_COLUMNS]
    every = messages.join(order, F.col(file_col) == F.col("__name")).select(*own, "__f")
    ends = every.groupBy("__f").agg(F.max_by("time", "seq").alias("last"))
    placed = order.join(ends, "__f", "left").agg(F.sort_array(F.collect_list(F.struct("__f", "last"))).alias("e"))
    lasts = placed.select(F.transform("e", lambda x: x["last"])).scalar()  # of a file without messages: null

    rows = suppress_zone_transfers(every, ("__f", "seq")).withColumn("__run_start", F.lit(None).cast("bigint"))
    if pending is not None:
        rows = rows.unionByName(pending.withColumn("__f", F.lit(-1)))
    by_key = Window.partitionBy(*KEY).orderBy("__f", "seq")
    rows = rows.withColumn("__start", F.coalesce("__run_start", "time")).withColumn("__run", F.sum("qr").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    # the first query of a run in a file, and the file that would end the run if it began there
    in_file = Window.partitionBy(*KEY, "__run", "qr", "__f").orderBy("seq")
    rows = rows.withColumn("__nth", F.row_number().over(in_file)).withColumn("__first", F.first("__start").over(in_file.rowsBetween(Window.unboundedPreceding, 0)))
    late = lambda last: F.coalesce(last > F.col("__first") + timeout_ms, F.lit(False))
    here = F.when(F.col("__f") >= 0, F.get("__lasts", F.col("__f")))
    later = F.array_position(F.transform(F.slice("__lasts", F.col("__f") + 2, F.lit(len(files))), late), F.lit(True))
    end = F.when(late(here), F.col("__f")).otherwise(F.when(later > 0, F.col("__f") + later.cast("int")).otherwise(F.lit(NEVER)))
    rows = rows.withColumn("__lasts", lasts).withColumn("__end", F.when(F.col("qr") == 0, end)).drop("__lasts")
    mine = F.struct(F.col("__f").alias("f"), F.col("__first").alias("first"), F.col("__end").alias("end"))
    all_files = Window.partitionBy(*KEY, "__run", "qr")
    rows = rows.withColumn("__files", F.collect_list(F.when(F.col("__nth") == 1, mine)).over(all_files))
    ahead = lambda heads, x: F.when((F.size(heads) == 0) | (x["f"] > F.try_element_at(heads, F.lit(-1))["end"]), F.concat(heads, F.array(x))).otherwise(heads)
    heads = F.aggregate(F.sort_array("__files"), F.array().cast("array<struct<f:int,first:bigint,end:int>>"), ahead)
    head = F.when(F.size("__files") == 1, F.col("__files")[0]).otherwise(F.try_element_at(F.filter(heads, lambda h: h["f"] <= F.col("__f")), F.lit(-1)))
    rows = rows.withColumn("__head", F.when(F.col("qr") == 0, head)).drop("__files", "__nth", "__first", "__end", "__start", "__run")
    # each message and its neighbours
    before = F.lag(F.struct(*own)).over(by_key)
    rows = rows.withColumns({"__before": before, "__till": F.lag("__head.end").over(by_key), "__next": F.lead("qr").over(by_key), "__next_f": F.lead("__f").over(by_key)})
    stays = F.col("__next").isNull() | (F.col("__next_f") > F.col("__head.end"))  # no message of the key ends the run
    kind = (
        F.when((F.col("qr") == 1) & (F.col("__before.qr") == 0) & (F.col("__f") <= F.col("__till")), "pair")
        .when((F.col("qr") == 1) & F.col("qname").isNotNull(), "response")
        .when((F.col("qr") == 0) & stays, F.when(F.col("__head.end") == NEVER, "pending").otherwise("expired"))
    )
    found = rows.withColumn("__kind", kind).where("__kind IS NOT NULL").persist(StorageLevel.MEMORY_AND_DISK)
    me, none = F.struct(*own), F.lit(None)
    is_ = lambda k: F.col("__kind") == k
    joined = found.where(is_("pair") | is_("response") | is_("expired") & F.col("qname").isNotNull()).select(
        F.when(is_("pair"), F.col("__before")).when(is_("expired"), me).otherwise(none).alias("request"),
        F.when(~is_("expired"), me).otherwise(none).alias("response"),
        is_("expired").alias("expired"),
    )
    return joined, found.where(is_("pending")).select(*own, F.col("__head.first").alias("__run_start"))


def _match_one(clean: DataFrame, every: DataFrame, timeout_ms: int, pending: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    own = [c for c in every.columns if c not in PENDING_COLUMNS]
    rows = clean.withColumn("__run_start", F.lit(None).cast("bigint"))
    found = classify(rows.unionByName(pending) if pending is not None else rows)
    last = last_time(every)
    late = F.col("__run_start") < last - F.lit(timeout_ms)
    me, none = F.struct(*own), F.lit(None)
    given = F.col("__kind").isin("pair", "response") | ((F.col("__kind") == "pending") & late & F.col("qname").isNotNull())
    joined = found.where(given).select(
        F.when(F.col("__kind") == "pair", F.col("__before")).when(F.col("__kind") == "pending", me).otherwise(none).alias("request"),
        F.when(F.col("__kind") != "pending", me).otherwise(none).alias("response"),
        (F.col("__kind") == "pending").alias("expired"),
    )
    return joined, found.where((F.col("__kind") == "pending") & (~late | last.isNull())).select(*own, "__run_start")
