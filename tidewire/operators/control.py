"""Control tables: the ledger of processed files and the table of partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.times import elapsed_seconds
from tidewire.schema import PARTITION_SCHEMA

KEY = ["table_name", "path"]
PLACE = ["year", "month", "day", "server"]


def upsert(known: DataFrame, seen: DataFrame, now: Column, engine: str) -> DataFrame:
    """``known`` with the partitions in ``seen`` (table_name, path, year, month, day, server): new ones are added, others touched."""
    new = seen.select(*KEY, *PLACE).distinct().select(*[F.col(c).alias(c if c in KEY else f"__{c}") for c in [*KEY, *PLACE]], F.lit(True).alias("__seen"))
    both = known.join(new, KEY, "full_outer")
    fresh = F.col("id").isNull()
    top = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).scalar()
    # ids of new partitions follow the largest one, in order of table and path
    numbers = new.join(known, KEY, "left_anti").select(*KEY)
    numbered = numbers.withColumn("__n", F.row_number().over(_order()))
    out = both.join(numbered, KEY, "left").withColumns(
        {c: F.coalesce(c, f"__{c}") for c in PLACE}
        | {
            "id": F.coalesce("id", top + F.col("__n")),
            "engine": F.coalesce("engine", F.lit(engine)),
            "created": F.coalesce("created", now),
            "updated_ts": F.when(F.col("__seen") | fresh, now).otherwise(F.col("updated_ts")),
        }
    )
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PARTITION_SCHEMA.fields])


def _order():
    from pyspark.sql import Window

    return Window.orderBy(*KEY)


def ping(known: DataFrame, seen: DataFrame, now: Column) -> DataFrame:
    """``known`` with the partitions in ``seen`` touched; none is added."""
    marked = known.join(seen.select(*KEY).distinct().withColumn("__seen", F.lit(True)), KEY, "left")
    return marked.withColumn("updated_ts", F.when(F.col("__seen"), now).otherwise(F.col("updated_ts"))).select(*known.columns)


def uncompacted(known: DataFrame, engine: str) -> DataFrame:
    return known.where(F.col("compaction_ts").isNull() & F.col("compaction_ok").isNull() & (F.col("engine") == engine)).orderBy("id")


def unpurged(known: DataFrame, engine: str, day: Column, up_to: bool = False) -> DataFrame:
    """Partitions of exactly that day that were never purged, by id; with ``up_to`` also those of earlier days."""
    own = F.make_date("year", "month", "day")
    when = own <= day if up_to else own == day
    return known.where(F.col("privacy_purge_ts").isNull() & (F.col("engine") == engine) & when).orderBy("id")


def due(known: DataFrame, now: Column, quiet: Column) -> DataFrame:
    """Partitions of days before today that were not touched for ``quiet`` (an interval): to compact."""
    return known.where((F.make_date("year", "month", "day") < now.cast("date")) & (F.col("updated_ts") + quiet < now))


def due_for_purge(known: DataFrame, now: Column) -> DataFrame:
    return due(known, now, F.make_dt_interval(days=F.lit(1)))


def mark(known: DataFrame, ids: list[int] | DataFrame, what: str, start: Column, end: Column, ok: bool) -> DataFrame:
    """``known`` with the result of a compaction or privacy_purge; failed ones are marked too, and so not tried again.

    ``ids``: a list, or a table with column id.
    """
    if isinstance(ids, DataFrame):
        asked = ids.select("id").distinct().withColumn("__hit", F.lit(True))
        marked = _marked(known.join(asked, "id", "left"), F.coalesce("__hit", F.lit(False)), what, start, end, ok)
        return marked.select(*known.columns)
    return _marked(known, F.col("id").isin(ids), what, start, end, ok)


def _marked(known: DataFrame, hit: Column, what: str, start: Column, end: Column, ok: bool) -> DataFrame:
    took = elapsed_seconds(start, end)
    cols = {f"{what}_ts": end, f"{what}_time": took, f"{what}_ok": F.lit(ok)}
    return known.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in cols.items()})


def find_file(ledger: DataFrame, file: str, server: str) -> DataFrame:
    return ledger.where((F.col("file") == file) & (F.col("server") == server))


def find_partition(known: DataFrame, table: str, path: str) -> DataFrame:
    return known.where((F.col("table_name") == table) & (F.col("path") == path))


def forget(ledger: DataFrame, days: int, now: Column) -> DataFrame:
    """The ledger without rows that started more than ``days`` ago."""
    return ledger.where(F.col("date_start") >= now - F.make_dt_interval(days=F.lit(days)))
