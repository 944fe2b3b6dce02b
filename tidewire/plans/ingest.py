"""Captures to stored rows, metrics and control tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.operators import files as inputs
from tidewire.operators import maintenance
from tidewire.operators.enrich import Enricher
from tidewire.operators.matching import TIMEOUT_MS, match_files
from tidewire.operators.metrics import all_metrics, flush, merge
from tidewire.operators.routing import explode_messages, split
from tidewire.operators.rows import dns_rows, icmp_rows
from tidewire.plans import ddl
from tidewire.schema import LEDGER_SCHEMA
from tidewire.sources import pcap, sink
from tidewire.sources.storage import Storage


@dataclass
class Settings:
    server: str = "default"
    privacy: bool = False
    icmp: bool = True
    tcp: bool = True
    timeout_ms: int = TIMEOUT_MS
    skip_newest: bool = False
    enrichers: list[Enricher] = field(default_factory=list)
    resolver: Enricher | None = None
    suffixes: DataFrame | None = None


@dataclass
class Result:
    dns: DataFrame
    icmp: DataFrame
    metrics: DataFrame
    pending: DataFrame | None
    files: list[str]
    rejected: DataFrame
    packets: DataFrame

    def release(self) -> None:
        """Let go of the rows that are kept for this result; after that it is computed anew."""
        for kept in (self.packets, self.dns, self.icmp):
            kept.unpersist()


def choose(spark: SparkSession, folder: str, ledger: DataFrame | None, settings: Settings) -> dict[str, str]:
    """Names and paths of the files to read, in order: new ones, without the newest if it may still be written."""
    found = inputs.discover(spark, folder).withColumn("server", F.lit(settings.server))
    if settings.skip_newest:
        found = inputs.skip_newest(found)
    if ledger is not None:
        found = inputs.unprocessed(found, ledger)
    return {r["file"]: r["path"] for r in found.select("file", "path").orderBy("file").collect()}


def ingest(spark: SparkSession, folder: str, settings: Settings | None = None, ledger: DataFrame | None = None, pending: DataFrame | None = None) -> Result | None:
    """Read a folder's new captures; None if there are none. Nothing is written.

    ``pending`` has the queries that an earlier run left, as stored from its result.
    """
    s = settings or Settings()
    chosen = choose(spark, folder, ledger, s)
    return ingest_files(spark, chosen, s, pending) if chosen else None


def ingest_files(spark: SparkSession, chosen: dict[str, str], s: Settings, pending: DataFrame | None = None) -> Result:
    """Read the captures ``chosen`` (name: path), in the order given."""
    names = list(chosen)
    packets = pcap.read(spark, list(chosen.values()), s.server, s.tcp).persist(StorageLevel.MEMORY_AND_DISK)  # other files are not opened
    good = packets.where(F.col("error").isNull())
    dns, icmp, rejected = split(good, s.icmp, s.tcp)
    # order over files: name, then packet, then message
    messages = explode_messages(dns).withColumn("seq", F.struct("pcap_file", "seq"))
    joined, pending = match_files(messages, "pcap_file", names, s.timeout_ms, pending)
    joined = joined.persist(StorageLevel.MEMORY_AND_DISK)
    rows = dns_rows(joined, s.privacy, s.enrichers, s.suffixes, s.resolver)
    icmp_table = icmp_rows(icmp, s.privacy, s.enrichers, s.suffixes, s.resolver)
    rows, icmp_table = rows.persist(StorageLevel.MEMORY_AND_DISK), icmp_table.persist(StorageLevel.MEMORY_AND_DISK)
    return Result(rows, icmp_table, all_metrics(rows, icmp_table), pending, names, packets.where(F.col("error").isNotNull()).unionByName(rejected), packets)


def record(spark: SparkSession, result: Result, folder: str, settings: Settings, began: datetime, ended: datetime, mode: str = maintenance.NONE, archive: str | None = None) -> DataFrame:
    """Ledger rows of the run's files; with a ``mode`` the files are archived or deleted as well.

    One row per file, also for files that gave no rows, so that none is read
    again. ``rows`` counts a file's packets.
    """
    counts = result.packets.where("error IS NULL").groupBy(F.col("pcap_file").alias("file")).agg(F.count("*").alias("rows"))
    listed = inputs.discover(spark, folder).where(F.col("file").isin(result.files)).select("file", "path", "bytes")
    rows = listed.join(counts, "file", "left").select(
        F.row_number().over(Window.orderBy("file")).alias("id"),
        F.lit(began).alias("date_start"),
        F.lit(ended).alias("date_end"),
        F.lit(int((ended - began).total_seconds())).alias("time"),
        "file",
        F.lit(settings.server).alias("server"),
        "path",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.lit(mode).alias("mode"),
        "bytes",
    )
    ledger = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA.fields]).persist(StorageLevel.MEMORY_AND_DISK)
    for row in ledger.select("path").collect():  # as many as the run had files
        maintenance.archive(spark, row["path"], mode, archive)
    return ledger


def store(result: Result, root: str, database: str | None = None) -> list[DataFrame]:
    """Append both tables below ``root``; returns the partitions that they touched.

    Rows that lack a required column go to ``_rejects`` instead. With a
    ``database`` the partitions are added to its tables ``dns`` and ``icmp``.
    """
    touched = []
    for table, rows in (("dns", result.dns), ("icmp", result.icmp)):
        good, bad = sink.split_valid(rows, table)
        sink.write(good, f"{root}/{table}", table)
        if not bad.isEmpty():
            bad.write.mode("append").parquet(f"{root}/_rejects/{table}")
        touched.append(sink.partitions_of(good, table))
        if database:
            add_to_catalog(good.sparkSession, database, table, f"{root}/{table}", touched[-1])
    return touched


def add_to_catalog(spark: SparkSession, database: str, table: str, path: str, places: DataFrame) -> None:
    """Add the partitions of a stored table to the catalog; partitions that it has stay."""
    keys = ["year", "month", "day", *(["server"] if table == "dns" else [])]
    rows = places.select("path", *keys).distinct().collect()  # as many as the run touched
    ddl.add_partitions(spark, f"{database}.{table}", [({k: r[k] for k in keys}, f"{path}/{r['path']}") for r in rows])
    ddl.refresh(spark, f"{database}.{table}")


def save_state(spark: SparkSession, path: str, pending: DataFrame | None, metrics: DataFrame | None) -> None:
    """Write what the next run needs aside, then put it in place of the state before."""
    store_, new = Storage(spark), f"{path}/_new"
    store_.delete(new, recursive=True)
    for name, rows in (("pending", pending), ("metrics", metrics)):
        if rows is not None:
            rows.write.parquet(f"{new}/{name}")
    store_.delete(f"{path}/state", recursive=True)
    if not store_.move(new, f"{path}/state") and store_.exists(new):
        raise OSError(f"cannot move {new}")


def load_state(spark: SparkSession, path: str) -> tuple[DataFrame | None, DataFrame | None]:
    """(pending, metrics) as saved; a state that cannot be read is deleted, and the run starts clean."""
    store_, found = Storage(spark), []
    for name in ("pending", "metrics"):
        try:
            rows = spark.read.parquet(f"{path}/state/{name}") if store_.exists(f"{path}/state/{name}") else None
            if rows is not None:
                rows.foreach(lambda _: None)  # the whole of it can be read
            found.append(rows)
        except Exception:
            store_.delete(f"{path}/state", recursive=True)
            return None, None
    return found[0], found[1]


def run(
    spark: SparkSession,
    folder: str,
    root: str,
    settings: Settings | None = None,
    ledger: DataFrame | None = None,
    database: str | None = None,
    each: bool = False,
    stop: Callable[[], bool] = lambda: False,
    writers: tuple[Callable[[str, DataFrame], None], ...] = (),
) -> tuple[list[str], DataFrame | None]:
    """Ingest a folder's new captures, store them, carry the state: (files done, metrics of buckets that are over).

    ``each``: files are stored one by one, as they are done, and ``stop`` is asked
    between them; else all at once. ``writers`` get every table's rows as well. The
    state, pending queries and the metrics of open buckets, is kept below ``root``.
    """
    s = settings or Settings()
    chosen = choose(spark, folder, ledger, s)
    done, over = [], None
    state = f"{root}/_state/{s.server}"
    for part in [{k: v} for k, v in chosen.items()] if each else [chosen] if chosen else []:
        if stop():
            break
        pending, open_buckets = load_state(spark, state)
        result = ingest_files(spark, part, s, pending)
        store(result, root, database)
        for writer in writers:
            writer("dns", result.dns)
            writer("icmp", result.icmp)
        now = merge(open_buckets, result.metrics) if open_buckets is not None else result.metrics
        closed, still = flush(now.persist(StorageLevel.MEMORY_AND_DISK))
        save_state(spark, state, result.pending, still)
        closed.write.mode("append").parquet(f"{root}/_metrics")
        now.unpersist()
        result.release()
        done += part
    if Storage(spark).exists(f"{root}/_metrics"):
        over = spark.read.parquet(f"{root}/_metrics")
    return done, over
