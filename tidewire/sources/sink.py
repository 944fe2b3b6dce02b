"""Writing tables and metrics."""

from __future__ import annotations

import socket
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.labels import partition_path, server_partition
from tidewire.functions.times import partition_columns
from tidewire.schema import DNS_SCHEMA, ICMP_SCHEMA, PARTITIONS

# Parquet settings.
ROW_GROUP_BYTES, PAGE_ROWS = 128 << 20, 20_000


def with_partitions(rows: DataFrame, table: str) -> DataFrame:
    """``rows`` with year, month, day and (dns) server in path form; icmp keeps its server column as data."""
    out = rows.withColumns(partition_columns(F.col("time")))
    return out.withColumn("server", server_partition(F.col("server"))) if table == "dns" else out


def split_valid(rows: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows that have every required column, the others)."""
    required = [f.name for f in {"dns": DNS_SCHEMA, "icmp": ICMP_SCHEMA}[table].fields if not f.nullable]
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required], F.lit(True))
    return rows.where(whole), rows.where(~whole)


def write(rows: DataFrame, path: str, table: str, mode: str = "append", max_records: int = 0) -> None:
    """Append to the partitioned table; Spark's committer shows files only when they are whole.

    Rows meet by partition first, so a partition gets few files; adaptive
    execution rolls large ones over at its advisory size. ``max_records`` rolls
    files over by rows.
    """
    placed = with_partitions(rows, table).drop("dns_query", "dns_response").hint("rebalance", *PARTITIONS[table])
    writer = placed.write.mode(mode).partitionBy(*PARTITIONS[table]).option("compression", "snappy")
    writer = writer.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.row.count.limit", PAGE_ROWS)
    (writer.option("maxRecordsPerFile", max_records) if max_records else writer).parquet(path)


def partitions_of(rows: DataFrame, table: str) -> DataFrame:
    """The partitions that ``rows`` fall into: table_name, path, year, month, day, server."""
    own = with_partitions(rows, table)
    server = F.col("server") if table == "dns" else F.lit(None).cast("string")
    own = own.select("year", "month", "day", server.alias("server")).distinct()
    path = partition_path(table, F.col("year"), F.col("month"), F.col("day"), F.col("server") if table == "dns" else None)
    return own.select(F.lit(table).alias("table_name"), path.alias("path"), "year", "month", "day", "server")


def send_graphite(lines: DataFrame, host: str, port: int, timeout: float = 10.0) -> None:
    """Send plaintext lines, each partition over its own connection."""

    def send(rows) -> None:
        with socket.create_connection((host, port), timeout) as s:
            for row in rows:
                s.sendall(f"{row['value']}\n".encode())

    lines.foreachPartition(send)
