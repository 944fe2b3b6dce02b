"""Metrics, captures and control as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire.operators.files import GLOB
from tidewire.operators.metrics import graphite_lines, row_metrics
from tidewire.sources import pcap, sink
from tidewire.sources.sink import send_graphite


def windowed(rows: DataFrame, watermark: str = "2 minutes", width: str = "60 seconds") -> DataFrame:
    """Counts per tumbling window, server and metric; a window is given out once the watermark has passed it."""
    named = row_metrics(rows).withColumn("ts", F.timestamp_seconds("bucket"))
    per = named.withWatermark("ts", watermark).groupBy(F.window("ts", width).alias("w"), "server", "metric").agg(F.count("*").cast("double").alias("value"))
    return per.select(F.unix_seconds("w.start").alias("bucket"), "server", "metric", "value")


def packets(spark: SparkSession, folder: str, server: str = "default", files_per_trigger: int = 10, archive: str | None = None, delete: bool = False) -> DataFrame:
    """Packets of captures as they arrive; done files stay, move to ``archive`` or are deleted."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    reader = reader.option("pathGlobFilter", GLOB).option("maxFilesPerTrigger", files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    elif delete:
        reader = reader.option("cleanSource", "delete")
    return pcap.decode_files(reader.load(folder), server)


def write_table(rows: DataFrame, path: str, table: str, checkpoint: str, seconds: float | None = None) -> StreamingQuery:
    """Append a stream of rows to the partitioned table; every ``seconds``, or once over what is there."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)
    return writer.foreachBatch(lambda batch, _: sink.write(batch, path, table)).start()


def write_graphite(metrics: DataFrame, prefix: str, host: str, port: int, checkpoint: str, send: Callable = send_graphite) -> StreamingQuery:
    def batch(rows: DataFrame, _: int) -> None:
        send(graphite_lines(rows, prefix), host, port)

    return metrics.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()
