"""Input files: discovery, order, what is new, what is old."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.operators.routing import has_suffix

# Names of input files.
SUFFIXES = [".pcap", ".pcap.gz", ".pcap.xz", ".pcap.bz2"]
GLOB = "*.{pcap,gz,xz,bz2}"


def discover(spark: SparkSession, path: str, suffixes: list[str] | None = None) -> DataFrame:
    """Files in a folder (not below it): path, file, bytes, modified. Contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", GLOB).load(path)
    listed = found.select("path", F.regexp_extract("path", "([^/]*)$", 1).alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    return listed.where(has_suffix(F.col("file"), suffixes or []))


def skip_newest(files: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Without the file whose name is last (per group): it may still be written."""
    w = Window.partitionBy(*(group or [F.lit(0)])).orderBy(F.desc("file"))
    return files.withColumn("__rank", F.row_number().over(w)).where("__rank > 1").drop("__rank")


def unprocessed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose (file, server) is not in the ledger."""
    return files.join(ledger.select("file", "server").distinct(), ["file", "server"], "left_anti")


def expired(files: DataFrame, days: int, now: Column | None = None, suffixes: list[str] | None = None) -> DataFrame:
    """Files last modified before ``now`` less ``days``."""
    limit = (now if now is not None else F.current_timestamp()) - F.make_dt_interval(days=F.lit(days))
    return files.where((F.col("modified") < limit) & has_suffix(F.col("file"), suffixes or []))
