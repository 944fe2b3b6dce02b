"""Captures as DataFrames.

``read`` goes through Spark's binaryFile source and so reads any file system;
``PcapDataSource`` (format ``pcap``) streams files from mounted folders without
holding a whole file. Both give one task per file, as decoding follows a file's
order, and one row with ``error`` for a file that is no capture.
"""

from __future__ import annotations

import bz2
import glob
import gzip
import io
import lzma
import os
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from tidewire.functions.labels import server_parts
from tidewire.schema import PACKET_SCHEMA
from tidewire.sources.wire import Malformed, decode

BATCH = 2_000
# Suffixes of compressed files.
OPENERS = {".gz": gzip.open, ".xz": lzma.open, ".bz2": bz2.open}
PLAIN = (".pcap",)


def opened(name: str, raw):
    """A stream of the decompressed bytes, by the name's suffix; concatenated members read on."""
    suffix = os.path.splitext(name.lower())[1]
    if suffix in OPENERS:
        return OPENERS[suffix](raw)
    if suffix not in PLAIN:
        raise Malformed(f"unknown suffix of {name}")
    return raw


def rows_of(name: str, raw, server: str | None, location: str | None, tcp: bool = True) -> Iterator[dict]:
    """Rows of one file; ``seq`` counts its packets."""
    base = {"pcap_file": name, "server": server, "server_location": location, "error": None}
    n = 0
    try:
        for row in decode(opened(name, raw), tcp):
            yield base | row | {"seq": n}
            n += 1
    except (Malformed, OSError, EOFError, lzma.LZMAError, zlib.error) as e:
        yield dict.fromkeys(PACKET_SCHEMA.names) | base | {"seq": n, "error": str(e)}


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    schema = to_arrow_schema(PACKET_SCHEMA)
    some: list[dict] = []
    for row in rows:
        some.append(row)
        if len(some) == BATCH:
            yield pa.RecordBatch.from_pylist(some, schema)
            some = []
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)


class Pieces(io.RawIOBase):
    """A stream of the bytes that an iterator gives piece by piece; one piece is held."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.rest = pieces, memoryview(b"")

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self.rest:
            piece = next(self.pieces, None)
            if piece is None:
                return 0
            self.rest = memoryview(piece)
        n = min(len(into), len(self.rest))
        into[:n], self.rest = self.rest[:n], self.rest[n:]
        return n


def decode_streams(rows: DataFrame, files: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[str, BinaryIO]]], server: str = "default", tcp: bool = True) -> DataFrame:
    """Packets of the files (name, stream) that ``files`` finds in a partition's rows; each is read before the next is asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, raw in files(batches):
            yield from _batches(rows_of(name, raw, server, None, tcp))

    parts = server_parts(F.col("server"))
    return rows.mapInArrow(run, PACKET_SCHEMA).withColumn("server_location", parts["location"])


def decode_files(files: DataFrame, server: str = "default", tcp: bool = True) -> DataFrame:
    """Packets of binaryFile rows (path, content); works for batch and streaming."""

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, BinaryIO]]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield path.rsplit("/", 1)[-1], io.BytesIO(content)

    return decode_streams(files.select("path", "content"), contents, server, tcp)


def read(spark: SparkSession, path: str | list[str], server: str = "default", tcp: bool = True) -> DataFrame:
    return decode_files(spark.read.format("binaryFile").load(path), server, tcp)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.server = options.get("server", "default")
        self.tcp = options.get("tcp", "true").lower() == "true"

    def partitions(self):
        names = sorted(glob.glob(os.path.join(self.path, "*"))) if os.path.isdir(self.path) else sorted(glob.glob(self.path))
        return [_File(p) for p in names if os.path.splitext(p)[1] in (*OPENERS, *PLAIN)]

    def read(self, partition):
        location = self.server.split("_", 1)[1] if "_" in self.server else None
        with open(partition.path, "rb") as raw:
            yield from _batches(rows_of(os.path.basename(partition.path), raw, self.server, location, self.tcp))


class PcapDataSource(DataSource):
    """``spark.read.format("pcap").option("server", name).option("tcp", "true").load(folder)``"""

    @classmethod
    def name(cls) -> str:
        return "pcap"

    def schema(self):
        return PACKET_SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PcapDataSource)
