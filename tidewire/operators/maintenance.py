"""Maintenance of stored partitions: compaction, removal of personal data, archiving."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.labels import append_path, compacted_name
from tidewire.functions.times import query_ts
from tidewire.schema import PERSONAL, table_schema
from tidewire.sources.storage import Storage

#: Bytes of a compacted file, about.
FILE_BYTES = 128 << 20
# What happens to an input file once it is processed.
NONE, ARCHIVE, DELETE = "NONE", "ARCHIVE", "DELETE"
#: Names that readers skip: of files that wait to be shown, and of a swap's journal.
HIDDEN, JOURNAL = "_new-", "_swap"
#: Compaction and purge never run at once.
_busy = threading.Lock()


def compacted(rows: DataFrame) -> DataFrame:
    """All columns, and ``query_ts`` from the time."""
    return rows.withColumn("query_ts", query_ts(F.col("time")))


def purged(rows: DataFrame, table: str) -> DataFrame:
    """Without personal columns; ``query_ts`` stays as it is."""
    return rows.drop(*PERSONAL[table])


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The stored table by its declared schema: columns that a file lacks are null, partition values keep their types."""
    return spark.read.schema(table_schema(table)).parquet(path)


def finish(spark: SparkSession, folder: str) -> bool:
    """Complete a swap that has its journal: delete the old files, show the new ones. True if there was one."""
    store, journal = Storage(spark), append_path(folder, JOURNAL)
    if not store.exists(journal):
        return False
    names = store.open(journal).decode().split("\n")
    for name in (n for n in names if not n.startswith(HIDDEN)):
        store.delete(append_path(folder, name))
    for name in (n for n in names if n.startswith(HIDDEN)):
        place = append_path(folder, name)
        if store.exists(place) and not store.move(place, append_path(folder, name.removeprefix(HIDDEN))):
            raise OSError(f"cannot move {place}")
    store.delete(journal)
    return True


def _swap(spark: SparkSession, root: str, place: str, rows: DataFrame, day: str, server: str) -> int:
    """Replace the files of one partition by ``rows``, which was read from them; returns the number of new files.

    The new files are written aside in full and moved in under names that readers
    skip. A journal then names them and the old ones; from there on ``finish``
    completes the swap, whoever was interrupted. No reader sees a row twice.
    """
    store, folder = Storage(spark), append_path(root, place)
    aside = append_path(root, f"_tmp/{uuid.uuid4().hex}")
    old = store.files(folder)
    n = max(1, -(-store.size(folder) // FILE_BYTES))
    moved: list[str] = []
    try:
        rows.coalesce(n).write.option("compression", "snappy").parquet(aside)  # no shuffle: one partition's files, merged
        for f in store.files(aside, (".parquet",)):
            moved.append(HIDDEN + compacted_name(day, server, uuid.uuid4().hex))
            if not store.move(f, append_path(folder, moved[-1])):
                raise OSError(f"cannot move {f}")
        store.write(append_path(folder, JOURNAL), "\n".join([*moved, *[f.rsplit("/", 1)[-1] for f in old]]))
        finish(spark, folder)
        return len(moved)
    except Exception:
        if not store.exists(append_path(folder, JOURNAL)):
            for f in moved:
                store.delete(append_path(folder, f))
        raise
    finally:
        store.delete(aside, recursive=True)


def _one(spark: SparkSession, root: str, table: str, place: str) -> DataFrame:
    """The rows of one partition, without its partition columns."""
    schema = table_schema(table, partitions=False)
    return spark.read.schema(schema).parquet(append_path(root, place))


def _parts(place: str) -> tuple[str, str]:
    values = dict(p.split("=", 1) for p in place.split("/"))
    return f"{int(values['year']):04d}{int(values['month']):02d}{int(values['day']):02d}", values.get("server", "all")


def compact(spark: SparkSession, root: str, table: str, place: str) -> int:
    """Merge a partition's files and fill ``query_ts``; returns the number of files."""
    with _busy:
        finish(spark, append_path(root, place))
        return _swap(spark, root, place, compacted(_one(spark, root, table, place)), *_parts(place))


def purge(spark: SparkSession, root: str, table: str, place: str) -> int:
    """Remove personal data from a partition; returns the number of files."""
    with _busy:
        finish(spark, append_path(root, place))
        return _swap(spark, root, place, purged(_one(spark, root, table, place), table), *_parts(place))


def run_all(places: Iterable[str], work) -> tuple[list[str], str | None]:
    """Call ``work`` on each partition, stopping at the first that fails: (done, failed)."""
    done: list[str] = []
    for place in places:
        try:
            work(place)
        except Exception:
            return done, place
        done.append(place)
    return done, None


def archive(spark: SparkSession, file: str, mode: str, folder: str | None = None) -> str | None:
    """Deal with a processed input file; returns its new path, if it still has one."""
    store = Storage(spark)
    if mode == ARCHIVE:
        target = append_path(folder, file.rsplit("/", 1)[-1])
        if not store.move(file, target):
            raise OSError(f"cannot move {file}")
        return target
    if mode == DELETE:
        store.delete(file)
        return None
    return file


def clean_archive(spark: SparkSession, folder: str, days: int) -> list[str]:
    """Delete archived files older than ``days``; returns them."""
    store = Storage(spark)
    old = store.expired(folder, days)
    for f in old:
        store.delete(f)
    return old
