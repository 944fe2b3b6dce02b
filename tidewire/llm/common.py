"""Helpers that several operators share."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The 26 letters that case folding touches.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Rows in an Arrow batch, at most.
BATCH_ROWS = 256
#: Rows (id and digest, about 100 bytes each) that are broadcast to drop rows, at most.
MOST_BROADCAST = 250_000
#: Fixed value: a word, as every contract here defines it.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` decides. Where it is unset, a local master gets a
    temporary folder and any other master a folder in the warehouse.
    """
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not known:
        local = sc.master.split("[")[0] == "local"
        known = tempfile.mkdtemp(prefix="tidewire-") if local else spark.conf.get("spark.sql.warehouse.dir") + "/_staged"
        sc.setCheckpointDir(known)
    return known.rstrip("/")


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def staged(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage, survives lost executors, and gives the reread table
    a known size, which broadcast decisions then rest on. The folder goes when
    the application ends, or earlier in ``discard``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    system, place = _system(spark, path)
    system.deleteOnExit(place)
    for made in _scopes:
        made.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of a few rows (columns of int, long, double or string), made without Python workers."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string()}
    named = [(name, kinds[kind]) for name, kind in (column.split() for column in schema.split(","))]
    columns = list(zip(*rows, strict=True)) or [()] * len(named)
    return spark.createDataFrame(pa.table({name: pa.array(values, kind) for (name, kind), values in zip(named, columns, strict=True)}))


def discard(df: DataFrame) -> None:
    """Delete a staged table that nothing will read again."""
    system, place = _system(df.sparkSession, df._staged_at)
    system.delete(place, True)


#: Paths that are staged while a block of ``scratch`` runs; the innermost block is last.
_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """On leaving the block, delete what was staged in it but for the tables added to the yielded list."""
    made, keep = [], []
    _scopes.append(made)
    try:
        yield keep
    finally:
        _scopes.remove(made)
        kept = {df._staged_at for df in keep}
        for path in made:
            if path not in kept:
                system, place = _system(spark, path)
                system.delete(place, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and leave everything else alone."""
    return F.translate(text, UPPER, LOWER)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after bounding the rows that Python workers of its session get at once, so that whole texts fit in their memory."""
    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def _show_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever the working folder."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _show_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_rows(docs: DataFrame, gone: DataFrame, id_col: str, key: Column, most: int = MOST_BROADCAST) -> DataFrame:
    """``docs`` without the rows that ``gone`` (id, key, once) names; columns unchanged.

    ``key`` tells texts under one id apart. Rows with ``once`` are reduced to
    one instead. ``gone`` is counted first: up to ``most`` rows are broadcast, so
    texts are not shuffled; a longer list is joined by shuffling.
    """
    gone = staged(gone.select(F.col("id").alias("__id"), F.col("key").alias("__want"), "once").distinct(), "gone")
    n = {r["once"]: r["n"] for r in gone.groupBy("once").agg(F.count("*").alias("n")).collect()}
    if not n:
        return docs
    same = F.col(id_col).eqNullSafe(F.col("__id")) & F.col("__key").eqNullSafe(F.col("__want"))
    side = lambda once: (F.broadcast if n[once] <= most else lambda x: x)(gone.where(F.col("once") == once).drop("once"))
    left = docs.withColumn("__key", key)
    if n.get(False):
        left = left.join(side(False), same, "left_anti")
    if n.get(True):
        first = left.join(side(True), same, "left_semi").dropDuplicates([id_col, "__key"])
        left = left.join(side(True), same, "left_anti").unionByName(first)
    return left.select(*docs.columns)


def prefix_sum(rows: DataFrame, group: list[str], bucket: str, order: list, amount: Column, name: str) -> DataFrame:
    """``rows`` with the sum of ``amount`` over the rows before, within ``group`` in order of (bucket, order).

    Two levels: bucket totals are summed over buckets, rows only within their
    bucket, so a large group is spread over as many tasks as it has buckets.
    """
    per = rows.groupBy(*group, bucket).agg(F.sum(amount).alias("__sum"))
    before = per.withColumn("__before", F.sum("__sum").over(Window.partitionBy(*group).orderBy(bucket)) - F.col("__sum")).drop("__sum")
    inner = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("__in", F.sum(amount).over(inner) - amount)
    return local.join(before, [*group, bucket]).withColumn(name, F.col("__before") + F.col("__in")).drop("__before", "__in")
