"""Domain names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labels(name: Column) -> Column:
    """The name's labels, without empty ones."""
    return F.filter(F.split(name, r"\."), lambda x: x != "")


def label_count(name: Column) -> Column:
    """0 for null and for the root."""
    return F.coalesce(F.size(labels(name)), F.lit(0)) * F.when(name.isNull(), 0).otherwise(1)


def last_labels(name: Column, n: int) -> Column:
    """The last ``n`` labels in lower case; all of them if there are fewer; null for the root."""
    own = labels(F.lower(name))
    some = F.when(F.size(own) > n, F.slice(own, -n, n)).otherwise(own)
    return F.when(F.size(own) > 0, F.array_join(some, "."))


def url_host(url: Column) -> Column:
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.when(host != "", F.lower(host))


def registered_domain(df: DataFrame, name_col: str, out_col: str, suffixes: DataFrame | None = None) -> DataFrame:
    """``df`` with the registered domain of ``name_col``: the longest public suffix and one label before it.

    ``suffixes`` (column ``suffix``) is a dimension table with suffixes of two
    or three labels; any last label counts as a suffix. Each name asks for its
    two tails only, so this is two equi-joins, which are broadcast while the
    dimension stays below Spark's threshold.
    """
    if suffixes is None:
        return df.withColumn(out_col, last_labels(F.col(name_col), 2))
    known = suffixes.select(F.lower(F.regexp_replace("suffix", r"^\.|\.$", "")).alias("__suffix")).distinct()
    name = F.col(name_col)
    out = df
    for n in (2, 3):
        side = known.where(F.size(F.split("__suffix", r"\.")) == n).select(F.col("__suffix").alias(f"__s{n}"))
        out = out.join(side, last_labels(name, n) == F.col(f"__s{n}"), "left")
    n = F.size(labels(name))
    domain = (
        F.when(F.col("__s3").isNotNull() & (n > 3), last_labels(name, 4))
        .when(F.col("__s3").isNotNull() & (n == 3), F.lit(None))
        .when(F.col("__s2").isNotNull() & (n > 2), last_labels(name, 3))
        .when(F.col("__s2").isNotNull() & (n == 2), F.lit(None))
        .otherwise(last_labels(name, 2))
    )
    return out.withColumn(out_col, domain).drop("__s2", "__s3")
