"""Country, network and public resolver of addresses.

Dimensions are range tables (lo, hi: address keys of 32 hex digits; prefix_len;
values). A range's bucket is the common leading digits of lo and hi, so each
range has one bucket; an address asks for its buckets at the lengths that occur
(33 at most), an equi-join that Spark broadcasts while the dimension is below
its threshold and shuffles beyond. Only distinct addresses are looked up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.ip import cidr_bounds, ip_key

# Resolver providers in the order in which they are asked.
PROVIDERS = ("CloudFlare", "Google", "OpenDNS", "Quad9")


def ranges(dim: DataFrame) -> DataFrame:
    """``dim`` with its bucket and the bucket's length."""
    common = F.expr("coalesce(array_min(filter(sequence(1, 32), i -> substr(lo, i, 1) <> substr(hi, i, 1))) - 1, 32)")
    return dim.withColumn("__len", common).withColumn("__bucket", F.expr("substr(lo, 1, __len)"))


def lookup(addresses: DataFrame, key_col: str, dim: DataFrame, best: Column, values: dict[str, str]) -> DataFrame:
    """``values`` (column of dim -> name) of the range with the least ``best``, for each key of ``addresses`` that a range contains."""
    bucketed = ranges(dim)
    lengths = sorted(r["__len"] for r in bucketed.select("__len").distinct().collect())  # 33 at most
    asked = addresses.where(F.col(key_col).isNotNull()).select(key_col, F.explode(F.array(*[F.lit(n) for n in lengths]).cast("array<int>")).alias("__len"))
    asked = asked.withColumn("__bucket", F.expr(f"substr({key_col}, 1, __len)"))
    hit = asked.join(bucketed, ["__len", "__bucket"]).where(F.col(key_col).between(F.col("lo"), F.col("hi")))
    found = hit.groupBy(key_col).agg(F.min_by(F.struct(*[F.col(c).alias(n) for c, n in values.items()]), best).alias("__v"))
    return found.select(key_col, *[F.col(f"__v.{n}").alias(n) for n in values.values()])


def longest() -> Column:
    """Longest prefix first, ties by the range's start."""
    return F.struct((-F.col("prefix_len")).alias("p"), F.col("lo").alias("l"))


Enricher = Callable[[DataFrame, str], DataFrame]


def country(dim: DataFrame) -> Enricher:
    return lambda addresses, key: lookup(addresses, key, dim, longest(), {"country": "country"})


def network(dim: DataFrame) -> Enricher:
    return lambda addresses, key: lookup(addresses, key, dim, longest(), {"asn": "asn", "asn_organisation": "asn_organisation"})


def resolver(dim: DataFrame) -> Enricher:
    """The first provider, by priority, one of whose prefixes holds the address."""
    order = F.struct(F.col("priority").alias("p"), F.col("lo").alias("l"))
    return lambda addresses, key: lookup(addresses, key, dim, order, {"name": "pub_resolver"})


def enrich(df: DataFrame, address_col: str, prefix: str, enrichers: Iterable[Enricher], source: DataFrame | None = None) -> DataFrame:
    """``df`` with the enrichers' columns, named with ``prefix``, for the address in ``address_col``.

    Leave the resolver out of ``enrichers`` where it does not apply. ``source``
    has all the addresses and is cheaper to read than ``df``, if given. The
    distinct addresses are kept (in memory, else on disk) for all enrichers.
    """
    distinct = (df if source is None else source).select(F.col(address_col).alias("__address")).where("__address is not null").distinct()
    info = distinct.withColumn("__key", ip_key(F.col("__address"))).persist(StorageLevel.MEMORY_AND_DISK)
    keys = info.where("__key is not null").select("__key").distinct()
    named = info
    for enricher in enrichers:
        found = enricher(keys, "__key")
        named = named.join(found.select("__key", *[F.col(c).alias(f"{prefix}{c}") for c in found.columns if c != "__key"]), "__key", "left")
    return df.join(named.drop("__key"), F.col(address_col) == F.col("__address"), "left").drop("__address")


def resolver_dim(spark: SparkSession, prefixes: dict[str, list[str]]) -> DataFrame:
    """Range table of providers' prefixes; providers outside the fixed order come last, by name."""
    order = [*PROVIDERS, *sorted(set(prefixes) - set(PROVIDERS))]
    rows = [(order.index(name), name, cidr, *cidr_bounds(cidr)) for name, cidrs in prefixes.items() for cidr in cidrs]
    return spark.createDataFrame(rows, "priority int, name string, cidr string, lo string, hi string, prefix_len int")
