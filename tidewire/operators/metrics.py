"""Time-series metrics over rows of the dns and icmp tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.labels import metric_name
from tidewire.functions.times import RETENTION, bucket
from tidewire.operators.routing import UDP

# Metric names.
QUERY, RESPONSE = "dns.query", "dns.response"
QTYPE, RCODE, OPCODE = "dns.request.qtype", "dns.request.rcode", "dns.request.opcode"
TCP_COUNT, UDP_COUNT, ICMP_COUNT = "tcp", "udp", "icmp"
IPV4, IPV6, COUNTRY = "ip.4", "ip.6", "geo.country"
RTT, RTT_SAMPLES = "tcp.rtt.handshake.avg", "tcp.rtt.handshake.samples"


def _named(name: str, suffix: Column) -> Column:
    return F.concat(F.lit(f"{name}."), suffix.cast("string"))


def row_metrics(rows: DataFrame) -> DataFrame:
    """One row per metric that a dns row counts in: bucket, server, metric (array element), from one pass.

    ``rows`` needs time, prot, ipv, qtype, rcode, opcode, country, dns_query and
    dns_response.
    """
    names = F.filter(
        F.array(
            F.when(F.col("dns_query"), F.lit(QUERY)),
            F.when(F.col("dns_response"), F.lit(RESPONSE)),
            _named(QTYPE, F.coalesce("qtype", F.lit(0))),
            _named(RCODE, F.col("rcode")),
            _named(OPCODE, F.col("opcode")),
            _named(COUNTRY, F.coalesce("country", F.lit("null"))),
            F.when(F.col("prot") == UDP, UDP_COUNT).otherwise(TCP_COUNT),
            F.when(F.col("ipv") == 4, IPV4).otherwise(IPV6),
        ),
        lambda x: x.isNotNull(),
    )
    return rows.select(bucket(F.col("time")).alias("bucket"), "server", F.explode(names).alias("metric"))


def counts(rows: DataFrame) -> DataFrame:
    """bucket, server, metric, value of all counters of dns rows; partial sums before the shuffle."""
    return row_metrics(rows).groupBy("bucket", "server", "metric").agg(F.count("*").cast("double").alias("value"))


def _average_rows(per: DataFrame) -> DataFrame:
    """One row for the average and one for the number of its samples."""
    pair = F.array(F.struct(F.lit(RTT).alias("metric"), F.col("avg").alias("value")), F.struct(F.lit(RTT_SAMPLES).alias("metric"), F.col("n").alias("value")))
    return per.select("bucket", "server", F.inline(pair))


def handshakes(rows: DataFrame) -> DataFrame:
    """Average TCP handshake time and its number of samples."""
    seen = rows.where((F.col("prot") != UDP) & F.col("tcp_hs_rtt").isNotNull() & (F.col("tcp_hs_rtt") != -1))
    per = seen.groupBy(bucket(F.col("time")).alias("bucket"), "server").agg(F.avg("tcp_hs_rtt").alias("avg"), F.count("*").cast("double").alias("n"))
    return _average_rows(per)


def icmp_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(bucket(F.col("time")).alias("bucket"), "server").agg(F.count("*").cast("double").alias("value")).select("bucket", "server", F.lit(ICMP_COUNT).alias("metric"), "value")


def all_metrics(dns: DataFrame, icmp: DataFrame | None = None) -> DataFrame:
    out = counts(dns).unionByName(handshakes(dns))
    return out if icmp is None else out.unionByName(icmp_counts(icmp))


def merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Earlier and later parts of the same buckets: sums add up, averages weigh by their samples."""
    both = old.unionByName(new)
    plain = both.where(~F.col("metric").isin(RTT, RTT_SAMPLES)).groupBy("bucket", "server", "metric").agg(F.sum("value").alias("value"))
    pairs = old.select("*", F.lit(0).alias("__part")).unionByName(new.select("*", F.lit(1).alias("__part"))).where(F.col("metric").isin(RTT, RTT_SAMPLES))
    wide = pairs.groupBy("bucket", "server", "__part").agg(
        F.max(F.when(F.col("metric") == RTT, F.col("value"))).alias("avg"), F.max(F.when(F.col("metric") == RTT_SAMPLES, F.col("value"))).alias("n")
    )
    total = wide.groupBy("bucket", "server").agg((F.sum(F.col("avg") * F.col("n")) / F.sum("n")).alias("avg"), F.sum("n").alias("n"))
    return plain.unionByName(_average_rows(total))


def flush(metrics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all buckets but each series' newest, the newest ones, which stay for the next run)."""
    newest = F.max("bucket").over(Window.partitionBy("server", "metric"))
    marked = metrics.withColumn("__newest", newest)
    return marked.where("bucket < __newest").drop("__newest"), marked.where("bucket = __newest").drop("__newest")


def top(metrics: DataFrame, name: str, n: int = 10) -> DataFrame:
    """The ``n`` series below ``name`` with the largest totals, ties by series."""
    per = metrics.where(F.startswith("metric", F.lit(f"{name}."))).groupBy("metric").agg(F.sum("value").alias("total"))
    return per.orderBy(F.desc("total"), "metric").limit(n)


def consolidate(metrics: DataFrame, seconds: int) -> DataFrame:
    """Averages over wider buckets, of series that never are zero or less."""
    wide = metrics.withColumn("wide", F.col("bucket") - F.pmod("bucket", F.lit(seconds)))
    per = wide.groupBy("server", "metric", "wide").agg(F.avg("value").alias("value"))
    least = per.groupBy("server", "metric").agg(F.min("value").alias("__least")).where("__least > 0").drop("__least")
    return per.join(least, ["server", "metric"], "left_semi")


def graphite_lines(metrics: DataFrame, prefix: str) -> DataFrame:
    """Plaintext protocol lines ``name value bucket``."""
    name = metric_name(prefix, F.col("metric"), F.col("server"))
    return metrics.select(F.concat_ws(" ", name, F.col("value").cast("string"), F.col("bucket").cast("string")).alias("value"))


def operational(rows: DataFrame, observation) -> DataFrame:
    """``rows``, counting while they pass: packets by kind. Read the numbers from ``observation`` after an action."""
    return rows.observe(
        observation,
        F.count("*").alias("rows"),
        F.count_if(F.col("request").isNotNull()).alias("requests"),
        F.count_if(F.col("response").isNotNull()).alias("responses"),
        F.count_if(F.col("expired")).alias("expired"),
    )


def throughput(packets: DataFrame) -> DataFrame:
    """Per file: packets, bytes and the captured milliseconds; whole packets and bytes per millisecond."""
    per = packets.groupBy("pcap_file").agg(F.count("*").alias("packets"), F.sum("ip_len").cast("long").alias("bytes"), (F.max("time") - F.min("time")).alias("ms"))
    ms = F.greatest("ms", F.lit(1))
    return per.withColumn("packets_per_ms", F.floor(F.col("packets") / ms)).withColumn("bytes_per_ms", F.floor(F.col("bytes") / ms))


__all__ = ["RETENTION", "all_metrics", "consolidate", "counts", "flush", "graphite_lines", "handshakes", "icmp_counts", "merge", "operational", "row_metrics", "throughput", "top"]
