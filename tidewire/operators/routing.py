"""Decoded packets to branches, messages, flows and writers."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.labels import flow_key

# IP protocol numbers.
ICMP, TCP, UDP, ICMP6 = 1, 6, 17, 58
DNS_PROTOCOLS = (0, TCP, UDP)


def route(prot: Column) -> Column:
    """dns, icmp or reject."""
    return F.when(prot.isin(*DNS_PROTOCOLS), "dns").when(prot.isin(ICMP, ICMP6), "icmp").otherwise("reject")


def split(packets: DataFrame, icmp_enabled: bool = True, tcp_enabled: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dns, icmp, reject) branches."""
    dns = packets.where(F.col("prot").isin(*DNS_PROTOCOLS))
    if not tcp_enabled:
        dns = dns.where(F.col("prot") != TCP)
    icmp = packets.where(F.col("prot").isin(ICMP, ICMP6) & F.lit(icmp_enabled))
    return dns, icmp, packets.where(~F.col("prot").isin(*DNS_PROTOCOLS, ICMP, ICMP6) | F.col("prot").isNull())


def explode_messages(dns: DataFrame) -> DataFrame:
    """One row per DNS message, in packet order; packets without messages go.

    Adds the matching columns: seq (packet order, then position), qr, id, qname,
    qtype, client and port.
    """
    rows = dns.where(F.size("messages") > 0).select("*", F.posexplode("messages").alias("pos", "message")).drop("messages")
    query = F.col("message.qr") == 0
    question = F.try_element_at(F.col("message.questions"), F.lit(1))
    return rows.select(
        *[c for c in rows.columns if c not in ("seq", "pos", "icmp")],
        F.struct("seq", "pos").alias("seq"),
        F.col("message.qr").alias("qr"),
        F.col("message.id").alias("id"),
        question["qname"].alias("qname"),
        question["qtype"].alias("qtype"),
        F.when(query, F.col("src")).otherwise(F.col("dst")).alias("client"),
        F.when(query, F.col("srcp")).otherwise(F.col("dstp")).alias("port"),
    )


def by_flow(packets: DataFrame, n: int) -> DataFrame:
    """Both directions of a flow in one partition; packets without an address go together."""
    return packets.repartition(n, F.coalesce(flow_key(F.col("src"), F.col("dst")), F.lit(0)))


def balance(rows: DataFrame, n: int) -> DataFrame:
    """Rows dealt evenly to ``n`` writers."""
    return rows.repartition(n)


def has_suffix(name: Column, suffixes: list[str]) -> Column:
    """Whether the name ends with any of the suffixes; all do if there are none."""
    return reduce(or_, [F.endswith(name, F.lit(s)) for s in suffixes]) if suffixes else F.lit(True)
