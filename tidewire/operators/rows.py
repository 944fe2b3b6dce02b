"""Joined messages and ICMP packets to the rows of the stored tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import edns
from tidewire.functions.names import label_count, registered_domain
from tidewire.operators.enrich import Enricher, enrich
from tidewire.schema import DNS_SCHEMA, ICMP_SCHEMA, PERSONAL

#: rcode of a query without a response; id and opcode of a row without either message.
NO_RESPONSE = UNKNOWN = -1


def _cast(df: DataFrame, schema, extra: Iterable[str] = ()) -> DataFrame:
    """The schema's columns in its order and types; null where ``df`` lacks one."""
    have = set(df.columns)
    own = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*own, *extra)


def without_personal(df: DataFrame, table: str, privacy: bool = True) -> DataFrame:
    """``df`` with the table's personal columns emptied."""
    if not privacy:
        return df
    return df.withColumns({c: F.lit(None).cast("string") for c in PERSONAL[table] if c in df.columns})


def dns_rows(joined: DataFrame, privacy: bool = False, enrichers: Iterable[Enricher] = (), suffixes: DataFrame | None = None, resolver: Enricher | None = None) -> DataFrame:
    """Rows of the dns table from ``request`` and ``response`` structs; ``server`` rides along.

    Client subnets are enriched without the resolver check.
    """
    q, r = F.col("request"), F.col("response")
    qm, rm = q["message"], r["message"]
    asked = F.size(qm["questions"]) > 0
    told = F.coalesce(F.size(rm["questions"]) > 0, F.lit(False))
    question = F.coalesce(F.try_element_at(qm["questions"], F.lit(1)), F.try_element_at(rm["questions"], F.lit(1)))
    either = lambda name: F.coalesce(q[name], r[name])
    swapped = lambda own, other: F.when(q.isNotNull(), q[own]).otherwise(r[other])
    cols: dict[str, Column] = {
        "id": F.coalesce(rm["id"], qm["id"], F.lit(UNKNOWN)),
        "opcode": F.coalesce(rm["opcode"], qm["opcode"], F.lit(UNKNOWN)),
        "rcode": F.when(told, rm["rcode"]).otherwise(NO_RESPONSE),
        "time": either("time"),
        "qname": question["qname"],
        "qtype": question["qtype"],
        "qclass": question["qclass"],
        "labels": label_count(question["qname"]),
        "ttl": q["ttl"],
        "rd": qm["rd"],
        "z": qm["z"],
        "cd": qm["cd"],
        "q_tc": qm["tc"],
        "q_ra": qm["ra"],
        "q_ad": qm["ad"],
        "qdcount": F.coalesce(F.when(told, rm["qdcount"]), qm["qdcount"], F.lit(0)),
        "frag": F.when(q["fragmented"], q["frags"]),
        "req_len": F.when(asked, qm["bytes"]),
        "req_ip_df": F.when(asked, q["df"]),
        "tcp_hs_rtt": F.when(asked & (q["tcp_hs_rtt"] != -1), q["tcp_hs_rtt"]),
        "resp_frag": F.when(told & r["fragmented"], r["frags"]),
        "res_len": F.when(told, rm["bytes"]),
        "res_ip_df": F.when(told, r["df"]),
        "edns_nsid": F.when(told, edns.response_nsid(rm["opt"])),
        "ipv": either("ipv"),
        "prot": either("prot"),
        "src": swapped("src", "dst"),
        "srcp": swapped("srcp", "dstp"),
        "dst": swapped("dst", "src"),
        "dstp": swapped("dstp", "srcp"),
        "proc_time": (r["time"] - q["time"]).try_cast("int"),  # null beyond 24 days
        "pcap_file": either("pcap_file"),
        "server_location": either("server_location"),
        "server": either("server"),
        "dns_query": q.isNotNull(),
        "dns_response": told,
    }
    cols |= {c: F.when(told, rm[c]) for c in ("aa", "tc", "ra", "ad", "ancount", "arcount", "nscount")}
    cols |= {c: F.when(qm.isNotNull(), v) for c, v in edns.request_columns(qm["opt"]).items()}
    rows = joined.select(*[v.alias(k) for k, v in cols.items()])
    rows = registered_domain(rows, "qname", "domainname", suffixes)
    enrichers = list(enrichers)
    if enrichers or resolver:
        base = rows = rows.persist(StorageLevel.MEMORY_AND_DISK)  # addresses and rows both read it
        rows = enrich(rows, "src", "", [*enrichers, *([resolver] if resolver else [])])
    if enrichers:
        rows = enrich(rows, "__subnet", "edns_client_subnet_", enrichers, base)
    return without_personal(_cast(rows, DNS_SCHEMA, ["server", "dns_query", "dns_response"]), "dns", privacy)


def icmp_rows(packets: DataFrame, privacy: bool = False, enrichers: Iterable[Enricher] = (), suffixes: DataFrame | None = None, resolver: Enricher | None = None) -> DataFrame:
    """Rows of the icmp table from ICMP packets."""
    icmp = F.col("icmp")
    orig = icmp["orig"]
    message = orig["message"]
    question = F.try_element_at(message["questions"], F.lit(1))
    opt = message["opt"]
    cols: dict[str, Column] = {
        "time": F.col("time"),
        "icmp_type": icmp["type"],
        "icmp_code": icmp["code"],
        "icmp_echo_client_type": icmp["echo_client_type"],
        "icmp_ip_mtu": F.when(icmp["mtu"] > 0, icmp["mtu"]),
        "ip_ttl": F.col("ttl"),
        "ip_v": F.col("ipv"),
        "ip_src": F.col("src"),
        "ip_dst": F.col("dst"),
        "ip_len": F.col("ip_len"),
        "l4_prot": F.col("prot"),
        "l4_srcp": F.coalesce("srcp", F.lit(0)),
        "l4_dstp": F.coalesce("dstp", F.lit(0)),
        "orig_ip_ttl": orig["ttl"],
        "orig_ip_v": orig["ipv"],
        "orig_ip_src": orig["src"],
        "orig_ip_dst": orig["dst"],
        "orig_ip_len": orig["ip_len"],
        "orig_l4_prot": orig["prot"],
        "orig_l4_srcp": orig["srcp"],
        "orig_l4_dstp": orig["dstp"],
        "orig_icmp_type": orig["icmp_type"],
        "orig_icmp_code": orig["icmp_code"],
        "orig_icmp_echo_client_type": orig["icmp_echo_client_type"],
        "orig_dns_id": message["id"],
        "orig_dns_len": message["bytes"],
        "orig_dns_qname": question["qname"],
        "orig_dns_qtype": question["qtype"],
        "orig_dns_qclass": question["qclass"],
        "orig_dns_labels": F.when(message.isNotNull(), label_count(question["qname"])),
        "orig_dns_edns_udp": opt["udp"],
        "orig_dns_edns_version": opt["version"],
        "orig_dns_edns_do": opt["dnssec_ok"],
        "server_location": F.col("server_location"),
        "pcap_file": F.col("pcap_file"),
        "server": F.col("server"),
    }
    same = ("aa", "tc", "rd", "ra", "z", "ad", "cd", "ancount", "arcount", "nscount", "qdcount", "rcode", "opcode")
    cols |= {f"orig_dns_{c}": message[c] for c in same}
    rows = packets.where(icmp.isNotNull()).select(*[v.alias(k) for k, v in cols.items()])
    rows = registered_domain(rows, "orig_dns_qname", "orig_dns_domainname", suffixes)
    enrichers = list(enrichers)
    if enrichers or resolver:
        rows = enrich(rows, "ip_src", "ip_", [*enrichers, *([resolver] if resolver else [])])
    return without_personal(_cast(rows, ICMP_SCHEMA), "icmp", privacy)
