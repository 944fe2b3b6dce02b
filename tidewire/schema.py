"""Declared schemas of the tables and of decoded packets."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DataType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

_TYPES = {"int": IntegerType(), "bigint": LongType(), "string": StringType(), "boolean": BooleanType(), "timestamp": TimestampType(), "binary": BinaryType()}


def _struct(columns: str, **nested: DataType) -> StructType:
    """A schema from ``name type [not null], ...`` and nested columns; needs no session."""
    out = StructType()
    for column in columns.split(", "):
        name, kind, *rest = column.split()
        out = out.add(StructField(name, nested[name] if kind == "nested" else _TYPES[kind], not rest))
    return out


# The dns table, in column order.
DNS_SCHEMA = _struct(
    "id int not null, time bigint not null, qname string, domainname string, frag int, ttl int, ipv int not null, "
    "prot int not null, src string, srcp int, dst string not null, dstp int not null, aa boolean, tc boolean, rd boolean, "
    "ra boolean, z boolean, ad boolean, cd boolean, ancount int, arcount int, nscount int, qdcount int not null, "
    "opcode int not null, rcode int not null, qtype int, qclass int, country string, asn string, asn_organisation string, "
    "edns_udp int, edns_version int, edns_do boolean, edns_ping boolean, edns_nsid string, edns_dnssec_dau string, "
    "edns_dnssec_dhu string, edns_dnssec_n3u string, edns_client_subnet string, edns_other string, "
    "edns_client_subnet_asn string, edns_client_subnet_asn_organisation string, edns_client_subnet_country string, "
    "labels int not null, resp_frag int, proc_time int, server_location string, edns_padding int, pcap_file string, "
    "edns_keytag_count int, edns_keytag_list string, q_tc boolean, q_ra boolean, q_ad boolean, pub_resolver string, "
    "req_len int, res_len int, tcp_hs_rtt int, req_ip_df boolean, res_ip_df boolean"
)
# The icmp table, in column order.
ICMP_SCHEMA = _struct(
    "time bigint not null, icmp_type int not null, icmp_code int not null, icmp_echo_client_type int not null, "
    "ip_ttl int not null, ip_v int not null, ip_src string, ip_dst string not null, ip_country string, ip_asn string, "
    "ip_asn_organisation string, ip_len int not null, l4_prot int not null, l4_srcp int not null, l4_dstp int not null, "
    "orig_ip_ttl int, orig_ip_v int, orig_ip_src string, orig_ip_dst string, orig_l4_prot int, orig_l4_srcp int, "
    "orig_l4_dstp int, orig_ip_len int, orig_icmp_type int, orig_icmp_code int, orig_icmp_echo_client_type int, "
    "orig_dns_id int, orig_dns_qname string, orig_dns_domainname string, orig_dns_len int, orig_dns_aa boolean, "
    "orig_dns_tc boolean, orig_dns_rd boolean, orig_dns_ra boolean, orig_dns_z boolean, orig_dns_ad boolean, "
    "orig_dns_cd boolean, orig_dns_ancount int, orig_dns_arcount int, orig_dns_nscount int, orig_dns_qdcount int, "
    "orig_dns_rcode int, orig_dns_qtype int, orig_dns_opcode int, orig_dns_qclass int, orig_dns_edns_udp int, "
    "orig_dns_edns_version int, orig_dns_edns_do boolean, orig_dns_labels int, server_location string, pcap_file string, "
    "ip_pub_resolver string, server string, icmp_ip_mtu int"
)
# Columns that the privacy purge empties.
PERSONAL = {"dns": ("src", "edns_client_subnet"), "icmp": ("ip_src", "orig_ip_src")}
# Partition columns.
PARTITIONS = {"dns": ("year", "month", "day", "server"), "icmp": ("year", "month", "day")}
# The ledger of processed files and the table of partitions.
LEDGER_SCHEMA = _struct(
    "id bigint, date_start timestamp, date_end timestamp, time int, file string, server string, path string, rows bigint, mode string, bytes bigint"
)
PARTITION_SCHEMA = _struct(
    "id bigint, engine string, table_name string, created timestamp, year int, month int, day int, server string, path string, "
    "compaction_ts timestamp, compaction_time int, compaction_ok boolean, updated_ts timestamp, "
    "privacy_purge_ts timestamp, privacy_purge_ok boolean, privacy_purge_time int"
)

_QUESTION = _struct("qname string, qtype int, qclass int")
_OPTION = _struct("code int, data binary")
_OPT = _struct("udp int, version int, dnssec_ok boolean, options nested", options=ArrayType(_OPTION))
MESSAGE = _struct(
    "id int, qr int, opcode int, rcode int, aa boolean, tc boolean, rd boolean, ra boolean, z boolean, ad boolean, cd boolean, "
    "qdcount int, ancount int, nscount int, arcount int, bytes int, questions nested, opt nested",
    questions=ArrayType(_QUESTION),
    opt=_OPT,
)
_INNER = _struct(
    "ttl int, ipv int, src string, dst string, prot int, srcp int, dstp int, ip_len int, icmp_type int, icmp_code int, icmp_echo_client_type int, message nested",
    message=MESSAGE,
)
_ICMP = _struct("type int, code int, echo_client_type int, mtu int, orig nested", orig=_INNER)
#: A decoded packet.
PACKET_SCHEMA = _struct(
    "seq bigint, time bigint, pcap_file string, server string, server_location string, ipv int, prot int, ttl int, ip_len int, "
    "src string, dst string, srcp int, dstp int, df boolean, fragmented boolean, frags int, tcp_hs_rtt int, messages nested, icmp nested, error string",
    messages=ArrayType(MESSAGE),
    icmp=_ICMP,
)


def table_schema(table: str, partitions: bool = True, query_ts: bool = True) -> StructType:
    """Schema of a stored table: its columns, ``query_ts`` (filled by compaction), its partition columns."""
    out = StructType(list({"dns": DNS_SCHEMA, "icmp": ICMP_SCHEMA}[table].fields))
    if query_ts:
        out = out.add("query_ts", TimestampType())
    for name in PARTITIONS[table] if partitions else ():
        out = out.add(name, StringType() if name == "server" else IntegerType())
    return StructType([StructField(f.name, f.dataType, True) for f in out.fields])
