"""The registered queries over the driver's tables, each with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions import labels as lb
from tidewire.functions.ip import in_cidr, ip_key, ipv4_parts, ipv4_to_long, is_ipv4
from tidewire.functions.names import label_count, registered_domain, url_host
from tidewire.functions.times import bucket, elapsed_seconds, epoch_ms, partition_columns, query_ts
from tidewire.operators import control, enrich, files, metrics, rows
from tidewire.operators.maintenance import compacted, purged
from tidewire.operators.matching import match, suppress_zone_transfers
from tidewire.operators.routing import balance, by_flow, explode_messages, has_suffix, route, split
from tidewire.plans import pseudo
from tidewire.plans.pseudo import GEO_SQL, MESSAGES_SQL

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}

DAYS_3 = 3 * 86_400_000

#: Matching in DuckDB, over the messages.
MATCH_SQL = """
zt AS (SELECT *, sum(CASE WHEN qr = 0 AND qtype IN (252, 251) THEN 1 ELSE 0 END) OVER (PARTITION BY id, client, port ORDER BY seq) AS epoch FROM m),
zr AS (SELECT *, sum(qr) OVER (PARTITION BY id, client, port, epoch ORDER BY seq) AS nth FROM zt),
s AS (SELECT * FROM zr WHERE qr = 0 OR epoch = 0 OR nth <= 1),
w AS (
  SELECT *, lag(qr) OVER k AS before_qr, lag(seq) OVER k AS before_seq, lead(qr) OVER k AS after_qr, sum(qr) OVER k AS run
  FROM s WINDOW k AS (PARTITION BY id, client, port, qname ORDER BY seq)),
f AS (SELECT *, first_value(time) OVER (PARTITION BY id, client, port, qname, run, qr ORDER BY seq) AS run_start FROM w),
l AS (SELECT arg_max(time, seq) AS last FROM m),
j AS (
  SELECT before_seq AS q_seq, seq AS r_seq, 'pair' AS kind FROM f WHERE qr = 1 AND before_qr = 0
  UNION ALL SELECT NULL, seq, 'response' FROM f WHERE qr = 1 AND before_qr IS DISTINCT FROM 0 AND qname IS NOT NULL
  UNION ALL SELECT seq, NULL, 'expired' FROM f, l WHERE qr = 0 AND after_qr IS NULL AND run_start < last - {timeout} AND qname IS NOT NULL)
"""
#: Joined rows with the columns that metrics need.
ROWS_SQL = """
d AS (
  SELECT coalesce(q.seq, r.seq) AS seq, coalesce(q.time, r.time) AS time, coalesce(q.prot, r.prot) AS prot, coalesce(q.ipv, r.ipv) AS ipv,
         CASE WHEN q.qname IS NOT NULL THEN q.qtype WHEN r.qname IS NOT NULL THEN r.qtype END AS qtype,
         CASE WHEN r.qname IS NOT NULL THEN r.rcode ELSE -1 END AS rcode, 0 AS opcode, coalesce(q.client, r.client) AS client,
         q.seq IS NOT NULL AS dns_query, r.qname IS NOT NULL AS dns_response,
         CASE WHEN q.qname IS NOT NULL THEN q.tcp_hs_rtt END AS tcp_hs_rtt, coalesce(q.u, r.u) AS u, q, r
  FROM j LEFT JOIN m q ON q.seq = q_seq LEFT JOIN m r ON r.seq = r_seq)
"""


def _with(*parts: str, timeout: int = 2000) -> str:
    return "WITH " + ", ".join(p.replace("{timeout}", str(timeout)) for p in parts) + " "


M, MJ = _with(MESSAGES_SQL), _with(MESSAGES_SQL, MATCH_SQL)
MD, MG = _with(MESSAGES_SQL, MATCH_SQL, ROWS_SQL), _with(MESSAGES_SQL, GEO_SQL)
MDG = _with(MESSAGES_SQL, MATCH_SQL, ROWS_SQL, GEO_SQL)


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[name or f.__name__] = f
        if sql:
            _sql[name or f.__name__] = sql
        return f

    return add


def _joined(spark: SparkSession, sf: str, timeout: int = 2000) -> DataFrame:
    return match(pseudo.messages(spark, sf), timeout)[0]


def _packet_rows(spark: SparkSession, sf: str, **kw) -> DataFrame:
    """Rows of the dns table from nested packets."""
    messages = explode_messages(pseudo.packets(spark, sf))
    return rows.dns_rows(match(messages)[0], **kw)


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    """dns rows as stored, with partition columns."""
    found = _packet_rows(spark, sf)
    return found.drop("dns_query", "dns_response").withColumns(partition_columns(F.col("time"))).withColumn("server", lb.server_partition(F.col("server")))


# --- matching ---


@query(MJ + "SELECT q_seq, r_seq FROM j WHERE kind = 'pair'")
def match_pairs(spark, sf):
    return _joined(spark, sf).where("request IS NOT NULL AND response IS NOT NULL").select(F.col("request.seq").alias("q_seq"), F.col("response.seq").alias("r_seq"))


@query(MJ + "SELECT r_seq FROM j WHERE kind = 'response'")
def match_response_only(spark, sf):
    return _joined(spark, sf).where("request IS NULL").select(F.col("response.seq").alias("r_seq"))


@query(MJ + "SELECT q_seq FROM j WHERE kind = 'expired'")
def match_expired(spark, sf):
    return _joined(spark, sf).where("expired").select(F.col("request.seq").alias("q_seq"))


@query(MJ + "SELECT q_seq, r_seq, kind = 'expired' AS expired FROM j")
def match_all_outer(spark, sf):
    return _joined(spark, sf).select(F.col("request.seq").alias("q_seq"), F.col("response.seq").alias("r_seq"), "expired")


@query(_with(MESSAGES_SQL, MATCH_SQL, timeout=DAYS_3) + f"SELECT seq, run_start FROM f, l WHERE qr = 0 AND after_qr IS NULL AND run_start >= last - {DAYS_3}")
def match_pending_kept(spark, sf):
    """Queries that stay pending for the next file under a timeout of three days."""
    return match(pseudo.messages(spark, sf), DAYS_3)[1].select("seq", F.col("__run_start").alias("run_start"))


@query(MJ + "SELECT seq, qr FROM s")
def zone_transfer_suppress(spark, sf):
    return suppress_zone_transfers(pseudo.messages(spark, sf)).select("seq", "qr")


@query(MJ + "SELECT count(*) AS pairs, min(r.time - q.time) AS least, max(r.time - q.time) AS most, CAST(sum(r.time - q.time) AS BIGINT) AS total FROM j JOIN m q ON q.seq = q_seq JOIN m r ON r.seq = r_seq")
def proc_time_stats(spark, sf):
    took = F.col("response.time") - F.col("request.time")
    return _joined(spark, sf).where("request IS NOT NULL AND response IS NOT NULL").agg(F.count("*").alias("pairs"), F.min(took).alias("least"), F.max(took).alias("most"), F.sum(took).alias("total"))


# --- rows ---

_PK_SQL = _with(
    MESSAGES_SQL.replace("ELSE 251 END AS qtype,", "ELSE 251 END AS raw_qtype,").replace("m AS (", "m0 AS (")
    + ", m AS (SELECT *, CASE WHEN qname IS NOT NULL THEN raw_qtype END AS qtype FROM m0)",
    MATCH_SQL,
)
_DNS_SQL = (
    _PK_SQL
    + """, d AS (SELECT q, r, q.seq AS qs, r.seq AS rs, coalesce(q.k, r.k) AS k FROM j LEFT JOIN m q ON q.seq = q_seq LEFT JOIN m r ON r.seq = r_seq),
t AS (SELECT *, qs IS NOT NULL AS hq, rs IS NOT NULL AND r.qname IS NOT NULL AS told, qs IS NOT NULL AND q.qname IS NOT NULL AS asked FROM d)
"""
)


@query(
    _DNS_SQL
    + """SELECT coalesce(r.id, q.id) AS id, coalesce(q.time, r.time) AS time, coalesce(q.qname, r.qname) AS qname,
    CASE WHEN asked OR told THEN 'example.com' END AS domainname, CASE WHEN asked OR told THEN 3 ELSE 0 END AS labels,
    CASE WHEN asked THEN q.qtype WHEN told THEN r.qtype END AS qtype, CASE WHEN asked OR told THEN 1 END AS qclass,
    CASE WHEN told THEN r.rcode ELSE -1 END AS rcode, 0 AS opcode,
    CASE WHEN hq THEN q.k % 64 + 1 END AS ttl, CASE WHEN hq THEN q.k % 5 = 0 END AS rd, CASE WHEN hq THEN q.k % 3 = 0 END AS q_tc,
    CASE WHEN told THEN 1 WHEN asked THEN 1 ELSE 0 END AS qdcount,
    CASE WHEN told THEN r.k % 2 = 0 END AS aa, CASE WHEN told THEN r.k % 3 END AS ancount,
    CASE WHEN hq AND q.k % 17 = 0 THEN q.k % 3 + 2 END AS frag, CASE WHEN told AND r.k % 17 = 0 THEN r.k % 3 + 2 END AS resp_frag,
    CASE WHEN asked THEN q.k + 40 END AS req_len, CASE WHEN told THEN r.k + 40 END AS res_len,
    CASE WHEN asked THEN q.k % 2 = 0 END AS req_ip_df, CASE WHEN told THEN r.k % 2 = 0 END AS res_ip_df,
    CASE WHEN asked THEN q.tcp_hs_rtt END AS tcp_hs_rtt,
    coalesce(q.client, r.client) AS src, coalesce(q.port, r.port) AS srcp, '192.0.2.53' AS dst, 53 AS dstp,
    coalesce(q.prot, r.prot) AS prot, coalesce(q.ipv, r.ipv) AS ipv,
    CASE WHEN qs IS NOT NULL AND rs IS NOT NULL THEN TRY_CAST(r.time - q.time AS INTEGER) END AS proc_time,
    coalesce(q.pcap_file, r.pcap_file) AS pcap_file, 'ams' AS server_location FROM t"""
)
def dns_rows_min(spark, sf):
    cols = "id time qname domainname labels qtype qclass rcode opcode ttl rd q_tc qdcount aa ancount frag resp_frag req_len res_len req_ip_df res_ip_df tcp_hs_rtt src srcp dst dstp prot ipv proc_time pcap_file server_location"
    return _packet_rows(spark, sf).select(*cols.split())


_EDNS_WHERE = "hq AND q.k % 10 < 7"


@query(
    _DNS_SQL
    + f"""SELECT coalesce(q.time, r.time) AS time, coalesce(q.client, r.client) AS src,
    CASE WHEN {_EDNS_WHERE} THEN 1232 END AS edns_udp, CASE WHEN {_EDNS_WHERE} THEN 0 END AS edns_version, CASE WHEN {_EDNS_WHERE} THEN q.k % 2 = 0 END AS edns_do,
    CASE WHEN {_EDNS_WHERE} AND q.k % 2 = 0 THEN q.k % 7 END AS edns_padding,
    CASE WHEN {_EDNS_WHERE} AND q.k % 3 = 0 THEN 2 END AS edns_keytag_count,
    CASE WHEN {_EDNS_WHERE} AND q.k % 3 = 0 THEN concat('0,', q.k * 257) END AS edns_keytag_list,
    CASE WHEN {_EDNS_WHERE} AND q.k % 5 = 0 THEN concat('1,10.', q.u % 4, '.', (q.u // 4) % 256, '.0/24,0') END AS edns_client_subnet,
    CASE WHEN {_EDNS_WHERE} THEN nullif(concat(CASE WHEN q.k % 7 = 0 THEN '10' END, CASE WHEN q.k % 11 = 0 THEN '99' END, CASE WHEN q.k % 4 = 0 THEN '3' END), '') END AS edns_other,
    CASE WHEN told AND r.k % 10 < 7 AND r.k % 4 = 0 THEN concat('ns', r.k) END AS edns_nsid FROM t"""
)
def edns_options(spark, sf):
    cols = "time src edns_udp edns_version edns_do edns_padding edns_keytag_count edns_keytag_list edns_client_subnet edns_other edns_nsid"
    return _packet_rows(spark, sf).select(*cols.split())


@query(_DNS_SQL + "SELECT count(*) AS n, 0 AS with_src, 0 AS with_subnet FROM t")
def privacy_rows(spark, sf):
    found = _packet_rows(spark, sf, privacy=True)
    return found.agg(F.count("*").alias("n"), F.count("src").cast("int").alias("with_src"), F.count("edns_client_subnet").cast("int").alias("with_subnet"))


@query(M + "SELECT seq, qr, client, port, id FROM m")
def message_explode(spark, sf):
    return explode_messages(pseudo.packets(spark, sf)).select(F.col("seq.seq").alias("seq"), "qr", "client", "port", "id")


@query("SELECT CASE k % 5 WHEN 0 THEN 'dns' WHEN 1 THEN 'dns' WHEN 2 THEN 'icmp' WHEN 3 THEN 'icmp' ELSE 'reject' END AS branch, count(*) AS n FROM (SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY 1")
def protocol_router(spark, sf):
    prot = F.element_at(F.array(*[F.lit(p) for p in (6, 17, 1, 58, 47)]), F.col("k") % 5 + 1)
    return pseudo.messages(spark, sf).select(route(prot).alias("branch")).groupBy("branch").agg(F.count("*").alias("n"))


@query("SELECT count_if(k % 4 = 0) AS dns, count_if(k % 4 = 2) AS icmp, count_if(k % 4 = 3) AS reject FROM (SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)")
def icmp_split(spark, sf):
    """Branch sizes with TCP switched off."""
    prot = F.element_at(F.array(*[F.lit(p) for p in (17, 6, 1, 47)]), F.col("k") % 4 + 1)
    parts = split(pseudo.messages(spark, sf).withColumn("prot", prot), tcp_enabled=False)
    named = [p.select(F.lit(n).alias("branch")) for n, p in zip(("dns", "icmp", "reject"), parts, strict=True)]
    one = named[0].unionByName(named[1]).unionByName(named[2])
    return one.agg(*[F.count_if(F.col("branch") == n).alias(n) for n in ("dns", "icmp", "reject")])


def _icmp_packets(spark, sf):
    p = pseudo.packets(spark, sf)
    message = F.col("messages")[0]
    orig = F.struct(
        F.lit(63).alias("ttl"), F.lit(4).alias("ipv"), F.col("src").alias("src"), F.col("dst").alias("dst"), F.lit(17).alias("prot"), F.col("srcp").alias("srcp"),
        F.col("dstp").alias("dstp"), F.lit(60).alias("ip_len"), F.lit(None).cast("int").alias("icmp_type"), F.lit(None).cast("int").alias("icmp_code"),
        F.lit(None).cast("int").alias("icmp_echo_client_type"), message.alias("message"),
    )
    icmp = F.struct(F.lit(3).alias("type"), (F.col("ttl") % 5).cast("int").alias("code"), F.lit(0).alias("echo_client_type"), F.when(F.col("ttl") % 2 == 0, 1400).otherwise(0).alias("mtu"), orig.alias("orig"))
    return p.withColumn("icmp", icmp).withColumn("prot", F.lit(1))


@query(
    M
    + """SELECT time, 3 AS icmp_type, (k % 64 + 1) % 5 AS icmp_code, CASE WHEN (k % 64 + 1) % 2 = 0 THEN 1400 END AS icmp_ip_mtu,
    CASE WHEN qr = 0 THEN client ELSE '192.0.2.53' END AS ip_src, CASE WHEN qr = 0 THEN client ELSE '192.0.2.53' END AS orig_ip_src,
    qname AS orig_dns_qname, CASE WHEN qname IS NOT NULL THEN 'example.com' END AS orig_dns_domainname, CASE WHEN qname IS NOT NULL THEN 3 ELSE 0 END AS orig_dns_labels,
    CASE WHEN qname IS NOT NULL THEN qtype END AS orig_dns_qtype, rcode AS orig_dns_rcode, CASE WHEN k % 10 < 7 THEN 1232 END AS orig_dns_edns_udp FROM m"""
)
def icmp_rows(spark, sf):
    cols = "time icmp_type icmp_code icmp_ip_mtu ip_src orig_ip_src orig_dns_qname orig_dns_domainname orig_dns_labels orig_dns_qtype orig_dns_rcode orig_dns_edns_udp"
    return rows.icmp_rows(_icmp_packets(spark, sf)).select(*cols.split())


# --- enrichment ---


@query(MG + "SELECT seq, country FROM m LEFT JOIN info USING (client)")
def geo_range_join(spark, sf):
    return enrich.enrich(pseudo.messages(spark, sf), "client", "", [enrich.country(pseudo.geo(spark, sf))]).select("seq", "country")


@query(MG + "SELECT seq, asn, asn_organisation FROM m LEFT JOIN info USING (client)")
def asn_range_join(spark, sf):
    return enrich.enrich(pseudo.messages(spark, sf), "client", "", [enrich.network(pseudo.asn(spark, sf))]).select("seq", "asn", "asn_organisation")


@query(MG + "SELECT pub_resolver, count(*) AS n FROM m LEFT JOIN info USING (client) GROUP BY 1")
def resolver_first_match(spark, sf):
    found = enrich.enrich(pseudo.messages(spark, sf), "client", "", [enrich.resolver(pseudo.resolvers(spark, sf))])
    return found.groupBy("pub_resolver").agg(F.count("*").alias("n"))


@query(MG + "SELECT client, count(*) AS n FROM ad, res WHERE ip BETWEEN lo AND hi GROUP BY client")
def cidr_bucket_join(spark, sf):
    """All ranges that hold an address, counted."""
    keys = pseudo.messages(spark, sf).select("client").distinct().withColumn("key", ip_key(F.col("client")))
    dim = enrich.ranges(pseudo.resolvers(spark, sf))
    lengths = [r["__len"] for r in dim.select("__len").distinct().collect()]
    asked = keys.withColumn("__len", F.explode(F.array(*map(F.lit, sorted(lengths))))).withColumn("__bucket", F.expr("substr(key, 1, __len)"))
    return asked.join(dim, ["__len", "__bucket"]).where("key BETWEEN lo AND hi").groupBy("client").agg(F.count("*").alias("n"))


@query(
    MG
    + """SELECT seq, country AS edns_client_subnet_country, asn AS edns_client_subnet_asn FROM m LEFT JOIN (
    SELECT client, (SELECT arg_min(country, 1000 - prefix_len) FROM geo WHERE ip // 256 * 256 BETWEEN lo AND hi) AS country,
           (SELECT min(asn) FROM net WHERE ip // 256 * 256 BETWEEN lo AND hi) AS asn FROM ad) USING (client) WHERE k % 10 < 7 AND k % 5 = 0"""
)
def ecs_enrich_skip_resolver(spark, sf):
    """Client subnets, enriched without the resolver."""
    from tidewire.functions.edns import request_columns

    message = F.col("messages")[0]
    cols = request_columns(message["opt"])
    subnets = pseudo.packets(spark, sf).select("seq", cols["__subnet"].alias("subnet")).where("subnet IS NOT NULL")
    found = enrich.enrich(subnets, "subnet", "edns_client_subnet_", [enrich.country(pseudo.geo(spark, sf)), enrich.network(pseudo.asn(spark, sf))])
    return found.select("seq", "edns_client_subnet_country", "edns_client_subnet_asn")


@query(MG + "SELECT DISTINCT client, ip AS number FROM ad")
def ip_to_long(spark, sf):
    return pseudo.messages(spark, sf).select("client").distinct().select("client", ipv4_to_long(F.col("client")).alias("number"))


@query(M + "SELECT DISTINCT client, CAST(split_part(client, '.', 2) AS INTEGER) AS second, CAST(split_part(client, '.', 4) AS INTEGER) AS fourth, len(string_split(client, '.')) AS parts FROM m")
def ipv4_split(spark, sf):
    parts = ipv4_parts(F.col("client"))
    return pseudo.messages(spark, sf).select("client").distinct().select("client", parts[1].cast("int").alias("second"), parts[3].cast("int").alias("fourth"), F.size(parts).cast("long").alias("parts"))


@query("SELECT vec_id, vec_id % 2 = 0 AS v4 FROM embeddings", name="is_ipv4")
def _is_ipv4(spark, sf):
    address = F.when(F.col("vec_id") % 2 == 0, "192.0.2.1").otherwise("2001:db8::1")
    return spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", is_ipv4(address).alias("v4"))


@query("SELECT vec_id, printf('20010db800000000%016x', vec_id) AS key, vec_id < 256 AS inside FROM embeddings")
def ipv6_key(spark, sf):
    address = F.concat(F.lit("2001:db8::"), F.lower(F.hex(F.expr("vec_id div 65536"))), F.lit(":"), F.lower(F.hex(F.expr("vec_id % 65536"))))
    return spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", ip_key(address).alias("key"), in_cidr(address, "2001:db8::/120").alias("inside"))


@query("SELECT page_id, len(list_filter(string_split(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1), '.'), lambda x: x <> '')) AS labels FROM pages")
def name_labels(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", label_count(url_host(F.col("url"))).cast("long").alias("labels"))


@query("SELECT page_id, regexp_extract(url, '^[a-z]+://(?:[^/?#]*\\.)?([^./?#]+\\.[^./?#]+\\.?)(?:[/?#:].*)?$', 1) AS domain FROM pages", name="registered_domain")
def _registered_domain(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", url_host(F.col("url")).alias("host"))
    return registered_domain(pages, "host", "domain").select("page_id", "domain")


@query(
    """WITH h AS (SELECT page_id, string_split(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1), '.') AS p FROM pages)
    SELECT page_id, CASE WHEN p[-2] || '.' || p[-1] = 'example.com' THEN CASE WHEN len(p) > 2 THEN p[-3] || '.example.com' END ELSE p[-2] || '.' || p[-1] END AS domain FROM h"""
)
def registered_domain_suffix(spark, sf):
    """With ``example.com`` as a public suffix."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", url_host(F.col("url")).alias("host"))
    suffixes = spark.createDataFrame([("example.com",)], "suffix string")
    return registered_domain(pages, "host", "domain", suffixes).select("page_id", "domain")


# --- metrics ---


def _metric_rows(spark: SparkSession, sf: str, geo: bool = False) -> DataFrame:
    """The columns that metrics need, from the plain messages."""
    q, r = F.col("request"), F.col("response")
    either = lambda c: F.coalesce(q[c], r[c]).alias(c)
    asked, told = q["qname"].isNotNull(), r["qname"].isNotNull()
    found = _joined(spark, sf).select(
        either("time"), either("prot"), either("ipv"), either("client"),
        F.when(asked, q["qtype"]).when(told, r["qtype"]).alias("qtype"), F.when(told, r["rcode"]).otherwise(-1).alias("rcode"), F.lit(0).alias("opcode"),
        q.isNotNull().alias("dns_query"), told.alias("dns_response"), F.when(asked, q["tcp_hs_rtt"]).alias("tcp_hs_rtt"),
        F.concat(F.lit("ns"), F.coalesce(q["u"], r["u"]) % 3).alias("server"),
    )
    if geo:
        return enrich.enrich(found, "client", "", [enrich.country(pseudo.geo(spark, sf))])
    return found.withColumn("country", F.lit(None).cast("string"))


def _series(name: str, exact: bool = False):
    def f(spark, sf):
        found = metrics.counts(_metric_rows(spark, sf, geo=name == metrics.COUNTRY))
        keep = F.col("metric") == name if exact else F.startswith("metric", F.lit(f"{name}."))
        return found.where(keep)

    return f


def _series_sql(metric: str, where: str = "true", geo: bool = False) -> str:
    source = "d LEFT JOIN info USING (client)" if geo else "d"
    return (MDG if geo else MD) + f"SELECT time // 1000 - time // 1000 % 60 AS bucket, concat('ns', u % 3) AS server, {metric} AS metric, CAST(count(*) AS DOUBLE) AS value FROM {source} WHERE {where} GROUP BY ALL"


for _name, _f, _s in (
    ("minute_query_count", _series(metrics.QUERY, True), _series_sql("'dns.query'", "dns_query")),
    ("minute_response_count", _series(metrics.RESPONSE, True), _series_sql("'dns.response'", "dns_response")),
    ("by_qtype", _series(metrics.QTYPE), _series_sql("concat('dns.request.qtype.', coalesce(qtype, 0))")),
    ("by_rcode", _series(metrics.RCODE), _series_sql("concat('dns.request.rcode.', rcode)")),
    ("by_opcode", _series(metrics.OPCODE), _series_sql("concat('dns.request.opcode.', opcode)")),
    ("by_country", _series(metrics.COUNTRY), _series_sql("concat('geo.country.', coalesce(country, 'null'))", geo=True)),
):
    query(_s, _name)(_f)


@query(_series_sql("CASE WHEN prot = 17 THEN 'udp' ELSE 'tcp' END"))
def by_transport(spark, sf):
    return metrics.counts(_metric_rows(spark, sf)).where(F.col("metric").isin("udp", "tcp"))


@query(_series_sql("CASE WHEN ipv = 4 THEN 'ip.4' ELSE 'ip.6' END"))
def by_ipv(spark, sf):
    return metrics.counts(_metric_rows(spark, sf)).where(F.startswith("metric", F.lit("ip.")))


@query(
    MD
    + """, a AS (SELECT time // 1000 - time // 1000 % 60 AS bucket, concat('ns', u % 3) AS server, avg(tcp_hs_rtt) AS v, CAST(count(*) AS DOUBLE) AS n
    FROM d WHERE prot <> 17 AND tcp_hs_rtt IS NOT NULL AND tcp_hs_rtt <> -1 GROUP BY ALL)
    SELECT bucket, server, 'tcp.rtt.handshake.avg' AS metric, v AS value FROM a UNION ALL SELECT bucket, server, 'tcp.rtt.handshake.samples', n FROM a"""
)
def tcp_rtt_avg(spark, sf):
    return metrics.handshakes(_metric_rows(spark, sf))


@query(M + "SELECT median(tcp_hs_rtt) AS median_rtt, count(tcp_hs_rtt) AS samples FROM m WHERE prot <> 17")
def rtt_median(spark, sf):
    return pseudo.messages(spark, sf).where("prot <> 17").agg(F.median("tcp_hs_rtt").alias("median_rtt"), F.count("tcp_hs_rtt").alias("samples"))


@query(M + "SELECT time // 1000 - time // 1000 % 60 AS bucket, concat('ns', u % 3, '_ams') AS server, 'icmp' AS metric, CAST(count(*) AS DOUBLE) AS value FROM m GROUP BY ALL")
def icmp_count(spark, sf):
    return metrics.icmp_counts(rows.icmp_rows(_icmp_packets(spark, sf)))


_RC = _series_sql("concat('dns.request.rcode.', rcode)")


@query(f"SELECT * FROM ({_RC}) QUALIFY bucket < max(bucket) OVER (PARTITION BY server, metric)")
def flush_all_but_last_bucket(spark, sf):
    return metrics.flush(_series(metrics.RCODE)(spark, sf))[0]


@query(f"SELECT bucket, server, metric, value * 2 AS value FROM ({_RC})")
def metric_merge(spark, sf):
    """The same buckets from two runs add up."""
    one = _series(metrics.RCODE)(spark, sf)
    return metrics.merge(one, one).where("value IS NOT NULL")


@query("SELECT metric, sum(value) AS total FROM (" + _series_sql("concat('geo.country.', coalesce(country, 'null'))", geo=True) + ") GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top10_country(spark, sf):
    return metrics.top(_series(metrics.COUNTRY)(spark, sf), metrics.COUNTRY)


@query("SELECT metric, sum(value) AS total FROM (" + _series_sql("concat('dns.request.qtype.', coalesce(qtype, 0))") + ") GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top10_qtype(spark, sf):
    return metrics.top(_series(metrics.QTYPE)(spark, sf), metrics.QTYPE)


@query(f"SELECT server, metric, bucket - bucket % 3600 AS wide, avg(value) AS value FROM ({_RC}) GROUP BY ALL")
def consolidate_min_above(spark, sf):
    return metrics.consolidate(_series(metrics.RCODE)(spark, sf), 3600)


@query("PIVOT (SELECT bucket - bucket % 86400 AS day, metric, value FROM (" + _series_sql("CASE WHEN prot = 17 THEN 'udp' ELSE 'tcp' END") + ")) ON metric IN ('tcp', 'udp') USING sum(value) GROUP BY day")
def series_pivot(spark, sf):
    found = metrics.counts(_metric_rows(spark, sf)).withColumn("day", F.col("bucket") - F.pmod("bucket", F.lit(86400)))
    return found.groupBy("day").pivot("metric", ["tcp", "udp"]).sum("value")


@query(M + "SELECT concat('tide.dns.query.ns.', 'ns', u % 3, '_ams', ' ', time // 1000 - time // 1000 % 60) AS value FROM m")
def metric_names(spark, sf):
    name = lb.metric_name("tide", F.lit("dns.query"), F.concat(F.lit("ns"), F.col("u") % 3, F.lit(".ams")))
    return pseudo.messages(spark, sf).select(F.concat_ws(" ", name, bucket(F.col("time")).cast("string")).alias("value"))


@query(
    M
    + """SELECT pcap_file, count(*) AS packets, CAST(sum(k + 68) AS BIGINT) AS bytes, max(time) - min(time) AS ms,
    count(*) // greatest(max(time) - min(time), 1) AS packets_per_ms, CAST(sum(k + 68) AS BIGINT) // greatest(max(time) - min(time), 1) AS bytes_per_ms FROM m GROUP BY pcap_file"""
)
def file_throughput(spark, sf):
    return metrics.throughput(pseudo.packets(spark, sf))


# --- partitions, names, projections ---


@query(M + "SELECT seq, CAST(year(make_timestamp(time * 1000)) AS INTEGER) AS year, CAST(month(make_timestamp(time * 1000)) AS INTEGER) AS month, CAST(day(make_timestamp(time * 1000)) AS INTEGER) AS day FROM m", name="partition_columns")
def _partition_columns(spark, sf):
    return pseudo.messages(spark, sf).select("seq", *[v.alias(k) for k, v in partition_columns(F.col("time")).items()])


@query("SELECT event_id AS seq, epoch_us(ts) // 1000 AS ms FROM events", name="query_ts")
def _query_ts(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    return ev.select(F.col("event_id").alias("seq"), epoch_ms(query_ts(epoch_ms(F.col("ts")))).alias("ms"))


_SERVER_SQL = "(SELECT event_id AS seq, CASE user_id % 4 WHEN 0 THEN 'ns1.dns.nl' WHEN 1 THEN 'ns1_ams_x' WHEN 2 THEN '  ' END AS name FROM events)"


def _servers(spark, sf):
    u = F.col("user_id") % 4
    name = F.when(u == 0, "ns1.dns.nl").when(u == 1, "ns1_ams_x").when(u == 2, "  ")
    return spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_id").alias("seq"), name.alias("name"))


@query(
    f"""SELECT seq, own AS name, regexp_replace(own, '[^A-Za-z0-9 ]', '_', 'g') AS normalized_name, split_part(own, '_', 1) AS server,
    CASE WHEN contains(own, '_') THEN substr(own, strpos(own, '_') + 1) END AS location
    FROM (SELECT seq, CASE WHEN trim(coalesce(name, '')) = '' THEN 'default' ELSE name END AS own FROM {_SERVER_SQL})"""
)
def server_name_parse(spark, sf):
    return _servers(spark, sf).select("seq", *[v.alias(k) for k, v in lb.server_parts(F.col("name")).items()])


@query(f"SELECT seq, CASE WHEN trim(coalesce(name, '')) = '' THEN '__default__' ELSE name END AS server FROM {_SERVER_SQL}")
def server_default_value(spark, sf):
    return _servers(spark, sf).select("seq", lb.server_partition(F.col("name")).alias("server"))


@query(_DNS_SQL + "SELECT coalesce(q.time, r.time) AS time, coalesce(q.time, r.time) AS query_ms, coalesce(q.client, r.client) AS src FROM t")
def compact_projection(spark, sf):
    return compacted(_stored(spark, sf)).select("time", F.unix_millis("query_ts").alias("query_ms"), "src")


@query(_DNS_SQL + "SELECT coalesce(q.time, r.time) AS time, coalesce(q.qname, r.qname) AS qname, false AS has_src, false AS has_subnet FROM t")
def purge_projection(spark, sf):
    left = purged(_stored(spark, sf), "dns")
    return left.select("time", "qname", F.lit("src" in left.columns).alias("has_src"), F.lit("edns_client_subnet" in left.columns).alias("has_subnet"))


# --- files and control tables ---

_FILES_SQL = "(SELECT DISTINCT concat('cap-', strftime(ts, '%Y-%m-%d'), '.pcap', CASE day(ts) % 3 WHEN 0 THEN '.gz' WHEN 1 THEN '.xz' ELSE '' END) AS file, 'default' AS server, CAST(day(ts) AS INTEGER) AS day FROM events)"


def _files(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    day = F.dayofmonth("ts")
    end = F.when(day % 3 == 0, ".gz").when(day % 3 == 1, ".xz").otherwise("")
    return ev.select(F.concat(F.lit("cap-"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".pcap"), end).alias("file"), F.lit("default").alias("server"), day.alias("day")).distinct()


@query(f"SELECT file FROM {_FILES_SQL} WHERE file < (SELECT max(file) FROM {_FILES_SQL})")
def skip_newest_file(spark, sf):
    return files.skip_newest(_files(spark, sf)).select("file")


@query(f"SELECT file, server FROM {_FILES_SQL} WHERE day % 2 = 1")
def unprocessed_files_anti(spark, sf):
    known = _files(spark, sf)
    return files.unprocessed(known, known.where("day % 2 = 0")).select("file", "server")


@query(f"SELECT file FROM {_FILES_SQL} WHERE day < 11 AND (file LIKE '%.gz' OR file LIKE '%.xz')")
def expired_files(spark, sf):
    known = _files(spark, sf).withColumn("modified", F.make_timestamp(F.lit(2024), F.lit(1), "day", F.lit(0), F.lit(0), F.lit(0)))
    return files.expired(known, 20, F.lit("2024-01-31").cast("timestamp"), [".gz", ".xz"]).select("file")


@query(f"SELECT file FROM {_FILES_SQL} WHERE file LIKE '%.pcap'")
def suffix_filter(spark, sf):
    return _files(spark, sf).where(has_suffix(F.col("file"), [".pcap"])).select("file")


_PARTS_SQL = """(SELECT o_custkey AS id, 'spark' AS engine, CASE o_custkey % 2 WHEN 0 THEN 'dns' ELSE 'icmp' END AS table_name, 2024 AS year, 1 AS month,
  CAST(1 + o_custkey % 28 AS INTEGER) AS day, concat('p', o_custkey) AS path, o_custkey % 3 = 0 AS done FROM (SELECT DISTINCT o_custkey FROM orders))"""


def _partitions(spark, sf):
    from tidewire.schema import PARTITION_SCHEMA

    key = F.col("o_custkey")
    base = spark.read.parquet(f"{sf}/orders.parquet").select("o_custkey").distinct()
    day = (1 + key % 28).cast("int")
    at = F.make_timestamp(F.lit(2024), F.lit(1), day, F.lit(12), F.lit(0), F.lit(0))
    done = key % 3 == 0
    cols = {
        "id": key, "engine": F.lit("spark"), "table_name": F.when(key % 2 == 0, "dns").otherwise("icmp"), "created": at, "year": F.lit(2024), "month": F.lit(1), "day": day,
        "server": F.lit("ns1"), "path": F.concat(F.lit("p"), key), "compaction_ts": F.when(done, at), "compaction_ok": F.when(done, True), "updated_ts": at,
        "privacy_purge_ts": F.when(done, at), "privacy_purge_ok": F.when(done, True),
    }
    return base.select(*[(cols.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in PARTITION_SCHEMA.fields])


def _now():
    return F.lit("2024-01-20 12:30:00").cast("timestamp")


@query(f"SELECT id, path FROM {_PARTS_SQL} WHERE NOT done AND day < 20")
def uncompacted_partitions(spark, sf):
    open_ = control.uncompacted(_partitions(spark, sf), "spark")
    return control.due(open_, _now(), F.make_dt_interval(mins=F.lit(60))).select("id", "path")


@query(f"SELECT id, path FROM {_PARTS_SQL} WHERE NOT done AND day = 10")
def unpurged_partitions(spark, sf):
    return control.due_for_purge(control.unpurged(_partitions(spark, sf), "spark", F.lit("2024-01-10").cast("date")), _now()).select("id", "path")


@query(f"SELECT table_name, path, epoch_ms(TIMESTAMP '2024-01-20 12:30:00') AS updated, false AS fresh FROM {_PARTS_SQL} WHERE id % 5 = 0 UNION ALL SELECT table_name, path, epoch_ms(make_timestamp(2024, 1, day, 12, 0, 0)), false FROM {_PARTS_SQL} WHERE id % 5 <> 0 UNION ALL SELECT table_name, concat('new-', path), epoch_ms(TIMESTAMP '2024-01-20 12:30:00'), true FROM {_PARTS_SQL} WHERE id % 7 = 0")
def partition_upsert(spark, sf):
    known = _partitions(spark, sf)
    place = ["table_name", "path", "year", "month", "day", "server"]
    seen = known.where("id % 5 = 0").select(*place).unionByName(known.where("id % 7 = 0").withColumn("path", F.concat(F.lit("new-"), "path")).select(*place))
    out = control.upsert(known, seen, _now(), "spark")
    return out.select("table_name", "path", F.unix_millis("updated_ts").alias("updated"), (F.startswith("path", F.lit("new-")) & F.col("id").isNotNull()).alias("fresh"))


@query(f"SELECT path, epoch_ms(CASE WHEN id % 5 = 0 THEN TIMESTAMP '2024-01-20 12:30:00' ELSE make_timestamp(2024, 1, day, 12, 0, 0) END) AS updated FROM {_PARTS_SQL}")
def partition_ping(spark, sf):
    known = _partitions(spark, sf)
    return control.ping(known, known.where("id % 5 = 0"), _now()).select("path", F.unix_millis("updated_ts").alias("updated"))


@query("SELECT sum(CASE WHEN o_custkey % 10 = 0 THEN 1 ELSE 0 END) AS marked, sum(CASE WHEN o_custkey % 10 = 0 THEN 90 ELSE 0 END) AS seconds FROM (SELECT DISTINCT o_custkey FROM orders)")
def partition_mark(spark, sf):
    """Marking by ids taken from the table."""
    known = _partitions(spark, sf)
    start = F.lit("2024-01-20 12:28:30").cast("timestamp")
    out = control.mark(known, known.where("id % 10 = 0").select("id"), "compaction", start, _now(), False)
    hit = F.col("compaction_ok") == F.lit(False)
    return out.agg(F.count_if(hit).cast("decimal(38,0)").alias("marked"), F.sum(F.when(hit, F.col("compaction_time")).otherwise(0)).cast("decimal(38,0)").alias("seconds"))


# --- flows and writers ---


@query(M + "SELECT count(*) AS n, count(DISTINCT client) AS flows FROM m")
def flow_symmetric_key(spark, sf):
    """Both directions of a flow have one key."""
    p = pseudo.packets(spark, sf)
    return p.agg(F.count("*").alias("n"), F.count_distinct(lb.flow_key(F.col("src"), F.col("dst"))).alias("flows"))


@query(M + "SELECT client, 1 AS partitions FROM m GROUP BY client")
def flow_partition(spark, sf):
    dealt = by_flow(pseudo.packets(spark, sf), 8).withColumn("part", F.spark_partition_id())
    client = F.when(F.col("srcp") == 53, F.col("dst")).otherwise(F.col("src"))
    return dealt.groupBy(client.alias("client")).agg(F.count_distinct("part").cast("int").alias("partitions"))


@query(M + "SELECT DISTINCT pcap_file FROM m")
def balance_union(spark, sf):
    """Rows dealt to writers and united again; the files that they touch."""
    m = pseudo.messages(spark, sf)
    return balance(m.where("qr = 0"), 4).unionByName(balance(m.where("qr = 1"), 4)).select("pcap_file").distinct()


@query(M + "SELECT pcap_file, CASE WHEN count(*) = 0 THEN '0' ELSE printf('%.2f', round(count_if(qr = 1) * 100.0::DOUBLE / count(*), 2)) END AS share, CAST((max(time) - min(time)) // 1000 AS INTEGER) AS seconds FROM m GROUP BY pcap_file")
def percent_elapsed(spark, sf):
    per = pseudo.messages(spark, sf).groupBy("pcap_file").agg(F.count_if(F.col("qr") == 1).alias("r"), F.count("*").alias("n"), F.min("time").alias("a"), F.max("time").alias("b"))
    return per.select("pcap_file", lb.percent(F.col("r"), F.col("n")).alias("share"), elapsed_seconds(query_ts(F.col("a")), query_ts(F.col("b"))).alias("seconds"))


@query("SELECT DISTINCT concat('year=', year(ts), '/month=', month(ts), '/day=', day(ts), '/server=', CASE user_id % 2 WHEN 0 THEN 'ns1' ELSE '__default__' END) AS path FROM events")
def partition_path(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet").select("ts", F.when(F.col("user_id") % 2 == 0, " ns 1").alias("server"))
    return ev.select(lb.partition_path("dns", F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.col("server")).alias("path")).distinct()


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-minute response codes of matched traffic."""
    return _series(metrics.RCODE)(spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
