"""Packets and dimensions made from the driver's tables, which hold no network data."""

from __future__ import annotations

import bz2
import gzip
import io
import lzma
import struct
from collections.abc import Callable, Iterable, Iterator
from itertools import batched, chain, groupby
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.ip import MAPPED, ip_key
from tidewire.functions.times import epoch_ms
from tidewire.sources import capture, pcap


def _div(a: str, b: int) -> Column:
    return F.expr(f"{a} div {b}")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One DNS message per row of ``events``."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    base = ev.select("event_id", "event_type", "ts", "value", F.col("user_id").alias("u"), k.alias("k"))
    return base.select(
        F.col("event_id").alias("seq"),
        epoch_ms(F.col("ts")).alias("time"),
        F.when(F.col("event_type").isin("view", "click", "signup"), 0).otherwise(1).alias("qr"),
        (F.col("u") % 16).cast("int").alias("id"),
        F.concat(F.lit("10."), F.col("u") % 4, F.lit("."), _div("u", 4) % 256, F.lit("."), F.col("u") % 3).alias("client"),
        (1024 + F.col("u")).cast("int").alias("port"),
        F.when(F.col("k") % 25 != 0, F.concat(F.lit("n"), F.col("k") % 4, F.lit(".example.com."))).alias("qname"),
        F.element_at(F.array(*[F.lit(t) for t in (1, 2, 15, 28, 252, 251)]), F.col("k") % 6 + 1).alias("qtype"),
        (F.col("k") % 6).alias("rcode"),
        F.when(F.col("k") % 3 > 0, 17).otherwise(6).alias("prot"),
        F.when(F.col("u") % 2 == 0, 4).otherwise(6).alias("ipv"),
        F.when((F.col("k") % 3 == 0) & (F.col("value") < 100), F.floor(F.col("value") * 10).cast("int")).alias("tcp_hs_rtt"),
        F.concat(F.lit("cap-"), F.date_format("ts", "yyyy-MM-dd")).alias("pcap_file"),
        F.col("u"),
        F.col("k"),
    )


#: The same in DuckDB, as the first common table expression ``m``.
MESSAGES_SQL = """
ev AS (SELECT event_id, event_type, ts, value, user_id AS u, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
m AS (
  SELECT event_id AS seq, epoch_us(ts) // 1000 AS time,
         CASE WHEN event_type IN ('view', 'click', 'signup') THEN 0 ELSE 1 END AS qr,
         CAST(u % 16 AS INTEGER) AS id,
         concat('10.', u % 4, '.', (u // 4) % 256, '.', u % 3) AS client,
         CAST(1024 + u AS INTEGER) AS port,
         CASE WHEN k % 25 <> 0 THEN concat('n', k % 4, '.example.com.') END AS qname,
         CASE k % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 15 WHEN 3 THEN 28 WHEN 4 THEN 252 ELSE 251 END AS qtype,
         k % 6 AS rcode, CASE WHEN k % 3 > 0 THEN 17 ELSE 6 END AS prot, CASE WHEN u % 2 = 0 THEN 4 ELSE 6 END AS ipv,
         CASE WHEN k % 3 = 0 AND value < 100 THEN CAST(floor(value * 10) AS INTEGER) END AS tcp_hs_rtt,
         concat('cap-', strftime(ts, '%Y-%m-%d')) AS pcap_file, u, k
  FROM ev)
"""


def _key(number: Column) -> Column:
    return F.concat(F.lit(MAPPED), F.lower(F.lpad(F.hex(number), 8, "0")))


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries: 10.r.0.0/16 per region, and 10.(n % 4).n.0/24 inside them per nation."""
    region, nation = spark.read.parquet(f"{sf_dir}/region.parquet"), spark.read.parquet(f"{sf_dir}/nation.parquet")
    wide = region.select((F.lit(10 << 24) + F.col("r_regionkey").cast("long") * 65536).alias("a"), F.lit(65535).alias("w"), F.lit(112).alias("prefix_len"), F.col("r_name").alias("country"))
    n = F.col("n_nationkey").cast("long")
    narrow = nation.select((F.lit(10 << 24) + n % 4 * 65536 + n * 256).alias("a"), F.lit(255).alias("w"), F.lit(120).alias("prefix_len"), F.col("n_name").alias("country"))
    return wide.unionByName(narrow).select(_key(F.col("a")).alias("lo"), _key(F.col("a") + F.col("w")).alias("hi"), "prefix_len", "country")


def asn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Networks: 10.(s % 4).(s % 50).0/24 per supplier; the least name wins where they share one."""
    s = F.col("s_suppkey")
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    start = F.lit(10 << 24) + s % 4 * 65536 + s % 50 * 256
    per = sup.groupBy(start.alias("a")).agg(F.min("s_suppkey").alias("s"))
    return per.select(
        _key(F.col("a")).alias("lo"), _key(F.col("a") + 255).alias("hi"), F.lit(120).alias("prefix_len"),
        F.concat(F.lit("AS"), F.col("s")).alias("asn"), F.concat(F.lit("Org "), F.col("s")).alias("asn_organisation"),
    )


def resolvers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider per region, with overlapping ranges from 10.p.0.0 on; the first four have names."""
    p = F.col("r_regionkey").cast("long")
    reg = spark.read.parquet(f"{sf_dir}/region.parquet")
    named = F.try_element_at(F.array(*[F.lit(x) for x in ("CloudFlare", "Google", "OpenDNS", "Quad9")]), (p + 1).cast("int"))
    names = F.coalesce(named, F.concat(F.lit("Provider "), p))
    rows = reg.select(p.cast("int").alias("priority"), names.alias("name"), (F.lit(10 << 24) + p * 65536).alias("a"), F.when(p == 0, 1023).when(p == 1, 4095).otherwise(196607).alias("w"))
    return rows.select("priority", "name", _key(F.col("a")).alias("lo"), _key(F.col("a") + F.col("w")).alias("hi"), F.lit(112).alias("prefix_len"))


#: The dimensions in DuckDB, over plain numbers.
GEO_SQL = """
geo AS (
  SELECT 167772160 + r_regionkey * 65536 AS lo, 167772160 + r_regionkey * 65536 + 65535 AS hi, 112 AS prefix_len, r_name AS country FROM region
  UNION ALL SELECT 167772160 + n_nationkey % 4 * 65536 + n_nationkey * 256, 167772160 + n_nationkey % 4 * 65536 + n_nationkey * 256 + 255, 120, n_name FROM nation),
net AS (
  SELECT lo, lo + 255 AS hi, concat('AS', s) AS asn, concat('Org ', s) AS asn_organisation
  FROM (SELECT 167772160 + s_suppkey % 4 * 65536 + s_suppkey % 50 * 256 AS lo, min(s_suppkey) AS s FROM supplier GROUP BY 1)),
res AS (
  SELECT r_regionkey AS priority, CASE r_regionkey WHEN 0 THEN 'CloudFlare' WHEN 1 THEN 'Google' WHEN 2 THEN 'OpenDNS' WHEN 3 THEN 'Quad9' ELSE concat('Provider ', r_regionkey) END AS name,
         167772160 + r_regionkey * 65536 AS lo, 167772160 + r_regionkey * 65536 + CASE r_regionkey WHEN 0 THEN 1023 WHEN 1 THEN 4095 ELSE 196607 END AS hi
  FROM region),
ad AS (SELECT client, min(167772160 + u % 4 * 65536 + (u // 4) % 256 * 256 + u % 3) AS ip FROM m GROUP BY client),
info AS (
  SELECT client, ip,
         (SELECT arg_min(country, 1000 - prefix_len) FROM geo WHERE ip BETWEEN lo AND hi) AS country,
         (SELECT min(asn) FROM net WHERE ip BETWEEN lo AND hi) AS asn,
         (SELECT min(asn_organisation) FROM net WHERE ip BETWEEN lo AND hi) AS asn_organisation,
         (SELECT arg_min(name, priority) FROM res WHERE ip BETWEEN lo AND hi) AS pub_resolver
  FROM ad)
"""


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as decoded packets with nested messages, for the row projections."""
    m = messages(spark, sf_dir)
    is_q = F.col("qr") == 0
    server = F.lit("192.0.2.53")
    bit = lambda n: F.col("k") % n == 0
    question = F.struct(F.col("qname").alias("qname"), F.col("qtype").alias("qtype"), F.lit(1).alias("qclass"))
    questions = F.when(F.col("qname").isNotNull(), F.array(question)).otherwise(F.array().cast("array<struct<qname:string,qtype:int,qclass:int>>"))
    option = lambda code, data: F.struct(F.lit(code).alias("code"), data.alias("data"))
    options = F.filter(
        F.array(
            F.when(bit(2), option(12, F.unhex(F.repeat(F.lit("00"), F.col("k") % 7)))),
            F.when(bit(3), option(14, F.unhex(F.lpad(F.hex(F.col("k").cast("long") * 257), 8, "0")))),
            F.when(bit(5), option(8, F.concat(F.unhex(F.lit("00011800")), F.unhex(F.lpad(F.hex(F.lit(10 * 65536) + F.col("u") % 4 * 256 + _div("u", 4) % 256), 6, "0"))))),
            F.when(bit(7), option(10, F.unhex(F.lit("0102030405060708")))),
            F.when(bit(11), option(99, F.unhex(F.lit("")))),
            F.when(bit(4), option(3, F.encode(F.concat(F.lit("ns"), F.col("k")), "UTF-8"))),
        ),
        lambda o: o.isNotNull(),
    )
    opt = F.when(F.col("k") % 10 < 7, F.struct(F.lit(1232).alias("udp"), F.lit(0).alias("version"), bit(2).alias("dnssec_ok"), options.alias("options")))
    message = F.struct(
        "id", "qr", F.lit(0).alias("opcode"), "rcode", bit(2).alias("aa"), bit(3).alias("tc"), bit(5).alias("rd"), bit(7).alias("ra"),
        F.lit(False).alias("z"), bit(11).alias("ad"), bit(13).alias("cd"), F.size(questions).alias("qdcount"), (F.col("k") % 3).alias("ancount"),
        (F.col("k") % 2).alias("nscount"), F.lit(1).alias("arcount"), (F.col("k") + 40).alias("bytes"), questions.alias("questions"), opt.alias("opt"),
    )
    return m.select(
        "seq", "time", "pcap_file", F.concat(F.lit("ns"), F.col("u") % 3, F.lit("_ams")).alias("server"), F.lit("ams").alias("server_location"),
        "ipv", "prot", (F.col("k") % 64 + 1).alias("ttl"), (F.col("k") + 68).alias("ip_len"),
        F.when(is_q, F.col("client")).otherwise(server).alias("src"), F.when(is_q, server).otherwise(F.col("client")).alias("dst"),
        F.when(is_q, F.col("port")).otherwise(53).alias("srcp"), F.when(is_q, F.lit(53)).otherwise(F.col("port")).alias("dstp"),
        bit(2).alias("df"), bit(17).alias("fragmented"), (F.col("k") % 3 + 2).alias("frags"), F.coalesce("tcp_hs_rtt", F.lit(-1)).alias("tcp_hs_rtt"),
        F.array(message).alias("messages"),
    )


SUFFIXES = ("", ".gz", ".xz", ".bz2")
SERVER = "192.0.2.53"
#: The EDNS option (code of local use) that tells a client's port where it does not fit the 16 bits on the wire.
WIDE_PORT = 65100


def _packet(row: dict, seqs: dict) -> bytes:
    """A UDP message, a TCP segment of two messages, or, without a name, an ICMP error that quotes a query."""
    ends = (row["client"], SERVER) if row["qr"] == 0 else (SERVER, row["client"])
    port = row["port"] & 0xFFFF
    opt = None if port == row["port"] else capture.option(WIDE_PORT, struct.pack(">q", row["port"]))
    ports = (port, 53) if row["qr"] == 0 else (53, port)
    if row["qname"] is None:
        quoted = capture.ip(capture.udp(capture.dns(row["id"], qname=f"q{row['k'] % 4}.example.com.", qtype=row["qtype"], opt=opt), port), 17, row["client"], SERVER)
        return capture.ip(bytes([3, 3]) + bytes(6) + quoted, 1, SERVER, row["client"])
    told = [capture.dns(row["id"] + 16 * i, row["qr"] == 1, row["qname"], row["qtype"], row["rcode"], opt=opt) for i in (0, 1)]
    if row["prot"] == 17:
        return capture.ip(capture.udp(told[0], *ports), 17, *ends)
    flow, data = (*ends, *ports), capture.framed(*told)
    at = seqs.get(flow, 1000)
    seqs[flow] = (at + len(data)) & 0xFFFFFFFF
    return capture.ip(capture.tcp(data, at, *ports), 6, *ends)


def full_port(opt: Column, port: Column) -> Column:
    """A client's port: as its message's EDNS option tells it, else as on the wire."""
    told = F.try_element_at(F.filter(opt["options"], lambda o: o["code"] == WIDE_PORT), F.lit(1))["data"]
    return F.coalesce(F.conv(F.hex(told), 16, -10).cast("long"), port.cast("long")).cast("int")


class _Capture:
    """One file that is written packet by packet and compressed at once; ``taken`` gives its bytes so far and forgets them."""

    def __init__(self, suffix: str):
        self.suffix, self.seqs, self.out = suffix, {}, io.BytesIO()
        pack = {"": lambda f: f, ".gz": lambda f: gzip.GzipFile(fileobj=f, mode="wb", mtime=0), ".xz": lambda f: lzma.open(f, "wb"), ".bz2": lambda f: bz2.open(f, "wb")}
        self.file = pack[suffix](self.out)
        self.file.write(capture.pcap([]))

    def add(self, rows: Iterable[dict]) -> None:
        self.file.write(capture.pcap([(row["time"], _packet(row, self.seqs)) for row in rows], header=False))

    def end(self) -> None:
        if self.suffix:
            self.file.close()  # ends the compressed data, not what they are written to

    def taken(self) -> bytes:
        data = self.out.getvalue()
        self.out.seek(0)
        self.out.truncate()
        return data


#: Packets that are written at once.
PIECE = 1_000


def pieces(suffix: str, rows: Iterable[dict], damaged: bool = False) -> Iterator[bytes]:
    """The bytes of a capture as its rows pass; of a ``damaged`` one only the first are its own."""
    file, head = _Capture(suffix), b""
    for some in batched(rows, PIECE):
        file.add(some)
        if damaged:
            head = (head + file.taken())[:20]
        else:
            yield file.taken()
    file.end()
    last = file.taken()
    yield ((head + last)[:20] if suffix else b"") + bytes([7]) * 64 if damaged else last


def captures(spark: SparkSession, sf_dir: str, damaged: bool = False) -> tuple[DataFrame, Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[str, BinaryIO]]]]:
    """Rows, and what makes a partition's capture files (name, stream) of them, for ``pcap.decode_streams``.

    One file a day, plain or compressed by the day; ``damaged``: those of each
    fifth day are broken. A file is written as it is read, so none is held.
    """

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, BinaryIO]]:
        rows = chain.from_iterable(batch.to_pylist() for batch in batches)
        for name, own in groupby(rows, lambda row: row["pcap_file"]):
            day = int(name[-2:])
            suffix = SUFFIXES[day % 4]
            yield f"{name}.pcap{suffix}", io.BufferedReader(pcap.Pieces(pieces(suffix, own, damaged and day % 5 == 0)))

    # the port is as wide as the user: a capture takes any, only a query that returns it casts it
    port = (1024 + F.col("u")).alias("port")
    rows = messages(spark, sf_dir).select("pcap_file", "seq", "time", "qr", "id", "client", port, "qname", "qtype", "rcode", "prot", "k")
    # a file's packets come in the order of their times, as streams, so that no task holds a day's rows
    return rows.repartition("pcap_file").sortWithinPartitions("pcap_file", "time", "seq"), files


__all__ = ["GEO_SQL", "MESSAGES_SQL", "asn", "captures", "full_port", "geo", "ip_key", "messages", "packets", "resolvers"]
