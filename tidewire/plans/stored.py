"""Registered queries over captures, stored tables, the catalog and streams, each with its DuckDB SQL.

Captures are made from the driver's tables and decoded like any other. Stored
tables are written once a session in the folder that driver and executors share.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewire.functions import labels as lb
from tidewire.operators import control, maintenance, metrics, rows
from tidewire.operators import files as inputs
from tidewire.operators.routing import explode_messages, split
from tidewire.plans import catalogue, ddl, pseudo
from tidewire.schema import LEDGER_SCHEMA
from tidewire.sources import pcap, prefixes, sink
from tidewire.sources.storage import Storage, shared_dir
from tidewire.streaming import metrics as stream_metrics

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}
_made: dict[tuple, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[f.__name__], _sql[f.__name__] = f, sql
        return f

    return add


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one; it goes when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    Storage(spark).mkdir(path)
    return Storage(spark).delete_on_exit(path)


def _once(spark: SparkSession, name: str, sf: str, make: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, name, sf)
    if key not in _made:
        path = _folder(spark, name)
        make(path)
        _made[key] = path
    return _made[key]


def _lake(spark: SparkSession, sf: str) -> str:
    """The dns table, stored by year, month, day and server."""
    return _once(spark, "lake", sf, lambda path: sink.write(catalogue._packet_rows(spark, sf), f"{path}/dns", "dns")) + "/dns"


#: Rows of the stored table in DuckDB: their time, day and server.
STORED_SQL = catalogue._DNS_SQL + ", x AS (SELECT coalesce(q.time, r.time) AS time, coalesce(q.qname, r.qname) AS qname, concat('ns', coalesce(q.u, r.u) % 3, '_ams') AS server FROM t), p AS (SELECT *, make_timestamp(time * 1000) AS ts FROM x)"
_PLACE_SQL = "concat('year=', year(ts), '/month=', month(ts), '/day=', day(ts), '/server=', server)"

# --- captures ---


def _decoded(spark, sf, damaged=False):
    return pcap.decode_streams(*pseudo.captures(spark, sf, damaged), "ns1_ams")


def _file_sql(day: str = "day(ts)") -> str:
    return f"concat('cap-', strftime(ts, '%Y-%m-%d'), '.pcap', CASE {day} % 4 WHEN 0 THEN '' WHEN 1 THEN '.gz' WHEN 2 THEN '.xz' ELSE '.bz2' END)"


_AT = catalogue.M.rstrip() + f", c AS (SELECT *, {_file_sql()} AS file FROM (SELECT *, make_timestamp(time * 1000) AS ts FROM m))"


@query(_AT + ", e AS (SELECT *, unnest(CASE prot WHEN 17 THEN [0] ELSE [0, 16] END) AS more FROM c WHERE qname IS NOT NULL) SELECT file AS pcap_file, time, qr, CAST(id + more AS INTEGER) AS id, qname, qtype, CAST(rcode * qr + rcode * (1 - qr) AS INTEGER) AS rcode, client, port, prot, 'ams' AS server_location FROM e")
def capture_messages(spark, sf):
    """Messages of plain and compressed captures: UDP packets, and TCP segments that hold two."""
    dns, _, _ = split(_decoded(spark, sf).where("error IS NULL"))
    found = explode_messages(dns)
    m = found.withColumn("port", pseudo.full_port(F.col("message.opt"), F.col("port")))
    return m.select("pcap_file", "time", "qr", "id", "qname", "qtype", F.col("message.rcode").alias("rcode"), "client", "port", "prot", "server_location")


@query(_AT + "SELECT file AS pcap_file, time, 3 AS icmp_type, 3 AS icmp_code, '192.0.2.53' AS ip_src, client AS ip_dst, id AS orig_dns_id, concat('q', k % 4, '.example.com.') AS orig_dns_qname, qtype AS orig_dns_qtype, 17 AS orig_l4_prot, port AS orig_l4_srcp, 53 AS orig_l4_dstp FROM c WHERE qname IS NULL")
def capture_icmp(spark, sf):
    """ICMP errors of captures with the queries that they quote."""
    _, icmp, _ = split(_decoded(spark, sf).where("error IS NULL"))
    orig = F.col("icmp.orig")
    full = orig.withField("srcp", pseudo.full_port(orig["message"]["opt"], orig["srcp"]))
    found = icmp.withColumn("icmp", F.col("icmp").withField("orig", full))
    return rows.icmp_rows(found).select("pcap_file", "time", "icmp_type", "icmp_code", "ip_src", "ip_dst", "orig_dns_id", "orig_dns_qname", "orig_dns_qtype", "orig_l4_prot", "orig_l4_srcp", "orig_l4_dstp")


@query(_AT + "SELECT file AS pcap_file, day(any_value(ts)) % 5 = 0 AS rejected FROM c GROUP BY file")
def capture_rejects(spark, sf):
    """Damaged captures give a reject row and do not end the run."""
    return _decoded(spark, sf, damaged=True).groupBy("pcap_file").agg(F.bool_or(F.col("error").isNotNull()).alias("rejected"))


@query(_AT + "SELECT file AS pcap_file, count(*) AS packets, max(time) - min(time) AS ms FROM c GROUP BY file")
def capture_throughput(spark, sf):
    return metrics.throughput(_decoded(spark, sf).where("error IS NULL")).select("pcap_file", "packets", "ms")


# --- stored tables ---


@query(STORED_SQL + "SELECT year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, day(ts)::INTEGER AS day, server, count(*) AS n, min(time) AS first, max(qname) AS last_name FROM p GROUP BY ALL")
def stored_partitions(spark, sf):
    """Rows written to partitions and read back by the declared schema."""
    table = maintenance.read_table(spark, _lake(spark, sf), "dns")
    return table.groupBy("year", "month", "day", "server").agg(F.count("*").alias("n"), F.min("time").alias("first"), F.max("qname").alias("last_name"))


@query(STORED_SQL + "SELECT count(*) AS n FROM p WHERE year(ts) = 2024 AND month(ts) = 1 AND day(ts) = 5 AND server = 'ns1_ams'")
def partition_prune(spark, sf):
    """One partition of the stored table; the others are not read."""
    table = maintenance.read_table(spark, _lake(spark, sf), "dns")
    return table.where("year = 2024 AND month = 1 AND day = 5 AND server = 'ns1_ams'").agg(F.count("*").alias("n"))


def _one_partition(spark, sf, name, times):
    """A table of the first partition alone, appended ``times`` times over: (root, place)."""
    found = catalogue._packet_rows(spark, sf)
    place = sink.partitions_of(found, "dns").agg(F.min("path")).first()[0]
    root = _folder(spark, name)
    own = sink.with_partitions(found, "dns")
    path = lb.partition_path("dns", F.col("year"), F.col("month"), F.col("day"), F.col("server"))
    one = own.where(path == place).drop("year", "month", "day")
    for _ in range(times):
        sink.write(one, root, "dns")
    return root, place


@query(STORED_SQL + f", o AS (SELECT * FROM p WHERE {_PLACE_SQL} = (SELECT min({_PLACE_SQL}) FROM p)) SELECT time, time AS query_ms, qname, 1 AS files FROM (SELECT * FROM o UNION ALL SELECT * FROM o UNION ALL SELECT * FROM o)")
def compact_stored(spark, sf):
    """A partition of three appends, compacted to one file with ``query_ts``."""
    root, place = _one_partition(spark, sf, "compact", 3)
    n = maintenance.compact(spark, root, "dns", place)
    return maintenance.read_table(spark, root, "dns").select("time", F.unix_millis("query_ts").alias("query_ms"), "qname", F.lit(n).alias("files"))


@query(STORED_SQL + f"SELECT time, qname, CAST(NULL AS VARCHAR) AS src, CAST(NULL AS VARCHAR) AS subnet FROM p WHERE {_PLACE_SQL} = (SELECT min({_PLACE_SQL}) FROM p)")
def purge_stored(spark, sf):
    """A partition after the removal of personal data."""
    root, place = _one_partition(spark, sf, "purge", 1)
    maintenance.purge(spark, root, "dns", place)
    return maintenance.read_table(spark, root, "dns").select("time", "qname", "src", F.col("edns_client_subnet").alias("subnet"))


@query(STORED_SQL + "SELECT server, count(*) AS n, 0 AS added FROM p GROUP BY server")
def catalog_partitions(spark, sf):
    """The stored table through the catalog: database, table, partitions, statistics, additive upgrade."""
    root, database = _lake(spark, sf), f"traffic_{uuid.uuid4().hex[:12]}"
    ddl.create_database(spark, database, _folder(spark, "db"), "it's traffic")
    ddl.create_table(spark, database, "dns", root)
    found = sink.partitions_of(catalogue._packet_rows(spark, sf), "dns").orderBy("path").collect()  # as many as there are partitions
    values = [{k: r[k] for k in ("year", "month", "day", "server")} for r in found]
    ddl.add_partitions(spark, f"{database}.dns", [(v, lb.append_path(root, r["path"])) for v, r in zip(values, found, strict=True)])
    ddl.refresh(spark, f"{database}.dns")
    for v in values[:1]:
        ddl.compute_stats(spark, f"{database}.dns", v)
    added = ddl.upgrade(spark, f"{database}.dns", "dns")
    return spark.table(f"{database}.dns").groupBy("server").agg(F.count("*").alias("n")).withColumn("added", F.lit(len(added)))


# --- files ---


@query(f"SELECT file, CASE day % 3 WHEN 0 THEN 'archive' WHEN 1 THEN 'in' ELSE 'gone' END AS place FROM {catalogue._FILES_SQL}")
def archive_cycle(spark, sf):
    """Processed files that are archived, kept and deleted, and where they then are."""
    store, root = Storage(spark), _folder(spark, "files")
    names = [(r["file"], r["day"]) for r in catalogue._files(spark, sf).select("file", "day").collect()]  # as many as there are files
    for file, day in names:
        store.write(f"{root}/in/{file}", "x")
        maintenance.archive(spark, f"{root}/in/{file}", (maintenance.ARCHIVE, maintenance.NONE, maintenance.DELETE)[day % 3], f"{root}/archive")
    where = [(file, next((p for p in ("in", "archive") if store.exists(f"{root}/{p}/{file}")), "gone")) for file, _ in names]
    return spark.createDataFrame(where, "file string, place string")


@query(f"SELECT file, octet_length(encode(file)) AS bytes FROM {catalogue._FILES_SQL} WHERE file LIKE '%.gz' OR file LIKE '%.xz'")
def files_discovered(spark, sf):
    """Compressed captures of a folder that holds others, too; their contents are not read."""
    store, root = Storage(spark), _folder(spark, "found")
    for row in catalogue._files(spark, sf).select("file").collect():  # as many as there are files
        store.write(f"{root}/{row['file']}", row["file"])
    store.write(f"{root}/notes.txt", "x")
    return inputs.discover(spark, root, [".gz", ".xz"]).select("file", F.col("bytes").cast("int").alias("bytes"))


_LEDGER_SQL = "(SELECT o_orderkey AS id, concat('f', o_custkey) AS file, CASE WHEN o_orderkey % 2 = 0 THEN 'ns1' ELSE 'ns2' END AS server, o_orderdate AS began FROM orders)"


def _ledger(spark, sf):
    own = spark.read.parquet(f"{sf}/orders.parquet")
    cols = {"id": F.col("o_orderkey"), "file": F.concat(F.lit("f"), "o_custkey"), "server": F.when(F.col("o_orderkey") % 2 == 0, "ns1").otherwise("ns2"), "date_start": F.col("o_orderdate").cast("timestamp")}
    return own.select(*[cols.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA.fields])


@query(f"SELECT id, server FROM {_LEDGER_SQL} WHERE file = 'f7' AND server = 'ns1'")
def ledger_find(spark, sf):
    return control.find_file(_ledger(spark, sf), "f7", "ns1").select("id", "server")


@query(f"SELECT id FROM {_LEDGER_SQL} WHERE began >= TIMESTAMP '1996-01-01 00:00:00'")
def ledger_forget(spark, sf):
    """The ledger without files older than 366 days on the second of January 1997."""
    return control.forget(_ledger(spark, sf), 367, F.lit("1997-01-02 00:00:00").cast("timestamp")).select("id")


@query(f"SELECT id, path FROM {catalogue._PARTS_SQL} WHERE table_name = 'dns' AND path = 'p42'")
def partition_find(spark, sf):
    return control.find_partition(catalogue._partitions(spark, sf), "dns", "p42").select("id", "path")


# --- prefix lists and range files ---

_LISTS_SQL = """SELECT 'lines' AS kind, concat('10.', r_regionkey, '.0.0/16') AS prefix FROM region
UNION ALL SELECT 'lines', concat('192.0.2.', r_regionkey, '/32') FROM region UNION ALL SELECT 'lines', concat('2001:db8::', r_regionkey, '/128') FROM region
UNION ALL SELECT 'records', concat('10.', n_nationkey, '.0.0/24') FROM nation WHERE n_nationkey % 2 = 0
UNION ALL SELECT 'page', concat('10.9.', n_nationkey, '.0/24') FROM nation UNION ALL SELECT 'page', concat('2001:db8:', n_nationkey, '::/48') FROM nation WHERE n_nationkey % 3 = 0"""


@query(_LISTS_SQL)
def resolver_lists(spark, sf):
    """Prefixes of resolvers from a list, from text records and from a page's table."""
    regions = [r["r_regionkey"] for r in spark.read.parquet(f"{sf}/region.parquet").select("r_regionkey").collect()]  # five
    nations = [r["n_nationkey"] for r in spark.read.parquet(f"{sf}/nation.parquet").select("n_nationkey").collect()]  # twenty-five
    path = _folder(spark, "lists") + "/prefixes.txt"
    Storage(spark).write(path, "\n".join([f" 10.{r}.0.0/16 \n192.0.2.{r}\n\n2001:db8::{r}" for r in regions]))
    records = ["\n".join(f"10.{n}.0.0/24 site" if n % 2 == 0 else f"10.{n}.0.0/24 one two" for n in nations)]
    cells = "".join(f"<tr><td>a</td><td>b</td><td>10.9.{n}.0/24</td><td>{f'2001:db8:{n}::/48' if n % 3 == 0 else ''}</td></tr>" for n in nations)
    page = f"<table id=other><tr><td>x</td></tr></table><table id='networks'><tr><th>1</th></tr>{cells}</table>"
    found = {"lines": prefixes.read_list(spark, path), "records": prefixes.from_records(records), "page": prefixes.from_page(page)}
    return spark.createDataFrame([(kind, p) for kind, own in found.items() for four_six in prefixes.families(own) for p in four_six], "kind string, prefix string")


@query("SELECT concat('00000000000000000000ffff', lower(printf('%08x', 167772160 + n_nationkey * 65536 + 128 * (n_nationkey % 2)))) AS lo, concat('00000000000000000000ffff', lower(printf('%08x', 167772160 + n_nationkey * 65536 + 128 * (n_nationkey % 2) + 127))) AS hi, 121 AS prefix_len, n_name AS country FROM nation UNION ALL SELECT concat('20010db8', lower(printf('%04x', n_nationkey)), repeat('0', 20)), concat('20010db8', lower(printf('%04x', n_nationkey)), repeat('f', 20)), 48, n_name FROM nation")
def range_files(spark, sf):
    """A range table from CSV, with prefixes of odd lengths."""
    n = F.col("n_nationkey")
    own = spark.read.parquet(f"{sf}/nation.parquet")
    four = own.select(F.concat(F.lit("10."), n, F.lit(".0."), F.lit(5) + 128 * (n % 2), F.lit("/25")).alias("network"), F.col("n_name").alias("name"))
    six = own.select(F.concat(F.lit("2001:db8:"), F.lower(F.hex(n.cast("long"))), F.lit("::/48")), "n_name")
    path = _folder(spark, "ranges") + "/csv"
    four.unionByName(six.toDF("network", "name")).unionByName(spark.createDataFrame([("no prefix", "x"), (None, "y")], "network string, name string")).write.option("header", True).csv(path)
    return prefixes.read_ranges(spark, path, {"name": "country"})


# --- metrics out, and as a stream ---


@query(catalogue.MJ + "SELECT count(*) AS n, count(q_seq) AS requests, count(r_seq) AS responses, count_if(kind = 'expired')::BIGINT AS expired FROM j")
def operational_counts(spark, sf):
    """What is counted while matched rows pass."""
    seen = Observation()
    metrics.operational(catalogue._joined(spark, sf), seen).write.format("noop").mode("overwrite").save()
    found = seen.get
    return spark.createDataFrame([tuple(found[k] for k in ("rows", "requests", "responses", "expired"))], "n long, requests long, responses long, expired long")


@query("SELECT concat('p.', metric, '.ns.', server, ' ', CAST(value AS VARCHAR), ' ', bucket) AS value FROM (" + catalogue._series_sql("concat('dns.request.rcode.', rcode)") + ")")
def graphite_lines(spark, sf):
    return metrics.graphite_lines(catalogue._series(metrics.RCODE)(spark, sf), "p")


@query(catalogue._sql["minute_query_count"])
def stream_query_count(spark, sf):
    """``minute_query_count`` as a stream over files, a few at a time, until what is there is read."""
    root = _folder(spark, "stream")
    found = catalogue._metric_rows(spark, sf)
    found.repartition(6).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(found.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    write = lambda batch, _: batch.write.mode("overwrite").parquet(f"{root}/out")
    counted = stream_metrics.windowed(stream).writeStream.outputMode("complete").foreachBatch(write)
    run = counted.option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{root}/out").where(F.col("metric") == metrics.QUERY).select("bucket", "server", "metric", "value")


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
