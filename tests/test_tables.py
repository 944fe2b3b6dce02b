"""Rows, metrics, storage, control tables, catalog and streams."""

import time
from datetime import datetime

from tidewire.sources import capture as c
import pytest
from pyspark.sql import functions as F

from tidewire.operators import control, files, maintenance, metrics
from tidewire.operators.enrich import country, enrich, network, resolver, resolver_dim
from tidewire.operators.matching import match
from tidewire.operators.routing import explode_messages, split
from tidewire.plans import ddl, ingest
from tidewire.plans.engine import Engine
from tidewire.schema import DNS_SCHEMA, ICMP_SCHEMA, LEDGER_SCHEMA, PARTITION_SCHEMA
from tidewire.sources import pcap, sink
from tidewire.sources.storage import Storage
from tidewire.streaming import matcher
from tidewire.streaming import metrics as stream_metrics

NOON = 1_704_110_400_000  # 2024-01-01T12:00Z


def captures(folder):
    """Two files; the first leaves a query that the second answers."""
    opt = c.option(8, bytes([0, 1, 24, 0, 10, 9, 8])) + c.option(3, b"")
    first = [c.query(NOON, 1, qname="www.example.nl.", opt=opt), c.answer(NOON + 7, 1, qname="www.example.nl.", rcode=3, opt=c.option(3, b"ns1")), c.query(NOON + 10, 2, sport=41000)]
    icmp = (NOON + 11, c.ip(bytes([3, 3]) + b"\0" * 6 + c.ip(c.udp(c.dns(9)), 17), 1))
    second = [c.answer(NOON + 900, 2, sport=41000), c.query(NOON + 1000, 3, sport=42000), c.query(NOON + 9000, 4, sport=43000)]
    (folder / "a-1.pcap").write_bytes(c.pcap([*first, icmp]))
    (folder / "a-2.pcap").write_bytes(c.pcap(second))
    (folder / "broken.pcap").write_bytes(b"?")


def dims(spark):
    geo = spark.createDataFrame([("0" * 20 + "ffffc0000200", "0" * 20 + "ffffc00002ff", 120, "NL"), ("0" * 20 + "ffff0a000000", "0" * 20 + "ffff0affffff", 104, "US")], "lo string, hi string, prefix_len int, country string")
    net = spark.createDataFrame([("0" * 20 + "ffffc0000200", "0" * 20 + "ffffc00002ff", 120, "AS1", "One")], "lo string, hi string, prefix_len int, asn string, asn_organisation string")
    return [country(geo), network(net)], resolver(resolver_dim(spark, {"Quad9": ["192.0.2.0/24"], "Google": ["192.0.2.8/29"]}))


@pytest.fixture
def result(spark, tmp_path):
    captures(tmp_path)
    enrichers, res = dims(spark)
    return ingest.ingest(spark, str(tmp_path), ingest.Settings(server="ns1_ams", enrichers=enrichers, resolver=res))


def test_ingest(result):
    rows = {r["id"]: r for r in result.dns.collect()}
    assert sorted(rows) == [1, 2, 3] and result.files == ["a-1.pcap", "a-2.pcap", "broken.pcap"]
    one = rows[1]
    assert (one["rcode"], one["proc_time"], one["country"], one["asn"], one["pub_resolver"]) == (3, 7, "NL", "AS1", "Google")
    assert (one["domainname"], one["labels"], one["edns_client_subnet"], one["edns_client_subnet_country"]) == ("example.nl", 3, "1,10.9.8.0/24,0", "US")
    assert (one["edns_nsid"], one["server_location"], one["edns_other"]) == ("ns1", "ams", "3")
    assert rows[2]["proc_time"] == 890 and rows[2]["pcap_file"] == "a-1.pcap"
    assert (rows[3]["rcode"], rows[3]["ancount"], rows[3]["src"]) == (-1, None, c.CLIENT)
    assert {r["id"] for r in result.pending.collect()} == {4}
    icmp = result.icmp.collect()
    assert len(icmp) == 1 and icmp[0]["orig_dns_id"] == 9 and icmp[0]["ip_country"] == "NL"
    assert [r["pcap_file"] for r in result.rejected.collect()] == ["broken.pcap"]
    assert result.dns.columns[:60] == DNS_SCHEMA.names and result.icmp.columns == ICMP_SCHEMA.names


def test_ledger_and_newest(spark, tmp_path):
    captures(tmp_path)
    ledger = spark.createDataFrame([("a-1.pcap", "default")], "file string, server string")
    assert ingest.choose(spark, str(tmp_path), ledger, ingest.Settings(skip_newest=True)).keys() == {"a-2.pcap"}


def test_record(spark, result, tmp_path):
    began, ended = datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 10, 0, 9)
    ledger = ingest.record(spark, result, str(tmp_path), ingest.Settings(server="ns1_ams"), began, ended, maintenance.ARCHIVE, str(tmp_path / "done"))
    rows = {r["file"]: (r["rows"], r["time"], r["server"], r["mode"]) for r in ledger.collect()}
    assert rows == {"a-1.pcap": (4, 9, "ns1_ams", "ARCHIVE"), "a-2.pcap": (3, 9, "ns1_ams", "ARCHIVE"), "broken.pcap": (0, 9, "ns1_ams", "ARCHIVE")}
    assert sorted(p.name for p in (tmp_path / "done").glob("*.pcap")) == sorted(rows) and not list(tmp_path.glob("*.pcap"))
    assert ledger.columns == LEDGER_SCHEMA.names


def test_pending_queries_of_an_earlier_run(spark, tmp_path):
    for i, packets in enumerate(([c.query(NOON, 5), c.query(NOON + 1, 6, sport=41000)], [c.answer(NOON + 1500, 5)])):
        (tmp_path / f"{i}").mkdir()
        (tmp_path / f"{i}" / f"b-{i}.pcap").write_bytes(c.pcap(packets))
    first = ingest.ingest(spark, str(tmp_path / "0"))
    assert first.dns.count() == 0
    first.pending.write.parquet(str(tmp_path / "pending"))
    second = ingest.ingest(spark, str(tmp_path / "1"), pending=spark.read.parquet(str(tmp_path / "pending")))
    assert [(r["id"], r["proc_time"], r["pcap_file"]) for r in second.dns.collect()] == [(5, 1500, "b-0.pcap")]
    assert [r["id"] for r in second.pending.collect()] == [6]


def test_privacy(spark, tmp_path):
    captures(tmp_path)
    out = ingest.ingest(spark, str(tmp_path), ingest.Settings(privacy=True))
    assert out.dns.where("src IS NOT NULL OR edns_client_subnet IS NOT NULL").count() == 0
    assert out.icmp.where("ip_src IS NOT NULL OR orig_ip_src IS NOT NULL").count() == 0


def test_store_compact_purge(spark, result, tmp_path):
    root = str(tmp_path / "lake")
    touched = ingest.store(result, root)
    ingest.store(result, root)
    place = touched[0].collect()[0]["path"]
    assert place == "year=2024/month=1/day=1/server=ns1_ams"
    table = maintenance.read_table(spark, f"{root}/dns", "dns")
    assert table.count() == 6 and table.where("query_ts IS NOT NULL").count() == 0
    assert maintenance.compact(spark, f"{root}/dns", "dns", place) == 1
    table = maintenance.read_table(spark, f"{root}/dns", "dns")
    assert table.count() == 6 and table.where("query_ts IS NULL").count() == 0
    assert table.agg(F.min(F.unix_millis("query_ts"))).first()[0] == NOON
    assert maintenance.purge(spark, f"{root}/dns", "dns", place) == 1
    table = maintenance.read_table(spark, f"{root}/dns", "dns")
    assert table.count() == 6 and table.where("src IS NOT NULL OR edns_client_subnet IS NOT NULL OR query_ts IS NULL").count() == 0
    assert not Storage(spark).files(f"{root}/dns/_tmp")
    icmp = maintenance.read_table(spark, f"{root}/icmp", "icmp")
    assert icmp.first()["server"] == "ns1_ams"


def test_failed_swap_keeps_the_old_files(spark, result, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    place = ingest.store(result, root)[0].collect()[0]["path"]
    before = Storage(spark).files(f"{root}/dns/{place}")
    monkeypatch.setattr(Storage, "move", lambda *a: False)
    done, failed = maintenance.run_all([place, "never"], lambda p: maintenance.compact(spark, f"{root}/dns", "dns", p))
    assert (done, failed) == ([], place)
    assert Storage(spark).files(f"{root}/dns/{place}") == before


def test_catalog(spark, result, tmp_path):
    root = str(tmp_path / "lake")
    ingest.store(result, root)
    ddl.create_database(spark, "traffic", str(tmp_path / "db"), "it's a test")
    ddl.create_table(spark, "traffic", "dns", f"{root}/dns")
    day = {"year": 2024, "month": 1, "day": 1, "server": "ns1_ams"}
    ddl.add_partition(spark, "traffic.dns", day, f"{root}/dns/year=2024/month=1/day=1/server=ns1_ams")
    ddl.add_partition(spark, "traffic.dns", day, f"{root}/dns/year=2024/month=1/day=1/server=ns1_ams")
    ddl.refresh(spark, "traffic.dns")
    ddl.compute_stats(spark, "traffic.dns", day)
    assert spark.table("traffic.dns").where("server = 'ns1_ams'").count() == 3
    assert ddl.upgrade(spark, "traffic.dns", "dns") == []
    spark.sql(f"CREATE TABLE traffic.old (id INT) USING parquet LOCATION '{tmp_path}/old'")
    assert "query_ts" in ddl.upgrade(spark, "traffic.old", "dns") and ddl.upgrade(spark, "traffic.old", "dns") == []
    assert [ok for _, ok in ddl.run_statements(spark, "# note\nALTER TABLE traffic.old ADD COLUMNS (x INT);\n\nALTER TABLE traffic.old ADD COLUMNS (x INT)")] == [True, False]
    spark.sql("DROP DATABASE traffic CASCADE")


def test_data_source(spark, tmp_path):
    captures(tmp_path)
    pcap.register(spark)
    df = spark.read.format("pcap").option("server", "ns1_ams").load(str(tmp_path))
    plain = pcap.read(spark, str(tmp_path), "ns1_ams")
    key = ["pcap_file", "seq", "time", "server_location"]
    assert sorted(map(tuple, df.select(*key).collect())) == sorted(map(tuple, plain.select(*key).collect()))


def test_files(spark, tmp_path):
    for name in ("b.pcap.gz", "a.pcap", "c.txt"):
        (tmp_path / name).write_bytes(b"1")
    found = files.discover(spark, str(tmp_path))
    assert sorted(r["file"] for r in found.collect()) == ["a.pcap", "b.pcap.gz"]
    assert [r["file"] for r in files.discover(spark, str(tmp_path), [".gz"]).collect()] == ["b.pcap.gz"]
    assert files.expired(found, 30).count() == 0
    assert files.expired(found, 30, F.current_timestamp() + F.make_dt_interval(days=F.lit(31))).count() == 2


def test_storage_and_archive(spark, tmp_path):
    store, a = Storage(spark), tmp_path / "in" / "x.pcap"
    a.parent.mkdir()
    a.write_bytes(b"abc")
    assert store.exists(str(a)) and store.open(str(a)) == b"abc" and store.size(str(a.parent)) == 3
    assert maintenance.archive(spark, str(a), maintenance.NONE) == str(a)
    moved = maintenance.archive(spark, str(a), maintenance.ARCHIVE, str(tmp_path / "old"))
    assert not a.exists() and store.exists(moved)
    assert maintenance.clean_archive(spark, str(tmp_path / "old"), 1) == []
    store.chmod(moved, "600")
    assert store.expired(str(tmp_path / "old"), -1) and len(maintenance.clean_archive(spark, str(tmp_path / "old"), -1)) == 1
    a.write_bytes(b"1")
    assert maintenance.archive(spark, str(a), maintenance.DELETE) is None and not a.exists()


def partitions(spark):
    def row(i, day, updated, done=False):
        at = datetime(2024, 1, day, 12)
        cols = dict.fromkeys(PARTITION_SCHEMA.names)
        return tuple((cols | {"id": i, "engine": "spark", "table_name": "dns", "created": at, "year": 2024, "month": 1, "day": day, "server": "s", "path": f"p{i}", "updated_ts": updated, "compaction_ts": at if done else None, "compaction_ok": done or None}).values())

    rows = [row(1, 1, datetime(2024, 1, 2)), row(2, 1, datetime(2024, 1, 2), True), row(3, 9, datetime(2024, 1, 9, 23)), row(4, 10, datetime(2024, 1, 10))]
    return spark.createDataFrame(rows, PARTITION_SCHEMA)


def test_control(spark):
    known, now = partitions(spark), F.lit("2024-01-10 00:30:00").cast("timestamp")
    open_ = control.uncompacted(known, "spark")
    assert [r["id"] for r in open_.collect()] == [1, 3, 4]
    assert [r["id"] for r in control.due(open_, now, F.make_dt_interval(mins=F.lit(60))).collect()] == [1, 3]
    assert [r["id"] for r in control.due_for_purge(known, now).collect()] == [1, 2]
    assert [r["id"] for r in control.unpurged(known, "spark", F.lit("2024-01-09").cast("date")).collect()] == [3]
    assert [r["id"] for r in control.unpurged(known, "spark", F.lit("2024-01-09").cast("date"), up_to=True).collect()] == [1, 2, 3]
    seen = known.where("id = 1").select("table_name", "path", "year", "month", "day", "server")
    new = seen.withColumn("path", F.lit("new")).withColumn("server", F.lit(None).cast("string"))
    out = {r["path"]: r for r in control.upsert(known, seen.unionByName(new), now, "spark").collect()}
    assert out["new"]["id"] == 5 and out["p1"]["updated_ts"] == datetime(2024, 1, 10, 0, 30) and out["p3"]["updated_ts"] == datetime(2024, 1, 9, 23)
    assert control.ping(known, new, now).where(F.col("updated_ts") == now).count() == 0
    marked = control.mark(known, [3], "privacy_purge", F.lit("2024-01-10 00:29:00").cast("timestamp"), now, False).where("id = 3").first()
    assert (marked["privacy_purge_ok"], marked["privacy_purge_time"]) == (False, 60)
    assert control.find_partition(known, "dns", "p1").count() == 1
    ledger = spark.createDataFrame([tuple({**dict.fromkeys(LEDGER_SCHEMA.names), "id": i, "date_start": datetime(2024, 1, i), "file": "f", "server": "s"}.values()) for i in (1, 9)], LEDGER_SCHEMA)
    assert [r["id"] for r in control.forget(ledger, 5, now).collect()] == [9]
    assert control.find_file(ledger, "f", "s").count() == 2


def test_metrics(spark, result):
    found = {(r["metric"], r["bucket"]): r["value"] for r in result.metrics.collect()}
    at = NOON // 1000
    assert found[("dns.query", at)] == 3 and found[("dns.response", at)] == 2
    assert found[("geo.country.NL", at)] == 3 and found[("icmp", at)] == 1 and found[("udp", at)] == 3
    one = spark.createDataFrame([(0, "s", metrics.RTT, 10.0), (0, "s", metrics.RTT_SAMPLES, 1.0), (0, "s", "tcp", 2.0)], "bucket long, server string, metric string, value double")
    two = spark.createDataFrame([(0, "s", metrics.RTT, 40.0), (0, "s", metrics.RTT_SAMPLES, 2.0), (60, "s", "tcp", 2.0)], one.schema)
    both = {(r["metric"], r["bucket"]): r["value"] for r in metrics.merge(one, two).collect()}
    assert both == {(metrics.RTT, 0): 30.0, (metrics.RTT_SAMPLES, 0): 3.0, ("tcp", 0): 2.0, ("tcp", 60): 2.0}
    out, kept = metrics.flush(metrics.merge(one, two))
    assert {(r["metric"], r["bucket"]) for r in out.collect()} == {("tcp", 0)} and kept.count() == 3
    assert "p.tcp.ns.s 2.0 0" in [r["value"] for r in metrics.graphite_lines(one, "p").collect()]


def test_operational_counts(spark, result, tmp_path):
    from pyspark.sql import Observation

    messages = explode_messages(split(pcap.read(spark, str(tmp_path)).where("error IS NULL"))[0])
    seen = Observation()
    metrics.operational(match(messages)[0], seen).collect()
    assert seen.get["rows"] >= 2 and seen.get["requests"] >= 1


def test_flow_and_enrichment_of_nothing(spark):
    empty = spark.createDataFrame([], "src string")
    assert enrich(empty, "src", "", dims(spark)[0]).columns == ["src", "country", "asn", "asn_organisation"]


def test_streams(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    captures(source)
    packets = stream_metrics.packets(spark, str(source), "ns1_ams")
    messages = explode_messages(packets.where("error IS NULL AND prot = 17"))
    flat = messages.select((F.col("time") * 1000 + F.col("seq.seq")).alias("seq"), "time", "qr", "id", "qname", "qtype", "client", "port")
    query = matcher.match_stream(flat).writeStream.format("memory").queryName("matched").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {(r["request"] and r["request"]["id"], r["response"] and r["response"]["id"]) for r in spark.table("matched").collect()}
    assert {(1, 1), (2, 2)} <= got
    rows = messages.select("time", "prot", "ipv", "qtype", F.col("message.rcode").alias("rcode"), F.col("message.opcode").alias("opcode"), F.lit(None).cast("string").alias("country"), (F.col("qr") == 0).alias("dns_query"), (F.col("qr") == 1).alias("dns_response"), "server")
    query = stream_metrics.windowed(rows).writeStream.format("memory").queryName("counted").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    counted = {r["metric"]: r["value"] for r in spark.table("counted").collect()}
    assert counted["dns.query"] == 4 and counted["dns.response"] == 2
    sent = []
    query = stream_metrics.write_graphite(stream_metrics.windowed(rows, "0 seconds"), "p", "h", 1, str(tmp_path / "c3"), send=lambda lines, host, port: sent.extend(r["value"] for r in lines.collect()))
    query.awaitTermination(120)


def test_stream_expiry(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    schema = "seq long, time long, qr int, id int, qname string, qtype int, client string, port int"
    for i, rows in enumerate([[(0, NOON, 0, 1, "a.", 1, "c", 5)], [(1, NOON + 60_000, 0, 2, "b.", 1, "c", 6)], [(2, NOON + 61_000, 1, 1, "a.", 1, "c", 5)], [(3, NOON + 90_000, 0, 3, "b.", 1, "c", 7)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(source / f"{i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(source))
    query = matcher.match_stream(stream).writeStream.format("memory").queryName("late").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(180)
    rows = spark.table("late").collect()
    kinds = {(r["request"]["seq"] if r["request"] else None, r["response"]["seq"] if r["response"] else None, r["expired"]) for r in rows}
    assert (0, None, True) in kinds or (0, 2, False) in kinds


def test_send_graphite(spark):
    import socketserver
    import threading

    got = []

    class Handler(socketserver.StreamRequestHandler):
        def handle(self):
            got.extend(self.rfile.read().decode().split("\n"))

    with socketserver.ThreadingTCPServer(("127.0.0.1", 0), Handler) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        sink.send_graphite(spark.createDataFrame([("a 1 2",)], "value string"), "127.0.0.1", server.server_address[1])
        time.sleep(0.5)
        server.shutdown()
    assert "a 1 2" in got


def test_engine():
    calls = []

    def job():
        calls.append(1)
        if len(calls) == 1:
            raise ValueError("first")

    engine = Engine(job, 0.01)
    engine.run_once()
    assert engine.status()["last_error"] == "first"
    engine.start()
    time.sleep(0.2)
    engine.stop()
    n = len(calls)
    engine.run_once()
    assert n > 1 and engine.status()["enabled"] is False
    engine.close()


def test_known_files_are_not_opened(spark, tmp_path, monkeypatch):
    captures(tmp_path)
    asked, read = [], pcap.read
    monkeypatch.setattr(pcap, "read", lambda spark, paths, *a: asked.extend(paths) or read(spark, paths, *a))
    ledger = spark.createDataFrame([("a-1.pcap", "default"), ("broken.pcap", "default")], "file string, server string")
    out = ingest.ingest(spark, str(tmp_path), ingest.Settings(), ledger)
    assert out.files == ["a-2.pcap"] == [p.rsplit("/", 1)[-1] for p in asked] and out.packets.count() == 3


def test_damaged_archives_give_rejects(tmp_path):
    import gzip
    import io

    data = gzip.compress(c.pcap([c.query(NOON + i, i) for i in range(40)]), mtime=0)
    for at in range(len(data)):
        broken = bytearray(data)
        broken[at] ^= 0x55
        rows = list(pcap.rows_of("x.pcap.gz", io.BytesIO(bytes(broken)), None, None))
        assert all(r["error"] is None for r in rows[:-1])


def test_an_interrupted_swap_is_finished(spark, result, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    place = ingest.store(result, root)[0].collect()[0]["path"]
    ingest.store(result, root)
    folder, delete = f"{root}/dns/{place}", Storage.delete
    calls = []

    def fail(self, path, recursive=False):
        calls.append(path)
        if len(calls) == 2 and not recursive:
            raise OSError("gone")
        return delete(self, path, recursive)

    monkeypatch.setattr(Storage, "delete", fail)
    with pytest.raises(OSError):
        maintenance.compact(spark, f"{root}/dns", "dns", place)
    monkeypatch.undo()
    table = lambda: maintenance.read_table(spark, f"{root}/dns", "dns")
    assert table().count() < 6  # never twice
    assert maintenance.finish(spark, folder) and not maintenance.finish(spark, folder)
    assert table().count() == 6 and table().where("query_ts IS NULL").count() == 0


def test_archive_that_fails_says_so(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Storage, "move", lambda *a: False)
    with pytest.raises(OSError):
        maintenance.archive(spark, str(tmp_path / "x"), maintenance.ARCHIVE, str(tmp_path / "old"))


def test_range_columns(spark):
    from tidewire.functions.ip import cidr_bounds, cidr_columns

    given = ["10.1.2.3/9", "0.0.0.0/0", "192.0.2.77/31", "192.0.2.9", "2001:db8::5/33", "::/0", "2001:db8::1", "fe80::1/127", " 10.0.0.0/8 "]
    rows = spark.createDataFrame([(x,) for x in [*given, "no", "1.2.3.4/99", None]], "n string")
    got = [tuple(r) for r in rows.select(*cidr_columns(F.col("n"))).collect()]
    assert got[: len(given)] == [cidr_bounds(x) for x in given] and got[len(given)] == (None, None, None)
    assert all(g[0] is None for g in got[len(given) :])


def test_run_carries_its_state(spark, tmp_path):
    """Files one by one and stopped between them, then the rest: the same rows as all at once."""
    source, seen = tmp_path / "in", []
    source.mkdir()
    captures(source)
    settings = ingest.Settings(server="ns1_ams")
    rows = lambda root: sorted((r["id"], r["proc_time"], r["pcap_file"]) for r in maintenance.read_table(spark, f"{root}/dns", "dns").collect())
    whole, _ = ingest.run(spark, str(source), str(tmp_path / "one"), settings)
    asked = iter([False, True])
    first, _ = ingest.run(spark, str(source), str(tmp_path / "two"), settings, each=True, stop=lambda: next(asked), writers=(lambda table, df: seen.append((table, df.count())),))
    known = spark.createDataFrame([(f, "ns1_ams") for f in first], "file string, server string")
    second, _ = ingest.run(spark, str(source), str(tmp_path / "two"), settings, known, each=True)
    assert whole == ["a-1.pcap", "a-2.pcap", "broken.pcap"] == first + second and first == ["a-1.pcap"]
    assert rows(tmp_path / "one") == rows(tmp_path / "two") and seen == [("dns", 1), ("icmp", 1)]
    pending, still = ingest.load_state(spark, str(tmp_path / "two" / "_state" / "ns1_ams"))
    assert [r["id"] for r in pending.collect()] == [4] and still.count() > 0


def test_a_broken_state_starts_clean(spark, tmp_path):
    path = tmp_path / "s" / "state" / "pending"
    path.mkdir(parents=True)
    (path / "x.parquet").write_bytes(b"no parquet")
    assert ingest.load_state(spark, str(tmp_path / "s")) == (None, None) and not path.exists()


def test_rows_without_required_columns_are_rejected(spark, result, tmp_path):
    from dataclasses import replace

    broken = replace(result, dns=result.dns.withColumn("time", F.when(F.col("id") != 2, F.col("time"))))
    root = str(tmp_path / "lake")
    spark.sql("CREATE DATABASE IF NOT EXISTS rejects")
    for t in ("dns", "icmp"):
        ddl.create_table(spark, "rejects", t, f"{root}/{t}")
    ingest.store(broken, root, "rejects")
    assert spark.table("rejects.dns").count() == 2 and spark.table("rejects.icmp").count() == 1
    assert [r["id"] for r in spark.read.parquet(f"{root}/_rejects/dns").collect()] == [2]
    spark.sql("DROP DATABASE rejects CASCADE")
