from ipaddress import ip_address

import pytest
from pyspark.sql import functions as F

from tidewire.functions import edns, labels
from tidewire.functions.ip import cidr_bounds, in_cidr, ip_key, ipv4_parts, ipv4_to_long, key_of
from tidewire.functions.names import label_count, registered_domain
from tidewire.functions.times import bucket, partition_columns
from tidewire.schema import DNS_SCHEMA, ICMP_SCHEMA, table_schema
from tidewire.sources import prefixes


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").coalesce(1)


def values(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr.alias("x")).collect()]


def test_ipv4(spark):
    df = column(spark, ["173.194.169.16", "1.2.3", "a.b.c.d", None])
    assert values(df, ipv4_to_long(F.col("v"))) == [2915215632, None, None, None]
    assert values(column(spark, ["123.125.111.172", "1.2"]), ipv4_parts(F.col("v"))) == [["123", "125", "111", "172"], None]


def test_keys_follow_numeric_order(spark):
    good = ["0.0.0.0", "10.1.2.3", "255.255.255.255", "::", "::1", "2001:db8::", "2001:DB8:0:0:1::1", "1:2:3:4:5:6:7:8", "::ffff:10.1.2.3", "fe80::1%eth0", "2001:db8::192.0.2.33"]
    assert values(column(spark, good), ip_key(F.col("v"))) == [key_of(g.split("%")[0]) for g in good]
    assert values(column(spark, ["", "x", "1:2", None, "1.2.3", "g::"]), ip_key(F.col("v"))) == [None] * 6


@pytest.mark.parametrize("cidr", ["10.0.0.0/8", "192.0.2.4/31", "192.0.2.1", "2001:db8::/33"])
def test_cidr(spark, cidr):
    lo, hi, n = cidr_bounds(cidr)
    assert lo <= hi and 0 <= n <= 128
    some = ["10.255.0.1", "192.0.2.5", "192.0.2.1", "2001:db8:7fff::1", "2001:db8:8000::1"]
    from ipaddress import ip_network

    net = ip_network(cidr, strict=False)
    assert values(column(spark, some), in_cidr(F.col("v"), cidr)) == [ip_address(a) in net for a in some]


def test_names(spark):
    df = column(spark, ["www.example.co.uk.", "example.nl", "nl.", ".", None, "a.b.c.example.nl"])
    assert values(df, label_count(F.col("v"))) == [4, 2, 1, 0, 0, 5]
    suffixes = spark.createDataFrame([("co.uk",), ("b.example.nl",)], "suffix string")
    got = registered_domain(df, "v", "d", suffixes)
    assert values(got, F.col("d")) == ["example.co.uk", "example.nl", "nl", None, None, "example.nl"]
    assert values(registered_domain(df, "v", "d"), F.col("d"))[0] == "co.uk"


def test_times(spark):
    df = column(spark, [0, 59_999, 60_000, 1_704_067_199_999], "long")
    assert values(df, bucket(F.col("v"))) == [0, 0, 60, 1_704_067_140]
    year = partition_columns(F.col("v"))
    assert values(df, F.struct(*year.values()))[3] == (2023, 12, 31)


def test_servers_and_paths(spark):
    df = column(spark, ["ns1.nl_ams_2", "  ", None, "ns 1"])
    parts = labels.server_parts(F.col("v"))
    assert values(df, parts["server"]) == ["ns1.nl", "default", "default", "ns 1"]
    assert values(df, parts["location"]) == ["ams_2", None, None, None]
    assert values(df, parts["normalized_name"])[0] == "ns1_nl_ams_2"
    assert values(df, labels.server_partition(F.col("v"))) == ["ns1.nl_ams_2", "__default__", "__default__", "ns1"]
    assert values(df, labels.metric_name("p", F.lit("m"), F.col("v")))[1:3] == ["p.m.ns.all"] * 2
    assert labels.append_path("/a/", "b/", "", None, "/c") == "/a/b/c"
    assert labels.fill("x ${A} ${B}", {"A": "1"}) == "x 1 ${B}"


def test_percent_and_flow(spark):
    df = spark.createDataFrame([(0, 1, 3, "a", "b"), (1, 1, 0, "b", "a"), (2, 0, 5, None, "a")], "i int, p int, t int, s string, d string")
    assert values(df, labels.percent(F.col("p"), F.col("t"))) == ["33.33", "0", "0.00"]
    keys = values(df, labels.flow_key(F.col("s"), F.col("d")))
    assert keys[0] == keys[1] and keys[2] is None


def test_edns(spark):
    options = [(5, b"\x08\x0a"), (8, bytes([0, 2, 33, 0, 0x20, 1, 0x0D, 0xB8, 0x80])), (14, b"\x00\x01\x4a\x5c"), (14, b""), (99, b""), (10, b"x"), (65001, b"")]
    df = spark.createDataFrame([(0, (512, 0, True, options)), (1, None)], "i int, opt struct<udp:int,version:int,dnssec_ok:boolean,options:array<struct<code:int,data:binary>>>")
    cols = edns.request_columns(F.col("opt"))
    row, none = df.orderBy("i").select(*[v.alias(k) for k, v in cols.items()]).collect()
    assert row["edns_dnssec_dau"] == "8,10" and row["edns_ping"] and row["edns_dnssec_dhu"] is None
    assert row["edns_client_subnet"] == "2,2001:db8:8000:0:0:0:0:0/33,0"
    assert (row["edns_keytag_count"], row["edns_keytag_list"], row["edns_other"]) == (0, None, "9910")
    assert all(v is None for v in none)


def test_schemas():
    assert (len(DNS_SCHEMA), len(ICMP_SCHEMA)) == (60, 54)
    assert [f.name for f in table_schema("dns").fields][-5:] == ["query_ts", "year", "month", "day", "server"]
    assert DNS_SCHEMA["id"].nullable is False and table_schema("dns")["id"].nullable


def test_prefix_lists():
    assert prefixes.from_lines([" 1.2.3.4 ", "", "10.0.0.0 / 8", "2001:db8::1"]) == ["1.2.3.4/32", "10.0.0.0/8", "2001:db8::1/128"]
    assert prefixes.from_records(["1.0.0.0/24 ams\n2.0.0.0/24 iad x\n3.0.0.0/24 fra"]) == ["1.0.0.0/24", "3.0.0.0/24"]
    page = "<table id=networks><tr><th>a<th>b</tr><tr><td>x</td><td>y</td><td>1.0.0.0/24</td><td>2001:db8::/32</td></tr></table>"
    assert prefixes.from_page(page) == ["1.0.0.0/24", "2001:db8::/32"]
    assert prefixes.families(["1.0.0.0/8", "::/0"]) == (["1.0.0.0/8"], ["::/0"])
    assert prefixes.newer(5, None) and prefixes.newer(5, 4) and not prefixes.newer(None, 4)
