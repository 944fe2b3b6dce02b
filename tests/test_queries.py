"""Every registered query of the catalogue against DuckDB."""

import io
import math
import os

import conftest
import duckdb
import pyarrow as pa
import pytest

from tidewire.plans import catalogue, pseudo, stored
from tidewire.sources import pcap

SF = f"{conftest.DATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else str(v)


QUERIES, SQL = catalogue.queries() | stored.queries(), catalogue.oracle_sql() | stored.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    order = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
    found = duck.sql(SQL[name])
    assert sorted(found.columns) == order
    at = [found.columns.index(c) for c in order]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())


def test_stored_table_is_pruned(spark):
    plan = QUERIES["partition_prune"](spark, SF)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(server#" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


@pytest.fixture(scope="module")
def many_users(tmp_path_factory):
    """The events under repeated and shifted keys, so that ports leave 16 bits and some share their low ones."""
    sf = tmp_path_factory.mktemp("many")
    shifts = "(VALUES (0, 0), (1, 60000), (2, 65536), (3, 131072), (4, 2147480000)) s(i, shift)"
    duckdb.sql(f"COPY (SELECT event_id + 1000000 * i AS event_id, ts, user_id + shift AS user_id, event_type, value, props FROM '{SF}/events.parquet', {shifts}) TO '{sf}/events.parquet'")
    return str(sf)


@pytest.mark.parametrize("name", ["capture_throughput", "capture_rejects", "capture_messages", "capture_icmp"])
def test_captures_of_ports_beyond_16_bits(spark, many_users, name):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{many_users}/events.parquet'")
    found = con.sql(SQL[name])
    got = QUERIES[name](spark, many_users).select(*found.columns).collect()
    assert len(got) > 0 and sorted(tuple(map(plain, r)) for r in got) == sorted(tuple(map(plain, r)) for r in found.fetchall())


@pytest.mark.parametrize("name", ["capture_rejects", "capture_throughput"])
def test_captures_of_users_beyond_32_bits(spark, tmp_path, name):
    """What returns no port takes any user, as its SQL does."""
    duckdb.sql(f"COPY (SELECT event_id + 1000000 * i AS event_id, ts, user_id + 1000000000 * i AS user_id, event_type, value, props FROM '{SF}/events.parquet', range(0, 60, 20) r(i)) TO '{tmp_path}/events.parquet'")
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    found = con.sql(SQL[name])
    got = QUERIES[name](spark, str(tmp_path)).select(*found.columns).collect()
    assert len(got) == 30 and sorted(tuple(map(plain, r)) for r in got) == sorted(tuple(map(plain, r)) for r in found.fetchall())


def test_captures_are_not_held(spark):
    """A file's packets come while it is still written; a damaged one is written whole, too."""
    taken = 0

    def batches(day):
        nonlocal taken
        row = {"pcap_file": f"cap-2024-01-{day}", "qr": 0, "id": 1, "client": "10.0.0.1", "port": 5_000_000_000, "qname": "a.nl.", "qtype": 1, "rcode": 0, "prot": 17, "k": 1}
        for at in range(50):
            taken += 1
            yield pa.RecordBatch.from_pylist([row | {"time": 1000 * at + i} for i in range(1000)])

    for damaged, day, own, first in ((False, "04", 50_000, 2), (False, "05", 50_000, 40), (True, "20", 0, 50), (True, "25", 0, 50)):
        taken = 0
        files = pseudo.captures(spark, SF, damaged)[1](batches(day))
        name, raw = next(files)
        rows = pcap.rows_of(name, raw, None, None)
        one = next(rows)
        assert taken <= first and (one["error"] is None) == (not damaged)
        assert sum(1 for _ in rows) == max(own - 1, 0) and taken == 50 and next(files, None) is None


def test_pieces_are_one_stream():
    assert io.BufferedReader(pcap.Pieces(iter([b"", b"ab", b"", b"cde", b""]))).read() == b"abcde"
    assert io.BufferedReader(pcap.Pieces(iter([b"ab", b"cde"])), 4).read(3) == b"abc"
