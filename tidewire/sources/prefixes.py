"""Prefix lists of public resolvers and range tables of addresses, from snapshots in files."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.ip import cidr_columns


def from_lines(lines: list[str]) -> list[str]:
    """One prefix a line; without white space; a bare address becomes a prefix of its full length."""
    out = []
    for line in lines:
        bare = "".join(line.split())
        if bare:
            out.append(bare if "/" in bare else f"{bare}/{128 if ':' in bare else 32}")
    return out


def from_records(records: list[str]) -> list[str]:
    """Prefixes of text records whose lines are ``prefix site``; lines with more or fewer parts are left out."""
    rows = [line.split() for record in records for line in record.splitlines()]
    return [r[0] for r in rows if len(r) == 2]


class _Networks(HTMLParser):
    def __init__(self, table: str):
        super().__init__()
        self.table, self.inside, self.rows, self.cell = table, False, [], None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.inside = dict(attrs).get("id") == self.table
        elif self.inside and tag == "tr":
            self.rows.append([])
        elif self.inside and tag in ("td", "th") and self.rows:
            self.cell = []

    def handle_endtag(self, tag):
        if tag == "table":
            self.inside = False
        elif tag in ("td", "th") and self.cell is not None:
            self.rows[-1].append("".join(self.cell).strip())
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def from_page(html: str, table: str = "networks", columns: tuple[int, ...] = (2, 3)) -> list[str]:
    """Prefixes in two columns (IPv4, IPv6) of a page's table, below its header."""
    parser = _Networks(table)
    parser.feed(html)
    return [row[c] for row in parser.rows[1:] for c in columns if len(row) > c and row[c]]


def families(prefixes: list[str]) -> tuple[list[str], list[str]]:
    """(IPv4, IPv6)"""
    return [p for p in prefixes if "." in p], [p for p in prefixes if ":" in p]


def read_list(spark: SparkSession, path: str) -> list[str]:
    return from_lines([r["value"] for r in spark.read.text(path).collect()])


def read_ranges(spark: SparkSession, path: str, values: dict[str, str]) -> DataFrame:
    """A range table from CSV with a ``network`` column; ``values`` maps the file's columns to ours. Lines without a valid prefix are left out."""
    raw = spark.read.option("header", True).csv(path)
    lo, hi, length = cidr_columns(F.col("network"))
    own = raw.select(lo.alias("lo"), hi.alias("hi"), length.alias("prefix_len"), *[F.col(c).alias(n) for c, n in values.items()])
    return own.where("lo IS NOT NULL")


def newer(remote_ms: int | None, local_ms: int | None) -> bool:
    """Whether a snapshot should be fetched again."""
    return local_ms is None or (remote_ms is not None and remote_ms > local_ms)
