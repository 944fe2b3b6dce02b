"""Addresses and prefixes as columns.

Every address gets a key of 32 hex digits whose order is the numeric order of
IPv6 (IPv4 is mapped into ::ffff:0:0/96), so ranges of either family compare
with ``between``.
"""

from __future__ import annotations

import ipaddress
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: where IPv4 lies in IPv6.
MAPPED = "00000000000000000000ffff"


def is_ipv4(address: Column) -> Column:
    return F.contains(address, F.lit("."))


def ipv4_parts(address: Column) -> Column:
    """The four parts of a dotted address; null unless there are exactly four."""
    parts = F.split(address, r"\.", -1)
    return F.when(F.size(parts) == 4, parts)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once; plain reuse would copy its whole expression."""
    return F.transform(F.array(value), body)[0]


def ipv4_to_long(address: Column) -> Column:
    """The address as an unsigned number; null for anything else."""
    return F.aggregate(ipv4_parts(address), F.lit(0).cast("long"), lambda n, part: n * 256 + part.try_cast("long"))


def _hex8(number: Column) -> Column:
    return F.lower(F.lpad(F.hex(number), 8, "0"))


def _groups(text: Column) -> Column:
    """Groups of one side of ``::``, four hex digits each; a dotted tail makes two."""

    def group(x: Column) -> Column:
        return F.when(F.contains(x, F.lit(".")), _hex8(ipv4_to_long(x))).otherwise(F.lpad(F.lower(x), 4, "0"))

    return F.array_join(F.transform(F.filter(F.split(text, ":"), lambda x: x != ""), group), "")


def _six(sides: Column) -> Column:
    """The digits of an IPv6 address, from what stands before and after ``::``."""
    pair = F.struct(_groups(sides[0]).alias("head"), F.when(F.size(sides) > 1, _groups(F.try_element_at(sides, F.lit(2)))).alias("tail"))
    fill = lambda p: F.repeat(F.lit("0"), 32 - F.length(p["head"]) - F.length(p["tail"]))
    return _let(pair, lambda p: F.when(p["tail"].isNull(), p["head"]).otherwise(F.concat(p["head"], fill(p), p["tail"])))


def ip_key(address: Column) -> Column:
    """The address's key; null for null and for what is no address."""

    def digits(a: Column) -> Column:
        return F.when(F.contains(a, F.lit(":")), _let(F.split(a, "::", 2), _six)).when(is_ipv4(a), F.concat(F.lit(MAPPED), _hex8(ipv4_to_long(a))))

    key = _let(F.regexp_replace(address, "%.*$", ""), digits)
    return _let(key, lambda k: F.when(k.rlike("^[0-9a-f]{32}$"), k))


def key_of(address: str) -> str:
    """The same key for one address on the driver."""
    ip = ipaddress.ip_address(address)
    return f"{int(ip):032x}" if ip.version == 6 else f"{MAPPED}{int(ip):08x}"


def cidr_bounds(cidr: str) -> tuple[str, str, int]:
    """First key, last key and prefix length (in 128 bits) of a prefix; a bare address is a prefix of its full length."""
    net = ipaddress.ip_network(cidr.strip(), strict=False)
    return key_of(str(net[0])), key_of(str(net[-1])), net.prefixlen + (96 if net.version == 4 else 0)


def cidr_columns(network: Column) -> tuple[Column, Column, Column]:
    """``cidr_bounds`` for a column: first key, last key, prefix length; all null where the text is no prefix."""
    address = F.substring_index(F.trim(network), "/", 1)
    key = ip_key(address)
    given = F.when(F.contains(network, F.lit("/")), F.substring_index(F.trim(network), "/", -1).try_cast("int"))
    bits = F.when(key.isNotNull(), F.when(is_ipv4(address), F.coalesce(given, F.lit(32)) + 96).otherwise(F.coalesce(given, F.lit(128))))
    bits = F.when(bits.between(0, 128), bits)

    def bound(p: Column, fill: str) -> Column:
        whole, part = F.floor(p["n"] / 4).cast("int"), p["n"] % 4
        digit = F.conv(F.substr(p["k"], whole + 1, F.lit(1)), 16, 10).cast("int")
        step = F.pow(F.lit(2), 4 - part).cast("int")
        least = digit - digit % step
        own = F.when(part > 0, F.lower(F.hex((least if fill == "0" else least + step - 1).cast("long")))).otherwise("")
        return F.rpad(F.concat(F.substr(p["k"], F.lit(1), whole), own), 32, fill)

    pair = F.struct(key.alias("k"), bits.alias("n"))
    return _let(pair, lambda p: bound(p, "0")), _let(pair, lambda p: bound(p, "f")), bits


def in_cidr(address: Column, cidr: str) -> Column:
    lo, hi, _ = cidr_bounds(cidr)
    return ip_key(address).between(lo, hi)
