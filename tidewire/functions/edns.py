"""EDNS options (RFC 6891) as columns over ``array<struct<code, data>>``.

Fixed values: option codes of the public registry.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NSID, DAU, DHU, N3U, SUBNET, PADDING, KEYTAG = 3, 5, 6, 7, 8, 12, 14
#: The experimental ping option.
PING = 65001
KNOWN = (NSID, DAU, DHU, N3U, SUBNET, PADDING, KEYTAG, PING)


def _last(options: Column, code: int) -> Column:
    """Data of the last option with ``code``: a later one overwrites."""
    return F.try_element_at(F.filter(options, lambda o: o["code"] == code), F.lit(-1))["data"]


def _byte(data: Column, at: int | Column) -> Column:
    return F.conv(F.hex(F.substring(data, at, 1)), 16, 10).cast("int")


def _numbers(data: Column, width: int) -> Column:
    """The data as unsigned numbers of ``width`` bytes; an empty array if there are none."""
    n = F.floor(F.octet_length(data) / width).cast("int")
    each = lambda i: F.conv(F.hex(F.substring(data, (i * width + 1).cast("int"), F.lit(width))), 16, 10).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), each)).otherwise(F.array().cast("array<int>"))


def _listed(options: Column, code: int) -> Column:
    return F.array_join(_numbers(_last(options, code), 1), ",")


def subnet_address(options: Column) -> Column:
    """The client subnet's address (RFC 7871); IPv6 with all eight groups."""
    data = _last(options, SUBNET)
    four = F.array_join(F.transform(F.sequence(F.lit(5), F.lit(8)), lambda i: F.coalesce(F.conv(F.hex(F.substring(data, i, F.lit(1))), 16, 10), F.lit("0"))), ".")
    digits = F.rpad(F.lower(F.hex(F.substring(data, 5, 16))), 32, "0")
    six = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.regexp_replace(F.substring(digits, i * 4 + 1, F.lit(4)), "^0{1,3}", "")), ":")
    return F.when(_byte(data, 2) == 1, four).when(_byte(data, 2) == 2, six)


def request_columns(opt: Column) -> dict[str, Column]:
    """Columns that a request's OPT record fills; all null without one."""
    options = F.coalesce(opt["options"], F.array().cast("array<struct<code:int,data:binary>>"))
    has = lambda code: F.exists(options, lambda o: o["code"] == code)
    tags = _numbers(_last(options, KEYTAG), 2)
    other = F.filter(options, lambda o: ~o["code"].isin(*[c for c in KNOWN if c != NSID]))
    address = subnet_address(options)
    data = _last(options, SUBNET)
    cols = {
        "edns_udp": opt["udp"],
        "edns_version": opt["version"],
        "edns_do": opt["dnssec_ok"],
        "edns_ping": F.when(has(PING), True),
        "edns_dnssec_dau": F.when(has(DAU), _listed(options, DAU)),
        "edns_dnssec_dhu": F.when(has(DHU), _listed(options, DHU)),
        "edns_dnssec_n3u": F.when(has(N3U), _listed(options, N3U)),
        "edns_client_subnet": F.when(has(SUBNET), F.concat_ws(",", _byte(data, 2), F.concat_ws("/", address, _byte(data, 3)), _byte(data, 4))),
        "edns_padding": F.when(has(PADDING), F.octet_length(_last(options, PADDING))),
        "edns_keytag_count": F.when(has(KEYTAG), F.size(tags)),
        "edns_keytag_list": F.when(has(KEYTAG) & (F.size(tags) > 0), F.array_join(tags, ",")),
        "edns_other": F.when(F.size(other) > 0, F.array_join(F.transform(other, lambda o: o["code"].cast("string")), "")),
        "__subnet": F.when(has(SUBNET), address),
    }
    return {k: F.when(opt.isNotNull(), v) for k, v in cols.items()}


def response_nsid(opt: Column) -> Column:
    """The first NSID option as text; empty if it has no data."""
    first = F.get(F.filter(opt["options"], lambda o: o["code"] == NSID), F.lit(0))
    return F.when(first.isNotNull(), F.coalesce(F.decode(first["data"], "UTF-8"), F.lit("")))
