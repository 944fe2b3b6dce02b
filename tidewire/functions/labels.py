"""Servers, metric names, paths and other labels."""

from __future__ import annotations

import re
from string import Template

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The server name where none is given, in names and in paths.
DEFAULT_SERVER, DEFAULT_PARTITION = "default", "__default__"


def server_parts(name: Column) -> dict[str, Column]:
    """name, normalized_name, server and location of ``<server>_<location>``; blank names become the default."""
    own = F.when(F.trim(F.coalesce(name, F.lit(""))) == "", DEFAULT_SERVER).otherwise(name)
    at = F.locate("_", own)
    return {
        "name": own,
        "normalized_name": F.regexp_replace(own, "[^A-Za-z0-9 ]", "_"),
        "server": F.when(at > 0, F.substring_index(own, "_", 1)).otherwise(own),
        "location": F.when(at > 0, F.substr(own, at + 1)),
    }


def server_partition(name: Column) -> Column:
    """The server's value in partition paths: without white space, never blank."""
    bare = F.regexp_replace(F.coalesce(name, F.lit("")), r"\s", "")
    return F.when(bare == "", DEFAULT_PARTITION).otherwise(bare)


def metric_name(prefix: str, metric: Column, server: Column) -> Column:
    """``prefix.metric.ns.server`` with the normalised server; blank servers become ``all``."""
    own = F.when(F.trim(F.coalesce(server, F.lit(""))) == "", "all").otherwise(F.regexp_replace(server, "[^A-Za-z0-9 ]", "_"))
    return F.concat_ws(".", F.lit(prefix), metric, F.lit("ns"), own)


def flow_key(src: Column, dst: Column) -> Column:
    """Equal for both directions of a flow; null if either end is unknown."""
    return F.when(src.isNotNull() & dst.isNotNull(), F.xxhash64(F.least(src, dst), F.greatest(src, dst)))


def percent(part: Column, total: Column) -> Column:
    """The share in per cent with two decimals; ``0`` where the total is 0."""
    return F.when(total == 0, "0").otherwise(F.format_string("%.2f", part.cast("double") * 100 / F.nullif(total, F.lit(0))))


def partition_path(table: str, year: Column, month: Column, day: Column, server: Column | None = None) -> Column:
    parts = [F.concat(F.lit("year="), year.cast("string")), F.concat(F.lit("month="), month.cast("string")), F.concat(F.lit("day="), day.cast("string"))]
    return F.concat_ws("/", *parts, *([F.concat(F.lit("server="), server_partition(server))] if table == "dns" else []))


def append_path(parent: str, *parts: str | None) -> str:
    """Join path parts with single slashes, leaving blank ones out."""
    return "/".join([parent.rstrip("/"), *[p.strip("/") for p in parts if p and p.strip()]])


def fill(template: str, values: dict[str, str]) -> str:
    """Replace ``${NAME}``; names that have no value stay."""
    return Template(template).safe_substitute(values)


def compacted_name(day: str, server: str, unique: str) -> str:
    return f"{day}-{re.sub(r'[^A-Za-z0-9]', '_', server)}-{unique}.parq"
