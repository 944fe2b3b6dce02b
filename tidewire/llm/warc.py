"""WARC archives: writing with revisit records, reading by boundary chains.

Writing: one record per page. Payloads of ``LEAST`` bytes or more that are equal
(by SHA-1) are written once, as the response of the largest page id; the others
become revisit records that refer to it. Each task writes one archive.

Reading splits archives at the record magic, in byte ranges, so no task holds a
whole archive. The magic may also stand inside payloads, so each occurrence is
only a candidate. From a candidate's header follows the offset of its successor
(header, content, two line ends). Tasks contract these pointers within their
byte range; the remaining pointers between ranges are resolved by pointer
jumping from each archive's start, in rounds that grow with the logarithm of
the number of ranges; then each task marks what is reachable in its range. Only
reachable candidates are records. A record whose payload holds the magic spans
several pieces, which are put together again.

Defined cases: null html is the empty payload; a null url has no target line;
null page ids lose against any id and stay null; rows that repeat the largest
page id are all responses; an empty table gives an empty result; other columns
of the input are ignored; an archive that breaks off yields the records that
are reachable before the break.
"""

from __future__ import annotations

import hashlib
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import prefix_sum, shared_dir, staged

#: The format's first line, line end and record end.
MAGIC = "WARC/1.1\r\n"
LINE, END = "\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payload bytes from which equal payloads become revisits.
LEAST = 1000
#: The date that records carry; fixed, so that reruns write equal archives.
DATE = "2024-01-01T00:00:00Z"


def decide(pages: DataFrame, id_col: str, html_col: str, least: int) -> DataFrame:
    """Columns digest, keep, of the payloads that more than one page has."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    narrow = pages.select(F.col(id_col).alias("id"), F.octet_length(payload).alias("bytes"), F.sha1(payload.cast("binary")).alias("digest"))
    some = narrow.where(F.col("bytes") >= least).groupBy("digest").agg(F.max("id").alias("keep"), F.count("*").alias("n"))
    return staged(some.where("n > 1").select("digest", "keep"), "repeated")


def _head(pairs: list[tuple[str, Column]]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat(*[F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v, F.lit(LINE))).otherwise("") for k, v in pairs])


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> None:
    """Write archives to the folder ``path``."""
    repeated = decide(pages, id_col, html_col, least).withColumnRenamed("digest", "__digest")
    rows = pages.select(
        F.col(id_col).cast("string").alias("id"),
        F.regexp_replace(F.col(url_col), r"[\x00-\x20\x7f]", "%20").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("bytes", F.octet_length("html"))
    rows = rows.join(repeated, F.col("digest") == F.col("__digest"), "left")
    keep = F.col("keep").cast("string")
    revisit = keep.isNotNull() & ~F.col("id").eqNullSafe(keep) & (F.col("bytes") >= least)
    urn = lambda c: F.concat(F.lit("<urn:page:"), c, F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "), F.col("bytes").cast("string"), F.lit(END))
    content = F.concat(http, F.when(F.col("revisit"), "").otherwise(F.col("html")))
    record = F.concat(
        F.lit(MAGIC),
        _head([
            ("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
            ("WARC-Record-ID", urn(F.coalesce("id", F.lit("none")))),
            ("WARC-Target-URI", F.col("url")),
            ("WARC-Date", F.lit(DATE)),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("WARC-Refers-To", F.when(F.col("revisit"), urn(keep))),
            ("WARC-Profile", F.when(F.col("revisit"), PROFILE)),
            ("Content-Type", F.lit("application/http; msgtype=response")),
            ("Content-Length", F.octet_length("content").cast("string")),
        ]),
        F.lit(LINE),
        F.col("content"),
    )
    made = rows.withColumn("revisit", F.coalesce(revisit, F.lit(False))).withColumn("content", content)
    made.select(record.alias("value")).write.option("lineSep", END).text(path)


def _field(name: str, value: str) -> Column:
    found = F.regexp_extract("head", rf"(?i)(?:^|\r\n){name}:[ \t]*{value}", 1)
    return F.when(found != "", found)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between occurrences of the magic: file, block (start of the byte range), mid (order), value."""
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("mid"), "value")


def _parse(pieces: DataFrame) -> DataFrame:
    """``pieces`` without their bytes, with what their headers say and, if all content is there, its payload's length and SHA-1."""
    size = F.octet_length("value")
    out = pieces.withColumn("head", F.substring_index("value", END, 1)).withColumn("size", size.cast("long"))
    out = out.withColumn("header", F.octet_length("head") + len(END))
    out = out.withColumn("length", F.when(F.octet_length("head") < size, _field("Content-Length", r"(\d{1,18})")).cast("long"))
    out = out.withColumn("type", _field("WARC-Type", r"(\w+)")).withColumn("complete", F.coalesce(F.col("size") >= F.col("header") + F.col("length"), F.lit(False)))
    body = F.expr("substring(cast(value AS binary), header + 1, cast(length AS int))")
    skip = F.octet_length(F.substring_index(body.cast("string"), END, 1)) + len(END)
    payload = F.when(F.col("complete") & (F.col("type") == "response"), F.substring(body, skip + 1, F.col("length").cast("int")))
    out = out.withColumn("payload", payload)
    told = F.regexp_extract(body.cast("string"), r"(?i)\r\nContent-Length:[ \t]*(\d+)", 1)
    return out.select(
        "file", "block", "mid", "size", "header", "length", "type", "complete",
        _field("WARC-Record-ID", r"<urn:page:([^>]*)>").alias("id"),
        _field("WARC-Refers-To", r"<urn:page:([^>]*)>").alias("refers_to"),
        F.coalesce(F.octet_length("payload"), F.when(F.col("complete") & (F.col("type") == "revisit") & (told != ""), told)).cast("long").alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), F.when(F.col("type") == "revisit", _field("WARC-Payload-Digest", "sha1:([0-9a-f]+)"))).alias("payload_digest"),
    )


def _contract(part: pd.DataFrame) -> pd.DataFrame:
    """For each candidate of a byte range, the first offset of its chain that is none of the range's candidates."""
    part = part.sort_values("off", ascending=False)
    out: dict[int, int] = {}
    for off, after in zip(part["off"].tolist(), part["next"].tolist(), strict=True):
        out[off] = out.get(after, after)
    return pd.DataFrame({"file": part["file"], "off": part["off"], "out": list(out.values())})


def _mark(key, nodes: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """Each piece of a byte range with the last reachable record at or before it in the range (``rec``, -1: none)."""
    nodes = nodes.sort_values("off")
    after = {o: n for o, n in zip(nodes["off"].tolist(), nodes["next"].tolist(), strict=True) if n >= 0}
    reached = set()
    for at in entries["off"].tolist():
        while at in after and at not in reached:
            reached.add(at)
            at = after[at]
    own = nodes["off"].where(nodes["off"].isin(reached)).ffill().fillna(-1).astype("int64")
    return pd.DataFrame({"file": nodes["file"], "block": nodes["block"], "mid": nodes["mid"], "off": nodes["off"], "rec": own})


def chain(parsed: DataFrame) -> DataFrame:
    """Every piece with the offset of the record that it belongs to: file, block, mid, off, rec."""
    step = F.col("size") + len(MAGIC)
    placed = prefix_sum(parsed.select("file", "block", "mid", "size", "header", "length", "type"), ["file"], "block", ["mid"], step, "start")
    valid = F.col("length").isNotNull() & F.col("type").isNotNull()
    after = F.col("start") + F.col("header") + F.col("length") + len(END)
    nodes = staged(
        placed.where("start > 0").select("file", "block", "mid", (F.col("start") - len(MAGIC)).alias("off"), F.when(valid, after).otherwise(-1).alias("next")),
        "candidates",
    )
    exits = staged(nodes.where("next >= 0").select("file", "block", "off", "next").groupBy("file", "block").applyInPandas(_contract, "file string, off long, out long"), "exits")
    reached = staged(exits.where("off = 0").select("file", "off"), "reached")
    entrances = exits.select("file", F.col("out").alias("off")).unionByName(reached).distinct()  # few in each range
    jumps = staged(exits.join(entrances, ["file", "off"], "left_semi"), "jumps")
    seen = reached.count()
    while seen:  # reached: all within 2**k - 1 jumps; jumps: 2**k at once
        onward = reached.join(jumps, ["file", "off"]).select("file", F.col("out").alias("off"))
        reached = staged(reached.unionByName(onward).distinct(), "reached")
        before, seen = seen, reached.count()
        if seen == before:
            break
        second = jumps.select("file", F.col("off").alias("out"), F.col("out").alias("far"))
        jumps = staged(jumps.join(second, ["file", "out"], "left").select("file", "off", F.coalesce("far", "out").alias("out")), "jumps")
    entries = staged(reached.join(nodes.select("file", "off", "block"), ["file", "off"]).select("file", "block", "off"), "entries")
    marked = nodes.groupBy("file", "block").cogroup(entries.groupBy("file", "block")).applyInPandas(_mark, "file string, block long, mid long, off long, rec long")
    marked = staged(marked, "marked")
    last = marked.groupBy("file", "block").agg(F.max("rec").alias("last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("file", "block", F.max("last").over(before).alias("carried"))
    return marked.join(carried, ["file", "block"]).select("file", "block", "mid", "off", F.when(F.col("rec") >= 0, F.col("rec")).otherwise(F.coalesce("carried", F.lit(-1))).alias("rec"))


def _join_up(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("off")
    whole = MAGIC.encode().join(bytes(v) for v in part["value"])
    first = part.iloc[0]
    content = whole[first["header"] : first["header"] + first["length"]]
    payload = content.partition(END.encode())[2] if first["type"] == "response" else b""
    return pd.DataFrame({"file": [first["file"]], "rec": [first["rec"]], "payload": [payload], "bytes": [len(payload)], "digest": [hashlib.sha1(payload).hexdigest()]})


def payloads(pieces: DataFrame, parsed: DataFrame, chained: DataFrame, wanted: DataFrame) -> DataFrame:
    """The payload of each record in ``wanted`` (file, rec), from all its pieces: file, rec, payload, bytes, digest."""
    info = parsed.select("mid", "header", "length", "type")
    need = chained.join(wanted, ["file", "rec"], "left_semi").select("mid", "file", "off", "rec").join(info, "mid")
    first = F.col("off") == F.col("rec")
    rows = need.join(pieces.select("mid", F.col("value").cast("binary").alias("value")), "mid")
    rows = rows.select("file", "rec", "off", "value", F.when(first, F.col("header")).otherwise(0).alias("header"), F.when(first, F.col("length")).otherwise(0).alias("length"), F.coalesce("type", F.lit("")).alias("type"))
    return rows.groupBy("file", "rec").applyInPandas(_join_up, "file string, rec long, payload binary, bytes long, digest string")


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record: file, off, type, id, refers_to, payload_bytes, payload_digest (and payload, if asked for)."""
    pieces = _pieces(spark, path)
    parsed = staged(_parse(pieces), "pieces")
    chained = staged(chain(parsed), "chained")
    heads = chained.where("off = rec").join(parsed.drop("file", "block"), "mid")
    records = heads.select("file", "off", "type", "id", "refers_to", "payload_bytes", "payload_digest", "complete")
    wanted = heads.select("file", F.col("off").alias("rec"), "complete").where(F.lit(with_payload) | ~F.col("complete")).select("file", "rec")
    if not with_payload and wanted.isEmpty():
        return records.drop("complete")
    more = payloads(pieces, parsed, chained, wanted).withColumnRenamed("rec", "off")
    joined = records.join(more, ["file", "off"], "left")
    part = ~F.col("complete") & (F.col("type") == "response")
    joined = joined.withColumn("payload_bytes", F.when(part, F.col("bytes")).otherwise(F.col("payload_bytes"))).withColumn("payload_digest", F.when(part, F.col("digest")).otherwise(F.col("payload_digest")))
    return joined.drop("complete", "bytes", "digest", *([] if with_payload else ["payload"]))


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back: one row per page."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, path, id_col, url_col, html_col)
    kind = dict(pages.dtypes)[id_col]
    number = lambda c: F.when(F.col(c) != "none", F.col(c)).cast(kind)
    return read(spark, path).select(number("id").alias(id_col), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), number("refers_to").alias("refers_to"))
