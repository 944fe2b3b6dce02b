"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import LOWER, UPPER, table
from .exact_dedup import exact_dedup
from .html_extract import main_text
from .images import find_copies
from .language_id import identify
from .licences import oracle as licence_sql
from .licences import scan as scan_licences
from .media import rendered
from .packing import pack
from .secrets import digest, scan
from .simhash import near_dedup
from .source_mix import BLOCK, PHI, mix
from .warc import archive


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op2_media_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_copies(rendered(table(spark, sf_dir, "embeddings")), "vec_id")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents")).drop("key", "root")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan(table(spark, sf_dir, "documents")))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP6_SQL = f"""
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       text_sha256
FROM t
"""


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("key")


OP7_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffle FROM documents),
s1 AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM d GROUP BY source),
s2 AS (SELECT *, CASE sid % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, source_size * 2.0::DOUBLE AS cap FROM s1),
s3 AS (
  SELECT *, ((SELECT sum(source_size) * 1.5::DOUBLE FROM s1)
             - (sum(cap) OVER (ORDER BY cap / w, sid ROWS UNBOUNDED PRECEDING) - cap))
            / sum(w) OVER (ORDER BY cap / w, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s2),
s4 AS (SELECT *, least(cap, w * (SELECT max(level) FROM s3)) AS target FROM s3),
s5 AS (SELECT *, CAST(floor(target) AS BIGINT) AS take, (source_size + {BLOCK - 1}) // {BLOCK} AS n_blocks FROM s4),
s6 AS (
  SELECT *, CASE WHEN source_size > 0 THEN (take // source_size) * n_blocks + (take % source_size + {BLOCK - 1}) // {BLOCK} ELSE 0 END AS n_slots FROM s5),
s7 AS (SELECT *, sum(n_slots) OVER (ORDER BY sid ROWS UNBOUNDED PRECEDING) - n_slots AS first FROM s6),
g AS (SELECT greatest(1, CAST(ceil(log2(greatest(sum(n_slots), 1))) AS INT)) AS bits, sum(n_slots) AS n FROM s7),
p AS (
  SELECT i, CAST((i::HUGEINT * ((CAST(floor((1::BIGINT << bits) / {PHI}::DOUBLE) AS BIGINT) | 1)::HUGEINT)) % (1::BIGINT << bits) AS BIGINT) AS point, n
  FROM g, range(1::BIGINT << (SELECT bits FROM g)) r(i)),
slot AS (
  SELECT s.sid, row_number() OVER (PARTITION BY s.sid ORDER BY i) - 1 AS rank, s.take, s.source_size, s.n_slots, s.n_blocks
  FROM p JOIN s7 s ON p.point >= s.first AND p.point < s.first + s.n_slots WHERE p.point < p.n),
taken_block AS (
  SELECT sid, rank % n_blocks AS block_no,
         CASE WHEN rank = n_slots - 1 AND (take % source_size) % {BLOCK} > 0 THEN (take % source_size) % {BLOCK} ELSE {BLOCK} END AS quota FROM slot),
line AS (
  SELECT d.doc_id, d.size, d.shuffle, s.sid, s.source_size, s.target,
         sum(d.size) OVER (PARTITION BY s.sid ORDER BY d.shuffle, d.size ROWS UNBOUNDED PRECEDING) - d.size AS start,
         row_number() OVER () AS row
  FROM d JOIN s7 s ON d.source IS NOT DISTINCT FROM s.source),
piece AS (
  SELECT row, sid, block_no, greatest(0, start - block_no * {BLOCK}) AS lo, least({BLOCK}, start + size - block_no * {BLOCK}) AS hi
  FROM (SELECT *, unnest(range(CAST(start // {BLOCK} AS BIGINT), CAST((start + size - 1) // {BLOCK} + 1 AS BIGINT))) AS block_no FROM line WHERE size > 0)),
got AS (
  SELECT row, sum(greatest(0, least(hi, quota) - lo)) AS taken FROM piece JOIN taken_block USING (sid, block_no) GROUP BY row)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM line LEFT JOIN got USING (row)
"""


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages"))


OP8_SQL = """
WITH t AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS keep FROM t)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN keep IS NOT NULL AND page_id IS DISTINCT FROM keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keep IS NOT NULL AND page_id IS DISTINCT FROM keep THEN keep END AS refers_to
FROM k
"""


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_media_copies": op2_media_copies,
        "op3_simhash_near_dedup": op3_simhash_near_dedup,
        "op4_secret_scan": op4_secret_scan,
        "op5_html_extraction": op5_html_extraction,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_source_mix": op7_source_mix,
        "op8_warc": op8_warc,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_licence_scan": op10_licence_scan,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_exact_dedup": OP6_SQL, "op7_source_mix": OP7_SQL, "op8_warc": OP8_SQL, "op10_licence_scan": licence_sql()}
