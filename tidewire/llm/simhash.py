"""SimHash near-dedup through vantage-point trees.

A text's 64-bit fingerprint has a bit set when more than half of its shingles'
XXH64 values have it. Fingerprints link at ``radius`` or fewer differing bits,
and a document's component is the least id reachable over links.

Only distinct fingerprints are searched, so copies never meet each other. A
vantage-point tree, built from a bounded sample, splits space by Hamming
distance: a node holds a vantage point and a radius, near fingerprints go to
one side and far ones to the other. Each fingerprint lives in one shard and
visits each shard that the triangle inequality leaves open (its distance is
within ``radius`` of the boundary), so each linked pair meets in the home shard
of either end: the pairs are exact, whatever the sample. Shards that stay large get
trees of their own, from samples of theirs. Inside a shard the same split goes on, then pairs are compared with XOR and a bit count. A shard
emits one edge per fingerprint (to the least of its local component), never its
pairs; the edges' components are then found across shards.

Defined cases: null and blank texts have fingerprint zero and link like any
other; fewer words than a shingle are one shingle; very long texts are hashed in
slices; a bit that exactly half the shingles have is unset; rows without an id
take no part in the choice of a component's id (it is null if no row of it has
one); repeated rows are rows of their own (``keep_one`` keeps one of them, and of
several texts under the least id the one with the least hash); an empty table gives an empty result;
other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import drop_rows, small_batches, small_table, staged
from .components import connected

WORDS = 3
SEED = 42
RADIUS = 2
#: Distinct fingerprints from which the tree is built, about; their number bounds what reaches the driver.
SAMPLE = 65_536
#: Rows of a shard beyond which it is split again, and fingerprints from which its tree is then built, about.
MOST, SPLIT = 1_000_000, 128
#: Distinct fingerprints that live in a shard, about.
SHARD = 4_096
#: Sampled fingerprints below which a node is not split.
LEAST = 16
#: Comparisons made at once.
BLOCK = 1 << 20


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The fingerprint as an unsigned number."""
    tokens = (text or "").encode().lower().split()  # bytes: A-Z and the six ASCII white spaces only
    if not tokens:
        return 0
    line = b" ".join(tokens)
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))
    stop = np.cumsum(size + 1) - 1
    start = stop - size
    if len(tokens) < words:
        spans = [(0, len(line))]
    else:
        spans = list(zip(start[: len(tokens) - words + 1].tolist(), stop[words - 1 :].tolist(), strict=True))
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for i in range(0, len(spans), 1 << 16):
        part = np.array([digest(line[a:b], seed) for a, b in spans[i : i + (1 << 16)]], dtype="<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(spans), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """Columns id, key (of the text), fp (the fingerprint as a signed long)."""

    @F.pandas_udf(LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words, seed) for t in texts], dtype=np.uint64).view(np.int64))

    return small_batches(docs).select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), of(F.coalesce(F.col(text_col), F.lit(""))).alias("fp"))


def distance(a, b):
    return np.bitwise_count(a ^ b)


def grow(sample: np.ndarray, depth: int, least: int = LEAST) -> list[tuple[np.uint64, int, int, int]]:
    """The tree: nodes (vantage, radius, near, far); a child below zero is shard ``-1 - child``.

    Of a few candidates the one whose distances spread most becomes the vantage
    point, its median distance the radius.
    """
    nodes: list = []
    shards = 0

    def build(points: np.ndarray, left: int) -> int:
        nonlocal shards
        best = None
        if left and len(points) >= least:
            for v in points[:: max(1, len(points) // 8)][:8]:
                d = distance(points, v)
                mid = int(np.median(d))
                near = int((d <= mid).sum())
                if 0 < near < len(points) and (best is None or d.std() > best[0]):
                    best = (d.std(), v, mid, d)
        if best is None:
            shards += 1
            return -shards
        at = len(nodes)
        nodes.append(None)
        _, v, mid, d = best
        nodes[at] = (v, mid, build(points[d <= mid], left - 1), build(points[d > mid], left - 1))
        return at

    build(sample, depth)
    return nodes


def route(nodes: list, points: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, index, home) of every shard that each point lives in or must visit."""
    out = []

    def go(at: int, index: np.ndarray, home: np.ndarray) -> None:
        if not len(index):
            return
        if at < 0:
            out.append((np.full(len(index), -1 - at, np.int32), index, home))
            return
        v, mid, near, far = nodes[at]
        d = distance(points[index], v).astype(np.int64)
        for child, own, open_ in ((near, d <= mid, d <= mid + radius), (far, d > mid, d + radius > mid)):
            go(child, index[open_], (home & own)[open_])

    go(0 if nodes else -1, np.arange(len(points)), np.ones(len(points), bool))
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (empty, empty, empty.astype(bool))


class _Union:
    """Components of local indexes; each root is the least index of its component."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.root[a], self.root[b]
        differ = a != b
        while differ.any():
            pairs = np.unique(np.stack([np.minimum(a, b)[differ], np.maximum(a, b)[differ]], axis=1), axis=0)
            np.minimum.at(self.root, pairs[:, 1], pairs[:, 0])
            while not (self.root == (up := self.root[self.root])).all():
                self.root = up
            a, b = self.root[pairs[:, 0]], self.root[pairs[:, 1]]
            differ = a != b


def link(points: np.ndarray, home: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each point the index of the least point of its component, over links that have an end in ``home``."""
    found = _Union(len(points))

    def pairs(h: np.ndarray, v: np.ndarray, left: int) -> None:
        if not len(h) or not len(v):
            return
        if left and len(h) * len(v) > 4 * BLOCK:
            vantage = points[h[len(h) // 2]]
            dh, dv = distance(points[h], vantage).astype(np.int64), distance(points[v], vantage).astype(np.int64)
            mid = int(np.median(dh))
            if (dh > mid).any():
                pairs(h[dh <= mid], v[dv <= mid + radius], left - 1)
                pairs(h[dh > mid], v[dv + radius > mid], left - 1)
                return
        step = max(1, BLOCK // len(v))
        for i in range(0, len(h), step):
            a, b = np.nonzero(distance(points[h[i : i + step]][:, None], points[v][None, :]) <= radius)
            found.add(h[i : i + step][a], v[b])

    pairs(np.flatnonzero(home), np.arange(len(points)), 12)
    return found.root


def _sampled(dealt: DataFrame, sizes: dict[int, int], each: int) -> dict[int, np.ndarray]:
    """About ``each`` home fingerprints of every shard in ``sizes``, chosen by hash."""
    known = small_table(dealt.sparkSession, [(s, min(1.0, each / n)) for s, n in sizes.items()], "shard long, rate double")
    part = F.pmod(F.xxhash64("fp"), F.lit(1 << 32)) / float(1 << 32)
    some = dealt.where("home").join(F.broadcast(known), "shard").where(part < F.col("rate")).select("shard", "fp").toArrow()
    at, points = some.column(0).to_numpy(), some.column(1).to_numpy().view(np.uint64)
    order = np.lexsort((points, at))
    at, points = at[order], points[order]
    return {s: points[np.searchsorted(at, s) : np.searchsorted(at, s, "right")] for s in sizes}


def _deal(dealt: DataFrame, trees: dict[int, list], radius: int) -> DataFrame:
    """Rows (shard, fp, home) after the shards that have a tree are split by it."""

    def run(batches):
        for batch in batches:
            at, points, own = batch["shard"].to_numpy(np.int64), batch["fp"].to_numpy(np.int64), batch["home"].to_numpy(bool)
            for s in np.unique(at):
                here = np.flatnonzero(at == s)
                if s in trees:
                    child, index, home = route(trees[s], points[here].view(np.uint64), radius)
                    # a child's number is mixed from its parent's; should two be equal, one task does the work of both
                    mixed = (child.astype(np.int64) + 1) * 0x9E3779B97F4A7C1 ^ np.int64(int(s) * 31 & 0x7FFFFFFFFFFFFFFF)
                    yield pd.DataFrame({"shard": mixed, "fp": points[here][index], "home": home & own[here][index]})
                else:
                    yield pd.DataFrame({"shard": at[here], "fp": points[here], "home": own[here]})

    return dealt.mapInPandas(run, "shard long, fp long, home boolean")


def shards(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD, sample: int = SAMPLE, most: int = MOST) -> DataFrame:
    """Rows (shard, fp, home): every fingerprint in its home shard and in each that it must visit.

    Shards of more than ``most`` rows are split again by trees of their own,
    until none is that large or vantage points do not tell its points apart.
    """
    n = distinct.count()
    depth = max(0, (max(n, 1) - 1) // shard).bit_length()
    dealt = distinct.select(F.lit(0).cast("long").alias("shard"), "fp", F.lit(True).alias("home"))
    if depth:
        dealt = _deal(dealt, {0: grow(_sampled(dealt, {0: n}, sample)[0], depth)}, radius)
    whole: set[int] = set()
    while n > most:  # else no shard can be larger
        dealt = staged(dealt, "dealt")
        sizes = dealt.groupBy("shard").agg(F.count("*").alias("n"), F.count_if("home").alias("own")).where(F.col("n") > most)
        large = {r["shard"]: r["own"] for r in sizes.collect() if r["own"] and r["shard"] not in whole}
        trees = {s: grow(points, SPLIT.bit_length(), LEAST) for s, points in _sampled(dealt, large, SPLIT).items()} if large else {}
        whole |= {s for s, nodes in trees.items() if not nodes}
        trees = {s: nodes for s, nodes in trees.items() if nodes}
        if not trees:
            break
        dealt = _deal(dealt, trees, radius)
    return dealt


def components(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD, sample: int = SAMPLE, most: int = MOST) -> DataFrame:
    """Columns node, root of every fingerprint (column ``fp``, each once) that is not its component's least."""

    def local(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("fp")
        points = part["fp"].to_numpy(np.int64)
        root = link(points.view(np.uint64), part["home"].to_numpy(bool), radius)
        moved = root != np.arange(len(root))
        return pd.DataFrame({"a": points[moved], "b": points[root[moved]]})

    return connected(shards(distinct, radius, shard, sample, most).groupBy("shard").applyInPandas(local, "a long, b long"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (hex), component_id, key, root (the component's least fingerprint)."""
    rows = staged(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = staged(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    labels = staged(components(distinct, radius), "labels")
    rooted = distinct.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    by_fp = rooted.select("fp", "root").join(least, "root")
    return rows.join(by_fp, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
        "key",
        "root",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the least id. Columns unchanged."""
    found = near_dedup(docs, id_col, text_col).withColumnRenamed(id_col, "id")
    first = F.col("id").eqNullSafe(F.col("component_id"))
    # rows that have the least id: one, but where ids repeat
    heads = found.where(first).groupBy("root", "id", "key").agg(F.count("*").alias("n")).withColumn("least", F.min("key").over(Window.partitionBy("root")))
    gone = found.where(~first).select("id", "key", F.lit(False).alias("once"))
    more = heads.where("key <> least OR n > 1").select("id", "key", (F.col("key") == F.col("least")).alias("once"))
    return drop_rows(docs, gone.unionByName(more), id_col, F.xxhash64(text_col))
