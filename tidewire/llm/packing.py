"""Best-fit packing with linear grouping.

Documents become token ids (a public byte-level BPE, then an end id). Longer
ones than ``capacity`` are cut so that only the first piece is shorter; full
pieces are sequences of their own. What is left to pack is one piece of
1..capacity-1 tokens per document, so a histogram of at most ``capacity - 1``
counts describes it whatever the corpus, and the plan is made from that:

1. linear grouping: lengths above ``capacity / 4``, longest first, form groups
   of equal cardinality; a group's lengths are rounded up to its longest;
2. few-size configurations: every multiset of at most three rounded lengths
   that fits is a configuration; a linear program (simplex with all columns
   priced) covers the groups with fewest sequences, and its floor is taken;
3. substitution: real lengths replace the rounded ones, run by run; the last
   place of a sequence takes the longest length that really fits, which is never
   shorter than what the configuration foresaw;
4. the large ones left over, then the small ones, longest first, go best-fit
   into the tightest gap that takes them.

The plan is a list of runs (length, ranks, first sequence, offset), a few
thousand rows for any input. Documents get a rank within their length (in
salted buckets, so a length that a third of all rows share is no hot group) and
join the broadcast runs.

Defined cases: null text is empty, and empty text is the end id alone; null ids
and repeated rows are documents of their own; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, small_table, staged

CAPACITY = 1024
#: Id that ends each document.
END = 2
#: Groups of equal cardinality.
GROUPS = 96
#: Lengths up to capacity / SMALL count as small.
SMALL = 4
#: Rows that share a length and a salt, about.
BUCKET = 500
#: Words beyond this many characters go the tokenizers' own way, which is not quadratic in them.
LONG_WORD = 2_000

_loaded: dict = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str):
    """text -> ids, as the tokenizer file at ``path`` gives them.

    The merges run in tiktoken, built from the file's own vocabulary, which is
    four times as fast; texts that hold a special token's string or a very long
    word take the tokenizers library.
    """
    if path in _loaded:
        return _loaded[path]
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    library: list = []

    def slow(text: str) -> list[int]:
        if not library:  # seldom needed, and large
            from tokenizers import Tokenizer

            library.append(Tokenizer.from_file(path))
        return library[0].encode(text, add_special_tokens=False).ids

    special = [t["content"] for t in spec.get("added_tokens", [])]
    # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    if spec.get("normalizer") or spec["model"]["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space") or not spec["pre_tokenizer"].get("use_regex", True):
        return _loaded.setdefault(path, slow)  # not the kind of file that the pattern is for
    fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        odd = any(s in text for s in special) or len(text) > LONG_WORD and max(map(len, text.split()), default=0) > LONG_WORD
        return slow(text) if odd else fast.encode_ordinary(text)

    _loaded[path] = encode
    return encode


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document of ``n`` ids; only the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, capacity: int, end: int) -> DataFrame:
    """One row per document: id, row (unique), first (length of the first piece), full (first full sequence number), crcs of all pieces."""

    def run(batches):
        encode = encoder(tokenizer)
        base = TaskContext.get().partitionId() << 33
        row, full = 0, 0
        for batch in batches:
            out = []
            for i, text in zip(batch["id"].tolist(), batch["text"].tolist(), strict=True):
                ids = np.array([*encode(text), end], dtype="<u4")
                parts = cut(len(ids), capacity)
                out.append((i, base + row, parts[0][1], base + full, [zlib.crc32(ids[s : s + n].tobytes()) for s, n in parts]))
                row, full = row + 1, full + len(parts) - (parts[0][1] < capacity)
            yield pd.DataFrame(out, columns=["id", "row", "first", "full", "crcs"]).astype({"id": "Int64"} if kind == "bigint" else {"id": object})

    kind = dict(docs.dtypes)[id_col]
    texts = small_batches(docs).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if kind == "bigint":  # null ids would make pandas read longs as doubles
        texts = texts.withColumn("id", F.col("id").cast("string"))
    out = texts.mapInPandas(_strings(run) if kind == "bigint" else run, f"id {kind}, row long, first int, full long, crcs array<long>")
    return out


def _strings(run):
    def inner(batches):
        for part in run(batches):
            part["id"] = pd.array([None if x is None or x is pd.NA else int(x) for x in part["id"]], dtype="Int64")
            yield part

    return inner


# --- the plan, from the histogram alone ---


def groups(counts: dict[int, int], k: int) -> list[tuple[int, dict[int, int]]]:
    """Equal-cardinality groups, longest first: (rounded length, {length: count}). With at most k lengths, a group for each."""
    if len(counts) <= k:
        return [(n, {n: counts[n]}) for n in sorted(counts, reverse=True)]
    each, out, room = -(-sum(counts.values()) // k) if counts else 0, [], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                out.append((length, {}))
                room = each
            n = min(left, room)
            out[-1][1][length] = n
            left, room = left - n, room - n
    return out


def configurations(tops: list[int], capacity: int, most: int = 3) -> list[tuple[int, ...]]:
    return [c for n in range(1, most + 1) for c in combinations_with_replacement(range(len(tops)), n) if sum(tops[g] for g in c) <= capacity]


def cover(need: np.ndarray, configs: list[tuple[int, ...]]) -> dict[tuple[int, ...], int]:
    """Whole numbers of configurations that cover at most ``need``: the floor of the linear program's optimum."""
    k = len(need)
    a = np.zeros((k, len(configs)), np.float32)
    for j, c in enumerate(configs):
        for g in c:
            a[g, j] += 1
    where = {c: j for j, c in enumerate(configs)}
    basis = [where[(g,)] for g in range(k)]
    inverse, x = np.eye(k), need.astype(float)
    for _ in range(60 * k):
        price = inverse.sum(axis=0)
        gain = price.astype(np.float32) @ a
        j = int(gain.argmax())
        if gain[j] <= 1 + 1e-5:
            break
        d = inverse @ a[:, j].astype(float)
        ok = d > 1e-9
        ratio = np.full(k, np.inf)
        ratio[ok] = x[ok] / d[ok]
        r = int(ratio.argmin())
        step = ratio[r]
        x = np.maximum(x - step * d, 0)
        x[r] = step
        pivot = inverse[r] / d[r]
        inverse = inverse - np.outer(d, pivot)
        inverse[r] = pivot
        basis[r] = j
    out: dict[tuple[int, ...], int] = defaultdict(int)
    for b, v in zip(basis, x, strict=True):
        if v >= 1 - 1e-9:
            out[configs[b]] += int(v + 1e-9)
    return out


class _Bins:
    """Runs of sequences with equal content, by gap; every length hands out its ranks in order."""

    def __init__(self, capacity: int):
        self.capacity, self.made, self.rows = capacity, 0, []
        self.next_rank: dict[int, int] = defaultdict(int)
        self.by_gap: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.gaps: list[int] = []

    def new(self, n: int) -> int:
        self.made += n
        return self.made - n

    def place(self, length: int, n: int, first: int, offset: int) -> None:
        rank = self.next_rank[length]
        self.next_rank[length] = rank + n
        self.rows.append((length, rank, rank + n, first, offset))

    def open(self, first: int, n: int, used: int) -> None:
        gap = self.capacity - used
        if gap and n:
            if not self.by_gap[gap]:
                insort(self.gaps, gap)
            self.by_gap[gap].append((first, n))

    def best_fit(self, length: int, count: int) -> None:
        while count:
            at = bisect_left(self.gaps, length)
            if at == len(self.gaps):
                n = -(-count // (self.capacity // length))
                self.open(self.new(n), n, 0)
                continue
            gap = self.gaps[at]
            first, n = self.by_gap[gap].pop()
            if not self.by_gap[gap]:
                self.gaps.pop(at)
            take = min(n, count)
            self.place(length, take, first, self.capacity - gap)
            self.open(first + take, n - take, self.capacity - gap)
            self.open(first, take, self.capacity - gap + length)
            count -= take


def plan(counts: dict[int, int], capacity: int = CAPACITY, k: int = GROUPS) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rows (length, rank_lo, rank_hi, sequence of rank_lo, offset) and the number of sequences."""
    large = {n: c for n, c in counts.items() if n > capacity // SMALL}
    grouped, bins, left = groups(large, k), _Bins(capacity), dict(large)

    def put(runs: list, lengths: list[int]) -> list:
        """Add to each run (first sequence, sequences, tokens used) the longest of ``lengths`` that are left and fit."""
        out = []
        for first, many, used in runs:
            for length in lengths:
                if many and left[length] and used + length <= capacity:
                    take = min(many, left[length])
                    bins.place(length, take, first, used)
                    out.append((first, take, used + length))
                    left[length] -= take
                    first, many = first + take, many - take
            if many:
                bins.open(first, many, used)
        return out

    if grouped:
        everything = sorted(large, reverse=True)
        pools = [sorted(g, reverse=True) for _, g in grouped]
        chosen = cover(np.array([sum(g.values()) for _, g in grouped]), configurations([t for t, _ in grouped], capacity))
        for config, n in sorted(chosen.items()):
            n = min(n, sum(left[x] for x in pools[config[0]]))
            runs = [(bins.new(n), n, 0)] if n else []
            for i, g in enumerate(config):
                # the last place was kept for any length of its group, so it takes the longest that really fits
                runs = put(runs, pools[g] if i == 0 or i < len(config) - 1 else everything)
            for run in runs:
                bins.open(*run)
    for length in sorted(left, reverse=True):
        bins.best_fit(length, left[length])
    for length in sorted((n for n in counts if n not in large), reverse=True):
        bins.best_fit(length, counts[length])
    return bins.rows, bins.made


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY, end: int = END, k: int = GROUPS) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Sequences of several pieces count from 0; those of one full piece are
    negative.
    """
    spark = docs.sparkSession
    cuts = staged(pieces(docs, id_col, text_col, tokenizer or default_tokenizer(), capacity, end), "pieces")
    short = cuts.where(F.col("first") < capacity)
    counts = {r["first"]: r["n"] for r in short.groupBy("first").agg(F.count("*").alias("n")).collect()}  # fewer than capacity rows
    rows, _ = plan(counts, capacity, k)
    runs = small_table(spark, rows, "first int, lo long, hi long, bin long, at int")
    salts = max(1, sum(counts.values()) // BUCKET)
    salted = short.select("row", "first", F.pmod(F.xxhash64("row"), F.lit(salts)).alias("salt"))
    per = salted.groupBy("first", "salt").agg(F.count("*").alias("n"))
    before = per.select("first", "salt", (F.sum("n").over(Window.partitionBy("first").orderBy("salt")) - F.col("n")).alias("before"))
    ranked = salted.withColumn("r", F.row_number().over(Window.partitionBy("first", "salt").orderBy("row")) - 1).join(before, ["first", "salt"])
    ranked = ranked.withColumn("r", F.col("r") + F.col("before")).drop("before", "salt")
    put = ranked.join(F.broadcast(runs), "first").where("r >= lo and r < hi")
    put = put.select("row", (F.col("bin") + F.col("r") - F.col("lo")).alias("bin"), "at")
    every = cuts.join(put, "row", "left").select("*", F.posexplode("crcs").alias("piece", "crc"))
    head = F.col("first") < capacity
    lead = head & (F.col("piece") == 0)
    nth = F.col("piece") - F.when(head, 1).otherwise(0)
    return every.select(
        F.col("id").alias(id_col),
        "piece",
        F.when(F.col("piece") == 0, 0).otherwise(F.col("first") + (F.col("piece") - 1).cast("long") * capacity).cast("long").alias("start"),
        F.when(F.col("piece") == 0, F.col("first")).otherwise(capacity).cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"),
        F.when(lead, F.col("bin")).otherwise(-1 - F.col("full") - nth).alias("sequence_id"),
        F.when(lead, F.col("at")).otherwise(0).cast("long").alias("offset"),
    )
