"""Copies among images by local descriptors.

An image becomes grey, then a pyramid of scales. At each scale Harris corners
are found; each gets an orientation (intensity centroid of its disc) and 256
binary tests of smoothed pixel pairs, turned by that orientation. A corner is the
highest within ``SPREAD`` pixels of its level, so their number grows with the
image; the pyramid goes down to the last level that can hold one (33 pixels).

The four words of a descriptor are the keys of four Hamming tables: corners of
different images meet that agree in the first ``WIDTH`` bits of a word, however
many do. Two images with two meetings within ``SEED`` bits, or one within
``SURE``, are compared corner by corner: corners that are each other's nearest,
at most ``DISTANCE`` bits apart, match. Each match proposes a similarity (scale, turn, shift); it
explains the matches whose places it maps onto each other and whose own turn and
scale agree with its own, so that chance matches, of which large pictures have
many, hardly ever agree. Two images link when one proposal explains at least
``CONSENSUS`` spots. Components of links are groups of copies.

Byte-equal images are one image to the search, so exact copies never pair. All
that meet are compared: no entry of a table is capped, so n_links counts every
link that the rule above finds, and work grows with the square of a crowd. Recall
against all pairs, met or not, is measured in the tests and the README.

Formats: PNG (8 bits a channel, not interlaced), PGM and PPM (binary, 8 bits).

Defined cases: null, empty, damaged and unreadable images have no corner and link
with nothing (equal ones still are one group); images without texture likewise;
images of more than ``MOST_PIXELS`` are halved until they have fewer, those of
more than ``READABLE`` count as unreadable; corners at equal distance are all
nearest; null ids take no part in the choice of a group's id; repeated rows are copies of each
other; an empty table gives an empty result; other columns of the input are
ignored.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, staged
from .components import connected

#: Step between scales; a corner is the highest within so many pixels of its level.
STEP, SPREAD = 1.25, 7
#: Radius of a corner's disc, and its margin at the border.
RADIUS, MARGIN = 13, 15
#: Most differing bits of a match; least matches of a link; pixels that a proposal may be off.
DISTANCE, CONSENSUS, TOLERANCE = 56, 5, 4.0
#: Pixels more that it may be off per pixel from its own corner; side of a spot.
SLACK, SPOT = 0.1, 8
#: Bits that corners which agree in a table share.
WIDTH = 24
#: Corners that crowd an entry of a table; the tests make crowds of more, which are compared like any others.
BUCKET = 64
#: Corners of a block, about, and pairs of corners that are compared at once.
BLOCK, ROOM = 500_000, 1 << 18
#: Most differing bits of a meeting in the tables, and of one that suffices alone.
SEED, SURE = 32, 16
#: Cosine of the angle, and the factor, by which a match's own turn and scale may differ from a proposal's.
TURN, RATIO = math.cos(math.radians(30)), 1.6
#: Pixels beyond which an image is halved, and beyond which it is not read.
MOST_PIXELS, READABLE = 1 << 22, 1 << 27
WORDS = ("d0", "d1", "d2", "d3")


def _tests(seed: int = 5) -> np.ndarray:
    """256 pairs of points in the disc, (256, 4)."""
    rng = np.random.default_rng(seed)
    out: list = []
    while len(out) < 256:
        p = rng.normal(0, RADIUS / 2.2, 4)
        if math.hypot(p[0], p[1]) < RADIUS and math.hypot(p[2], p[3]) < RADIUS:
            out.append(p)
    return np.array(out)


TESTS = _tests()
_grid = np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1]
DISC = np.argwhere(_grid[0] ** 2 + _grid[1] ** 2 <= RADIUS**2) - RADIUS


def decode(data: bytes | None) -> np.ndarray | None:
    """Grey values as floats; None for what cannot be read."""
    try:
        px = _read(data) if data else None
    except (ValueError, TypeError, OverflowError, IndexError, MemoryError, struct.error, zlib.error):
        return None
    while px is not None and px.size > MOST_PIXELS:
        h, w = (n // 2 * 2 for n in px.shape)
        px = px[:h, :w].reshape(h // 2, 2, w // 2, 2).mean(axis=(1, 3)) if h and w else None
    return px


def _read(data: bytes) -> np.ndarray | None:
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return _png(data)
    m = re.match(rb"P([56])\s+(?:#[^\n]*\s+)*(\d{1,9})\s+(\d{1,9})\s+(\d{1,9})\s", data)
    if not m or not 0 < int(m[4]) < 256 or not 0 < int(m[2]) * int(m[3]) <= READABLE:
        return None
    width, height, n = int(m[2]), int(m[3]), 1 if m[1] == b"5" else 3
    return np.frombuffer(data, np.uint8, width * height * n, m.end()).reshape(height, width, n).mean(axis=2)


def _png(data: bytes) -> np.ndarray | None:
    at, parts, palette = 8, [], None
    width = height = depth = kind = interlace = 0
    while at + 8 <= len(data):
        size, name = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + size]
        at += 12 + size
        if name == b"IHDR":
            width, height, depth, kind, _, _, interlace = struct.unpack(">IIBBBBB", part)
        elif name == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif name == b"IDAT":
            parts.append(part)
    n = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}.get(kind)
    if depth != 8 or interlace or n is None or not 0 < width * height <= READABLE or kind == 3 and palette is None:
        return None
    room = height * (width * n + 1)  # no more is unpacked, whatever the data hold
    raw = np.frombuffer(zlib.decompressobj().decompress(b"".join(parts), room), np.uint8).reshape(height, width * n + 1)
    out = np.zeros((height, width * n), np.uint8)
    above = np.zeros(width * n, np.uint8)
    for y in range(height):
        line, how = raw[y, 1:], raw[y, 0]
        if how == 0:
            row = line
        elif how == 2:
            row = line + above
        else:
            row = _unfilter(line, above, n, how)
        out[y] = above = row
    px = out.reshape(height, width, n)
    if kind == 3:
        return palette[px[:, :, 0]].mean(axis=2)
    return px[:, :, : n - 1 if kind in (4, 6) else n].mean(axis=2)


def _unfilter(line: np.ndarray, above: np.ndarray, n: int, how: int) -> np.ndarray:
    row, up = [0] * n, [0] * n + above.tolist()
    for i, v in enumerate(line.tolist()):
        a, b, c = row[i], up[i + n], up[i]
        if how == 1:
            p = a
        elif how == 3:
            p = (a + b) // 2
        else:
            q = a + b - c
            p = min((abs(q - a), 0, a), (abs(q - b), 1, b), (abs(q - c), 2, c))[2]
        row.append((v + p) & 255)
    return np.array(row[n:], np.uint8)


def encode(px: np.ndarray) -> bytes:
    """A grey PNG."""
    px = np.clip(np.rint(px), 0, 255).astype(np.uint8)
    lines = np.hstack([np.zeros((len(px), 1), np.uint8), px]).tobytes()
    chunk = lambda name, part: struct.pack(">I", len(part)) + name + part + struct.pack(">I", zlib.crc32(name + part))
    head = struct.pack(">IIBBBBB", px.shape[1], px.shape[0], 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines, 1)) + chunk(b"IEND", b"")


def _box(a: np.ndarray, r: int) -> np.ndarray:
    """Means over squares of 2r + 1 pixels, edges repeated."""
    p = np.pad(a, r + 1, mode="edge").cumsum(axis=0).cumsum(axis=1)
    k = 2 * r + 1
    h, w = a.shape
    return (p[k : k + h, k : k + w] - p[:h, k : k + w] - p[k : k + h, :w] + p[:h, :w]) / (k * k)


def resize(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear."""
    def weights(n: int, m: int) -> np.ndarray:
        at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        low = np.floor(at).astype(int)
        high = np.minimum(low + 1, n - 1)
        out = np.zeros((m, n))
        np.add.at(out, (np.arange(m), low), 1 - (at - low))
        np.add.at(out, (np.arange(m), high), at - low)
        return out

    return weights(a.shape[0], height) @ a @ weights(a.shape[1], width).T


def _at(a: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Bilinear values at fractional places."""
    y, x = np.clip(y, 0, a.shape[0] - 1.001), np.clip(x, 0, a.shape[1] - 1.001)
    iy, ix = y.astype(int), x.astype(int)
    fy, fx = y - iy, x - ix
    return a[iy, ix] * (1 - fy) * (1 - fx) + a[iy + 1, ix] * fy * (1 - fx) + a[iy, ix + 1] * (1 - fy) * fx + a[iy + 1, ix + 1] * fy * fx


def _peak(low: np.ndarray, mid: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where, within half a step, the parabola through three values is highest."""
    bend = low - 2 * mid + high
    return np.clip(np.where(bend < 0, (low - high) / (2 * np.where(bend < 0, bend, 1)), 0), -0.5, 0.5)


def _highest(a: np.ndarray, r: int) -> np.ndarray:
    """Maxima over squares of 2r + 1 pixels, edges repeated."""
    for axis in (0, 1):
        n = a.shape[axis]
        p = np.pad(a, [(r, r) if i == axis else (0, 0) for i in (0, 1)], mode="edge")
        a = np.max([p.take(range(i, i + n), axis) for i in range(2 * r + 1)], axis=0)
    return a


def _levels(px: np.ndarray) -> list[np.ndarray]:
    """The pyramid, each level made from the one before, down to the last that can hold a corner."""
    out: list = []
    while min(shape := [round(n / STEP ** len(out)) for n in px.shape]) > 2 * MARGIN + 2:
        out.append(resize(out[-1], *shape) if out else px)
    return out


def _told(smooth: np.ndarray, blurred: np.ndarray, y: np.ndarray, x: np.ndarray) -> tuple[list, list]:
    """Angles and descriptors of corners."""
    y, x = y[:, None], x[:, None]
    disc = _at(smooth, y + DISC[:, 0], x + DISC[:, 1])
    angle = np.arctan2((disc * DISC[:, 0]).sum(axis=1), (disc * DISC[:, 1]).sum(axis=1))
    c, s = np.cos(angle)[:, None], np.sin(angle)[:, None]
    dots = TESTS.reshape(-1, 2)
    value = _at(blurred, y + dots[:, 0] * s + dots[:, 1] * c, x + dots[:, 0] * c - dots[:, 1] * s)
    return angle.tolist(), np.packbits(value[:, ::2] < value[:, 1::2], axis=1).view(">i8").tolist()


def describe(px: np.ndarray | None) -> list[tuple]:
    """Corners (x, y, angle, scale, four 64-bit parts of the descriptor), strongest first."""
    if px is None:
        return []
    found = []
    for level, a in enumerate(_levels(px)):
        h, w = a.shape
        smooth = _box(_box(a, 1), 1)
        dy, dx = np.gradient(smooth)
        xx, yy, xy = _box(dx * dx, 2), _box(dy * dy, 2), _box(dx * dy, 2)
        r = xx * yy - xy * xy - 0.05 * (xx + yy) ** 2
        inner = (slice(MARGIN, h - MARGIN), slice(MARGIN, w - MARGIN))
        y, x = np.nonzero((r[inner] == _highest(r, SPREAD)[inner]) & (r[inner] > 1e-3))
        y, x = y + MARGIN, x + MARGIN
        at_y, at_x = y + _peak(r[y - 1, x], r[y, x], r[y + 1, x]), x + _peak(r[y, x - 1], r[y, x], r[y, x + 1])
        blurred, fy, fx = _box(smooth, 1), px.shape[0] / h, px.shape[1] / w
        for i in range(0, len(y), 256):  # bounds the memory that a large picture takes
            own_y, own_x = at_y[i : i + 256], at_x[i : i + 256]
            for k, (angle, words) in enumerate(zip(*_told(smooth, blurred, own_y, own_x), strict=True)):
                place = (float((own_x[k] + 0.5) * fx), float((own_y[k] + 0.5) * fy))
                found.append((-r[y[i + k], x[i + k]], (*place, angle, STEP**level, words)))
    return [c for _, c in sorted(found)]


CORNER = "struct<x:double,y:double,angle:double,scale:double,d:array<bigint>>"


def descriptors(images: DataFrame, id_col: str, image_col: str) -> DataFrame:
    """Columns id, digest (SHA-256 of the bytes), corners."""

    @F.pandas_udf(f"array<{CORNER}>")
    def of(data: pd.Series) -> pd.Series:
        names = ("x", "y", "angle", "scale", "d")
        return pd.Series([[dict(zip(names, c, strict=True)) for c in describe(decode(d))] for d in data], dtype=object)

    blob = F.coalesce(F.col(image_col), F.lit(b""))
    return small_batches(images).select(F.col(id_col).alias("id"), F.sha2(blob, 256).alias("digest"), of(blob).alias("corners"))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, one after another."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class _Pictures:
    """Pictures with their corners as arrays, by img: corners of picture p are ``at[p] : at[p + 1]``."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("img").combine_chunks()
        corners = rows.column("corners").combine_chunks()
        self.img = rows.column("img").to_numpy()
        self.at = np.concatenate([[0], np.cumsum(corners.value_lengths().to_numpy())]).astype(np.int64)
        found = corners.flatten()
        self.x, self.y, self.angle, self.scale = (found.field(n).to_numpy(zero_copy_only=False) for n in ("x", "y", "angle", "scale"))
        self.d = found.field("d").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(WORDS)).view(np.uint64)
        self.of = np.repeat(np.arange(len(self.img)), np.diff(self.at))

    def tables(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """The corners of each Hamming table in the order of their first bits, and these."""
        out = []
        for t in range(len(WORDS)):
            head = self.d[:, t] >> np.uint64(64 - WIDTH)
            order = np.argsort(head, kind="stable")
            out.append((order, head[order]))
        return out


def _met(own: _Pictures, first: int, last: int, other: _Pictures, tables: list, same: bool) -> Iterator[tuple[int, np.ndarray]]:
    """Pictures first to last of ``own``, each with those of ``other`` that it meets often or closely enough."""
    seen = np.zeros((last - first) * len(other.img), np.int32)
    lo, hi = own.at[first], own.at[last]
    for t, (order, heads) in enumerate(tables):
        mine = own.d[lo:hi, t] >> np.uint64(64 - WIDTH)
        start = np.searchsorted(heads, mine)
        size = np.searchsorted(heads, mine, "right") - start
        total = np.concatenate([[0], np.cumsum(size)])
        k = 0
        while k < len(mine):  # an entry of any size is compared whole, so many pairs at a time
            end = max(k + 1, int(np.searchsorted(total, total[k] + ROOM, "right")) - 1)
            x, y = np.repeat(np.arange(lo + k, lo + end), size[k:end]), order[_ranges(start[k:end], size[k:end])]
            k = end
            if same:
                later = own.of[x] > other.of[y]
                x, y = x[later], y[later]
            apart = own.d[x] ^ other.d[y]
            bits = np.bitwise_count(apart).sum(axis=1, dtype=np.uint16)
            # corners that an earlier table brought together have been counted there
            new = (bits <= SEED) & ((apart[:, :t] >> np.uint64(64 - WIDTH)) != 0).all(axis=1)
            x, y, bits = x[new], y[new], bits[new]
            np.add.at(seen, (own.of[x] - first) * len(other.img) + other.of[y], np.where(bits <= SURE, 2, 1).astype(np.int32))
    for p, row in enumerate(seen.reshape(last - first, -1), first):
        yield p, np.flatnonzero(row > 1)


def _matches(own: _Pictures, p: int, other: _Pictures, among: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Corners of picture p and of those ``among`` the others that are each other's nearest, by picture: (place in ``among``, own corner, other corner)."""
    sizes = other.at[among + 1] - other.at[among]
    cols, begins = _ranges(other.at[among], sizes), np.cumsum(sizes) - sizes
    segment = np.repeat(np.arange(len(among)), sizes)
    lo, hi = own.at[p], own.at[p + 1]
    there = np.ascontiguousarray(other.d[cols].T)
    step = max(1, ROOM // len(cols))

    def tile(k: int) -> np.ndarray:
        here = own.d[k : min(k + step, hi)]
        bits = np.zeros((len(here), len(cols)), np.uint16)
        for t in range(len(WORDS)):
            bits += np.bitwise_count(here[:, t, None] ^ there[t])
        return bits

    at = range(lo, hi, step)
    kept = {k: tile(k) for k in at} if len(cols) * (hi - lo) <= 8 * ROOM else {}  # else computed twice
    least = np.min([(kept[k] if kept else tile(k)).min(axis=0) for k in at], axis=0)
    found = []
    for k in at:
        bits = kept[k] if kept else tile(k)
        i, j = np.nonzero((bits == least) & (bits <= distance))
        nearest = np.minimum.reduceat(bits, begins, axis=1)
        ok = bits[i, j] == nearest[i, segment[j]]
        found.append((segment[j[ok]], i[ok] + k, cols[j[ok]]))
    place, x, y = (np.concatenate(c) for c in zip(*found, strict=True))
    by = np.argsort(place, kind="stable")
    return place[by], x[by], y[by]


def _explained(a: _Pictures, x: np.ndarray, b: _Pictures, y: np.ndarray, consensus: int, tolerance: float) -> int:
    """Most spots that the proposal of one match explains; 0 if fewer than ``consensus``."""
    turn, ratio = b.angle[y] - a.angle[x], b.scale[y] / a.scale[x]
    cos, sin, best = ratio * np.cos(turn), ratio * np.sin(turn), 0
    ax, ay, bx, by = a.x[x], a.y[x], b.x[y], b.y[y]
    # one spot of a picture counts once, at however many scales it has corners
    spots = [(u // SPOT).astype(np.int64) << 32 | (v // SPOT).astype(np.int64) for u, v in ((ax, ay), (bx, by))]
    step = max(1, ROOM // len(x))
    for k in range(0, len(x), step):
        h = slice(k, k + step)
        c, s = cos[h, None], sin[h, None]
        right, down = ax - ax[h, None], ay - ay[h, None]
        off_x, off_y = c * right - s * down - (bx - bx[h, None]), s * right + c * down - (by - by[h, None])
        # a proposal's angle and scale are rough, so the tolerance grows with the distance from its own corner
        reach = tolerance + SLACK * ratio[h, None] * np.hypot(right, down)
        own = ratio / ratio[h, None]
        good = (off_x * off_x + off_y * off_y <= reach * reach) & (np.cos(turn - turn[h, None]) >= TURN) & (own >= 1 / RATIO) & (own <= RATIO)
        n = good.sum(axis=1)
        if n.max() < consensus:
            continue
        for i in np.argsort(-n, kind="stable"):
            if n[i] <= best or n[i] < consensus:
                break
            best = max(best, min(len(set(told[good[i]].tolist())) for told in spots))
    return best if best >= consensus else 0


def _linked(own: _Pictures, other: _Pictures, same: bool, distance: int, consensus: int, tolerance: float) -> Iterator[tuple]:
    """(a, b, n) of the linked pictures of two blocks, or of one with itself."""
    tables, step = other.tables(), max(1, min(256, 4 * ROOM // len(other.img)))
    for first in range(0, len(own.img), step):
        for p, met in _met(own, first, min(first + step, len(own.img)), other, tables, same):
            room = max(1, ROOM // max(1, int(own.at[p + 1] - own.at[p])))
            sizes = np.cumsum(other.at[met + 1] - other.at[met]) if len(met) else np.zeros(0)
            for among in np.split(met, np.flatnonzero(np.diff(sizes // room)) + 1) if len(met) else ():
                place, x, y = _matches(own, p, other, among, distance)
                n = np.bincount(place, minlength=len(among))
                ends = np.cumsum(n)
                for q in np.flatnonzero(n >= consensus):
                    i, j = x[ends[q] - n[q] : ends[q]], y[ends[q] - n[q] : ends[q]]
                    a, b = own.img[p], other.img[among[q]]
                    told = _explained(own, i, other, j, consensus, tolerance) if a > b else _explained(other, j, own, i, consensus, tolerance)
                    if told:
                        yield max(a, b), min(a, b), told


def links_of(pictures: DataFrame, distance: int = DISTANCE, consensus: int = CONSENSUS, tolerance: float = TOLERANCE, block: int = BLOCK) -> DataFrame:
    """Pairs of images (a, b) of ``pictures`` (img, corners) with the matches that one similarity explains (n).

    Pictures are dealt to blocks of about ``block`` corners; a task gets two blocks
    (or one) and compares each picture of one with each of the other, so nothing
    is shuffled but the pictures, once for each block, and memory is bounded
    however many corners share an entry.
    """
    known = pictures.where(F.size("corners") > 0).select("img", "corners")
    n = max(1, math.ceil((known.agg(F.sum(F.size("corners"))).first()[0] or 0) / block))
    own, other = F.pmod(F.xxhash64("img"), F.lit(n)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = known.withColumn("own", own).withColumn("other", other)
    low, high = F.least("own", "other"), F.greatest("own", "other")
    dealt = dealt.select("img", "corners", (F.col("own") == low).alias("low"), (low == high).alias("same"), (low * n - F.floor(low * (low - 1) / 2) + high - low).cast("int").alias("cell"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        same = rows.column("same")[0].as_py()
        left = _Pictures(rows.filter(rows.column("low")).select(["img", "corners"]))
        right = left if same else _Pictures(rows.filter(pc.invert(rows.column("low"))).select(["img", "corners"]))
        if not len(left.img) or not len(right.img):
            return
        del rows, batches
        found = _linked(left, right, same, distance, consensus, tolerance)
        while some := list(islice(found, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*some, strict=True)], ["a", "b", "n"])

    return small_batches(dealt.repartitionById(n * (n + 1) // 2, F.col("cell"))).mapInArrow(compare, "a long, b long, n long")


def links(corners: DataFrame, distance: int = DISTANCE, consensus: int = CONSENSUS, tolerance: float = TOLERANCE, block: int = BLOCK) -> DataFrame:
    """``links_of`` for corners (img, corner, c) in rows of their own."""
    return links_of(corners.groupBy("img").agg(F.collect_list("c").alias("corners")), distance, consensus, tolerance, block)


def find_copies(images: DataFrame, id_col: str = "id", image_col: str = "image") -> DataFrame:
    """One row per row of ``images``: id, n_corners, n_links (of its picture), group_id (least id of its group)."""
    rows = staged(descriptors(images, id_col, image_col), "corners")
    pictures = staged(rows.groupBy("digest").agg(F.min("id").alias("first"), F.first("corners").alias("corners")).withColumn("img", F.xxhash64("digest")), "pictures")
    linked = staged(links_of(pictures), "links")
    degree = linked.select(F.col("a").alias("img")).unionByName(linked.select(F.col("b").alias("img"))).groupBy("img").agg(F.count("*").alias("n_links"))
    roots = staged(connected(linked.select("a", "b")), "roots")
    grouped = pictures.select("digest", "img", "first", F.size("corners").alias("n_corners")).join(degree, "img", "left").join(roots, F.col("img") == F.col("node"), "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "img"))
    least = grouped.groupBy("root").agg(F.min("first").alias("group_id"))
    known = grouped.join(least, "root").select("digest", "n_corners", F.coalesce("n_links", F.lit(0)).alias("n_links"), "group_id")
    return rows.select("id", "digest").join(known, "digest").select(F.col("id").alias(id_col), "n_corners", "n_links", "group_id")
