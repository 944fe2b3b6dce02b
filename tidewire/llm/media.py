"""A media column for the driver's tables, which hold no images.

Each row of ``embeddings`` gets a grey PNG: a texture drawn from its vector
alone. Of every ten rows some show another row's scene instead: a crop, an edit
(contrast, brightness, noise), a smaller version between the search's scales, a
turn or a crop at fractions of pixels, so that the table holds copies to find.

Defined cases: a null vector gives a null image (or its base's scene); of several
vectors under a base's id one is drawn; null ids and repeated rows are drawn from
their own vectors; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .images import _at, encode, resize

SIDE = 112
#: Rows that a task draws, about.
ROWS = 512


def scene(vector: np.ndarray) -> np.ndarray:
    rng = np.random.default_rng(zlib.crc32(np.ascontiguousarray(vector, "<f4").tobytes()))
    coarse, fine = rng.normal(0, 1, (16, 16)), rng.normal(0, 1, (40, 40))
    return 128 + 40 * resize(coarse, SIDE, SIDE) + 25 * resize(fine, SIDE, SIDE)


def smaller(px: np.ndarray, factor: float) -> np.ndarray:
    """Means over the area that each pixel covers."""
    h, w = (round(n * factor) for n in px.shape)
    return resize(px, 4 * h, 4 * w).reshape(h, 4, w, 4).mean(axis=(1, 3))


def turned(px: np.ndarray, degrees: float) -> np.ndarray:
    a = np.deg2rad(degrees)
    y, x = (g - (n - 1) / 2 for g, n in zip(np.mgrid[: px.shape[0], : px.shape[1]], px.shape, strict=True))
    return _at(px, y * np.cos(a) + x * np.sin(a) + (px.shape[0] - 1) / 2, x * np.cos(a) - y * np.sin(a) + (px.shape[1] - 1) / 2)


#: Kinds 4 to 7: smaller by these factors.
FACTORS = (0.9, 0.7, 0.5, 0.33)


def variant(px: np.ndarray, kind: int, seed: int) -> np.ndarray:
    """0: as it is; 1: a crop; 2: contrast, brightness and noise; 3: a smaller version; 4 to 7: others; 8: a turn; 9: a crop between pixels."""
    if 4 <= kind <= 7:
        return smaller(px, FACTORS[kind - 4])
    if kind == 8:
        return turned(px, 17)
    if kind == 9:
        y, x = np.mgrid[: px.shape[0] - 20, : px.shape[1] - 20]
        return _at(px, y + 7.5, x + 4.3)
    rng = np.random.default_rng(seed)
    if kind == 1:
        y, x = rng.integers(0, 21, 2)
        return px[y : y + 92, x : x + 92]
    if kind == 2:
        return px * 0.8 + 30 + rng.normal(0, 3, px.shape)
    return resize(px, 90, 90) if kind == 3 else px


def rendered(embeddings: DataFrame) -> DataFrame:
    """Columns vec_id, image. In each ten ids 3, 6 and 9 show the row whose id ends in 0: kinds 1 to 3 in even tens, 4 to 6 and 7 to 9 in odd ones by turns."""
    own = embeddings.select("vec_id", "embedding")
    digit = F.pmod("vec_id", F.lit(10))
    ten = F.pmod(F.floor(F.col("vec_id") / 10), F.lit(4))
    kind = F.when(digit.isin(3, 6, 9), (digit / 3).cast("int") + F.when(ten == 1, 3).when(ten == 3, 6).otherwise(0)).otherwise(0)
    asked = own.withColumn("kind", kind).withColumn("base", F.when(F.col("kind") > 0, F.col("vec_id") - digit).otherwise(-1 - F.abs("vec_id")))  # else a key of its own
    bases = own.where(digit == 0).dropDuplicates(["vec_id"]).select(F.col("vec_id").alias("base"), F.col("embedding").alias("other"))
    # vectors are small and drawing takes long, so rows are dealt out by their number, not by their bytes
    joined = asked.join(bases, "base", "left").repartition(embeddings.count() // ROWS + 1)

    @F.pandas_udf("binary")
    def draw(vector: pd.Series, kind: pd.Series, seed: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else encode(variant(scene(np.asarray(v, np.float32)), int(k), int(s) & (1 << 63) - 1)) for v, k, s in zip(vector, kind, seed, strict=True)], dtype=object)

    shown = F.when(F.col("other").isNotNull(), F.col("kind")).otherwise(0)
    return joined.select("vec_id", draw(F.coalesce("other", "embedding"), shown, F.coalesce("vec_id", F.lit(0))).alias("image"))
