"""Language identification by error-correcting output codes.

Every learned language has a codeword of +1 and -1. For each bit a binary
classifier over hashed character n-grams (regularised least squares, all bits
solved at once) gives a margin. Decoding is loss-weighted: a language's distance
is the sum over bits of its weight for the bit times exp(-margin * code bit),
where the weights are the shares of that language's training texts that the
bit's classifier gets right, normalised per language. The nearest codeword wins;
a small gap to the next one flags ambiguity.

The classifier learns from a bounded sample, ``PER_LANGUAGE`` texts a language
and ``MOST_TEXTS`` in all, chosen by a hash of the id among all labelled rows
outside the held-out fold. Features are computed by the tasks, and one task
solves for the weights (conjugate gradients over at most ``MOST_TEXTS`` vectors
of ``DIM`` counts, some 100 MB); nothing but the weights reaches the driver.
Whole texts are read, in learning and in prediction, long ones in chunks.
Language, source and id are never inputs of a prediction.

Defined cases: null text and text without a letter are ``und`` with score 0 (so
is everything when no language can be learned); with one learned language all
other texts get it; of languages at equal distance the first by name wins and
the text is ambiguous; null ids are not held out and not learned from; repeated
rows are predicted alike and learned from once (of several texts under one id
and language, one); an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches

#: The training sample's bounds.
PER_LANGUAGE, MOST_TEXTS = 500, 6_000
#: Ids that are ranked, as a multiple of the sample, about.
SPARE = 4
#: Hashed n-gram features, and the n-grams' lengths.
DIM, LENGTHS = 4096, (1, 2, 3, 4)
RIDGE = 0.3
#: Fold (of 4, by CRC-32 of the id's text) that is never learned from.
FOLDS, HELD_OUT = 4, 2
#: Distance to the next codeword, as a share of it, below which a text is ambiguous.
GAP = 0.1
#: Sharpness of the score.
SHARP = 8.0
#: Characters that are turned into features at once.
CHUNK = 1 << 16
UNKNOWN = "und"

_MODEL = pa.schema([("languages", pa.list_(pa.string())), ("weight", pa.binary()), ("bias", pa.binary()), ("trust", pa.binary())])
_letter = regex.compile(r"\p{L}")
#: Fixed value: odd multipliers of the rolling hash.
_MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


def features(text: str) -> np.ndarray:
    """Square roots of hashed n-gram counts, scaled to length 1. What is no letter in ASCII counts as a space."""
    lower = text.lower()
    counts = np.zeros(DIM)
    for at in range(0, len(lower), CHUNK):
        part = lower[max(0, at - max(LENGTHS) + 1) : at + CHUNK] if at else lower[:CHUNK]
        code = np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32).copy()
        code[(code < 97) | ((code > 122) & (code < 192))] = 32
        own = min(at, max(LENGTHS) - 1)  # characters repeated from the chunk before
        for n in LENGTHS:
            if len(code) < n:
                continue
            m = len(code) - n + 1
            h = np.full(m, n * 0x165667B1, np.uint32)
            blank = np.ones(m, bool)
            for k in range(n):
                h = (h ^ code[k : k + m]) * np.uint32(_MIX[k])
                h ^= h >> np.uint32(15)
                blank &= code[k : k + m] == 32
            first = max(0, own - n + 1)  # n-grams that end in the chunk before were counted there
            counts += np.bincount((h[first:] % np.uint32(DIM))[~blank[first:]], minlength=DIM)
    counts = np.sqrt(counts)
    norm = np.linalg.norm(counts)
    return (counts / norm if norm else counts).astype(np.float32)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """k rows of +1 and -1, no two columns equal or opposite: all splits for few languages, else the best of several random codes."""
    if k < 2:
        return np.ones((k, 0))
    if k <= 5:
        return np.array([[1.0, *c] for c in product([1.0, -1.0], repeat=k - 1) if min(c) < 0]).T
    rng, best = np.random.default_rng(seed), None
    bits = 12 * (k - 1).bit_length()
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], size=(k, bits))
        code = code[:, np.abs(code.sum(axis=0)) < k]
        apart = min(int((code[i] != code[j]).sum()) for i in range(k) for j in range(i)) if k <= 64 else int((code[0] != code[1:]).sum(axis=1).min())
        if best is None or apart > best[0]:
            best = (apart, code)
    return best[1]


def solve(x: np.ndarray, want: np.ndarray, scale: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray]:
    """(weight, bias) of the ridge regression of ``want`` on ``x``, rows weighted by ``scale`` squared: conjugate gradients on the normal equations.

    ``x`` is only read, in blocks, so memory beyond it is a few vectors a bit.
    """
    weigh = (scale * scale)[:, None]

    def back(rows: np.ndarray) -> np.ndarray:
        out = np.zeros((x.shape[1] + 1, rows.shape[1]))
        for i in range(0, len(x), 512):
            out[:-1] += x[i : i + 512].astype(float).T @ rows[i : i + 512]
        out[-1] = rows.sum(axis=0)
        return out

    def ahead(w: np.ndarray) -> np.ndarray:
        return np.concatenate([x[i : i + 512].astype(float) @ w[:-1] for i in range(0, len(x), 512)]) + w[-1]

    w = np.zeros((x.shape[1] + 1, want.shape[1]))
    left = back(weigh * want)
    step, size = left.copy(), (left * left).sum(axis=0)
    least = 1e-14 * size
    for _ in range(500):
        if (size <= least).all():
            break
        bent = back(weigh * ahead(step)) + ridge * step
        far = size / np.maximum((step * bent).sum(axis=0), 1e-300)
        w += far * step
        left -= far * bent
        before, size = size, (left * left).sum(axis=0)
        step = left + (size / np.maximum(before, 1e-300)) * step
    return w[:-1].astype(np.float32), w[-1].astype(np.float32)


class Model:
    """Learned languages, their codewords, the bits' classifiers and the decoding weights."""

    def __init__(self, languages: list[str], weight: np.ndarray | None = None, bias: np.ndarray | None = None, trust: np.ndarray | None = None):
        self.languages, self.code = languages, codewords(len(languages))
        self.weight, self.bias, self.trust = weight, bias, trust

    @classmethod
    def learned(cls, languages: list[str], x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> Model:
        """``x``: one feature row per text; ``y``: the index of its language."""
        model = cls(languages)
        if len(languages) < 2:
            return model
        share = np.bincount(y, minlength=len(languages)).astype(float)
        scale = np.sqrt(len(y) / (len(languages) * share[y]))  # languages count alike
        model.weight, model.bias = solve(x, model.code[y], scale, ridge)
        right = model.margins(x) * model.code[y] > 0
        good = np.array([right[y == c].mean(axis=0) for c in range(len(languages))])
        model.trust = good / np.maximum(good.sum(axis=1, keepdims=True), 1e-9)
        return model

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weight + self.bias

    def distances(self, x: np.ndarray) -> np.ndarray:
        margin = np.clip(self.margins(x), -4, 4)
        return np.stack([np.exp(-margin * c) @ t for c, t in zip(self.code, self.trust, strict=True)], axis=1)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, score, ambiguous) of each text."""
        out = [(UNKNOWN, 0.0, True)] * len(texts)
        asked = [i for i, t in enumerate(texts) if t and _letter.search(t)]
        if not self.languages or not asked:
            return out
        if len(self.languages) == 1:
            for i in asked:
                out[i] = (self.languages[0], 1.0, False)
            return out
        for at in range(0, len(asked), 256):
            part = asked[at : at + 256]
            d = self.distances(np.stack([features(texts[i]) for i in part]))
            near = np.sort(d, axis=1)
            odds = np.exp(-SHARP * (d - near[:, :1]))
            score = 1 / odds.sum(axis=1)
            for i, c, s, (one, two) in zip(part, d.argmin(axis=1), score, near[:, :2], strict=True):
                out[i] = (self.languages[c], float(s), bool(two - one < GAP * two))
        return out


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, most: int = MOST_TEXTS) -> Model:
    rows = small_batches(docs).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out("id") & F.col("text").isNotNull())
    # a language's ids are thinned by their hash to a few times the sample before they are ranked
    known = rows.groupBy("lang").agg(F.approx_count_distinct("id").alias("n"))
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 32)) / float(1 << 32)
    thin = rows.select("id", "lang").join(F.broadcast(known), "lang").where(part < SPARE * per_language / F.col("n")).select("id", "lang").distinct()
    order = [F.pmod(F.xxhash64("id"), F.lit(1 << 32)), F.col("id")]
    first = thin.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("r") <= per_language)
    chosen = first.orderBy("r", "lang").limit(most).select("id", "lang")  # at most ``most`` short rows

    @F.pandas_udf("binary")
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).tobytes() if _letter.search(t) else None for t in texts], dtype=object)

    some = rows.join(F.broadcast(chosen), ["id", "lang"]).select("id", "lang", vector("text").alias("x")).where("x is not null")
    one = some.groupBy("lang", "id").agg(F.min("x").alias("x")).repartition(1).sortWithinPartitions("lang", "id").select("lang", "x")

    def learn(batches):
        x, names = np.empty((most, DIM), np.float32), []
        for batch in batches:
            for v in batch.column(1):
                x[len(names)] = np.frombuffer(v.as_buffer(), np.float32)
                names.append(None)
            names[len(names) - batch.num_rows :] = batch.column(0).to_pylist()
        languages = sorted(set(names))
        at = {lang: i for i, lang in enumerate(languages)}
        m = Model.learned(languages, x[: len(names)], np.array([at[n] for n in names], dtype=int))
        parts = [None if p is None else np.ascontiguousarray(p).tobytes() for p in (m.weight, m.bias, m.trust)]
        yield pa.RecordBatch.from_pylist([{"languages": languages, "weight": parts[0], "bias": parts[1], "trust": parts[2]}], _MODEL)

    got = one.mapInArrow(learn, "languages array<string>, weight binary, bias binary, trust binary").collect()  # one row, the weights
    if not got or got[0]["weight"] is None:
        return Model(list(got[0]["languages"]) if got else [])
    languages, bias = list(got[0]["languages"]), np.frombuffer(got[0]["bias"], np.float32)
    return Model(languages, np.frombuffer(got[0]["weight"], np.float32).reshape(DIM, len(bias)), bias, np.frombuffer(got[0]["trust"]).reshape(len(languages), len(bias)))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with struct ``__lang`` (pred, score, ambiguous)."""

    @F.pandas_udf("pred string, score double, ambiguous boolean")
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(model.predict([None if t is None or t != t else t for t in texts]), columns=["pred", "score", "ambiguous"])

    return small_batches(docs).withColumn("__lang", of(F.col(text_col)))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score, ambiguous."""
    found = predict(docs.select(id_col, text_col), fit(docs, id_col, text_col, lang_col), text_col)
    return found.select(id_col, held_out(id_col).alias("held_out"), F.col("__lang.pred").alias("lang_pred"), F.col("__lang.score").alias("score"), F.col("__lang.ambiguous").alias("ambiguous"))


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text has a learned language; ``und`` ones go. Columns unchanged.

    Ambiguity alone rejects nothing: short clean texts are often ambiguous.
    """
    found = predict(docs, fit(docs, id_col, text_col, lang_col), text_col)
    return found.where(F.col("__lang.pred") != UNKNOWN).select(*docs.columns)
